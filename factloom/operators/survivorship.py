"""Facts and survivorship: one golden row an entity from ranked field-level facts, and the conflicts resolved.

A fact is (entity, field, value, source, source_class, retrieved, asserted_at, basis, site_visit, confidence,
row_hash, ord). Rules are data: for each field an ordered list of tokens (a source, class:X, basis:Y or
site_visit). The rank of a fact is an expression made from the rules, so one pass ranks all fields; winners are
aggregates with map-side combination, so no entity's facts are gathered in one task; a task of many entities may
sort its own rows first (spark.sql.objectHashAggregate.sortBased.fallbackThreshold).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import plausible_number

# Who may rule an entity out, and by which flags.
HUMAN = ["employee_feedback", "operator"]
EXCLUDING_SOURCES = [*HUMAN, "web_research"]
EXCLUDING_FLAGS = ["not_ic", "closed"]
# Sources ranked below all others unless a rule names them, and the bases that lift them.
WEB_SOURCES = ["ai_search", "manual_web_lookup", "web_research"]
WEB_BASES = ["web_verified", "web_primary"]
MONITOR_FIX = "monitor_fix"

FACT = ["entity", "field", "value", "source", "source_class", "retrieved", "asserted_at", "basis", "site_visit", "confidence", "row_hash", "ord"]


@dataclass
class Rules:
    default: list[str]
    fields: dict[str, list[str]] = field(default_factory=dict)
    #: name: (pooled fields, order, least, most)
    derived: dict[str, tuple[list[str], list[str], float, float]] = field(default_factory=dict)


def facts(df: DataFrame, **given: Column) -> DataFrame:
    """The fact columns in order, absent ones null."""
    kinds = dict.fromkeys(FACT, "string") | {"entity": None, "site_visit": "boolean", "confidence": "double", "ord": "bigint"}
    return df.select(*[(given[c] if c in given else (F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]))).alias(c) for c in FACT])


def unpivot(rows: DataFrame, ids: list[str], columns: dict[str, str]) -> DataFrame:
    """One row for each non-blank column: field and value. columns: field -> column."""
    wide = rows.select(*ids, *[F.trim(F.col(c).cast("string")).alias(f) for f, c in columns.items()])
    return wide.unpivot(ids, list(columns), "field", "value").where("value is not null and value <> ''")


def rank_of(order: list[str]) -> Column:
    """Position of the first token that names the fact; later for what no token names."""
    n = len(order)
    out = F.lit(float(n))
    for i, token in reversed(list(enumerate(order))):
        kind, _, name = token.partition(":")
        if token == "site_visit":
            hit = F.coalesce("site_visit", F.lit(False))
        else:
            hit = F.coalesce(F.col({"class": "source_class", "basis": "basis"}.get(kind, "source") if name else "source") == (name or token), F.lit(False))
        out = F.when(hit, float(i)).otherwise(out)
    first_auto = next((i for i, p in enumerate(order) if p not in [*HUMAN, "site_visit"]), n)
    first_machine = next((i for i, p in enumerate(order) if p not in HUMAN), n)
    web = F.lit(float(n + 1))
    lifted = F.lit(first_auto - 0.5) + 0.25 * (F.col("basis") == WEB_BASES[1]).cast("double") - 0.1 * F.coalesce("confidence", F.lit(0.0))
    web = F.when((F.col("source") == "web_research") & F.col("basis").isin(WEB_BASES), lifted).otherwise(web)
    for i, token in reversed(list(enumerate(order))):
        named = F.col("source") == token
        if token.startswith("basis:"):
            named = (F.col("source") == "web_research") & F.coalesce(F.col("basis") == token[6:], F.lit(False))
        web = F.when(named, float(i)).otherwise(web)
    out = F.when(F.coalesce(F.col("basis") == "street_interpolated", F.lit(False)), float(n + 2)).otherwise(out)
    if MONITOR_FIX not in order:
        out = F.when(F.col("source") == MONITOR_FIX, first_machine - 0.7).otherwise(out)
    return F.when(F.col("source").isin(WEB_SOURCES), web).otherwise(out)


def ranked(facts_: DataFrame, rules: Rules) -> DataFrame:
    rank = F.lit(None).cast("double")
    for name, order in rules.fields.items():
        rank = F.when(F.col("field") == name, rank_of(order)).otherwise(rank)
    return facts_.withColumn("rank", F.coalesce(rank, rank_of(rules.default)))


def preference(rank: Column) -> Column:
    """Greatest for the winner: least rank, then most recent, then first in input order."""
    tie = F.when(F.col("source") == HUMAN[0], F.coalesce("row_hash", F.lit(""))).otherwise("")
    return F.struct(-rank, F.coalesce("retrieved", F.lit("")), F.coalesce("asserted_at", F.lit("")), tie, -F.col("ord"))


def golden(facts_: DataFrame, rules: Rules, fields: list[str], keep_excluded: bool = False) -> DataFrame:
    """entity, each field and field__source, each derived field, n_assertions, n_sources. One shuffle, by entity."""
    rows = ranked(facts_, rules)
    won = F.struct("value", "source")
    aggregates = [F.max_by(F.when(F.col("field") == f, won), F.when(F.col("field") == f, preference(F.col("rank")))).alias(f"_{f}") for f in fields]
    for name, (pool, order, low, high) in rules.derived.items():
        number = plausible_number(F.col("value"), low, high)
        fits = F.col("field").isin(pool) & number.isNotNull()
        aggregates.append(F.max_by(F.when(fits, F.struct(number.alias("value"), "source")), F.when(fits, preference(rank_of(order)))).alias(f"_{name}"))
    wide = rows.groupBy("entity").agg(*aggregates, F.count("*").alias("n_assertions"), F.size(F.collect_set("source")).cast("long").alias("n_sources"))
    names = [*fields, *rules.derived]
    wide = wide.select("entity", *[x for f in names for x in (F.col(f"_{f}.value").alias(f), F.col(f"_{f}.source").alias(f"{f}__source"))], "n_assertions", "n_sources")
    if keep_excluded or "existence_flag" not in fields:
        return wide
    return wide.where(~excluded())


def excluded() -> Column:
    return F.coalesce(F.col("existence_flag").isin(EXCLUDING_FLAGS) & F.col("existence_flag__source").isin(EXCLUDING_SOURCES), F.lit(False))


def conflicts(facts_: DataFrame, rules: Rules) -> DataFrame:
    """entity, field, winner, winner_source, n_values, values for fields of more than one value."""
    rows = ranked(facts_, rules)
    out = rows.groupBy("entity", "field").agg(F.max_by(F.struct("value", "source"), preference(F.col("rank"))).alias("w"), F.collect_set("value").alias("v")).where(F.size("v") > 1)
    return out.select("entity", "field", F.col("w.value").alias("winner"), F.col("w.source").alias("winner_source"), F.size("v").cast("long").alias("n_values"), F.left(F.array_join(F.sort_array("v"), " | "), F.lit(300)).alias("values"))


def coverage(golden_: DataFrame, fields: list[str]) -> DataFrame:
    """field, filled: how many rows have the field."""
    one = golden_.agg(*[F.count(F.nullif(F.trim(F.col(f).cast("string")), F.lit(""))).alias(f) for f in fields])
    return one.unpivot([], fields, "field", "filled")


def losses(before: DataFrame, after: DataFrame, allowed: dict[str, int]) -> DataFrame:
    """Fields that lost more rows than allowed between two coverages."""
    allow = F.create_map(*[F.lit(x) for kv in allowed.items() for x in kv]) if allowed else F.create_map().cast("map<string,int>")
    both = before.withColumnRenamed("filled", "before").join(after.withColumnRenamed("filled", "after"), "field", "full")
    both = both.select("field", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.withColumn("lost", F.col("before") - F.col("after")).where(F.col("lost") > F.coalesce(F.element_at(allow, F.col("field")), F.lit(0)))


def field_rows(rules: Rules, flags: list[str]) -> list[tuple[str, str | None]]:
    """(field, order as JSON) for every field of the rules; flags carry no order."""
    import json

    own = {f: json.dumps(o) for f, o in rules.fields.items()} | {f: json.dumps(d[1]) for f, d in rules.derived.items()}
    return [*own.items(), *[(f, None) for f in flags]]
