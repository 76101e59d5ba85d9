"""Clusters of rows about one entity, their attributes and tiers, and stable ids.

Rows carry `ord`, the order in which they were taken in: first-seen values, ties and ids depend on it and on
nothing else, so partitioning never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators.graph import keep

from factloom.functions.text import norm_name

# How sure each method is.
CONFIDENCE = {"entity+street": 0.95, "street_key": 0.90, "name+city": 0.70, "attached": 0.70, "no-fixed-plant": 0.60}
ADDRESSED = ["street_key", "entity+street"]


def signature(entity: Column, state: Column, city: Column, street: Column, name: Column, no_plant: Column) -> tuple[Column, Column]:
    """(signature, method) of a row, by the best key it has."""
    state, city = F.coalesce(state, F.lit("")), F.coalesce(city, F.lit(""))
    placed, known = F.coalesce(street, F.lit("")) != "", F.coalesce(entity, F.lit("")) != ""
    none = F.coalesce(no_plant, F.lit(False))
    sig = (
        F.when(none, F.concat(F.lit("NFP|"), norm_name(name)))
        .when(known & placed, F.concat_ws("|", state, F.lit("E"), entity, street))
        .when(placed, F.concat_ws("|", state, F.lit("S"), street))
        .otherwise(F.concat_ws("|", state, F.lit("N"), city, norm_name(name)))
    )
    return sig, F.when(none, "no-fixed-plant").when(known & placed, "entity+street").when(placed, "street_key").otherwise("name+city")


def first_members(rows: DataFrame) -> DataFrame:
    """One row a signature: method and the first member's state, city, street, name; first_ord."""
    first = F.min_by(F.struct("state", "city", "street_key", "name", "method"), F.col("ord"))
    out = rows.groupBy("sig").agg(first.alias("f"), F.min("ord").alias("first_ord"))
    return out.select("sig", "first_ord", "f.*", norm_name(F.col("f.name")).alias("norm"))


def _single(clusters: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """Keys that exactly one addressed cluster has, and that cluster."""
    a = clusters.where(F.col("method").isin(ADDRESSED)).select("sig", "norm", *[k.alias(n) for k, n in zip(keys, names, strict=True)])
    for n in names:
        a = a.where(F.coalesce(F.col(n), F.lit("")) != "")
    return a.groupBy(*names).agg(F.count("*").alias("n"), F.min("sig").alias("target"), F.min("norm").alias("target_norm")).where("n = 1").drop("n")


def attach(clusters: DataFrame) -> DataFrame:
    """(sig, target, how): name-only clusters that belong to exactly one addressed cluster.

    Three passes, each over what the one before left: same state, city and name; same state, city and first
    word (two shared words if the first is common); a distinctive name that is unique in the country, for rows
    without a place. Two possible targets give no match.
    """
    loose = clusters.where("method = 'name+city'")
    one = _single(clusters, [F.col("state"), F.col("city"), F.col("norm")], ["state", "city", "norm1"])
    first = loose.join(one, (loose["state"] == one["state"]) & (loose["city"] == one["city"]) & (loose["norm"] == one["norm1"])).select("sig", "target", F.lit("name+city").alias("how"))
    left = clusters.join(first, "sig", "left_anti")

    head = F.split_part(F.col("norm"), F.lit(" "), F.lit(1))
    words = left.select(F.explode(F.array_distinct(F.filter(F.split("norm", " "), lambda t: t != ""))).alias("head")).groupBy("head").agg(F.count("*").alias("df"))
    size = left.agg(F.greatest(F.lit(5), F.expr("count(*) div 100")).alias("common"))
    two = _single(left, [F.col("state"), F.col("city"), head], ["state", "city", "head"])
    loose = left.where("method = 'name+city'").select("sig", "state", "city", "norm", head.alias("head"))
    met = loose.where(F.length("head") >= 3).join(two, ["state", "city", "head"]).join(words, "head").join(F.broadcast(size))  # size is one row
    shared = F.size(F.array_intersect(F.split("norm", " "), F.split("target_norm", " ")))
    second = met.where((F.col("df") <= F.col("common")) | (shared >= 2)).select("sig", "target", F.lit("name-head+city").alias("how"))
    left = left.join(second, "sig", "left_anti")

    three = _single(left, [F.col("norm")], ["norm3"])
    loose = left.where("method = 'name+city' and coalesce(state, '') = '' and coalesce(city, '') = ''")
    loose = loose.where(F.col("norm").contains(" ") | (F.length("norm") >= 8))
    third = loose.join(three, loose["norm"] == three["norm3"]).select("sig", "target", F.lit("name-only").alias("how"))
    return first.unionByName(second).unionByName(third)


def clusters_of(rows: DataFrame) -> DataFrame:
    """The rows with their final signature (`cluster`) and match_method after attaching."""
    moved = attach(first_members(rows))
    out = rows.join(moved, "sig", "left")
    return out.withColumn("cluster", F.coalesce("target", "sig")).withColumn("match_method", F.when(F.col("target").isNotNull(), "attached").otherwise(F.col("method"))).drop("target")


def confidence(method: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), method)


def tier(placed: Column, site_visit: Column, sources: Column) -> Column:
    return F.when(~placed, "T0").when(site_visit & (sources >= 2), "T3").when(sources >= 2, "T2").otherwise("T1")


def entities(rows: DataFrame) -> DataFrame:
    """One row a cluster: name and place of the first member of its own signature, aliases, counts, tier."""
    own = F.struct((F.col("sig") != F.col("cluster")).cast("int"), "ord")
    agg = rows.groupBy("cluster").agg(
        F.min_by(F.struct("name", "state", "city", "street_key"), own).alias("f"),
        F.min(F.struct((F.col("sig") != F.col("cluster")).cast("int").alias("k"), "ord")).alias("first"),
        F.collect_set(F.trim("name")).alias("names"),
        F.count("*").alias("n_rows"),
        F.count_distinct("source").alias("n_sources"),
        F.bool_or(F.coalesce("street_key", F.lit("")) != "").alias("placed"),
        F.bool_or(F.col("site_visit")).alias("visited"),
    )
    aliases = F.array_join(F.sort_array(F.filter("names", lambda x: (x != "") & (x != F.trim("f.name")))), " | ")
    return agg.select("cluster", "first.ord", "f.*", aliases.alias("aliases"), "n_rows", "n_sources", tier(F.col("placed"), F.col("visited"), F.col("n_sources")).alias("tier"))


def numbered(df: DataFrame, order: str, out: str = "no", buckets: int = 1024) -> DataFrame:
    """Adds 0, 1, 2, … in the order of a whole-number column without ordering the table in one task.

    Rows are counted in buckets of equal width, a table of `buckets` rows gives each its offset, and rows are
    ranked within their bucket.
    """
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return df.withColumn(out, F.lit(0).cast("bigint"))
    width = max(1, (high - low) // buckets + 1)
    df = df.withColumn("_b", F.expr(f"cast(({order} - {low}) div {width} as int)"))
    counts = df.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_o"))
    here = F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1
    return df.withColumn("_h", here).join(F.broadcast(offsets), "_b").withColumn(out, F.col("_o") + F.col("_h")).drop("_b", "_o", "_h")  # at most `buckets` rows


def issue_ids(entities_: DataFrame, registry: DataFrame, next_no: int, prefix: str = "FL-") -> DataFrame:
    """entity_id for every cluster: the registry's where it knows the signature, else the next in order of `ord`.

    registry: (cluster, entity_id). Nothing is renumbered; the same call on its own result issues none. Numbers have
    five digits or more. The clusters are written once, as counting and numbering read them again.
    """
    known = keep(entities_.join(registry, "cluster", "left"), "known")
    old, new = known.where("entity_id is not null"), known.where("entity_id is null").drop("entity_id")
    new = numbered(new, "ord", "_no").withColumn("entity_id", F.format_string(f"{prefix}%05d", F.col("_no") + next_no)).drop("_no")
    return old.withColumn("issued", F.lit(False)).unionByName(new.withColumn("issued", F.lit(True)))


def lookup_ids(clusters: DataFrame, registry: DataFrame) -> DataFrame:
    """(cluster, entity_id, how): known by its signature, else attached to the one live id its other keys name.

    clusters: (cluster, alts array<string>); registry: (cluster, entity_id, live).
    """
    direct = clusters.join(registry.select("cluster", "entity_id"), "cluster", "left")
    open_ = direct.where("entity_id is null").select("cluster", F.explode("alts").alias("alt"))
    live = registry.where("live").select(F.col("cluster").alias("alt"), F.col("entity_id").alias("found"))
    alt = open_.join(live, "alt").groupBy("cluster").agg(F.count_distinct("found").alias("n"), F.min("found").alias("found"))
    out = direct.join(alt, "cluster", "left")
    how = F.when(F.col("entity_id").isNotNull(), "known").when(F.col("n") == 1, "attached").when(F.col("n") > 1, "ambiguous").otherwise("new")
    return out.select("cluster", F.coalesce("entity_id", F.when(F.col("n") == 1, F.col("found"))).alias("entity_id"), how.alias("how"))
