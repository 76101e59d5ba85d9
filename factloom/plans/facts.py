"""Facts, survivorship, provenance, releases and refresh over orders as facts about customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import hashed
from factloom.operators import incremental, survivorship, tables
from factloom.operators.survivorship import Rules
from factloom.plans.registry import query, table

RULES = Rules(["class:1", "class:2", "class:3", "class:4", "class:5"], {"status": ["class:1", "class:3", "class:2"], "priority": ["class:1", "class:2"]}, {"value": (["total", "lines"], ["class:2", "class:1"], 1000, 400000)})
FIELDS = ["status", "priority"]


def order_rows(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    cls = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("ord"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total"),
        cls.alias("source_class"), F.concat(F.lit("list"), cls).alias("source"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("retrieved"),
    )


def order_facts(spark, sf, rows: DataFrame | None = None) -> DataFrame:
    rows = order_rows(spark, sf) if rows is None else rows
    ids = ["entity", "ord", "source_class", "source", "retrieved"]
    long = survivorship.unpivot(rows, ids, {"status": "status", "priority": "priority"})
    return survivorship.facts(long, row_hash=hashed(F.col("entity"), F.col("field"), F.col("ord")))


_FACTS = """
with rows as (
  select o_custkey as entity, o_orderkey as ord, o_orderstatus as status, o_orderpriority as priority, o_totalprice as total,
    substr(o_orderpriority, 1, 1) as class, 'list' || substr(o_orderpriority, 1, 1) as source, strftime(o_orderdate, '%Y-%m-%d') as retrieved
  from orders
), facts as (
  select entity, ord, class, source, retrieved, 'status' as field, status as value,
    case class when '1' then 0 when '3' then 1 when '2' then 2 else 3 end as rank from rows where trim(status) <> ''
  union all
  select entity, ord, class, source, retrieved, 'priority', priority, case class when '1' then 0 when '2' then 1 else 2 end from rows where trim(priority) <> ''
), won as (
  select *, row_number() over (partition by entity, field order by rank, retrieved desc, ord) as no from facts
)"""
_GOLDEN = (
    _FACTS
    + """, golden as (
  select f.entity, max(s.value) as status, max(s.source) as status__source, max(p.value) as priority, max(p.source) as priority__source,
    count(*) as n_assertions, count(distinct f.source) as n_sources
  from facts f
  left join won s on s.entity = f.entity and s.field = 'status' and s.no = 1
  left join won p on p.entity = f.entity and p.field = 'priority' and p.no = 1
  group by f.entity
)"""
)


@query("golden_survivorship", _GOLDEN + " select * from golden")
def golden_survivorship(spark, sf):
    return survivorship.golden(order_facts(spark, sf), Rules(RULES.default, RULES.fields), FIELDS)


@query("golden_conflicts", _FACTS + """ select w.entity, w.field, w.value as winner, w.source as winner_source, c.n_values, left(c.vals, 300) as "values"
  from won w join (select entity, field, count(distinct value) as n_values, string_agg(distinct value, ' | ' order by value) as vals from facts group by all having count(distinct value) > 1) c
  on c.entity = w.entity and c.field = w.field where w.no = 1""")
def golden_conflicts(spark, sf):
    return survivorship.conflicts(order_facts(spark, sf), RULES)


def _numbers(spark, sf) -> DataFrame:
    """Totals as printed, with a thousands separator and a currency, and what the lines sum to."""
    rows = order_rows(spark, sf)
    printed = F.concat(F.lit("USD "), F.format_string("%,.2f", "total"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("ord")).agg(F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), 2).cast("string").alias("lines"))
    both = rows.withColumn("total", printed).join(lines, "ord", "left")
    return survivorship.facts(survivorship.unpivot(both, ["entity", "ord", "source_class", "source", "retrieved"], {"total": "total", "lines": "lines"}))


@query("golden_derived", """
with facts as (
  select o_custkey as entity, o_orderkey as ord, substr(o_orderpriority, 1, 1) as class, strftime(o_orderdate, '%Y-%m-%d') as retrieved, 'total' as field, o_totalprice as n from orders
  union all
  select o_custkey, o_orderkey, substr(o_orderpriority, 1, 1), strftime(o_orderdate, '%Y-%m-%d'), 'lines', s from orders join (select l_orderkey, sum(l_extendedprice::decimal(18,2))::double as s from lineitem group by 1) on l_orderkey = o_orderkey
), good as (
  select *, round_even(n, 0)::bigint::varchar as value, 'list' || class as source, row_number() over (partition by entity order by case class when '2' then 0 when '1' then 1 else 2 end, retrieved desc, ord, field) as no
  from facts where n between 1000 and 400000
)
select c.entity, g.value, g.source as value__source, c.n_assertions, c.n_sources
from (select entity, count(*) as n_assertions, count(distinct class) as n_sources from facts group by 1) c left join good g on g.entity = c.entity and g.no = 1""")
def golden_derived(spark, sf):
    facts = _numbers(spark, sf)
    # Two facts of one order tie: the field's name decides, as input order does.
    facts = facts.withColumn("ord", F.col("ord") * 2 + (F.col("field") == "total").cast("int"))
    return survivorship.golden(facts, Rules(RULES.default, {}, RULES.derived), [])


def _flagged(spark, sf):
    flags = order_rows(spark, sf).where("ord % 40 = 0").select("entity", "ord", F.lit("web_research").alias("source"), F.lit("web").alias("source_class"), "retrieved", F.lit("existence_flag").alias("field"), F.when(F.col("status") == "F", "closed").otherwise("active").alias("value"), F.lit("web_verdict").alias("basis"))
    human = order_rows(spark, sf).where("ord % 90 = 0").select("entity", "ord", F.lit("operator").alias("source"), F.lit("operator").alias("source_class"), "retrieved", F.lit("existence_flag").alias("field"), F.lit("active").alias("value"), F.lit("operator").alias("basis"))
    return order_facts(spark, sf).unionByName(survivorship.facts(flags)).unionByName(survivorship.facts(human))


@query("golden_excluded", _FACTS + """, flags as (
  select entity, ord, retrieved, 2 as rank, case when status = 'F' then 'closed' else 'active' end as flag, 'web_research' as source from rows where ord % 40 = 0
  union all select entity, ord, retrieved, 1, 'active', 'operator' from rows where ord % 90 = 0
), flag as (select *, row_number() over (partition by entity order by rank, retrieved desc, ord) as no from flags),
gone as (select entity from flag where no = 1 and flag = 'closed')
select f.entity, max(s.value) as status, max(s.source) as status__source, max(g.flag) as existence_flag, max(g.source) as existence_flag__source,
  count(distinct (f.field, f.ord)) + any_value(coalesce(k.n, 0)) as n_assertions, count(distinct f.source) + any_value(coalesce(k.m, 0)) as n_sources
from facts f left join won s on s.entity = f.entity and s.field = 'status' and s.no = 1
left join flag g on g.entity = f.entity and g.no = 1
left join (select entity, count(*) as n, count(distinct source) as m from flags group by 1) k on k.entity = f.entity
where f.entity not in (select entity from gone) group by f.entity""")
def golden_excluded(spark, sf):
    rules = Rules(RULES.default, RULES.fields | {"existence_flag": ["employee_feedback", "operator", "basis:web_verdict", "basis:advisory"]})
    return survivorship.golden(_flagged(spark, sf), rules, ["status", "existence_flag"])


@query("rulings_unapplied", _FACTS + """, flags as (
  select entity, ord, retrieved, case when status = 'F' then 'closed' else 'active' end as flag from rows where ord % 40 = 0
), latest as (select entity, flag, row_number() over (partition by entity order by retrieved desc, ord desc) as no from flags)
select l.entity, flag from latest l where no = 1 and flag = 'closed' and l.entity not in (select entity from rows where ord % 90 = 0)""")
def rulings_unapplied(spark, sf):
    """Latest ruling of each entity (ties: the later row) that excludes it and that no person has overridden."""
    facts = _flagged(spark, sf)
    rulings = tables.latest(facts.where("field = 'existence_flag' and source = 'web_research'"), ["entity"], F.desc("retrieved"), F.desc("ord"))
    human = facts.where("field = 'existence_flag' and source = 'operator'").select("entity")
    return rulings.where(F.col("value").isin(survivorship.EXCLUDING_FLAGS)).join(human, "entity", "left_anti").select("entity", F.col("value").alias("flag"))


@query("coverage_losses", _GOLDEN + """, two as (select * from golden where status__source in ('list1', 'list2'))
select * from (
  select 'status' as field, (select count(status) from golden) as before, (select count(status) from two) as after
  union all select 'priority', (select count(priority) from golden), (select count(priority) from two where priority__source <> 'list2')
) c, (select 0) where before > after""".replace("c, (select 0) where before > after", "where before > after").replace("select * from (", "select field, before, after, before - after as lost from ("))
def coverage_losses(spark, sf):
    before = golden_survivorship(spark, sf)
    after = before.where(F.col("status__source").isin("list1", "list2"))
    after = after.withColumn("priority", F.when(F.col("priority__source") != "list2", F.col("priority")))
    return survivorship.losses(survivorship.coverage(before, FIELDS), survivorship.coverage(after, FIELDS), {"status": 0})


@query("golden_unpivot", _GOLDEN + """
select entity, 'status' as field, status as value, status__source as source from golden where status is not null
union all select entity, 'priority', priority, priority__source from golden where priority is not null""")
def golden_unpivot(spark, sf):
    g = golden_survivorship(spark, sf)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.col(f"{f}__source").alias("source")) for f in FIELDS]))
    return g.select("entity", pairs.alias("p")).select("entity", "p.*").where("value is not null")


@query("provenance_view", _GOLDEN + """, long as (
  select entity, 'status' as field, status as value, status__source as source from golden union all select entity, 'priority', priority, priority__source from golden
)
select l.entity, l.field, l.value, l.source, count(f.ord) as n_facts, min(f.retrieved) as first_retrieved, max(o.o_totalprice) as most_total
from long l left join facts f on f.entity = l.entity and f.field = l.field and f.value = l.value and f.source = l.source
left join orders o on o.o_orderkey = f.ord group by all""")
def provenance_view(spark, sf):
    """Every golden value with the facts that state it and the rows these came from."""
    facts = order_facts(spark, sf).select("entity", "field", "value", "source", "ord", "retrieved")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), "o_totalprice")
    out = golden_unpivot(spark, sf).join(facts, ["entity", "field", "value", "source"], "left").join(o, "ord", "left")
    return out.groupBy("entity", "field", "value", "source").agg(F.count("ord").alias("n_facts"), F.min("retrieved").alias("first_retrieved"), F.max("o_totalprice").alias("most_total"))


@query("assertions_resolved", """
with registry as (select c_custkey as id, case when c_custkey % 7 = 0 then 'R' || (c_custkey % 100) end as permanent from customer where c_custkey % 7 < 5),
legacy as (select c_custkey as id, 'L' || (c_custkey % 50) as permanent from customer where c_custkey % 2 = 0),
merged as (select 'L' || i as permanent, 'L' || (i + 10) as into_id from range(0, 40, 4) t(i))
select o_orderkey, coalesce(m.into_id, r.permanent, l.permanent) as permanent,
  case when r.permanent is not null then 'registry' when l.permanent is not null then 'legacy' else 'unresolved' end as how
from orders o left join registry r on r.id = o.o_custkey left join legacy l on l.id = o.o_custkey and r.id is null
left join merged m on m.permanent = coalesce(r.permanent, l.permanent)""")
def assertions_resolved(spark, sf):
    """Facts to permanent ids by two paths, the second only for those the first does not know, then one merge hop."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    registry = c.where("id % 7 < 5").select(F.col("id").alias("rid"), F.when(F.col("id") % 7 == 0, F.concat(F.lit("R"), F.col("id") % 100)).alias("rp"))
    legacy = c.where("id % 2 = 0").select(F.col("id").alias("lid"), F.concat(F.lit("L"), F.col("id") % 50).alias("lp"))
    merged = spark.range(0, 40, 4).select(F.concat(F.lit("L"), F.col("id")).alias("mp"), F.concat(F.lit("L"), F.col("id") + 10).alias("into_id"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = o.join(registry, F.col("rid") == F.col("o_custkey"), "left").join(legacy, (F.col("lid") == F.col("o_custkey")) & F.col("rid").isNull(), "left")
    out = out.join(merged, F.col("mp") == F.coalesce("rp", "lp"), "left")
    how = F.when(F.col("rp").isNotNull(), "registry").when(F.col("lp").isNotNull(), "legacy").otherwise("unresolved")
    return out.select("o_orderkey", F.coalesce("into_id", "rp", "lp").alias("permanent"), how.alias("how"))


def _release(spark, sf, year_to: int) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return o.where(F.col("year") <= year_to).select("o_orderkey", "o_custkey", "o_orderstatus", "year")


@query("append_if_absent", "select o_orderkey, o_custkey, o_orderstatus, year(o_orderdate)::int as year, year(o_orderdate) = 1998 as fresh from orders where year(o_orderdate) <= 1998")
def append_if_absent(spark, sf):
    old, new = _release(spark, sf, 1997), _release(spark, sf, 1998)
    fresh, table_ = tables.append_if_absent(old, new.unionByName(new), ["o_orderkey"])
    return table_.join(fresh.select("o_orderkey", F.lit(True).alias("fresh")), "o_orderkey", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))


def _customers_of(spark, sf, year: int) -> DataFrame:
    o = table(spark, sf, "orders").where(F.year("o_orderdate") == year)
    return o.groupBy(F.col("o_custkey").alias("id")).agg(F.lit(year).alias("first_seen"), F.round(F.max("o_totalprice"), 2).alias("most"), F.lit(year).alias("last_seen"))


@query("upsert_first_seen", """
select o_custkey as id, min(year(o_orderdate))::int as first_seen, max_by(most, yr) as most, max(yr)::int as last_seen
from (select o_custkey, o_orderdate, year(o_orderdate) as yr, max(o_totalprice) over (partition by o_custkey, year(o_orderdate)) as most from orders where year(o_orderdate) in (1996, 1997)) group by 1""")
def upsert_first_seen(spark, sf):
    return tables.upsert(_customers_of(spark, sf, 1996), _customers_of(spark, sf, 1997), ["id"], keep=["first_seen"])


@query("guarded_upsert", """
with a as (select o_custkey as id, max(o_totalprice) as most from orders where year(o_orderdate) = 1996 group by 1),
b as (select o_custkey as id, max(o_totalprice) as most from orders where year(o_orderdate) = 1997 group by 1)
select coalesce(a.id, b.id) as id, case when b.id is not null and (a.id is null or a.most < 300000) then 1997 else 1996 end as first_seen,
  case when b.id is not null and (a.id is null or a.most < 300000) then b.most else a.most end as most,
  case when b.id is not null and (a.id is null or a.most < 300000) then 1997 else 1996 end as last_seen from a full join b on a.id = b.id""")
def guarded_upsert(spark, sf):
    return tables.guarded_upsert(_customers_of(spark, sf, 1996), _customers_of(spark, sf, 1997), ["id"], F.col("a.most") < 300000)


@query("partition_replace", "select o_orderkey, o_custkey, case when year(o_orderdate) = 1997 then 'X' else o_orderstatus end as o_orderstatus, year(o_orderdate)::int as year from orders where year(o_orderdate) <= 1998 and not (year(o_orderdate) = 1997 and o_orderkey % 2 = 0)")
def partition_replace(spark, sf):
    old = _release(spark, sf, 1998)
    new = old.where("year = 1997 and o_orderkey % 2 = 1").withColumn("o_orderstatus", F.lit("X"))
    return tables.replace_parts(old, new, "year").select("o_orderkey", "o_custkey", "o_orderstatus", "year")


@query("delete_by_keys", "select o_orderkey, o_custkey, o_orderstatus, year(o_orderdate)::int as year from orders where year(o_orderdate) <= 1998 and o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def delete_by_keys(spark, sf):
    gone = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return tables.delete_keys(_release(spark, sf, 1998), gone, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_orderstatus", "year")


@query("last_writer", "select event_id, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as no from events) where no = 1")
def last_writer(spark, sf):
    e = table(spark, sf, "events")
    return tables.latest(e, ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("event_id", "user_id", "event_type", "value")


@query("field_changes", """
with a as (select o_custkey as id, max(o_totalprice) as most, min(o_orderstatus) as status from orders where o_orderkey % 3 <> 0 group by 1),
b as (select o_custkey as id, max(o_totalprice) as most, min(o_orderstatus) as status from orders where o_orderkey % 3 <> 1 group by 1),
j as (select a.id as ai, b.id as bi, a.most as am, b.most as bm, a.status as sa, b.status as sb from a full join b on a.id = b.id)
select 'most' as field, count(*) filter (ai is null) as added, count(*) filter (bi is null) as removed, count(*) filter (am <> bm) as changed from j
union all select 'status', count(*) filter (ai is null), count(*) filter (bi is null), count(*) filter (sa <> sb) from j""")
def field_changes(spark, sf):
    o = table(spark, sf, "orders")

    def side(rest):
        g = o.where(F.col("o_orderkey") % 3 != rest).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("most"), F.min("o_orderstatus").alias("status"))
        return tables.fingerprint(g, ["id"], ["most", "status"])

    return tables.changes(side(0), side(1), ["id"])


@query("snapshot_json", """select c_custkey, '{"c_acctbal":' || c_acctbal::varchar || ',"c_mktsegment":"' || c_mktsegment || '"}' as row_json from customer where c_acctbal >= 1000 and c_acctbal < 9000""")
def snapshot_json(spark, sf):
    c = table(spark, sf, "customer").where("c_acctbal >= 1000 and c_acctbal < 9000")
    return c.select("c_custkey", F.to_json(F.struct("c_acctbal", "c_mktsegment")).alias("row_json"))


@query("human_carry_forward", _FACTS + """, human as (select c_custkey as entity, 'HOLD' as value from customer where c_custkey % 10 = 0)
select e.entity, coalesce(h.value, w.value) as status, case when h.value is not null then 'operator' else w.source end as status__source, e.n + (case when h.value is null then 0 else 1 end) as n_assertions,
  e.m + (case when h.value is null then 0 else 1 end) as n_sources
from (select entity, count(*) as n, count(distinct source) as m from facts where field = 'status' group by 1 union all select entity, 0, 0 from human where entity not in (select entity from facts)) e
left join human h on h.entity = e.entity left join won w on w.entity = e.entity and w.field = 'status' and w.no = 1""")
def human_carry_forward(spark, sf):
    """People's facts join every rebuild and keep rows that no list has."""
    human = table(spark, sf, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("entity"), F.lit("status").alias("field"), F.lit("HOLD").alias("value"), F.lit("operator").alias("source"), F.lit("operator").alias("source_class"), F.lit("").alias("retrieved"), F.lit(0).cast("long").alias("ord"))
    facts = order_facts(spark, sf).where("field = 'status'").unionByName(survivorship.facts(human))
    return survivorship.golden(facts, Rules(RULES.default, {"status": ["employee_feedback", "operator", *RULES.fields["status"]]}), ["status"])


@query("dirty_queue", "select distinct o_custkey as entity from orders where year(o_orderdate) = 1998")
def dirty_queue(spark, sf):
    rows = order_rows(spark, sf).where(F.col("retrieved").startswith("1998"))
    return incremental.dirty(order_facts(spark, sf, rows))


@query("incremental_refresh", _GOLDEN + " select * from golden")
def incremental_refresh(spark, sf):
    """Golden of all years before 1998 and then of each later year's queue alone; equals a full rebuild."""
    rules = Rules(RULES.default, RULES.fields)
    rows, years = order_rows(spark, sf), ["1998", "1999", "2000", "2001"]
    facts = order_facts(spark, sf, rows.where(F.substring("retrieved", 1, 4) < "1998"))
    out = survivorship.golden(facts, rules, FIELDS)
    for y in years:
        new = order_facts(spark, sf, rows.where(F.substring("retrieved", 1, 4) == y))
        facts = facts.unionByName(new)
        out, _ = incremental.refresh(out, facts, new, rules, FIELDS)
    return out


@query("admissible_only", _FACTS + """, good as (select *, row_number() over (partition by entity, field order by rank, retrieved desc, ord) as n2 from facts where retrieved >= '1997-01-01')
select entity, max(value) filter (field = 'status' and n2 = 1) as status, max(source) filter (field = 'status' and n2 = 1) as status__source,
  max(value) filter (field = 'priority' and n2 = 1) as priority, max(source) filter (field = 'priority' and n2 = 1) as priority__source, count(*) as n_assertions, count(distinct source) as n_sources from good group by 1""")
def admissible_only(spark, sf):
    return incremental.settled(order_facts(spark, sf), Rules(RULES.default, RULES.fields), FIELDS, F.col("retrieved") >= "1997-01-01")


@query("dim_field", """select * from (values ('status', '["class:1", "class:3", "class:2"]'), ('priority', '["class:1", "class:2"]'), ('value', '["class:2", "class:1"]'), ('quality_flag', null)) t(field, order_json)""")
def dim_field(spark, sf):
    return spark.createDataFrame(survivorship.field_rows(RULES, ["quality_flag"]), "field string, order_json string")


@query("submitted_facts", """
with e as (select event_id, user_id, event_type, json_extract(props, '$.k')::bigint as k from events)
select event_id as id, 'e' || user_id as entity, event_type as field, k::varchar as value, 'https://x.example/' || (event_id % 5) as url,
  case when event_id % 3 = 0 then 'registry_page' when event_id % 3 = 1 then 'company_site' else 'directory' end as kind,
  case when event_id % 3 = 0 then 'web_verified' when event_id % 3 = 1 then 'web_primary' else 'web_cited' end as basis,
  case when event_id % 5 = 4 then 'page not fetched' when event_id % 4 = 3 then 'quote not on the page' when event_id % 4 = 2 then 'quote does not state the value' end as rejected
from e where event_id % 6 <> 5""".replace("when event_id % 4 = 2 then 'quote does not state the value'", "when event_id % 4 = 2 and instr('the page says so', k::varchar) = 0 then 'quote does not state the value' when event_id % 4 < 2 and k > 99 then 'quote not on the page'"))
def submitted_facts(spark, sf):
    """Payloads parsed, each assertion checked against the page it cites."""
    from factloom.operators import documents

    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    quote = F.when(F.col("event_id") % 4 == 3, F.lit("nowhere on the page")).when(F.col("event_id") % 4 == 2, F.lit("the page says so")).otherwise(F.concat(F.lit("value "), F.col("k"), F.lit(" stated")))
    kind = F.element_at(F.array(F.lit("registry_page"), F.lit("company_site"), F.lit("directory")), (F.col("event_id") % 3 + 1).cast("int"))
    source = F.struct(F.lit("s1").alias("source_ref"), F.concat(F.lit("https://x.example/"), F.col("event_id") % 5).alias("url"), kind.alias("kind"))
    fact = F.struct(F.col("event_type").alias("field"), F.col("k").cast("string").alias("value"), F.lit("s1").alias("source_ref"), quote.alias("quote"), F.lit(0.9).alias("confidence"))
    payload = F.to_json(F.struct(F.concat(F.lit("e"), F.col("user_id")).alias("entity"), F.lit("a").alias("agent"), F.array(source).alias("sources"), F.array(fact).alias("assertions")))
    rows = e.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 6 == 5, F.lit("{broken")).otherwise(payload).alias("payload"))
    text = F.concat(F.lit("the page says so. "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("value "), i, F.lit(" stated"))), "; "))
    pages = spark.range(4).select(F.concat(F.lit("https://x.example/"), F.col("id")).alias("url"), text.alias("text"))
    return documents.cited_facts(documents.submissions(rows, "payload"), "id", pages)
