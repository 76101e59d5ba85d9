"""Name tiers, place and donor matches, salvage, verdicts and evaluation over made-up rows of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.text import norm_name
from factloom.operators import matching, research
from factloom.operators.graph import keep
from factloom.plans.registry import query, table


def firms(spark, sf):
    """Suppliers as firms at a few addresses, under several spellings."""
    k = F.col("s_suppkey")
    kinds = ["Acme {0} Homes, Inc.", "ACME {0} HOMES - Plant 2", "Beta Steel d/b/a Acme {0} Homes", "Gamma {0} Works", "Homes & Steel LLC"]
    name = F.element_at(F.array(*[F.concat_ws(" ", F.lit(n.split("{0}")[0].strip()), (F.expr("s_suppkey div 10") % 6).cast("string") if "{0}" in n else F.lit(None), F.lit(n.split("{0}")[-1].strip()) if "{0}" in n else F.lit(None)) for n in kinds]), (k % 5 + 1).cast("int"))
    street = F.element_at(F.array(*map(F.lit, ["Main Street", "Main St", "Oak Ave"])), (k % 3 + 1).cast("int"))
    return table(spark, sf, "supplier").select(
        k.alias("id"), name.alias("name"), F.concat(F.expr("s_suppkey div 10") % 6 + 1, F.lit(" "), street).alias("address"), F.when(k % 2 == 0, "St. Louis").otherwise("Saint Louis").alias("city"), F.lit("MO").alias("state"),
        F.when(k % 4 == 0, "(314) 555-0100").otherwise("").alias("phone"), F.when(k % 7 == 0, "www.acme.com").otherwise("").alias("website"), F.col("s_acctbal").cast("long").alias("weight"),
    )


_FIRMS = """firms as (select s_suppkey as id, case s_suppkey % 5 when 0 then 'Acme ' || n || ' Homes, Inc.' when 1 then 'ACME ' || n || ' HOMES - Plant 2' when 2 then 'Beta Steel d/b/a Acme ' || n || ' Homes' when 3 then 'Gamma ' || n || ' Works' else 'Homes & Steel LLC' end as name from (select *, (s_suppkey // 10) % 6 as n from supplier))"""


@query("name_variants", "with " + _FIRMS + r""", sides as (select id, unnest(regexp_split_to_array(replace(lower(name), '&', ' and '), '\bd/b/a\b')) as side from firms),
words as (select id, list_filter(string_split(trim(regexp_replace(regexp_replace(side, '\s[-–—|]\s.*$', ''), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w not in ('inc', 'llc', 'the', 'co', 'company')) as w from sides),
named as (select id, regexp_replace(array_to_string(w, ' '), '(?:(?:^| )(?:plant|number|[0-9]+))+$', '') as v from words)
select id, list_sort(list_distinct(list(v))) as variants from named where v <> '' group by id""")
def name_variants(spark, sf):
    return firms(spark, sf).select("id", research.name_variants(F.col("name")).alias("variants"))


@query("parcel_duplicates")
def parcel_duplicates(spark, sf):
    rows = firms(spark, sf)
    return research.of_kinds(rows, research.parcel_kinds(rows)).select("a", "b", "street", "tier")


@query("duplicate_survivors")
def duplicate_survivors(spark, sf):
    rows, tiers = firms(spark, sf), ["certain", "likely", "review"]
    kinds = keep(research.parcel_kinds(rows).select("a_kind", "b_kind", F.split_part("tier", F.lit(":"), F.lit(1)).alias("tier")), "kinds")
    return research.survivors_by_tier(research.kind_links(rows, kinds, tiers), rows.select("id", "weight"), tiers, "weight")


_AT = """
with e as (select c_custkey as id, (c_custkey % 400) as no, case c_custkey % 3 when 0 then 'OAK' when 1 then 'ELM' else 'PINE HILL' end as street, c_nationkey % 5 as city, c_nationkey % 3 as state, c_custkey % 97 as zip from customer),
q as (select s_suppkey as place_id, (s_suppkey % 400) as no, case s_suppkey % 3 when 0 then 'OAK' when 1 then 'ELM' else 'PINE HILL' end as street, s_nationkey % 5 as city, s_nationkey % 3 as state, s_suppkey % 97 as zip from supplier),
m as (select e.id, q.place_id, case when e.city = q.city then 0 else 1 end as how from e join q on e.no = q.no and e.street = q.street and e.state = q.state and (e.city = q.city or e.zip = q.zip))"""


@query("place_match", _AT + """, f as (select * from m where how = 0 or id not in (select id from m where how = 0))
select id, min(place_id) as place_id, case how when 0 then 'city' else 'zip' end as how from f group by id, f.how having count(distinct place_id) = 1""")
def place_match(spark, sf):
    def rows(t, key, nation, name):
        k = F.col(key)
        street = F.element_at(F.array(F.lit("Oak Street"), F.lit("Elm Rd"), F.lit("Pine Hill Drive")), (k % 3 + 1).cast("int"))
        return table(spark, sf, t).select(k.alias(name), F.concat(k % 400, F.lit(" "), street).alias("address"), F.concat(F.lit("City "), F.col(nation) % 5).alias("city"), F.concat(F.lit("s"), F.col(nation) % 3).alias("state"), F.lpad((k % 97).cast("string"), 5, "0").alias("zip"))

    return research.place_match(rows("customer", "c_custkey", "c_nationkey", "id"), rows("supplier", "s_suppkey", "s_nationkey", "place_id"))


@query("donor_points", """
with t as (select c_custkey as id, c_custkey % 120 as k1, c_nationkey as k2 from customer),
g as (select s_suppkey % 120 as k1, s_nationkey as k2, 'p' || (s_suppkey % 60) as point from supplier),
a as (select t.id, count(distinct point) as n, min(point) as point from t join g using (k1, k2) group by 1),
b as (select t.id, count(distinct point) as n, min(point) as point from t join g using (k1) where t.id not in (select id from a) group by 1)
select id, point, 'name and place' as how from a where n = 1 union all select id, point, 'name' from b where n = 1""")
def donor_points(spark, sf):
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 120).cast("string").alias("k1"), F.col("c_nationkey").cast("string").alias("k2"))
    g = table(spark, sf, "supplier").select((F.col("s_suppkey") % 120).cast("string").alias("k1"), F.col("s_nationkey").cast("string").alias("k2"), F.concat(F.lit("p"), F.col("s_suppkey") % 60).alias("point"))
    return research.donors(t, g, [("name and place", [F.col("k1"), F.col("k2")]), ("name", [F.col("k1")])])


@query("look_alikes", """
select p.p_partkey as id, g.p_partkey as entity, 'name' as why from part p join part g on p.p_name = g.p_name and p.p_partkey % 2 = 0 and g.p_partkey % 2 = 1 and p.p_size % 3 = g.p_size % 3
union select p.p_partkey, g.p_partkey, 'address' from part p join part g on p.p_brand = g.p_brand and p.p_type = g.p_type and p.p_partkey % 2 = 0 and g.p_partkey % 2 = 1 and p.p_size % 3 = g.p_size % 3""")
def look_alikes(spark, sf):
    state = F.element_at(F.array(F.lit("tx"), F.lit("New York"), F.lit("CA")), (F.col("p_size") % 3 + 1).cast("int"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat(F.initcap("p_name"), F.lit(", Inc.")).alias("name"), state.alias("state"), F.col("p_brand").alias("address"), F.col("p_type").alias("city"))
    return research.look_alikes(p.where("id % 2 = 0"), p.where("id % 2 = 1").withColumnRenamed("id", "entity"))


@query("source_holders", """
with n as (select distinct p_name as name from part where p_partkey % 4 = 0), i as (select distinct 's' || (p_partkey % 6) as source, case when p_partkey % 3 = 0 then p_name || ' works' else p_name end as name from part where p_partkey % 4 <> 0)
select n.name, string_agg(distinct i.source, ',' order by i.source) as sources from n left join i on i.name = n.name or starts_with(i.name, n.name || ' ') group by 1""")
def source_holders(spark, sf):
    p = table(spark, sf, "part")
    names = p.where("p_partkey % 4 = 0").select(F.col("p_name").alias("name"))
    ingested = p.where("p_partkey % 4 <> 0").select(F.concat(F.lit("s"), F.col("p_partkey") % 6).alias("source"), F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" Works"))).otherwise(F.upper("p_name")).alias("name"))
    return research.holders(names, ingested)


@query("recall_rungs")
def recall_rungs(spark, sf):
    """Even rows as control to odd ones as entities, rung by rung, each entity once."""
    p = table(spark, sf, "part").withColumn("state", F.when(F.col("p_partkey") % 5 > 0, F.col("p_brand")))
    control = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("control"), F.col("p_name").alias("name"), F.col("p_type").alias("city"), "state")
    entities = p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("entity"), F.concat(F.initcap("p_name"), F.when(F.col("p_partkey") % 3 == 0, " Works").otherwise(" Co.")).alias("name"), F.col("p_type").alias("city"), "state")
    return research.recall_assigned(control, entities)


@query("json_salvage")
def json_salvage(spark, sf):
    e = table(spark, sf, "events")
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here: ["), "props", F.lit(", {label: 'IC', i: 1}]"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    return e.select("event_id", research.json_objects(body).alias("objects"))


@query("canonical_labels", "select event_id, case event_id % 5 when 0 then 'IC' when 1 then 'NOT-IC' when 2 then 'NOT-IC' when 3 then 'UNCERTAIN' else 'UNCERTAIN' end as label from events")
def canonical_labels(spark, sf):
    raw = F.element_at(F.array(F.lit(" ic "), F.lit("not ic"), F.lit("NOT_IC"), F.lit("maybe"), F.lit(None).cast("string")), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", research.canonical_label(raw).alias("label"))


@query("signal_guess", """
with s as (select * from (values ('parts', 'widget'), ('parts', 'red'), ('drives', 'gear'), ('metal', 'rod'), ('metal', 'bolt'), ('cold', 'cold')) t(leaf, signal)),
h as (select p_partkey, leaf, count(*) as hits, max(length(signal)) as longest from part join s on contains(p_name, signal) group by 1, 2)
select p_partkey, leaf, hits from (select *, row_number() over (partition by p_partkey order by hits desc, longest desc, leaf desc) as no from h) where no = 1""")
def signal_guess(spark, sf):
    signals = [("parts", "widget"), ("parts", "red"), ("drives", "gear"), ("metal", "rod"), ("metal", "bolt"), ("cold", "cold")]
    return research.best_signal(table(spark, sf, "part"), "p_partkey", "p_name", signals)


@query("name_anchors", """
with r as (select c_custkey // 25 as batch, c_custkey % 25 as i, c_custkey as row, c_mktsegment || (c_custkey % 7) as name from customer),
a as (select batch, i, case when i % 4 = 3 then lag(name) over (partition by batch order by i) when i % 10 = 8 then 'nobody' else name end as name from r),
one as (select batch, name, min(row) as row from r group by 1, 2 having count(*) = 1)
select a.batch, a.i, case when r.name = a.name then r.row else o.row end as row, case when r.name = a.name then 'index' when o.row is not null then 'name' else 'dropped' end as how
from a join r on r.batch = a.batch and r.i = a.i left join one o on o.batch = a.batch and o.name = a.name""")
def name_anchors(spark, sf):
    from pyspark.sql import Window

    k = F.col("c_custkey")
    r = table(spark, sf, "customer").select(F.expr("c_custkey div 25").alias("batch"), (k % 25).alias("i"), k.alias("row"), F.concat("c_mktsegment", k % 7).alias("name"))
    before = F.lag("name").over(Window.partitionBy("batch").orderBy("i"))
    a = r.select("batch", "i", F.when(F.col("i") % 4 == 3, F.concat(F.lower(before), F.lit(" "))).when(F.col("i") % 10 == 8, "nobody").otherwise(F.col("name")).alias("name"))
    return research.anchored(a, r)


@query("geocode_reasons", """
select case when s_suppkey % 5 = 4 then 'not rooftop' when s_suppkey % 7 = 6 then 'house number differs' when s_suppkey % 11 = 10 then 'state differs' when s_suppkey % 3 = 2 and s_suppkey % 2 = 1 then 'city differs' when s_suppkey % 2 = 1 then 'ZIP differs' when s_suppkey % 13 = 12 then 'street: suffix_differs' end as reason, count(*) as n from supplier group by 1""")
def geocode_reasons(spark, sf):
    k = F.col("s_suppkey")
    reason = research.geocode_reason(F.when(k % 5 == 4, "range").otherwise("rooftop"), k % 7 != 6, k % 3 != 2, k % 11 != 10, k % 2 != 1, F.when(k % 13 == 12, "!suffix_differs").otherwise("canonical"))
    return table(spark, sf, "supplier").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("verdict_chain", """
with v as (select event_id, case event_id % 4 when 0 then 'not_ic' when 1 then 'closed' when 2 then 'duplicate' else 'active' end as said, event_id % 3 as cited, event_id % 2 as strong from events)
select event_id, case when event_id % 10 = 0 and said in ('not_ic', 'closed') then 'review' when said = 'not_ic' and cited < 2 and strong < 1 then 'review' when said = 'closed' and event_id % 7 <> 0 then 'review' when said = 'duplicate' and event_id % 3 <> 0 then 'review' else said end as verdict from v""")
def verdict_chain(spark, sf):
    k = F.col("event_id")
    said = F.element_at(F.array(F.lit("not_ic"), F.lit("closed"), F.lit("duplicate"), F.lit("active")), (k % 4 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", research.verdict(said, k % 3, k % 2, k % 3 == 0, k % 10 == 0, k % 7 == 0).alias("verdict"))


def _details(spark, sf, rest):
    o = table(spark, sf, "orders").where(F.col("o_orderkey") % 7 != rest)
    return o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, "status").otherwise("priority").alias("field"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).when(F.col("o_orderkey") % (rest + 3) == 0, F.lit("5 low")).otherwise(F.col("o_orderpriority")).alias("value"))


_DETAILS = "(select o_orderkey as id, case when o_orderkey % 2 = 0 then 'status' else 'priority' end as field, case when o_orderkey % 2 = 0 then o_orderstatus when o_orderkey % {1} = 0 then '5 low' else o_orderpriority end as value from orders where o_orderkey % 7 <> {0})"
_KEY = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"


@query("answer_agreement", f"""
with a as {_DETAILS.format(1, 4)}, r as {_DETAILS.format(2, 5)}
select field, count(*) filter (r <> '') as asked, count(*) filter (r <> '' and a <> '') as answered, count(*) filter (r = a) as agreed, count(*) filter (r is null and a <> '') as novel
from (select coalesce(r.field, a.field) as field, {_KEY.format('r.value')} as r, {_KEY.format('a.value')} as a from r full join a on r.id = a.id and r.field = a.field) group by 1""")
def answer_agreement(spark, sf):
    return research.agreement(_details(spark, sf, 1), _details(spark, sf, 2), ["id", "field"])


@query("new_details", f"""
with c as {_DETAILS.format(1, 4)}, p as {_DETAILS.format(2, 5)}, b as {_DETAILS.format(3, 6)}
select * from c where not exists (select 1 from p where p.id = c.id and p.field = c.field and {_KEY.format('p.value')} = {_KEY.format('c.value')}) and not exists (select 1 from b where b.id = c.id and b.field = c.field and {_KEY.format('b.value')} = {_KEY.format('c.value')})""")
def new_details(spark, sf):
    return research.new_details(_details(spark, sf, 1), _details(spark, sf, 2), _details(spark, sf, 3))


@query("word_overlap", """
with n as (select distinct p_name as name from part), w as (select a.name as a, b.name as b, string_split(a.name, ' ') as x, string_split(b.name, ' ') as y from n a join n b on split_part(a.name, ' ', 2) = split_part(b.name, ' ', 2) and a.name < b.name)
select a, b, len(list_intersect(x, y)) / least(len(x), len(y)) as similarity from w""")
def word_overlap(spark, sf):
    n = table(spark, sf, "part").select(F.col("p_name").alias("name")).distinct().withColumn("k", F.split_part(norm_name(F.col("name")), F.lit(" "), F.lit(2)))
    pairs = n.select("k", F.col("name").alias("a")).join(n.select("k", F.col("name").alias("b")), "k").where("a < b")
    return pairs.select("a", "b", research.overlap_similarity(F.split("a", " "), F.split("b", " ")).alias("similarity"))


@query("single_page_removals", "select event_id // 2 as id from events where event_type <> 'error' group by 1 having count(distinct event_id % 3) = 1")
def single_page_removals(spark, sf):
    e = table(spark, sf, "events")
    page = F.concat(F.lit("seen  on "), "event_type", F.lit(" page"))
    facts = e.select(F.expr("event_id div 2").alias("id"), (F.col("event_id") % 3).cast("string").alias("url"), F.when(F.col("event_type") == "error", "not there").otherwise(F.concat(F.lit("seen on "), "event_type")).alias("quote"), page.alias("page"))
    return research.removal_support(facts)


@query("mention_windows")
def mention_windows(spark, sf):
    return research.stated_near(table(spark, sf, "documents"), "doc_id", "text", "license", 40)
