"""Reviews over the driver's tables: checks, audits, gates, strict matches, funnels, summaries, work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import streets
from factloom.operators import review
from factloom.plans.registry import query, table
from factloom.plans.release import case, pick


@query("control_problems", """
with c as (select o_orderkey % 1000 as id, case when o_orderkey % 17 = 0 then ' ' else o_orderpriority end as p, o_orderstatus as s, case when o_orderkey % 5 = 0 then 'x' else '' end as a, case when o_orderkey % 10 = 0 then 'y' else '' end as b from orders),
n as (select 'blank:p' as "check", count(*) filter (trim(p) = '') as n from c union all select 'value:s', count(*) filter (s not in ('O', 'F')) from c union all select 'pair:a+b', count(*) filter ((a <> '') <> (b <> '')) from c
union all select 'repeated:id', count(*) from (select id from c group by 1 having count(*) > 1)) select * from n where n > 0""")
def control_problems(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select((k % 1000).alias("id"), F.when(k % 17 == 0, " ").otherwise(F.col("o_orderpriority")).alias("p"), F.col("o_orderstatus").alias("s"), F.when(k % 5 == 0, "x").otherwise("").alias("a"), F.when(k % 10 == 0, "y").otherwise("").alias("b"))
    return review.problems(rows, ["p"], ["id"], {"s": ["O", "F"]}, [("a", "b")])


@query("control_totals", "with f as (select o_custkey as k, count(*) as found from orders group by 1), s as (select c_custkey as k, c_custkey % 12 as stated from customer) select coalesce(s.k, f.k) as k, stated, found from s full join f on s.k = f.k where stated is distinct from found")
def control_totals(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.lit(1).alias("n"))
    return review.totals(rows, "k", "n", table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 12).alias("total")))


_NAMES = ["Florida Plywoods, Inc.", "JELD-WEN Windows", "Acme Truss & Millwork", "Redi Mix Supply", "Honest Homes", "Concrete Pipe Co", "Wall Panel Plywood LLC", ""]
_FLAG = "([1, 1, 0, 1, 0, 1, 0, 0])[p_partkey % 8 + 1]"


@query("precision_audit", f"select 't' || p_size % 5 as product_type, count(*) as admitted, sum({_FLAG})::bigint as flagged, count(*) filter (p_partkey % 8 in (2, 6)) as held_back, count(*) filter (p_partkey % 3 = 0) as product_naics from part where p_partkey % 8 <> 7 group by 1")
def precision_audit(spark, sf):
    k = F.col("p_partkey")
    return review.precision_audit(table(spark, sf, "part").select(pick(k, _NAMES).alias("name"), F.concat(F.lit("t"), F.col("p_size") % 5).alias("product_type"), pick(k, ["321911", "332311", ""]).alias("naics")))


_FACTS = [
    ("enrich:locate", "address", "1 A St", "search", "https://x.com :: 1 A St"), ("enrich:locate", "address", "2 B St", "search", "recalled"), ("geo", "lat_lon", "1,2", "rooftop", ""), ("geo", "lat_lon", "1,2", "range", ""),
    ("geo", "lat_lon", "1,2", "place_match", "overture:9 :: matched 1 A St"), ("geo", "lat_lon", "1,2", "place_match", "overture:9"), ("geo", "lat_lon", "1,2", "interpolated_on_building", "x :: confirmed by overture:r:building:7"),
    ("fp", "building_sqft", "900", "", "none"), ("fp", "building_sqft", "900", "", "r:7"), ("enrich:existence", "existence_flag", "review", "", ""), ("enrich:existence", "status", "closed", "", ""), ("cap", "capability_leaf", "truss", "", ""), ("cap", "capability_group", "cakes", "", ""),
]
_F = "with f as (select o_orderkey % 13 as k from orders), c as (select k, count(*) as n from f group by 1)"
_GATES = {"E1": ((0, 1), (1,)), "E2": ((2, 3, 4, 5, 6), (3,)), "E3": ((7, 8), (7,)), "E5": ((9, 10), (10,)), "E7": ((4, 5), (5,)), "E8": ((6,), ()), "E9": ((11, 12), (12,))}


@query("evidence_gates", f"{_F} " + " union all ".join(f"select '{g}' as gate, coalesce(sum(n) filter (k in ({', '.join(map(str, a))})), 0)::bigint as n, coalesce(sum(n) filter (k in ({', '.join(map(str, (*b, -1)))})), 0)::bigint as bad from c" for g, (a, b) in _GATES.items()))
def evidence_gates(spark, sf):
    cols = [pick(F.col("o_orderkey"), [f[i] for f in _FACTS]).alias(c) for i, c in enumerate(["source_id", "field", "value", "basis", "evidence"])]
    return review.evidence_gates(table(spark, sf, "orders").select(*cols), ["frames"], ["truss", "panel"])


@query("lost_coverage", "with n as (select count(*) filter (p_partkey % 3 <> 0) as a, count(*) filter (p_partkey % 3 <> 0 and p_partkey % 7 <> 0) as b from part) select 'name' as field, a as before, b as after from n where b < a")
def lost_coverage(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(F.when(k % 3 != 0, "x").alias("name"), F.lit("y").alias("brand"), F.when(k % 5 == 0, "").otherwise("z").alias("site"), k)
    after = p.withColumns({"name": F.when(k % 7 != 0, F.col("name")), "site": F.when(k > 1, F.col("site"))})
    return review.lost_coverage(p.drop("p_partkey"), after.drop("p_partkey"), ["name", "brand", "site"], {"site": 1})


_STRICT = """
with e as (select c_custkey as id, c_custkey % 300 as no, c_custkey % 2 as st, c_nationkey % 4 as city, case when c_custkey % 3 = 0 then '' else 'z' end as zip from customer),
q as (select s_suppkey as pid, s_suppkey % 300 as no, s_suppkey % 2 as st, s_nationkey % 4 as city, case when s_suppkey % 5 = 0 then 'w' else 'z' end as zip, s_suppkey % 2 as pt from supplier),
m as (select e.id, q.pid, q.pt from e join q using (no, st, city) where e.zip = '' or e.zip = q.zip)"""


@query("strict_places", _STRICT + " select id, case when count(distinct pt) = 1 then max(pid) end as place_id, case when count(distinct pt) = 1 then 'matched' else 'ambiguous_place_points' end as how from m group by 1")
def strict_places(spark, sf):
    def rows(t, key, nation):
        k = F.col(key)
        return table(spark, sf, t).select(k.alias("id"), F.lit("Acme Homes").alias("name"), F.concat(k % 300, F.lit(" "), pick(k, ["Oak Street", "Pine Hill Road"])).alias("address"), F.concat(F.lit("Town"), F.col(nation) % 4).alias("city"), F.lit("TX").alias("state"), k)

    e = rows("customer", "c_custkey", "c_nationkey").withColumn("zip", F.when(F.col("c_custkey") % 3 == 0, "").otherwise("73301")).drop("c_custkey")
    s = rows("supplier", "s_suppkey", "s_nationkey").withColumns({"zip": F.when(F.col("s_suppkey") % 5 == 0, "73399").otherwise("73301-0001"), "lat": F.lit(30.0), "lon": (F.col("s_suppkey") % 2).cast("double")})
    return review.strict_places(e, s.drop("s_suppkey").withColumnRenamed("id", "place_id"), lambda a, b: streets.name_score(a, b))


@query("settled_places", """
with c as (select o_custkey as id, o_orderkey as pid, o_orderkey % 3 as a, case when o_custkey % 4 = 0 then 0 else o_orderkey % 2 end as far, case when o_custkey % 3 = 0 then 0.95 else 0.5 end as s from orders where o_orderkey % 5 = 0),
g as (select id, count(*) as n, max(far) - min(far) as d, max(s) as s, first(pid order by 'n' || a, far, pid) as first_, min(pid) as best from c group by 1)
select id, case when n = 1 or d = 0 then first_ when s >= 0.9 then best end as place_id, case when n = 1 then 'one' when d = 0 then 'one_building' when s >= 0.9 then 'name' else 'ambiguous' end as how from g""")
def settled_places(spark, sf):
    o, k, c = table(spark, sf, "orders").where("o_orderkey % 5 = 0"), F.col("o_orderkey"), F.col("o_custkey")
    far = F.when(c % 4 == 0, 0).otherwise(k % 2)
    return review.settled_places(o.select(c.alias("id"), k.alias("place_id"), F.concat(F.lit("n"), k % 3).alias("name"), (30 + far * 0.01).alias("lat"), F.lit(-97.0).alias("lon"), F.when(c % 3 == 0, 0.95).otherwise(0.5).alias("score")))


@query("sole_donors", """
with t as (select c_custkey as id, c_custkey % 700 as k from customer), g as (select s_suppkey as id, s_suppkey % 700 as k, s_suppkey % 5 as p from supplier union all select s_suppkey, s_suppkey % 700, case when s_suppkey % 4 = 0 then 9 else s_suppkey % 5 end from supplier),
j as (select t.id, count(distinct g.id) as n, min(g.id) as g, count(distinct g.p) as np, min(g.p) as p from t left join g on t.k = g.k and t.id <> g.id group by 1)
select id, case when n = 1 and np = 1 then g end as donor, case when n = 1 and np = 1 then p end as point, case when n = 0 then 'no_donor' when n > 1 then 'several_donors' when np > 1 then 'conflicting_points' else 'matched' end as how from j""")
def sole_donors(spark, sf):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    one = s.select(k.alias("id"), (k % 5).alias("point"), F.concat(F.lit("n"), k % 700).alias("name"))
    two = s.select(k.alias("id"), F.when(k % 4 == 0, 9).otherwise(k % 5).alias("point"), F.concat(F.lit("n"), k % 700).alias("name"))
    targets = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), F.col("c_custkey") % 700).alias("name"))
    return review.sole_donor(targets, one.unionAll(two), F.col("name"))


@query("standing_entities", "select c_custkey as entity from customer where c_custkey in (select o_custkey from orders) or c_custkey % 10 = 0")
def standing_entities(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"))
    return review.standing(c, table(spark, sf, "orders").select(F.col("o_custkey").alias("entity")), c.where("entity % 10 = 0"))


@query("crosswalk_candidates", """
with m as (select c_custkey as id from customer where c_custkey % 3 = 0), f as (select s_suppkey as fid, 'w' || s_suppkey % 6 as a, 'x' || s_suppkey % 2 as b, s_nationkey % 3 as city from supplier where s_suppkey not in (select id from m)),
c as (select c_custkey as id, 'w' || c_custkey % 6 as h, 'x' || c_custkey % 5 as b, c_nationkey % 3 as city from customer where c_custkey % 3 <> 0),
j as (select c.id, min(fid) as fid from c join f on c.city = f.city and (c.h = f.a) group by 1)
select j.id as control_id, j.fid as facility_id, 'acme' || c.h as head, case when c.b = f.b then 'acme' || c.h || ' ' || c.b else 'acme' || c.h end as shared from j join c on j.id = c.id join f on j.fid = f.fid""")
def crosswalk_candidates(spark, sf):
    def rows(t, key, nation, second, name):
        k = F.col(key)
        return table(spark, sf, t).select(k.alias(name), F.concat(F.lit("Acmew"), k % 6, F.lit(" x"), k % second).alias("name"), F.concat(F.lit("Town "), F.col(nation) % 3).alias("city"), F.lit("TX").alias("state"))

    control, places = rows("customer", "c_custkey", "c_nationkey", 5, "control_id"), rows("supplier", "s_suppkey", "s_nationkey", 2, "facility_id")
    matched = control.where("control_id % 3 = 0").select("control_id", F.col("control_id").alias("facility_id"))
    return review.crosswalk_candidates(control, places.withColumn("ord", F.col("facility_id")), matched)


_STATUS = "select c_custkey as control_id, case when c_custkey % 3 = 0 then 'HAVE' else 'MISSING' end as status, case when c_custkey % 3 = 0 then case when c_custkey % 2 = 0 then 'no' else 'yes' end else '' end as has_address, case when c_custkey % 3 = 0 then '' when c_custkey in (select o_custkey from orders) then 'ingested but lost' else 'never ingested' end as why from customer"


@query("control_status", _STATUS)
def control_status(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("control_id"))
    outcome = c.where("control_id % 3 = 0").withColumn("tier", F.when(F.col("control_id") % 2 == 0, "T0").otherwise("T2"))
    return review.control_status(c, outcome, table(spark, sf, "orders").select(F.col("o_custkey").alias("control_id"), F.lit("s").alias("source")))


@query("source_gap", f"with s as ({_STATUS}) select count(*) as in_scope, count(*) filter (status = 'HAVE') as found, count(*) filter (why = 'ingested but lost') as lost, count(*) filter (why = 'never ingested') as never, round((count(*) - count(*) filter (why = 'never ingested')) / count(*), 4) as ceiling from s")
def source_gap(spark, sf):
    return review.source_gap(control_status(spark, sf))


_SAID = ["the value is not a street address", "no citation given", "it cited a page search did not visit", "confidence 0.4 is below 0.7", "the cited page does not contain it", "could not read the cited page", "nothing"]
_BUCKET = case("o_orderkey", ["not a street address", "no citation", "cited a page search never opened", "confidence below threshold", "page did not contain the address", "page could not be read", "model found nothing it could cite"])


@query("locate_funnel", f"select {_BUCKET} as bucket, count(*) as rows, count(distinct o_custkey) as calls from orders group by 1")
def locate_funnel(spark, sf):
    return review.locate_funnel(table(spark, sf, "orders").withColumn("why", pick(F.col("o_orderkey"), _SAID)), "why", "o_custkey")


@query("admitted_points", """select p_partkey as id, why = '' as admitted, why from (select p_partkey, case when p_partkey % 5 = 4 then 'never geocoded' when p_partkey % 5 = 0 then 'already a rooftop coordinate' when p_partkey % 5 = 3 then 'kind is not admitted'
 when p_size % 3 = 0 then 'the postcode it returned is not ours' when p_size % 7 = 0 or p_size > 40 then 'no building within the radius' else '' end as why from part)""")
def admitted_points(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    kind = F.when(k % 5 != 4, pick(k, ["rooftop", "range_interpolation", "nearest", "state", "x"]))
    rows = table(spark, sf, "part").select(k.alias("id"), kind.alias("kind"), F.lit("73301-1").alias("own_zip"), F.when(s % 3 == 0, "73302").otherwise("73301").alias("zip"), F.when(s % 7 != 0, s + 10.0).alias("building_m"))
    return review.admitted_points(rows, ["range_interpolation", "nearest"])


@query("capability_report", "with t as (select n_regionkey as grp, n_nationkey as leaf from nation), a as (select c_nationkey as leaf, (c_custkey % 100) / 100.0 as c from customer where c_nationkey % 6 <> 0) select t.grp, t.leaf, count(a.leaf) as n, count(*) filter (c < 0.5) as unsure, min(c)::double as least, max(c)::double as most from t left join a using (leaf) group by all")
def capability_report(spark, sf):
    answers = table(spark, sf, "customer").where("c_nationkey % 6 <> 0").select(F.col("c_nationkey").alias("leaf"), ((F.col("c_custkey") % 100) / 100.0).alias("confidence"))
    return review.capability_report(answers, table(spark, sf, "nation").select(F.col("n_regionkey").alias("grp"), F.col("n_nationkey").alias("leaf")))


@query("merged_summaries", "select o_orderpriority, sum(o_orderkey)::bigint as calls, min(o_custkey) as best, bool_and(o_orderkey > 3) as passed from orders group by 1")
def merged_summaries(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", F.col("o_orderkey").alias("calls"), F.col("o_custkey").alias("best"), (F.col("o_orderkey") > 3).alias("passed"))
    return review.summed(rows, ["o_orderpriority"], ["calls"], ["best"], ["passed"])


@query("net_moves", "with b as (select p_partkey % 4 = 0 as was, p_partkey % 6 = 0 as now, p_size % 5 as category from part where p_partkey % 10 <> 9) select category, count(*) filter (was and not now) as lost, count(*) filter (now and not was) as won, count(*) filter (now and not was) - count(*) filter (was and not now) as net from b group by 1")
def net_moves(spark, sf):
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    old = p.where("p_partkey % 10 <> 9").select(k.alias("row_hash"), F.when(k % 4 == 0, "IC").alias("label"), (F.col("p_size") % 5).alias("category"))
    return review.net_moves(old, p.select(k.alias("row_hash"), F.when(k % 6 == 0, "IC").otherwise("no").alias("label"), (F.col("p_size") % 5).alias("category")), "IC")


@query("cache_statistics", "select o_orderpriority as kind, o_orderstatus as provider, count(*) as entries, sum(o_orderkey % 2)::bigint as positives, sum(o_orderkey % 7)::bigint as calls_saved from orders group by all")
def cache_statistics(spark, sf):
    k = F.col("o_orderkey")
    return review.cache_stats(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("provider"), (k % 2).alias("found"), (k % 7).alias("hits")))


@query("rank_order", "select row_number() over (order by case o_orderstatus when 'P' then 0 when 'F' then 1 else 2 end, o_orderkey) as place, o_orderkey from orders order by 1 limit 200")
def rank_order(spark, sf):
    """The first 200 in the order of a list of states; the report is a page of them."""
    from pyspark.sql import Window

    page = review.by_rank(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "F"], "o_orderkey").limit(200)
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    return page.select(F.row_number().over(Window.orderBy(rank, "o_orderkey")).alias("place"), "o_orderkey")


@query("pairs_by_confidence", "select row_number() over (order by o_orderkey % 10 desc, o_orderkey) as place, o_orderkey from orders order by 1 limit 100")
def pairs_by_confidence(spark, sf):
    """The 100 surest pairs, in stable order."""
    from pyspark.sql import Window

    by = [F.desc("confidence"), F.asc("o_orderkey")]
    rows = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 10).alias("confidence")).orderBy(*by).limit(100)
    return rows.select(F.row_number().over(Window.orderBy(*by)).alias("place"), "o_orderkey")


@query("work_list", """with l as (select o_custkey as item, max(o_orderkey % 50) as until, max(o_orderkey % 4) as tries from orders where o_orderkey % 3 = 0 group by 1)
select c_custkey as item, case when c_custkey % 5 = 0 then 'done' when l.until > 40 then 'leased' when l.tries >= 3 then 'given_up' else 'open' end as state from customer left join l on item = c_custkey""")
def work_list(spark, sf):
    c, k = table(spark, sf, "customer").select(F.col("c_custkey").alias("item")), F.col("o_orderkey")
    leases = table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("item"), (k % 50).alias("until"), (k % 4).alias("tries"))
    return review.work_list(c, c.where("item % 5 = 0"), leases, F.lit(40))


@query("sampled", """(select 'every' as how, p_partkey from (select p_partkey, row_number() over (order by p_partkey) - 1 as r from part) where r % 7 = 0)
union all (select 'first', p_partkey from part order by p_partkey limit 10)
union all (select 'strata', p_partkey from (select p_partkey, p_brand, row_number() over (partition by p_brand order by md5('s|' || p_partkey), p_partkey) as r from part) order by r, p_brand limit 60)""")
def sampled(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    rules = {"every": review.taken(p, "every", 7, ["p_partkey"]), "first": review.taken(p, "first", 10, ["p_partkey"]), "strata": review.taken(p, "hash", 60, ["p_partkey"], "p_brand", "s")}
    parts = [df.select(F.lit(how).alias("how"), "p_partkey") for how, df in rules.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
