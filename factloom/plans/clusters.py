"""Candidates, clusters, ids, duplicates and graphs over parts as rows about things."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.text import norm_name
from factloom.operators.graph import keep
from factloom.operators import candidates, clustering, graph, matching
from factloom.plans.registry import query, table

_ROWS = """
with rows0 as (
  select p_partkey as ord, p_name as name, p_brand as state, case when p_partkey % 13 = 0 then '' else lower(p_type) end as city,
    case when p_size % 3 = 0 then '' else p_size || ' ' || p_type end as street_key, case when p_partkey % 17 = 0 then 'E' || (p_partkey % 5) else '' end as entity,
    p_partkey % 101 = 0 as no_plant, 's' || (p_partkey % 4) as source, p_partkey % 11 = 0 as site_visit from part
), rows1 as (
  select ord, name, case when ord % 13 = 0 then '' else state end as state, city, street_key, entity, no_plant, source, site_visit from rows0
), rows as (
  select *, case when no_plant then 'NFP|' || name when entity <> '' and street_key <> '' then state || '|E|' || entity || '|' || street_key when street_key <> '' then state || '|S|' || street_key else state || '|N|' || city || '|' || name end as sig,
    case when no_plant then 'no-fixed-plant' when entity <> '' and street_key <> '' then 'entity+street' when street_key <> '' then 'street_key' else 'name+city' end as method from rows1
)"""
_FIRST = (
    _ROWS
    + """, first as (
  select sig, min(ord) as first_ord, arg_min(state, ord) as state, arg_min(city, ord) as city, arg_min(street_key, ord) as street_key, arg_min(name, ord) as name, arg_min(method, ord) as method from rows group by sig
)"""
)
_ATTACH = (
    _FIRST
    + """, one as (select state, city, name, min(sig) as target from first where method in ('street_key', 'entity+street') and state <> '' and city <> '' and name <> '' group by all having count(*) = 1),
a1 as (select f.sig, o.target, 'name+city' as how from first f join one o using (state, city, name) where f.method = 'name+city'),
left1 as (select *, split_part(name, ' ', 1) as head from first where sig not in (select sig from a1)),
df as (select head, count(*) as df from (select sig, unnest(list_distinct(string_split(name, ' '))) as head from left1) group by 1),
two as (select state, city, head, min(sig) as target, min(name) as target_name from left1 where method in ('street_key', 'entity+street') and state <> '' and city <> '' group by all having count(*) = 1),
a2 as (select l.sig, t.target, 'name-head+city' as how from left1 l join two t using (state, city, head) join df using (head) where l.method = 'name+city' and length(l.head) >= 3
  and (df <= greatest(5, (select count(*) from left1) // 100) or len(list_intersect(string_split(l.name, ' '), string_split(t.target_name, ' '))) >= 2)),
left2 as (select * from left1 where sig not in (select sig from a2)),
three as (select name, min(sig) as target from left2 where method in ('street_key', 'entity+street') group by 1 having count(*) = 1),
a3 as (select l.sig, t.target, 'name-only' as how from left2 l join three t using (name) where l.method = 'name+city' and l.state = '' and l.city = '' and (contains(l.name, ' ') or length(l.name) >= 8)),
moved as (select * from a1 union all select * from a2 union all select * from a3),
final as (select r.*, coalesce(m.target, r.sig) as cluster, case when m.target is not null then 'attached' else r.method end as match_method from rows r left join moved m using (sig))"""
)
_ENTITIES = (
    _ATTACH
    + """, entities as (
  select cluster, arg_min(ord, (case when sig <> cluster then 1 else 0 end) * 1000000000 + ord) as ord, arg_min(name, (case when sig <> cluster then 1 else 0 end) * 1000000000 + ord) as name,
    arg_min(state, (case when sig <> cluster then 1 else 0 end) * 1000000000 + ord) as state, arg_min(city, (case when sig <> cluster then 1 else 0 end) * 1000000000 + ord) as city, arg_min(street_key, (case when sig <> cluster then 1 else 0 end) * 1000000000 + ord) as street_key,
    list_sort(list(distinct name)) as names, count(*) as n_rows, count(distinct source) as n_sources, bool_or(street_key <> '') as placed, bool_or(site_visit) as visited from final group by cluster
)"""
)


def rows(spark, sf):
    k = F.col("p_partkey")
    loose = k % 13 == 0
    p = table(spark, sf, "part").select(
        k.alias("ord"), F.col("p_name").alias("name"), F.when(loose, "").otherwise(F.col("p_brand")).alias("state"), F.when(loose, "").otherwise(F.lower("p_type")).alias("city"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.concat(F.col("p_size"), F.lit(" "), "p_type")).alias("street_key"), F.when(k % 17 == 0, F.concat(F.lit("E"), k % 5)).otherwise("").alias("entity"),
        (k % 101 == 0).alias("no_plant"), F.concat(F.lit("s"), k % 4).alias("source"), (k % 11 == 0).alias("site_visit"),
    )
    sig, method = clustering.signature(F.col("entity"), F.col("state"), F.col("city"), F.col("street_key"), F.col("name"), F.col("no_plant"))
    return p.withColumn("sig", sig).withColumn("method", method)


@query("cluster_signature", _ROWS + " select ord, sig, method from rows")
def cluster_signature(spark, sf):
    return rows(spark, sf).select("ord", "sig", "method")


@query("attach_addressless", _ATTACH + " select * from moved")
def attach_addressless(spark, sf):
    return clustering.attach(clustering.first_members(rows(spark, sf)))


@query("cluster_rows", _ATTACH + " select ord, cluster, match_method, case match_method when 'entity+street' then 0.95::double when 'street_key' then 0.9 when 'no-fixed-plant' then 0.6 else 0.7 end as confidence from final")
def cluster_rows(spark, sf):
    return clustering.clusters_of(rows(spark, sf)).select("ord", "cluster", "match_method", clustering.confidence(F.col("match_method")).alias("confidence"))


@query("cluster_entities", _ENTITIES + " select cluster, ord, name, state, city, street_key, array_to_string(list_filter(names, lambda x: x <> name), ' | ') as aliases, n_rows, n_sources, case when not placed then 'T0' when visited and n_sources >= 2 then 'T3' when n_sources >= 2 then 'T2' else 'T1' end as tier from entities")
def cluster_entities(spark, sf):
    return clustering.entities(clustering.clusters_of(rows(spark, sf)))


@query("issue_ids", _ENTITIES + """, reg as (select cluster, printf('FL-%05d', ord) as entity_id from entities where ord % 2 = 0)
select e.cluster, coalesce(r.entity_id, printf('FL-%05d', row_number() over (partition by r.entity_id is null order by e.ord) - 1 + (select greatest(96841, max(ord) + 1) from entities))) as entity_id, r.entity_id is null as issued from entities e left join reg r using (cluster)""")
def issue_ids(spark, sf):
    """Clusters with ids; the next number is beyond all that the registry holds."""
    e = keep(clustering.entities(clustering.clusters_of(rows(spark, sf))).select("cluster", "ord"), "entities")
    registry = e.where("ord % 2 = 0").select("cluster", F.format_string("FL-%05d", "ord").alias("entity_id"))
    next_no = max(96841, (e.agg(F.max("ord")).first()[0] or 0) + 1)
    return clustering.issue_ids(e, registry, next_no).select("cluster", "entity_id", "issued")


@query("registry_lookup", _ATTACH + """, c as (select cluster, min(ord) as ord from final group by 1), alts as (select distinct cluster, sig as alt from final where sig <> cluster),
reg as (select sig as cluster, 'R' || (first_ord % 500) as entity_id, first_ord % 9 <> 0 as live from first where first_ord % 3 = 0),
found as (select a.cluster, count(distinct r.entity_id) as n, min(r.entity_id) as f from alts a join reg r on r.cluster = a.alt and r.live where a.cluster not in (select cluster from reg) group by 1)
select c.cluster, coalesce(r.entity_id, case when f.n = 1 then f.f end) as entity_id, case when r.entity_id is not null then 'known' when f.n = 1 then 'attached' when f.n > 1 then 'ambiguous' else 'new' end as how
from c left join reg r using (cluster) left join found f using (cluster)""")
def registry_lookup(spark, sf):
    r = rows(spark, sf)
    done = clustering.clusters_of(r)
    alts = done.groupBy("cluster").agg(F.collect_set(F.when(F.col("sig") != F.col("cluster"), F.col("sig"))).alias("alts"))
    first = clustering.first_members(r).where("first_ord % 3 = 0")
    registry = first.select(F.col("sig").alias("cluster"), F.concat(F.lit("R"), F.col("first_ord") % 500).alias("entity_id"), (F.col("first_ord") % 9 != 0).alias("live"))
    return clustering.lookup_ids(alts, registry)


@query("token_frequency", "select token, count(*) as df from (select p_partkey, unnest(list_distinct(string_split(p_name, ' '))) as token from part) group by 1")
def token_frequency(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.explode(F.array_distinct(F.split(norm_name(F.col("p_name")), " "))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


@query("seed_collisions", """
with plan as (select c_custkey, c_custkey % 700 as number from customer), old as (select s_suppkey as number from supplier)
select number, count(*) as n, bool_or(o is not null) as taken from (select p.number, old.number as o from plan p left join old using (number)) group by 1 having count(*) > 1 or bool_or(o is not null)""")
def seed_collisions(spark, sf):
    plan = table(spark, sf, "customer").select((F.col("c_custkey") % 700).alias("number"))
    old = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("number"), F.lit(True).alias("o"))
    return plan.join(old, "number", "left").groupBy("number").agg(F.count("*").alias("n"), F.bool_or(F.coalesce("o", F.lit(False))).alias("taken")).where("n > 1 or taken")


@query("dedupe_components", "select p_partkey as node, min(p_partkey) over (partition by p_brand, p_name) as component from part")
def dedupe_components(spark, sf):
    """Parts of equal brand and name: each links to the least of its group, and components follow the links."""
    p = table(spark, sf, "part")
    least = p.groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("b"))
    edges = p.join(least, ["p_brand", "p_name"]).select(F.col("p_partkey").alias("a"), "b")
    return graph.components(p.select(F.col("p_partkey").alias("node")), edges)


@query("path_components", """
with recursive edges as (select c_custkey as a, c_custkey + 7 as b from customer where c_custkey % 70 < 40 and c_custkey + 7 < (select count(*) from customer)),
both_ as (select a, b from edges union all select b, a from edges),
reach as (select c_custkey as node, c_custkey as far from customer union select r.node, e.b from reach r join both_ e on e.a = r.far)
select node, min(far) as component from reach group by node""")
def path_components(spark, sf):
    c = table(spark, sf, "customer")
    n = c.count()
    edges = c.where("c_custkey % 70 < 40").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 7).alias("b")).where(F.col("b") < n)
    return graph.components(c.select(F.col("c_custkey").alias("node")), edges)


@query("collapse_report", "select count(*) as n_rows, count(*) - count(distinct (p_brand, p_name)) as collapses, (count(*) - count(distinct (p_brand, p_name)))::double / count(*) as rate, count(distinct (p_brand, p_name)) as corrected from part")
def collapse_report(spark, sf):
    return graph.collapse_report(dedupe_components(spark, sf))


@query("component_survivors", "select component, survivor from (select min(p_partkey) over w as component, p_partkey as survivor, row_number() over (partition by p_brand, p_name order by p_size desc, p_partkey) as no from part window w as (partition by p_brand, p_name)) where no = 1")
def component_survivors(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), "p_size")
    return graph.survivors(dedupe_components(spark, sf).join(p, "node"), "p_size")


@query("merge_chains", """
with recursive chain as (select s_suppkey as node, s_suppkey + 1 as into_ from supplier where s_suppkey % 10 <> 9 and s_suppkey + 1 < (select count(*) from supplier)),
walk as (select node, into_ as hop from chain union all select w.node, c.into_ from walk w join chain c on c.node = w.hop)
select node, max(hop) as root from walk group by node union all select * from (values (-1, null), (-2, null)) t(node, root)""")
def merge_chains(spark, sf):
    s = table(spark, sf, "supplier")
    n = s.count()
    chain = s.where("s_suppkey % 10 <> 9").select(F.col("s_suppkey").alias("node"), (F.col("s_suppkey") + 1).alias("into")).where(F.col("into") < n)
    cycle = spark.createDataFrame([(-1, -2), (-2, -1)], "node bigint, into bigint")
    return graph.follow(chain.unionByName(cycle))


@query("candidate_reasons", r"""
with r as (select p_partkey, 's' || (p_partkey % 20) as source, p_type as code, p_name as name, left(p_type, 4) as family from part)
select p_partkey, case when source = 's3' then 'source s3' when code = 'PROMO' then 'core PROMO' when family = 'ECON' then 'family ECON' when code = 'LARGE' then 'code LARGE' when contains(name, 'bolt') then null
  when regexp_matches(name, '\bwidget') and family in ('SMAL', 'MEDI') then '\bwidget in ' || family when regexp_matches(name, '^red\b') and family in ('STAN', 'SMAL') then '^red\b in ' || family end as reason from r
where reason is not null""")
def candidate_reasons(spark, sf):
    p = table(spark, sf, "part")
    why = candidates.reason(F.concat(F.lit("s"), F.col("p_partkey") % 20), F.col("p_type"), F.col("p_name"), ["s3"], ["PROMO"], ["ECON"], ["LARGE"], ["bolt"], [(r"\bwidget", ["SMAL", "MEDI"]), (r"^red\b", ["STAN", "SMAL"])])
    return p.select("p_partkey", why.alias("reason")).where("reason is not null")


@query("label_routing", "select d.doc_id, case when d.source = 'src0' then 'keep' when l.quality = 1 then 'keep' when l.quality = 0 then 'drop' else 'review' end as queue from documents d left join labels l using (doc_id)")
def label_routing(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    labels = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "yes").otherwise("no").alias("label"))
    return candidates.route(d, labels, "doc_id", F.col("source") == "src0").select("doc_id", "queue")


@query("duplicate_confidence", """
with p as (select p_brand as state, p_name as name, p_type as city, p_size as street, min(p_partkey) as id from part group by all)
select a.id as a, b.id as b, case when a.street = b.street then 0.95::double else 0.4 end as confidence from p a join p b on a.state = b.state and a.id < b.id and ((a.street = b.street) or (a.name = b.name and a.city = b.city))""")
def duplicate_confidence(spark, sf):
    p = table(spark, sf, "part").groupBy(F.col("p_brand").alias("state"), F.col("p_name").alias("name"), F.col("p_type").alias("city"), F.col("p_size").alias("street")).agg(F.min("p_partkey").alias("id"))
    a, b = p.select("state", *[F.col(c).alias(f"a_{c}") for c in ("name", "city", "street", "id")]), p.select("state", *[F.col(c).alias(f"b_{c}") for c in ("name", "city", "street", "id")])
    # Two equi-joins instead of all pairs of a state: one key a rule, pairs that meet both come once.
    by_street = a.join(b, (a["state"] == b["state"]) & (F.col("a_street") == F.col("b_street")))
    by_name = a.join(b, (a["state"] == b["state"]) & (F.col("a_name") == F.col("b_name")) & (F.col("a_city") == F.col("b_city")) & (F.col("a_street") != F.col("b_street")))
    c = matching.duplicate_confidence(F.col("a_name") == F.col("b_name"), F.lit(0.0), F.lit(1.0), F.col("a_street") == F.col("b_street"), F.lit(True))
    cols = [F.col("a_id").alias("a"), F.col("b_id").alias("b"), c.alias("confidence")]
    return by_street.where("a_id < b_id").select(*cols).unionByName(by_name.where("a_id < b_id").select(*cols))


@query("dedupe_fuzzy")
def dedupe_fuzzy(spark, sf):
    p = table(spark, sf, "part").where("p_partkey % 7 <> 0").select("p_brand", F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    typo = table(spark, sf, "part").where("p_partkey % 7 = 0").select("p_brand", F.col("p_partkey").alias("id"), F.replace("p_name", F.lit("e"), F.lit("ee")).alias("name"))
    return matching.fuzzy_pairs(p.unionByName(typo), ["p_brand"], "id", "name", 0.9)


@query("false_merge")
def false_merge(spark, sf):
    from factloom.functions.streets import likeness
    from factloom.operators import measure

    p = table(spark, sf, "part").groupBy("p_brand", "p_size", "p_name").agg(F.min("p_partkey").alias("id"))
    b = p.select("p_brand", "p_size", F.col("p_name").alias("other"))
    pairs = p.join(b, ["p_brand", "p_size"]).where("p_name < other").withColumn("group", F.concat_ws("|", "p_brand", "p_size"))
    return measure.false_merge(pairs, "group", likeness("p_name", "other"), 0.6)


@query("greedy_match")
def greedy_match(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("control"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("x"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("y"))
    e = s.join(c, "nation").where("abs(x - y) < 400").withColumn("rung", F.when(F.abs(F.col("x") - F.col("y")) < 100, 0).otherwise(1))
    return matching.greedy_one_to_one(e.select("nation", "control", "entity", "rung"), "control", "entity", "rung", ["control", "entity"], "nation")


@query("unique_target", """
with one as (select p_brand, p_name, min(p_partkey) as target from part group by all having count(*) = 1)
select l.p_partkey, o.target from (select p_partkey + 1000000 as p_partkey, p_brand, p_name from part where p_size < 20) l join one o using (p_brand, p_name)""")
def unique_target(spark, sf):
    p = table(spark, sf, "part")
    loose = p.where("p_size < 20").select((F.col("p_partkey") + 1000000).alias("p_partkey"), "p_brand", "p_name")
    return matching.unique_match(loose, p.select("p_brand", "p_name", F.col("p_partkey").alias("target")), ["p_brand", "p_name"], "target").select("p_partkey", "target")


@query("both_sides_unique", """
with a as (select p_partkey as id, p_name || p_size as k from part where p_partkey % 2 = 0), b as (select p_partkey as other, p_name || p_size as k from part where p_partkey % 2 = 1)
select id, other from a join b using (k) where k in (select k from a group by 1 having count(*) = 1) and k in (select k from b group by 1 having count(*) = 1)""")
def both_sides_unique(spark, sf):
    p = table(spark, sf, "part").withColumn("k", F.concat("p_name", F.col("p_size").cast("string")))
    return matching.both_unique(p.where("p_partkey % 2 = 0").select("k", F.col("p_partkey").alias("id")), p.where("p_partkey % 2 = 1").select("k", F.col("p_partkey").alias("other")), "k").select("id", "other")


@query("tiered_resolution", """
with pairs as (select c_custkey as id, c_nationkey as nation, c_mktsegment as seg from customer),
byseg as (select s_nationkey as nation, min(s_suppkey) as v from supplier group by 1 having count(*) = 1)
select p.id, coalesce(case when p.id % 5 = 0 then p.id end, case when p.id % 3 = 0 then p.id + 1000000 end, b.v + 2000000) as value,
  case when p.id % 5 = 0 then 'same_id' when p.id % 3 = 0 then 'identity' when b.v is not null then 'unique_name' else 'unresolved' end as how from pairs p left join byseg b using (nation)""")
def tiered_resolution(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    one = matching.unique_match(c, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("v")), ["nation"], "v")
    steps = [("same_id", c.where("id % 5 = 0").select("id", F.col("id").alias("value"))), ("identity", c.where("id % 3 = 0").select("id", (F.col("id") + 1000000).alias("value"))), ("unique_name", one.select("id", (F.col("v") + 2000000).alias("value")))]
    return matching.tiered(c, "id", steps, "value")
