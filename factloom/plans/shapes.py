"""Aggregates, windows, orders, sets, samples, record assembly and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.operators import candidates, measure
from factloom.plans.registry import query, table
from factloom.sources import records


@query("count_by_key", "select o_orderstatus, count(*) as n from orders group by 1")
def count_by_key(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("conditional_counts", "select l_returnflag, count(*) as n, count(*) filter (l_discount > 0.05) as discounted, count(*) filter (l_tax = 0) as untaxed, round(sum(case when l_quantity > 25 then l_extendedprice::decimal(18,2) else 0 end)::double, 2) as big_sum from lineitem group by 1")
def conditional_counts(spark, sf):
    big = F.sum(F.when(F.col("l_quantity") > 25, F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(0))
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_if(F.col("l_tax") == 0).alias("untaxed"), F.round(big.cast("double"), 2).alias("big_sum"))


@query("distinct_sources", "select l_partkey, count(distinct l_suppkey) as n_sources, count(distinct l_returnflag) as n_values from lineitem group by 1")
def distinct_sources(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n_sources"), F.count_distinct("l_returnflag").alias("n_values"))


@query("first_in_order", "select o_custkey, arg_min(o_orderstatus, o_orderkey) as first_status, arg_max(o_orderstatus, o_orderkey) as last_status from orders group by 1")
def first_in_order(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("first_status"), F.max_by("o_orderstatus", "o_orderkey").alias("last_status"))


@query("alias_lists", "select p_brand, string_agg(distinct p_name, ' | ' order by p_name) as aliases from part group by 1")
def alias_lists(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_name")), " | ").alias("aliases"))


@query("argmax_ties", "select user_id, event_id, value from (select *, row_number() over (partition by user_id order by value desc, ts desc, event_id) as no from events) where no = 1")
def argmax_ties(spark, sf):
    best = F.max_by(F.struct("event_id", "value"), F.struct("value", "ts", -F.col("event_id"))).alias("b")
    return table(spark, sf, "events").groupBy("user_id").agg(best).select("user_id", "b.event_id", "b.value")


@query("most_attested", "select p_brand, p_name as value, n from (select p_brand, p_name, count(*) as n, row_number() over (partition by p_brand order by count(*) desc, p_name) as no from part group by 1, 2) where no = 1")
def most_attested(spark, sf):
    n = table(spark, sf, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    return candidates.first_per(n, [F.col("p_brand")], F.desc("n"), F.col("p_name")).select("p_brand", F.col("p_name").alias("value"), "n")


@query("evidence_merge", """
select user_id, count(*) as n_rows, string_agg(distinct event_type, ' ' order by event_type) as kinds, left(string_agg(event_type || ':' || value, '; ' order by event_id), 900) as notes, arg_min(props, event_id) filter (value > 20) as first_props from events group by 1""")
def evidence_merge(spark, sf):
    e = table(spark, sf, "events")
    note = F.concat(F.col("event_type"), F.lit(":"), F.col("value").cast("string"))
    notes = F.left(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", note.alias("t")))), lambda x: x["t"]), "; "), F.lit(900))
    first = F.min_by(F.when(F.col("value") > 20, F.col("props")), F.when(F.col("value") > 20, F.col("event_id")))
    return e.groupBy("user_id").agg(F.count("*").alias("n_rows"), F.array_join(F.sort_array(F.collect_set("event_type")), " ").alias("kinds"), notes.alias("notes"), first.alias("first_props"))


@query("coverage_bias", """
with f as (select s_nationkey as nation, count(*) as found from supplier group by 1), c as (select c_nationkey as nation, count(*) as frame from customer group by 1),
b as (select c.nation, coalesce(f.found, 0) as found, c.frame, sum(coalesce(f.found, 0)) over () as all_found, sum(c.frame) over () as all_frame from c left join f using (nation))
select nation, found, frame, round(found / frame, 6) as coverage, round(found / all_found - frame / all_frame, 6) as bias, frame / all_frame >= 0.04 as is_large from b""")
def coverage_bias(spark, sf):
    found = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("found"))
    frame = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("frame"))
    return measure.coverage_and_bias(found, frame, "nation", 0.04)


@query("mean_abs_bias", """
with f as (select s_nationkey as nation, count(*) as found from supplier group by 1), c as (select c_nationkey as nation, count(*) as frame from customer group by 1),
b as (select coalesce(f.found, 0) as found, c.frame, sum(coalesce(f.found, 0)) over () as all_found, sum(c.frame) over () as all_frame from c left join f using (nation))
select round(avg(abs(round(found / all_found - frame / all_frame, 6))), 6) as mean_abs_bias, count(*) as n_groups from b where frame / all_frame >= 0.04""")
def mean_abs_bias(spark, sf):
    return measure.mean_absolute_bias(coverage_bias(spark, sf))


@query("precision_recall", """
with c as (select count(*) filter (quality = 1 and n_chars > 800) as tp, count(*) filter (quality <> 1 and n_chars > 800) as fp, count(*) filter (quality = 1 and n_chars <= 800) as fn, count(*) filter (quality <> 1 and n_chars <= 800) as tn from labels join documents using (doc_id))
select tp, fp, fn, tn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(tp / (tp + fp * ((tp + fn) * (1 - 0.3) / ((fp + tn) * 0.3))), 6) as precision_at_base from c""")
def precision_recall(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return measure.precision_recall(d, F.col("quality") == 1, F.col("n_chars") > 800, 0.3)


@query("confusion_counts", "select quality as truth, toxic as predicted, count(*) as n from labels group by 1, 2")
def confusion_counts(spark, sf):
    return measure.confusion(table(spark, sf, "labels"), F.col("quality"), F.col("toxic"))


@query("label_moves", "select case when a.n_chars > 500 then 'long' else 'short' end as old, case when a.n_chars > 900 then 'long' else 'short' end as new, count(*) as n from documents a where doc_id % 4 <> 0 and doc_id % 5 <> 0 group by 1, 2")
def label_moves(spark, sf):
    d = table(spark, sf, "documents")

    def run(rest, cut):
        return d.where(F.col("doc_id") % rest != 0).select("doc_id", F.when(F.col("n_chars") > cut, "long").otherwise("short").alias("label"))

    return measure.label_moves(run(4, 500), run(5, 900), "doc_id", "label")


@query("quantiles", "select o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 3) as p50, round(quantile_cont(o_totalprice, 0.9), 3) as p90, min(o_totalprice) as least, max(o_totalprice) as most, list_sort(list(o_totalprice))[count(*) // 2 + 1] as upper_median from orders group by 1")
def quantiles(spark, sf):
    q = measure.quantiles(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice")
    return q.withColumns({c: F.round(c, 3) for c in ("p50", "p90")})


@query("distance_gate", "select count(*) as n, round(quantile_cont(abs(value - 50), 0.9), 6) as p90, round(max(abs(value - 50)), 6) as most, count(*) >= 10 as tested, quantile_cont(abs(value - 50), 0.9) <= 150 and max(abs(value - 50)) <= 500 as passed from events")
def distance_gate(spark, sf):
    return measure.distance_gate(table(spark, sf, "events").select(F.abs(F.col("value") - 50).alias("d")), "d").withColumns({c: F.round(c, 6) for c in ("p90", "most")})


@query("gate_tally", """
select 'priced' as gate, count(*) as n, count(*) filter (l_extendedprice <= 0) as violations, count(*) > 0 as tested, count(*) filter (l_extendedprice <= 0) = 0 as passed from lineitem
union all select 'untaxed', count(*), count(*) filter (l_tax = 0), true, count(*) filter (l_tax = 0) = 0 from lineitem union all select 'none', 0, 0, false, null""")
def gate_tally(spark, sf):
    li = table(spark, sf, "lineitem")
    out = measure.gate_row(li, "priced", F.col("l_extendedprice") <= 0)
    return out.unionByName(measure.gate_row(li, "untaxed", F.col("l_tax") == 0)).unionByName(measure.gate_row(li.where("false"), "none", F.col("l_tax") == 0))


@query("drift_check", """
with n as (select year(o_orderdate)::int as y, count(*) as n from orders group by 1)
select a.y as year, a.n, b.n as last, round(abs(a.n - b.n) / b.n, 6) as change, coalesce(abs(a.n - b.n) / b.n > 0.02, false) as halts from n a left join n b on b.y = a.y - 1""")
def drift_check(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return measure.drift(n, n.select((F.col("year") + 1).alias("year"), F.col("n").alias("last")), "year", 0.02)


@query("validate_rows", """
with r as (select o_orderkey, case when o_orderkey % 17 = 0 then '' else 'p' || o_orderkey end as position, case when o_orderkey % 19 = 0 then 'guess' else 'none' end as basis, case when o_orderkey % 23 = 0 then 'other' else 'own' end as source_id, case when o_orderkey % 29 = 0 then '1/2/2024' when o_orderkey % 2 = 0 then '2024-01-02' else '' end as expiry from orders)
select problem, count(*) as n from (
  select 'row_position is blank' as problem from r where position = '' union all select 'status_basis is unknown' from r where basis = 'guess'
  union all select 'source_id is another' from r where source_id <> 'own' union all select 'expiry_date is not ISO' from r where expiry <> '' and not regexp_full_match(expiry, '\\d{4}-\\d{2}-\\d{2}')) group by 1""".replace("\\\\", "\\"))
def validate_rows(spark, sf):
    from factloom.sources.files import problems

    k = F.col("o_orderkey")
    r = table(spark, sf, "orders").select(F.when(k % 17 == 0, "").otherwise(F.concat(F.lit("p"), k)).alias("row_position"), F.when(k % 19 == 0, "guess").otherwise("none").alias("status_basis"), F.when(k % 23 == 0, "other").otherwise("own").alias("source_id"), F.when(k % 29 == 0, "1/2/2024").when(k % 2 == 0, "2024-01-02").otherwise("").alias("expiry_date"), *[F.lit("x").alias(c) for c in ("source_url", "source_document", "retrieved_date", "name_verbatim")])
    return problems(r, "own").groupBy("problem").agg(F.count("*").alias("n"))


@query("status_counts", "select count(*) as n, count(*) filter (o_orderstatus = 'F') as located, count(*) filter (o_totalprice < 2000) as leads, greatest(count(*) filter (o_orderstatus = 'F') - count(*) filter (o_totalprice < 2000), 0) as published from orders")
def status_counts(spark, sf):
    a = table(spark, sf, "orders").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("located"), F.count_if(F.col("o_totalprice") < 2000).alias("leads"))
    return a.withColumn("published", F.greatest(F.col("located") - F.col("leads"), F.lit(0).cast("long")))


@query("usage_costs", "select event_type, round(sum(value::decimal(18,6) * 0.15 / 1000 + 0.002)::double, 3) as cost, count(*) as calls from events group by 1")
def usage_costs(spark, sf):
    cost = F.col("value").cast("decimal(18,6)") * F.lit("0.15").cast("decimal(3,2)") / 1000 + F.lit("0.002").cast("decimal(4,3)")
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.sum(cost).cast("double"), 3).alias("cost"), F.count("*").alias("calls"))


@query("existence_two_of_four", """
select p_partkey, flags, case when flags >= 2 then 'review' end as flag, nullif(concat_ws(', ', case when p_size < 8 then 'small' end, case when p_retailprice < 950 then 'cheap' end, case when p_type = 'PROMO' then 'promo' end, case when p_name like '%bolt%' then 'bolt' end), '') as why
from (select *, (p_size < 8)::int + (p_retailprice < 950)::int + (p_type = 'PROMO')::int + (p_name like '%bolt%')::int as flags from part)""")
def existence_two_of_four(spark, sf):
    rules = {"small": F.col("p_size") < 8, "cheap": F.col("p_retailprice") < 950, "promo": F.col("p_type") == "PROMO", "bolt": F.col("p_name").contains("bolt")}
    flags = sum((r.cast("int") for r in rules.values()), F.lit(0))
    return table(spark, sf, "part").select("p_partkey", flags.alias("flags"), F.when(flags >= 2, "review").alias("flag"), F.nullif(F.concat_ws(", ", *[F.when(r, n) for n, r in rules.items()]), F.lit("")).alias("why"))


@query("count_over", "select c_custkey, n from (select c_custkey, count(*) over () as n, row_number() over (order by c_acctbal, c_custkey) as no from customer where c_nationkey < 5) where no <= 20")
def count_over(spark, sf):
    """A page with the count of all: the count is one row, joined, instead of a window over the table."""
    c = table(spark, sf, "customer").where("c_nationkey < 5")
    total = c.agg(F.count("*").alias("n"))
    return c.orderBy("c_acctbal", "c_custkey").limit(20).join(F.broadcast(total)).select("c_custkey", "n")  # one row


@query("distinct_on", "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by value desc, event_id) as no from events) where no = 1")
def distinct_on(spark, sf):
    return candidates.first_per(table(spark, sf, "events"), [F.col("user_id"), F.col("event_type")], F.desc("value"), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("topn_per_group", "select o_custkey, o_orderkey, no as rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as no from orders) where no <= 3")
def topn_per_group(spark, sf):
    from factloom.operators.matching import top_per_group

    return top_per_group(table(spark, sf, "orders"), ["o_custkey"], 3, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("ties_at_best", "select p_brand, p_partkey from (select *, rank() over (partition by p_brand order by p_size desc) as r from part) where r = 1")
def ties_at_best(spark, sf):
    """All rows at the best value: the best is an aggregate, joined back, so no brand is sorted."""
    p = table(spark, sf, "part")
    best = p.groupBy("p_brand").agg(F.max("p_size").alias("best"))
    return p.join(best, "p_brand").where("p_size = best").select("p_brand", "p_partkey")


@query("gap_islands", """
with g as (select user_id, event_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) > interval 2 hour then 1 else 0 end as new from events)
select user_id, event_id, (sum(new) over (partition by user_id order by ts rows unbounded preceding))::bigint as island from g""")
def gap_islands(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    gap = F.unix_micros("ts") - F.unix_micros("_prev") > 7_200_000_000
    return records.islands(e, ["user_id"], "ts", gap).select("user_id", "event_id", "island")


@query("record_assembly", """
with l as (select user_id, event_id, event_type, sum((event_type = 'signup')::int) over (partition by user_id order by event_id rows unbounded preceding) as record from events)
select user_id, record::bigint as record, string_agg(event_type, ' ' order by event_id) as text, count(*) as n_lines from l where record > 0 group by all""")
def record_assembly(spark, sf):
    return records.assembled(table(spark, sf, "events"), ["user_id"], "event_id", F.col("event_type") == "signup", "event_type")


@query("ended_records", """
with l as (select user_id, event_id, event_type, sum((event_type = 'purchase')::int) over (partition by user_id order by event_id desc rows unbounded preceding) as record from events)
select user_id, record::bigint as record, string_agg(event_type, ' ' order by event_id) as text, count(*) as n_lines from l where record > 0 group by all""")
def ended_records(spark, sf):
    return records.ended(table(spark, sf, "events"), ["user_id"], "event_id", F.col("event_type") == "purchase", "event_type")


@query("lookahead_groups", "select conv_id, turn, text from (select *, lead(text) over (partition by conv_id order by turn) as next from conversations) where length(next) > length(text)")
def lookahead_groups(spark, sf):
    return records.headed(table(spark, sf, "conversations"), ["conv_id"], "turn", F.length("next") > F.length("text")).select("conv_id", "turn", "text")


@query("page_furniture", "with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents) select line, count(*) as n from l where line not in (select line from l group by 1 having count(distinct doc_id) >= 3) group by 1 having count(*) >= 2")
def page_furniture(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return records.without_furniture(lines, "doc_id", "line", 3).groupBy("line").agg(F.count("*").alias("n")).where("n >= 2")


@query("explode_towns", """
with r as (select p_partkey, string_split(p_name, ' ')[1] || ', ' || string_split(p_name, ' ')[2] || ' & ' || p_type || ', ' || p_brand as t from part)
select p_partkey, p_brand as state, unnest([string_split(p_name, ' ')[1], string_split(p_name, ' ')[2], p_type]) as town from part""")
def explode_towns(spark, sf):
    p = table(spark, sf, "part")
    words = F.split("p_name", " ")
    text = F.concat(words[0], F.lit(", "), words[1], F.lit(" & "), "p_type", F.lit(", "), "p_brand")
    return records.towns(p.select("p_partkey", text.alias("t")), "t").select("p_partkey", "state", "town")


@query("years_folded", "select o_custkey, string_agg(distinct 'y' || year(o_orderdate), ',' order by 'y' || year(o_orderdate)) as years from orders where year(o_orderdate) between 1996 and 1999 and o_orderstatus = 'F' group by 1")
def years_folded(spark, sf):
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    years = [f"y{y}" for y in range(1996, 2000)]
    wide = o.groupBy("o_custkey").agg(*[F.max(F.when((F.col("y") == int(y[1:])) & (F.col("o_orderstatus") == "F"), "R1")).alias(y) for y in years])
    return records.years_folded(wide, ["o_custkey"], years, "R")


@query("completeness_alarm", "select c_nationkey, max(c_custkey % 60) + 1 as advertised, count(distinct c_custkey % 25) as seen from customer group by 1 having count(distinct c_custkey % 25) * 2 <= max(c_custkey % 60) + 1")
def completeness_alarm(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", (F.col("c_custkey") % 60 + 1).alias("adv"), (F.col("c_custkey") % 25).alias("page"))
    return records.pages_alarm(c, "c_nationkey", "adv", "page")


@query("round_robin", "select s_nationkey, s_suppkey, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey)::int as turn from supplier")
def round_robin(spark, sf):
    return candidates.round_robin(table(spark, sf, "supplier"), "s_nationkey", F.desc("s_acctbal"), F.col("s_suppkey")).select("s_nationkey", "s_suppkey", "turn")


@query("batch_deal", """
with d as (select c_custkey, c_custkey % 15 as batch from customer)
select batch, count(*) as n, sha256(string_agg(c_custkey::varchar, ',' order by c_custkey)) as batch_hash from d group by 1""")
def batch_deal(spark, sf):
    d = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 15).alias("batch"))
    ordered = F.array_join(F.transform(F.sort_array(F.collect_list("c_custkey")), lambda x: x.cast("string")), ",")
    return d.groupBy("batch").agg(F.count("*").alias("n"), F.sha2(ordered, 256).alias("batch_hash"))


@query("seeded_page", "select c_custkey from customer order by md5(c_custkey::varchar || 'seed7') limit 50 offset 100")
def seeded_page(spark, sf):
    return candidates.sampled(table(spark, sf, "customer"), "c_custkey", "seed7", 50, 100).select("c_custkey")


@query("nulls_last_page", "select c_custkey, x from (select c_custkey, case when c_custkey % 3 > 0 then c_acctbal end as x from customer) order by x desc nulls last, c_custkey limit 40")
def nulls_last_page(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("x"))
    return c.orderBy(F.desc_nulls_last("x"), "c_custkey").limit(40)


@query("deferred_groups", "select c_nationkey, n, case when row_number() over (order by n desc, c_nationkey) <= 10 then 'run' else 'deferred' end as queue from (select c_nationkey, count(*) as n from customer group by 1)")
def deferred_groups(spark, sf):
    g = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return g.withColumn("queue", F.when(F.row_number().over(Window.orderBy(F.desc("n"), "c_nationkey")) <= 10, "run").otherwise("deferred"))  # one row a group


@query("budget_prefix", "select s_nationkey, s_suppkey, case when sum(s_acctbal::decimal(18,2)) over (partition by s_nationkey order by s_suppkey rows unbounded preceding) <= 12000 then 'run' else 'deferred' end as queue from supplier")
def budget_prefix(spark, sf):
    s = table(spark, sf, "supplier").withColumn("cost", F.col("s_acctbal").cast("decimal(18,2)"))
    return candidates.within_budget(s, "cost", 12000, F.col("s_suppkey"), group="s_nationkey").select("s_nationkey", "s_suppkey", "queue")


@query("union_sources", "select c_custkey as id, c_name as name, 'customer' as source, null::varchar as segment from customer where false union all select s_suppkey, s_name, 'supplier', null from supplier union all select c_custkey, c_name, 'customer', c_mktsegment from customer")
def union_sources(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("source"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("source"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("union_distinct", "select c_nationkey as nation from customer union select s_nationkey from supplier")
def union_distinct(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("set_intersect", "select c_custkey % 700 as k from customer where c_acctbal > 0 intersect select s_suppkey * 3 from supplier")
def set_intersect(spark, sf):
    return table(spark, sf, "customer").where("c_acctbal > 0").select((F.col("c_custkey") % 700).alias("k")).intersect(table(spark, sf, "supplier").select(F.col("s_suppkey") * 3))


@query("set_except", "select c_custkey % 700 as k from customer except select s_suppkey * 3 from supplier")
def set_except(spark, sf):
    return table(spark, sf, "customer").select((F.col("c_custkey") % 700).alias("k")).subtract(table(spark, sf, "supplier").select(F.col("s_suppkey") * 3))


@query("semi_flags", "select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P') as has_pending, c_custkey in (select o_custkey from orders where o_totalprice > 400000) as has_large from customer")
def semi_flags(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderstatus") == "P").alias("has_pending"), F.bool_or(F.col("o_totalprice") > 400000).alias("has_large"))
    c = table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left")
    return c.select("c_custkey", F.coalesce("has_pending", F.lit(False)).alias("has_pending"), F.coalesce("has_large", F.lit(False)).alias("has_large"))


@query("anti_unattempted", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where year(o_orderdate) >= 2000)")
def anti_unattempted(spark, sf):
    done = table(spark, sf, "orders").where(F.year("o_orderdate") >= 2000).select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("growing_semi", "select l_orderkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY' and c_nationkey < 5))")
def growing_semi(spark, sf):
    """Three passes, each kept to the ids of the one before."""
    c = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY' and c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    o = table(spark, sf, "orders").join(c, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").join(o, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("demand_projects", """
with k as (select event_id, user_id, 'name:' || event_type || '|' || (user_id % 7) as k1, case when event_id % 3 = 0 then 'addr:' || (user_id % 11) end as k2 from events),
old as (select 'name:' || t || '|' || n as key, 'DP-' || lpad((n * 10 + length(t))::varchar, 6, '0') as project from (select distinct event_type as t from events) cross join range(4) r(n)),
hits as (select k.event_id, o.project, 1 as pos from k join old o on o.key = k.k1 union all select k.event_id, o.project, 2 from k join old o on o.key = k.k2)
select k.event_id, arg_min(h.project, h.pos) as project from k left join hits h using (event_id) group by 1""")
def demand_projects(spark, sf):
    """The first of a mention's keys that a project already has decides the project."""
    e = table(spark, sf, "events")
    keys = F.array_compact(F.array(F.concat(F.lit("name:"), "event_type", F.lit("|"), F.col("user_id") % 7), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("addr:"), F.col("user_id") % 11))))
    k = e.select("event_id", F.posexplode(keys).alias("pos", "key"))
    kinds = e.select("event_type").distinct().withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(3))))
    old = kinds.select(F.concat(F.lit("name:"), "event_type", F.lit("|"), "n").alias("key"), F.concat(F.lit("DP-"), F.lpad((F.col("n") * 10 + F.length("event_type")).cast("string"), 6, "0")).alias("project"))
    return k.join(old, "key", "left").groupBy("event_id").agg(F.min_by(F.col("project"), F.when(F.col("project").isNotNull(), F.col("pos"))).alias("project"))
