"""Intake and releases over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import intake
from factloom.operators import release
from factloom.plans.registry import query, table


def pick(k, values: list[str]):
    """The value whose turn it is."""
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def case(k: str, values: list[str]) -> str:
    quoted = [v.replace("'", "''") for v in values]
    return f"(['{"', '".join(quoted)}'])[{k} % {len(values)} + 1]"


_KEYS = ["The Acme Company of North Road, Inc.", "ACME 12 Highway Drive", "12 South Parkway Court LLC", "Lane & Boulevard Co"]


@query("intake_key", "select s_suppkey, " + case("s_suppkey", ["acme n rd", "acme 12 hwy dr", "12 s pkwy ct", "ln blvd"]) + " || ' ' || s_suppkey as key from supplier")
def intake_key(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", intake.intake_key(F.concat(pick(k, _KEYS), F.lit(" #"), k)).alias("key"))


_LINES = [
    "{0} N STATE ROAD 39, LA PORTE, IN 46350", "{0} Mill Rd,  Saint Augusta, MN 76055- 4900", "{0} A St, BEDFORD, OHIO 44146", "{0} King St, Guelph, Ontario N1H 3A1",
    "{0} Pine, Suite 4, Dallas, TX 75103 -", "PO Box {0}", "{0} Quai, Quebec", "{0} Elm St, Salem, or.",
]
_LINE_PARTS = [
    ("{0} N STATE ROAD 39", "LA PORTE", "IN", "46350", "US"), ("{0} Mill Rd", "Saint Augusta", "MN", "76055-4900", "US"), ("{0} A St", "BEDFORD", "OH", "44146", "US"), ("{0} King St", "Guelph", "ON", "N1H3A1", "CA"),
    ("{0} Pine, Suite 4", "Dallas", "TX", "75103", "US"), ("PO Box {0}", "", "", "", "US"), ("{0} Quai", "", "QC", "", "CA"), ("{0} Elm St, Salem, or.", "", "", "", "US"),
]


@query("split_address", "select s_suppkey, " + ", ".join(f"replace({case('s_suppkey', [p[i] for p in _LINE_PARTS])}, '{{0}}', s_suppkey::varchar) as {n}" for i, n in enumerate(["street", "city", "state", "zip", "country"])) + " from supplier")
def split_address(spark, sf):
    k = F.col("s_suppkey")
    line = F.replace(pick(k, _LINES), F.lit("{0}"), k.cast("string"))
    return table(spark, sf, "supplier").select("s_suppkey", intake.split_address(line).alias("p")).select("s_suppkey", "p.*")


@query("city_state_zip", "select s_suppkey, " + case("s_suppkey", ["Houston", "Mt. Airy", "nowhere at all", ""]) + " as city, " + case("s_suppkey", ["TX", "NC", "", ""]) + " as state, " + case("s_suppkey", ["77020", "", "", ""]) + " as zip from supplier")
def city_state_zip(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", intake.split_city_state_zip(pick(F.col("s_suppkey"), ["Houston, TX 77020", "Mt. Airy NC.", "nowhere at all", " "])).alias("p")).select("s_suppkey", "p.*")


_VALUES = [
    ("phone", "+1 (212) 555-0100", "212.555.0100", True), ("zip", "46350-1234", "46350", True), ("website", "https://www.a.com/x", "a.com", True), ("state", "ohio", "OH", True), ("state", "TX", "OK", False),
    ("email", "A@B.co", "a@b.co", True), ("name", "Acme Steel Homes of Ohio Inc", "The Acme Steel Homes of Ohio", True), ("name", "Acme Steel", "Acme Wood", False), ("name", "", "", False), ("sq_ft", "12,000", "12000", True), ("phone", "", "", False),
]


@query("same_value", "select s_suppkey, " + case("s_suppkey", [v[0] for v in _VALUES]) + " as field, (" + str([v[3] for v in _VALUES]).lower() + f")[s_suppkey % {len(_VALUES)} + 1] as same from supplier")
def same_value(spark, sf):
    f, a, b = (pick(F.col("s_suppkey"), [v[i] for v in _VALUES]) for i in range(3))
    return table(spark, sf, "supplier").select("s_suppkey", f.alias("field"), intake.same_value(f, a, b).alias("same"))


_SITES = [("84 Lumber", "Mt. Airy Truss Plant", "84 Lumber — Mt. Airy Truss Plant"), ("The Truss Company", "Sumner, WA", "The Truss Company"), ("Acme", "ACME West", "ACME West"), ("", "Plant 2", "Plant 2"), ("Acme", "", "")]


@query("establishment_name", "select s_suppkey, " + case("s_suppkey", [x[2] for x in _SITES]) + " as name, s_suppkey % 3 = 0 as millwork from supplier")
def establishment_name(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", intake.establishment_name(pick(k, [x[0] for x in _SITES]), pick(k, [x[1] for x in _SITES])).alias("name"), intake.millwork_only(pick(k, ["Door shop", "door and truss plant", "Retail"])).alias("millwork"))


@query("witnessed_street", "select s_suppkey, case when s_suppkey % 6 in (0, 3) then s_name else '' end as street from supplier")
def witnessed_street(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", intake.witnessed_street(F.col("s_name"), pick(k, ["Ohio", "TX", "nowhere"]), pick(k, ["OH", "Ohio", "", "oh", "texas!", ""])).alias("street"))


@query("keyword_vetoes", "with d as (select doc_id, lower(coalesce(text, '')) as t from documents) select doc_id, list_filter(['control house', 'modular', 'panels', 'steel', 'data'], lambda w: regexp_matches(t, '(^|[^a-z0-9])' || w || '($|[^a-z0-9])')) as terms from d")
def keyword_vetoes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", intake.vetoes(F.col("text"), ["data", "steel", "modular", "control house", "panels"]).alias("terms"))


_CONTACTS = [
    ("email", "NoReply@x.com", "", "", "an opt-out or no-reply mailbox"), ("email", "sales@x.com", "", "", None), ("phone", "1234567890", "Florida Taxpayer Number 1234567890", "", "the quote gives an identification number, not a phone"),
    ("phone", "2125550100", "License office phone 2125550100", "", None), ("phone", "1234567890", "1234567890", "https://r.gov/entity/1234567890", "the number is the page's own identifier on an ID register, not a phone"), ("phone", "2125550100", "2125550100", "https://yellow.com/2125550100", None),
]


@query("junk_contacts", "select s_suppkey, nullif(" + case("s_suppkey", [c[4] or "" for c in _CONTACTS]) + ", '') as why from supplier")
def junk_contacts(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", intake.junk_contact(*(pick(F.col("s_suppkey"), [c[i] for c in _CONTACTS]) for i in range(4))).alias("why"))


@query("small_footprint", "select s_suppkey, " + "([9907, 2829, 17461, 3779, 5081, 10002, 6647, 6647])[s_suppkey % 8 + 1] as least from supplier")
def small_footprint(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", intake.small_footprint(pick(F.col("s_suppkey"), ["332311", "3212141", "321991", "321992", "321213", "332312", "9", ""])).alias("least"))


@query("all_columns", "select c_custkey::varchar as key, c_name as name, c_mktsegment as segment, '' as balance from customer union all select s_suppkey::varchar, coalesce(s_name, ''), '', s_nationkey::varchar from supplier")
def all_columns(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return release.with_all_columns(c, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("balance")))


@query("release_load", "select r_name, count(*) as n from region join nation on r_regionkey = n_regionkey group by all")
def release_load(spark, sf):
    """Two tables of a release, read again by the pointer."""
    import uuid

    from factloom.operators.graph import shared

    root = f"{shared(spark)}/release-{uuid.uuid4().hex}"
    release.load_release(spark, root, "r1", {"dim": table(spark, sf, "region").limit(0), "fact": table(spark, sf, "nation")})
    release.load_release(spark, root, "r2", {"dim": table(spark, sf, "region"), "fact": table(spark, sf, "nation")})
    dim, fact = (release.read_release(spark, root, n) for n in ("dim", "fact"))
    return dim.join(fact, dim["r_regionkey"] == fact["n_regionkey"]).groupBy("r_name").agg(F.count("*").alias("n"))


_STAGES = "select o_custkey % 50 as run_id, (['acquire', 'resolve', 'publish'])[o_orderkey % 3 + 1] as stage, o_custkey % 7 as source, o_orderkey * 60 as began, o_orderkey * 60 + 90 as ended, o_orderkey % 11 as rows, o_orderkey % 13 <> 0 as ok from orders"


@query("run_records", f"select run_id, round((max(ended) - min(began)) / 60, 1) as minutes, count(distinct source) as sources, coalesce(sum(rows) filter (stage = 'acquire'), 0)::bigint as candidates, coalesce(sum(rows) filter (stage = 'publish'), 0)::bigint as published, count(*) filter (not ok) as failed from ({_STAGES}) group by 1")
def run_records(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    return release.run_record(o.select((F.col("o_custkey") % 50).alias("run_id"), pick(k, ["acquire", "resolve", "publish"]).alias("stage"), (F.col("o_custkey") % 7).alias("source"), (k * 60).alias("began"), (k * 60 + 90).alias("ended"), (k % 11).alias("rows"), (k % 13 != 0).alias("ok")))


@query("halted_sources", "select o_orderkey, o_custkey from orders where o_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
def halted_sources(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("source_id"))
    return release.halted(o, o.where("o_totalprice > 400000")).select("o_orderkey", F.col("source_id").alias("o_custkey"))


@query("source_dispatch", """with old as (select o_custkey as s, arg_max('a/' || o_orderkey, o_orderkey) as p from (select o_custkey, o_orderkey, rank() over (partition by o_custkey order by o_orderdate desc, 'a/' || o_orderkey desc) as r from orders) where r = 1 group by 1)
select c_custkey as source_id, case when c_nationkey = 3 then null when c_custkey % 4 = 1 then 'f/' || c_custkey else old.p end as path, case when c_nationkey = 3 then 'skipped' when c_custkey % 4 = 1 then 'fetched' when old.p is not null then 'archived' else 'failed' end as state from customer left join old on s = c_custkey""")
def source_dispatch(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    key = F.col("c_custkey").alias("source_id")
    fetched = c.where("c_custkey % 2 = 1").select(key, F.concat(F.lit("f/"), "c_custkey").alias("path"), (F.col("c_custkey") % 4 == 1).alias("ok"))
    archived = o.select(F.col("o_custkey").alias("source_id"), F.col("o_orderdate").alias("date"), F.concat(F.lit("a/"), "o_orderkey").alias("path"))
    return release.dispatch(c.select(key, F.when(F.col("c_nationkey") == 3, "lookup").otherwise("A").alias("class")), fetched, archived)


@query("archive_copy", "select 'p' || p_partkey as path, p_size as size from part where not (p_partkey % 5 <> 0 and p_partkey % 3 <> 0)")
def archive_copy(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("p"), "p_partkey").alias("path"), F.col("p_size").alias("size"))
    return release.to_copy(p, p.where("p_partkey % 5 <> 0").withColumn("size", F.when(F.col("p_partkey") % 3 == 0, F.col("size") + 1).otherwise(F.col("size"))))


@query("carried_forward", "select 'f' || p_partkey || '.csv' as file, 'new' as path from part where p_partkey % 2 = 0 union all select 'f' || p_partkey || case when p_partkey % 5 = 0 then '_hand.csv' else '.csv' end, 'old' from part where p_partkey % 5 = 0 or (p_partkey % 2 = 1 and p_partkey % 10 = 7)")
def carried_forward(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part")
    new = p.where(k % 2 == 0).select(F.concat(F.lit("f"), k, F.lit(".csv")).alias("file"), F.lit("new").alias("path"))
    old = p.select(F.concat(F.lit("f"), k, F.when(k % 5 == 0, "_hand.csv").otherwise(".csv")).alias("file"), F.lit("old").alias("path"))
    return release.carried_forward(new, old, ["%\\_hand.csv", "%7.csv"])


_PAGES = "select o_custkey as source_id, count(*) as k, count(*) filter (o_orderkey % 4 > 1) as full_, max(o_orderkey % 30) as said, sum(case when o_orderkey % 4 > 1 then o_orderkey % 4 - 1 else 0 end) as rows_ from orders group by 1"


@query("page_alarms", f"with p as ({_PAGES}) select source_id, 'half of the pages are empty' as alarm from p where full_ * 2 <= k union all select source_id, 'advertised pages are missing' from p where said > k union all select source_id, 'fewer rows than pages' from p where rows_ < k")
def page_alarms(spark, sf):
    k = F.col("o_orderkey")
    return release.pages_missing(table(spark, sf, "orders").select(F.col("o_custkey").alias("source_id"), k.alias("page"), F.when(k % 4 > 1, k % 4 - 1).otherwise(0).alias("n"), (k % 30).alias("advertised")))


@query("header_pick", "select c_custkey, c_mktsegment as picked from customer")
def header_pick(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.col(release.first_column(c, "segment", "category")).alias("picked"))


@query("dedupe_by_key", "select p_partkey from (select p_partkey, p_size % 10 = 0 and p_brand = 'Brand#11' as blank, row_number() over (partition by case when p_size % 10 = 0 and p_brand = 'Brand#11' then 'b' || p_partkey else p_size || '|' || p_brand end order by p_partkey) as r from part) where r = 1")
def dedupe_by_key(spark, sf):
    none = (F.col("p_size") % 10 == 0) & (F.col("p_brand") == "Brand#11")
    return release.first_kept(table(spark, sf, "part"), [F.when(~none, F.col("p_size").cast("string")), F.when(~none, F.col("p_brand"))], "p_partkey").select("p_partkey")
