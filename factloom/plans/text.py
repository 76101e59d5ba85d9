"""Normalisers and validators over names, places and values made from the tables' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import streets, text
from factloom.operators import measure
from factloom.plans.registry import query, table

_PLAIN = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_LEGAL = r"\b(inc|llc|l l c|corp|corporation|co|company|ltd|the)\b"
_NORM = "trim(regexp_replace(regexp_replace(" + _PLAIN + ", '" + _LEGAL + "', ' ', 'g'), ' +', ' ', 'g'))"
#: Customers under made-up firm names, and places, phones, addresses and URLs in several notations.
_MADE = """
with made as (
  select c_custkey as id, case c_custkey % 5 when 0 then 'The ' || c_name || ', Inc.' when 1 then upper(c_name) || ' L.L.C.' when 2 then c_name || ' Company' when 3 then '' else c_mktsegment || ' & Co (' || c_name || ')' end as name,
    case c_custkey % 6 when 0 then 'St. Louis' when 1 then 'Mt Vernon' when 2 then 'FT. WORTH' when 3 then 'Saint  Paul' when 4 then 'Fort Mount-Saint' else null end as city,
    case c_custkey % 7 when 0 then 'texas' when 1 then ' New   York ' when 2 then 'ca' when 3 then 'Ontario' when 4 then '' when 5 then 'XX' else 'District of Columbia' end as state,
    case c_custkey % 5 when 0 then '(' || lpad((c_custkey % 900 + 100)::varchar, 3, '0') || ') 555-0' || lpad((c_custkey % 1000)::varchar, 3, '0') when 1 then '1-800-555-0' || lpad((c_custkey % 1000)::varchar, 3, '0') when 2 then '555-0199' when 3 then null else '2125550' || lpad((c_custkey % 1000)::varchar, 3, '0') || ' x' end as phone,
    case c_custkey % 4 when 0 then c_custkey || ' Main Street, Suite 4, Austin TX 73301-' || lpad((c_custkey % 10000)::varchar, 4, '0') when 1 then 'P.O. Box ' || c_custkey || ', Austin TX 73301' when 2 then c_custkey || 'B Elm' else null end as address,
    case c_custkey % 6 when 0 then 'HTTPS://www.Firm' || c_custkey || '.com/about?x=1' when 1 then 'firm' || c_custkey || '.co.uk' when 2 then 'http://sites.google.com/view/x' when 3 then 'localhost/x' when 4 then 'http://user@shop.firm.org:8080/#a' else '' end as url,
    c_acctbal
  from customer
)"""


def made(spark, sf):
    def pick(n, *values):
        k = F.col("c_custkey") % n
        out = F.when(k == 0, values[0])
        for i, v in enumerate(values[1:], 1):
            out = out.when(k == i, v) if i < len(values) - 1 else out.otherwise(v)
        return out

    s, nil = F.lit, F.lit(None).cast("string")
    k3, k4, key = F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        pick(5, F.concat(s("The "), "c_name", s(", Inc.")), F.concat(F.upper("c_name"), s(" L.L.C.")), F.concat("c_name", s(" Company")), s(""), F.concat("c_mktsegment", s(" & Co ("), "c_name", s(")"))).alias("name"),
        pick(6, s("St. Louis"), s("Mt Vernon"), s("FT. WORTH"), s("Saint  Paul"), s("Fort Mount-Saint"), nil).alias("city"),
        pick(7, s("texas"), s(" New   York "), s("ca"), s("Ontario"), s(""), s("XX"), s("District of Columbia")).alias("state"),
        pick(5, F.concat(s("("), F.lpad((F.col("c_custkey") % 900 + 100).cast("string"), 3, "0"), s(") 555-0"), k3), F.concat(s("1-800-555-0"), k3), s("555-0199"), nil, F.concat(s("2125550"), k3, s(" x"))).alias("phone"),
        pick(4, F.concat(key, s(" Main Street, Suite 4, Austin TX 73301-"), k4), F.concat(s("P.O. Box "), key, s(", Austin TX 73301")), F.concat(key, s("B Elm")), nil).alias("address"),
        pick(6, F.concat(s("HTTPS://www.Firm"), key, s(".com/about?x=1")), F.concat(s("firm"), key, s(".co.uk")), s("http://sites.google.com/view/x"), s("localhost/x"), s("http://user@shop.firm.org:8080/#a"), s("")).alias("url"),
        "c_acctbal",
    )


@query("norm_name", _MADE + f" select id, {_NORM.format('name')} as norm, {_PLAIN.format('name')} as light, replace({_NORM.format('name')}, ' ', '') as squashed, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') as alnum from made")
def norm_name(spark, sf):
    n = F.col("name")
    return made(spark, sf).select("id", text.norm_name(n).alias("norm"), text.light_name(n).alias("light"), text.name_key(n).alias("squashed"), text.alnum(n).alias("alnum"))


@query("name_tokens", _MADE + f""", t as (select id, unnest(list_distinct(string_split({_PLAIN.format("name")}, ' '))) as token from made)
select id, count(*) filter (token <> '') as n_tokens, string_agg(token, ' ' order by token) filter (length(token) > 1 and not regexp_full_match(token, '[0-9]+') and token not in ('the', 'co', 'inc', 'company')) as distinctive from t group by id""")
def name_tokens(spark, sf):
    generic = ["the", "co", "inc", "company"]
    d = F.sort_array(text.distinctive_tokens(F.col("name"), generic))
    return made(spark, sf).select("id", F.size(text.tokens(F.col("name"))).cast("long").alias("n_tokens"), F.nullif(F.array_join(d, " "), F.lit("")).alias("distinctive"))


@query("city_norm", _MADE + r""", p as (select id, """ + _PLAIN.format("coalesce(city, '')") + r""" as c, lower(coalesce(city, '')) as raw from made)
select id, array_to_string(list_transform(string_split(c, ' '), lambda w: case w when 'st' then 'saint' when 'ste' then 'sainte' when 'mt' then 'mount' when 'ft' then 'fort' else w end), ' ') as city_norm,
  replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '[^a-z0-9 ]', '', 'g'), '\bfort\b', 'ft', 'g'), '\bmount\b', 'mt', 'g'), '\bsaint\b', 'st', 'g'), ' ', '') as city_key from p""")
def city_norm(spark, sf):
    return made(spark, sf).select("id", text.norm_city(F.col("city")).alias("city_norm"), text.city_key(F.col("city")).alias("city_key"))


@query("us_state", _MADE + " select id, case id % 7 when 0 then 'TX' when 1 then 'NY' when 2 then 'CA' when 6 then 'DC' else '' end as state from made")
def us_state(spark, sf):
    return made(spark, sf).select("id", text.us_state(F.col("state")).alias("state"))


@query("phone_digits", _MADE + r""", d as (select id, regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') as d from made)
select id, case when length(d) = 10 then d when length(d) = 11 and d[1] = '1' then d[2:] else '' end as digits, case when length(d) >= 10 then right(d, 10) else '' end as last10 from d""")
def phone_digits(spark, sf):
    return made(spark, sf).select("id", text.phone_digits(F.col("phone")).alias("digits"), text.phone_last10(F.col("phone")).alias("last10"))


@query("address_parts", _MADE + r""" select id, regexp_extract(split_part(coalesce(address, ''), ',', 1), '^\s*([0-9]+)\b', 1) as house,
  regexp_extract(coalesce(address, ''), '([0-9]{5})(-[0-9]{4})?\s*$', 1) as zip_end, case when length(regexp_replace(coalesce(address, ''), '[^0-9]', '', 'g')) >= 5 then left(regexp_replace(coalesce(address, ''), '[^0-9]', '', 'g'), 5) else '' end as zip5,
  coalesce(regexp_matches(address, '^\s*[0-9]+\s+\S') and not regexp_matches(lower(address), 'p\.?\s*o\.?\s*box'), false) as physical from made""")
def address_parts(spark, sf):
    a = F.col("address")
    return made(spark, sf).select("id", text.house_number(a).alias("house"), text.trailing_zip(a).alias("zip_end"), text.zip5(a).alias("zip5"), text.physical_street(a).alias("physical"))


@query("place_street_key", _MADE + r""", w as (select id, string_split(trim(regexp_replace(regexp_replace(upper(coalesce(address, '')), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), ' ') as w from made)
select id, coalesce(list_filter(w, lambda x: regexp_full_match(x, '[0-9]+'))[1], '') as number,
  array_to_string(list_sort(list_distinct(list_filter(w, lambda x: length(x) >= 3 and not regexp_full_match(x, '[0-9]+') and x not in ('STREET', 'SUITE', 'BOX', 'ATTN', 'ROAD', 'AVE', 'AVENUE', 'BLVD', 'BOULEVARD', 'DRIVE', 'LANE', 'WAY', 'COURT', 'PLACE', 'HWY', 'HIGHWAY', 'PKWY', 'PARKWAY', 'STE', 'UNIT', 'BLDG', 'BUILDING')))), ' ') as words from w""")
def place_street_key(spark, sf):
    return made(spark, sf).select("id", text.place_number(F.col("address")).alias("number"), F.array_join(text.place_words(F.col("address")), " ").alias("words"))


@query("host_of_url", _MADE + """ select id, case id % 6 when 0 then 'firm' || id || '.com' when 1 then 'firm' || id || '.co.uk' when 2 then 'sites.google.com' when 3 then 'localhost' when 4 then 'shop.firm.org' else '' end as host,
  case id % 6 when 0 then 'firm' || id || '.com' when 1 then 'firm' || id || '.co.uk' when 4 then 'shop.firm.org' else '' end as own_domain,
  case id % 6 when 0 then 'https://firm' || id || '.com/' when 1 then 'https://firm' || id || '.co.uk/' when 2 then 'https://sites.google.com/' when 3 then 'https://localhost/' when 4 then 'https://shop.firm.org/' else '' end as homepage from made""")
def host_of_url(spark, sf):
    u = F.col("url")
    return made(spark, sf).select("id", text.host(u).alias("host"), text.own_domain(u).alias("own_domain"), text.homepage(u).alias("homepage"))


@query("page_hosts", """select page_id, regexp_replace(regexp_extract(lower(trim(url)), '^[a-z]+://([^/:?#]*)', 1), '^www\\.', '') as host,
  case when regexp_matches(lower(url), '^[a-z]+://(www\\.)?the') then 'company_site' else 'other' end as kind from pages""")
def page_hosts(spark, sf):
    p = table(spark, sf, "pages")
    h = text.host(F.col("url"))
    return p.select("page_id", h.alias("host"), text.source_kind(F.col("url"), F.when(h.startswith("the"), h).otherwise("none")).alias("kind"))


@query("row_hash", """select c_custkey, left(sha256(c_name || chr(31) || c_nationkey || chr(31) || c_mktsegment || chr(31)), 16) as row_hash,
  left(sha256(c_custkey || chr(31) || 'name' || chr(31) || c_name || chr(31)), 16) as assertion_id, left(sha256('geocode' || chr(31) || lower(c_name) || chr(31)), 32) as cache_key from customer""")
def row_hash(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", text.hashed(F.col("c_name"), F.col("c_nationkey"), F.col("c_mktsegment")).alias("row_hash"), text.hashed(F.col("c_custkey"), F.lit("name"), F.col("c_name")).alias("assertion_id"), text.hashed(F.lit("geocode"), F.lower("c_name"), length=32).alias("cache_key"))


@query("iso_date_quarter", """select o_orderkey, case when o_orderkey % 5 = 4 then '' else strftime(o_orderdate, '%Y-%m-%d') end as iso, case when o_orderkey % 5 < 4 then year(o_orderdate) || 'Q' || quarter(o_orderdate) end as quarter from orders""")
def iso_date_quarter(spark, sf):
    o = table(spark, sf, "orders")
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    printed = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, F.date_format(d, "MM/dd/yyyy")).when(k == 3, F.date_format(d, "MMMM d, yyyy")).otherwise("soon")
    iso = text.iso_date(printed)
    return o.select("o_orderkey", iso.alias("iso"), text.quarter(iso).alias("quarter"))


@query("plausible_number", """select event_id, case when value between 10 and 150 then round_even(value, 0)::bigint::varchar end as value, case when json_extract(props, '$.k')::bigint between 10 and 150 then json_extract(props, '$.k')::bigint::varchar end as k from events""")
def plausible_number(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", text.plausible_number(F.concat(F.lit("about "), F.format_string("%.2f", "value"), F.lit(" units")), 10, 150).alias("value"), text.plausible_number(F.col("props"), 10, 150).alias("k"))


@query("edit_distance", """select a.n_nationkey as a, b.n_nationkey as b, levenshtein(lower(a.n_name), lower(b.n_name)) as distance, levenshtein(lower(a.n_name), lower(b.n_name)) <= 1 as minor
  from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey""")
def edit_distance(spark, sf):
    n = table(spark, sf, "nation")
    a, b = n.select(F.col("n_nationkey").alias("a"), "n_regionkey", F.col("n_name").alias("x")), n.select(F.col("n_nationkey").alias("b"), "n_regionkey", F.col("n_name").alias("y"))
    return a.join(b, "n_regionkey").where("a < b").select("a", "b", F.levenshtein(F.lower("x"), F.lower("y")).cast("long").alias("distance"), text.minor_correction(F.col("x"), F.col("y"), 1).alias("minor"))


@query("prefix_names", """
with n as (select distinct p_name as name from part union select p_name || ' works' from part where p_partkey % 9 = 0 union select split_part(p_name, ' ', 1) from part where p_partkey % 5 = 0)
select a.name as a, b.name as b from n a join n b on length(a.name) < length(b.name) and starts_with(b.name, a.name || ' ') and (contains(a.name, ' ') or length(a.name) >= 8)""")
def prefix_names(spark, sf):
    """Names that begin another at a word's end; the join key is the first word, which both share."""
    p = table(spark, sf, "part")
    n = p.select(F.col("p_name").alias("name")).union(p.where("p_partkey % 9 = 0").select(F.concat("p_name", F.lit(" works")))).union(p.where("p_partkey % 5 = 0").select(F.split_part("p_name", F.lit(" "), F.lit(1)))).distinct()
    n = n.withColumn("head", F.split_part("name", F.lit(" "), F.lit(1)))
    a, b = n.select("head", F.col("name").alias("a")), n.select("head", F.col("name").alias("b"))
    return a.join(b, "head").where(F.length("a") < F.length("b")).where(text.whole_word_prefix(F.col("a"), F.col("b"))).select("a", "b")


@query("check_values", """
with v as (select o_orderkey as id, case o_orderkey % 8 when 0 then 'state' when 1 then 'zip' when 2 then 'lat_lon' when 3 then 'website' when 4 then 'email' when 5 then 'phone' when 6 then 'sq_ft' else 'capability' end as field, o_custkey % 2 = 0 as good, o_custkey % 11 = 0 as blank from orders)
select case when blank then 'blank' when good then 'passed' else case field when 'state' then 'not a state code' when 'zip' then 'not a ZIP code' when 'lat_lon' then 'not a coordinate' when 'website' then 'not a URL' when 'email' then 'not an e-mail address' when 'phone' then 'not a phone number' when 'sq_ft' then 'out of range' else 'not in the taxonomy' end end as reason, count(*) as n from v group by 1""")
def check_values(spark, sf):
    fields = ["state", "zip", "lat_lon", "website", "email", "phone", "sq_ft", "capability"]
    good = ["TX", "73301-0001", "30.1,-97.2", "https://a.com/x", "a@b.co", "(212) 555-0100", "12000", "truss"]
    bad = ["ZZ", "7330", "130.1,-97.2", "nowhere", "a@b", "555-0100", "12", "cakes"]
    o = table(spark, sf, "orders")
    at = (F.col("o_orderkey") % 8 + 1).cast("int")
    value = F.when(F.col("o_custkey") % 11 == 0, " ").when(F.col("o_custkey") % 2 == 0, F.element_at(F.array(*map(F.lit, good)), at)).otherwise(F.element_at(F.array(*map(F.lit, bad)), at))
    return measure.by_reason(o, text.check_value(F.element_at(F.array(*map(F.lit, fields)), at), value, ["truss", "panel"]))


@query("street_key")
def street_key(spark, sf):
    s = table(spark, sf, "supplier")
    kinds = ["Street", "St.", "Avenue Suite 4", "3rd Road Unit B", "Third Rd", "Sam Houston Parkway N", "E 27th St Terrace"]
    address = F.concat(F.col("s_suppkey"), F.lit(" North Oak "), F.element_at(F.array(*map(F.lit, kinds)), (F.col("s_suppkey") % 7 + 1).cast("int")))
    return s.select("s_suppkey", streets.street_key(address).alias("street_key"), streets.street_parts(address).alias("parts"))


@query("street_equivalent")
def street_equivalent(spark, sf):
    left = ["100 Main Street", "US Hwy 231", "840 Palm Ave", "12 Industrial Rd", "5 Sam Houston Pkwy N", "1 Third Ave"]
    right = ["100 Main St", "Highway 231", "840 Palm St", "12 Industiral Road", "5 Sam Houston Pkwy", "1 3rd Avenue"]
    s = table(spark, sf, "supplier")
    i, j = (F.col("s_suppkey") % 6 + 1).cast("int"), (F.expr("s_suppkey div 6") % 6 + 1).cast("int")
    a, b = F.element_at(F.array(*map(F.lit, left)), i), F.element_at(F.array(*map(F.lit, right)), j)
    return s.select("s_suppkey", a.alias("a"), b.alias("b"), streets.street_rule(a, b).alias("rule"))


@query("name_score")
def name_score(spark, sf):
    s = table(spark, sf, "supplier")
    a = F.concat(F.lit("Acme Building "), F.col("s_suppkey") % 10, F.lit(" LLC"))
    return s.select("s_suppkey", streets.name_score(a, F.lit("ACME BUILDING 3 INC")).alias("score"))


@query("quote_exact", """
select item_id, doc_id from benchmark b join documents d on trim(regexp_replace(b.text, '\\s+', ' ', 'g')) <> '' and contains(trim(regexp_replace(d.text, '\\s+', ' ', 'g')), trim(regexp_replace(b.text, '\\s+', ' ', 'g')))""")
def quote_exact(spark, sf):
    """Benchmark passages that stand word for word in documents; the join key is a rare run of words."""
    from factloom.operators import documents

    b = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("quote"))
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("page"))
    return documents.quote_pairs(b, d, "quote", "page").select("item_id", "doc_id")
