"""Scans, records, streets, graphs, streams: small cases with known answers."""

import zipfile

import pytest
from pyspark.sql import functions as F

from factloom.functions import streets, text
from factloom.operators import documents, graph, matching
from factloom.sources import files, records
from factloom.streaming import refresh


@pytest.mark.parametrize(
    "a,b,rule",
    [
        ("100 Main Street", "100 MAIN STREET", "exact"),
        ("100 Main Street", "100 Main St", "canonical"),
        ("1505 W Third Ave", "1505 W 3rd Ave", "canonical"),
        ("US Hwy 231", "Highway 231", "canonical"),
        ("US Hwy 231", "Highway 31", "!route_number_differs"),
        ("12 Industrial Rd", "12 Industiral Road", "one_edit"),
        ("12 Oak Rd", "12 Oat Rd", "!street_words_differ"),
        ("840 Palm Ave", "840 Palm St", "!suffix_differs"),
        ("1200 S Lake St", "1200 N Lake St", "!direction_differs"),
        ("5 W Sam Houston Pkwy N", "5 W Sam Houston Pkwy", "!direction_differs"),
        ("", "1 A St", "!missing_street"),
    ],
)
def test_street_rules(a, b, rule):
    assert streets.same_street(a, b) == rule == streets.same_street(b, a)


def test_parcel_and_keys():
    assert streets.same_street("840 Palm Ave", "840 Palm St", parcel=True) == "parcel"
    assert streets.same_street("1200 S Lake St", "1200 N Lake St", parcel=True) == "!direction_differs"
    assert streets.key("1801 E 27th St Terrace") == streets.key("1801 East 27th Terrace") == "1801 e 27th ter"
    assert streets.key("1505 W Third Ave, Suite 4") == "1505 w 3rd ave" and streets.key("P.O. Box 7") == "" and streets.key("5980 W Sam Houston Pkwy N") == "5980 w sam houston pkwy n"
    assert streets.one_edit("abcd", "abdc") and streets.one_edit("abc", "abcd") and not streets.one_edit("abcd", "badc")
    assert streets.place_score("Acme Inc", "ACME LLC") == 1.0 and streets.place_score("Acme Steel Works", "Acme") >= 0.9 and streets.place_score("", "x") == 0.0


def test_text_expressions(spark):
    row = spark.range(1).select(
        text.us_state(F.lit("Varsinais-Suomi")).alias("a"), text.phone_digits(F.lit("1-662-563-4574")).alias("b"), text.norm_city(F.lit("St. Louis")).alias("c"),
        text.norm_name(F.lit("The Truss Company, L.L.C.")).alias("d"), text.own_domain(F.lit("https://m.facebook.com/x")).alias("e"), text.iso_date(F.lit("2/30/2024")).alias("f"),
        text.plausible_number(F.lit("120,000 sq ft"), 500, 2e7).alias("g"), text.whole_word_prefix(F.lit("blue"), F.lit("blue horse")).alias("h"), text.quoted(F.lit("a  b"), F.lit("x a\nb y")).alias("i"),
    ).first()
    assert tuple(row) == ("", "6625634574", "saint louis", "truss", "", "", "120000", False, True)


def test_csv_contract_and_zip(spark, tmp_path):
    columns = [*files.REQUIRED, *files.VERBATIM, *files.OTHER, "website"]
    line = ["s1", "u", "d", "2024-01-01", "1", '"A, ""B"" Co"', "1 Main Street", "St Louis", "missouri", "63101", "US", "", "", "", "none", "", "", "", "no-fixed-plant", "x.com"]
    (tmp_path / "s1.csv").write_text("﻿" + ",".join(columns) + "\n" + ",".join(line) + "\n")
    df = files.contract(spark, str(tmp_path / "s1.csv"))
    row = files.normalised(df).first()
    assert row["name_verbatim"] == 'A, "B" Co' and row["phone"] == "" and row["city_norm"] == "saint louis" and row["state"] == "MO" and row["street_key"] == "1 main st" and row["no_fixed_plant"] and len(row["row_hash"]) == 16
    assert files.problems(df, "s1").count() == 0 and files.problems(df, "s2").count() == 1
    (tmp_path / "bad.csv").write_text("source_id\nx\n")
    with pytest.raises(ValueError, match="missing columns"):
        files.contract(spark, str(tmp_path / "bad.csv"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in.csv", "id,x,y\n1,a,b\n2,,c\n")
    assert sorted(map(tuple, files.zipped_csv(spark, str(tmp_path / "a.zip"), "in.csv", ["id", "x"]).collect())) == [("1", "a"), ("2", "")]
    reg = files.registry(spark, [{"id": "a", "class": "A", "status": "active"}, {"id": "b", "class": "lookup", "status": "active"}, {"id": "c", "class": "B", "status": "paused"}])
    assert [r["source_id"] for r in reg.where("runs").collect()] == ["a"]
    paths = spark.createDataFrame([("raw/source=a/date=2024-01-01/x",), ("raw/source=a/date=2024-02-01/x",), ("raw/source=b/none/x",)], "path string")
    assert [r["date"] for r in files.newest_part(paths).collect()] == ["2024-02-01"]
    assert files.sql(spark, "select count(*) as n from t where id > :least", {"t": spark.range(5)}, least=2).first()["n"] == 2


def test_records(spark):
    df = spark.createDataFrame([(1, "Lane, Aurora & Salem, OR")], "id int, t string")
    assert [(r["town"], r["state"]) for r in records.towns(df, "t").collect()] == [("Lane", "OR"), ("Aurora", "OR"), ("Salem", "OR")]
    assert documents.table_rows("<table><tr><th>A<td>b &amp; c</td></tr><tr></tr><tr><td> d <i>e</i></td></tr></table>") == [["A", "b & c"], ["d e"]]


def test_components_and_chains(spark):
    nodes = spark.range(1, 1200).select(F.col("id").alias("node"))
    edges = nodes.where("node % 100 <> 99 and node < 1198").select(F.col("node").alias("a"), (F.col("node") + 1).alias("b"))
    got = {r["node"]: r["component"] for r in graph.components(nodes, edges).collect()}
    assert got[99] == 1 and got[199] == 100 and got[1199] == 1199 and len(set(got.values())) == 13
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100)], "node bigint, into bigint")
    roots = {r["node"]: r["root"] for r in graph.follow(chain).collect()}
    assert {roots[i] for i in range(1, 40)} == {40} and roots[100] is None and roots[101] is None


def test_fuzzy_pairs_lose_nothing_to_the_bounds(spark):
    import itertools
    from difflib import SequenceMatcher

    names = ["acme steel", "acme stele", "acmesteel", "banker steel", "bankers steel", "zeta", "zetas", "a", "b"]
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(names)], "g int, id int, name string")
    got = {(r["ta"], r["tb"]) for r in matching.fuzzy_pairs(df, ["g"], "id", "name", 0.85).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(names), 2) if SequenceMatcher(None, a, b).ratio() >= 0.85}


def test_greedy_goes_rung_by_rung(spark):
    edges = spark.createDataFrame([("g", "a", "x", 1), ("g", "b", "x", 0), ("g", "a", "y", 2)], "g string, l string, r string, rung int")
    got = {(r["l"], r["r"]) for r in matching.greedy_one_to_one(edges, "l", "r", "rung", ["l", "r"], "g").collect()}
    assert got == {("b", "x"), ("a", "y")}


def test_stream_equals_rebuild_and_replay_changes_nothing(spark, tmp_path):
    from factloom.operators.survivorship import golden
    from factloom.operators.tables import read_version
    from tests import test_survivorship as ts

    rows = ts.facts(9, 240)
    for i in range(3):
        ts.frame(spark, rows[i * 80 : (i + 1) * 80]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    step = refresh.refresher(spark, str(tmp_path / "out"), ts.RULES, ts.FIELDS)
    refresh.run_available(refresh.fact_stream(spark, str(tmp_path / "in"), ts.SCHEMA), step, str(tmp_path / "cp"))
    want = ts.as_dict(golden(ts.frame(spark, rows), ts.RULES, ts.FIELDS))
    assert ts.as_dict(read_version(spark, str(tmp_path / "out/golden"))) == want == ts.plain_golden(rows)
    step(ts.frame(spark, rows[160:]), 2)
    assert ts.as_dict(read_version(spark, str(tmp_path / "out/golden"))) == want


def test_late_events_change_nothing(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "e"))
    q = refresh.hourly_counts(stream).writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) as n from hourly").first()["n"] == spark.read.parquet(str(tmp_path / "e")).count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = entry.queries()
    assert len(names) > 100 and set(entry.oracle_sql()) <= set(names)


def test_quotes_of_any_length_are_found(spark):
    from factloom.operators.documents import quote_pairs

    pages = ["the quick brown fox jumps over the lazy dog and sleeps", "quick", "a  quick\nbrown foxes", "(quick brown fox) über alles", "x y", "", "the lazy dogs over the lazy dog", "the lazy dogs over the lazy dog"]
    base = pages[0].split()
    quotes = [" ".join(base[i : i + n]) for n in range(1, 10) for i in range(len(base) - n + 1)]
    quotes += ["uic", "ck bro", "ick brown fo", "k", "q", "x", "über", "er alle", "the lazy dog", "fox ", " \n", "quick  brown", "zebra", "the the", "k brown foxe", "quick brown", "quick brown", "own fox jumps over th", "e lazy dogs over t", "(", "fox)"]
    q = spark.createDataFrame(list(enumerate(quotes)), "item_id int, quote string")
    p = spark.createDataFrame([(i, x) for i, x in enumerate(pages)] + [(99, None)], "doc_id int, page string")
    flat = lambda x: " ".join(x.split())
    want = sorted((i, j) for i, x in enumerate(quotes) for j, y in enumerate(pages) if flat(x) and flat(x) in flat(y))
    assert sorted(tuple(r) for r in quote_pairs(q, p, "quote", "page").select("item_id", "doc_id").collect()) == want


def test_customers_of_any_id_take_part_in_greedy_match(spark, tmp_path):
    from factloom.plans import load

    spark.sql("select 1L as s_suppkey, 3 as s_nationkey, 10.0D as s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql("select 150000L as c_custkey, 3 as c_nationkey, 20.0D as c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    assert [(r["control"], r["entity"]) for r in load()[0]["greedy_match"](spark, str(tmp_path)).collect()] == [(1, 150000)]


def test_parts_of_any_key_take_part_in_recall_rungs(spark, tmp_path):
    from factloom.plans import load

    spark.sql("select * from values (2L, 'Red Bolt', 'b', 't'), (7L, 'Red Bolt', 'b', 't') as t(p_partkey, p_name, p_brand, p_type)").write.parquet(f"{tmp_path}/part.parquet")
    assert [(r["control"], r["entity"]) for r in load()[0]["recall_rungs"](spark, str(tmp_path)).collect()] == [(2, 7)]


def geo_tables(spark, path, customers, suppliers):
    spark.createDataFrame([(k, 1) for k in customers], "c_custkey bigint, c_nationkey int").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(k, 1) for k in suppliers], "s_suppkey bigint, s_nationkey int").write.parquet(f"{path}/supplier.parquet")


def sql_rows(path, name):
    import duckdb

    from factloom.plans import load

    con = duckdb.connect()
    for t in ("customer", "supplier"):
        con.execute(f"create view {t} as select * from read_parquet('{path}/{t}.parquet/*.parquet')")
    return sorted(con.execute(load()[1][name]).fetchall())


def test_nearest_of_two_sides_is_that_of_the_sql(spark, tmp_path):
    from factloom.plans import load

    geo_tables(spark, tmp_path, [*range(1000), 3750], range(1000))
    got = load()[0]["nearest_in_radius"](spark, str(tmp_path)).select("id", "oid", "distance_m")
    assert sorted(map(tuple, got.collect())) == sql_rows(tmp_path, "nearest_in_radius")


def crowded(spark, monkeypatch, path, name):
    """A query's rows are the SQL's where many rows stand at one place, and each place is met once."""
    from factloom.operators import geo
    from factloom.plans import load

    geo_tables(spark, path, [i + 1000 * j for i in range(20) for j in range(30)] + [5], [i + 1000 * j for i in range(0, 20, 2) for j in range(35)])
    met, within = [], geo.within
    monkeypatch.setattr(geo, "within", lambda p, o, m: met.append((p.count(), o.count())) or within(p, o, m))
    got = load()[0][name](spark, str(path))
    names = [d for d in ("id", "oid", "area", "distance_m", "decision", "building_id") if d in got.columns]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(sql_rows(path, name), key=str)
    assert met == [(20, 10)]


def test_largest_meets_every_place_once(spark, tmp_path, monkeypatch):
    crowded(spark, monkeypatch, tmp_path, "largest_in_radius")


def test_building_decision_meets_every_place_once(spark, tmp_path, monkeypatch):
    crowded(spark, monkeypatch, tmp_path, "building_decision")


def test_crosswalk_keeps_one_facility_a_place_and_word(spark, monkeypatch):
    from factloom.operators import review

    control = spark.createDataFrame([(i, f"Acme Works {i % 3}", "Town", "TX") for i in range(40)], "control_id long, name string, city string, state string")
    places = spark.createDataFrame([(i, i, f"Works Acme {i % 3}", "Town", "TX") for i in range(50, 90)] + [(50, 50, "Acme Zinc 1", "Town", "TX")], "ord long, facility_id long, name string, city string, state string")
    counts, kind, join = [], type(control), type(control).join
    monkeypatch.setattr(kind, "join", lambda a, b, on=None, how=None: counts.append(join(a, b, on, how)) or counts[-1])
    got = review.crosswalk_candidates(control, places, control.where("control_id = 0").select("control_id", F.col("control_id").alias("facility_id")))
    monkeypatch.undo()
    want = [(i, 50, "acme", min(" ".join(sorted({"acme", "works", str(i % 3)} & w)) for w in ({"acme", "works", "2"}, {"acme", "zinc", "1"}))) for i in range(1, 40)]
    assert sorted(map(tuple, got.collect())) == want
    assert max(x.count() for x in counts) <= 2 * 3 * 41


def test_parcel_duplicates_judge_kinds_and_give_all_pairs(spark, monkeypatch):
    from factloom.operators import research
    from factloom.plans import research as plans

    rows = plans.firms(spark, "/root/testdata/sf0.1").where("id < 900")
    pairs = research.parcel_pairs(rows.withColumn("variants", research.name_variants(F.col("name")))).withColumn("street", streets.street_rule("a_address", "b_address")).where("not startswith(street, '!')")
    want = sorted(map(tuple, pairs.select("a_id", "b_id", "street", research.name_tier("a_", "b_")).collect()))
    monkeypatch.setattr(plans, "firms", lambda *_: rows)
    got = plans.parcel_duplicates(spark, "")
    assert len(want) > 30000 and sorted(map(tuple, got.collect())) == want
    assert research.parcel_kinds(rows).count() < len(want)


@pytest.mark.parametrize("one_way", [False, True])
def test_survivors_of_kinds_are_those_of_all_pairs(spark, one_way):
    from factloom.operators import research
    from factloom.plans import research as plans

    tiers = ["certain", "likely", "review"]
    rows = plans.firms(spark, "/root/testdata/sf0.1").where("id < 500 and (id % 60 < 25 or id % 7 = 0)")
    kinds = research.parcel_kinds(rows).withColumn("tier", F.split_part("tier", F.lit(":"), F.lit(1)))
    kinds = kinds.where("tier <> 'certain' or a_kind = b_kind and crc32(a_kind) % 2 = 0" + (" or a_kind < b_kind" if one_way else ""))
    kinds = graph.keep(kinds, "test-kinds")
    pairs, links = research.of_kinds(rows, kinds), graph.keep(research.kind_links(rows, kinds, tiers), "test-links")
    want, got = (sorted(map(tuple, research.survivors_by_tier(p, rows.select("id", "weight"), tiers, "weight").collect())) for p in (pairs, links))
    assert got == want and len({x[2] for x in got}) > 1
    assert links.count() < pairs.count()


def test_recall_walk_assigns_what_a_walk_over_all_pairs_does(spark):
    import random

    from factloom.operators import research

    rng = random.Random(4)
    names = ["Red Bolt", "Red Bolt Co.", "Red Bolt Works", "Red Bolt Works East", "Red", "Redwoodmill", "Redwoodmill Inc", "Redwoodmill Two", "Inc.", "", None]
    some = lambda n, ids: [(rng.randrange(ids), rng.choice(names), rng.choice(["b", "c", "", None]), rng.choice(["s", "t", "", None])) for _ in range(n)]
    for ids in (40, 100000):
        c, e = (spark.createDataFrame(some(120, ids), f"{x} long, name string, city string, state string") for x in ("control", "entity"))
        edges = research.recall_edges(c, e).groupBy("control", "entity").agg(F.min("rung").alias("rung")).withColumn("one", F.lit(1))
        want = matching.greedy_one_to_one(edges, "control", "entity", "rung", ["control", "entity"], "one").drop("one")
        want = sorted(map(tuple, want.collect()))
        assert sorted(map(tuple, research.recall_assigned(c, e).collect())) == want and {x[2] for x in want} >= {0, 1}


def test_look_alikes_give_each_pair_once_without_sorting_out_all(spark):
    from factloom.operators import research

    kind = "name string, state string, address string, city string"
    new = spark.createDataFrame([(1, "Red Co", "TX", "1 A", "X"), (1, "Blue", "TX", "2 B", "X"), (1, "Red Inc", "TX", "1 a", "x"), (2, "Red", "TX", "1 A", "X"), (None, "Red", "TX", "", "")], f"id long, {kind}")
    golden = spark.createDataFrame([(7, "Red", "TX", "1 A", "X"), (7, "Blue", "TX", "2 B", "X"), (8, "Red", "TX", "", "X"), (8, "Red", "TX", "", "X")], f"entity long, {kind}")
    got = sorted(map(tuple, research.look_alikes(new, golden).collect()), key=str)
    assert got == sorted([(1, 7, "name"), (1, 8, "name"), (1, 7, "address"), (2, 7, "name"), (2, 8, "name"), (2, 7, "address"), (None, 7, "name"), (None, 8, "name")], key=str)
    plan = research.look_alikes(new, golden)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union")
