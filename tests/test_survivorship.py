"""Ranks, ties, exclusions and refresh against a plain row-by-row version."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from factloom.operators import incremental, survivorship, tables
from factloom.operators.survivorship import Rules

RULES = Rules(["employee_feedback", "operator", "site_visit", "class:A", "class:B"], {"name": ["operator", "class:B", "basis:rooftop"], "existence_flag": ["operator", "basis:web_verdict"]})
FIELDS = ["name", "city", "existence_flag"]
SCHEMA = "entity bigint, field string, value string, source string, source_class string, retrieved string, asserted_at string, basis string, site_visit boolean, confidence double, row_hash string, ord bigint"


def plain_rank(f, order):
    human, n = ("employee_feedback", "operator"), len(order)
    if f["source"] in ("ai_search", "manual_web_lookup", "web_research"):
        for i, t in enumerate(order):
            if t == f["source"] or (f["source"] == "web_research" and t == f"basis:{f['basis']}"):
                return i
        if f["source"] == "web_research" and f["basis"] in ("web_verified", "web_primary"):
            auto = next((i for i, t in enumerate(order) if t not in (*human, "site_visit")), n)
            return auto - 0.5 + (0.25 if f["basis"] == "web_primary" else 0) - 0.1 * (f["confidence"] or 0)
        return n + 1
    if f["source"] == "monitor_fix" and "monitor_fix" not in order:
        return next((i for i, t in enumerate(order) if t not in human), n) - 0.7
    if f["basis"] == "street_interpolated":
        return n + 2
    for i, t in enumerate(order):
        if (t == "site_visit" and f["site_visit"]) or t in (f["source"], f"class:{f['source_class']}", f"basis:{f['basis']}"):
            return i
    return n


def plain_golden(facts):
    groups = defaultdict(list)
    for f in sorted(facts, key=lambda f: f["ord"]):
        groups[f["entity"], f["field"]].append(f)
    out = defaultdict(dict)
    for (e, field), rows in groups.items():
        order = RULES.fields.get(field, RULES.default)
        best = min(plain_rank(f, order) for f in rows)
        tied = [f for f in rows if plain_rank(f, order) == best]
        top = max((f["retrieved"] or "", f["asserted_at"] or "", f["row_hash"] if f["source"] == "employee_feedback" else "") for f in tied)
        won = next(f for f in tied if (f["retrieved"] or "", f["asserted_at"] or "", f["row_hash"] if f["source"] == "employee_feedback" else "") == top)
        out[e][field] = (won["value"], won["source"])
    return {e: v for e, v in out.items() if not (v.get("existence_flag", ("",))[0] in ("closed", "not_ic") and v["existence_flag"][1] in ("operator", "employee_feedback", "web_research"))}


def facts(seed, n=900):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        field = rng.choice(["name", "name", "city", "existence_flag"])
        value = rng.choice(["closed", "active", "not_ic"]) if field == "existence_flag" else rng.choice("uvwxyz")
        out.append({"entity": rng.randrange(80), "field": field, "value": value, "source": rng.choice(["s1", "s2", "operator", "employee_feedback", "web_research", "ai_search", "monitor_fix"]), "source_class": rng.choice("ABC"), "retrieved": rng.choice(["2024-01-01", "2024-02-01", None]), "asserted_at": rng.choice([None, "t1", "t2"]), "basis": rng.choice(["rooftop", "web_verified", "web_primary", "web_verdict", "street_interpolated", "none", None]), "site_visit": rng.random() < 0.1, "confidence": rng.choice([None, 0.7, 0.8]), "row_hash": f"{i:04d}", "ord": i})
    return out


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA).repartition(3)


def as_dict(df):
    return {r["entity"]: {f: (r[f], r[f"{f}__source"]) for f in FIELDS if r[f] is not None} for r in df.collect()}


def test_winners_and_exclusions(spark):
    for seed in (1, 2):
        rows = facts(seed)
        assert as_dict(survivorship.golden(frame(spark, rows), RULES, FIELDS)) == plain_golden(rows)


def test_any_sequence_of_increments_equals_a_rebuild(spark):
    rows = facts(3, 300)
    df = frame(spark, rows[:100])
    golden = survivorship.golden(df, RULES, FIELDS)
    for lo in (100, 200):
        new = frame(spark, rows[lo : lo + 100])
        df = df.unionByName(new)
        golden, held = incremental.refresh(golden, df, new, RULES, FIELDS)
        assert held.count() == 0
    assert as_dict(golden) == plain_golden(rows)


def test_a_loss_is_held(spark):
    rows = [r for r in facts(4, 200) if r["field"] != "existence_flag"]
    df = frame(spark, rows)
    golden = survivorship.golden(df, RULES, FIELDS)
    losing = df.where("not (entity % 2 = 0 and field = 'city')")
    after, held = incremental.refresh(golden, losing, df.select("entity"), RULES, FIELDS, hold_losses=True)
    had = {e for e, v in as_dict(golden).items() if e % 2 == 0 and "city" in v and "name" in v}
    assert {r["entity"] for r in held.collect()} == had
    assert {e: v for e, v in as_dict(after).items() if e in had} == {e: v for e, v in as_dict(golden).items() if e in had}


def test_versions_and_plans(spark, tmp_path):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    tables.write_version(df, str(tmp_path / "t"), "1")
    tables.write_version(df.where("id < 5"), str(tmp_path / "t"), "2", "part")
    assert tables.read_version(spark, str(tmp_path / "t")).count() == 5
    done = []
    expected = tables.plan_hash(df)
    assert tables.apply_plan(df.repartition(3), expected, done.append) == expected and len(done) == 1
    try:
        tables.apply_plan(df.where("id > 0"), expected, done.append)
        raise AssertionError
    except ValueError:
        assert len(done) == 1
    fresh, again = tables.append_if_absent(df, df, ["id"])
    assert fresh.count() == 0 and again.count() == 10
    assert tables.widen(df, {"x": "string", "id": "string"}).dtypes == [("id", "bigint"), ("part", "bigint"), ("x", "string")]
