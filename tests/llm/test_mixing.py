import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from factloom.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = float(sum(sizes.values())), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            return fixed | {s: left * weight[s] / total for s in open_}
        for s in over:
            fixed[s] = float(most * sizes[s])
        left = sum(sizes.values()) - sum(fixed.values())


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for s, n in (("a", 400), ("b", 9), ("c", 40), (None, 30), ("é", 60), ("Z", 1)):
        rows += [(None, " ".join("w%d" % i for i in range(rng.choice([0, 1, 7, 60, 900]))), s) for _ in range(n)]
    rng.shuffle(rows)
    return [(i * 2, t, s) for i, (_, t, s) in enumerate(rows)] + [(5001, None, "a"), (5003, "\x1c", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_contract(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(a, b, c, 1, 2) for a, b, c in rows], "doc_id bigint, text string, source string, size int, start int").repartition(3)
    got = mixing.mix(df).collect()
    sizes, words = defaultdict(int), {}
    for i, t, s in rows:
        words[i] = len([w for w in (t or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w])
        sizes[s] += words[i]
    want, taken = plain_targets(sizes), defaultdict(int)
    assert sorted(r["doc_id"] for r in got) == sorted(words)
    for r in got:
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, 0.01 * t, 256), (s, taken[s], t)
    assert sorted(map(tuple, mixing.mix(df.repartition(2)).collect()), key=str) == sorted(map(tuple, got), key=str)
    out = mixing.take(df).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in out} == {s: n for s, n in taken.items() if n}


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, "c", None), (2, "", "x"), (3, None, "x")], "doc_id bigint, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 5 and sum(r["taken"] for r in got) == 5
    assert {r["target"] for r in got if r["source"] == "x"} == {0.0}
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.take(df.limit(0)).count() == 0
    assert mixing.mix(df.where("source = 'x'")).agg(F.sum("taken")).first()[0] == 0


def test_any_prefix_of_the_schedule_keeps_the_shares(spark):
    df = spark.createDataFrame([(i, "w " * 5000, "s%d" % (i % 4)) for i in range(40)], "doc_id bigint, text string, source string")
    goals = mixing.targets(mixing.sized(df))
    slots = sorted((r["slot"], r["sidx"]) for r in mixing.schedule(goals).collect())
    share = {r["sidx"]: r["slots"] for r in goals.collect()}
    total = sum(share.values())
    for upto in (50, 200, 700):
        for s, n in share.items():
            assert abs(sum(x == s for _, x in slots[:upto]) - upto * n / total) < 6


def test_take_leaves_columns_of_any_name(spark):
    rows = [(i, "a b c d", "s%d" % (i % 2), 7, 10 + i, "x") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int, _words int, _keep string")
    out = mixing.take(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    got = out.collect()
    assert got and all(r["_words"] == 10 + r["doc_id"] and r["_keep"] == "x" and r["n_chars"] == len(r["text"]) for r in got)
