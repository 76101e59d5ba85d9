import math
import random

import numpy as np
import pytest

from factloom.llm import neighbours


def brute(rows, k):
    seen = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in seen:
        if q % 50 == 0:
            found = [(-np.dot(a, b) / math.sqrt(np.dot(a, a)) / math.sqrt(np.dot(b, b)), i) for i, b in seen if i != q and len(b) == len(a)]
            out[q] = sorted((round(s, 9), i) for s, i in found)[:k]
    return out


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, rank string")
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0"), **kw).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], round(-r["score"], 9), r["vec_id"]))
    return {q: [(s, i) for _, s, i in sorted(v)] for q, v in got.items()}


def test_small_tables_are_exact(spark):
    rng = random.Random(4)
    one = [float(np.float32(rng.gauss(0, 1))) for _ in range(6)]
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(6)]) for i in range(240)]
    rows += [(i, one) for i in range(300, 420)] + [(500, one), (500, one), (501, None), (502, []), (503, [0.0] * 6), (504, [1.0, None] * 3)]
    rows += [(505, [float("nan")] * 6), (506, [float("inf")] + [1.0] * 5), (None, one), (550, [1.0, 2.0]), (551, [2.0, 1.0])]
    got = result(spark, rows, shard=100)
    assert got == brute(rows, 5)
    assert got[500] == [(-1.0, i) for i in range(300, 305)] and len(got[550]) == 1
    assert result(spark, rows[:1]) == {}


def test_recall(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((3000, 32)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got, want = result(spark, rows, shard=800), brute(rows, 5)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_vectors_of_any_magnitude(spark):
    rows = [(50, [1e200, 1e200]), (1, [1e200, 2e200]), (2, [1.0, 1.0]), (3, [1e-310, 1.1e-310]), (100, [3e-320, 0.0]), (4, [-1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r["query_id"], r["vec_id"], r["score"]) for r in neighbours.nearest(df, df.where("vec_id % 50 = 0"), 2).orderBy("query_id", "rank").collect()]
    assert [g[:2] for g in got] == [(50, 2), (50, 3), (100, 2), (100, 50)] and got[0][2] == pytest.approx(1.0, abs=1e-15)
    assert got[2][2] == got[3][2] == pytest.approx(2**-0.5)

