import random

import numpy as np
import pytest

from factloom.llm import common, rolling


@pytest.mark.parametrize("most", [500_000, 0])
def test_components_both_ways(spark, monkeypatch, most):
    monkeypatch.setattr(common, "ONE_TASK", most)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 90) if i % 30 != 29] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(5, 5), (-7, 400)]
    label = {i: i for i in [*range(0, 401), -7]}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    nodes = spark.createDataFrame([(i,) for i in label], "node bigint")
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(3), nodes).collect()
    assert {r["node"]: r["component"] for r in got} == label
    assert common.components(spark.createDataFrame([], "a bigint, b bigint"), nodes.limit(3)).count() == 3


def test_hashes_depend_on_bytes_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 3000)
    ends = starts + rng.integers(1, 40, 3000)
    by_words, by_sums = {}, {}
    for s, e, x, y in zip(starts, ends, rolling.word_hashes(data, starts, ends).tolist(), rolling.span(rolling.sums(data), starts, ends).tolist()):
        by_words.setdefault(x, set()).add(bytes(data[s:e]))
        by_sums.setdefault(y, set()).add(bytes(data[s:e]))
    kinds = len({bytes(data[s:e]) for s, e in zip(starts, ends)})
    assert len(by_words) == len(by_sums) == kinds and all(len(v) == 1 for v in [*by_words.values(), *by_sums.values()])
