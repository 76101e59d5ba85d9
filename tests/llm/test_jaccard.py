import random
import re

import numpy as np
import pytest

from factloom.llm import jaccard, sets


def brute(rows, k, t):
    def shingles(x):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    s = [shingles(x) for _, x in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= t * len(s[i] | s[j]):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(s[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    boiler = some(40)
    docs = []
    for _ in range(12):
        base = some(rng.choice([3, 6, 10, 30, 80, 150]))
        for _ in range(rng.choice([1, 2, 5, 40])):
            d = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                d[rng.randrange(len(d))] = rng.choice(vocabulary).upper()
            docs.append(" ".join(d))
    docs += [" ".join(boiler + some(rng.randint(0, 12))) for _ in range(60)]
    docs += ["", None, " \n", "one", "ONE", "a b c", "a  b\tc", "É b c d", "é b c d"]
    rng.shuffle(docs)
    return [(i * 3, d) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed,t", [(1, 85), (2, 85), (3, 60)])
def test_equals_brute_force(spark, seed, t):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, jaccard.join(df, 4, t).collect())) == brute(rows, 4, t)


def test_edges(spark):
    df = spark.createDataFrame([(1, "a b", 1, 2), (1, "a b", 1, 2), (0, "a b", 3, 4), (5, None, 3, 4)], "doc_id bigint, text string, cls int, key int")
    assert sorted(map(tuple, jaccard.join(df).collect())) == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (5, 0, 5)]
    assert jaccard.join(df.limit(0)).count() == 0


def test_ids_null_and_text(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "x y z")], "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard.join(df).collect()), key=str) == [(7, 2, 7), (None, 1, None), (None, 2, 7)]
    df = spark.createDataFrame([("12", "a b c d e"), ("x9", "a b c d e")], "doc_id string, text string")
    assert sorted(map(tuple, jaccard.join(df).collect()), key=str) == [(12, 2, 12), (None, 2, 12)]


def test_very_long_text(spark):
    rng = random.Random(9)
    words = ["w%d" % rng.randrange(10**6) for _ in range(300_000)]
    changed = list(words)
    for i in range(0, 300_000, 200):
        changed[i] = "other"
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[:200_000]))], "doc_id bigint, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()) == [(1, 1), (2, 1), (3, 3)]


@pytest.mark.parametrize("t", [60, 80, 85, 95])
def test_keys_and_bits_keep_every_pair(t):
    import pyarrow as pa

    rng, near = np.random.default_rng(5), 0
    for _ in range(1500):
        n = int(rng.choice([rng.integers(1, 20), rng.integers(20, 400)]))
        own = rng.integers(0, 2**63, n, dtype=np.uint64)
        less, more = rng.integers(0, max(1, n * (100 - t) // 150) + 1, 2)
        a, b = np.unique(own), np.unique(np.concatenate([own[: n - less], rng.integers(0, 2**63, more, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) == 0 or both == len(a) == len(b) or 100 * both < t * (len(a) + len(b) - both):
            continue
        near += 1
        first, tokens = np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b])
        row, key = sets.part_keys(first, tokens, t)
        assert np.isin(key[row == 0], key[row == 1]).any()
        signs = sets.Signs(np.diff(first), pa.array(sets.odd_bits(first, tokens, t), pa.binary()))
        assert signs.near(np.array([0]), np.array([1]), t).all()
    assert near > 300


def test_frequent_keys_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(sets, "FREQUENT", 3)
    monkeypatch.setattr(sets, "LOCAL", 2)
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, jaccard.join(df, 4, 85).collect())) == brute(rows, 4, 85)


def test_a_row_that_stands_for_others_meets_their_partners(spark):
    """b is near only to a, all of whose keys are frequent in a's batch and led there by sets that are far from b."""
    rng = np.random.default_rng(3)

    def cls(words):
        text = " ".join(words).encode()
        return int(sets.classes(*sets.unit_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 1))[0])

    a = max(([f"w{i}x{j}" for j in range(40)] for i in range(300)), key=cls)
    far = [[f"v{i}x{j}" if j in gone else w for j, w in enumerate(a)] for i in range(1000) for gone in [set(rng.permutation(40)[:10].tolist())]]
    one = [(i + 10, " ".join(w)) for i, w in enumerate(far)] + [(1, " ".join(a))]
    two = [(2, " ".join([*a[:-2], "other"]))]
    sc = spark.sparkContext
    df = spark.createDataFrame(sc.union([sc.parallelize(x, 1) for x in (one, two)]), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(df, 1, 85).collect()}
    assert got[1] == got[2] == 1 and [got[i] for i, _ in one[:-1]] == [i for i, _ in one[:-1]]


def test_linked_equals_all_pairs():
    rng = np.random.default_rng(2)
    for turn in range(20):
        bases = [rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64) for _ in range(4)]
        found = []
        for _ in range(80):
            base = bases[rng.integers(0, 4)]
            keep = base[rng.random(len(base)) < rng.choice([1.0, 0.97, 0.9])]
            found.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, 5), dtype=np.uint64)])))
        found = [s for s in found if len(s)]
        first = np.concatenate([[0], np.cumsum([len(s) for s in found])])
        edges = jaccard.linked(first, np.concatenate(found), 85)
        got, want = sets.Union(), sets.Union()
        for a, b in edges:
            got.join(a, b)
        for i in range(len(found)):
            for j in range(i):
                both = len(np.intersect1d(found[i], found[j]))
                if 100 * both >= 85 * (len(found[i]) + len(found[j]) - both):
                    want.join(i, j)
        assert [got.find(i) for i in range(len(found))] == [want.find(i) for i in range(len(found))]


def test_parts_of_a_family_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(sets, "GROUP", 2500)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, jaccard.join(df, 4, 85).collect())) == brute(rows, 4, 85)
