import hashlib
import random
import re

import pytest

from factloom.llm import lines


def brute(rows, k, t, least_words):
    def shingles(x):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if len(w) >= least_words else set()

    every, out = [], {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for x in (text or "").split("\n"):
            s = shingles(x)
            if not (s and any(100 * len(s & e) >= t * len(s | e) for e in every if e)):
                kept.append(x)
            every.append(s)
        out[d] = ("\n".join(kept), len((text or "").split("\n")) - len(kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(150)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    pool = [some(rng.choice([2, 5, 6, 12, 30, 60])) for _ in range(14)]
    docs = []
    for _ in range(70):
        out = []
        for _ in range(rng.randint(0, 7)):
            line = list(rng.choice(pool)) if rng.random() < 0.6 else some(rng.randint(1, 40))
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(words)
            if rng.random() < 0.3:
                line = line + some(rng.randint(1, 3))
            out.append(" ".join(line))
        docs.append("\n".join(out) + rng.choice(["", "", "\n", "\n\n"]))
    return [(i * 2, d) for i, d in enumerate(docs)] + [(1001, None), (1003, ""), (1005, "\n"), (1007, docs[0]), (1009, docs[0])]


@pytest.mark.parametrize("seed,t", [(1, 80), (2, 80), (3, 60)])
def test_equals_brute_force(spark, seed, t):
    rows = corpus(seed)
    df = spark.createDataFrame([(a, b, a) for a, b in rows], "doc_id bigint, text string, key bigint").repartition(3)
    got = {r["doc_id"]: r["text"] for r in lines.dedup(df, t=t).collect()}
    want = brute(rows, 5, t, 5)
    assert {d: x or "" for d, x in got.items()} == {d: x for d, (x, _) in want.items()}
    assert got[1001] is None and sum(n for _, n in want.values()) > 40
    report = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in lines.dedup(df, t=t, report=True).collect()}
    assert report == {d: (n, hashlib.sha256(x.encode()).hexdigest()) for d, (x, n) in want.items()}


def test_parts_of_a_family_lose_nothing(spark, monkeypatch):
    from factloom.llm import sets

    monkeypatch.setattr(sets, "GROUP", 2000)
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert {r["doc_id"]: r["text"] or "" for r in lines.dedup(df).collect()} == {d: x for d, (x, _) in brute(rows, 5, 80, 5).items()}


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e\nA B  C d e"), (1, "a b c d e\nA B  C d e"), (2, "x\nx")], "doc_id bigint, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in lines.dedup(df).collect()) == [(0, "a b c d e"), (1, ""), (1, ""), (2, "x\nx")]
    assert lines.dedup(df.limit(0)).count() == 0


def test_short_lines_equal_brute_force(spark, tmp_path):
    rows = corpus(4) + [(2001, "Home\nx\nAll rights reserved."), (2003, "home\n\nall  rights reserved.\nrights all reserved."), (2005, "X\nx y\nHOME")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows, 5, 80, 1)
    assert want[2003] == ("\nrights all reserved.", 2) and want[2005] == ("x y", 2)
    got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in lines.op10_lines(spark, str(tmp_path)).collect()}
    assert got == {d: (n, hashlib.sha256(x.encode()).hexdigest()) for d, (x, n) in want.items()}


def test_columns_of_any_name_and_text_ids(spark):
    rows = [("7", "a b c d e\nf g", 1, 2, 3), ("10", "a b c d e\nz z", 4, 5, 6), ("x", "q r s t u", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id string, Text string, _key int, _gone int, kind int")
    out = lines.dedup(df, report=False)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [("10", "z z", 4, 5, 6), ("7", "a b c d e\nf g", 1, 2, 3), ("x", "q r s t u", 7, 8, 9)]


def test_very_long_line(spark):
    rng = random.Random(1)
    line = " ".join("w%d" % rng.randrange(10**6) for _ in range(200_000))
    df = spark.createDataFrame([(1, line), (2, "x\n" + line + " more"), (3, line[: len(line) // 2])], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in lines.dedup(df).collect()} == {1: line, 2: "x", 3: line[: len(line) // 2]}


def test_prefixes_are_dealt_in_runs_and_meet_whole(spark, monkeypatch):
    import numpy as np

    from factloom.llm import sets

    monkeypatch.setattr(sets, "DEAL", 100)
    docs = spark.createDataFrame(corpus(6), "doc_id bigint, text string").repartition(3)
    level = np.arange(sets.SKETCH) % 3
    packed = sets.prefixes(docs, 5, 80, level.astype(np.uint8), 1, 7)
    runs = [(r["part"], np.frombuffer(r["cells"], sets.CELL)) for r in packed.collect()]
    assert sum(len(c) for _, c in runs) > 500 > 10 * len(runs) and {p for p, _ in runs} == set(range(7))
    of = {token: p for p, c in runs for token in c["token"].tolist()}
    assert all(of[token] == p for p, c in runs for token in c["token"].tolist())
    size = np.bincount(list(of.values()))
    assert size.max() < 2 * size.mean()
    want = set()
    for text in {x for _, d in corpus(6) for x in (d or "").split("\n")}:
        first, tokens = sets.unit_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), 5, level)
        n, cls = len(tokens), int(sets.classes(first, tokens).view(np.int64)[0])
        if 100 * n >= 80 * (n + 1):
            want |= {(int(x), cls, i) for i, x in enumerate(tokens[: sets.prefix_length(n, 80)].view(np.int64))}
    assert {x for _, c in runs for x in c.tolist()} == want
    count = {}
    for token, _, _ in want:
        count[token] = count.get(token, 0) + 1
    got = [tuple(r) for r in sets.shared_cells(packed, "cells").collect()]
    assert sorted(got) == sorted(x for x in want if count[x[0]] > 1) and got
