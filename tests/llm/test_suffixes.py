import hashlib
import random

import numpy as np
import pytest

from factloom.llm import common, suffixes


def brute(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p : p + length], []).append((i, p))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p : p + length] = b"\1" * length
    out = []
    for t, g in zip(texts, gone):
        kept = bytes(b for b, x in zip(t, g) if not x)
        out.append((len(t), sum(g), len([1 for x in bytes(g).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, words=30):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdé ñ") for _ in range(rng.randint(1, 9))) for _ in range(words)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [some(25) for _ in range(4)]
    docs = []
    for _ in range(60):
        parts = [some(rng.randint(0, 30)) for _ in range(rng.randint(1, 4))]
        for s in shared:
            if rng.random() < 0.4:
                cut = rng.randint(0, len(s) // 2)
                parts.insert(rng.randint(0, len(parts)), s[cut : cut + rng.randint(40, len(s))])
        docs.append("".join(parts))
    docs += [docs[0], docs[0], docs[1], "", "x" * 500, "x" * 90, "xy" * 300, docs[3] + docs[3], "short"]
    return docs


@pytest.mark.parametrize("seed,most", [(1, 5000), (2, 5000), (3, 1)])
def test_equals_brute_force(spark, seed, most):
    docs = corpus(seed)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id bigint, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in suffixes.remove(rows, 60, gram=12, most=most).collect()}
    want = brute([t.encode() for t in docs], 60)
    assert [got[i] for i in range(len(docs))] == want
    assert sum(w[1] > 0 for w in want) > 20


def test_edges(spark):
    rows = [(None, "a" * 300, 1, "x"), (1, None, 2, "y"), (1, "", 3, None), (2, "b" * 199, 4, "z"), (2, "b" * 199, 4, "z"), (3, "c" * 200, 1, "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key int, h string")
    got = sorted([tuple(r)[:4] for r in suffixes.remove(df).collect()], key=str)
    assert got == sorted([(None, 300, 300, 1), (1, 0, 0, 0), (1, 0, 0, 0), (2, 199, 0, 0), (2, 199, 0, 0), (3, 200, 0, 0)], key=str)
    assert suffixes.remove(df.limit(0)).count() == 0


def test_long_texts_are_cut_without_loss():
    parts = list(suffixes.pieces(100, 10, 30))
    assert {p for i, j in parts for p in range(i, j - 9)} == set(range(91)) and sum(j - i - 9 for i, j in parts) == 91


def test_longest_previous_factor():
    data = np.frombuffer(b"abracadabra", np.uint8)
    text = bytes(data)
    want = [max(k for k in range(len(text) - i + 1) if k == 0 or text.find(text[i : i + k]) < i) for i in range(len(text))]
    assert list(suffixes.longest_previous_factor(data)) == want
    starts = np.arange(len(b"xxabcdefghijyyabcdefghijzz") - 9)
    earlier, later = suffixes.repeated_starts(np.frombuffer(b"xxabcdefghijyyabcdefghijzz", np.uint8), starts, 10)
    assert list(np.flatnonzero(earlier)) == [14] and list(np.flatnonzero(later)) == [2]


def test_factors_equal_brute_force():
    rng = np.random.default_rng(3)
    for turn in range(60):
        length = int(rng.choice([3, 8, 10, 13]))
        text = bytes(rng.integers(97, 97 + int(rng.choice([1, 2, 3])), 60).astype(np.uint8))
        starts = np.flatnonzero(rng.random(61 - length) < 0.8)
        same = lambda i, j: next((k for k in range(length) if text[i + k] != text[j + k]), length)
        earlier, later = suffixes.factors(np.frombuffer(text, np.uint8), starts, length)
        assert list(earlier) == [max((same(i, j) for j in starts if j < i), default=0) for i in starts]
        assert list(later) == [max((same(i, j) for j in starts if j > i), default=0) for i in starts]


@pytest.mark.parametrize("most", [5000, 2])
def test_one_hot_anchor(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "HELD", 5)
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    hot = some(90)
    docs = [some(rng.randint(0, 80)) + hot + some(rng.randint(0, 80)) for _ in range(150)] + [hot] * 40
    rows = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(docs)], "doc_id bigint, text string").repartition(5)
    got = sorted(tuple(r)[1:] for r in suffixes.remove(rows, 60, gram=12, most=most).collect())
    assert got == sorted(brute([t.encode() for t in docs], 60))


def test_very_long_text(spark, monkeypatch):
    rng = random.Random(4)
    some = lambda n: "".join(rng.choices("abcdefghijklmnop \u00e9", k=n))
    shared = some(700)
    docs = [some(1_500_000) + shared + some(900_000), some(300) + shared, some(5000)]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    size = len(shared.encode())
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffixes.remove(rows).collect()}
    # The bytes beside the passage may happen to be equal too.
    assert got[2] == (0, 0) and all(size <= got[i][0] <= size + 4 and got[i][1] == 1 for i in (0, 1))


def test_few_files_are_saved(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    rows = spark.createDataFrame(list(enumerate(corpus(5))), "doc_id bigint, text string").repartition(3)
    assert suffixes.remove(rows, 60, gram=12, most=100).where("n_removed > 0").count() > 20
    tables = sorted((tmp_path / "factloom").iterdir())
    assert [t.name.rpartition("-")[0] for t in tables] == ["anchors", "stretch-bytes"]
    # No more files than tasks, whatever kinds of rows they hold.
    assert all(len(list(t.rglob("*.parquet"))) <= 4 for t in tables)


def test_counted_holds_one_batch_at_a_time():
    none, read = np.zeros(1, np.int64), []

    def batches():
        for i in range(50):
            read.append(i)
            for turn in range(2):
                yield suffixes._rows(0, none + i, none + turn, none, none, none, none + 1)
                yield from suffixes._ranges(none + i, none + turn, none + turn + 5)

    out = []
    for got in suffixes._counted(batches(), 9, 5, 99):
        out += [r for r in got.to_pylist()]
        assert len(read) < 4 or len(out) >= len(read)
    assert len([r for r in out if r["kind"] == 0 and r["n"] == 2]) == 100
    assert sorted((r["key"], r["lo"], r["hi"]) for r in out if r["kind"] == 2) == [(i, t, t + 5) for i in range(50) for t in range(2)]


def test_texts_of_short_periods_are_counted_by_the_piece(spark):
    import pyarrow as pa

    texts = ["x" * 3_000_000, "xy" * 1_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6]), pa.array(texts)], ["key", "text"])
    rows = [r for b in suffixes._anchors(iter([batch]), 200, 32) for r in b.select(["kind", "key", "n"]).to_pylist() if r["kind"] == 0]
    # Several rows a content show that no text was held as a whole; of the first, each start is a stretch.
    assert 5 < len(rows) < 50 and sum(r["n"] for r in rows if r["key"] == 5) == 3_000_000 - 199
    got = suffixes.remove(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:4] for r in got] == [(3_000_000, 3_000_000, 1), (2_000_000, 2_000_000, 1)]
