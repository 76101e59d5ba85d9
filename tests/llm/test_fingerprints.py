import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from factloom.llm import fingerprints as fp


def sketch(text, k=64):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    padded, out = [""] * 4 + words, set()
    for i in range(len(words)):
        h = 42
        for w in padded[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return sorted(out)[:k]


def likeness(a, b, k=64):
    union = sorted(set(a) | set(b))[:k]
    return sum(x in a and x in b for x in union) / len(union) if union else 1.0


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for j, (i, t) in enumerate(rows):
        n, follow = len(t), rows[(j + 1) % len(rows)][1]
        edited = t[: n - n // 2] + follow[: n // 2]
        a, b, c = sketch(t), sketch(edited), sketch(follow)
        text = lambda s: "".join("%016x" % (x % (1 << 64)) for x in s)
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), round(likeness(a, b), 9), round(likeness(a, c), 9)))
    return sorted(map(str, out))


def result(spark, tmp_path, rows):
    spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id bigint, text string, next int, sketch string").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    got = fp.op7_fingerprints(spark, str(tmp_path)).collect()
    return sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))) for r in got)


@pytest.mark.parametrize("rows_a_bucket", [256, 7])
def test_equals_brute_force(spark, tmp_path, monkeypatch, rows_a_bucket):
    monkeypatch.setattr(fp, "BUCKET_ROWS", rows_a_bucket)
    rng = random.Random(rows_a_bucket)
    words = ["w%d" % i for i in range(40)] + ["É🙂", "ß"]
    rows = [(i * i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 30, 300])))) for i in range(90)]
    rows += [(10**12, "far away"), (10**12 + 1, "\n"), (-5, "below"), (None, "null id")]
    assert result(spark, tmp_path, rows) == brute(rows)


def test_edges(spark, tmp_path):
    for rows in ([(1, "alone here")], [(1, None), (1, ""), (1, "x y")], [(2, "a b c"), (2, "a b c"), (3, "z")], []):
        assert result(spark, tmp_path, rows) == brute(rows)


def test_sketches_merge_and_estimate(spark):
    a, b = " ".join("w%d" % i for i in range(1200)), " ".join("w%d" % i for i in range(600, 1800))
    df = fp.sketched(spark.createDataFrame([(1, a), (1, b)], "g int, text string"), "text", "sketch")
    merged = fp.merge_sketches(df, ["g"], "sketch").first()["sketch"]
    sets = [sketch(a, 10**6), sketch(b, 10**6)]
    assert merged == sorted(set(sets[0]) | set(sets[1]))[:64]
    both = df.where(F.col("text") == a).select(F.col("sketch").alias("x")).join(df.where(F.col("text") == b).select(F.col("sketch").alias("y")))
    r = both.select(fp.resemblance(F.col("x"), F.col("y")).alias("r"), fp.containment(F.col("x"), F.col("y")).alias("c"), fp.distinct_shingles(F.col("x")).alias("n")).first()
    assert abs(r["r"] - 1 / 3) < 0.2 and abs(r["c"] - 0.5) < 0.25 and abs(r["n"] - 1200) < 500
