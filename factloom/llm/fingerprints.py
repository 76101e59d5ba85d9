"""Document fingerprints: bottom-k sketches of shingle hashes (DataFrame functions only).

A text's shingles are its words, each with the four words before it (empty ones before the first), so a text
of n words has n shingles of five words, lower-cased. The sketch is the k smallest distinct 64-bit hashes in
ascending order. Two sketches merge into the sketch of the union of their shingles; they estimate
resemblance, containment and the number of distinct shingles.

Defined cases: null texts count as empty; an empty or blank text has the empty sketch, alike (1.0) only to
another; documents are ordered by doc_id (null first), then text; a single document is its own next; repeated
rows and ids give a row each; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import WORD, save, table

K, WIDTH = 64, 5
#: One bucket of the order by id holds about so many rows; there are at most MOST_BUCKETS.
BUCKET_ROWS, MOST_BUCKETS, FAN = 256, 16384, 128


def sketched(df: DataFrame, text: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """Adds the sketch of a text column: array of bigint, ascending."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    df = df.withColumn("_w", F.concat(F.array(*[F.lit("")] * (width - 1)), words))
    hashes = F.transform(F.sequence(F.lit(0), F.size("_w") - width), lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(width)]))
    hashes = F.when(F.size("_w") >= width, hashes).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop("_w")


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch a group: the k least hashes of its parts' sketches, found by rank, so that no group is gathered."""
    hashes = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    least = hashes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the two texts' shingles, 0 to 1."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, 0 to 1."""
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_next(df: DataFrame, carried: list[str]) -> DataFrame:
    """Adds next (a struct of the carried columns) of the row that follows by doc_id; the first follows the last.

    Quantiles of doc_id part the rows into buckets; the order is found within each, and each bucket also
    holds a copy of the next bucket's first row. No step orders the whole table in one task.
    """
    ids = df.agg(F.count("*"), F.count("doc_id")).first()
    n = max(1, min(MOST_BUCKETS, ids[0] // BUCKET_ROWS))
    cuts = df.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * MOST_BUCKETS)).first()[0] if n > 1 and ids[1] else []
    cuts = sorted(set(cuts or []))
    key = F.col("doc_id")
    if cuts:
        coarse = F.array(*map(F.lit, cuts[::FAN]))
        c = F.size(F.filter(coarse, lambda x: x <= key))
        fine = F.slice(F.array(*map(F.lit, cuts)), F.greatest(c - 1, F.lit(0)) * FAN + 1, FAN)
        df = df.withColumn("_c", F.when(key.isNull(), 0).otherwise(c)).withColumn("_b", F.when(F.col("_c") == 0, 0).otherwise((F.col("_c") - 1) * FAN + F.size(F.filter(fine, lambda x: x <= key)))).drop("_c")
    else:
        df = df.withColumn("_b", F.lit(0))
    firsts = df.groupBy("_b").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("f")).collect()  # a row a bucket
    firsts = sorted((r["_b"], r["f"]["doc_id"]) for r in firsts)
    df = df.withColumn("_copy", F.lit(False))
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    if len(firsts) > 1:
        heads = [(b, i) for b, i in firsts if i is not None]
        named = F.col("doc_id").isin([i for _, i in heads])
        if len(heads) < len(firsts):
            named = named | F.col("doc_id").isNull()
        low = df.where(named & F.col("_b").isin([b for b, _ in firsts]))
        by = Window.partitionBy("_b").orderBy(F.col("doc_id").asc_nulls_first(), "text")
        low = low.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")
        to = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("_b"))
    else:
        by = Window.partitionBy("_b").orderBy(F.col("doc_id").asc_nulls_first(), "text")
        low = df.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")
        to = F.col("_b")
    wrapped = to >= F.col("_b")
    low = low.withColumn("_last", wrapped).withColumn("_b", to).withColumn("_copy", F.lit(True))
    both = df.withColumn("_last", F.lit(False)).unionByName(low)
    order = Window.partitionBy("_b").orderBy("_last", F.col("doc_id").asc_nulls_first(), "_copy", "text")
    both = both.withColumn("next", F.lead(F.struct(*carried)).over(order))
    return both.where(~F.col("_copy")).drop("_copy", "_last", "_b")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(sketched(docs, "text", "sketch"), ["text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)))
    rows = sketched(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next.sketch")).alias("near_next"),
    )
