"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's features are its byte n-grams of 3 to 5 (with marks for its start and end) and itself, hashed to
BUCKETS. A window of WINDOW words is the average of its features' vectors; a linear softmax over it gives the
window's odds. Windows cover the whole text and the document's score is that of its strongest window, scaled
by a logistic fit on documents kept out of the training, so that a few words count the same in a long text.
Vectors start from the log-odds of a feature's documents; each round then learns, of a toxic document, the
windows that stand out and, of others, all (multiple-instance learning). Vectors and softmax are trained
together by Adagrad. A word that directly repeats the one before it counts once.

The training set is a bounded sample of labelled rows: at most `most_docs` a class and `most_chars` characters
a class, in the order of a hash of doc_id. Features seen in fewer than LEAST_DOCS of them are not used.
Scoring reads every whole text. Source, language and doc_id are never inputs of a score.

Defined cases: null, empty and blank texts score 0; null labels
are not learnt from; an id with several labels counts as toxic if one says so; without documents of both
classes every score is 0; repeated rows and ids give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import rolling
from factloom.llm.common import mapped, portions, release, table, utf8

BUCKETS, DIM, WINDOW, LEAST_DOCS = 1 << 17, 8, 6, 4
#: A window of fewer features counts as padded with empty ones to so many.
PADDED = 60
THRESHOLD = 0.7
HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"


@dataclass
class Model:
    """A weight for each bucket (0 and unused where not known), and the scaling of the strongest window."""

    weight: np.ndarray
    used: np.ndarray
    bias: float
    scale: tuple[float, float, float]


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature of the words data[start:end], sorted by word."""
    size = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(size)])
    own = np.repeat(np.arange(len(starts)), size)
    at = np.arange(first[-1]) - first[own]
    marked = np.where(at == 0, 1, np.where(at == size[own] - 1, 2, 0)).astype(np.uint8)
    inside = marked == 0
    marked[inside] = data[(starts[own] + at - 1)[inside]]
    total = rolling.sums(marked)
    where, bucket = [np.arange(len(starts))], [rolling.span(total, first[:-1], first[1:])]
    for n in (3, 4, 5):
        begin = np.flatnonzero(at + n <= size[own])
        where.append(own[begin])
        bucket.append(rolling.span(total, begin, begin + n))
    where = np.concatenate(where)
    order = np.argsort(where, kind="stable")
    return where[order], (np.concatenate(bucket)[order] & np.uint64(BUCKETS - 1)).astype(np.int64)


def bags(data: np.ndarray, offsets: np.ndarray):
    """Distinct words' features and each row's words as numbers of them: (word, bucket, number, first)."""
    data = rolling.LOWER[data]
    starts, ends, first = rolling.words(data, offsets)
    hashes = rolling.word_hashes(data, starts, ends)
    _, one, number = np.unique(hashes, return_index=True, return_inverse=True)
    word, bucket = features(data, starts[one], ends[one])
    return word, bucket, number, first


def bags_of_many(data: np.ndarray, offsets: np.ndarray):
    """What bags() gives, from some of the texts and some of the words at a time and in 32 bits."""
    hashes, starts, ends, count = ([np.zeros(0, k)] for k in (np.uint64, np.int32, np.int32, np.int64))
    for i, j in portions(offsets):
        part = rolling.LOWER[data[offsets[i] : offsets[j]]]
        a, b, f = rolling.words(part, offsets[i : j + 1] - offsets[i])
        hashes.append(rolling.word_hashes(part, a, b))
        starts.append((a + offsets[i]).astype(np.int32))
        ends.append((b + offsets[i]).astype(np.int32))
        count.append(np.diff(f))
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    _, one, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    del hashes
    starts, ends, word, bucket = starts[one], ends[one], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(one), 20_000):
        a, b = starts[at : at + 20_000].astype(np.int64), ends[at : at + 20_000].astype(np.int64)
        size = b - a
        own = rolling.LOWER[data[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())]]
        w, x = features(own, np.cumsum(size) - size, np.cumsum(size))
        word.append((w + at).astype(np.int32))
        bucket.append(x.astype(np.int32))
    first = np.concatenate([[0], np.cumsum(np.concatenate(count))])
    return np.concatenate(word), np.concatenate(bucket), number.astype(np.int32), first


def counted(number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """False where a word directly repeats the one before it in its row."""
    fresh = np.ones(len(number), bool)
    fresh[1:] = number[1:] != number[:-1]
    fresh[first[:-1][np.diff(first) > 0]] = True
    return fresh


def windows(first: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ranges [from, to) that cover each row, the last moved back to full width; and the row of each."""
    count = np.diff(first)
    many = (count + width - 1) // width
    row = np.repeat(np.arange(len(count)), many)
    no = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = np.maximum(0, np.minimum(no * width, count[row] - width))
    return first[row] + start, first[row] + np.minimum(start + width, count[row]), row


def train(texts: list[str], toxic: list[int], seed: int = 5, rounds: int = 4, batch: int = 2048) -> Model | None:
    """Fits on whole texts; every fourth text serves the scaling only."""
    y = np.asarray(toxic, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    raw = [(t or "").encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    del raw
    word, bucket, number, first = bags_of_many(data, offsets)
    starts = np.searchsorted(word, np.arange(number.max(initial=0) + 2, dtype=np.int32))
    length = np.diff(starts)

    def flat(words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = length[words_]
        return np.repeat(starts[:-1][words_] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n

    in_toxic, in_clean = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for i in range(len(y)):  # a document at a time, so that memory does not grow with the sample
        have = np.unique(bucket[flat(np.unique(number[first[i] : first[i + 1]]))[0]])
        (in_toxic if y[i] else in_clean)[have] += 1
    used = in_toxic + in_clean >= min(LEAST_DOCS, max(1, y.sum() // 4))
    odds = np.log((in_toxic + 0.5) / (y.sum() + 1)) - np.log((in_clean + 0.5) / (len(y) - y.sum() + 1))
    keep = used[bucket]
    word, bucket = word[keep], bucket[keep]
    starts = np.searchsorted(word, np.arange(number.max(initial=0) + 2, dtype=np.int32))
    length = np.diff(starts)

    rng = np.random.default_rng(seed)
    vectors = (rng.standard_normal((BUCKETS, DIM)) * 0.02).astype(np.float32)
    soft, bias = (rng.standard_normal((DIM, 2)) * 0.1).astype(np.float32), np.array([1, -1], np.float32)
    vectors[:, 0], soft[0] = np.clip(odds, -0.3, 5), (-1, 1)
    fresh = counted(number, first)
    past_v, past_s, past_b = np.full((BUCKETS, DIM), 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    lo, hi, row = windows(first)
    train_row = np.zeros(len(y), bool)
    for c in (0, 1):  # every fourth text of a class serves the scaling
        train_row[np.flatnonzero(y == c)[np.arange((y == c).sum()) % 4 != 3]] = True

    def gather(chosen: np.ndarray):
        size = hi[chosen] - lo[chosen]
        places = np.repeat(lo[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        owner = np.repeat(np.arange(len(chosen)), size)[fresh[places]]
        index, n = flat(number[places[fresh[places]]])
        return bucket[index], np.bincount(owner, weights=n, minlength=len(chosen)).astype(np.int64)

    def step(chosen: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float):
        nonlocal vectors, soft, bias
        b, per = gather(chosen)
        owner = np.repeat(np.arange(len(chosen)), per)
        bag = np.stack([np.bincount(owner, vectors[b, d], len(chosen)) for d in range(DIM)], 1) / np.maximum(per, PADDED)[:, None]
        z = bag @ soft + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(chosen)), target] -= 1
        p *= (weight / weight.sum())[:, None] * 64
        back = (p @ soft.T / np.maximum(per, PADDED)[:, None]).astype(np.float32)
        g_s, g_b = bag.T @ p + 1e-4 * soft, p.sum(0)
        near, where = np.unique(b, return_inverse=True)
        g_v = np.stack([np.bincount(where, back[owner, d], len(near)) for d in range(DIM)], 1) + 1e-4 * vectors[near]
        past_v[near] += g_v**2
        vectors[near] -= rate * g_v / np.sqrt(past_v[near])
        past_s[:] += g_s**2
        soft -= rate * g_s / np.sqrt(past_s)
        past_b[:] += g_b**2
        bias -= rate * g_b / np.sqrt(past_b)

    def weights() -> np.ndarray:
        return vectors @ (soft[:, 1] - soft[:, 0])

    def logits() -> np.ndarray:
        value = np.concatenate([[0], np.cumsum(np.bincount(word, weights()[bucket], number.max(initial=0) + 1)[number] * fresh)])
        many = np.concatenate([[0], np.cumsum(length[number] * fresh)])
        return (value[hi] - value[lo]) / np.maximum(many[hi] - many[lo], PADDED) + float(bias[1] - bias[0])

    chosen = np.flatnonzero(train_row[row])
    positive = y[row] == 1
    for _ in range(rounds):
        z = logits()
        top = np.full(len(y), -np.inf)
        np.maximum.at(top, row, z)
        stands = z >= np.where(top[row] > 2, 0.7 * top[row], top[row])
        pos, neg = chosen[positive[chosen] & stands[chosen]], chosen[~positive[chosen]]
        hard = neg[np.argsort(-z[neg], kind="stable")[: 5 * len(pos)]]
        part = np.concatenate([pos, hard, rng.permutation(neg)[: max(10 * len(pos), 2 * batch)]])
        weight = np.where(positive, len(part) / max(1, 2 * len(pos)), len(part) / max(1, 2 * (len(part) - len(pos))))
        for _ in range(2 if len(part) > 8 * batch else 4):
            part = rng.permutation(part)
            for at in range(0, len(part), batch):
                own_ = part[at : at + batch]
                step(own_, positive[own_].astype(int), weight[own_], 0.05)
    z = logits()
    top = np.full(len(y), -30.0)
    np.maximum.at(top, row, z)
    many = np.log1p(np.bincount(row, minlength=len(y)))
    fit = ~train_row if min(((~train_row) & (y == c)).sum() for c in (0, 1)) >= 3 else np.ones(len(y), bool)
    return Model(np.where(used, weights(), 0).astype(np.float32), used, float(bias[1] - bias[0]), scaling(np.clip(top[fit], -30, 30), many[fit], y[fit]))


def scaling(top: np.ndarray, many: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic fit of the label on the strongest window and the logarithm of the number of windows."""
    x = np.stack([top, -many, np.ones(len(y))], 1)
    w = np.array([1.0, 0.0, 0.0])
    balance = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (balance * (p - y)) + w - np.array([1.0, 0.0, 0.0])
        move = np.linalg.solve((x * (balance * p * (1 - p))[:, None]).T @ x + np.eye(3), grad)
        w -= move * min(1.0, 1.0 / max(1e-9, float(np.abs(move).max())))
    return tuple(map(float, w))


def scores(model: Model | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A score for every row of UTF-8 bytes."""
    out = np.zeros(len(offsets) - 1)
    if model is None:
        return out
    a, b, c = model.scale
    for i, j in portions(offsets):
        word, bucket, number, first = bags(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        words_ = int(number.max(initial=-1)) + 1
        value = np.bincount(word, model.weight[bucket], max(1, words_))
        count = np.bincount(word, model.used[bucket], max(1, words_))
        fresh = counted(number, first)
        value, count = (np.concatenate([[0.0], np.cumsum(v[number] * fresh)]) if len(number) else np.zeros(1) for v in (value, count))
        lo, hi, row = windows(first)
        z = (value[hi] - value[lo]) / np.maximum(count[hi] - count[lo], PADDED) + model.bias
        top = np.full(j - i, -30.0)
        np.maximum.at(top, row, z)
        many = np.log1p(np.bincount(row, minlength=j - i))
        out[i:j] = np.where(many == 0, 0.0, 1 / (1 + np.exp(-np.clip(a * np.clip(top, -30, 30) - b * many + c, -30, 30))))
    return out


def sample(docs: DataFrame, labels: DataFrame, most_docs: int, most_chars: int, learn: str = f"not ({HELD_OUT})"):
    """(texts, labels) of the bounded training set, in an order that reruns agree on.

    A text gives at most a hundredth of its class's characters, its first ones, so that no long text ends the sample.
    """
    rows = labels.where("doc_id is not null and toxic in (0, 1)").where(learn).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = rows.where("_toxic = 0").orderBy(*order).limit(most_docs).unionAll(rows.where("_toxic = 1").orderBy(*order).limit(most_docs))
    few = few.withColumnRenamed("doc_id", "_id")
    # At most 2 * most_docs rows of two numbers.
    found = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id")).where("text is not null")
    found = found.withColumn("text", F.left("text", F.lit(max(1, most_chars // 100))))
    upto = Window.partitionBy("_toxic").orderBy(F.xxhash64("_id"), "_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_chars", F.coalesce(F.sum(F.length("text")).over(upto), F.lit(0))).where(F.col("_chars") < most_chars)
    got = sorted(((r["_id"], r["text"], r["_toxic"]) for r in found.select("_id", "text", "_toxic").toLocalIterator()), key=lambda r: (r[0], r[1]))
    return [r[1] for r in got], [r[2] for r in got]


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = 1500, most_chars: int = 6_000_000) -> Model | None:
    out = train(*sample(docs, labels, most_docs, most_chars))
    release()
    return out


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model and (model.weight, model.used, model.bias, model.scale))

    def run(batches):
        import pyarrow as pa

        from factloom.llm import toxicity

        own = shared.value and toxicity.Model(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(toxicity.scores(own, *utf8(batch.column(1))), pa.float64())], [id_col, "score"])

    return mapped(docs.select(id_col, text_col), run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def clean(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below threshold, with all their columns."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model and (model.weight, model.used, model.bias, model.scale))
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        from factloom.llm import toxicity

        own = shared.value and toxicity.Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array(toxicity.scores(own, *utf8(batch.column(at))) < threshold))

    return mapped(docs, run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
