"""Byte-level BPE: a segment tree over byte positions keeps the leftmost pair of the lowest rank.

Every match of the pattern is encoded by itself, without special tokens. A merge changes three leaves (the
merged part's pair, its left neighbour's, and the one that is gone) in logarithmic time, so one match of n
bytes costs O(n log n) however long it is. Matches of up to MEMO_CHARS characters are kept in a bounded memo
of each Python worker.

Defined cases: null and empty texts have no ids (their digests are those of no bytes); repeated rows and
repeated or null ids give a row each; an empty table gives an empty result; only the id and text columns are
read. Decoding gives back the UTF-8 bytes of the text.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import mapped, ship, table

NONE = 1 << 62
#: Matches of up to MEMO_CHARS characters whose ids a worker keeps, half of them new: some 40 MB, for all of its tasks.
MEMO, MEMO_CHARS = 400_000, 48
_loaded: dict = {}


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get, size = len(piece), ranks.get, 1
    while size < n:
        size *= 2
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    end, before = list(range(1, n + 1)), list(range(-1, n))
    while (least := tree[1]) < NONE:
        i = least & 0xFFFFFFFF
        j = end[i]
        e = end[i] = end[j]
        before[e] = i
        p = before[i]
        changed = [(j, NONE)]
        r = get(piece[i : end[e]]) if e < n else None
        changed.append((i, NONE if r is None else r << 32 | i))
        if p >= 0:
            r = get(piece[p:e])
            changed.append((p, NONE if r is None else r << 32 | p))
        for k, value in changed:
            k += size
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                if b < a:
                    a = b
                if tree[k] == a:
                    break
                tree[k] = a
                k >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Coder:
    """Encodes and decodes by a rank file's bytes and a pattern."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        self.ranks = read_ranks(raw)
        self.matches = regex.compile(pattern).findall
        self.parts = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for part, i in self.ranks.items():
            self.parts[i] = part
        ranks = self.ranks

        class Memo(dict):
            """What was asked for lately: a full memo becomes the old one, from which what is asked again comes back."""

            old: dict = {}

            def __missing__(self, match: str) -> bytes:
                packed = self.old.get(match)
                if packed is None:
                    packed = b"".join(i.to_bytes(4, "little") for i in merge(match.encode(), ranks))
                if len(match) <= MEMO_CHARS:
                    if len(self) >= MEMO // 2:
                        self.old = dict(self)
                        self.clear()
                    self[match] = packed
                return packed

        self.memo = Memo()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.matches(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.parts.__getitem__, memoryview(packed).cast("I")))


def coder(raw: bytes, pattern: str) -> Coder:
    key = (hashlib.sha256(raw).digest(), pattern)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Coder(raw, pattern)
    return _loaded[key]


def public(name: str) -> tuple[bytes, str]:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encode(docs: DataFrame, raw: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 for every row; with ids=True also token_ids (array of int).

    raw: the rank file's bytes (some hundred kilobytes), read on the driver and broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((raw, pattern))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from factloom.llm import bpe

        own = bpe.coder(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, first, second, lists = [], [], [], []
                for text in batch.column(1):
                    packed = own.encode(text.as_py() or "")
                    n.append(len(packed) // 4)
                    first.append(hashlib.sha256(packed).hexdigest())
                    second.append(hashlib.sha256(own.decode(packed)).hexdigest())
                    if ids:
                        lists.append(np.frombuffer(packed, "<i4"))
                cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    cols.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    return mapped(docs.select(id_col, text_col), run, schema)


def decode(encoded: DataFrame, raw: bytes, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds decoded (binary) to rows with an array of ids; null ids give null."""
    from pyspark.sql import functions as F

    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast((raw, pattern))

    @F.pandas_udf("binary")
    def back(ids):
        from factloom.llm import bpe

        parts = bpe.coder(*shared.value).parts
        return ids.map(lambda x: None if x is None else b"".join(parts[i] for i in x))

    return encoded.withColumn("decoded", back(ids_col))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), *public("byte_bpe_50k.tiktoken"))
