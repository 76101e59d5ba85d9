"""Suffix-array dedup: byte strings of a given length that occur more than once, by longest-previous-factor arrays.

A position of a text can start a repeated string of `length` bytes only if the string's least k-gram hash (its
anchor) occurs twice. Every start belongs to exactly one anchor, and the starts of one anchor are consecutive:
their bytes make a stretch. So repeated strings are found among the stretches of one anchor hash:

1. stretches are counted by anchor and content, those of one batch of texts before anything is shuffled; an anchor
   that occurs once goes (nothing of it repeats), a content that occurs twice repeats as a whole, one copy goes on;
2. the distinct stretches of an anchor hash are sorted by suffix. In suffix order the best earlier match of a start is
   the previous or the next smaller position, and the best later match the previous or next larger one; the longest
   common prefixes with these are its longest previous and longest next factor (up to `length`). A start repeats if
   either reaches `length`. An anchor hash with over MOST distinct stretches is settled by counting the strings
   themselves, which needs no group in one task and gives the same result.

Equal texts are one text with a count. Texts are told apart by 64 bits of hash, contents by their anchor's 64 bits and 64
of their own, counted strings by 128; in step 2 bytes are compared.

Defined cases: null counts as empty; texts shorter than `length` keep all; equal texts of at least `length`
bytes repeat as a whole; repeated rows and ids count as separate texts; an empty table gives an empty result;
only the id and text columns are read. Matches never cross rows. Texts are read in pieces of PIECE bytes, and
rows in parts of some megabytes.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import rolling
from factloom.llm.common import mapped, save, slices, table, utf8

LENGTH, GRAM = 200, 32
#: Distinct stretches of one anchor hash that are sorted in one task.
MOST = 5000
PIECE = 1 << 20
#: Stretches that are counted together before anything is shuffled.
STRETCHES = 1 << 18


def ranks(data: np.ndarray, length: int) -> list[np.ndarray]:
    """For sizes 1, 2, 4, .. up to `length` the rank of the string of that size at every position, zeros after the end; by doubling."""
    rank = data.astype(np.uint64) + np.uint64(1)
    out = [rank]
    while 1 << len(out) <= length:
        if (int(rank.max(initial=0)) + 1) ** 2 >= 1 << 63:
            _, rank = np.unique(rank, return_inverse=True)
            out[-1] = rank = rank.astype(np.uint64) + np.uint64(1)
        have = 1 << len(out) - 1
        later = np.concatenate([rank, np.zeros(have, np.uint64)])[have : have + len(data)]
        rank = rank * np.uint64(int(rank.max(initial=0)) + 1) + later
        out.append(rank)
    return out


def common(level: list[np.ndarray], p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
    """Longest common prefixes of the suffixes at p and q, up to `length`."""
    n, out = len(level[0]), np.zeros(len(p), np.int64)
    for i in range(len(level) - 1, -1, -1):
        # Twice the largest: what doubling has not covered is less than twice as long.
        for _ in range(2 if i == len(level) - 1 else 1):
            a, b = p + out, q + out
            there = (a < n) & (b < n)
            same = np.zeros(len(p), bool)
            same[there] = level[i][a[there]] == level[i][b[there]]
            out[same] += 1 << i
    return np.minimum(out, length)


def nearest_less(value: np.ndarray) -> np.ndarray:
    """For each place the last place before it with a smaller value, or -1: all places jump at once over what is larger."""
    out = np.arange(-1, len(value) - 1)
    todo = np.flatnonzero(out >= 0)
    while len(todo):
        todo = todo[value[out[todo]] > value[todo]]
        out[todo] = out[out[todo]]
        todo = todo[out[todo] >= 0]
    return out


def factors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of each start, up to `length`: the longest string there that also begins at an earlier (a later) start."""
    level = ranks(data, length)
    whole, rest = level[-1], length - (1 << len(level) - 1)
    # Two overlapping ranks order the first `length` bytes; ties stand in order of position.
    order = np.lexsort((starts, whole[starts + rest] if rest else whole[starts], whole[starts]))
    place = starts[order]
    out = []
    for value in (place, -place):
        best = np.zeros(len(starts), np.int64)
        for near in (nearest_less(value), len(value) - 1 - nearest_less(value[::-1])[::-1]):
            hit = (near >= 0) & (near < len(value))
            both = np.zeros(len(starts), np.int64)
            both[hit] = common(level, place[hit], place[near[hit]], length)
            best = np.maximum(best, both)
        back = np.empty(len(starts), np.int64)
        back[order] = best
        out.append(back)
    return out[0], out[1]


def longest_previous_factor(data: np.ndarray, length: int | None = None) -> np.ndarray:
    """For every position the length, up to `length`, of the longest string there that also starts earlier."""
    length = len(data) if length is None else length
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    return np.minimum(factors(padded, np.arange(len(data)), length)[0], len(data) - np.arange(len(data)))


def repeated_starts(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start, whether its string of `length` bytes has an earlier and a later equal among the starts."""
    previous, following = factors(data, starts, length)
    return previous >= length, following >= length


def stretches(data: np.ndarray, length: int, gram: int):
    """(first start, last start, anchor hash, content hash) of every stretch of one text; strings start within [first, last].

    The content hash sums spread hashes of all its grams, so that texts made to collide in a plain sum do not.
    """
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    width = length - gram + 1
    total = rolling.sums(data)
    places = np.arange(n - gram + 1)
    hashes = rolling.span(total, places, places + gram)
    # The place breaks ties, so that equal strings choose equal places in them; PIECE leaves room for it.
    bits = np.uint64(PIECE.bit_length())
    value = (hashes >> bits << bits) | places.astype(np.uint64)
    pad = -len(value) % width
    rows = np.concatenate([value, np.full(pad, ~np.uint64(0), np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    many = n - length + 1
    least = np.minimum(back[:many], ahead[width - 1 : width - 1 + many])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([new[1:], [many]]) - 1
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * rolling.powers(len(hashes) + 1)[0][: len(hashes)], out=total[1:])
    return new, last, hashes[anchor[new]], rolling.span(total, new, last + width)


def pieces(n: int, length: int, most: int = PIECE):
    """Parts [i, j) of a long text that overlap by length - 1 bytes: each string lies in exactly one."""
    i = 0
    while i < n:
        j = min(n, i + most)
        yield i, j
        if j == n:
            break
        i += most - length + 1


NAMES = ["kind", "h", "s", "key", "lo", "hi", "n"]
KINDS = "kind int, h bigint, s bigint, key bigint, lo bigint, hi bigint, n bigint"


def _rows(kind: int, *cols):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), kind, np.int32)), *(pa.array(c.view(np.int64)) for c in cols)], NAMES)


def _anchors(batches, length: int, gram: int):
    """Kind 0: a stretch (anchor hash, content hash, key, first start, last start, times); kind 2: a range [lo, hi) that repeats."""
    for batch in batches:
        for part in slices(batch, 1):
            data, offsets = utf8(part.column(1))
            keys, out, many = part.column(0).to_numpy(zero_copy_only=False), [], 0
            for r in range(part.num_rows):
                text = data[offsets[r] : offsets[r + 1]]
                for i, j in pieces(len(text), length):
                    a, b, h, s = stretches(text[i:j], length, gram)
                    out.append((h, s, np.full(len(a), keys[r]), a + i, b + i))
                    many += len(a)
                    # A text of very short periods has as many stretches as bytes.
                    if many > STRETCHES:
                        yield from _combined(out, length)
                        out, many = [], 0
            yield from _combined(out, length)


def _combined(out: list, length: int):
    """Rows of kind 0 of stretches (h, s, key, lo, hi), one a content with its number, and of kind 2 for contents that occur twice."""
    h, s, key, lo, hi = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 5
    if not len(h):
        return
    order = np.lexsort((lo, key, s, h))
    h, s, key, lo, hi = (x[order] for x in (h, s, key, lo, hi))
    first, size = _runs(h, s)
    yield _rows(0, h[first], s[first], key[first], lo[first], hi[first], size)
    again = np.repeat(size > 1, size)
    yield from _ranges(key[again], lo[again], hi[again] + length)


def _runs(*cols) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs of rows with equal values."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], 0)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


def _ranges(key, lo, hi):
    """Rows of kind 2: overlapping ranges of a key as one. They go through the shuffle of the anchors, so h deals them out."""
    if not len(key):
        return
    order = np.lexsort((lo, key))
    key, lo, hi = key[order], lo[order], hi[order]
    # Ranges of one key are put apart from those of the next, so that one running maximum serves all.
    turn = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) * (int(hi.max()) + 1)
    end = np.maximum.accumulate(turn + hi)
    cut = np.flatnonzero(np.concatenate([[True], (turn + lo)[1:] > end[:-1]]))
    last = np.append(cut[1:], len(key)) - 1
    key, lo, none = key[cut], lo[cut], np.zeros(len(cut), np.int64)
    yield _rows(2, rolling.mix((key ^ lo).view(np.uint64)), none, key, lo, (end - turn)[last], none)


#: Rows of one anchor hash that a task holds; of more, it holds so many at a time and takes all for many stretches.
HELD = 1 << 19


def _counted(batches, most: int, length: int, most_held: int):
    """Rows in the order of (h, s): of kind 0, one a content of anchors with several, n now their number; of kind 2, those that came and contents that occur twice."""
    held, frequent = None, None
    for cols in chain(batches, [None]):
        now = None if cols is None else {c: cols.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(NAMES)}
        if now is not None:
            known = now["kind"] == 2
            yield from _ranges(*(now[c][known] for c in ("key", "lo", "hi")))
            now = {c: v[~known] for c, v in now.items()}
            held = now if held is None else {c: np.concatenate([held[c], now[c]]) for c in NAMES}
        if held is None or not len(held["h"]):
            continue
        h = held["h"]
        cut = len(h) if now is None else int(np.searchsorted(h, h[-1]))
        if len(h) - cut > most_held:
            frequent, cut = h[-1], int(np.searchsorted(held["s"][cut:], held["s"][-1])) + cut
        if not cut:
            continue
        g, held = {c: v[:cut] for c, v in held.items()}, {c: v[cut:] for c, v in held.items()}
        first, size = _runs(g["h"], g["s"])
        times = np.add.reduceat(g["n"], first)
        at, kinds = _runs(g["h"][first])
        kinds = np.where((g["h"][first[at]] == frequent) if frequent is not None else False, most + 1, kinds)
        several = np.repeat(kinds, np.diff(np.append(at, len(first))))
        go = first[several > 1]
        yield _rows(0, *(g[c][go] for c in NAMES[1:6]), several[several > 1])
        again = np.repeat(times > 1, size)
        yield from _ranges(g["key"][again], g["lo"][again], g["hi"][again] + length)


def _sorted_groups(batches, length: int):
    """Rows (h, key, lo, bytes) in the order of h: the ranges [lo, hi) of a key that strings which repeat cover."""

    def settle(rows):
        data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        size = np.array([len(r[3]) for r in rows])
        first, many = np.cumsum(size) - size, size - length + 1
        own = np.repeat(np.arange(len(rows)), many)
        starts = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        earlier, later = repeated_starts(data, starts, length)
        hit = np.flatnonzero(earlier | later)
        place = np.array([r[2] for r in rows])[own[hit]] + starts[hit] - first[own[hit]]
        yield from _ranges(np.array([r[1] for r in rows], np.int64)[own[hit]], place, place + length)

    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:3] == held[-1][:3]:
                continue  # of a document that stands in several rows
            if held and row[0] != held[-1][0] and size >= 1 << 19:
                yield from settle(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield from settle(held)


def _strings(batches, length: int):
    """Two hashes of every string of `length` bytes of rows (key, lo, bytes), as h and s, with key and lo."""
    for batch in batches:
        for part in slices(batch, 2, 1 << 18):
            for key, lo, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = np.frombuffer(text, np.uint8)
                starts = np.arange(len(data) - length + 1)
                total, half = rolling.sums(data), starts + length // 2
                a = rolling.span(total, starts, starts + length)
                b = rolling.mix(rolling.span(total, starts, half) + np.uint64(1)) ^ rolling.span(total, half, starts + length)
                none = np.zeros(len(starts), np.int64)
                yield _rows(0, a, b, np.full(len(starts), key), lo + starts, lo + starts + length, none)


def _equal_strings(batches):
    """The ranges of strings of which there are several; rows come in the order of (h, s, key, lo), and equal rows are one."""
    last = None
    for batch in batches:
        g = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6)]
        if last is not None:
            g = [np.concatenate([a, b]) for a, b in zip(last, g, strict=True)]
        if not len(g[0]):
            continue
        first, _ = _runs(*g)
        g = [x[first] for x in g]
        same = (g[0][1:] == g[0][:-1]) & (g[1][1:] == g[1][:-1])
        hit = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        yield from _ranges(*(x[hit] for x in g[2:]))
        last = [x[-1:] for x in g]


def packed(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the text as zstandard bytes: what is shuffled is a third as large."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, len(keep)):
                data, offsets = utf8(part.column(len(keep)))
                texts = [pack(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.binary())], [*keep, "packed"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return mapped(docs.select(*keep, text), run, f"{kinds}, packed binary")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(key, spans): the byte ranges of each text that repeated strings cover; key as in keyed()."""
    from factloom.llm.sets import texts_of, whole_number

    rows, most_held = keyed(docs), HELD
    # Few tables are saved, and none in parts: without its native library Hadoop starts processes for each file, at first of the size of the JVM.
    found = mapped(rows.select("key", "text"), lambda b: _anchors(b, length, gram), KINDS)
    ordered = found.repartition("h").sortWithinPartitions("h", "s", "key", "lo")
    counted = save(mapped(ordered, lambda b: _counted(b, most, length, most_held), KINDS), "anchors")
    # One document of each key: equal texts have equal bytes.
    one = rows.select("key", whole_number(docs, "doc_id").alias("doc_id")).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    asked = counted.where("kind = 0").groupBy("key").agg(F.collect_list(F.struct("h", "lo", "hi", "n")).alias("asked")).join(one, "key")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                data, offsets = utf8(part.column(0))
                for r, wanted in enumerate(part.column(1).to_pylist()):
                    text = data[offsets[r] : offsets[r + 1]]
                    cols = [[x[c] for x in wanted] for c in ("h", "lo", "hi", "n", "key")]
                    cols.append([text[a : b + length].tobytes() for a, b in zip(cols[1], cols[2], strict=True)])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 5 else pa.int64()) for i, c in enumerate(cols)], ["h", "lo", "hi", "n", "key", "bytes"])

    asked = asked.select("doc_id", "key", F.transform("asked", lambda x: x.withField("key", F.col("key"))).alias("asked"))
    parts = save(mapped(texts_of(docs, asked), cut, "h bigint, lo bigint, hi bigint, n bigint, key bigint, bytes binary"), "stretch-bytes")
    few = parts.where(F.col("n") <= most).select("h", "key", "lo", "bytes").repartition("h").sortWithinPartitions("h", "key", "lo")
    spans = counted.where("kind = 2").select("key", "lo", "hi")
    spans = spans.unionByName(mapped(few, lambda b: _sorted_groups(b, length), KINDS).select("key", "lo", "hi"))
    strings = mapped(parts.where(F.col("n") > most).select("key", "lo", "bytes"), lambda b: _strings(b, length), KINDS)
    strings = strings.repartition("h").sortWithinPartitions("h", "s", "key", "lo")
    spans = spans.unionByName(mapped(strings, _equal_strings, KINDS).select("key", "lo", "hi"))
    return spans.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds key: a hash of the text, the same for equal texts."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", text_key(F.col("text")))


def text_key(text):
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(F.length(text.cast("binary")), text)


def unions(spans) -> list[tuple[int, int]]:
    """Ranges as maximal ones."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", texts: bool = False, **limits) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256; with texts=True also kept (binary) and spans."""
    found = repeats(docs.select(F.col(id_col).alias("doc_id"), "text"), length, **limits).hint("shuffle_hash")
    rows = packed(keyed(docs).select(id_col, "key", "text"), [id_col, "key"]).join(found, "key", "left").select(id_col, "packed", "spans")

    def run(batches):
        import hashlib

        import pyarrow as pa
        import zstandard

        from factloom.llm import suffixes

        unpack = zstandard.ZstdDecompressor().decompress
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))] * texts
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                out = []
                for packed_, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    text = unpack(packed_)
                    gone = suffixes.unions((x["lo"], x["hi"]) for x in spans or ())
                    ends = [0, *(x for s in gone for x in s), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                    row = (len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
                    out.append((*row, kept, [{"lo": a, "hi": b} for a, b in gone]) if texts else row)
                cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * len(kinds), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"] * texts])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return mapped(rows, run, schema + ", kept binary, spans array<struct<lo: bigint, hi: bigint>>" * texts)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove(table(spark, sf_dir, "documents"))
