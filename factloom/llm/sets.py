"""What exact set-similarity joins share: sets of shingle hashes, keys by which sets meet, bounds, families, checks.

A unit (a document or a line) is the set of its distinct shingles. Units of equal sets are one class. Classes meet by
keys. For lines these are prefixes: in a fixed order of all tokens, rarest first, two sets with Jaccard t or more share a
token among the first n - ceil(t * n) + 1 of each. Rarity is the size of a token's bucket in a sketch of fixed size, ties
by hash: a total order that is the same everywhere, whatever the sketch says, so that no link is lost by it. For documents
they are the contents of parts of the universe of tokens (part_keys). What meets passes bounds by size, position and by
bitmaps of the places on which an odd number of a set's tokens fall; what is left joins families, whose sets are compared.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm import rolling
from factloom.llm.common import mapped, portions, save, utf8

SKETCH = 1 << 16


def least_common(a, b, t: int):
    """Least intersection of sets of a and b tokens with 100 * intersection >= t * union."""
    return -((-t * (a + b)) // (100 + t))


def prefix_length(n, t: int):
    return n + (-t * n) // 100 + 1


def unit_sets(data: np.ndarray, offsets: np.ndarray, k: int, level: np.ndarray | None = None, least_words: int = 1):
    """Distinct tokens of every unit: (first, tokens) with a unit's tokens in the global order.

    level: rarity by sketch bucket; without it the order is by hash.
    """
    data = rolling.lower(data)
    starts, ends, first = rolling.words(data, offsets)
    hashes = rolling.word_hashes(data, starts, ends)
    tokens, at = rolling.shingles(hashes, first, k)
    own = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    if least_words > 1:
        keep = (np.diff(first) >= least_words)[own]
        tokens, own = tokens[keep], own[keep]
    key = tokens >> np.uint64(6)
    if level is not None:
        key = key | (level[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58))
    # One sort of 20 bits of the unit and 44 of the key; where that leaves a tie of different tokens, the full one.
    order = None
    if len(offsets) <= 1 << 20:
        short = own.astype(np.uint64) << np.uint64(44) | key >> np.uint64(20)
        order = np.argsort(short)
        short, there = short[order], tokens[order]
        if ((short[1:] == short[:-1]) & (there[1:] != there[:-1])).any():
            order = None
    if order is None:
        order = np.lexsort((tokens, key, own))
    tokens, own = tokens[order], own[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])
    if not new.all():
        tokens, own = tokens[new], own[new]
    return np.searchsorted(own, np.arange(len(offsets))), tokens


def classes(first: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A hash of each unit's set, whatever the order; 0 for an empty set."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        a, b = np.add.reduceat(rolling.mix(tokens), first[full]), np.bitwise_xor.reduceat(rolling.mix(tokens + np.uint64(1)), first[full])
        out[full] = rolling.mix(a ^ rolling.mix(b + np.diff(first)[full].astype(np.uint64))) | np.uint64(1)
    return out


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows (each with its line feed), and the first line of each row."""
    cuts = np.flatnonzero(data == 10) + 1
    bounds = np.unique(np.concatenate([offsets, cuts]))
    return bounds, np.searchsorted(bounds, offsets)


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for buckets up to four times the mean, then the doublings beyond it."""
    mean = max(1.0, counts.mean()) * 4
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / mean)), 0, 31).astype(np.uint8)


def read_levels(sketch: DataFrame) -> tuple[np.ndarray, int]:
    """Levels and the number of tokens. sketch: (bucket, n). At most SKETCH rows come to the driver."""
    counts = np.zeros(SKETCH)
    for r in sketch.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return levels(counts), int(counts.sum())


#: Cells of prefixes that a task gathers before it deals them to parts; the most a part holds on average, and parts a shuffle partition.
DEAL, PART, SPREAD = 1 << 20, 100_000, 8
CELL = np.dtype([("token", "<i8"), ("cls", "<i8"), ("pos", "<i4")])


def parts_of(cells: int, partitions: int) -> int:
    """Parts for so many cells: so small that a task holds little, so many that hashing spreads them over the partitions."""
    return max(-(-cells // PART), SPREAD * partitions)


def prefixes(rows: DataFrame, k: int, t: int, level: np.ndarray, least_words: int, parts: int) -> DataFrame:
    """(part, cells): the prefix of every class of lines as packed CELLs, dealt to parts by the token; a task gives a class once (in a memo of bounded size).

    Cells go in runs, as a row for each is far dearer to shuffle and sort. Sets so small that only an equal set can reach t give none: equal sets are one class.
    """
    given, most = rows.sparkSession.sparkContext.broadcast(level), DEAL

    def run(batches):
        import pyarrow as pa

        from factloom.llm import rolling, sets

        def dealt(held):
            cells = np.concatenate(held)
            # Prefixes hold the least hashes of their sets: only mixed anew do they spread evenly.
            spread = rolling.mix(cells["token"].view(np.uint64) + np.uint64(5)) >> np.uint64(32)
            part = (spread * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
            cells, size = cells[np.argsort(part, kind="stable")], np.bincount(part, minlength=parts)
            full = np.flatnonzero(size)
            ends = pa.array(np.concatenate([[0], np.cumsum(size[full]) * sets.CELL.itemsize]), pa.int64())
            packed = pa.Array.from_buffers(pa.large_binary(), len(full), [None, ends.buffers()[1], pa.py_buffer(cells)])
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), packed.cast(pa.binary())], ["part", "cells"])

        known: set[int] = set()
        held, gathered = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in portions(offsets):
                part, offs = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                first, tokens = sets.unit_sets(part, sets.line_offsets(part, offs)[0], k, given.value, least_words)
                cls, n = sets.classes(first, tokens), np.diff(first)
                fresh = sets.fresh(cls, known) & (100 * n >= t * (n + 1))
                size = np.where(fresh, sets.prefix_length(n, t), 0)
                own = np.repeat(np.arange(len(n)), size)
                cells = np.empty(len(own), sets.CELL)
                cells["pos"] = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
                cells["token"], cells["cls"] = tokens[first[own] + cells["pos"]].view(np.int64), cls[own].view(np.int64)
                held.append(cells)
                gathered += len(cells)
                if gathered >= most:
                    yield from dealt(held)
                    held, gathered = [], 0
        if gathered:
            yield from dealt(held)

    return mapped(rows.select("text"), run, "part bigint, cells binary")


def shared_cells(packed: DataFrame, name: str) -> DataFrame:
    """(token, cls, pos) of the tokens that two classes or more share, each class once a token. packed: (part, cells)."""

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        def settled(held):
            cells = np.frombuffer(b"".join(held), sets.CELL)
            held.clear()
            order = np.argsort(cells["token"])
            token = cells["token"][order]
            again = token[1:] == token[:-1]
            both = np.zeros(len(token), bool)
            both[1:] |= again
            both[:-1] |= again
            g = sets.once({c: cells[c][order[both]] for c in ("token", "cls", "pos")}, ["token", "cls", "pos"])
            if len(g["token"]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in g.values()], list(g))

        held, own = [], None
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and part != own:
                    yield from settled(held)
                own = part
                held.append(cells.as_buffer().to_pybytes())
        if held:
            yield from settled(held)

    rows = packed.repartition("part").sortWithinPartitions("part")
    return save(mapped(rows, run, "token bigint, cls bigint, pos int"), name)


def once(g: dict, names: list[str]) -> dict:
    """The rows of tokens that two classes or more share, each class once a token, by its least row, in order."""
    order = np.lexsort((*(g[c] for c in names[:1:-1]), g["cls"], g["token"]))
    g = {c: v[order] for c, v in g.items()}
    token, cls = g["token"], g["cls"]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
    g = {c: v[new] for c, v in g.items()}
    size = group_sizes(g["token"])
    keep = np.repeat(size > 1, size)
    return {c: v[keep] for c, v in g.items()}


def fresh(cls: np.ndarray, known: set) -> np.ndarray:
    """Which classes (0 is none) are not known yet; they are from now on."""
    out = np.zeros(len(cls), bool)
    if len(known) > MEMO:
        known.clear()
    kinds, at = np.unique(cls, return_index=True)
    for c, u in zip(kinds.tolist(), at.tolist(), strict=True):
        if c and c not in known:
            known.add(c)
            out[u] = True
    return out


def bands(t: int) -> np.ndarray:
    """Least sizes of bands of set sizes; sets that may reach t are of the same or of neighbouring bands."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(out[-1] * 10000 // (t * t) + 1)
    return np.array(out)


def band_parts(low: int, top: int, t: int) -> tuple[int, int]:
    """(parts, spare) for pairs whose smaller set has low to top tokens: they differ by at most parts - 1 - spare tokens.

    spare is about the most parts that stay empty by chance. No parts where such sets can only be equal.
    """
    differ = (100 - t) * (top + 100 * top // t) // (100 + t)
    if differ == 0:
        return 0, 0
    spare = 1
    for _ in range(6):
        m = differ + 1 + spare
        empty = m * np.exp(-low / m)
        spare = 1 + int(np.ceil(empty + 5 * np.sqrt(empty)))
    return differ + 1 + spare, spare


def part_keys(first: np.ndarray, tokens: np.ndarray, t: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): keys of which two different sets that reach t share one at least. Their lowest bit is 0. wanted: of which sets.

    A band of sizes parts the universe of tokens into m parts by hash. Two sets that reach t differ by so few tokens
    that they are equal in more than `spare` parts. A key is the content of a part that is not empty; a set with more than
    `spare` empty parts gives those as keys too, for two sets equal in empty parts alone both have so many. A pair meets in
    the band of the smaller set, so a set gives the keys of its own band and of the one below if that has partners.
    """
    low = bands(t)
    n = np.diff(first)
    own = np.repeat(np.arange(len(n)), n)
    spread = rolling.mix(tokens + np.uint64(77))
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for below in (0, 1):
        band = np.searchsorted(low, n, "right") - 1 - below
        use = (n > 0) & (band >= 0) & (True if wanted is None else wanted)
        top = low[np.maximum(band, 0) + 1] - 1
        if below:
            use &= 100 * top >= t * n
        m, spare = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for x in np.unique(band[use]).tolist():
            m[use & (band == x)], spare[use & (band == x)] = band_parts(int(low[x]), int(low[x + 1] - 1), t)
        at = np.concatenate([[0], np.cumsum(m)])
        there = m[own] > 0
        h, o = spread[there], own[there]
        held = np.zeros(at[-1], np.uint64)
        np.add.at(held, at[o] + ((h >> np.uint64(32)) * m[o].astype(np.uint64) >> np.uint64(32)).astype(np.int64), h | np.uint64(1))
        row = np.repeat(np.arange(len(n)), m)
        full = held != 0
        gives = full | (np.bincount(row[~full], minlength=len(n)) > spare)[row]
        part = np.arange(at[-1]) - at[row]
        key = rolling.mix(held + rolling.mix((part + (band[row] << 32)).astype(np.uint64)))
        rows.append(row[gives])
        keys.append(key[gives] & ~np.uint64(1))
    return np.concatenate(rows), np.concatenate(keys)


#: A key with more classes in one batch sends only the first and ties the others to it.
LOCAL = 32


#: The position of a row that stands for others of its key: all that have the key become one family.
TIED = -2


def local_ties(cls: np.ndarray, keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cls, key, pos) rows with each class once a key; keys of over `most` classes keep their least one, to which the others are tied.

    A tie is a key of its own, with the lowest bit set, that two classes share. The row that is kept has the position
    TIED: who meets it elsewhere may be linked to one that it stands for, so no bound is asked there.
    """
    order = np.lexsort((cls, keys))
    cls, keys = cls[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (cls[1:] != cls[:-1])
    cls, keys = cls[new], keys[new]
    size = group_sizes(keys)
    many = np.repeat(size > most, size)
    if not many.any():
        return cls, keys, np.full(len(keys), -1, np.int32)
    begin = np.repeat(np.cumsum(size) - size, size)
    lead = begin == np.arange(len(keys))
    a, b = cls[begin[many & ~lead]], cls[many & ~lead]
    pair, one = np.unique(rolling.mix(a ^ rolling.mix(b)) | np.uint64(1), return_index=True)
    keep = ~many | lead
    pos = np.concatenate([np.where(many, TIED, -1)[keep], np.full(2 * len(one), -1)]).astype(np.int32)
    return np.concatenate([cls[keep], a[one], b[one]]), np.concatenate([keys[keep], pair, pair]), pos


def whole_groups(batches, names, key: str = "token"):
    """Batches as dicts of numpy arrays that end where a key ends; rows come in the order of the key."""
    held = None
    for batch in batches:
        now = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            now = {c: np.concatenate([held[c], now[c]]) for c in names}
        n = len(now[key])
        if n == 0:
            continue
        cut = int(np.searchsorted(now[key], now[key][-1]))
        held = {c: v[cut:] for c, v in now.items()}
        if cut:
            yield {c: v[:cut] for c, v in now.items()}
    if held is not None and len(held[key]):
        yield held


def whole_number(docs: DataFrame, column: str):
    """A column as bigint; text that is no whole number as null."""
    return F.expr(f"try_cast(`{column}` as bigint)") if docs.select(column).schema[0].dataType.typeName() == "string" else F.col(column).cast("bigint")


def shared(rows: DataFrame, columns: str, name: str) -> DataFrame:
    """The rows of tokens that two classes or more share, each class once a token, by its least row. rows: (token, cls, ...), columns: their kinds."""
    names = [x.split()[0] for x in columns.split(", ")]

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        for g in sets.whole_groups(batches, names):
            token = g["token"]
            again = token[1:] == token[:-1]
            both = np.zeros(len(token), bool)
            both[1:] |= again
            both[:-1] |= again
            g = {c: v[both] for c, v in g.items()}
            g = sets.once(g, names)
            if len(g["token"]):
                yield pa.RecordBatch.from_arrays([pa.array(g[c]) for c in names], names)

    return save(mapped(rows.repartition("token").sortWithinPartitions("token"), run, columns), name)


def group_sizes(key: np.ndarray) -> np.ndarray:
    """Lengths of the runs of equal keys."""
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return np.diff(np.append(begin, len(key)))


def odd_words(n, t: int):
    """Words of 64 bits of a set's odd bits: four to eight times the tokens that two such sets may differ by, a power of two."""
    bits = np.maximum(128, 8 * (100 - t) * np.asarray(n, np.int64) // (100 + t))
    return 1 << np.ceil(np.log2(bits / 64)).astype(np.int64)


def odd_bits(first: np.ndarray, tokens: np.ndarray, t: int) -> list[bytes]:
    """For each set a bitmap of the places that an odd number of its tokens fall on.

    The bits in which two differ can't outnumber the tokens in one set alone. A longer bitmap folds to a shorter.
    """
    n = np.diff(first)
    size = np.where(n > 0, odd_words(n, t), 0)
    at = np.concatenate([[0], np.cumsum(size)])
    own = np.repeat(np.arange(len(n)), n)
    bits = np.zeros(at[-1], np.uint64)
    place = at[own] + ((tokens >> np.uint64(6)).astype(np.int64) & (size[own] - 1))
    np.bitwise_xor.at(bits, place, np.uint64(1) << (tokens & np.uint64(63)))
    raw = bits.tobytes()
    return [raw[8 * a : 8 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_COUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def popcount(x: np.ndarray) -> np.ndarray:
    """Bits set in the last axis of 64-bit words."""
    if hasattr(np, "bitwise_count"):
        return np.bitwise_count(x).sum(-1, dtype=np.int64)
    return _COUNT[np.ascontiguousarray(x).view(np.uint16)].sum(-1, dtype=np.int64)


class Signs:
    """Sizes and odd bits of the rows of an Arrow column, as arrays."""

    def __init__(self, n: np.ndarray, odd):
        raw, at = utf8(odd)
        self.n, self.at, self.size = n.astype(np.int64), at[:-1] >> 3, np.diff(at) >> 3
        self.bits = np.frombuffer(raw.tobytes(), np.uint64)

    def near(self, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
        """Which pairs of rows may reach t by their sizes and odd bits."""
        a, b = self.n[i], self.n[j]
        out = 100 * np.minimum(a, b) >= t * np.maximum(a, b)
        most = a + b - 2 * least_common(a, b, t)
        wide = np.maximum(self.size[i], self.size[j]) << 32 | np.minimum(self.size[i], self.size[j])
        for w in np.unique(wide[out]).tolist():
            rows = np.flatnonzero(out & (wide == w))
            step = max(1, (1 << 20) // (w >> 32))
            for k in range(0, len(rows), step):
                r = rows[k : k + step]
                x = self._folded(i[r], w & 0xFFFFFFFF) ^ self._folded(j[r], w & 0xFFFFFFFF)
                out[r] = popcount(x) <= most[r]
        return out

    def _folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The odd bits of rows as a matrix of that many words; all of them are that long, or all twice as long or more."""
        out = np.empty((len(rows), width), np.uint64)
        for s in np.unique(self.size[rows]).tolist():
            hit = self.size[rows] == s
            own = self.bits[self.at[rows[hit]][:, None] + np.arange(s)]
            out[hit] = np.bitwise_xor.reduce(own.reshape(len(own), -1, width), 1) if s > width else own
        return out


class Union(dict):
    """Disjoint sets of whatever is asked for."""

    def find(self, x):
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while self.get(x, x) != root:
            self[x], x = root, self.get(x, x)
        return root

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


#: Rows of one token that are compared with each other; the rows of a more frequent token all become one family,
#: whose sets meet by size and in chunks (dealt).
FREQUENT = 1 << 16
#: Entries of a union or a memo of classes before it starts anew.
MEMO = 200_000


def families(cells: DataFrame, t: int) -> DataFrame:
    """Edges (a, b) whose components hold every link. cells: (token, cls, n, odd, pos), pos null or negative where there is no order.

    Sets of a and b tokens that share one at positions i and j of the global order have at most
    min(i, j) + min(a - i, b - j) in common. Tokens with the lowest bit set and no position join all their rows, and so
    do those of which one row is TIED.
    """

    frequent = FREQUENT

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        union = sets.Union()
        for part, more in sets.whole_tables(batches, frequent):
            if len(union) > sets.MEMO:
                union.clear()
            token, cls = (part.column(c).to_numpy() for c in ("token", "cls"))
            n, pos = part.column("n").to_numpy(), part.column("pos").fill_null(-1).to_numpy().astype(np.int64)
            signs, out = sets.Signs(n, part.column("odd")), []
            size = sets.group_sizes(token)
            begin = np.cumsum(size) - size
            tied = np.minimum.reduceat(pos, begin) == sets.TIED
            every = ((token[begin] & 1 == 1) & (pos[begin] < 0)) | tied | (size > frequent) | more

            def may(i, j, pos=pos, signs=signs):
                a, b = signs.n[i], signs.n[j]
                ok = (pos[i] < 0) | (np.minimum(pos[i], pos[j]) + np.minimum(a - pos[i], b - pos[j]) >= sets.least_common(a, b, t))
                i, j = i[ok], j[ok]
                ok = signs.near(i, j, t)
                return i[ok], j[ok]

            def joined(i, j, cls=cls, out=out):
                for a, b in zip(cls[i].tolist(), cls[j].tolist(), strict=True):
                    if union.join(a, b):
                        out.append((a, b))

            # Each row with the first of its token; then all that are not yet joined.
            lead = np.repeat(begin, size)
            rest = np.flatnonzero(lead != np.arange(len(token)))
            free = np.repeat(every, size)[rest]
            joined(lead[rest[free]], rest[free])
            joined(*may(lead[rest[~free]], rest[~free]))
            small = ~every & (size > 2) & (size <= 64)
            rows = np.flatnonzero(np.repeat(small, size))
            kinds, back = np.unique(cls[rows], return_inverse=True)
            root = np.array([union.find(x) for x in kinds.tolist()], np.int64)[back]
            for i, j in sets.some_within(size[small]):
                differ = root[i] != root[j]
                joined(*may(rows[i[differ]], rows[j[differ]]))
            for at, s in zip(begin[~every & (size > 64)].tolist(), size[~every & (size > 64)].tolist(), strict=True):
                _, root = np.unique([union.find(x) for x in cls[at : at + s].tolist()], return_inverse=True)
                # Rows come in order of size; some rows at a time meet those after them.
                own = n[at : at + s]
                later = np.searchsorted(own, 100 * own // t, "right") - np.arange(s) - 1
                for rows in np.split(np.arange(s), np.flatnonzero(np.diff(np.cumsum(later) >> 15)) + 1):
                    i = np.repeat(rows, later[rows])
                    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later[rows]) - later[rows], later[rows])
                    differ = root[i] != root[j]
                    if not differ.any():
                        continue
                    i, j = may(at + i[differ], at + j[differ])
                    for x, y in zip((i - at).tolist(), (j - at).tolist(), strict=True):
                        if root[x] != root[y]:
                            union.join(int(cls[at + x]), int(cls[at + y]))
                            out.append((int(cls[at + x]), int(cls[at + y])))
                            root[root == root[y]] = root[x]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    rows = cells.select("token", "cls", "n", "odd", "pos").repartition("token").sortWithinPartitions("token", "n")
    return mapped(rows, run, "a bigint, b bigint").distinct()


def whole_tables(batches, most: int):
    """(table, more): tables that end where a token ends; a token of over `most` rows comes alone, in parts with more set, each after the first led by its first row."""
    import pyarrow as pa

    held, lead, own = None, None, 0
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        token = held.column("token").to_numpy()
        if lead is not None and len(token):
            end = int(np.searchsorted(token, own, "right")) if token[0] == own else 0
            if end:
                yield pa.concat_tables([lead, held.slice(0, end)]).combine_chunks(), True
            if end < len(token):
                lead = None
            held, token = held.slice(end), token[end:]
        if not len(token):
            continue
        cut = int(np.searchsorted(token, token[-1]))
        if cut:
            yield held.slice(0, cut).combine_chunks(), False
            held = held.slice(cut)
        if len(held) > most:
            lead, own = held.slice(0, 1).combine_chunks(), token[-1]
            yield held.combine_chunks(), True
            held = held.slice(len(held))
    if held is not None and len(held):
        yield held.combine_chunks(), False


def some_within(size: np.ndarray, most: int = 1 << 17):
    """All pairs i < j of rows in consecutive groups of the given sizes, some groups at a time."""
    first = np.cumsum(size) - size
    for rows in np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size * size) // most)) + 1) if len(size) else []:
        i, j = within(size[rows])
        yield i + first[rows[0]], j + first[rows[0]]


def in_common(first: np.ndarray, tokens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets, a million tokens of pairs in one sort."""
    size = (first[a + 1] - first[a]) + (first[b + 1] - first[b])
    out = np.zeros(len(a), np.int64)
    for rows in np.split(np.arange(len(a)), np.flatnonzero(np.diff(np.cumsum(size) >> 20)) + 1) if len(a) else []:
        sides = []
        for x in (a[rows], b[rows]):
            n = first[x + 1] - first[x]
            sides.append((np.repeat(np.arange(len(rows)), n), tokens[np.repeat(first[x] - (np.cumsum(n) - n), n) + np.arange(n.sum())]))
        own, held = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
        order = np.lexsort((held, own))
        own, held = own[order], held[order]
        out[rows] = np.bincount(own[1:][(held[1:] == held[:-1]) & (own[1:] == own[:-1])], minlength=len(rows))
    return out


#: Groups of up to so many sets are settled together, every pair of theirs counted; larger ones go through a tree.
SMALL = 16


def small_pairs(first: np.ndarray, tokens: np.ndarray, cuts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of sets that reach t, within groups cuts[i]:cuts[i + 1] of up to SMALL sets."""
    size = np.diff(cuts)
    few = size <= SMALL
    rows = np.flatnonzero(np.repeat(few, size))
    i, j = within(size[few])
    a, b = rows[i], rows[j]
    n = np.diff(first)
    near = 100 * np.minimum(n[a], n[b]) >= t * np.maximum(n[a], n[b])
    a, b = a[near], b[near]
    both = in_common(first, tokens, a, b)
    good = 100 * both >= t * (n[a] + n[b] - both)
    return a[good], b[good]


#: What one task holds at most, in tokens; a set counts as LEAST_SIZE at least, which bounds a group's pairs too.
GROUP, LEAST_SIZE = 2_000_000, 500


def dealt(members: DataFrame, t: int) -> DataFrame:
    """(cls, group): groups in which every two members of a family whose sizes may meet are together.

    members: (cls, family, size). A family of up to GROUP tokens is one group. A larger one is parted by size: in
    steps of t per cent, a set can only meet those of its own and the next step, so each step and the next make a
    group; if that is too large as well, it is dealt to chunks and every two chunks make a group.
    """
    weight = F.greatest(F.col("size"), F.lit(LEAST_SIZE))
    total = members.groupBy("family").agg(F.sum(weight).alias("tokens"))
    rows = members.join(total, "family")
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / t)) + 1e-9).cast("int")
    steps = F.when(F.col("tokens") > GROUP, F.array(step, step - 1)).otherwise(F.array(F.lit(-9)))
    rows = rows.select("cls", "size", "family", F.explode(steps).alias("step"))
    many = rows.groupBy("family", "step").agg(F.ceil(F.sum(weight) / GROUP).cast("int").alias("chunks"))
    rows = rows.join(many, ["family", "step"]).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select("cls", F.xxhash64("family", "step", F.least("own", "other"), F.greatest("own", "other")).alias("group"))


def sets_of(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, tokens) of many texts, some at a time."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    firsts, parts, at = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)], 0
    for i, j in portions(offsets):
        first, tokens = unit_sets(np.frombuffer(b"".join(texts[i:j]), np.uint8), offsets[i : j + 1] - offsets[i], k)
        firsts.append(first[1:] + at)
        parts.append(tokens)
        at += len(tokens)
    return np.concatenate(firsts), np.concatenate(parts)


def texts_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (doc_id, key, asked) with the text of each document; one that stands in several rows comes as often."""
    from factloom.llm.suffixes import keyed

    asked = asked.select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "asked").hint("shuffle_hash")
    rows = keyed(docs).select(whole_number(docs, "doc_id").alias("doc_id"), "key", "text")
    return rows.join(asked, (rows["key"] == asked["k"]) & rows["doc_id"].eqNullSafe(asked["id"])).select("text", "asked")


def whole_rows(batches, key: int = 0, most: int = 1 << 20, text: int = 2):
    """Lists of rows (group, cls, text, ..) that end where a group ends; small groups come together, a row that repeats the class before it goes."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:2] == held[-1][:2]:
                continue
            if held and size > most and row[key] != held[-1][key]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[text])
    if held:
        yield held


def within(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs i < j of rows in consecutive groups of the given sizes."""
    end = np.repeat(np.cumsum(size), size)
    n = int(size.sum())
    later = end - np.arange(n) - 1
    i = np.repeat(np.arange(n), later)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
