"""N-gram Jaccard join by signature trees.

Documents are sets of distinct word shingles. The join goes from coarse to fine, and each step keeps every link:

1. Sets that may be linked are equal in a part of the universe of tokens (sets.part_keys) and meet there. Sizes and
   bitmaps bound what they have in common; what may be linked is joined into families. A task gives only the edges that
   join what it had not joined, so thousands of near copies give edges in proportion to their number.
2. Each family's texts meet once. A signature is a bitmap of a set's tokens, sixteen bits a token. The family's
   sets, ordered by size and signature, are the leaves of a tree whose nodes hold the OR of the bitmaps, the range
   of sizes and the largest number of tokens that fell on bits already set. A dual traversal drops node pairs
   whose sizes can't reach the threshold or whose largest possible overlap is below the least needed; what is
   left and not yet connected is checked on the sets themselves. A family of over GROUP tokens is
   parted by size and then to chunks, every two of which meet (sets.py).
3. Connected components of the links found.

Defined cases: null, empty and blank texts have the empty set and link with nothing (their component is their
own id); fewer words than k make one shingle; equal sets are one class whatever their number; repeated rows
give a row each; a null id takes part and gives a null component where it is the smallest alone; ids are whole
numbers, and one that is text without a whole number counts as null; an empty table gives an empty result; only
the id and text columns are read. A text longer than others takes its own size in memory, and some 30 times that
for its tokens while it is read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import sets
from factloom.llm.common import components, mapped, portions, save, table, utf8
from factloom.llm.suffixes import keyed

K, LIKE = 4, 85
LEAF, FAN, SLICE = 16, 8, 2048


def measured(docs: DataFrame, k: int, t: int) -> DataFrame:
    """(doc_id, key, cls, n, odd): the class and size of each row's set, and its odd bits (sets.py)."""

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for i, j in portions(offsets):
                first, tokens = sets.unit_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                cols = [batch.column(0)[i:j], batch.column(1)[i:j], pa.array(sets.classes(first, tokens).view(np.int64)), pa.array(np.diff(first)), pa.array(sets.odd_bits(first, tokens, t), pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "key", "cls", "n", "odd"])

    rows = keyed(docs).select(sets.whole_number(docs, "doc_id").alias("doc_id"), "key", "text")
    return save(mapped(rows, run, "doc_id bigint, key bigint, cls bigint, n bigint, odd binary"), "sets")


def met(docs: DataFrame, k: int, t: int) -> DataFrame:
    """(token, cls, pos): the keys that two classes or more share; pos tells which rows stand for others (sets.local_ties)."""
    local = sets.LOCAL

    def run(batches):
        import pyarrow as pa

        from factloom.llm import sets

        known: set[int] = set()
        for batch in batches:
            held, size = [], 0
            data, offsets = utf8(batch.column(0))
            for i, j in portions(offsets):
                first, tokens = sets.unit_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                cls = sets.classes(first, tokens)
                row, key = sets.part_keys(first, tokens, t, sets.fresh(cls, known))
                held.append((cls[row], key))
                size += len(key)
                if size > 500_000 or j == len(offsets) - 1:
                    own, key, pos = sets.local_ties(*(np.concatenate(x) for x in zip(*held, strict=True)), local)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(own.view(np.int64)), pa.array(pos)], ["token", "cls", "pos"])
                    held, size = [], 0

    columns = "token bigint, cls bigint, pos int"
    return sets.shared(mapped(keyed(docs).select("text"), run, columns), columns, "met")


class Tree:
    """Rows in order of size in nodes of LEAF rows, these in nodes of FAN, up to one root.

    bits: a bitmap a row; spare: tokens of the row beyond the bits set; comp: rows of one comp need no pair.
    """

    def __init__(self, n, bits, spare, comp):
        self.rows = (n, bits, spare, comp)
        self.levels = [self._node(n, n, bits, spare, comp, comp, np.arange(0, len(n), LEAF))]
        while len(self.levels[-1][0]) > 1:
            last = self.levels[-1]
            self.levels.append(self._node(*last, np.arange(0, len(last[0]), FAN)))

    @staticmethod
    def _node(low, high, bits, spare, c0, c1, at):
        return (np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.bitwise_or.reduceat(bits, at), np.maximum.reduceat(spare, at), np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at))

    def _overlap(self, bits, spare, i, j) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        step = max(1, (8 << 20) // (8 * bits.shape[1]))
        for k in range(0, len(i), step):
            x, y = i[k : k + step], j[k : k + step]
            out[k : k + step] = sets.popcount(bits[x] & bits[y]) + np.minimum(spare[x], spare[y])
        return out

    def pairs(self, t: int):
        """Row pairs i < j that may reach t and are not of one comp, and their largest possible overlap.

        In blocks: a depth-first walk over slices of node pairs, so that a block is bounded whatever the tree.
        """
        start = np.zeros(1, np.int64)
        todo = [(len(self.levels) - 1, start, start)]
        while todo:
            depth, i, j = todo.pop()
            if len(i) > SLICE:
                todo += [(depth, i[k : k + SLICE], j[k : k + SLICE]) for k in range(0, len(i), SLICE)]
                continue
            low, high, bits, spare, c0, c1 = self.levels[depth]
            keep = ~((c0[i] == c1[i]) & (c0[j] == c1[j]) & (c0[i] == c0[j]))
            keep &= (100 * high[i] >= t * low[j]) & (100 * high[j] >= t * low[i])
            i, j = i[keep], j[keep]
            keep = self._overlap(bits, spare, i, j) >= sets.least_common(low[i], low[j], t)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            step, size = (FAN, len(self.levels[depth - 1][0])) if depth else (LEAF, len(self.rows[0]))
            a = (i[:, None] * step + np.arange(step))[:, :, None]
            b = (j[:, None] * step + np.arange(step))[:, None, :]
            a, b = np.broadcast_arrays(a, b)
            ok = (a < size) & (b < size) & ((a < b) if depth == 0 else (a <= b))
            i, j = a[ok], b[ok]
            if depth:
                todo.append((depth - 1, i, j))
                continue
            n, bits, spare, comp = self.rows
            keep = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= t * np.maximum(n[i], n[j]))
            i, j = i[keep], j[keep]
            most = self._overlap(bits, spare, i, j)
            keep = most >= sets.least_common(n[i], n[j], t)
            yield i[keep], j[keep], most[keep]


def signatures(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of sixteen bits a token of the largest set, and the tokens beyond the bits set."""
    n = np.diff(first)
    width = max(64, 1 << int(16 * int(n.max(initial=1)) - 1).bit_length())
    bits = np.zeros((len(n), width // 64), np.uint64)
    own = np.repeat(np.arange(len(n)), n)
    at = (tokens & np.uint64(width - 1)).astype(np.int64)
    np.bitwise_or.at(bits, (own, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return bits, n - sets.popcount(bits)


def meetings(first: np.ndarray, tokens: np.ndarray, t: int, wanted):
    """Pairs (a, b) of the sets tokens[first[i]:first[i + 1]] that signature trees leave, by blocks, likeliest first.

    wanted(a, b) tells of arrays of pairs which are still of use when their block comes up.
    """
    n = np.diff(first)
    order = np.argsort(n, kind="stable")
    # Sizes that may meet lie together: a run of them shares one width of bitmap.
    cuts = [0]
    while cuts[-1] < len(n):
        cuts.append(int(np.searchsorted(n[order], 4 * n[order[cuts[-1]]], "right")))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        hi = int(np.searchsorted(n[order], n[order[hi - 1]] * 100 // t, "right"))  # and those that the last may meet
        part = order[lo:hi]
        size = n[part]
        at = np.concatenate([[0], np.cumsum(size)])
        own = np.concatenate([tokens[first[x] : first[x + 1]] for x in part]) if len(part) else tokens[:0]
        bits, spare = signatures(own, at)
        finer = np.lexsort((bits[:, 0], size))
        size = size[finer]
        for i, j, most in Tree(size, bits[finer], spare[finer], np.arange(len(part))).pairs(t):
            x, y = part[finer[i]], part[finer[j]]
            use = np.flatnonzero(wanted(x, y))
            for k in use[np.argsort(-most[use] / (size[i[use]] + size[j[use]]), kind="stable")].tolist():
                yield int(x[k]), int(y[k])


def reaches(p: np.ndarray, q: np.ndarray, t: int) -> bool:
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= t * (len(p) + len(q) - both)


def linked(first: np.ndarray, tokens: np.ndarray, t: int) -> list[tuple[int, int]]:
    """Spanning edges of the links among the sets tokens[first[i]:first[i + 1]]."""
    label, out = np.arange(len(first) - 1), []
    for x, y in meetings(first, tokens, t, lambda a, b: label[a] != label[b]):
        if label[x] != label[y] and reaches(tokens[first[x] : first[x + 1]], tokens[first[y] : first[y + 1]], t):
            label[label == label[y]] = label[x]
            out.append((x, y))
    return out


def links(docs: DataFrame, found: DataFrame, k: int = K, t: int = LIKE) -> DataFrame:
    """(cls, component) of every class that may be linked to another; found as measured() gives it."""
    one = found.where("n > 0").dropDuplicates(["cls"])
    cells = met(docs, k, t).join(one.select("cls", "n", "odd"), "cls")
    edges = save(sets.families(cells, t), "family-edges")
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select("b")).distinct()
    family = components(edges, nodes).select(F.col("node").alias("cls"), F.col("component").alias("family"))
    family = save(family.join(one.select("cls", "doc_id", "key", F.col("n").alias("size")), "cls"), "families")

    units = save(sets.texts_of(docs, family.select("doc_id", "key", F.col("cls").alias("asked"))), "family-texts")
    groups = sets.dealt(family, t)

    def run(batches):
        import pyarrow as pa

        from factloom.llm import jaccard, sets

        for rows in sets.whole_rows(batches):
            first, tokens = sets.sets_of([r[2].encode() for r in rows], k)
            cuts = np.array([0, *(i for i in range(1, len(rows)) if rows[i][0] != rows[i - 1][0]), len(rows)])
            out = [(rows[x][1], rows[y][1]) for x, y in zip(*sets.small_pairs(first, tokens, cuts, t), strict=True)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > sets.SMALL:
                    out += [(rows[a + x][1], rows[a + y][1]) for x, y in jaccard.linked(first[a : b + 1] - first[a], tokens[first[a] : first[b]], t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], ["a", "b"])

    rows = groups.join(units.withColumnRenamed("asked", "cls"), "cls").select("group", "cls", "text")
    good = save(mapped(rows.repartition("group").sortWithinPartitions("group", "cls"), run, "a bigint, b bigint"), "links")
    return components(good, nodes).select(F.col("node").alias("cls"), "component")


def join(docs: DataFrame, k: int = K, t: int = LIKE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; docs linked by t per cent or more are one component."""
    found = measured(docs, k, t)
    known = links(docs, found, k, t)
    rows = found.select("doc_id", "cls", F.col("n").alias("n_shingles"))
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    rows = rows.where("n_shingles > 0")
    least = rows.groupBy("cls").agg(F.min("doc_id").alias("least")).join(known, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = save(least.select("cls", "component", "least"), "classes")
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(least.join(ids, "component").select("cls", "component_id"), "cls").select("doc_id", "n_shingles", "component_id").unionByName(empty)


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
