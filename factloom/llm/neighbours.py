"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, as flat arrays.

Distinct vectors are dealt to shards of about SHARD by a hash. Each shard's graph is built at once: a node's
level is drawn geometrically; on every level each node links to its nearest, thinned so that links point in
different directions, and links run both ways up to a cap. Each graph goes to one task, and the queries stream by
it in blocks: they descend its levels and search the lowest with a beam; shard results merge by score. Scores are cosines in double precision
of the original vectors. Equal vectors are one node with their least ids: of any number of equal vectors only
the smallest ids can be among the nearest.

Defined cases: vectors null, empty, zero or holding null or non-finite components, and rows with null ids,
take no part; vectors of another length are of another space and never met; repeated rows count once; a
query's own id is no candidate of it; fewer candidates than k give fewer rows; an empty table gives an empty
result; other columns are ignored. Vectors of any
finite magnitude take part: they are scaled by powers of two, which changes no cosine.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import mapped, save, ship, table

SHARD, LINKS, WIDE, BEAM, BLOCK = 8192, 16, 64, 96, 512
SALTS = 64


def _thin(near: np.ndarray, close: np.ndarray, unit: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first), those nearer to the node than to one taken before; then the nearest rest."""
    between = np.einsum("bid,bjd->bij", unit[near], unit[near])
    taken = np.zeros(near.shape, bool)
    for j in range(near.shape[1]):
        blocked = (taken[:, :j] & (between[:, :j, j] > close[:, j : j + 1])).any(1)
        taken[:, j] = ~blocked & (taken.sum(1) < most)
    order = np.argsort(~taken, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, 1)


def build(unit: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Flat arrays: for level l its nodes (n{l}) and their neighbours (a{l}, -1 where none)."""
    n = len(unit)
    level = np.floor(-np.log(np.random.default_rng(seed).random(n) + 1e-300) / np.log(LINKS)).astype(int)
    out = {}
    for at in range(int(level.max(initial=0)) + 1):
        nodes = np.flatnonzero(level >= at)
        most = 2 * LINKS if at == 0 else LINKS
        own = unit[nodes]
        wide = min(WIDE, len(nodes) - 1)
        if wide < 1:
            out[f"n{at}"], out[f"a{at}"] = nodes.astype(np.int32), np.full((len(nodes), 1), -1, np.int32)
            continue
        ahead = np.empty((len(nodes), min(most, wide)), np.int64)
        for i in range(0, len(nodes), 512):
            close = own[i : i + 512] @ own.T
            close[np.arange(len(close)), np.arange(i, i + len(close))] = -np.inf
            near = np.argpartition(-close, wide - 1, 1)[:, :wide]
            close = np.take_along_axis(close, near, 1)
            order = np.argsort(-close, 1, kind="stable")
            near, close = np.take_along_axis(near, order, 1), np.take_along_axis(close, order, 1)
            for j in range(0, len(near), 64):
                ahead[i + j : i + j + 64] = _thin(near[j : j + 64], close[j : j + 64], own, most)
        a, b = np.repeat(np.arange(len(nodes)), ahead.shape[1]), ahead.ravel()
        src, dst, back = np.concatenate([a, b]), np.concatenate([b, a]), np.repeat([0, 1], len(a))
        _, one = np.unique(src * len(nodes) + dst, return_index=True)
        src, dst, back = src[one], dst[one], back[one]
        order = np.lexsort((-np.einsum("ij,ij->i", own[src], own[dst]), back, src))
        src, dst = src[order], dst[order]
        place = np.arange(len(src)) - np.searchsorted(src, src)
        keep = place < 2 * most
        flat = np.full((len(nodes), 2 * most), -1, np.int32)
        flat[src[keep], place[keep]] = nodes[dst[keep]]
        out[f"n{at}"], out[f"a{at}"] = nodes.astype(np.int32), flat
    return out


def search(unit: np.ndarray, graph: dict[str, np.ndarray], queries: np.ndarray, k: int, beam: int = BEAM) -> np.ndarray:
    """Nodes (one row a query, nearest first by single precision, -1 where none)."""
    n, q = len(unit), len(queries)
    top = max(int(x[1:]) for x in graph if x[0] == "n")
    rows = np.arange(q)
    place = np.full(n, -1, np.int32)
    best = np.full(q, graph[f"n{top}"][0], np.int64)
    value = queries @ unit[best[0]] if q else np.zeros(0, np.float32)
    for at in range(top, 0, -1):
        place[:] = -1
        place[graph[f"n{at}"]] = np.arange(len(graph[f"n{at}"]))
        while True:
            near = graph[f"a{at}"][place[best]]
            close = np.where(near >= 0, np.einsum("qd,qjd->qj", queries, unit[near]), -np.inf)
            j = close.argmax(1)
            better = close[rows, j] > value
            if not better.any():
                break
            best, value = np.where(better, near[rows, j], best), np.where(better, close[rows, j], value)
    beam = min(max(beam, k), n)
    found, score, open_ = np.full((q, beam), -1, np.int64), np.full((q, beam), -np.inf, np.float32), np.zeros((q, beam), bool)
    seen = np.zeros((q, n), bool)
    entries = np.unique(np.linspace(0, n - 1, min(8, n)).astype(int))
    start = np.concatenate([best[:, None], np.broadcast_to(entries, (q, len(entries)))], 1)[:, : max(1, beam)]
    fresh = ~((start[:, :, None] == start[:, None, :]) & (np.arange(start.shape[1])[:, None] > np.arange(start.shape[1])[None])).any(2)
    seen[rows[:, None], start] = True
    close = np.where(fresh, np.einsum("qd,qjd->qj", queries, unit[start]), -np.inf)
    found[:, : start.shape[1]], score[:, : start.shape[1]], open_[:, : start.shape[1]] = np.where(fresh, start, -1), close, fresh
    flat = graph["a0"]
    while open_.any():
        rank = np.where(open_, score, -np.inf)
        pick = np.argpartition(-rank, min(4, beam) - 1, 1)[:, : min(4, beam)]
        live = open_[rows[:, None], pick]
        open_[rows[:, None], pick] = False
        near = np.where(live[:, :, None], flat[np.where(live, found[rows[:, None], pick], 0)], -1).reshape(q, -1)
        near = np.where((near >= 0) & ~seen[rows[:, None], near], near, -1)
        near = np.sort(near, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        hit, col = np.nonzero(near >= 0)
        seen[hit, near[hit, col]] = True
        close = np.full(near.shape, -np.inf, np.float32)
        close[hit, col] = np.einsum("id,id->i", queries[hit], unit[near[hit, col]])
        found, score = np.concatenate([found, near], 1), np.concatenate([score, close], 1)
        open_ = np.concatenate([open_, near >= 0], 1)
        keep = np.argpartition(-score, beam - 1, 1)[:, :beam]
        found, score, open_ = (np.take_along_axis(x, keep, 1) for x in (found, score, open_))
        open_ &= score > -np.inf
    order = np.argsort(-score, 1, kind="stable")[:, :k]
    return np.where(np.take_along_axis(score, order, 1) > -np.inf, np.take_along_axis(found, order, 1), -1)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def valid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col)
    good = (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce((x == x) & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull()).where(good)


def index(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row a shard: (space, shard, vectors, ids, graph). rows: (id, v) as valid() gives them."""
    ship(rows.sparkSession)
    # The k + 1 least ids of equal vectors, by salted ranks, so that any number of them is spread.
    ranked = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))).where(F.col("r") <= k + 1)
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = save(ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    shards = nodes.groupBy(F.size("v").alias("space")).agg(F.ceil(F.count("*") / shard).alias("n"))
    dealt = nodes.withColumn("space", F.size("v")).join(shards, "space").withColumn("shard", F.pmod(F.xxhash64("v", F.lit(3)), F.col("n")))

    def make(pdf):
        import pandas as pd

        from factloom.llm import neighbours

        pdf = pdf.sort_values("v", key=lambda s: s.map(lambda x: x.tobytes()))
        raw = np.stack(pdf["v"].to_numpy())
        unit = neighbours.exact(raw)
        unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
        ids = np.full((len(pdf), k + 1), -1, np.int64)
        have = np.zeros((len(pdf), k + 1), bool)
        for i, x in enumerate(pdf["ids"]):
            ids[i, : len(x)], have[i, : len(x)] = x, True
        body = neighbours.pack({"raw": raw, "ids": ids, "have": have, **neighbours.build(unit)})
        return pd.DataFrame({"space": [int(pdf["space"].iloc[0])], "shard": [int(pdf["shard"].iloc[0])], "body": [body]})

    return save(dealt.select("space", "shard", "v", "ids").groupBy("space", "shard").applyInPandas(make, "space int, shard bigint, body binary"), "graphs")


def exact(x: np.ndarray) -> np.ndarray:
    """Rows by the power of two that brings their largest component to [0.5, 1): a cosine keeps its every bit, and no square overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def answers(arrays: dict[str, np.ndarray], own: np.ndarray, q: np.ndarray, k: int, beam: int):
    """(query_id, vec_id, score) of the k best of a shard's vectors for each query, its own id left out."""
    raw, ids, have, unit = (arrays[x] for x in ("raw", "ids", "have", "unit"))
    q = exact(q)
    part = (q / np.linalg.norm(q, axis=1, keepdims=True)).astype(np.float32)
    found = search(unit, arrays["graph"], part, min(4 * k + 4, len(unit)), beam)
    score = np.einsum("qd,qjd->qj", q, raw[found]) / (np.sqrt((q**2).sum(1))[:, None] * arrays["length"][found])
    hit, col = np.nonzero(found >= 0)
    node = found[hit, col]
    row, member = np.nonzero(have[node])
    q_id, v_id, s, qi = own[hit[row]], ids[node[row], member], score[hit[row], col[row]], hit[row]
    other = q_id != v_id
    q_id, v_id, s, qi = q_id[other], v_id[other], s[other], qi[other]
    order = np.lexsort((v_id, -s, qi))
    keep = order[np.arange(len(order)) - np.searchsorted(qi[order], qi[order]) < k]
    return q_id[keep], v_id[keep], s[keep]


def opened(body: bytes) -> dict:
    """A shard's graph as search() wants it."""
    graph = dict(np.load(io.BytesIO(body)))
    raw, ids, have = (graph.pop(x) for x in ("raw", "ids", "have"))
    raw = exact(raw)
    length = np.sqrt((raw**2).sum(1))
    return {"raw": raw, "ids": ids, "have": have, "unit": (raw / length[:, None]).astype(np.float32), "length": length, "graph": graph}


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", beam: int = BEAM, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of rows found for every row of queries.

    A task gets each of its shards once, the graph first and then the queries, which stream by in blocks.
    """
    graphs = index(valid(rows, id_col, vec_col), k, shard)
    asked = save(valid(queries, id_col, vec_col).distinct().withColumn("space", F.size("v")), "queries")
    places = graphs.select("space", "shard").groupBy("space").agg(F.collect_list("shard").alias("shards"))
    right = asked.join(places, "space").select("space", F.explode("shards").alias("shard"), "id", "v", F.lit(None).cast("binary").alias("body"))
    left = graphs.select("space", "shard", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("v"), "body")

    def run(batches):
        import pyarrow as pa

        from factloom.llm import neighbours

        here, graph = None, None
        for batch in batches:
            at = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            i = 0
            while i < len(at):
                j = i + 1
                while j < len(at) and at[j] == at[i] and j - i < neighbours.BLOCK:
                    j += 1
                part = batch.slice(i, j - i)
                if at[i] != here:
                    # Of a shard's rows the graph comes first.
                    here, graph = at[i], neighbours.opened(part.column(4)[0].as_py())
                    part = part.slice(1)
                if len(part):
                    v = part.column(3)
                    q = v.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                    cols = neighbours.answers(graph, part.column(2).to_numpy(), q, k, beam)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["query_id", "vec_id", "score"])
                i = j

    dealt = left.unionAll(right).repartition("space", "shard").sortWithinPartitions("space", "shard", F.col("id").asc_nulls_first())
    found = mapped(dealt, run, "query_id bigint, vec_id bigint, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"))
