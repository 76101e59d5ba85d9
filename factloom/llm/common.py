"""What the operators share: shipping the package, written tables, bytes of an Arrow column."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space and 0x09-0x0D part words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once a session, by Spark's own file server."""
    context = spark.sparkContext
    if getattr(context, "_factloom_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    if top.suffix != ".zip" and top.is_dir():
        out = os.path.join(tempfile.mkdtemp(), "factloom_shipped.zip")
        with zipfile.ZipFile(out, "w") as z:
            for path in sorted([top / "__init__.py", *(top / "llm").glob("*.py")]):
                z.write(path, str(path.relative_to(top.parent)))
        context.addPyFile(out)
    context._factloom_shipped = True


def free(docs: DataFrame, name: str) -> str:
    """A column name that docs has not, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; in local mode a folder of its own where the session names none, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def save(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes df as Parquet to the shared folder, in a folder for each value of by, and reads it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/factloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offset of each row, null as empty; copies nothing without nulls."""
    import pyarrow as pa

    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batch, column: int, most: int = 1 << 22):
    """Parts of an Arrow batch whose texts in that column have at most so many bytes together, or one row."""
    _, offsets = utf8(batch.column(column))
    for i, j in portions(offsets, most):
        yield batch.slice(i, j - i)


def release() -> None:
    """Gives memory that is free but still held back to the system: Python workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # not glibc


LIMIT, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) with this package on the executors; a worker gives its free memory back at the end of a task.

    Batches of long texts end at BATCH bytes, where the session leaves Spark's own limit of 64 MB.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(LIMIT) in ("67108864b", "67108864", "64m"):
        spark.conf.set(LIMIT, BATCH)

    def whole(batches):
        from factloom.llm import common

        try:
            yield from run(batches)
        finally:
            common.release()

    return df.mapInArrow(whole, schema)


def portions(offsets: np.ndarray, most: int = (1 << 19) - 64):
    """Row ranges [i, j) of at most that many bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: Up to so many edges are joined in one task, some 16 bytes each; more go through rounds of shuffles.
ONE_TASK = 500_000


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) for every node; component is the smallest node reached by links (a, b).

    The number of edges is counted first. Beyond ONE_TASK, large-star and small-star steps alternate: each is one
    shuffle over the links, and the number of rounds grows with the logarithm of the longest chain. Each round is
    written to the shared folder.
    """
    edges = save(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.count() <= ONE_TASK:
        found = edges.coalesce(1).mapInArrow(_joined, "u bigint, component bigint")
    else:
        found = _stars(edges).groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(found, nodes["node"] == found["u"], "left").select("node", F.coalesce("component", "node").alias("component"))


def _joined(batches):
    """(u, component) of every end of the edges (u, v)."""
    import pyarrow as pa

    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(u), find(v)
            up[u], up[v] = up.get(u, u), up.get(v, v)
            if x != y:
                up[max(x, y)] = min(x, y)
    ends = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array([find(x) for x in ends], pa.int64())], ["u", "component"])


def _stars(edges: DataFrame) -> DataFrame:
    before = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = save(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now
