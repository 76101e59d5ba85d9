"""Graphs as edge tables: connected components by least label, merge chains, survivors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared(spark) -> str:
    """The folder that the driver and all executors share; a private one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the folder that all executors share and reads it again."""
    path = f"{shared(df.sparkSession)}/factloom-graph/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the least node reached by edges (a, b).

    Each round every node takes the least label among itself and its neighbours and then its label's label, so
    rounds grow with the logarithm of the longest path. Each round is written, which cuts the lineage.
    """
    links = keep(edges.where("a <> b").select("a", "b").unionAll(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = keep(nodes.select("node").distinct().withColumn("component", F.col("node")), "labels")
    while True:
        near = links.join(label, links["b"] == label["node"]).groupBy("a").agg(F.min("component").alias("m"))
        step = label.join(near, label["node"] == near["a"], "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("now"))
        jump = step.select(F.col("node").alias("hop"), F.col("now").alias("far"))
        label = keep(step.join(jump, step["now"] == jump["hop"], "left").select("node", "was", F.least("now", F.coalesce("far", "now")).alias("component")), "labels")
        moved = label.where("was <> component").limit(1).count()
        label = label.select("node", "component")
        if not moved:
            return label


def survivors(members: DataFrame, weight: str) -> DataFrame:
    """(component, survivor): most weight, then the least node."""
    best = members.groupBy("component").agg(F.max_by("node", F.struct(F.col(weight), -F.col("node"))).alias("survivor"))
    return best


def collapse_report(label: DataFrame) -> DataFrame:
    """n_rows, collapses, rate, corrected."""
    sizes = label.groupBy("component").agg(F.count("*").alias("n"))
    out = sizes.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("collapses"))
    return out.select("n_rows", "collapses", (F.col("collapses") / F.col("n_rows")).alias("rate"), (F.col("n_rows") - F.col("collapses")).alias("corrected"))


def follow(chain: DataFrame, most: int = 64) -> DataFrame:
    """(node, root) for merges (node, into): the end of each chain, by doubling; members of a cycle end at null.

    Each round doubles the hops taken, so chains of 2 ** most links end; what has not ended after as many
    rounds as the table's size needs is a cycle.
    """
    now = keep(chain.select("node", F.col("into").alias("root"), F.lit(True).alias("open")), "chain")
    size = now.count()
    rounds = min(most, max(1, size).bit_length() + 1)
    for _ in range(rounds):
        ahead = now.select(F.col("node").alias("at"), F.col("root").alias("next"))
        now = keep(now.join(ahead, now["root"] == ahead["at"], "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "chain")
        if not now.where("open").limit(1).count():
            break
    return now.select("node", F.when(~F.col("open"), F.col("root")).alias("root"))
