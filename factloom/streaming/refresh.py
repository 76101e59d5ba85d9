"""The change queue as a stream: facts arrive as files, each micro-batch refreshes the entities it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.incremental import refresh
from factloom.operators.survivorship import Rules
from factloom.operators.tables import exists, read_version, write_version


def fact_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def refresher(spark: SparkSession, root: str, rules: Rules, fields: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: adds a batch's new facts to root/facts and writes golden's next version.

    Facts are told apart by row_hash and kept in a folder a batch; versions are named by batch. A batch that runs again
    writes its own folder again and changes nothing else. Only what is not there yet counts as empty; any failure to
    read what is there ends the batch, which the stream then repeats.
    """
    facts_at, golden_at = f"{root}/facts", f"{root}/golden"

    def run(batch: DataFrame, batch_id: int) -> None:
        from factloom.operators.survivorship import golden

        new = batch.dropDuplicates(["row_hash"])
        own = f"{facts_at}/batch={batch_id}"
        # What this batch wrote before it broke off is no fact of the past.
        facts = spark.read.parquet(facts_at).where(F.col("batch") != batch_id).drop("batch").select(*batch.columns) if exists(spark, facts_at) else None
        fresh = new if facts is None else new.join(facts.select("row_hash"), "row_hash", "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(own)
        fresh = spark.read.schema(batch.schema).parquet(own)
        everything = fresh if facts is None else facts.unionByName(fresh)
        before = read_version(spark, golden_at) if exists(spark, f"{golden_at}/current") else golden(fresh.limit(0), rules, fields)
        after, _ = refresh(before, everything, fresh, rules, fields)
        write_version(after, golden_at, f"{batch_id:09d}")

    return run


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Drains what there is and stops."""
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def hourly_counts(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Events by hour and type under a watermark; rows later than it no longer change a window."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")
