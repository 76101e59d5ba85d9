"""Releases: files with one header, all tables of a release under one pointer, run records, archives and fallbacks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.tables import exists


def with_all_columns(*parts: DataFrame) -> DataFrame:
    """Rows of several tables under the union of their columns, in the order they are first seen, all as text; what a table lacks is empty."""
    columns = list(dict.fromkeys(c for p in parts for c in p.columns))
    out = None
    for p in parts:
        own = p.select(*[(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in p.columns else F.lit("")).alias(c) for c in columns])
        out = own if out is None else out.unionAll(own)
    return out


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A folder of CSV files with one header: the columns given (those a row lacks are empty, others are left out), or all."""
    given = rows if columns is None else rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns])
    given.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def load_release(spark: SparkSession, root: str, release: str, tables: dict[str, DataFrame]) -> str:
    """Writes all tables of a release and, last, one pointer that names it: a reader sees all of a release or none.

    A table that an earlier try wrote whole stays; half a table is written again.
    """
    for name, df in tables.items():
        if not exists(spark, f"{root}/release={release}/{name}/_SUCCESS"):
            df.write.mode("overwrite").parquet(f"{root}/release={release}/{name}")
    spark.createDataFrame([(release, time.time_ns())], "release string, at long").coalesce(1).write.mode("append").json(f"{root}/current")
    return release


def read_release(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the release named last."""
    release = spark.read.schema("release string, at long").json(f"{root}/current").agg(F.max_by("release", "at")).first()[0]
    return spark.read.parquet(f"{root}/release={release}/{name}")


def run_record(parts: DataFrame) -> DataFrame:
    """One row a run: (run_id, minutes, sources, candidates, published, failed) of its stage records (run_id, stage, source, began, ended, rows, ok)."""
    stage = lambda s: F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("rows"))), F.lit(0))
    return parts.groupBy("run_id").agg(
        F.round((F.max("ended") - F.min("began")) / 60, 1).alias("minutes"), F.count_distinct("source").alias("sources"), stage("acquire").alias("candidates"), stage("publish").alias("published"), F.count_if(~F.col("ok")).alias("failed")
    )


def halted(rows: DataFrame, problems: DataFrame) -> DataFrame:
    """The rows of sources without a problem. problems: (source_id, …)."""
    return rows.join(problems.select("source_id").distinct(), "source_id", "left_anti")


def dispatch(sources: DataFrame, fetched: DataFrame, archived: DataFrame) -> DataFrame:
    """(source_id, path, state) of every source. sources: (source_id, class); fetched: (source_id, path, ok); archived: (source_id, date, path).

    What was fetched is read; where that failed, the newest archived copy; a source of a skipped class or without
    any copy says so.
    """
    new = fetched.where("ok").groupBy("source_id").agg(F.min("path").alias("new"))
    old = archived.groupBy("source_id").agg(F.max_by("path", F.struct("date", "path")).alias("old"))
    rows = sources.join(new, "source_id", "left").join(old, "source_id", "left")
    state = F.when(F.col("class") == "lookup", "skipped").when(F.col("new").isNotNull(), "fetched").when(F.col("old").isNotNull(), "archived").otherwise("failed")
    return rows.withColumn("state", state).select("source_id", F.when(F.col("state") == "fetched", F.col("new")).when(F.col("state") == "archived", F.col("old")).alias("path"), "state")


def to_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """(path, size) of the files that a copy of an archive lacks or holds in another size."""
    return source.join(target, ["path", "size"], "left_anti").select("path", "size")


def carried_forward(newest: DataFrame, before: DataFrame, by_hand: list[str]) -> DataFrame:
    """The newest snapshot's files and, of the one before, those made by hand that it lacks. newest, before: (file, path)."""
    made = F.lit(False)
    for pattern in by_hand:
        made = made | F.col("file").like(pattern)
    return newest.unionByName(before.where(made).join(newest.select("file"), "file", "left_anti").select(*newest.columns))


def pages_missing(pages: DataFrame) -> DataFrame:
    """(source_id, alarm) of paged sources. pages: (source_id, page, n, advertised): rows found a page and the pages the source says it has."""
    per = pages.groupBy("source_id").agg(F.count("*").alias("k"), F.count_if(F.col("n") > 0).alias("full"), F.max("advertised").alias("said"), F.sum("n").alias("rows"))
    alarms = [F.when(F.col("full") * 2 <= F.col("k"), "half of the pages are empty"), F.when(F.col("said") > F.col("k"), "advertised pages are missing"), F.when(F.col("rows") < F.col("k"), "fewer rows than pages")]
    return per.select("source_id", F.explode(F.filter(F.array(*alarms), lambda x: x.isNotNull())).alias("alarm"))


def first_column(df: DataFrame, *names: str) -> str | None:
    """The first column whose name, in lower case, holds one of the names."""
    return next((c for c in df.columns if any(n in c.lower() for n in names)), None)


def first_kept(rows: DataFrame, keys: list, order: str) -> DataFrame:
    """The first row of each key; rows with an empty key all stay."""
    key = F.concat_ws("\u0001", *[F.coalesce(k, F.lit("")) for k in keys])
    marked = rows.withColumn("_key", key).withColumn("_blank", F.regexp_replace("_key", "\u0001", "") == "")
    first = marked.where("not _blank").groupBy("_key").agg(F.min(order).alias("_first"))
    return marked.join(first, "_key", "left").where(F.col("_blank") | (F.col(order) == F.col("_first"))).select(*rows.columns)
