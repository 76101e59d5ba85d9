"""Write semantics on tables without transactions: each gives the next version of a table from the last and new rows."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order: a struct maximum would need one type, so by rank."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def append_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the rows really new, the next table)."""
    fresh = new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return fresh, old.unionByName(fresh)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = ()) -> DataFrame:
    """New rows replace old ones by key; columns in keep hold their first value."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full")
    present = F.col(f"b.{keys[0]}").isNotNull()
    cols = []
    for c in old.columns:
        was, now = F.col(f"a.{c}"), F.col(f"b.{c}")
        cols.append((F.coalesce(was, now) if c in keep or c in keys else F.when(present, now).otherwise(was)).alias(c))
    return joined.select(*cols)


def guarded_upsert(old: DataFrame, new: DataFrame, keys: list[str], guard: Column) -> DataFrame:
    """As upsert, but an old row changes only where the guard (over old, as a.*) holds."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full")
    take = F.col(f"b.{keys[0]}").isNotNull() & (F.col(f"a.{keys[0]}").isNull() | F.coalesce(guard, F.lit(False)))
    return joined.select(*[(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")) if c in keys else F.when(take, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))).alias(c) for c in old.columns])


def replace_parts(old: DataFrame, new: DataFrame, part: str) -> DataFrame:
    """Rows of the parts that new holds are replaced as a whole."""
    return old.join(new.select(part).distinct(), part, "left_anti").unionByName(new)


def delete_keys(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys).distinct(), keys, "left_anti")


def widen(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds the columns that df predates, as null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def fingerprint(df: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """(ids, field, hash): what each field holds."""
    wide = df.select(*ids, *[F.sha2(F.coalesce(F.col(f).cast("string"), F.lit("")), 256).alias(f) for f in fields])
    return wide.unpivot(ids, fields, "field", "hash")


def changes(before: DataFrame, after: DataFrame, ids: list[str]) -> DataFrame:
    """field, added, removed, changed between two fingerprints."""
    a, b = before.withColumnRenamed("hash", "x"), after.withColumnRenamed("hash", "y")
    both = a.join(b, [*ids, "field"], "full")
    return both.groupBy("field").agg(F.count_if(F.col("x").isNull()).alias("added"), F.count_if(F.col("y").isNull()).alias("removed"), F.count_if(F.col("x") != F.col("y")).alias("changed"))


def exists(spark, path: str) -> bool:
    """Whether a file or folder is there; any other failure to look is an error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_version(df: DataFrame, root: str, version: str, part: str | None = None) -> str:
    """Writes a new version beside the old ones and then names it in a pointer.

    Pointers are added, never rewritten, so at any moment the last one names a whole version. A version that is whole
    already is not written again; what a broken run left of one is.
    """
    path = f"{root}/version={version}"
    if not exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path, partitionBy=part)
    df.sparkSession.createDataFrame([(version, time.time_ns())], "version string, at long").coalesce(1).write.mode("append").json(f"{root}/current")
    return path


def read_version(spark, root: str) -> DataFrame:
    version = spark.read.schema("version string, at long").json(f"{root}/current").agg(F.max_by("version", "at")).first()[0]
    return spark.read.parquet(f"{root}/version={version}")


def apply_plan(plan: DataFrame, expected: str, write) -> str:
    """Writes only if the plan computed again still has the hash that was approved; returns the hash."""
    found = plan_hash(plan)
    if found != expected:
        raise ValueError("the plan has changed since it was approved")
    write(plan)
    return found


def plan_hash(plan: DataFrame) -> str:
    """Order-free hash of the rows: sums of two 64-bit hashes and the count."""
    cols = sorted(plan.columns)
    a, b = F.xxhash64(*cols).cast("decimal(38,0)"), F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)")
    return "-".join(str(x) for x in plan.agg(F.sum(a), F.sum(b), F.count("*")).first())
