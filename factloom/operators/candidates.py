"""Which rows to consider: rule chains whose first hit is the reason, samples, batches, label routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reason(source: Column, code: Column, name: Column, always: list[str], core: list[str], families: list[str], codes: list[str], collisions: list[str], keywords: list[tuple[str, list[str]]]) -> Column:
    """Why a row is a candidate: its source, its code, its family, or a keyword within a family; null if it is not."""
    name, family = F.lower(F.coalesce(name, F.lit(""))), F.substring(code, 1, 4)
    out = F.when(source.isin(always), F.concat(F.lit("source "), source)).when(code.isin(core), F.concat(F.lit("core "), code)).when(family.isin(families), F.concat(F.lit("family "), family)).when(code.isin(codes), F.concat(F.lit("code "), code))
    for word in collisions:
        out = out.when(name.contains(word), F.lit(None))
    for pattern, own in keywords:
        out = out.when(name.rlike(pattern) & family.isin(own), F.concat(F.lit(pattern + " in "), family))
    return out


def route(rows: DataFrame, labels: DataFrame, key: str, bypass: Column) -> DataFrame:
    """Adds `queue`: keep, review or drop by label; rows that bypass are kept; unlabelled rows are reviewed."""
    out = rows.join(labels.select(key, "label"), key, "left")
    queue = F.when(bypass, "keep").when(F.col("label") == "yes", "keep").when(F.col("label") == "no", "drop").otherwise("review")
    return out.withColumn("queue", queue)


def first_per(rows: DataFrame, keys: list[Column], *order: Column) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def sampled(rows: DataFrame, key: str, seed: str, n: int, offset: int = 0) -> DataFrame:
    """A page of rows in an order that the seed gives."""
    return rows.withColumn("_o", F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))).orderBy("_o").offset(offset).limit(n).drop("_o")


def round_robin(rows: DataFrame, stratum: str, *order: Column) -> DataFrame:
    """Adds `turn` (the row's place in its stratum): ordering by (turn, stratum) interleaves strata."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))


def dealt(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(batch, n, batch_hash): batches of about `size` rows by the key's hash, and a hash of what each holds."""
    n = rows.count()
    many = max(1, -(-n // size))
    out = rows.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(many)))
    return out.groupBy("batch").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list(F.col(key).cast("string"))), ","), 256).alias("batch_hash"))


def within_budget(rows: DataFrame, cost: str, ceiling: float, *order: Column, group: str | None = None) -> DataFrame:
    """Adds `queue`: run while the running cost in order stays within the ceiling, else deferred."""
    w = Window.partitionBy(*([group] if group else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("spent", F.sum(cost).over(w)).withColumn("queue", F.when(F.col("spent") <= ceiling, "run").otherwise("deferred"))
