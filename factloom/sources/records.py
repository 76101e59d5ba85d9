"""Records out of lines: gaps, starts, look-ahead, columns, towns; ordered by an explicit position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, part: list[str], order: str, gap: Column) -> DataFrame:
    """Adds `island`: a new number wherever `gap` (over this row and _prev, the order's last value) holds."""
    w = Window.partitionBy(*part).orderBy(order)
    out = df.withColumn("_prev", F.lag(order).over(w)).withColumn("_new", F.coalesce(gap.cast("int"), F.lit(0)))
    return out.withColumn("island", F.sum("_new").over(w)).drop("_prev", "_new")


def assembled(df: DataFrame, part: list[str], order: str, starts: Column, text: str) -> DataFrame:
    """Lines joined into records: a line that starts a record, and those after it; lines before the first go."""
    w = Window.partitionBy(*part).orderBy(order)
    lines = df.withColumn("_s", starts.cast("int")).withColumn("record", F.sum("_s").over(w)).where("record > 0")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")
    return lines.groupBy(*part, "record").agg(joined.alias("text"), F.count("*").alias("n_lines"))


def headed(df: DataFrame, part: list[str], order: str, is_list: Column) -> DataFrame:
    """Lines whose next line is a list: they name an entry. is_list is over `next`, the line after."""
    w = Window.partitionBy(*part).orderBy(order)
    return df.withColumn("next", F.lead("text").over(w)).where(F.coalesce(is_list, F.lit(False)))


def ended(df: DataFrame, part: list[str], order: str, ends: Column, text: str) -> DataFrame:
    """Lines joined into records that a closing line ends: counted from the last line back."""
    w = Window.partitionBy(*part).orderBy(F.desc(order))
    lines = df.withColumn("_e", ends.cast("int")).withColumn("record", F.sum("_e").over(w)).where("record > 0")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")
    return lines.groupBy(*part, "record").agg(joined.alias("text"), F.count("*").alias("n_lines"))


def without_furniture(df: DataFrame, page: str, text: str, least: int = 3) -> DataFrame:
    """Lines that do not recur on `least` pages or more."""
    often = df.groupBy(text).agg(F.count_distinct(page).alias("_p")).where(F.col("_p") >= least)
    return df.join(often.select(text), text, "left_anti")


def towns(df: DataFrame, text: str) -> DataFrame:
    """'A, B & C, OR' as a row a town: the last part is the state of every town before it."""
    parts = F.transform(F.split(text, r"[,&]"), lambda x: F.trim(x))
    return df.withColumn("_p", parts).withColumn("state", F.element_at("_p", -1)).withColumn("town", F.explode(F.slice("_p", 1, F.size("_p") - 1))).where("town <> ''").drop("_p")


def years_folded(df: DataFrame, ids: list[str], years: list[str], starts: str) -> DataFrame:
    """Year columns as one text: the years whose cell begins with `starts`."""
    long = df.select(*ids, *years).unpivot(ids, years, "year", "cell").where(F.col("cell").startswith(starts))
    return long.groupBy(*ids).agg(F.array_join(F.sort_array(F.collect_list("year")), ",").alias("years"))


def pages_alarm(df: DataFrame, group: str, advertised: str, page: str) -> DataFrame:
    """Groups with rows from half of their advertised pages or fewer."""
    g = df.groupBy(group).agg(F.max(advertised).alias("advertised"), F.count_distinct(page).alias("seen"))
    return g.where(F.col("seen") * 2 <= F.col("advertised"))
