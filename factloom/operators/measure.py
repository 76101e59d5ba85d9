"""Gates and measures: shares and bias, precision and recall, quantiles, label moves, evidence rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage_and_bias(found: DataFrame, frame: DataFrame, group: str, large: float) -> DataFrame:
    """group, found, frame, coverage, share difference; is_large marks groups with that share of the frame or more.

    found: (group, found); frame: (group, frame).
    """
    both = frame.join(found, group, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    totals = both.agg(F.sum("found").alias("all_found"), F.sum("frame").alias("all_frame"))
    out = both.join(F.broadcast(totals))  # one row
    share = F.col("frame") / F.col("all_frame")
    return out.select(group, "found", "frame", F.round(F.col("found") / F.col("frame"), 6).alias("coverage"), F.round(F.try_divide(F.col("found"), F.col("all_found")) - share, 6).alias("bias"), (share >= large).alias("is_large"))


def mean_absolute_bias(per_group: DataFrame) -> DataFrame:
    return per_group.where("is_large").agg(F.round(F.avg(F.abs("bias")), 6).alias("mean_abs_bias"), F.count("*").alias("n_groups"))


def confusion(df: DataFrame, truth: Column, said: Column) -> DataFrame:
    return df.groupBy(truth.alias("truth"), said.alias("predicted")).agg(F.count("*").alias("n"))


def precision_recall(df: DataFrame, truth: Column, said: Column, base_rate: float) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and the precision at a base rate other than the sample's."""
    c = df.agg(F.count_if(truth & said).alias("tp"), F.count_if(~truth & said).alias("fp"), F.count_if(truth & ~said).alias("fn"), F.count_if(~truth & ~said).alias("tn"))
    pos, neg = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    weight = F.try_divide(pos * (1 - base_rate), neg * base_rate)
    return c.select("tp", "fp", "fn", "tn", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"), F.round(F.try_divide(F.col("tp"), pos), 6).alias("recall"), F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp") * weight), 6).alias("precision_at_base"))


def label_moves(old: DataFrame, new: DataFrame, key: str, label: str) -> DataFrame:
    """(old, new, n) over rows that both runs labelled."""
    both = old.select(key, F.col(label).alias("old")).join(new.select(key, F.col(label).alias("new")), key)
    return both.groupBy("old", "new").agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """Interpolated 50th and 90th percentile, least and most, and the upper median."""
    return df.groupBy(group).agg(F.percentile(value, F.lit(0.5)).alias("p50"), F.percentile(value, F.lit(0.9)).alias("p90"), F.min(value).alias("least"), F.max(value).alias("most"), F.expr(f"percentile_disc(0.5) within group (order by {value} desc)").alias("upper_median"))


def distance_gate(df: DataFrame, value: str, least_n: int = 10, p90: float = 150, most: float = 500) -> DataFrame:
    """n, p90, most and whether measured distances allow writing; too few are untested, not failed."""
    d = df.agg(F.count(value).alias("n"), F.percentile(value, F.lit(0.9)).alias("p90"), F.max(value).alias("most"))
    return d.withColumn("tested", F.col("n") >= least_n).withColumn("passed", F.when(F.col("n") >= least_n, (F.col("p90") <= p90) & (F.col("most") <= most)))


def gate_row(df: DataFrame, name: str, bad: Column, tested: bool = True) -> DataFrame:
    """name, n, violations, tested, passed for a predicate that no row may meet."""
    g = df.agg(F.count("*").alias("n"), F.count_if(F.coalesce(bad, F.lit(False))).alias("violations"))
    return g.select(F.lit(name).alias("gate"), "n", "violations", ((F.col("n") > 0) & F.lit(tested)).alias("tested"), F.when((F.col("n") > 0) & F.lit(tested), F.col("violations") == 0).alias("passed"))


def drift(now: DataFrame, last: DataFrame, key: str, tolerance: float) -> DataFrame:
    """key, n, last, change and whether the change exceeds the tolerance; a source without a last count does not drift."""
    both = now.join(last, key, "left")
    change = F.try_divide(F.abs(F.col("n") - F.col("last")), F.col("last"))
    return both.select(key, "n", "last", F.round(change, 6).alias("change"), F.coalesce(change > tolerance, F.lit(False)).alias("halts"))


def false_merge(members: DataFrame, group: str, ratio: Column, least: float) -> DataFrame:
    """Groups whose least alike pair of members falls below `least`. members: pairs within groups."""
    return members.groupBy(group).agg(F.min(ratio).alias("least_ratio")).where(F.col("least_ratio") < least)


def by_reason(df: DataFrame, reason: Column) -> DataFrame:
    """Counts of rows by the first failing rule (null: passed)."""
    return df.groupBy(F.coalesce(reason, F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))
