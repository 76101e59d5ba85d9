"""Incremental refresh of golden rows from a queue of changed entities; equals a full rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.survivorship import Rules, golden


def dirty(facts_: DataFrame) -> DataFrame:
    """What a batch of facts puts on the queue: each entity once."""
    return facts_.select("entity").distinct()


def settled(facts_: DataFrame, rules: Rules, fields: list[str], admissible: Column | None = None) -> DataFrame:
    """Golden rows over facts that may win; a fact that may not is out before ranking, which needs no second pass."""
    return golden(facts_.where(admissible) if admissible is not None else facts_, rules, fields)


def refresh(golden_: DataFrame, facts_: DataFrame, queue: DataFrame, rules: Rules, fields: list[str], hold_losses: bool = False) -> tuple[DataFrame, DataFrame]:
    """(next golden, held): rows of queued entities computed again from all their facts; others untouched.

    A queued entity without facts leaves golden. With hold_losses a row that would lose a field it has stays as
    it is and its entity is returned as held, to remain on the queue.
    """
    queue = queue.select("entity").distinct()
    fresh = golden(facts_.join(queue, "entity", "left_semi"), rules, fields)
    kept = golden_.join(queue, "entity", "left_anti")
    if not hold_losses:
        return kept.unionByName(fresh), queue.limit(0)
    new = fresh.select("entity", *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_in"))
    lost = F.lit(False)
    for f in fields:
        lost = lost | (F.col(f).isNotNull() & F.col("_in") & F.col(f"_{f}").isNull())
    held = golden_.join(new, "entity").where(lost).select("entity")
    stay = golden_.join(held, "entity", "left_semi")
    return kept.unionByName(stay).unionByName(fresh.join(held, "entity", "left_anti")), held
