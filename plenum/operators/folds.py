"""What the other folds say, for aggregates that can't be taken off again once a fold is in.

A sum of all folds less one is a subtraction; an `and`, a union or a largest gap is not. Each fold's partial state is
made once; what stands before a fold and what stands after it are merged around the fold that is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _merged(kind: str, column: str, frame) -> Column:
    if kind == "sum":
        return F.sum(column).over(frame)
    if kind == "and":
        return F.min(column).over(frame)  # false is less than true; null where nothing is known
    if kind == "union":
        return F.array_distinct(F.flatten(F.collect_list(column).over(frame)))
    raise ValueError(f"no merge of kind {kind}")


def _joined(kind: str, before: Column, after: Column) -> Column:
    if kind == "sum":
        return F.when(before.isNotNull() | after.isNotNull(), F.coalesce(before, F.lit(0)) + F.coalesce(after, F.lit(0)))
    return F.least(before, after) if kind == "and" else F.array_union(before, after)


def complement(states: DataFrame, keys: list[str], fold: str, kinds: dict[str, str]) -> DataFrame:
    """`states` (keys, fold, ...), a row per key and fold, with rest_<name>: the state of the key's other folds.

    Kinds: sum, and (of booleans, null where nothing is known), union (of arrays). A key has as many rows as folds.
    """
    line = Window.partitionBy(*keys).orderBy(fold)
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    made = states.select("*", *[_merged(k, c, before).alias(f"__b_{c}") for c, k in kinds.items()], *[_merged(k, c, after).alias(f"__a_{c}") for c, k in kinds.items()])
    return made.select(*states.columns, *[_joined(k, F.col(f"__b_{c}"), F.col(f"__a_{c}")).alias(f"rest_{c}") for c, k in kinds.items()])


def largest_gaps(rows: DataFrame, day: str, fold: str, n_folds: int) -> DataFrame:
    """(fold, lo, gap): for each fold the largest gap in days between distinct dates of the other folds, the later on ties.

    A date stays for a fold unless that fold alone has it, so dates are read once and not once for each fold.
    """
    dates = rows.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(F.min(fold).alias("least"), F.max(fold).alias("most"))
    sole = F.when(F.col("least") == F.col("most"), F.col("least"))
    kept = dates.select("day", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold"), sole.alias("sole")).where(~F.col("fold").eqNullSafe(F.col("sole")))
    steps = kept.select("fold", "day", F.datediff(F.lead("day").over(Window.partitionBy("fold").orderBy("day")), "day").alias("gap")).where("gap IS NOT NULL")
    best = steps.groupBy("fold").agg(F.max(F.struct("gap", "day")).alias("b"))
    return best.select("fold", F.col("b.day").alias("lo"), F.col("b.gap").alias("gap"))
