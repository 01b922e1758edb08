"""Running ranks over pre-counted values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_rank(counts: DataFrame, group: list[str], value: str, n: str) -> DataFrame:
    """Adds `__before` (rows with smaller values) and `__total` to rows of (group, value, count).

    Values are cut into ranges by quantiles of the distinct values; a range sums its own counts and the
    ranges' sums (one row each) give every range its start, so no window spans all values.
    """
    cuts = 64
    spread = counts.groupBy(*group).agg(F.percentile_approx(value, [k / cuts for k in range(1, cuts)], 10_000).alias("__cuts"))
    spread = spread.select(*[F.col(g).alias(f"__c_{g}") for g in group], "__cuts")
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    # One row without groups; with groups, their number is not known, so Spark chooses by size.
    bucketed = counts.join(spread, on) if group else counts.join(F.broadcast(spread), F.col(n).isNotNull())
    bucketed = bucketed.withColumn("__range", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts", *[f"__c_{g}" for g in group])
    ranges = bucketed.groupBy(*group, "__range").agg(F.sum(n).alias("__sum"))
    up = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*[F.col(g).alias(f"__s_{g}") for g in group], F.col("__range").alias("__r"), F.coalesce(F.sum("__sum").over(up), F.lit(0)).alias("__start"), F.sum("__sum").over(Window.partitionBy(*group)).alias("__total"))
    same = F.col("__range") == F.col("__r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__s_{g}"))
    inside = Window.partitionBy(*group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inner = bucketed.withColumn("__in", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return inner.join(starts if group else F.broadcast(starts), same).withColumn("__before", F.col("__start") + F.col("__in")).drop("__r", "__range", "__start", "__in", *[f"__s_{g}" for g in group])
