"""Order-sensitive operators: fills, islands, folds, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.operators.running import cumulate


def forward_fill(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def islands(df: DataFrame, group: list[str], order: list[Column], key: Column, name: str) -> DataFrame:
    """Number of the run of equal neighbours that a row belongs to, from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    fresh = (~key.eqNullSafe(F.lag(key).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return df.withColumn("__fresh", fresh).withColumn(name, F.sum("__fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__fresh")


def nearest_fill(df: DataFrame, group: list[str], at: Column, tie: list[Column], value: Column, name: str) -> DataFrame:
    """The known value of the nearest row by `at`, the earlier one on ties."""
    w = Window.partitionBy(*group).orderBy(at, *tie)
    known = F.when(value.isNotNull(), F.struct(at.alias("t"), value.alias("v")))
    prior = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    later = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    work = df.withColumn("__p", prior).withColumn("__l", later)
    closer = F.col("__l.t").isNotNull() & (F.col("__p.t").isNull() | (F.col("__l.t") - at < at - F.col("__p.t")))
    return work.withColumn(name, F.when(closer, F.col("__l.v")).otherwise(F.col("__p.v"))).drop("__p", "__l")


def round_robin_fold(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """Folds dealt in turn within each group, in a total order; ranks by distributed running totals, so a group may hold any share."""
    placed = cumulate(df, [F.col(g) for g in group], order, {"__turn": F.lit(1)}, "folds")
    return placed.withColumn("fold", (F.col("__turn_before") % k).cast("int")).drop("__turn_before", "__turn_all")


def stratified_split(df: DataFrame, strata: str, key: str, seed: str, share: float) -> DataFrame:
    """Holds out a share of every stratum, in the order of a hash."""
    order = [F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary")), F.col(key)]
    placed = cumulate(df, [F.col(strata)], order, {"__n": F.lit(1)}, "strata")
    held = F.col("__n_before") + 1 <= F.bround(F.col("__n_all") * F.lit(share))
    return placed.withColumn("split", F.when(held, "holdout").otherwise("dev")).drop("__n_before", "__n_all")
