"""Operators that resolve many readings of a field into one value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: Column, *values: Column) -> DataFrame:
    """Per key, the values of the row that is first in `order` (one combining aggregation, no window)."""
    picked = F.min_by(F.struct(*values), order).alias("__v")
    return df.groupBy(*keys).agg(picked).select(*keys, "__v.*")


def plurality(readings: DataFrame, keys: list[str], value: Column, key: Column, seq: Column, page: Column, conf: Column, snappable: Column | None = None, clean: Column | None = None) -> DataFrame:
    """Plurality vote: per case the value of the group ranked first.

    Groups of equal `key` rank by: can be snapped, more pages, more readings, higher confidence, earlier
    first reading. Within the group the representative is clean, long, confident, early. Both levels are
    combining aggregations, so a case with any number of readings needs no task of its own.
    """
    snap = F.lit(True) if snappable is None else snappable
    good = F.lit(True) if clean is None else clean
    shown = readings.select(*keys, value.alias("__value"), key.alias("__key"), seq.alias("__seq"), page.alias("__page"), conf.alias("__conf"), snap.alias("__snap"), good.alias("__clean"))
    shown = shown.where(F.col("__key").isNotNull() & (F.col("__key") != ""))
    sure = F.coalesce("__conf", F.lit(-1.0))
    rep_rank = F.struct((~F.col("__clean")).alias("a"), (-F.length("__value")).alias("b"), (-sure).alias("c"), F.col("__seq").alias("d"))
    groups = shown.groupBy(*keys, "__key").agg(
        F.min_by("__snap", "__seq").alias("snap"),
        F.count_distinct("__page").alias("pages"),
        F.count(F.lit(1)).alias("reads"),
        F.max(sure).alias("conf"),
        F.min("__seq").alias("seq"),
        F.min_by("__value", rep_rank).alias("value"),
    )
    rank = F.struct((~F.col("snap")).alias("a"), (-F.col("pages")).alias("b"), (-F.col("reads")).alias("c"), (-F.col("conf")).alias("d"), F.col("seq").alias("e"))
    return first_by(groups, keys, rank, F.col("value"), F.col("reads"), F.col("pages"))


def majority_id(votes: DataFrame, keys: list[str], vote: str, seq: Column, fallback: Column | None = None) -> DataFrame:
    """The most frequent id; ties go to the one seen first; no votes: the fallback."""
    counts = votes.where(F.col(vote).isNotNull()).groupBy(*keys, vote).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first"))
    best = first_by(counts, keys, F.struct((-F.col("n")).alias("n"), F.col("first")), F.col(vote).alias("winner"), F.col("n").alias("votes"))
    return best if fallback is None else best.withColumn("winner", F.coalesce("winner", fallback))


def excess_mass(lines: Column, floor: float = 40.0, margin: float = 0.9) -> Column:
    """Sum of (mean - floor) * n over confidence lines above the floor and above the page's foot."""
    inside = F.filter(lines, lambda e: e["y"] < margin)
    return F.aggregate(inside, F.lit(0.0), lambda a, e: a + F.greatest(F.lit(0.0), e["mean"] - floor) * e["n"])


def trust_merge(candidates: DataFrame, keys: list[str], field: str, value: str, valid: Column, trust: Column) -> DataFrame:
    """Per case and field the first valid value in order of trust."""
    return first_by(candidates.where(F.coalesce(valid, F.lit(False))), [*keys, field], trust, F.col(value))


def quorum(flags: DataFrame, keys: list[str], page: str, flag: str, strong: Column, needed: int = 2) -> DataFrame:
    """Flags seen strongly once, or weakly in at least `needed` readings of one page."""
    per_page = flags.groupBy(*keys, page, flag).agg(F.max(strong.cast("int")).alias("s"), F.count(F.lit(1)).alias("n"))
    kept = per_page.where((F.col("s") == 1) | (F.col("n") >= needed))
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_set(flag)).alias("flags"))


def unanimous(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value, where all that is known agrees."""
    return df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).where("lo = hi").select(*keys, F.col("lo").alias(value))


def conflicts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Cases with more than one distinct value."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")
