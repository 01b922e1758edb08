"""Offline evaluation: shrunken rates, lift, calibration, percentiles, drift, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.operators.ranks import running_rank as _running_rank


def shrunken_accuracy(rows: DataFrame, branch: str, predicted: str, hit: Column, k: float = 10.0, clamp: tuple[float, float] = (0.05, 0.95)) -> DataFrame:
    """Per branch: hits shrunk towards the mean class prior of its rows. One pass over classes, one over branches."""
    cells = rows.groupBy(branch, predicted).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("long")).alias("hits"))
    by_class = cells.groupBy(F.col(predicted).alias("__c")).agg((F.sum("hits") / F.sum("n")).alias("class_prior"))
    joined = cells.join(by_class, F.col(predicted) == F.col("__c"))
    g = joined.groupBy(branch).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), (F.sum(F.col("class_prior") * F.col("n")) / F.sum("n")).alias("prior"))
    shrunk = (F.col("hits") + k * F.col("prior")) / (F.col("n") + k)
    return g.select(branch, "n", "hits", "prior", shrunk.alias("shrunk"), F.bround(F.greatest(F.lit(clamp[0]), F.least(F.lit(clamp[1]), shrunk)), 3).alias("confidence"))


def cell_refinement(rows: DataFrame, table: DataFrame, branch: str, cell: str, hit: Column, k: float = 10.0, least: int = 5, clamp: tuple[float, float] = (0.05, 0.95)) -> DataFrame:
    """Cells with support that move off their branch's value, shrunk towards it before clamping."""
    cells = rows.groupBy(branch, cell).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("long")).alias("hits")).where(F.col("n") >= least)
    b = table.select(F.col(branch).alias("__b"), "shrunk", F.col("confidence").alias("__conf"))
    joined = cells.join(b, F.col(branch) == F.col("__b"))
    value = F.bround(F.greatest(F.lit(clamp[0]), F.least(F.lit(clamp[1]), (F.col("hits") + k * F.col("shrunk")) / (F.col("n") + k))), 3)
    return joined.select(branch, cell, F.col("n"), value.alias("value"), "__conf").where("value <> __conf").drop("__conf")


def lift(rows: DataFrame, features: Sequence[str], target: Column, least: int = 15) -> DataFrame:
    """Every feature=value cell with support: rate, lift and z against the base rate."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features]))
    long = rows.select(target.cast("long").alias("y"), cells.alias("c")).where("c.value IS NOT NULL")
    g = long.groupBy(F.col("c.feature").alias("feature"), F.col("c.value").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    base = rows.agg(F.sum(target.cast("long")).alias("h"), F.count(F.lit(1)).alias("m"))
    j = g.where(F.col("n") >= least).join(F.broadcast(base.select((F.col("h") / F.col("m")).alias("base"))), F.col("n").isNotNull())
    rate = F.col("hits") / F.col("n")
    return j.select("feature", "value", "n", "hits", rate.alias("rate"), (rate / F.col("base")).alias("lift"), ((rate - F.col("base")) / F.sqrt(F.col("base") * (1 - F.col("base")) / F.col("n"))).alias("z"))


def brier(rows: DataFrame, conf: Column, correct: Column) -> DataFrame:
    """Mean squared gap and the calibration points that it earns."""
    gap = F.avg(F.pow(conf - correct.cast("double"), F.lit(2)))
    return rows.agg(F.count(F.lit(1)).alias("n"), gap.alias("brier")).withColumn("points", 20 * F.greatest(F.lit(0.0), 1 - 2 * F.col("brier")))


def nearest_rank(rows: DataFrame, value: str, percents: Sequence[int], group: Sequence[str] = ()) -> DataFrame:
    """sorted[round_half_even(q / 100 * (n - 1))] for each percent and group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = _running_rank(counts, list(group), value, "__n")
    wanted = F.explode(F.array(*[F.lit(q) for q in percents]))
    asked = placed.groupBy(*group).agg(F.max("__total").alias("__m")).select(*group, F.col("__m"), wanted.alias("q"))
    asked = asked.withColumn("__at", F.bround(F.col("q") / 100.0 * (F.col("__m") - 1)).cast("long")).select(*[F.col(g).alias(f"__g_{g}") for g in group], "q", "__at")
    on = (F.col("__at") >= F.col("__before")) & (F.col("__at") < F.col("__before") + F.col("__n"))
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return placed.join(asked if group else F.broadcast(asked), on).select(*group, "q", F.col(value).alias("pick"))


def index_percentiles(rows: DataFrame, value: str, percents: Sequence[int]) -> DataFrame:
    """(q, pick): sorted[int(n * q / 100)] for each percent."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    placed = _running_rank(counts, [], value, "__n").withColumn("q", F.explode(F.array(*[F.lit(x) for x in percents])))
    at = F.floor(F.col("__total") * F.col("q") / 100)
    return placed.where((at >= F.col("__before")) & (at < F.col("__before") + F.col("__n"))).select("q", F.col(value).alias("pick"))


def max_gap_midpoint(rows: DataFrame, day: str, least_days: int = 20, default: str | None = None) -> DataFrame:
    """Middle of the longest gap between distinct days, if it is long enough; else no row, or one with the default as its middle."""
    days = rows.select(F.to_date(day).alias("d")).distinct()
    gaps = days.select("d", F.lead("d").over(Window.orderBy("d")).alias("hi")).where("hi IS NOT NULL").withColumn("gap", F.datediff("hi", "d"))
    best = gaps.agg(F.max(F.when(F.col("gap") >= least_days, F.struct("gap", "d"))).alias("b"))
    if default is not None:
        middle = F.date_format(F.date_add("b.d", F.floor(F.col("b.gap") / 2).cast("int")), "yyyy-MM-dd")
        return best.select(F.date_format("b.d", "yyyy-MM-dd").alias("lo"), F.col("b.gap").cast("long").alias("gap"), F.coalesce(middle, F.lit(default)).alias("midpoint"))
    best = best.where("b IS NOT NULL").select("b.*")
    return best.select(F.date_format("d", "yyyy-MM-dd").alias("lo"), F.col("gap").cast("long").alias("gap"), F.date_format(F.date_add("d", F.floor(F.col("gap") / 2).cast("int")), "yyyy-MM-dd").alias("midpoint"))


def replay_diff(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Per key and field what differs, with keys that only one side has."""
    a = old.select(F.col(key).alias("ka"), *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    b = new.select(F.col(key).alias("kb"), *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    j = a.join(b, F.col("ka") == F.col("kb"), "full_outer")
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("old"), F.col(f"b_{f}").alias("new")) for f in fields]))
    state = F.when(F.col("kb").isNull(), "missing").when(F.col("ka").isNull(), "extra").otherwise("changed")
    return j.select(F.coalesce("ka", "kb").alias(key), state.alias("state"), cells.alias("c")).where("NOT (c.old <=> c.new)").select(key, "state", "c.field", "c.old", "c.new")
