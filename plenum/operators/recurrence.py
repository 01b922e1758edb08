"""Ids that recur far more often than the corpus explains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def recurring(ids: DataFrame, id_col: str, least_rows: int = 50, least_ratio: float = 3.0, most_share: float = 0.05, ignored: tuple = ()) -> DataFrame:
    """Ids above the largest multiplicative gap in the spectrum of occurrence counts; empty where it abstains.

    The spectrum has one row per distinct count, so its window is small whatever the number of ids; the
    boundary is one row, joined by a broadcast.
    """
    known = ids.where(F.col(id_col).isNotNull() & ~F.col(id_col).isin(*ignored)) if ignored else ids.where(F.col(id_col).isNotNull())
    counts = known.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.groupBy("n").agg(F.count(F.lit(1)).alias("ids"))
    rising = Window.orderBy("n")
    whole = Window.partitionBy()
    steps = levels.select("n", "ids", F.lead("n").over(rising).alias("hi"), F.sum(F.col("n") * F.col("ids")).over(whole).alias("rows"), F.sum("ids").over(whole).alias("distinct"), F.sum("ids").over(Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("above"))
    best = steps.where("hi IS NOT NULL").agg(F.max(F.struct((F.col("hi") / F.col("n")).alias("ratio"), F.col("n").alias("lo"), "above", "rows", "distinct")).alias("b")).select("b.*")
    bound = best.where((F.col("rows") >= least_rows) & (F.col("ratio") >= least_ratio) & (F.col("above") <= most_share * F.col("distinct")))
    return counts.join(F.broadcast(bound.select("lo")), F.col("n") > F.col("lo")).select(id_col, F.col("n").alias("occurrences"))


def revise(records: DataFrame, flagged: DataFrame, id_col: str, exempt: Column, outranking: Column, filled: Column) -> DataFrame:
    """One-way correction: records of flagged ids become DENIED unless exempt, outranked, or filled in."""
    marked = records.join(flagged.select(F.col(id_col).alias("__f")), F.col(id_col) == F.col("__f"), "left")
    hit = F.col("__f").isNotNull() & ~F.coalesce(exempt, F.lit(True)) & ~outranking & ~filled & (F.col("decision") != "DENIED")
    return marked.withColumn("branch", F.when(hit, "recurring_id").otherwise(F.col("branch"))).withColumn("decision", F.when(hit, "DENIED").otherwise(F.col("decision"))).drop("__f")
