"""Small tabular sources: truth labels, splits, key lists, word tables of an OCR engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators.sequences import islands

LABELS = ", ".join(f"{c} string" for c in ("case_id", "applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "adjudication"))
WORDS = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"


def labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELS).option("header", "true").csv(path)


def splits(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, split) from a JSON object of lists."""
    d = spark.read.schema("seed int, dev array<string>, holdout array<string>").option("multiLine", "true").json(path)
    part = lambda s: d.select(F.explode(s).alias("case_id"), F.lit(s).alias("split"))
    return part("dev").unionByName(part("holdout"))


def keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys, one per line; blank lines and # comments are skipped."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(line.alias("key"))


def word_lines(spark: SparkSession, path: str) -> DataFrame:
    """(page, line, mean, n, y, text) of a word table: runs of words of one line, in reading order."""
    words = spark.read.schema(WORDS).option("sep", "\t").option("header", "true").option("quote", "").csv(path)
    heights = words.where("level = 1").groupBy(F.col("page_num").alias("pg")).agg(F.max("height").alias("page_height"))
    good = words.where((F.col("level") == 5) & (F.col("conf") >= 0) & (F.trim(F.coalesce("text", F.lit(""))) != ""))
    place = [F.col(c) for c in ("block_num", "par_num", "line_num", "word_num")]
    runs = islands(good, ["page_num"], place, F.struct("block_num", "par_num", "line_num"), "run")
    first = F.struct("block_num", "par_num", "line_num", "word_num")
    g = runs.groupBy("page_num", "run").agg(
        F.bround(F.avg("conf"), 1).alias("mean"), F.count(F.lit(1)).alias("n"), F.min_by("top", first).alias("top"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(first.alias("o"), "text"))), lambda x: x["text"]), " ").alias("text"),
    )
    return g.join(heights, F.col("page_num") == F.col("pg"), "left").select("page_num", "run", "mean", "n", (F.col("top") / F.col("page_height")).alias("y"), "text")
