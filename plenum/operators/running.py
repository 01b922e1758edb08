"""Running totals and ranks over whole tables, and the shared folder they are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: Tables made in the scratches that are open, the innermost last; each thread of the driver has its own.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a session on one machine gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="plenum-shared-")
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/plenum/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _SCRATCH.get():
        _SCRATCH.get()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stashed inside are removed at the end; what is to last must have been written anew after it, or by then."""
    made: list[str] = []
    before = _SCRATCH.set((*_SCRATCH.get(), made))
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def lasting(df: DataFrame, tag: str) -> DataFrame:
    """A stash that outlives the scratch it is made in."""
    before = _SCRATCH.set(())
    try:
        return stash(df, tag)
    finally:
        _SCRATCH.reset(before)


def cumulate(df: DataFrame, group: list[Column], order: list[Column], amounts: dict[str, Column], tag: str) -> DataFrame:
    """Running totals per group over all rows in a given order, without a group ever meeting in one task.

    The rows are range-partitioned by (group, order) and written; each partition sums its own part, the
    sums of the parts (one row per part and group) give every part its start. Adds to the columns of `df`,
    for each name in `amounts`, `<name>_before` (exclusive running total) and `<name>_all` (the group's
    total). `order` must be a total order for repeatable results. Group columns may be null.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [f"__g{i}" for i in range(len(group))]
    laid = df.select("*", *[g.alias(k) for g, k in zip(group, keys, strict=True)], *[a.alias(f"__a_{n}") for n, a in amounts.items()])
    ordered = [F.col(k).asc_nulls_last() for k in keys] + order
    laid = laid.repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered)
    laid = laid.withColumn("__pos", F.monotonically_increasing_id())
    laid = stash(laid.withColumn("__part", F.shiftright("__pos", 33).cast("int")), tag)
    within = Window.partitionBy("__part", *keys).orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(f"__a_{n}").alias(f"__s_{n}") for n in amounts]
    by_part = laid.groupBy("__part", *keys).agg(*sums)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = by_part.select(
        F.col("__part").alias("__sp"),
        *[F.col(k).alias(f"__s{k}") for k in keys],
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in amounts],
        *[F.sum(f"__s_{n}").over(whole).alias(f"__t_{n}") for n in amounts],
    )
    running = laid.select("*", *[(F.sum(f"__a_{n}").over(within) - F.col(f"__a_{n}")).alias(f"__r_{n}") for n in amounts])
    on = F.col("__part") == F.col("__sp")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__s{k}"))
    joined = running.join(starts, on, "left")
    kept = [F.col(c) for c in df.columns]
    return joined.select(*kept, *[(F.col(f"__r_{n}") + F.col(f"__b_{n}")).alias(f"{n}_before") for n in amounts], *[F.col(f"__t_{n}").alias(f"{n}_all") for n in amounts])
