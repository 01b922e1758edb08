"""Stamps that say how an artifact was made, and the guard on joins of artifacts that were made differently."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys on which artifacts must agree, and keys on which they should.
CRITICAL = ("restore", "ocr_optical")
ADVISORY = ("git_rev",)


@dataclass(frozen=True)
class PlanSettings:
    """What a plan was run with. It is stamped on what the plan writes and changes no meaning silently."""

    restore: str = "on"
    ocr_optical: str = "on"
    git_rev: str = ""
    schema: str = "5"

    @classmethod
    def of(cls, spark: SparkSession, prefix: str = "plenum.") -> PlanSettings:
        """From the session's settings that begin with the prefix; others have their defaults."""
        return cls(**{f.name: spark.conf.get(prefix + f.name, f.default) for f in fields(cls)})

    def stamp(self) -> dict[str, str]:
        return asdict(self)


def disagreements(stamps: DataFrame) -> DataFrame:
    """(key, critical, n_values, artifacts) of a table (artifact, key, value): keys that have more than one value; a missing key is tolerated."""
    shown = stamps.where(F.col("value").isNotNull() & F.col("key").isin(*CRITICAL, *ADVISORY))
    each = F.concat_ws("=", "artifact", "value")
    g = shown.groupBy("key").agg(F.count_distinct("value").alias("n_values"), F.array_join(F.sort_array(F.collect_set(each)), ", ").alias("artifacts"))
    return g.where("n_values > 1").select("key", F.col("key").isin(*CRITICAL).alias("critical"), "n_values", "artifacts")


def require_agreement(spark: SparkSession, stamps: Mapping[str, Mapping[str, str]]) -> None:
    """Raise if two artifacts to be joined disagree on a critical key; warn of others and of artifacts without a stamp."""
    for name in sorted(name for name, stamp in stamps.items() if not stamp):
        warnings.warn(f"{name} has no stamp: how it was made can't be checked", stacklevel=2)
    rows = [(name, key, value) for name, stamp in stamps.items() for key, value in stamp.items()]
    found = disagreements(spark.createDataFrame(rows, "artifact string, key string, value string")).orderBy("key").collect() if rows else []
    for row in found:
        message = f"{row['key']} differs: {row['artifacts']}"
        if row["critical"]:
            raise ValueError(f"artifacts of different pipelines can't be joined: {message}")
        warnings.warn(message, stacklevel=2)


def guarded_join(left: DataFrame, right: DataFrame, on, how: str, left_stamp: Mapping[str, str], right_stamp: Mapping[str, str]) -> DataFrame:
    """A join that is refused where the two sides were made differently."""
    require_agreement(left.sparkSession, {"left": left_stamp, "right": right_stamp})
    return left.join(right, on, how)
