"""Session construction with settings every plan in the package assumes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)

#: Settings that do not depend on the size of the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "plenum", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package defaults; `extra` keys use underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return ship(builder.getOrCreate())


#: Rows that a Python worker gets at once, so that a batch of long texts stays small; a session's own setting comes first.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers as an archive, through Spark's own file distribution."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        archive = Path(tempfile.mkdtemp(prefix="plenum-code-")) / "plenum-code.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for path in sorted(Path(ROOT, "plenum").rglob("*.py")):
                packed.write(path, path.relative_to(ROOT))
        context.addPyFile(str(archive))
        if not context.getConf().contains(BATCH_ROWS[0]):
            spark.conf.set(*BATCH_ROWS)
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be on any file system that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
