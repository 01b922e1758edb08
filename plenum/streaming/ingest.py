"""Page-text cases as they arrive: decided batch by batch, the first record of a case wins, later knowledge only tightens.

Three steps, each restartable from its checkpoint: `adjudicate_stream` writes the records of every batch of files;
`first_records_stream` lets one record of each case through, with a state per case that expires; `tighten` adds
what the corpus as a whole says about records that have already gone out, and `current` reads both.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from plenum.operators.recurrence import recurring
from plenum.operators.running import scratch, stash
from plenum.operators.vote import first_by
from plenum.plans.packets import adjudicate, records
from plenum.sources.page_text import stream_cases

_RECORD = ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "adjudication", "confidence", "branch")
RECORDS = "case_id string, " + ", ".join(f"{c} {'double' if c == 'confidence' else 'string'}" for c in _RECORD) + ", batch long"
#: How long a case's first record shuts out others, in milliseconds.
KEEP_MS = 30 * 24 * 3600 * 1000


def first_cases(batch: DataFrame) -> DataFrame:
    """Of the lines of a stem the first: the one of the first file by name, then of the first place in it."""
    # Within a block of a file rows are numbered as they come.
    ranked = batch.withColumn("__at", F.struct(F.col("file"), F.col("block"), F.monotonically_increasing_id()))
    return first_by(ranked, ["stem"], F.col("__at"), F.col("cost_ms"), F.col("error"), F.col("pages"))


def adjudicate_stream(spark: SparkSession, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Write the records of each batch of new files to `sink`/batch=n; a batch that is run again replaces itself.

    Of several lines of a case within a batch the first by (file, place) counts. What a batch writes on the way is
    removed when it is done.
    """

    def write(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            cases = stash(first_cases(batch), "stream-cases")
            made = first_by(records(adjudicate(cases)), ["case_id"], F.struct("branch", "confidence"), *[F.col(c) for c in _RECORD])
            made.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream_cases(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _first_of(keep_ms: int):
    """The state function: of a case without a state the record of the least batch."""

    def first(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = [row for frame in frames for row in frame.to_dict("records")]  # repeats of one case
        if rows and not state.exists:
            best = min(rows, key=lambda r: (r["batch"], r["branch"], r["confidence"]))
            state.update((int(best["batch"]),))
            yield pd.DataFrame([{k: v for k, v in best.items() if k != "written"}])
        if rows:
            state.setTimeoutTimestamp(int(max(r["written"] for r in rows).timestamp() * 1000) + keep_ms)

    return first


def first_records_stream(spark: SparkSession, provisional: str, sink: str, checkpoint: str, keep_ms: int = KEEP_MS) -> StreamingQuery:
    """Append to `sink` the first record of each case among the batches that `adjudicate_stream` has written.

    A case's state is its first batch, kept until files are written twice `keep_ms` after the case was last seen, so the state
    is bounded by the cases of that time and no batch reads the sink.
    """
    found = spark.readStream.schema(RECORDS).parquet(provisional).select("*", F.col("_metadata.file_modification_time").alias("written"))
    # A file is late, and left out, only if it is older than the newest one by as much as states are kept.
    found = found.withWatermark("written", f"{keep_ms} milliseconds")
    once = found.groupBy("case_id").applyInPandasWithState(_first_of(keep_ms), RECORDS, "batch long", "append", GroupStateTimeout.EventTimeTimeout)
    return once.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def tighten(spark: SparkSession, sink: str, known: tuple[str, ...], filled: DataFrame | None = None) -> int:
    """Add to `sink`.tightened the records that ids recurring over the whole sink turn into denials; how many are new.

    Rows already written are never rewritten, so a reader sees them before and after, and a run that is killed
    leaves what was there. Sponsors in `known`, exempt visas, findings, higher rules and cases in `filled` (case_id: the
    sponsor is a fill, no evidence) are left alone.
    """
    now = current(spark, sink)
    ids = recurring(now, "sponsor_id", ignored=(*known, "SPN-0000")).select(F.col("sponsor_id").alias("f"))
    hit = now.join(ids, F.col("sponsor_id") == F.col("f"), "left_semi").where((F.col("adjudication") != "DENIED") & ~F.col("visa_class").isin("DIP-1", "unknown") & ~F.col("branch").isin("adjudicator_finding", "disqualifying_flag"))
    if filled is not None:
        hit = hit.join(filled.select(F.col("case_id").alias("fc")), F.col("case_id") == F.col("fc"), "left_anti")
    with scratch(spark):
        made = stash(hit.withColumn("adjudication", F.lit("DENIED")).withColumn("branch", F.lit("recurring_id")), "tightened")
        n = made.count()
        if n:
            made.write.mode("append").parquet(f"{sink}.tightened")
    return n


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def current(spark: SparkSession, sink: str) -> DataFrame:
    """The records of `sink` as they stand: a denial added later replaces what went out first."""
    out = spark.read.schema(RECORDS).parquet(sink)
    if not _exists(spark, f"{sink}.tightened"):
        return out
    both = out.withColumn("late", F.lit(0)).unionByName(spark.read.schema(RECORDS).parquet(f"{sink}.tightened").withColumn("late", F.lit(1)))
    return first_by(both, ["case_id"], -F.col("late"), *[F.col(c) for c in (*_RECORD, "batch")])
