"""Page text made once and kept: a row per case with its cost or its error; and Spark's own extension points for packets."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.functions import udtf

from plenum.operators.evaluate import index_percentiles
from plenum.sources.page_text import SCHEMA

LINE = "page_no int, channel string, ord int, line string"


def materialise(stems: DataFrame, read: Callable[[str], list[dict]], path: str) -> DataFrame:
    """Write (stem, cost_ms, error, pages as JSON) of each stem under `path` and read it back; a failure is a row, not the end."""

    def run(batches: Iterator):
        import pandas as pd

        for batch in batches:
            rows = []
            for stem in batch["stem"]:
                start = time.perf_counter()
                try:
                    pages, error = json.dumps(read(stem)), None
                except Exception as e:  # noqa: BLE001  the error is the row's content
                    pages, error = None, f"{type(e).__name__}: {e}"
                rows.append((stem, int(1000 * (time.perf_counter() - start)), error, pages))
            yield pd.DataFrame(rows, columns=["stem", "cost_ms", "error", "pages"])

    stems.select("stem").mapInPandas(run, "stem string, cost_ms long, error string, pages string").write.mode("overwrite").parquet(path)
    return stems.sparkSession.read.parquet(path)


def cost_quantiles(made: DataFrame, percents: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """(q, pick): index percentiles of the cost of what was made."""
    return index_percentiles(made.where("error IS NULL"), "cost_ms", percents)


@udtf(returnType=LINE)
class PacketLines:
    """The lines of a case's pages (a JSON array), with the channel that each comes through."""

    def eval(self, pages: str):
        for page in json.loads(pages or "[]"):
            for channel in ("visible_lines", "hidden_lines", "struck", "ocr_lines"):
                for k, line in enumerate(page.get(channel) or []):
                    yield page.get("page_no"), channel.split("_")[0], k, line
            for r, reading in enumerate(page.get("reads") or []):
                for k, line in enumerate(reading.get("lines") or []):
                    yield page.get("page_no"), f"read {r}", k, line


class PacketSource(DataSource):
    """`spark.read.format("packets").load(folder)`: cases of page-text caches, a partition per file."""

    @classmethod
    def name(cls) -> str:
        return "packets"

    def schema(self) -> str:
        return "stem string, cost_ms bigint, error string, pages string"

    def reader(self, schema) -> DataSourceReader:
        return _PacketReader(self.options["path"])


class _PacketReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        return [InputPartition(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.base_name.endswith((".json", ".jsonl"))]

    def read(self, partition: InputPartition):
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        with system.open_input_stream(partition.value) as file:
            rest = b""
            while chunk := file.read(1 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                yield from filter(None, map(_case, whole))
            if (last := _case(rest)) is not None:
                yield last


def _case(line: bytes) -> tuple | None:
    """A case's row; none for the header and empty lines; a line that is no JSON object is a row that holds the error."""
    try:
        item = json.loads(line) if line.strip() else {"_meta": None}
    except ValueError as e:
        return None, None, f"no JSON: {e}", None
    if not isinstance(item, dict):
        return None, None, "no JSON object", None
    return None if "_meta" in item else (item.get("stem"), item.get("cost_ms"), item.get("error"), json.dumps(item.get("pages")))


def register(spark) -> None:
    """Make the source and the table function known to a session."""
    spark.dataSource.register(PacketSource)
    spark.udtf.register("packet_lines", PacketLines)


def with_pages(cases: DataFrame) -> DataFrame:
    """Cases whose pages are JSON, as `read_cases` gives them."""
    kind = SCHEMA.split("pages ")[1].split(", _meta")[0]
    return cases.withColumn("pages", F.from_json("pages", kind))
