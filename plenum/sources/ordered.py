"""A sink whose files are in order, so that a run that is killed leaves a valid beginning of its output.

`df.write.format("ordered").mode(...).save(path)` writes a version: a folder of numbered files of JSON lines, one for each
partition, each put under its name only when it is complete. A run that ends well renames a pointer, `_current`, to
its version; until then, and after a run that was killed, readers see the version before, or, if there is none, the
unbroken run of files from number 0 on. The order of rows is the order of partitions: sort before writing.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

PART = re.compile(r"part-(\d{6})\.jsonl")


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _put(folder: str, name: str, lines) -> None:
    """Write a file under a name of its own, then rename it."""
    system, root = _fs(folder)
    system.create_dir(root, recursive=True)
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        for line in lines:
            out.write(line)
    system.move(draft, f"{root}/{name}")


def _plain(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


@dataclass
class _Written(WriterCommitMessage):
    part: int
    rows: int


class _OrderedWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path, self.version = path, f"v-{datetime.datetime.now(datetime.UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def write(self, iterator) -> WriterCommitMessage:
        part, count = TaskContext.get().partitionId(), 0

        def lines():
            nonlocal count
            for row in iterator:
                count += 1
                yield json.dumps({k: _plain(v) for k, v in row.asDict(recursive=True).items()}).encode() + b"\n"

        _put(f"{self.path}/{self.version}", f"part-{part:06d}.jsonl", lines())
        return _Written(part, count)

    def commit(self, messages) -> None:
        done = sorted((m.part, m.rows) for m in messages if m is not None)
        _put(self.path, "_current", [json.dumps({"version": self.version, "parts": len(done), "rows": sum(n for _, n in done)}).encode()])

    def abort(self, messages) -> None:
        """What is there stays: it is the beginning that readers may use."""


class OrderedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _OrderedWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OrderedSink)


def valid_parts(path: str) -> list[str]:
    """The files that readers may use, in order: a row for each part of one version comes to the driver, no data."""
    from pyarrow import fs

    system, root = _fs(path)
    if system.get_file_info(root).type == fs.FileType.NotFound:
        return []
    with_pointer = system.get_file_info(f"{root}/_current").type == fs.FileType.File
    if with_pointer:
        with system.open_input_stream(f"{root}/_current") as f:
            versions = [json.loads(f.read())["version"]]
    else:
        versions = sorted((f.base_name for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("v-")), reverse=True)
    for version in versions:
        found = {int(m[1]) for f in system.get_file_info(fs.FileSelector(f"{root}/{version}")) if (m := PART.fullmatch(f.base_name))}
        whole = [f"{path}/{version}/part-{k:06d}.jsonl" for k in range(len(found)) if all(j in found for j in range(k + 1))]
        if whole or with_pointer:
            return whole
    return []


def read_ordered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The valid rows with `part`, the number of the file that each stands in."""
    parts = valid_parts(path)
    if not parts:
        return spark.createDataFrame([], f"{schema}, part int")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d{6})", 1).cast("int")
    return spark.read.schema(schema).json(parts).select("*", number.alias("part"))
