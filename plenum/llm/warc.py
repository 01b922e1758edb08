"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The writer makes one archive per partition in a shared folder; a retried task writes anew under another
name and only the files of tasks that succeeded are listed in the manifest it returns.
The reader divides archives into byte ranges. A task looks in its range for the gzip magic; a place may be a
record's start if a gzip header and deflate stream begin there that decode to a WARC version line; what follows its
member decides nothing. An archive stored inside a record has such places too. So a range first tells, for each of them, where the records that begin there leave the range; the
exit of one range is the entry of the next, and following these from the archive's start, a row per range, shows
where each range is to be read from (archives of one range are read at once). A task owns the records that start
in its range and reads on past its end to finish the last one. After a damaged member the next place that may be
a record's start is taken.

Defined cases
- null payloads are written as empty. Empty table: no archive, empty results. Repeated rows: a record each.
- of payloads that are equal and at least `least` bytes long the one with the largest id is the response,
  the others revisit it; where all ids are null, all are responses. Rows that repeat the response's id are
  responses too.
- records of other writers: an id that isn't one of ours, and a digest that is missing or no SHA-1 (base 32 or hexadecimal),
  are null; without a usable Content-Length the block is what the member holds; records of other types are left out.
- extra columns are ignored. Very long payloads: a task holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.llm._shared import shared_dir, stash

MAGIC = b"\x1f\x8b\x08"
LEAST = 1000
SPLIT = 32 << 20
CHUNK = 1 << 20
FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _open_fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else ("file://" + path.removeprefix("file:")))


def _urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,18})>", urn or "")
    return int(found[1]) if found else None


def _sha1_of(said: str | None) -> str | None:
    """A payload digest in hexadecimal; null if it is none, or of another algorithm."""
    name, _, value = (said or "").partition(":")
    if name.strip().lower() != "sha1":
        return None
    value = value.strip()
    if re.fullmatch("[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", value) else None


def _whole(said: str | None) -> int | None:
    return int(said) if said and re.fullmatch("[0-9]{1,18}", said) else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head only, which tells the payload's length."""
    sha = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    clean = "".join(c for c in (url or "") if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id, sha.hexdigest())}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {clean}"] if clean else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}",
        *([f"WARC-Refers-To: {_urn(refers_to, '')}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple | None:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        named[key.strip().lower()] = value.strip()
    kind = named.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    length = _whole(named.get("content-length"))
    block = rest[:length] if length is not None else rest.removesuffix(b"\r\n\r\n")
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        fields = [x.partition(b":") for x in http.split(b"\r\n")[1:]]
        size = next((_whole(v.strip().decode("latin-1")) for k, _, v in fields if k.strip().lower() == b"content-length"), 0)
        digest = _sha1_of(named.get("warc-payload-digest"))
    return _page_of(named.get("warc-record-id")), named.get("warc-target-uri"), size, digest, kind, _page_of(named.get("warc-refers-to")), payload if kind == "response" else None


class _Window:
    """Forward reads of a file from a place on."""

    def __init__(self, file, at: int) -> None:
        self.file, self.base, self.data = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.data += got
        return bool(got)

    def drop(self, upto: int) -> None:
        if upto > self.base:
            self.data = self.data[upto - self.base :]
            self.base = upto


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """(decoded record, the place after its member) if a record starts at `at`."""
    unpack = zlib.decompressobj(31)
    out: list[bytes] = []
    size, pos = 0, at - window.base
    try:
        while not unpack.eof:
            if pos >= len(window.data) and not window.more():
                return None
            got = unpack.decompress(window.data[pos : pos + CHUNK])
            pos = min(len(window.data), pos + CHUNK)
            if size < 5 <= size + len(got) and not (b"".join(out) + got).startswith(b"WARC/"):
                return None
            out.append(got)
            size += len(got)
    except zlib.error:
        return None
    record = b"".join(out)
    return (record, window.base + pos - len(unpack.unused_data)) if record.startswith(b"WARC/") else None


def _records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes, int]]:
    """(place, decoded record, the place after its member) of the records that start in [start, end), from a record's start on."""
    system, name = _open_fs(path)
    with system.open_input_file(name) as file:
        window, at = _Window(file, start), start
        while at < end:
            found = window.data.find(MAGIC, at - window.base)
            if found < 0:
                at = max(at, window.base + len(window.data) - len(MAGIC) + 1)
                window.drop(at)
                if not window.more():
                    return
                continue
            at = window.base + found
            if at >= end:
                return
            window.drop(at)
            hit = _member(window, at)
            if hit is None:
                at += 1
                continue
            yield at, *hit
            at = hit[1]
            window.drop(at)


def read_range(path: str, start: int, end: int) -> Iterator[bytes]:
    """The decoded records whose members start in [start, end) of the archive."""
    return (record for _, record, _ in _records(path, start, end))


def _places(path: str, start: int, end: int) -> Iterator[int]:
    """All places of the magic in [start, end)."""
    system, name = _open_fs(path)
    with system.open_input_file(name) as file:
        file.seek(start)
        base, data = start, b""
        while base < end:
            got = file.read(CHUNK)
            data += got
            at = data.find(MAGIC)
            while 0 <= at and base + at < end:
                yield base + at
                at = data.find(MAGIC, at + 1)
            if not got:
                return
            base, data = base + max(0, len(data) - len(MAGIC) + 1), data[-len(MAGIC) + 1 :]


def exits(path: str, start: int, end: int) -> dict[int, int]:
    """For each place in the range where a record may start: where the records from there on leave the range."""
    out: dict[int, int] = {}
    for place in _places(path, start, end):
        if place in out:
            continue
        trail, leaves = [], None
        for at, _, after in _records(path, place, end):
            if not trail and at != place:
                break  # no record starts here
            if at in out:
                leaves = out[at]
                break
            trail.append(at)
            leaves = after
        out.update(dict.fromkeys(trail, end if leaves is None else max(end, leaves)))
    return out


def _entries(spark: SparkSession, ranges: DataFrame) -> DataFrame:
    """`ranges` (path, bytes, start, end) of archives of several ranges with `entry`, where each is to be read from."""

    def tell(batches):
        for batch in batches:
            rows = []
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = exits(path, start, end)
                # Where all trails leave the range at one place, it doesn't matter which of them is entered.
                one = len(set(found.values())) < 2
                rows.append((path, start, end, list(found.values())[:1] if one else list(found.values()), [] if one else list(found)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "start", "end", "exits", "places"])

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        at, out = 0, []
        for row in group.sort_values("start").itertuples():
            entry = max(at, row.start)
            if entry >= row.end:
                continue
            out.append((row.path, entry, row.end))
            leaves = {p: x for p, x in zip(row.places, row.exits, strict=True) if p >= entry} if len(row.places) else {}
            at = leaves[min(leaves)] if leaves else max(row.end, *row.exits) if len(row.exits) and not len(row.places) else row.end
        return pd.DataFrame(out, columns=["path", "start", "end"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = ranges.repartition(parts).mapInArrow(tell, "path string, start long, end long, exits array<long>, places array<long>")
    return stash(told.groupBy("path").applyInPandas(follow, "path string, start long, end long"), "warc-entries")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write an archive per partition under `path`; the manifest (path, bytes, records) of the files that count."""
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    digest = F.sha1("payload").alias("digest")
    equal = rows.where(F.octet_length("payload") >= least).select("page_id", digest).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    equal = stash(equal.where("n > 1").select(F.col("digest").alias("d"), "first"), "warc-equal")
    planned = rows.withColumn("digest", F.sha1("payload")).join(equal, F.col("digest") == F.col("d"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    planned = planned.select("page_id", "url", "payload", refers)

    def run(batches):
        file, size, count, target = None, 0, 0, ""
        for batch in batches:
            ids, urls, payloads, others = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                if file is None:
                    target = f"{path}/{uuid.uuid4().hex}.warc.gz"
                    system, name = _open_fs(target)
                    system.create_dir(name.rpartition("/")[0], recursive=True)
                    file = system.open_output_stream(name, compression=None)
                data = record_bytes(ids[i].as_py(), urls[i].as_py(), payloads[i].as_py(), others[i].as_py(), date)
                file.write(data)
                size, count = size + len(data), count + 1
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], ["path", "bytes", "records"])

    return stash(planned.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """A manifest (path, bytes) of the archives under a folder, through Spark's file systems."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("length").alias("bytes"))


def read_warc(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """The response and revisit records of the archives in a manifest (path, bytes)."""
    spark = manifest.sparkSession
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long")))
    ranges = manifest.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    ranges = ranges.select("path", "bytes", "start", F.least("bytes", F.col("start") + split).alias("end"))
    several = ranges.where(F.col("bytes") > split)
    whole = ranges.where(F.col("bytes") <= split).select("path", "start", "end")
    ranges = whole if several.isEmpty() else whole.unionByName(_entries(spark, several))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        names = [f.split(" ")[0] for f in FIELDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        rows, held = [], 0
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for data in read_range(path, start, end):
                    row = parse_record(data)
                    if row is None:
                        continue
                    rows.append(row)
                    held += len(data)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield pack()
                        rows, held = [], 0
        if rows:
            yield pack()

    return ranges.mapInArrow(run, FIELDS)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = write_warc(pages, f"{shared_dir(spark)}/plenum/warc-{uuid.uuid4().hex}")
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM g
"""
