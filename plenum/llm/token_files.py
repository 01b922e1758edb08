"""Token-id files: each document compressed by itself with one shared zstandard dictionary.

Every document's ids, its end id included, are serialised as little-endian integers (two bytes where the
vocabulary allows, else four) and compressed as a frame of their own; a dictionary trained on serialised arrays
gives short frames the context that they lack. A shard file holds documents in ascending order of id, in blocks:

    header     magic, version, bytes of an id, SHA-256 of the dictionary
    blocks     frames, then an Arrow stream (doc_id, at, n_tokens, before): where each frame begins
    directory  an Arrow stream with a row for each block: first and last doc_id, places, docs, ids, ids before
    footer     length of the directory, magic

So one short document is reached by reading a directory, one block's index and one frame. The dictionary lies beside the
shards, named by its hash, which each file repeats and each reader verifies. A retried task writes anew under
another name; the manifest (`_manifest`, a row for each block) lists only files of tasks that succeeded.

Encoding happens in the scan, and only compressed frames are shuffled. The dictionary is fitted on a bounded sample
(SAMPLE documents by hash, SAMPLE_BYTES of each): it decides sizes, never contents.

Defined cases
- null and empty texts: the end id alone. Empty table: no file, an empty manifest, empty results.
- order: ascending id, null ids last; rows that share an id stand side by side in the order of their frames.
- repeated rows: a document each. Extra columns are ignored. Ids must be integers.
- very long texts: encoded one at a time; a block is closed once it holds BLOCK_BYTES.
- too few samples to train on: their bytes are the dictionary; none at all: no dictionary.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plenum.llm._shared import named, shared_dir, stash, text_or_empty
from plenum.llm.word_tokens import ByteTokens, slices

MAGIC = b"PLTOKENS"
VERSION = 1
HEADER = struct.Struct("<8sHH32s")
FOOTER = struct.Struct("<Q8s")
BLOCK_DOCS = 4096
BLOCK_BYTES = 4 << 20
SAMPLE = 2000
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Parts that a worker remembers: one batch of texts has tens of thousands of new ones.
REMEMBERED = 200_000
INDEX = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("before", pa.int64())])
BLOCKS = pa.schema([("first_id", pa.int64()), ("last_id", pa.int64()), ("frames_at", pa.int64()), ("index_at", pa.int64()), ("index_end", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("ids_before", pa.int64())])
MANIFEST = "path string, shard int, block int, first_id long, last_id long, frames_at long, index_at long, index_end long, docs long, ids long, ids_before long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_ENCODERS: dict[str, ByteTokens] = {}


def encoder(name: str) -> ByteTokens:
    """One encoder for each distributed tokenizer and worker process."""
    if name not in _ENCODERS:
        _ENCODERS[name] = ByteTokens(SparkFiles.get(name), remembered=REMEMBERED)
    return _ENCODERS[name]


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else ("file://" + path.removeprefix("file:")))


def _sample(rows: DataFrame, name: str, most: int) -> list[bytes]:
    """Serialised ids of about `most` documents that a hash chooses, a bounded part of each."""
    n = rows.count()
    if not n:
        return []
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) <= int(min(1.0, most / n) * (1 << 30))

    def run(batches):
        encode = encoder(name)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                made = [x.tobytes() for x in encode(texts)]
                yield pa.RecordBatch.from_arrays([pa.array([_part(x) for x in made], pa.binary())], ["ids"])

    got = rows.where(drawn).select("text").mapInArrow(run, "ids binary").where("octet_length(ids) > 0").collect()
    return sorted(bytes(r["ids"]) for r in got)


def _part(ids: bytes) -> bytes:
    """At most SAMPLE_BYTES of an array, from a place that its hash tells."""
    room = (len(ids) - SAMPLE_BYTES) // 4
    at = 4 * (zlib.crc32(ids) % (room + 1)) if room > 0 else 0
    return ids[at : at + SAMPLE_BYTES]


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary from serialised arrays; the arrays' own bytes where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def _ipc(schema: pa.Schema, columns: list) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
    return sink.getvalue().to_pybytes()


class ShardWriter:
    """One shard file, from (doc_id, n_tokens, frame) in order."""

    def __init__(self, path: str, width: int, dictionary_sha: bytes) -> None:
        self.path = path
        system, name = _fs(path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(name, compression=None)
        self.at = 0
        self._put(HEADER.pack(MAGIC, VERSION, width, dictionary_sha))
        self.start, self.ids, self.entries, self.blocks = self.at, 0, [], []

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.entries.append((doc_id, self.at, n_tokens, self.ids))
        self._put(frame)
        self.ids += n_tokens
        if len(self.entries) >= BLOCK_DOCS or self.at - self.start >= BLOCK_BYTES:
            self._close_block()

    def _close_block(self) -> None:
        if not self.entries:
            return
        index_at, columns = self.at, list(zip(*self.entries, strict=True))
        self._put(_ipc(INDEX, columns))
        before = columns[3][0]
        self.blocks.append((columns[0][0], columns[0][-1], self.start, index_at, self.at, len(self.entries), self.ids - before, before))
        self.start, self.entries = self.at, []

    def close(self) -> list[tuple]:
        self._close_block()
        directory = _ipc(BLOCKS, list(zip(*self.blocks, strict=True)))
        self._put(directory)
        self._put(FOOTER.pack(len(directory), MAGIC))
        self.file.close()
        return self.blocks


class ShardReader:
    """Reads a shard file's directory, indexes and single documents."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.system, name = _fs(path)
        self.file = self.system.open_input_file(name)
        magic, version, width, self.dictionary_sha = HEADER.unpack(self._bytes(0, HEADER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{path} is no token file of version {VERSION}")
        self.dtype = np.dtype(f"<u{width}")
        self.unpack = _unpacker(path.rpartition("/")[0], self.dictionary_sha.hex())

    def _bytes(self, start: int, end: int) -> bytes:
        return self.file.read_at(end - start, start)

    def directory(self) -> list[dict]:
        size = self.file.size()
        length, magic = FOOTER.unpack(self._bytes(size - FOOTER.size, size))
        if magic != MAGIC:
            raise ValueError(f"{self.path} is cut short")
        return pa.ipc.open_stream(self._bytes(size - FOOTER.size - length, size - FOOTER.size)).read_all().to_pylist()

    def index(self, index_at: int, index_end: int) -> pa.Table:
        return pa.ipc.open_stream(self._bytes(index_at, index_end)).read_all()

    def ids(self, start: int, end: int) -> np.ndarray:
        """The document whose frame lies in [start, end)."""
        return np.frombuffer(self.unpack(self._bytes(start, end)), self.dtype)

    def block(self, frames_at: int, index_at: int, index_end: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids of the shard before it, ids) of a block's documents, in order."""
        index = self.index(index_at, index_end)
        data = self._bytes(frames_at, index_at)
        edges = [*index["at"].to_pylist(), index_at]
        for k, (doc_id, before) in enumerate(zip(index["doc_id"].to_pylist(), index["before"].to_pylist(), strict=True)):
            yield doc_id, before, np.frombuffer(self.unpack(data[edges[k] - frames_at : edges[k + 1] - frames_at]), self.dtype)

    def close(self) -> None:
        self.file.close()


_UNPACKERS: dict[tuple[str, str], object] = {}


def _unpacker(folder: str, sha: str):
    """The decompressing function for a dictionary that is found by its hash, which is verified."""
    import zstandard

    if (folder, sha) not in _UNPACKERS:
        system, name = _fs(f"{folder}/{sha}.zdict")
        with system.open_input_file(name) as f:
            data = f.read()
        if hashlib.sha256(data).hexdigest() != sha:
            raise ValueError(f"the dictionary of {folder} isn't the one that its files were written with")
        if len(_UNPACKERS) > 8:
            _UNPACKERS.clear()
        _UNPACKERS[folder, sha] = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
    return _UNPACKERS[folder, sha]


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 0, sample: int = SAMPLE) -> DataFrame:
    """Write the documents' ids under `path` and return the manifest, which is also written there."""
    import zstandard

    spark = docs.sparkSession
    source = tokenizer or default_tokenizer()
    spark.sparkContext.addFile(source)
    name = os.path.basename(source)
    rows = docs.select(named(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
    dictionary = train(_sample(rows, name, sample))
    sha = hashlib.sha256(dictionary).digest()
    system, folder = _fs(path)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/{sha.hex()}.zdict", compression=None) as f:
        f.write(dictionary)

    def pack(batches):
        encode = encoder(name)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=True).compress
        end = np.array([end_id], encode.dtype)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                made = [np.concatenate([x, end]) for x in encode(texts)]
                counts = pa.array([len(x) for x in made], pa.int64())
                frames = pa.array([press(x.tobytes()) for x in made], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), counts, frames], ["id", "n_tokens", "frame"])

    packed = stash(rows.mapInArrow(pack, "id long, n_tokens long, frame binary"), "token-frames")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.col("id").asc_nulls_last(), F.col("frame")]
    laid = packed.repartitionByRange(parts, order[0]).sortWithinPartitions(*order)
    width = ByteTokens(source).dtype.itemsize

    def write(batches):
        shard, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(i) for i in range(3)), strict=True):
                writer = writer or ShardWriter(f"{path}/part-{shard:06d}-{uuid.uuid4().hex}.tok", width, sha)
                writer.add(doc_id.as_py(), n.as_py(), frame.as_buffer().to_pybytes())
        if writer:
            blocks = writer.close()
            head = [[writer.path] * len(blocks), [shard] * len(blocks), list(range(len(blocks)))]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[f.type for f in BLOCKS]]
            columns = [pa.array(c, k) for c, k in zip([*head, *zip(*blocks, strict=True)], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "shard", "block", *BLOCKS.names])

    laid.mapInArrow(write, MANIFEST).write.parquet(f"{path}/_manifest")
    return open_tokens(spark, path)


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a folder of token files, a row for each block, with `start`: the ids of all shards before."""
    blocks = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("n"))  # one row for each file
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.join(F.broadcast(shards.select(F.col("shard").alias("s"), before.alias("start"))), F.col("shard") == F.col("s")).drop("s")


def _each(manifest: DataFrame, names: list[str], kinds: list[pa.DataType], make) -> DataFrame:
    """A row make(doc_id, start, ids) for each document; blocks are dealt out evenly and read one at a time."""
    spark = manifest.sparkSession
    dealt = manifest.select("path", "frames_at", "index_at", "index_end", "start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches):
        for batch in batches:
            for path, frames_at, index_at, index_end, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, rows, held = ShardReader(path), [], 0
                for doc_id, before, ids in reader.block(frames_at, index_at, index_end):
                    rows.append(make(doc_id, start + before, ids))
                    held += len(ids)
                    if held > 1 << 20:
                        yield pack(rows)
                        rows, held = [], 0
                reader.close()
                if rows:
                    yield pack(rows)

    schema = ", ".join(f"`{n}` {_SPARK[k]}" for n, k in zip(names, kinds, strict=True))
    return dealt.mapInArrow(run, schema)


_SPARK = {pa.int64(): "long", pa.list_(pa.int64()): "array<long>"}


def read_tokens(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, ids: every document of the files, with the number of ids before it."""
    return _each(manifest, [id_col, "start", "ids"], [pa.int64(), pa.int64(), pa.list_(pa.int64())], lambda doc_id, start, ids: (doc_id, start, ids.astype(np.int64)))


def token_digests(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, n_tokens, ids_crc32: of every document of the files, the ids as little-endian 32-bit integers."""
    make = lambda doc_id, start, ids: (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    return _each(manifest, [id_col, "start", "n_tokens", "ids_crc32"], [pa.int64()] * 4, make)


def fetch_tokens(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, start, ids of the documents whose ids are in `wanted` (nulls are in none): indexes of the blocks between the
    least and the largest id asked for are read, then the documents' own frames."""
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = stash(wanted.select(named(id_col).cast("long").alias("w")).where("w IS NOT NULL").distinct(), "token-wanted")
    low, high = ids.agg(F.min("w"), F.max("w")).first()
    near = (F.col("first_id") <= high) & (F.col("last_id").isNull() | (F.col("last_id") >= low))  # null ids come last
    blocks = manifest.where(F.lit(False) if low is None else near).select("path", "index_at", "index_end", "start").repartition(parts)

    def places(batches):
        for batch in batches:
            for path, index_at, index_end, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = ShardReader(path)
                index = reader.index(index_at, index_end)
                reader.close()
                ends = pa.array([*index["at"].to_pylist()[1:], index_at], pa.int64())
                starts = pa.array([start + b for b in index["before"].to_pylist()], pa.int64())
                columns = [index["doc_id"].combine_chunks(), pa.array([path] * len(index)), index["at"].combine_chunks(), ends, starts]
                yield pa.RecordBatch.from_arrays(columns, ["id", "path", "at", "end", "start"])

    found = blocks.mapInArrow(places, "id long, path string, at long, end long, start long").join(ids, F.col("id") == F.col("w"))
    found = found.select("path", "id", "start", "at", "end").repartition(parts, "path", "at").sortWithinPartitions("path", "at")

    def read(batches):
        reader = None
        for batch in batches:
            rows = []
            for path, doc_id, start, at, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or reader.path != path:
                    if reader is not None:
                        reader.close()
                    reader = ShardReader(path)
                rows.append((doc_id, start, reader.ids(at, end).astype(np.int64)))
            if rows:
                a, b, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(list(c), pa.list_(pa.int64()))], [id_col, "start", "ids"])

    return found.mapInArrow(read, f"`{id_col}` long, start long, ids array<long>")


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(write_tokens(docs, f"{shared_dir(spark)}/plenum/tokens-{uuid.uuid4().hex}"))
