"""SentencePiece encoding that keeps byte offsets, and decoding.

A text is normalised by the model's compiled character map: at each position the longest key that is a
prefix of what is left is replaced; where none fits, one character passes through. Every byte of the
result remembers the source byte that it comes from, so each piece projects to a span of original bytes.
The model's BPE merges then cut the normalised text into pieces. A merge can only join characters that
some piece holds side by side; where no piece does (before a space mark that follows another character,
and before line ends), a long text is parted first, so that merging needs memory for one part at a time.
Nothing is remembered from text to text.

Defined cases
- null and empty texts: no pieces, empty decoded text. Empty table: empty result.
- repeated rows: each is encoded by itself. Ids of any type, null ids included, are passed through.
- extra columns are ignored, whatever their names. Very long texts: one text at a time is held.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.llm._shared import named, text_or_empty

MARK = "▁"
#: Characters after which a text is parted at the next place that no piece spans.
PART = 4096


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _distributed(spark: SparkSession, model_path: str | None) -> str:
    """The model's file sent to every executor; the name that it goes by there."""
    path = model_path or default_model()
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


class CharMap:
    """A compiled character map: a double-array trie of UTF-8 keys, then zero-ended replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest key that starts at `at`."""
        if not self.units:
            return None
        units, found = self.units, None
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start : self.strings.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalizer:
    """Text to normalised text, with the source byte of each normalised byte (and one past the end)."""

    def __init__(self, spec) -> None:
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        data = text.encode("utf-8", "replace")
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            return self._plain(text, data)
        return self._mapped(data)

    def _plain(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        widths = np.where(np.frombuffer(data, np.uint8) == 32, 3, 1)
        source = np.repeat(np.arange(len(data)), widths)
        lead = np.zeros(3 if self.prefix else 0, np.int64)
        return MARK * self.prefix + text.replace(" ", MARK), np.concatenate([lead, source, [len(data)]])

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        chunks: list[tuple[bytes, int, int]] = []
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                used, out = hit
            else:
                used = _char_width(data[at])
                out = data[at : at + used]
            chunks.append((out, at, at + used))
            at += used
        out, source = bytearray(), []
        end = len(data)
        if self.squeeze:
            while chunks and chunks[0][0] == b" ":
                chunks.pop(0)
            while chunks and chunks[-1][0].rstrip(b" ") == b"":
                end = chunks.pop()[1]
        if not chunks:
            return "", np.zeros(1, np.int64)
        mark = MARK.encode()
        if self.prefix:
            out += mark
            source += [chunks[0][1]] * 3
        blank = self.squeeze
        for piece, start, _ in chunks:
            if self.squeeze and blank:
                piece = piece.lstrip(b" ")
            for byte in piece:
                shown = mark if byte == 32 else bytes([byte])
                out += shown
                source += [start] * len(shown)
            if piece:
                blank = self.squeeze and piece.endswith(b" ")
        while self.squeeze and out.endswith(mark) and len(out) > 3:
            del out[-3:]
            end = source[-3]
            del source[-3:]
        return out.decode("utf-8", "replace"), np.array([*source, end], np.int64)


def _char_width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


@dataclass
class Encoded:
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class PieceCodec:
    """Encodes and decodes with one model file."""

    def __init__(self, model_path: str, part: int = PART) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        self.whole = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.normalize = Normalizer(proto.normalizer_spec)
        core = proto.normalizer_spec
        core.precompiled_charsmap, core.add_dummy_prefix, core.remove_extra_whitespaces, core.name = b"", False, False, "identity"
        self.merger = SentencePieceProcessor(model_proto=proto.SerializeToString())
        pieces = [p for p in proto.pieces if p.type != 6]
        free = proto.trainer_spec.model_type == 2 and not any(p.type == 4 for p in pieces) and not proto.trainer_spec.treat_whitespace_as_suffix
        cuts = free and not any(re.search(f"[^{MARK}]{MARK}", p.piece) or ("\n" in p.piece and len(p.piece) > 1) for p in pieces)
        self.cut = re.compile(f"\n|(?<=[^{MARK}]){MARK}").search if cuts else (lambda text, at: None)
        self.part = part
        self.width = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = proto.trainer_spec.unk_id
        self.names = [str(k) for k in range(len(proto.pieces))]

    def parts(self, normal: str) -> Iterator[str]:
        """A normalised text in parts that merge by themselves."""
        at = 0
        while len(normal) - at > self.part and (edge := self.cut(normal, at + self.part)):
            yield normal[at : edge.start()]
            at = edge.start()
        yield normal[at:]

    def encode(self, text: str | None) -> Encoded:
        normal, source = self.normalize(text or "")
        parts = list(self.parts(normal))
        ids = np.concatenate([np.asarray(self.merger.encode_as_numpy(x), np.int32) for x in parts])
        widths = self.width[ids]
        if self.unknown in ids:  # an unknown piece stands for what no other piece covers
            widths = np.array([len(p.surface.encode()) for x in parts for p in self.merger.encode(x, return_type="proto").pieces], np.int64)
        edges = np.cumsum(widths)
        return Encoded(ids, source[edges - widths], source[edges])

    def joined(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.names.__getitem__, ids.tolist()))

    def decode(self, ids) -> str:
        return self.whole.decode(list(map(int, ids)) if not isinstance(ids, np.ndarray) else ids.tolist())


_CODECS: dict[str, PieceCodec] = {}


def codec(name: str) -> PieceCodec:
    """One codec, about 10 MB, for each distributed model and worker process."""
    if name not in _CODECS:
        _CODECS[name] = PieceCodec(SparkFiles.get(name))
    return _CODECS[name]


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """id_col, ids, begins, ends: the pieces of each text and the original bytes that each stands for."""
    model = _distributed(docs.sparkSession, model_path)
    slim = docs.select(named(id_col), text_or_empty(text).alias("text"))
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches):
        use = codec(model)
        for batch in batches:
            done = [use.encode(t.as_py()) for t in batch.column(1)]
            columns = [[e.ids for e in done], [e.begins for e in done], [e.ends for e in done]]
            arrays = [pa.array(c, pa.list_(pa.int32())) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, "ids", "begins", "ends"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """id_col, text: what the model decodes each array of ids to (null: empty)."""
    model = _distributed(encoded.sparkSession, model_path)
    slim = encoded.select(named(id_col), F.coalesce(named(ids), F.array().cast("array<int>")).alias("ids"))
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches):
        use = codec(model)
        for batch in batches:
            texts = [use.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, text string")


def piece_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256, spans_sha256: one encoding and decoding of each text, as digests.

    The same codec as `encode` and `decode`, without sending the arrays back to the JVM.
    """
    model = _distributed(docs.sparkSession, model_path)
    slim = docs.select(named(id_col), text_or_empty(text).alias("text"))
    kind = slim.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        use = codec(model)
        for batch in batches:
            rows = []
            for item in batch.column(1):
                e = use.encode(item.as_py())
                spans = np.stack([e.begins, e.ends]).astype("<i8").tobytes()
                rows.append((len(e.ids), sha(use.joined(e.ids).encode()), sha(use.decode(e.ids).encode("utf-8", "replace")), sha(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            arrays = [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return slim.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def op3_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    return piece_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
