"""Alignment of two tokenizers' tokens over the same bytes.

A text's tokens by tokenizer A and by tokenizer B are laid along its bytes by a dangling-suffix transducer: its state
is the side that leads and the bytes by which it leads; it reads the next token of the side that lags, which uses
the residual up, leaves some of it or becomes the leader. Where the residual is empty, both sides end together: a
group closes, and the two tokens that end there are linked. Transitions are remembered by residual and token;
what is remembered is bounded and no result depends on it.

Of two linked tokens the bytes of one are a suffix of the other's, so a vocabulary has at most as many different
pairs as its tokens have bytes (times the few ids that share their bytes), whatever the corpus: the table of
corpus-wide pair counts, gathered by partial sums, is bounded by the two models and is sent to the executors.

Defined cases
- null and empty texts, and texts of which either side's tokens don't spell a space and the text: no tokens, zeros.
- repeated rows: each counts. Ids of any type, null ids included, are passed through. Empty table: empty result.
- extra columns are ignored, whatever their names. Very long texts: one bounded slice of texts at a time is held.
- ties: of pairs whose counts are equally high for a B id, all are best.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import named, stash, text_or_empty
from plenum.llm.sentence_pieces import default_model
from plenum.llm.token_files import default_tokenizer
from plenum.llm.word_tokens import ByteTokens, PieceTokens, slices

#: Transitions remembered in a worker.
REMEMBERED = 500_000
#: Pair codes gathered in a task before they are summed.
BUFFER = 2_000_000


class _State(dict):
    """Next states by token. `leads`: 0 if A leads, 1 if B does; the start, where nothing is left over, reads A."""

    __slots__ = ("leads", "machine", "rest")

    def __init__(self, machine: Transducer, leads: int, rest: bytes) -> None:
        super().__init__()
        self.machine, self.leads, self.rest = machine, leads, rest

    def __missing__(self, token: int) -> _State:
        lags = 1 - self.leads
        read, rest = self.machine.spelled[lags][token], self.rest
        if rest.startswith(read):
            after = self.machine.state(self.leads, rest[len(read) :])
        elif read.startswith(rest):
            after = self.machine.state(lags, read[len(rest) :])
        else:
            raise ValueError("the two sides spell different bytes")
        self.machine.remember(self, token, after)
        return after


class Transducer:
    """Groups two token sequences that spell the same bytes."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes], most: int = REMEMBERED) -> None:
        self.spelled, self.most = (a_bytes, b_bytes), most
        self.start = _State(self, 1, b"")
        self.states: dict[tuple[int, bytes], _State] = {}
        self.known = 0

    def state(self, leads: int, rest: bytes) -> _State:
        if not rest:
            return self.start
        return self.states.get((leads, rest)) or self.states.setdefault((leads, rest), _State(self, leads, rest))

    def remember(self, state: _State, token: int, after: _State) -> None:
        if self.known >= self.most:
            self.states.clear()
            self.start.clear()
            self.known = 0
        state[token] = after
        self.known += 1

    def groups(self, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        """How many tokens of A and of B have been read when each group closes."""
        start = state = self.start
        at_b, ends_a, ends_b = 0, [], []
        for at_a, token in enumerate(a, 1):
            state = state[token]
            while not state.leads:
                state = state[b[at_b]]
                at_b += 1
            if state is start:
                ends_a.append(at_a)
                ends_b.append(at_b)
        return ends_a, ends_b


class Aligner:
    """Encodes texts by both models and aligns them."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteTokens(a_path, plain_specials=True), PieceTokens(b_path)
        spelled = self.a.token_bytes(), self.b.token_bytes()
        self.spelled = spelled
        self.machine = Transducer(*spelled)
        sizes = self.a.size, self.b.size
        self.by_code = sizes[1]
        # Texts of ids with what may follow them, in one list: A before `,` and `|`, then B before `,` and `;`.
        self.shown = [f"{k}{mark}" for size, marks in zip(sizes, (",|", ",;"), strict=True) for mark in marks for k in range(size)]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """(ids of A, ids of B) of each text; None if it has no tokens."""
        pairs = zip(texts, self.a([" " + t for t in texts]), self.b(texts), strict=True)
        for text, a, b in pairs:
            want = b" " + text.encode("utf-8", "replace")
            same = text and all(b"".join(map(s.__getitem__, x.tolist())) == want for s, x in zip(self.spelled, (a, b), strict=True))
            yield (a, b) if same else None

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the groups, as counts of tokens of each side."""
        ends = self.machine.groups(a.tolist(), b.tolist())
        return np.array(ends[0], np.int64), np.array(ends[1], np.int64)

    def written(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
        """`a1,a2|b1;a3|b2,b3`: the ids of each group, A's before B's."""
        of_a = np.searchsorted(ends_a, np.arange(len(a)), side="right")
        of_b = np.searchsorted(ends_b, np.arange(len(b)), side="right")
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ends_a - 1] = 1
        last_b[ends_b - 1] = 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], ends_b])[of_a]] = a + last_a * self.a.size
        order[np.arange(len(b)) + ends_a[of_b]] = b + last_b * self.b.size + 2 * self.a.size
        return "".join(map(self.shown.__getitem__, order.tolist()))[:-1]

    def codes(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
        """A number for the id pair of each link."""
        return a[ends_a - 1].astype(np.int64) * self.by_code + b[ends_b - 1]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_name: str, b_name: str) -> Aligner:
    """One aligner for each pair of distributed models and worker process."""
    if (a_name, b_name) not in _ALIGNERS:
        _ALIGNERS[a_name, b_name] = Aligner(SparkFiles.get(a_name), SparkFiles.get(b_name))
    return _ALIGNERS[a_name, b_name]


class PairSums:
    """Sums of counts by pair code, merged whenever the buffer is full."""

    def __init__(self, most: int = BUFFER) -> None:
        self.most, self.held, self.waiting = most, 0, []
        self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((codes, counts))
        self.held += len(codes)
        if self.held >= self.most:
            self.merge()

    def merge(self) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        self.codes, self.counts = codes[first], np.add.reduceat(counts, first) if len(first) else counts
        self.waiting, self.held = [], 0


def _models(docs: DataFrame, a_path: str | None, b_path: str | None) -> tuple[str, str]:
    paths = a_path or default_tokenizer(), b_path or default_model()
    for path in paths:
        docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(paths[0]), os.path.basename(paths[1])


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """id_col, a_ids, b_ids, a_ends, b_ends: both sides' ids and how many of each stand before the end of every group."""
    names = _models(docs, a_path, b_path)
    slim = docs.select(named(id_col), text_or_empty(text).alias("text"))
    kind = slim.schema[id_col].dataType.simpleString()

    def run(batches):
        use = aligner(*names)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                rows = []
                for pair in use.encode(texts):
                    a, b = pair or (np.empty(0, np.int32),) * 2
                    rows.append((a, b, *(use.align(a, b) if pair else (a, b))))
                arrays = [pa.array([x.astype(np.int32) for x in c], pa.list_(pa.int32())) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *arrays], [id_col, "a_ids", "b_ids", "a_ends", "b_ends"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(code, n): how many links hold each pair, from rows of (codes, counts) as binary arrays; summed in each task first."""

    def run(batches):
        sums = PairSums()
        for batch in batches:
            for codes, counts in zip(batch.column(0), batch.column(1), strict=True):
                sums.add(np.frombuffer(codes.as_buffer(), "<u8").astype(np.int64), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
        sums.merge()
        for k in range(0, len(sums.codes), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(sums.codes[k : k + (1 << 16)]), pa.array(sums.counts[k : k + (1 << 16)])], ["code", "n"])

    partial = linked.where("n_links > 0").select("codes", "counts").mapInArrow(run, "code long, n long")
    return partial.groupBy("code").agg(F.sum("n").alias("n"))


class PairTable:
    """Counts of all pairs, and which are the highest of their B id."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, by_code: int) -> None:
        order = np.argsort(codes)
        self.codes, self.counts = codes[order], counts[order]
        highest = np.zeros(by_code, np.int64)
        np.maximum.at(highest, self.codes % by_code, self.counts)
        self.best = self.counts == highest[self.codes % by_code]

    def __call__(self, codes: np.ndarray, times: np.ndarray) -> tuple[int, int]:
        """(links whose pair is a best one, sum of the pairs' counts over links)."""
        at = np.searchsorted(self.codes, codes)
        return int(times[self.best[at]].sum()), int((times * self.counts[at]).sum())


def alignment_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text's alignment."""
    spark = docs.sparkSession
    names = _models(docs, a_path, b_path)
    slim = docs.select(named(id_col), text_or_empty(text).alias("text"))
    kind = slim.schema[id_col].dataType.simpleString()
    own = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "counts"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]

    def run(batches):
        use = aligner(*names)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                rows = []
                for pair in use.encode(texts):
                    if pair is None:
                        rows.append((0, 0, 0, 0, "", b"", b""))
                        continue
                    ends = use.align(*pair)
                    codes, counts = np.unique(use.codes(*pair, *ends), return_counts=True)
                    sha = hashlib.sha256(use.written(*pair, *ends).encode()).hexdigest()
                    rows.append((len(pair[0]), len(pair[1]), len(ends[0]), len(ends[0]), sha, codes.astype("<u8").tobytes(), counts.astype("<u4").tobytes()))
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *arrays], ["id", *own])

    made = slim.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, counts binary")
    linked = stash(made, "aligned")
    counted = stash(pair_counts(linked), "aligned-pairs").toArrow()  # bounded by the two models, see above
    by_code = PieceTokens(b_path or default_model()).size
    table = spark.sparkContext.broadcast(PairTable(counted["code"].to_numpy(), counted["n"].to_numpy(), by_code))
    out = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def look_up(batches):
        find = table.value
        for batch in batches:
            found = [find(np.frombuffer(c.as_buffer(), "<u8").astype(np.int64), np.frombuffer(n.as_buffer(), "<u4").astype(np.int64)) for c, n in zip(batch.column(6), batch.column(7), strict=True)]
            best, sums = (pa.array(x, pa.int64()) for x in zip(*found, strict=True)) if found else (pa.array([], pa.int64()),) * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), best, sums, batch.column(5)], out)

    return linked.mapInArrow(look_up, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op12_align_tokens(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment_digests(docs.select(F.col("doc_id").cast("long"), "text"))
