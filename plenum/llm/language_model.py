"""Scoring texts with a weighted backoff automaton learnt from the corpus.

The model is a smoothed bigram model. Its states are the words met (and the start of a text); a state has
an arc for each word that followed it in training, weighted with the log-probability
log10((c(hw) + mu * P(w)) / (c(h) + mu)), and a failure arc, weighted log10(mu / (c(h) + mu)), to the
common state, whose arcs weigh log10 P(w) with P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)). A text is scored
in one traversal from left to right that carries the state and adds up the weights.

The automaton of a large corpus fits no single machine, so each block of texts gets the part it can reach:
1. each block sends the sorted hashes of its distinct words and word pairs, with their training counts, to
   ranges of the hash space (a frequent pair is one entry per block, so no range is hot);
2. each range adds up the counts and answers every block in the order in which it asked, without keys;
3. each block, cut again from the same rows, builds its part of the automaton and traverses its texts.
The rows are read twice, as the same blocks; a block whose answers don't fit its second reading fails
the job rather than give wrong scores (write such an input to a table first). All of the corpus is
counted; there is no cutoff. Words and pairs are told apart by 64-bit hashes.

Defined cases
- null and empty texts: one token, the end. Null ids count as the text "" for the hold-out rule.
- repeated rows: each is trained on and scored. Empty table: empty result. Extra columns are ignored.
- no training rows: N = V = 0, the base is uniform over one unknown token.
- very long texts: a text is never parted, so a block holds at least one; otherwise `BLOCK` bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import named, stash, text_or_empty
from plenum.llm.shingles import mixed, word_hashes

BLOCK = 16 << 20
RANGE_BYTES = 32 << 20
MU = 16.0
ADD = 0.1
#: Neither can be a word: words hold no white space.
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))
START = np.uint64(xxhash.xxh3_64_intdigest(b" start"))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: Column, folds: int = 10, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


@dataclass
class Automaton:
    """The part of the automaton that some texts reach: log10 weights by symbol, state and arc."""

    common: np.ndarray  # arcs of the common state, by symbol
    failure: np.ndarray  # failure arcs, by state
    arcs: np.ndarray  # arcs by pair; NaN where the state has no such arc

    @classmethod
    def build(cls, symbol_counts, state_counts, pair_counts, pair_symbols, pair_states, total: int, distinct: int, mu: float = MU) -> Automaton:
        p = (symbol_counts + ADD) / (total + ADD * (distinct + 1))
        arcs = np.full(len(pair_counts), np.nan)
        seen = pair_counts > 0
        states = pair_states[seen]
        arcs[seen] = np.log10((pair_counts[seen] + mu * p[pair_symbols[seen]]) / (state_counts[states] + mu))
        return cls(np.log10(p), np.log10(mu / (state_counts + mu)), arcs)

    def traverse(self, states: np.ndarray, symbols: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """The weight of each step of texts laid end to end: the arc, or else the failure arc and the common arc."""
        arc = self.arcs[pairs]
        return np.where(np.isnan(arc), self.failure[states] + self.common[symbols], arc)


@dataclass
class Block:
    """Texts laid end to end as hashes, each closed by END."""

    ids: list
    held: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray

    def histories(self) -> np.ndarray:
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = START
        return before

    def in_training(self) -> np.ndarray:
        return np.repeat(~self.held, np.diff(np.append(self.starts, len(self.tokens))))


def pair_keys(histories: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(histories * _PAIR + tokens)


def blocks(batches, size: int = BLOCK) -> Iterator[Block]:
    """Blocks of whole texts from Arrow batches of (id, held, text), the same ones from the same rows."""
    ids, held, parts, held_bytes = [], [], [], 0

    def made() -> Block:
        lengths = np.array([len(p) for p in parts], np.int64)
        return Block(ids, np.array(held, bool), np.concatenate(parts), np.cumsum(lengths) - lengths)

    end = np.array([END], np.uint64)
    for batch in batches:
        for i, h, text in zip(*(batch.column(k) for k in range(3)), strict=True):
            data = text.as_py()
            ids.append(i.as_py())
            held.append(h.as_py())
            parts.append(np.concatenate([word_hashes(data), end]))
            held_bytes += len(data) + 8
            if held_bytes >= size:
                yield made()
                ids, held, parts, held_bytes = [], [], [], 0
    if ids:
        yield made()


def counted(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, how often each occurs in training)."""
    every = np.unique(keys)
    trained, counts = np.unique(keys[training], return_counts=True)
    out = np.zeros(len(every), np.uint32)
    out[np.searchsorted(every, trained)] = counts
    return every, out


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences of six bytes, or eight where one needs more; the first byte says which."""
    steps = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    width = 6 if not len(keys) or int(steps[1:].max(initial=0)) < 1 << 48 else 8
    raw = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width] if len(keys) else np.zeros((0, width), np.uint8)
    return bytes([width]) + (keys[:1].astype("<u8").tobytes() if len(keys) else b"") + raw.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    if len(data) == 1:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), wide.view("<u8").ravel()]), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as compressed planes of bytes."""
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def _edges(ranges: int) -> np.ndarray:
    return np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)


def _name(seq: int) -> int:
    return (TaskContext.get().partitionId() << 24) + seq


def _questions(slim: DataFrame, ranges: int, size: int) -> DataFrame:
    """(range, block, words, word_counts, pairs, pair_counts): what each block asks each range."""

    def run(batches):
        edges = _edges(ranges)
        for seq, block in enumerate(blocks(batches, size)):
            training = block.in_training()
            # The start of a text is a state but no token; it is known by the count of ends.
            words, word_counts = counted(block.tokens, training)
            pairs, pair_counts = counted(pair_keys(block.histories(), block.tokens), training)
            at, to = (np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for x in (words, pairs))
            rows = []
            for r in range(ranges):
                w, p = slice(at[r], at[r + 1]), slice(to[r], to[r + 1])
                if w.stop > w.start or p.stop > p.start:
                    rows.append((r, _name(seq), pack_keys(words[w]), pack_counts(word_counts[w]), pack_keys(pairs[p]), pack_counts(pair_counts[p])))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["range", "block", "words", "word_counts", "pairs", "pair_counts"])

    return slim.mapInArrow(run, "range int, block long, words binary, word_counts binary, pairs binary, pair_counts binary")


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], int, int]:
    """(each asker's keys' counts over all askers, number of keys with a count, sum of counts)."""
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(places, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    return [sums[p] for p in np.split(places, ends[:-1])], int((sums > 0).sum()), int(sums.sum())


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    words, distinct, total = _totals([unpack_keys(x) for x in rows["words"]], [unpack_counts(x) for x in rows["word_counts"]])
    pairs, _, _ = _totals([unpack_keys(x) for x in rows["pairs"]], [unpack_counts(x) for x in rows["pair_counts"]])
    number = rows["range"].iloc[0]
    out = [(int(b), number, pack_counts(w), pack_counts(p), 0, 0) for b, w, p in zip(rows["block"], words, pairs, strict=True)]
    out.append((-1, number, None, None, distinct, total))
    return pd.DataFrame(out, columns=["block", "range", "words", "pairs", "distinct", "total"])


def _texts(slim: DataFrame, size: int, kind: str) -> DataFrame:
    """(block, ids, held, lengths, tokens, words): each block's texts as places in its sorted list of words."""

    def run(batches):
        for seq, block in enumerate(blocks(batches, size)):
            words, places = np.unique(block.tokens, return_inverse=True)
            planes = np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
            lengths = np.diff(np.append(block.starts, len(block.tokens))).astype("<i8").tobytes()
            arrays = [pa.array([_name(seq)], pa.int64()), pa.array([block.ids], pa.list_(kinds)), *[pa.array([x], pa.binary()) for x in (np.packbits(block.held).tobytes(), lengths, zlib.compress(planes, 1), pack_keys(words))]]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "ids", "held", "lengths", "tokens", "words"])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = to_arrow_type(slim.schema["id"].dataType)
    return slim.mapInArrow(run, f"block long, ids array<{kind}>, held binary, lengths binary, tokens binary, words binary")


def _scored(texts: pd.DataFrame, answers: pd.DataFrame, total: int, distinct: int, mu: float) -> pd.DataFrame:
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if not len(texts):
        return pd.DataFrame([], columns=names)
    row = texts.iloc[0]
    words = unpack_keys(row["words"])
    lengths = np.frombuffer(row["lengths"], "<i8")
    places = np.ascontiguousarray(np.frombuffer(zlib.decompress(row["tokens"]), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    answers = answers.sort_values("range")
    word_counts = np.concatenate([unpack_counts(x) for x in answers["words"]])
    pair_counts = np.concatenate([unpack_counts(x) for x in answers["pairs"]])
    tokens = words[places]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = START
    pairs, steps = np.unique(pair_keys(before, tokens), return_inverse=True)
    if len(word_counts) != len(words) or len(pair_counts) != len(pairs):
        raise RuntimeError("the rows of a block have changed between two reads; write the input to a table first")
    # One more state than words: the start, met as often as the end.
    states = np.empty_like(places)
    states[1:] = places[:-1]
    states[starts] = len(words)
    ends = word_counts[np.searchsorted(words, END)]
    pair_symbols, pair_states = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
    pair_symbols[steps], pair_states[steps] = places, states
    model = Automaton.build(word_counts, np.append(word_counts, ends), pair_counts, pair_symbols, pair_states, total, distinct, mu)
    add = lambda x: np.add.reduceat(x, starts)
    return pd.DataFrame(
        {
            "id": list(row["ids"]),
            "held_out": np.unpackbits(np.frombuffer(row["held"], np.uint8), count=len(lengths)).astype(bool),
            "n_tokens": lengths,
            "n_known": add((word_counts > 0).astype(np.int64)[places]),
            "train_tokens": total,
            "base_score": add(model.common[places]),
            "score": add(model.traverse(states, places, steps)),
        },
        columns=names,
    )


def _repeatable(rows: DataFrame) -> DataFrame:
    """Rows that come in the same order each time they are read: a scan as it is, anything else written first."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    loose = ("Exchange", "Python", "Arrow", "Pandas", "Aggregate", "Sort", "Window", "Join", "Limit", "RDD", "LocalTable", "Union", "Coalesce")
    return stash(rows, "lm-rows") if any(x in plan for x in loose) else rows


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", mu: float = MU, block: int = BLOCK) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    slim = docs.select(named(id_col).alias("id"), held_out(named(id_col)).alias("held"), text_or_empty(text).cast("binary").alias("text"))
    slim = _repeatable(slim)
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(8, -(-size // RANGE_BYTES))
    asked = _questions(slim, ranges, block)
    replies = "block long, range int, words binary, pairs binary, distinct long, total long"
    answers = stash(asked.groupBy("range").applyInPandas(_answer, replies), "lm-answers")
    whole = answers.where("block = -1").agg(F.sum("distinct"), F.sum("total")).first()
    distinct, total = int(whole[0] or 0), int(whole[1] or 0)
    kind = slim.schema["id"].dataType.simpleString()
    texts = _texts(slim, block, kind)
    asked_by = answers.where("block >= 0").select("block", "range", "words", "pairs")
    found = texts.groupBy("block").cogroup(asked_by.groupBy("block")).applyInPandas(
        lambda a, b: _scored(a, b, total, distinct, mu),
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return found.withColumnRenamed("id", id_col)


def op6_language_model(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
