"""Toxicity: a learnt lexicon matched with tolerance, hits weighed by their context.

Lexicon: words, and beginnings of words, that training documents marked toxic hold and others don't.
Matching: the terms form a trie; a word is looked up by walking the trie together with the word's
Levenshtein automaton (its rows of edit distances), so misspelled terms are found as well as exact ones.
Context: a window of words around each hit tells quotation and report (a hit counts less) from address
(it counts more). A logistic model over the weighed hits, fitted on training documents, gives the score.
Labels, language, source and id are never inputs of a score.

Bound (a parameter): at most `max_train` labelled training documents, the first by a hash of their id, are
read for learning. Terms are whole words of at least four letters and beginnings of four to eight letters; each
must be in one of fifty toxic training documents, so their number follows from the sample. Every document is
scored whole.

Defined cases
- null and empty texts: no hits, the score of a text without hits. Empty table: empty result.
- no training labels of one kind: no lexicon, each score is the share of toxic training labels (or 0).
- repeated labels of an id: toxic if any is. Repeated documents are scored each.
- extra columns are ignored by `scores` and passed on by `keep_civil`, whatever their names.
- very long texts: time grows with the length; a task holds one Arrow batch.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import named, packed, stash, text_or_empty, unpacked

MAX_TRAIN = 12_000
THRESHOLD = 0.3
#: Share of a term's training documents that must be toxic.
PRECISION = 0.6
WINDOW = 6
EDITS = 1
SHORTEST = 4
LONGEST_PREFIX = 8
#: Words, about 150 bytes each, that a task remembers; results don't depend on it.
REMEMBERED = 60_000

# Marks and words that tell quotation, report and address.
QUOTES = "\"“”„«»‘’‹›"
REPORTS = frozenset("said says say called calls wrote quote quoted word term phrase reads sagte nannte schrieb zitat wort dit appelle mot cite dijo dice llama palabra cita".split())
ADDRESS = frozenset("you your youre du dich dir euch ihr tu toi te vous eres usted ustedes".split())

_EDGES = re.compile(r"^[\W\d_]+|[\W_]+$")


def trained_on(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def bare(word: str) -> str:
    """A word in lower case without marks around it."""
    return word.lower() if word.isalpha() else _EDGES.sub("", word).lower()


def terms_of(text: str) -> set[str]:
    """Candidate terms: whole words (ending in $) and beginnings of words."""
    out: set[str] = set()
    for word in {bare(w) for w in set(text.split())}:
        if len(word) >= SHORTEST:
            out.add(word + "$")
        out.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST_PREFIX) + 1))
    return out


def _any_of(starts):
    """Whether a word begins with one of the given strings."""
    found = "|".join(map(re.escape, sorted(starts)))
    return re.compile(found).match if found else (lambda word: None)


def _swaps(letters: str) -> list[str]:
    """The letters with one place blanked, for each place: two strings one substitution apart share one of them."""
    return [f"{letters[:k]}\0{letters[k + 1 :]}" for k in range(len(letters))]


class Lexicon:
    """A trie of terms; whole words end in $. Short terms in `loose` admit one substitution."""

    def __init__(self, terms: list[str], edits: int = EDITS, loose: Iterable[str] = ()) -> None:
        self.terms, self.edits = sorted(terms), edits
        self.swapped: dict[str, list[str]] = {}
        for term in sorted(loose):
            for form in _swaps(term.rstrip("$")):
                self.swapped.setdefault(form + "$" * term.endswith("$"), []).append(term)
        self.sizes = sorted({len(t) for t in loose if not t.endswith("$")})
        self.whole = {t[:-1] for t in terms if t.endswith("$")}
        self.starts = _any_of(t for t in terms if not t.endswith("$"))
        self.root: dict = {}
        # If a term of d + 1 parts is within d edits of a word, one part stands unchanged within d places of its own.
        parts: dict[int, set[str]] = {}
        for term in self.terms:
            letters = term.rstrip("$")
            if self.tolerance(term) == 0:
                continue
            node = self.root
            for c in letters:
                node = node.setdefault(c, {})
            node["$" if term.endswith("$") else "^"] = term
            cuts = [round(k * len(letters) / (edits + 1)) for k in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                parts.setdefault(a, set()).add(letters[a:b])
        near = [f".{{{max(0, a - edits)},{a + edits}}}(?:{'|'.join(map(re.escape, sorted(p)))})" for a, p in sorted(parts.items())]
        self.may = re.compile("|".join(near), re.DOTALL).match
        # What tells most words at once: no start of a term, no loose term but for one letter, no part of a term.
        forms = ["".join("." if c == "\0" else r"\Z" if c == "$" else re.escape(c) for c in form) for form in sorted(self.swapped)]
        starts = [re.escape(t) for t in self.terms if not t.endswith("$")]
        self.near = None if not self.terms else re.compile("|".join([*starts, *forms, *near]), re.DOTALL).match

    def tolerance(self, term: str) -> int:
        """Edits allowed: none for short terms, where one would turn many other words into hits."""
        return self.edits if len(term.rstrip("$")) >= (5 if term.endswith("$") else 7) else 0

    def substituted(self, word: str) -> set[str]:
        """Loose terms that the word is one substitution away from."""
        if not self.swapped:
            return set()
        forms = [form + "$" for form in _swaps(word)] if len(word) == SHORTEST else []
        forms += [form for k in self.sizes if k <= len(word) for form in _swaps(word[:k])]
        return {term for form in forms for term in self.swapped.get(form, ())}

    def nearest(self, word: str) -> int | None:
        """The fewest edits from the word to a term, if within the term's tolerance."""
        if word in self.whole:
            return 0
        if self.near is None or not self.near(word):
            return None
        if self.starts(word):
            return 0
        if self.substituted(word):
            return 1
        if not self.root or not self.may(word):
            return None
        best: int | None = None
        size, most = len(word), self.edits
        stack = [(self.root, list(range(size + 1)))]
        while stack:
            node, row = stack.pop()
            if "$" in node and row[-1] <= most and (best is None or row[-1] < best):
                best = row[-1]
            if "^" in node and min(row) <= most and (best is None or min(row) < best):
                best = min(row)
            for c, child in node.items():
                if c in "$^":
                    continue
                grown = [row[0] + 1]
                for k in range(size):
                    grown.append(min(row[k] + (word[k] != c), row[k + 1] + 1, grown[k] + 1))
                if min(grown) <= most:
                    stack.append((child, grown))
        return best


@dataclass
class Model:
    terms: list[str]
    weights: list[float]  # intercept first
    plain: float  # the score where there is no lexicon
    loose: list[str] = field(default_factory=list)  # short terms that admit a substitution


class Scorer:
    """Scores one text after another with a model."""

    def __init__(self, model: Model, remembered: int = REMEMBERED) -> None:
        self.model, self.lexicon = model, Lexicon(model.terms, loose=model.loose)
        lexicon = self.lexicon

        class Known(dict):
            def __missing__(self, raw: str) -> int:
                if len(self) >= remembered:
                    self.clear()
                hit = lexicon.nearest(bare(raw))
                value = self[raw] = 0 if hit is None else hit + 1
                return value

        self.known = Known()

    def features(self, text: str) -> list[float]:
        words = text.split()
        hits = list(map(self.known.__getitem__, words))
        if not any(hits):
            return [0.0] * 5
        exact = fuzzy = most = direct = 0.0
        for i, hit in enumerate(hits):
            if hit:
                weight = self.context(words, i) * (1.0 if hit == 1 else 0.5)
                exact += weight if hit == 1 else 0.0
                fuzzy += weight if hit > 1 else 0.0
                most = max(most, weight)
                direct += weight >= 1.0
        return [math.log1p(exact), math.log1p(fuzzy), most, math.log1p(direct), math.log1p(100 * (exact + fuzzy) / len(words))]

    def context(self, words: list[str], at: int) -> float:
        """How far a hit counts: less in quotation or report, more in address."""
        before, after = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
        own = words[at]
        opened = own[:1] in QUOTES or any(w[:1] in QUOTES and w[-1:] not in QUOTES for w in before)
        closed = own.rstrip(".,;:!?)")[-1:] in QUOTES or any(w.rstrip(".,;:!?)")[-1:] in QUOTES and w[:1] not in QUOTES for w in after)
        near = {bare(w) for w in before[-3:]} | {bare(w) for w in after[:2]}
        weight = 1.0 - 0.6 * (opened and closed) - 0.2 * bool(near & REPORTS) + 0.2 * bool(near & ADDRESS)
        return max(0.1, weight)

    def score(self, text: str) -> float:
        if not self.model.terms:
            return self.model.plain
        x = self.features(text)
        z = self.model.weights[0] + sum(w * v for w, v in zip(self.model.weights[1:], x, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def choose_terms(counts: list[tuple[str, int, int]], toxic: int) -> list[str]:
    """Terms that tell toxic documents, from (term, toxic documents, other documents)."""
    least = max(5, math.ceil(0.02 * toxic))
    good = {t: (p, n) for t, p, n in counts if p >= least and p / (p + n + 1) >= PRECISION}
    # Of beginnings with the same documents the longest says most; then the shortest of a chain covers the rest.
    longer: dict[str, list[str]] = {}
    for t in good:
        if len(t.rstrip("$")) > SHORTEST or t.endswith("$"):
            longer.setdefault(t[:-1], []).append(t)
    closed = {t for t in good if not any(good[x] == good[t] for x in longer.get(t, ()))}
    # A beginning gives way to what extends it, is as frequent in toxic documents, and is in fewer others.
    for t in good:
        closed -= {b for k in range(SHORTEST, len(t)) if (b := t[:k]) in good and good[b][0] == good[t][0] and good[b][1] > good[t][1]}
    kept: set[str] = set()
    for t in sorted(closed, key=lambda t: (len(t.rstrip("$")), t)):
        if not any(t[:k] in kept for k in range(SHORTEST, len(t.rstrip("$")) + (1 if t.endswith("$") else 0))):
            kept.add(t)
    return sorted(kept)


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> list[float]:
    """Logistic regression with a ridge on all but the intercept, by Newton's method."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[0] = math.log(rate / (1 - rate))
    keep = np.diag([1e-3, *[ridge] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        slope = a.T @ (y - p) - keep @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text: str, max_train: int) -> DataFrame:
    marked = labels.where(trained_on(F.col(id_col)) & F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("l")).agg(F.max("toxic").cast("int").alias("y"))
    chosen = stash(marked.orderBy(F.xxhash64("l"), "l").limit(max_train), "tox-labels")  # at most max_train rows
    rows = docs.select(named(id_col).alias("i"), text_or_empty(text).alias("text")).join(F.broadcast(chosen), F.col("i") == F.col("l"))
    # A document that is there several times is learnt from once.
    return stash(rows.groupBy("i").agg(F.first("y").alias("y"), F.min("text").alias("text")).select("y", "text").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "tox-train")


def _loose(train: DataFrame, terms: list[str]) -> list[str]:
    """Terms too short for edits that no civil training document has a word one substitution away from."""
    strict = Lexicon(terms)
    short = [t for t in terms if strict.tolerance(t) == 0]

    def count(batches):
        lexicon = Lexicon(terms, loose=short)
        for batch in batches:
            met: set[str] = set()
            for word in {bare(w) for y, t in zip(batch.column(0), batch.column(1), strict=True) if not y.as_py() for w in set(t.as_py().split())}:
                if word not in lexicon.whole and not lexicon.starts(word):
                    met |= lexicon.substituted(word)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.string())], ["term"])

    met = {r["term"] for r in train.mapInArrow(count, "term string").distinct().collect()}  # at most the short terms
    return [t for t in short if t not in met]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", max_train: int = MAX_TRAIN) -> Model:
    """The model; labels has id_col and toxic (0/1). Only rows that `trained_on` picks are used."""
    train = _training(docs, labels, id_col, text, max_train)
    tally = {int(r["y"]): int(r["count"]) for r in train.groupBy("y").count().collect()}
    toxic, civil = tally.get(1, 0), tally.get(0, 0)
    plain = toxic / (toxic + civil) if toxic + civil else 0.0
    if not toxic or not civil:
        return Model([], [], plain)

    def count(batches):
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for y, t in zip(batch.column(0), batch.column(1), strict=True):
                found[y.as_py()].update(terms_of(t.as_py()))
            terms = sorted(set(found[0]) | set(found[1]))
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *[pa.array([found[y][t] for t in terms], pa.int64()) for y in (1, 0)]], ["term", "p", "n"])

    counts = train.mapInArrow(count, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    # Bounded by the sample: each is in at least one in fifty of its toxic documents.
    useful = counts.where((F.col("p") >= max(5, math.ceil(0.02 * toxic))) & (F.col("p") >= PRECISION * (F.col("p") + F.col("n") + 1)))
    terms = choose_terms([(r["term"], r["p"], r["n"]) for r in useful.collect()], toxic)
    if not terms:
        return Model([], [], plain)
    loose = _loose(train, terms)
    bare_model = Model(terms, [0.0] * 6, plain, loose)

    def measure(batches):
        scorer = Scorer(bare_model)
        for batch in batches:
            x = [scorer.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    seen = train.mapInArrow(measure, "y int, x array<double>").collect()  # at most max_train short rows
    seen = sorted((r["y"], *r["x"]) for r in seen)
    data = np.array(seen, float)
    return Model(terms, fit_weights(data[:, 1:], data[:, 0]), plain, loose)


def _with_scores(rows: DataFrame, at: int, model: Model, name: str) -> DataFrame:
    """`rows` and a score column of the text in column `at`."""

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            made = pa.array([scorer.score(t.as_py() or "") for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, DoubleType())]))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, score: one row per document."""
    slim = docs.select(named(id_col).alias("id"), text_or_empty(text).alias("text"))
    return _with_scores(slim, 1, model, "score").select(F.col("id").alias(id_col), "score")


def keep_civil(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold."""
    scored = _with_scores(packed(docs, text_or_empty(text).alias("text")), 1, model, "score")
    return unpacked(scored.where(F.col("score") < threshold), docs)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = scores(docs, model)
    return found.select("doc_id", (~trained_on(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
