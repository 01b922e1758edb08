"""Product codes of vectors, exact in integers, found by vantage-point trees.

A component x becomes floor(256 * x). Vectors are cut into equal consecutive parts, and every part position has a
codebook that starts as that part of the vectors with the smallest ids. In each round a part goes to its nearest
entry and an entry becomes the floor of its parts' mean. The nearest entry is found by branch and bound in a vantage-point
tree over the codebook's entries: distances to the vantage entry bound those to the entries on either side by the
triangle inequality. Radii are rounded outwards and a side is visited where its bound does not exceed the best
distance, so no rounding can hide an entry; what is visited is compared as integers, ties to the lower index.
A batch of parts walks the tree together.

Tasks sum the parts of each entry themselves; what leaves a task, and what reaches the driver, is one number
for each entry and component, however many vectors there are.

Defined cases
- vectors that are null, or hold null or non-finite components, are dropped; so are those whose length isn't that of
  the vector with the smallest id, and empty ones. If the length is no multiple of the parts: an error.
- fewer vectors than entries: as many entries as there are vectors. Empty table: empty result.
- ties: of entries that are equally near the lowest index; of vectors that share an id the least vector comes first, null
  ids come last. Repeated rows: each counts. Entries that nothing is nearest to stay as they are.
- components beyond what 64-bit sums of squares allow (2^27 after scaling for parts of four) count as that limit.
- extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import few_broadcast, named, stash

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Entries of a leaf, compared one after the other.
LEAF = 6
#: Rows that walk the trees together.
AT_ONCE = 4096
#: Labels that may be sent to every executor with their sums.
BROADCAST_LABELS = 200_000


def _root(squares: np.ndarray, toward: float) -> np.ndarray:
    """Square roots, rounded towards -inf or inf by more than conversion and root can be wrong."""
    root = np.sqrt(squares.astype(np.float64))
    return np.nextafter(np.nextafter(root, toward), toward)


class VantageTree:
    """The nearest of a codebook's entries (k x d integers), ties to the lower index."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF) -> None:
        self.entries, self.leaf = entries.astype(np.int64), leaf
        self.root = self._node(np.arange(len(entries)))
        self.compared = 0

    def _node(self, which: np.ndarray):
        """A leaf: its entries. Else: (vantage entry, two sides, each with its least and largest distance from it)."""
        if len(which) <= self.leaf:
            return which
        vantage, rest = which[0], which[1:]
        squares = ((self.entries[rest] - self.entries[vantage]) ** 2).sum(axis=1)
        order = np.argsort(squares, kind="stable")
        half = (len(rest) + 1) // 2
        sides = []
        for part in (order[:half], order[half:] if half < len(order) else order[:1]):  # a side is never empty
            low, high = _root(squares[part[:1]], -np.inf)[0], _root(squares[part[-1:]], np.inf)[0]
            sides.append((low, high, self._node(np.sort(rest[part]))))
        return vantage, *sides

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each point."""
        points = points.astype(np.int64)
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        if len(points):
            self._visit(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _compare(self, entry: int, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> np.ndarray:
        squares = ((points[rows] - self.entries[entry]) ** 2).sum(axis=1)
        better = (squares < best[rows]) | ((squares == best[rows]) & (entry < index[rows]))
        best[rows[better]] = squares[better]
        index[rows[better]] = entry
        self.compared += len(rows)
        return squares

    def _visit(self, node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            for entry in node:
                self._compare(entry, points, rows, best, index)
            return
        vantage, inner, outer = node
        squares = self._compare(vantage, points, rows, best, index)
        below, above = _root(squares, -np.inf), _root(squares, np.inf)
        # No entry of a side is nearer than its bound.
        bounds = [np.maximum(low - above, below - high) for low, high, _ in (inner, outer)]
        near = bounds[0] <= bounds[1]
        for chosen, bound, side in ((near, bounds[0], inner), (~near, bounds[1], outer), (near, bounds[1], outer), (~near, bounds[0], inner)):
            left = chosen & (bound <= _root(best[rows], np.inf))
            if left.any():
                self._visit(side[2], points, rows[left], best, index)


def limit(dims: int) -> int:
    """The largest component whose squared distances, summed over a vector, stay below 2^63."""
    return int(((2**63 - 1) // (4 * dims)) ** 0.5 * 0.999)


def _scaled(vectors: np.ndarray, bound: int) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -bound, bound).astype(np.int64)


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """An Arrow column of integer lists of one length as a matrix."""
    return np.asarray(column.flatten()).reshape(-1, dims)


def integers(vectors: DataFrame, id_col: str, vector: str, *more: str) -> tuple[DataFrame, int]:
    """((id, v, *more), dims): the vectors kept, as integers, in a written table."""
    rows = vectors.select(named(id_col).alias("id"), named(vector).cast("array<double>").alias("x"), *[named(c).alias(f"more{k}") for k, c in enumerate(more)])
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = rows.where(F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size("x") > 0))
    first = sound.orderBy(F.col("id").asc_nulls_last(), "x").select(F.size("x").alias("d")).limit(1).collect()
    dims = first[0]["d"] if first else 0
    own = [f"more{k}" for k in range(len(more))]
    kinds = {f.name: f.dataType.simpleString() for f in sound.schema}
    bound = limit(max(dims, 1))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = _scaled(_matrix(batch.column(1), dims), bound)
                column = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), dims).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), column, *batch.columns[2:]], ["id", "v", *own])

    schema = ", ".join([f"id {kinds['id']}", "v array<long>", *[f"{c} {kinds[c]}" for c in own]])
    return stash(sound.where(F.size("x") == dims).mapInArrow(run, schema), "vector-integers"), dims


def _slices(batches, column: int, dims: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            piece = batch.slice(k, AT_ONCE)
            yield piece, _matrix(piece.column(column), dims).reshape(-1, parts, dims // parts)


def _assign(trees: list[VantageTree], cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part of a batch (rows x parts x width)."""
    found = [tree.nearest(cut[:, p]) for p, tree in enumerate(trees)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def first_codebooks(rows: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """parts x entries x width: the parts of the vectors with the smallest ids."""
    first = [r["v"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    return np.array(first, np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)


def improved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry that parts are nearest to becomes the floor of their mean."""
    parts, entries, width = books.shape
    dims = parts * width

    def run(batches):
        trees = [VantageTree(book) for book in books]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, cut in _slices(batches, 0, dims, parts):
            index, _ = _assign(trees, cut)
            for p in range(parts):
                np.add.at(sums[p], index[:, p], cut[:, p])
                counts[p] += np.bincount(index[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        columns = [p, e, counts[p, e]]
        total = pa.FixedSizeListArray.from_arrays(pa.array(sums[p, e].ravel()), width).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), total], ["part", "entry", "n", "total"])

    partial = rows.select("v").mapInArrow(run, "part long, entry long, n long, total array<long>")
    exact = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width)]
    out = books.copy()
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():  # a row for each entry
        out[r["part"], r["entry"]] = [int(r[f"t{k}"]) // r["n"] for k in range(width)]
    return out


def coded(rows: DataFrame, books: np.ndarray, *more: str) -> DataFrame:
    """(id, code array<int>, error, *more) of each vector."""
    parts, _, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        trees = [VantageTree(book) for book in books]
        for piece, cut in _slices(batches, 1, parts * width, parts):
            index, squares = _assign(trees, cut)
            codes = pa.FixedSizeListArray.from_arrays(pa.array(index.astype(np.int32).ravel()), parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column(0), codes, pa.array(squares.sum(axis=1)), *piece.columns[2:]], ["id", "code", "error", *more])

    schema = ", ".join([f"id {kinds['id']}", "code array<int>, error long", *[f"`{c}` {kinds[c]}" for c in more]])
    return rows.select("id", "v", *more).mapInArrow(run, schema)


def decoded(codes: DataFrame, books: np.ndarray, id_col: str = "id", code: str = "code") -> DataFrame:
    """id_col, vector array<double>: what each code stands for."""
    slim = codes.select(named(id_col).alias("id"), named(code).alias("code"))
    kind = slim.schema["id"].dataType.simpleString()
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            index = _matrix(batch.column(1), parts)
            made = books[np.arange(parts), index].reshape(len(index), parts * width) / SCALE
            column = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), parts * width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], [id_col, "vector"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, vector array<double>")


def codebooks_sha256(books: np.ndarray) -> str:
    """Of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((id, code array<int>, error, label), codebooks), the rows in a written table."""
    rows, dims = integers(vectors, id_col, vector, label)
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    books = first_codebooks(rows, dims, parts, entries) if dims else np.zeros((parts, 0, 1), np.int64)
    for _ in range(rounds if dims else 0):
        books = improved(rows, books)
    return stash(coded(rows, books, "more0"), "vector-codes").withColumnRenamed("more0", "label"), books


def with_label_errors(rows: DataFrame) -> DataFrame:
    """`rows` with label_error: the errors of all rows of the same label, nulls together, as far as a long holds it."""
    most = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    sums = stash(rows.groupBy("label").agg(most.alias("label_error")).withColumnRenamed("label", "of"), "vector-labels")
    return rows.join(few_broadcast(sums, BROADCAST_LABELS), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    rows, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    made = with_label_errors(rows.select("id", hexed.alias("code"), "error", "label"))
    return made.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to the codebooks of round k, and the codebooks after it."""
    square = " + ".join(f"(q.x{i} - c.x{i}) * (q.x{i} - c.x{i})" for i in range(4))
    mean = ", ".join(f"coalesce(CAST(floor(s.x{i} / s.n) AS BIGINT), c.x{i}) AS x{i}" for i in range(4))
    sums = ", ".join(f"sum(q.x{i}) AS x{i}" for i in range(4))
    return f"""a{k} AS MATERIALIZED (
  SELECT q.vec_id, q.p, any_value(q.label) AS label, {", ".join(f"any_value(q.x{i}) AS x{i}" for i in range(4))}, min(({square}) * 64 + c.e) AS best
  FROM q JOIN c{k} c USING (p) GROUP BY q.vec_id, q.p
), c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, {mean} FROM c{k} c
  LEFT JOIN (SELECT p, best % 64 AS e, count(*) AS n, {sums} FROM a{k} q GROUP BY ALL) s USING (p, e)
)"""


OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS MATERIALIZED (
  SELECT vec_id, label, p, v[4 * p + 1] AS x0, v[4 * p + 2] AS x1, v[4 * p + 3] AS x2, v[4 * p + 4] AS x3 FROM kept, range(16) t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x0, x1, x2, x3 FROM q QUALIFY e < 64
), {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)}, coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM coded
"""
