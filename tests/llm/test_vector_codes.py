"""Vantage trees against plain search, and the codes against plain loops over whole numbers."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from plenum.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, id int, code string, v string, error int"



def plain(rows, parts, entries, rounds):
    """(vec_id, code, error, label, label_error) of each kept row, and the codebooks."""
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=order)
    dims = len(kept[0][1]) if kept else parts
    kept = [(r[0], [int(np.floor(256 * x)) for x in r[1]], r[2]) for r in kept if len(r[1]) == dims]
    width = dims // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        after = []
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[nearest(p, c[p])[1]].append(c[p])
            after.append([[sum(x) // len(held[k]) for x in zip(*held[k], strict=True)] if held[k] else e for k, e in enumerate(books[p])])
        books = after
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    sums = defaultdict(int)
    for (_, _, label), f in zip(kept, found, strict=True):
        sums[label] += sum(d for d, _ in f)
    return sorted(((i, tuple(k for _, k in f), sum(d for d, _ in f), label, sums[label]) for (i, _, label), f in zip(kept, found, strict=True)), key=repr), books


def table(n=300, dims=8, seed=5):
    rng = random.Random(seed)
    rows = [(rng.randrange(10_000), [rng.choice([rng.gauss(0, 0.3), 0.25, -0.25]) for _ in range(dims)], rng.choice([0, 1, 1, None])) for _ in range(n)]
    rows += [rows[3], rows[3], (None, rows[5][1], 1), (1, None, 1), (2, [], 1), (3, [0.1] * (dims - 1) + [float("nan")], 1), (4, [float("inf")] + [0.0] * (dims - 1), 1), (5, [None] + [0.0] * (dims - 1), 1), (20_000, [0.5] * (dims + 2), 1)]
    return rows + [(30_000 + k, [0.125] * dims, 0) for k in range(200)]  # one vector, many times


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "v", 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("entries", "rounds", "n"), [(64, 2, 300), (16, 3, 300), (64, 2, 20)])
def test_codes_equal_plain_loops(spark, entries, rounds, n):
    rows = table(n)
    want, books = plain(rows, 4, entries, rounds)
    made, own = vector_codes.compress(frame(spark, rows), parts=4, entries=entries, rounds=rounds)
    got = [(r["id"], tuple(r["code"]), r["error"], r["label"], r["label_error"]) for r in vector_codes.with_label_errors(made).collect()]
    assert own.tolist() == books and sorted(got, key=repr) == want
    assert vector_codes.codebooks_sha256(own) == hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    back = {(r["id"], tuple(r["vector"])) for r in vector_codes.decoded(made, own).collect()}
    assert back == {(i, tuple(x / 256 for p, k in enumerate(code) for x in books[p][k])) for i, code, *_ in want}


def test_empty_tables_and_odd_lengths(spark):
    made, books = vector_codes.compress(frame(spark, [(1, None, 1)]))
    assert made.count() == 0 and vector_codes.with_label_errors(made).count() == 0 and books.shape[1] == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(frame(spark, [(1, [0.5] * 7, 1)]))


def test_components_beyond_the_limit_count_as_it(spark):
    made, books = vector_codes.compress(frame(spark, [(1, [1e300, -1e300] * 8, 1), (2, [0.0] * 16, 1)]), parts=4)
    assert books.max() == vector_codes.limit(16) and books.min() == -vector_codes.limit(16) and all(r["error"] >= 0 for r in made.collect())


@pytest.mark.parametrize("leaf", [1, 6])
@pytest.mark.parametrize("spread", [2, 50, 1 << 26])
def test_tree_against_plain_search(leaf, spread):
    rng = np.random.default_rng(spread)
    for k in (1, 2, 7, 64):
        entries = rng.integers(-spread, spread, (k, 4))
        entries[k // 2 :] = entries[: k - k // 2]  # repeated entries tie
        points = np.concatenate([rng.integers(-spread, spread, (500, 4)), entries])
        squares = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        index, best = vector_codes.VantageTree(entries, leaf).nearest(points)
        assert (index == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()


def test_the_tree_compares_less_than_all():
    rng = np.random.default_rng(9)
    centres = rng.integers(-2000, 2000, (64, 4))
    points = centres[rng.integers(0, 64, 5000)] + rng.integers(-20, 20, (5000, 4))
    tree = vector_codes.VantageTree(centres)
    tree.nearest(points)
    assert tree.compared < 0.5 * 64 * len(points)


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = con.sql(vector_codes.OP13_SQL)
    got = vector_codes.op13_vector_codes(spark, sf)
    at = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[k] for k in at) for r in want.fetchall())
