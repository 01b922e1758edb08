"""Sharding against a plain Python version of the same rounds, and what rounds and quotas are for."""

import random
import struct
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import xxhash

from plenum.llm import sharding


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(*values):
    """Spark's xxhash64 of a row: each value's hash seeds the next; nulls change nothing."""
    h = 42
    for v in values:
        if isinstance(v, bytes):
            h = xxhash.xxh64_intdigest(v, h)
        elif v is not None:
            kind = "<i" if isinstance(v, Int) else "<q"
            h = xxhash.xxh64_intdigest(struct.pack(kind, v), h)
    return signed(h)


class Int(int):
    """A 32-bit value."""


def brute(rows, shards, rounds=sharding.ROUNDS, bounded=True):
    """(id, size, crc, shard, slot) of each row, as a multiset."""
    made = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), sha256((t or "").encode()).digest()) for i, t in rows]
    count = Counter(r[3] for r in made)
    linked = [[*r, chained(r[0], r[3]) % shards] for r in made if count[r[3]] > 1]
    alone = sorted((r for r in made if count[r[3]] == 1), key=lambda r: r[3])
    total = sum(r[1] for r in made)
    share = total / shards
    null_last = lambda i: (i is None, i or 0)
    for _ in range(rounds):
        load = Counter()
        held = Counter()
        for r in linked:
            load[r[4]] += r[1]
            held[r[3], r[4]] += r[1]
        room = [max(0.0, share * (1 + sharding.SLACK) - load[s]) for s in range(shards)]
        rank = {(g, s): (b, chained(g, Int(s)), s) for (g, s), b in held.items()}

        def goals(open_):
            best = {}
            for (g, s), x in rank.items():
                if open_[s]:
                    best[g] = max(best.get(g, x), x)
            goal = {(g, s): best[g][2] for (g, s), x in rank.items() if g in best and best[g] > x}
            wants = [[0] * shards for _ in range(shards)]
            for (g, s), to in goal.items():
                wants[s][to] += held[g, s]
            return goal, wants

        goal, wants = goals([True] * shards)
        allowed = [[float("inf")] * shards for _ in range(shards)]
        if bounded:
            open_ = [room[s] + sum(wants[s]) > sharding.FULL * share for s in range(shards)]
            goal, wants = goals(open_)
            allowed = sharding.quotas(wants, room)
        if not goal:
            break
        used = Counter()
        for r in sorted(linked, key=lambda r: (r[3], null_last(r[0]), r[1])):
            to = goal.get((r[3], r[4]))
            if to is not None:
                used[r[4], to] += r[1]
                if used[r[4], to] <= allowed[r[4]][to]:
                    r[4] = to
    held, kept = Counter(), []
    for r in sorted(linked, key=lambda r: (r[4], r[3], null_last(r[0]), r[1])):
        held[r[4]] += r[1]
        if held[r[4]] <= share or not bounded:
            kept.append(r)
        else:
            alone.append(tuple(r[:4]))
    alone.sort(key=lambda r: (r[3], null_last(r[0]), r[1]))
    load = Counter()
    for r in kept:
        load[r[4]] += r[1]
    cuts = sharding.edges([load[s] for s in range(shards)], total - sum(load.values()))[:-1]
    at, placed = 0, [tuple(r) for r in kept]
    for r in alone:
        placed.append((*r, sum(e <= at + r[1] / 2 for e in cuts)))
        at += r[1]
    out, slots = [], Counter()
    for i, size, crc, _, s in sorted(placed, key=lambda r: (r[4], r[3], null_last(r[0]), r[1])):
        out.append((i, size, crc, s, slots[s]))
        slots[s] += 1
    return sorted(out, key=repr)


def table(seed=1, hot=0):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    rows = [(i, rng.choice(texts) if rng.random() < 0.4 else f"text {i} " + "x" * rng.randrange(300)) for i in range(700)]
    rows += [(None, "no id"), (None, "no id"), (5, None), (6, ""), (5, None), (7, "same"), (7, "same")]
    return rows + [(10_000 + k, "hot text " * 20) for k in range(hot)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, `group` int").repartition(3)


@pytest.mark.parametrize(("rounds", "hot"), [(4, 0), (4, 400), (1, 0)])
def test_shards_equal_the_plain_rounds(spark, rounds, hot):
    rows = table(hot=hot)
    got = sharding.shard(frame(spark, rows), rounds=rounds).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 8, rounds)


def cut_links(rows, placed):
    where = defaultdict(Counter)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for i, _, _, s, _ in placed:
        where[texts[i][0]][s] += 1
    return sum((sum(c.values()) ** 2 - sum(n * n for n in c.values())) // 2 for c in where.values())


def test_rounds_cut_fewer_links_and_quotas_keep_the_balance(spark):
    rows = [r for r in table(hot=600) if r[0] is not None and r[0] > 7]
    by_rounds = [cut_links(rows, sharding.shard(frame(spark, rows), rounds=n).collect()) for n in (0, 1, 4)]
    assert by_rounds[0] > by_rounds[1] > by_rounds[2]

    def spread(placed):
        load = Counter()
        for r in placed:
            load[r["shard"]] += r["size"]
        return max(load.values()) / (sum(load.values()) / 8)

    assert spread(sharding.shard(frame(spark, rows)).collect()) < 1.05
    assert spread(sharding.shard(frame(spark, rows), bounded=False).collect()) > 1.5


def test_one_document_larger_than_a_shard(spark):
    rows = [(1, "x" * 50_000), (2, "y" * 50_000), (3, "y" * 50_000), *((k, f"small {k}") for k in range(4, 60))]
    assert sorted((tuple(r) for r in sharding.shard(frame(spark, rows)).collect()), key=repr) == brute(rows, 8)


def test_documents_that_are_all_linked_are_levelled(spark):
    rows = [(i, f"text number {i // 3} " * 20) for i in range(900)]
    got = sharding.shard(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 8)


@pytest.mark.parametrize("linked", [0.5, 0.9, 1.0])
@pytest.mark.parametrize("several", [2, 3, 7])
def test_few_groups_are_cut_however_many_documents_are_linked(spark, linked, several):
    n = 400 * several
    rows = [(i, f"text number {i // several} " * 20 if i < n * linked else f"one of its kind {i} " * 15) for i in range(n)]
    placed = [tuple(r) for r in sharding.shard(frame(spark, rows)).collect()]
    where, load = defaultdict(set), Counter()
    for i, size, _, s, _ in placed:
        load[s] += size
        if i < n * linked:
            where[i // several].add(s)
    assert sum(len(s) > 1 for s in where.values()) < 0.1 * len(where)
    assert max(load.values()) - min(load[s] for s in range(8)) <= 2 * max(r[1] for r in placed)


def test_quotas_are_even_where_shards_are_full():
    wants = [[0, 10, 0], [4, 0, 6], [0, 2, 0]]
    assert sharding.quotas(wants, [0, 0, 0]) == [[0, 4, 0], [4, 0, 2], [0, 2, 0]]
    assert sharding.quotas(wants, [100, 100, 100]) == wants
    some = sharding.quotas(wants, [0, 3, 0])
    assert sum(r[1] for r in some) - sum(some[1]) <= 3 + 1e-6 and some[0][1] > 4


def test_level_of_loads():
    assert sharding.edges([0, 0], 10) == [5, 10] and sharding.edges([8, 0], 4) == [0, 4] and sharding.edges([3, 1, 2], 3) == [0, 2, 3]
