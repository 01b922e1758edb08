"""Near-duplicate groups by MinHash with sequential Bayesian verification.

A document's set holds the hashes of its distinct word shingles. Documents with the same set share one
entry, and what follows works on entries. Entries whose signatures agree in all rows of a band are
candidates. A candidate pair is compared a batch of signature places at a time; as soon as the posterior
probability that its similarity reaches the threshold falls below `miss`, it is dropped; what survives
all batches is compared on the full sets. Verified links form components.

No bucket is ever gathered or paired off in full:
1. star round: every member of a bucket is compared with the bucket's smallest entry only. That makes one
   candidate per member and turns groups of near copies into components;
2. cross rounds: in buckets that still hold more than one component, the members are cut into blocks and
   each pair of blocks is a unit of work of bounded size. A first pass over the signatures tells which
   members have a plausible partner in another component; a second one, over those members only, checks
   plausible pairs on the full sets, skips pairs that a link found on the way has joined, and passes on
   the links that join components, fewer than the unit has members. Pairs that an earlier band or the
   star round has compared are left out. So no pair of different components goes unseen, no link is lost
   but by the banding and `miss`, and the rows passed on grow with the members, not with their pairs.
With 32 bands of 5 rows, a pair of similarity 0.85 shares no band with probability 4e-7 (0.8: 3e-6).

Defined cases
- null and empty texts, and texts without words: empty set, linked with nothing, alone in their component.
- fewer words than the shingle's width: the whole sequence is the one shingle.
- ties: the smallest id represents a component; null ids come last. Repeated rows have equal sets; all
  carry the component's id, and `drop_near_copies` lets one row through.
- empty table: empty result. Extra columns, whatever their names, are ignored or passed on.
- very long texts: a task holds one batch's sets; sets of documents without candidates never leave it.
"""

from __future__ import annotations

import hashlib
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import few_broadcast, lasting, least_row, named, packed, scratch, stash, text_or_empty, unpacked
from plenum.llm.components import components
from plenum.llm.shingles import shingle_set

WIDTH, BANDS, ROWS, BATCH = 5, 32, 5, 32
PLACES = BANDS * ROWS
MISS = 1e-6
BLOCK = 512
#: Documents (24 bytes each) whose texts are fetched by a broadcast lookup; beyond that by a shuffled join.
BROADCAST_DOCS = 500_000

_ODD = np.random.default_rng(20_240_607)
_A = (_ODD.integers(0, 2**32, PLACES, dtype=np.uint64) | 1).astype(np.uint32)
_B = _ODD.integers(0, 2**32, PLACES, dtype=np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray) -> bytes:
    """MinHash: the least value of each place's hash function over the set."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)[:, None]
    best = np.full(PLACES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 256):
        part = low[at : at + 256] * _A
        part += _B
        np.minimum(best, part.min(axis=0), out=best)
    return best.astype("<u4").tobytes()


def least_matches(threshold: float, miss: float, batch: int = BATCH, places: int = PLACES) -> np.ndarray:
    """For each number of places compared: the least matches with which a pair may still reach `threshold`.

    The similarity's posterior after m matches in n places is Beta(1 + m, 1 + n - m).
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(batch, places + 1, batch):
        need = n
        for m in range(n, -1, -1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            if np.exp(log)[grid >= threshold].sum() / 20_000 < miss:
                break
            need = m
        out.append(need)
    return np.array(out)


def plausible(a: np.ndarray, b: np.ndarray, need: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """Which rows of two arrays of signatures stay plausible through all batches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for k, least in enumerate(need):
        part = slice(k * batch, (k + 1) * batch)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        stay = matches >= least
        alive, matches = alive[stay], matches[stay]
    return alive


def _signatures(column) -> np.ndarray:
    data = b"".join(column)
    return np.frombuffer(data, "<u4").reshape(-1, PLACES)


def sketches(docs: DataFrame, id_col: str, text: str, width: int = WIDTH) -> DataFrame:
    """(id, th, n, key, sig): hash of the text, size of the set, digest of the set, signature."""
    body = text_or_empty(text)
    slim = docs.select(named(id_col).alias("id"), F.xxhash64(body).alias("th"), body.cast("binary").alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            counts, keys, sigs = [], [], []
            for item in batch.column(2):
                s = shingle_set(item.as_py(), width)
                counts.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sigs.append(signature(s) if len(s) else b"")
            arrays = [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "th", "n", "key", "sig"])

    return slim.mapInArrow(run, f"id {kind}, th long, n long, key binary, sig binary")


def _buckets(entries: DataFrame) -> DataFrame:
    """(band, nth, key): the buckets of each entry, and which band each belongs to."""
    step = ROWS * 4
    of = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(F.xxhash64(i, F.substring("sig", i * step + 1, F.lit(step))).alias("band"), i.alias("nth")))
    return entries.select(F.explode(of).alias("x"), "key").select("x.band", "x.nth", "key")


def _pruned(pairs: DataFrame, entries: DataFrame, need: np.ndarray) -> DataFrame:
    """Candidate pairs (a, b) that stay plausible."""
    left = entries.select(F.col("key").alias("ka"), F.col("sig").alias("sa"))
    right = entries.select(F.col("key").alias("kb"), F.col("sig").alias("sb"))
    both = pairs.join(right, F.col("b") == F.col("kb")).join(left, F.col("a") == F.col("ka")).select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                alive = plausible(_signatures(batch.column(2).to_pylist()), _signatures(batch.column(3).to_pylist()), need)
                yield batch.take(pa.array(alive)).select(["a", "b"])

    return both.mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets overlap enough: 100 * common >= percent * union."""
    left = sets.select(F.col("key").alias("ka"), F.col("items").alias("ia"))
    right = sets.select(F.col("key").alias("kb"), F.col("items").alias("ib"))
    both = pairs.join(right, F.col("b") == F.col("kb")).join(left, F.col("a") == F.col("ka")).select("a", "b", "ia", "ib")

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select(["a", "b"])

    return both.mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, entries: DataFrame, keys: DataFrame, id_col: str, text: str, width: int, tag: str) -> DataFrame:
    """(key, items): the full sets of the entries in `keys` (column k), made anew from one document of each."""
    wanted = stash(entries.join(keys, F.col("key") == F.col("k"), "left_semi").select("row.th", "row.id"), tag)
    body = text_or_empty(text)
    rows = docs.select(named(id_col).alias("__i"), F.xxhash64(body).alias("__t"), body.cast("binary").alias("text"))
    if wanted.count() <= BROADCAST_DOCS:
        wanted = F.broadcast(wanted)
    found = rows.join(wanted, (F.col("__t") == F.col("th")) & F.col("__i").eqNullSafe(F.col("id"))).select("text")

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(0)]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["key", "items"])

    made = found.mapInArrow(run, "key binary, items binary")
    # Repeated rows were all fetched; one of each is enough.
    return stash(made.groupBy("key").agg(F.first("items").alias("items")), tag + "-sets")


def _units(members: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (band, i, j, own, ...) dealt so that each pair of blocks of a bucket meets in one run of sorted rows.

    `members` has band, key, root; buckets with a single component are left out.
    """
    sizes = members.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("key").alias("pivot"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    sizes = stash(sizes.select(F.col("band").alias("mb"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "near-mixed")
    left = members.join(sizes, F.col("band") == F.col("mb")).drop("mb")
    own = F.pmod(F.xxhash64("key", "band"), F.col("blocks")).cast("int")
    # A member of block i meets all blocks: units (i, j) with i <= j.
    dealt = left.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns)


def _sorted_units(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "key")


def _runs(batches):
    """Tables of whole units from batches of rows sorted by (band, i, j); a unit has at most two blocks of rows."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        marks = [rows.column(c).to_numpy() for c in ("band", "i", "j")]
        cuts = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
        for start, end in zip(np.append(0, cuts[:-1]) if len(cuts) else [], cuts, strict=True):
            yield rows.slice(int(start), int(end - start))
        rest = rows.slice(int(cuts[-1]) if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield rest


def _open_pairs(unit: pa.Table, sigs: np.ndarray, need: np.ndarray):
    """Plausible pairs (x, y) of rows of a unit that only this unit is to look at, a few rows at a time."""
    i, j, nth = (int(unit.column(c)[0].as_py()) for c in ("i", "j", "nth"))
    _, roots = np.unique(np.array(unit.column("root").to_pylist(), object), return_inverse=True)
    own = unit.column("own").to_numpy()
    first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
    bands = sigs.reshape(len(sigs), BANDS, ROWS)
    step = max(1, 60_000 // max(1, len(second)))
    for at in range(0, len(first), step):
        x, y = (m.ravel() for m in np.meshgrid(first[at : at + step], second, indexing="ij"))
        apart = (roots[x] != roots[y]) & ((x < y) if i == j else True)
        x, y = x[apart], y[apart]
        alive = plausible(sigs[x], sigs[y], need)
        x, y = x[alive], y[alive]
        if nth and len(x):
            fresh = ~(bands[x, :nth] == bands[y, :nth]).all(axis=2).any(axis=1)
            x, y = x[fresh], y[fresh]
        yield x, y


def _partnered(crowded: DataFrame, roots: DataFrame, entries: DataFrame, need: np.ndarray) -> DataFrame:
    """(band, nth, key, root): bucket members with a plausible partner in another component."""
    members = crowded.join(roots, F.col("key") == F.col("node"), "left").select("band", "nth", "key", F.col("pivot"), F.coalesce("root", "key").alias("root"))
    # The star round has compared the pivots with all members of their buckets.
    members = stash(members.where("key <> pivot").drop("pivot"), "near-members")
    dealt = _units(members, ["nth", "key", "root"])
    dealt = dealt.join(entries.select(F.col("key").alias("ek"), "sig"), F.col("key") == F.col("ek")).drop("ek")

    def run(batches):
        for unit in _runs(batches):
            sigs = _signatures(unit.column("sig").to_pylist())
            found = [np.unique(np.concatenate(p)) for p in _open_pairs(unit, sigs, need)]
            rows = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            if len(rows):
                yield from unit.take(pa.array(rows)).select(["band", "nth", "key", "root"]).combine_chunks().to_batches()

    return _sorted_units(dealt).mapInArrow(run, "band long, nth int, key binary, root binary").distinct()


def _joining_links(members: DataFrame, entries: DataFrame, sets: DataFrame, need: np.ndarray, percent: int) -> DataFrame:
    """Links (a, b) between components, checked on full sets, enough to join all that such links join."""
    dealt = _units(members, ["nth", "key", "root"])
    dealt = dealt.join(entries.select(F.col("key").alias("ek"), "sig"), F.col("key") == F.col("ek")).drop("ek")
    dealt = dealt.join(sets.select(F.col("key").alias("sk"), "items"), F.col("key") == F.col("sk")).drop("sk")

    def run(batches):
        for unit in _runs(batches):
            sigs = _signatures(unit.column("sig").to_pylist())
            items = [np.frombuffer(x.as_py(), "<u8") for x in unit.column("items")]
            keys = unit.column("key").to_pylist()
            _, parent = np.unique(np.array(unit.column("root").to_pylist(), object), return_inverse=True)
            of, parent = parent.tolist(), list(range(len(keys)))
            out = []

            def top(c):
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for xs, ys in _open_pairs(unit, sigs, need):
                closest = np.argsort(-(sigs[xs] == sigs[ys]).sum(axis=1), kind="stable")
                for x, y in zip(xs[closest].tolist(), ys[closest].tolist(), strict=True):
                    p, q = top(of[x]), top(of[y])
                    if p == q:
                        continue
                    a, b = items[x], items[y]
                    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                        continue
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        parent[max(p, q)] = min(p, q)
                        out.append(sorted((keys[x], keys[y])))
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return _sorted_units(dealt).mapInArrow(run, "a binary, b binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH, miss: float = MISS) -> DataFrame:
    """(id, th, n, first): each row's id, hash of its text, size of its set, and the smallest id of its component. Tables made on the way are removed."""
    with scratch(docs.sparkSession):
        return lasting(_near_groups(docs, id_col, text, percent, width, miss), "near-groups")


def _near_groups(docs: DataFrame, id_col: str, text: str, percent: int, width: int, miss: float) -> DataFrame:
    need = least_matches(percent / 100, miss)
    rows = stash(sketches(docs, id_col, text, width), "near-sketches")
    some = rows.where("n > 0")
    entries = stash(some.groupBy("key").agg(F.min("id").alias("least"), F.min(F.struct("th", "id")).alias("row"), F.first("sig").alias("sig")), "near-entries")
    buckets = _buckets(entries)
    pivots = buckets.groupBy("band").agg(F.min("key").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    pivots = stash(pivots.select(F.col("band").alias("pb"), "pivot"), "near-pivots")
    crowded = stash(buckets.join(pivots, F.col("band") == F.col("pb")).select("band", "nth", "key", "pivot"), "near-buckets")
    star = stash(_pruned(crowded.where("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct(), entries, need), "near-star")
    ends = star.select(F.col("a").alias("k")).unionByName(star.select(F.col("b").alias("k"))).distinct()
    links = stash(_verified(star, _sets(docs, entries, ends, id_col, text, width, "near-star-docs"), percent), "near-links")
    members = stash(_partnered(crowded, components(links), entries, need), "near-partnered")
    sets = _sets(docs, entries, members.select(F.col("key").alias("k")).distinct(), id_col, text, width, "near-cross-docs")
    links = stash(links.unionByName(_joining_links(members, entries, sets, need, percent)), "near-links")
    roots = stash(components(links), "near-roots")
    placed = entries.join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("least").alias("first")).select(F.col("root").alias("r"), "first")
    named = stash(placed.join(stash(firsts, "near-firsts"), F.col("root") == F.col("r")).select(F.col("key").alias("k"), "first"), "near-named")
    found = some.select("id", "th", "n", "key").join(named, F.col("key") == F.col("k")).select("id", "th", "n", "first")
    return found.unionByName(rows.where("n = 0").select("id", "th", "n", F.col("id").alias("first")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80, width: int = WIDTH, broadcast: int = BROADCAST_DOCS) -> DataFrame:
    """The input's columns, one row of each component (the smallest id's) and all rows with empty sets."""
    groups = near_groups(docs, id_col, text, percent, width)
    sets = groups.where("n > 0")
    # Of a component the row with the smallest (id, hash of the text) stays.
    stays = sets.where(F.col("id").eqNullSafe(F.col("first"))).groupBy("id").agg(F.min("th").alias("t")).withColumnRenamed("id", "i")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))
    loses = sets.join(stash(stays, "near-stays"), same, "left_anti").select(F.col("id").alias("i"), F.col("th").alias("t")).distinct()
    again = sets.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("i", "t")
    again = stash(again, "near-again")
    rows = packed(docs, named(id_col).alias("id"), F.xxhash64(text_or_empty(text)).alias("th"))
    rest = rows.join(few_broadcast(stash(loses, "near-loses"), broadcast), same, "left_anti")
    if again.isEmpty():
        return unpacked(rest, docs)
    twice = rest.join(again, same, "left_semi").groupBy("id", "th").agg(least_row())
    return unpacked(rest.join(again, same, "left_anti").select("row").unionByName(twice.select("row")), docs)


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("first").alias("component_id"), F.col("id").eqNullSafe(F.col("first")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (
  SELECT a, min(b) AS least FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.least, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""
