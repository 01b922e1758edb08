"""Sharding by balanced label propagation, law `bytes`: the shards' sizes are near equal.

Documents with equal texts are linked. Linked documents start in a shard chosen by a hash; then, in rounds,
each moves towards the shard that holds most of its neighbours' bytes, under quotas for every pair of shards: what
may go from one to another is what wants to come back, so that swaps keep sizes even, and beyond that what keeps
the goal within its capacity, an equal share of all bytes and SLACK more. A shard that can neither take nor swap any more
is no goal, so what it can't take gathers in the next one, and a group larger than a shard ends in as few shards as
hold it. A group's neighbours are counted through its bytes per shard, so no pairs of documents are made. The label that a
linked document has after the last round is its shard; documents without a link only level the sizes: they are laid
in a line that is cut where the shards' free room ends. What a shard then holds beyond its share joins that line too, group
by group, so that only a group on which a cut falls is parted.

Only DataFrame operations are used. Defined cases
- null text: no bytes, so size 1, and the checksum of the empty text; null and empty texts are linked.
- ties between shards are settled by a hash of group and shard; equal rows are ordered by id, nulls last.
- rows that repeat an id are separate documents. Empty table: empty result. Extra columns are ignored.
- a document larger than a shard's share stays where it starts if linked, else it fills a shard alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import cumulate, named, stash, text_or_empty

SHARDS = 8
ROUNDS = 4
#: A shard that can take less than this part of its share is no goal.
FULL = 0.05
#: How far a shard may grow beyond its share while labels spread, as a part of the share.
SLACK = 0.1


def _loads(rows: DataFrame, shards: int) -> list[int]:
    """Bytes in each shard; one row per shard comes to the driver."""
    found = {r["shard"]: r["b"] for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _per_shard(values: Sequence, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def _moves(held: DataFrame, open_: Sequence[bool]) -> DataFrame:
    """(g, s, goal, bytes): members of a group in shard s move to the goal, the open shard that holds most of the group."""
    best = held.groupBy("group").agg(F.max(F.when(_per_shard(open_, F.col("shard")), F.col("rank"))).alias("best"))
    both = held.join(best.select(F.col("group").alias("g"), "best"), F.col("group") == F.col("g"))
    found = both.where(F.col("best") > F.col("rank")).select("g", F.col("shard").alias("s"), F.col("best.shard").alias("goal"), F.col("rank.bytes").alias("bytes"))
    return stash(found, "shard-moves")


def _wants(moves: DataFrame, shards: int) -> list[list[int]]:
    """Bytes that want to go from each shard to each; one row per pair of shards comes to the driver."""
    out = [[0] * shards for _ in range(shards)]
    for r in moves.groupBy("s", "goal").agg(F.sum("bytes").alias("b")).collect():
        out[r["s"]][r["goal"]] = r["b"]
    return out


def quotas(wants: Sequence[Sequence[float]], room: Sequence[float]) -> list[list[float]]:
    """Bytes that may go from each shard to each: as much as comes back, and more as far as the goals' room allows."""
    shards = range(len(room))
    even = [[float(min(wants[a][b], wants[b][a])) for b in shards] for a in shards]
    extra = [[wants[a][b] - even[a][b] for b in shards] for a in shards]
    for _ in range(100):
        settled = True
        for b in shards:
            comes = sum(extra[a][b] for a in shards)
            allowed = max(0.0, room[b] + sum(extra[b]))
            if comes > allowed * (1 + 1e-9) + 1e-6:
                settled = False
                for a in shards:
                    extra[a][b] *= allowed / comes
        if settled:
            break
    return [[even[a][b] + extra[a][b] for b in shards] for a in shards]


def propagate(linked: DataFrame, shards: int, share: float, rounds: int = ROUNDS, bounded: bool = True) -> DataFrame:
    """`linked` (id, group, size, crc, shard) with the labels after the rounds; `bounded` puts the quotas in force."""
    columns = ["id", "group", "size", "crc", "shard"]
    for _ in range(rounds):
        held = linked.groupBy("group", "shard").agg(F.sum("size").alias("bytes"))
        held = stash(held.select("group", "shard", F.struct("bytes", F.xxhash64("group", "shard").alias("h"), "shard").alias("rank"), F.col("bytes").alias("size")), "shard-held")
        moves = _moves(held, [True] * shards)
        wants = _wants(moves, shards)
        allowed = [[float("inf")] * shards for _ in range(shards)]
        if bounded:
            room = [max(0.0, share * (1 + SLACK) - load) for load in _loads(held, shards)]
            open_ = [r + sum(w) > FULL * share for r, w in zip(room, wants, strict=True)]
            if not all(open_):
                moves = _moves(held, open_)
                wants = _wants(moves, shards)
            allowed = quotas(wants, room)
        if not any(w and q for row, most in zip(wants, allowed, strict=True) for w, q in zip(row, most, strict=True)):
            break
        # Groups are hashed anew on both sides, so that a join that meets a huge group can be split at run time.
        same = (F.xxhash64("group", "shard") == F.xxhash64("g", "s")) & (F.col("group") == F.col("g")) & (F.col("shard") == F.col("s"))
        aims = linked.join(moves.drop("bytes"), same, "left").select(*columns, "goal")
        order = [F.col("group"), F.col("id").asc_nulls_last(), F.col("size")]
        asked = cumulate(aims.where("goal IS NOT NULL"), [F.col("shard"), F.col("goal")], order, {"bytes": F.col("size")}, "shard-asked")
        quota = _per_shard([q for row in allowed for q in row], F.col("shard") * shards + F.col("goal"))
        went = asked.select("id", "group", "size", "crc", F.when(F.col("bytes_before") + F.col("size") <= quota, F.col("goal")).otherwise(F.col("shard")).alias("shard"))
        linked = stash(aims.where("goal IS NULL").select(*columns).unionByName(went), "shard-labels")
    return linked


def edges(loads: Sequence[float], extra: float) -> list[float]:
    """Where a line of `extra` bytes is cut so that, laid on top of the loads, it fills the lowest shards to one level."""
    lowest, level, width = sorted(loads), 0.0, 0
    for width in range(1, len(loads) + 1):
        level = (extra + sum(lowest[:width])) / width
        if width == len(loads) or level <= lowest[width]:
            break
    out, at = [], 0.0
    for load in loads:
        at += max(0.0, level - load)
        out.append(at)
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS, bounded: bool = True) -> DataFrame:
    """id_col, size, text_crc32, shard, slot: one row per document; slots count from 0 within each shard."""
    body = text_or_empty(text)
    rows = stash(
        docs.select(named(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("group")),
        "shard-rows",
    )
    groups = stash(rows.groupBy("group").count().where("count > 1").select(F.col("group").alias("g")), "shard-groups")
    same = (F.xxhash64("group") == F.xxhash64("g")) & (F.col("group") == F.col("g"))
    start = F.pmod(F.xxhash64("id", "group"), F.lit(shards)).cast("int").alias("shard")
    linked = stash(rows.join(groups, same, "left_semi").select("id", "group", "size", "crc", start), "shard-labels")
    alone = rows.join(groups, same, "left_anti").select("id", "group", "size", "crc")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"]
    share = total / shards
    linked = propagate(linked, shards, share, rounds, bounded)
    loads = _loads(linked, shards)
    if bounded and max(loads) > share:
        # What a shard has held beyond its share from the start goes into the line, the last groups first.
        held = cumulate(linked, [F.col("shard")], [F.col("group"), F.col("id").asc_nulls_last(), F.col("size")], {"bytes": F.col("size")}, "shard-held")
        held = stash(held.select("id", "group", "size", "crc", "shard", (F.col("bytes_before") + F.col("size") <= share).alias("stays")), "shard-labels")
        linked = held.where("stays").drop("stays")
        alone = alone.unionByName(held.where(~F.col("stays")).select("id", "group", "size", "crc"))
        loads = _loads(linked, shards)
    line = cumulate(alone, [], [F.col("group"), F.col("id").asc_nulls_last(), F.col("size")], {"bytes": F.col("size")}, "shard-line")
    cuts = F.array(*[F.lit(float(e)) for e in edges(loads, total - sum(loads))[:-1]]) if shards > 1 else F.array().cast("array<double>")
    place = F.size(F.filter(cuts, lambda e: e <= F.col("bytes_before") + F.col("size") / 2))
    labels = linked.unionByName(line.select("id", "group", "size", "crc", place.cast("int").alias("shard")))
    placed = cumulate(labels, [F.col("shard")], [F.col("group"), F.col("id").asc_nulls_last(), F.col("size")], {"slot": F.lit(1)}, "shard-slots")
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot_before").cast("long").alias("slot"))


def op8_shard(spark, sf_dir: str) -> DataFrame:
    placed = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
