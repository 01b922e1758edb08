"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources, in code-point order with null last, weigh 5, 2, 1,
repeating. Each source's target is its share of all words by weight, at most `most` times its own words;
what a source cannot take is shared again by weight among the others until none is above its limit.
Within a source every document expects target / size copies. The expected copies are summed along the
source, from the largest document to the smallest; one random offset per source is added, and a document
is taken once for each whole number that its stretch of the sum crosses. The order by size makes each
run of neighbours alike, so the words taken stay near the target. The running sums come from the shared
distributed running total, so no source ever meets in one task.

Defined cases
- null texts have size 0; a source without words has target 0 and its documents are not taken.
- a null source is a source of its own, last in order. Empty table: empty result.
- ties in size are ordered by id; rows that repeat an id are separate documents.
- extra columns, whatever their names and types, are ignored by `mix_counts` and returned by `mix`.
- the same rows give the same mix, in whatever order or partitioning they come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plenum.llm._shared import count_words, cumulate, few_broadcast, least_row, named, packed, stash, text_or_empty, uniform, unpacked

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
AT_ONCE = 1_000
#: Rows (some 75 bytes each once sent) of copies to take that may be sent to every executor, so that texts stay where they are.
BROADCAST_ROWS = 500_000


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, weight, target: one row for each source of (source, size) rows.

    Only this table, one row per source, is ordered as a whole. A source is full when the common level
    (words per unit of weight) reaches limit / weight, so the sources fill in that order and the level
    that uses up all words follows from running sums.
    """
    table = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choice = F.array(*[F.lit(w) for w in weights])
    table = table.withColumn("weight", F.element_at(choice, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    table = table.withColumn("limit", F.col("source_size") * most)
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    used = F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    total, heft = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    # The level if the sources before this one are full and this one is not.
    table = table.withColumn("level", (total - full) / (heft - used))
    table = table.withColumn("open", F.col("level") * F.col("weight") <= F.col("limit"))
    table = table.withColumn("nth", F.row_number().over(filling))
    level = F.max(F.when(F.col("open"), F.struct((-F.col("nth")).alias("n"), F.col("level").alias("level")))).over(everything)["level"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return table.select("source", "source_size", "weight", target.alias("target"))


def _copies(rows: DataFrame, ids: list[str], weights: Sequence[int], most: int, seed: str) -> DataFrame:
    """(`ids` columns, source, size) rows with source_size, target, and the number of copies to take."""
    targets = stash(source_targets(rows, weights, most), "mix-targets")
    order = [F.col("size").desc(), *[F.col(c).asc_nulls_last() for c in ids]]
    placed = cumulate(rows, [F.col("source")], order, {"rank": F.lit(1)}, "mix-ranks")
    targets = targets.withColumnRenamed("source", "__source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = uniform(F.lit(seed), F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    crossed = lambda n: F.floor(n * ratio + offset)
    copies = crossed(F.col("rank_before") + 1) - crossed(F.col("rank_before"))
    return joined.select(*ids, "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """id_col, source, size, source_size, target, copies: one row per document."""
    rows = docs.select(named(id_col).alias("id"), named(source).cast("string").alias("source"), count_words(text_or_empty(text)).alias("size"))
    return _copies(stash(rows, "mix-sizes"), ["id"], weights, most, seed).withColumnRenamed("id", id_col)


def _row_hash(docs: DataFrame) -> Column:
    """Hash of all columns; those that hold maps, which have no hash, by their serialised form."""
    holds_map = lambda f: "map<" in f.dataType.simpleString()
    return F.xxhash64(*[F.to_json(F.struct(named(f.name).alias("c"))) if holds_map(f) else named(f.name) for f in docs.schema])


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED, broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """The input's columns, each row as often as the mix takes it."""
    slim = docs.select(named(id_col).alias("id"), _row_hash(docs).alias("h"), named(source).cast("string").alias("source"), count_words(text_or_empty(text)).alias("size"))
    counts = _copies(stash(slim, "mix-sizes"), ["id", "h"], weights, most, seed)
    # Rows alike in all columns share one entry with the copies of all of them.
    shares = counts.groupBy(F.col("id").alias("i"), F.col("h").alias("h")).agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("m"))
    shares = few_broadcast(stash(shares.where("n > 0"), "mix-shares"), broadcast)
    rows = packed(docs, named(id_col).alias("id"), _row_hash(docs).alias("key"))
    joined = rows.join(shares, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("h")))
    times = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy")
    single = joined.where("m = 1").select("row", times(F.col("n"))).select("row")
    alike = joined.where("m > 1").groupBy("id", "key").agg(least_row(), F.first("n").alias("n"))
    # What stands for very many rows is dealt out in runs of AT_ONCE copies before they are made.
    runs = alike.select("row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(AT_ONCE).cast("long"))).alias("from")).repartition("from", "n")
    many = runs.select("row", times(F.least(F.col("n") - F.col("from"), F.lit(AT_ONCE)))).select("row")
    return unpacked(single.unionByName(many), docs)


def op4_mix(spark, sf_dir: str) -> DataFrame:
    counts = mix_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counts.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), fill AS (
  SELECT 0 AS step, source, source_size, weight, false AS at_limit FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight,
         at_limit OR weight * (sum(CASE WHEN at_limit THEN -2 * source_size ELSE source_size END) OVER ())
                     > 3 * source_size * (sum(CASE WHEN at_limit THEN 0 ELSE weight END) OVER ())
  FROM fill WHERE step < (SELECT count(*) FROM s)
), last AS (
  SELECT * FROM fill WHERE step = (SELECT count(*) FROM s)
), t AS (
  SELECT source, source_size,
         CASE WHEN at_limit THEN 3.0::DOUBLE * source_size
              ELSE weight * (CAST(sum(CASE WHEN at_limit THEN -2 * source_size ELSE source_size END) OVER () AS DOUBLE)
                             / CAST(sum(CASE WHEN at_limit THEN 0 ELSE weight END) OVER () AS DOUBLE)) END AS target
  FROM last
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS ratio,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS LAST) - 1 AS n,
         CAST(CAST('0x' || substr(md5('mix-1|' || coalesce('=' || d.source, '-')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor((n + 1) * ratio + u) - floor(n * ratio + u) AS BIGINT) * size AS taken
FROM r
"""
