"""Exact deduplication by progressive refinement.

Texts are equal when they are identical after every run of ASCII white space is replaced by one space;
a null text counts as empty. Candidates are narrowed three times: rows are grouped by the length of the
normalised text, the groups that hold more than one row by a hash of its first characters, and only the
rows of groups that still hold more than one have their whole text hashed (SHA-256) and compared.
`exact_groups_with_digests` is asked for every row's digest, so there the hash is made in the scan and only compared less.

Defined cases
- empty table: empty result. Empty and null texts: equal to each other.
- ties: of equal texts the smallest id stays; null ids come last, so a null id stays only if all are null.
- repeated rows (same id, equal text): each counts in `group_size`; all carry the id that stays and are
  marked kept in `exact_groups`; `drop_exact_copies` lets one row through. Rows that share an id, or have
  none, but not the text are documents of their own: there is one row out for each row in.
- extra columns, whatever their names, are ignored by `exact_groups` and returned by `drop_exact_copies`.
- very long texts: only hashes leave a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import BLANKS, few_broadcast, least_row, named, packed, stash, text_or_empty, unpacked

#: Groups (16 bytes each) that may be sent to every executor; beyond that the lookup is a shuffled join.
BROADCAST_GROUPS = 500_000


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def text_digest(text: str = "text") -> Column:
    """Lowercase hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text).cast("binary"), 256)


def _outline(docs: DataFrame, id_col: str, text: str, prefix: int, *more: Column) -> DataFrame:
    """(id, len, head, *more) of each row; `more` may use the normalised text, `norm`."""
    slim = docs.select(named(id_col).alias("id"), normalised(text).alias("norm"))
    return slim.select("id", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, prefix)).alias("head"), *more)


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest")


def _candidates(outline: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """((l, h) of the groups by length and head that hold more than one row, whether they are at most `most`)."""
    lengths = stash(outline.groupBy("len").count().where("count > 1").select(F.col("len").alias("l")), "dedup-lengths")
    # A head that occurs twice at a length tells that the length does, so beyond the bound that step may be left out.
    few = lengths.count() <= most
    alike = outline.join(F.broadcast(lengths), F.col("len") == F.col("l"), "left_semi") if few else outline
    groups = alike.groupBy("len", "head").count().where("count > 1").select(F.col("len").alias("l"), F.col("head").alias("h"))
    groups = stash(groups, "dedup-groups")
    return groups, groups.count() <= most


def _same_group() -> Column:
    return (F.col("len") == F.col("l")) & (F.col("head") == F.col("h"))


def _narrowed(docs: DataFrame, id_col: str, text: str, prefix: int, most: int) -> tuple[DataFrame, DataFrame, bool]:
    """(outline, groups that hold more than one row, whether they are few)."""
    outline = stash(_outline(docs, id_col, text, prefix), "dedup-outline")
    return outline, *_candidates(outline, most)


def _full_hashes(docs: DataFrame, id_col: str, text: str, prefix: int, narrowed: tuple[DataFrame, DataFrame, bool]) -> tuple[DataFrame, DataFrame]:
    """((id) of rows ruled out before their content was compared, (id, digest) of the rows left)."""
    outline, groups, few = narrowed
    apart = outline.join(groups, _same_group(), "left_anti").select("id")
    if few:
        rows = _outline(docs, id_col, text, prefix, "norm")
        left = rows.join(F.broadcast(groups), _same_group(), "left_semi").select("id", _digest())
    else:  # hash in the scan and shuffle the hashes, never the texts
        left = _outline(docs, id_col, text, prefix, _digest()).join(groups, _same_group(), "left_semi").select("id", "digest")
    return apart, stash(left, "dedup-digests")


def _copies(left: DataFrame) -> DataFrame:
    """Rows left (id, digest), with the id that stays and the size of their group."""
    groups = left.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Hashed anew on both sides, so that a join that meets a huge group can be split at run time.
    groups = groups.select(F.xxhash64("digest").alias("k"), F.col("digest").alias("d"), "keep_id", "group_size")
    keyed = left.withColumn("hk", F.xxhash64("digest"))
    return keyed.join(groups, (F.col("hk") == F.col("k")) & (F.col("digest") == F.col("d"))).select("id", "digest", "keep_id", "group_size")


def _grouped(apart: DataFrame, left: DataFrame, *more: str) -> DataFrame:
    alone = apart.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *more)
    found = _copies(left).select("id", "keep_id", "group_size", *more).unionByName(alone)
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: int = 64, most: int = BROADCAST_GROUPS) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size (long), kept."""
    found = _grouped(*_full_hashes(docs, id_col, text, prefix, _narrowed(docs, id_col, text, prefix, most)))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept")


def exact_groups_with_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: int = 64, most: int = BROADCAST_GROUPS) -> DataFrame:
    """`exact_groups` with text_sha256 of every row: the digests come from the one scan, and only those of rows left are compared."""
    outline = stash(_outline(docs, id_col, text, prefix, _digest()), "dedup-outline")
    groups, few = _candidates(outline, most)
    placed = outline.join(F.broadcast(groups) if few else groups, _same_group(), "left")
    placed = stash(placed.select("id", "digest", F.col("l").isNotNull().alias("left")), "dedup-digests")
    made = _grouped(placed.where(~F.col("left")), placed.where("left").select("id", "digest"), "digest")
    return made.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _packed_with_digests(docs: DataFrame, id_col: str, text: str, prefix: int, narrowed: tuple[DataFrame, DataFrame, bool]) -> DataFrame:
    """(row, id, digest): only rows of groups that hold others have their whole text hashed, while such groups are few enough to be
    sent out; beyond that every row is hashed in the scan, so that hashes are shuffled and texts are not."""
    _, groups, few = narrowed
    if not few:
        return packed(docs, named(id_col).alias("id"), F.unhex(text_digest(text)).alias("digest"))
    rows = packed(docs, named(id_col).alias("id"), normalised(text).alias("norm"))
    rows = rows.select("row", "id", "norm", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, prefix)).alias("head"))
    told = rows.join(F.broadcast(groups), _same_group(), "left")
    return told.select("row", "id", F.when(F.col("l").isNotNull(), F.unhex(F.sha2(F.col("norm").cast("binary"), 256))).alias("digest"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: int = 64, most: int = BROADCAST_GROUPS) -> DataFrame:
    """The input's columns, one row for each group of equal texts (the smallest id's; of its repeats, the least row)."""
    narrowed = _narrowed(docs, id_col, text, prefix, most)
    _, left = _full_hashes(docs, id_col, text, prefix, narrowed)
    copies = stash(_copies(left).where("group_size > 1"), "dedup-copies")
    ids = copies.groupBy("id", "digest", "keep_id").agg(F.count(F.lit(1)).alias("n"))
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    loses = ids.where(~stays).select(F.col("id").alias("i"), F.col("digest").alias("d"))
    again = ids.where(stays & (F.col("n") > 1)).select(F.col("id").alias("i"), F.col("digest").alias("d"))
    loses = few_broadcast(stash(loses, "dedup-loses"), most)
    rows = _packed_with_digests(docs, id_col, text, prefix, narrowed)
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d"))
    rest = rows.join(loses, same, "left_anti")
    if again.isEmpty():
        return unpacked(rest, docs)
    twice = rest.join(again, same, "left_semi").groupBy("digest").agg(least_row())
    return unpacked(rest.join(again, same, "left_anti").select("row").unionByName(twice.select("row")), docs)


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups_with_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
