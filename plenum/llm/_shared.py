"""What the operators share: the shared folder, written tables, and skew-safe lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.operators.running import cumulate, lasting, scratch, shared_dir, stash  # noqa: F401

#: ASCII white space, and its complement, as the contracts of the operators use it.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def named(column: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_or_empty(column: str) -> Column:
    return F.coalesce(named(column).cast("string"), F.lit(""))


def few_broadcast(rows: DataFrame, most: int) -> DataFrame:
    """A written table, to be sent to every executor if it has at most `most` rows; beyond that joins shuffle."""
    return F.broadcast(rows) if rows.count() <= most else rows


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """(row, *more): a row's columns as one struct, so that names of our own can't clash with theirs."""
    return docs.select(F.struct(*[named(c).alias(c) for c in docs.columns]).alias("row"), *more)


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` out of packed rows."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def least_row() -> Column:
    """Of equal keys the least packed row, by its serialised form (which maps have too)."""
    return F.min_by("row", F.to_json("row")).alias("row")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for texts without any."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(*columns: Column) -> Column:
    """A repeatable number in [0, 1) from the given columns, the same in Spark and in SQL engines with md5."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
