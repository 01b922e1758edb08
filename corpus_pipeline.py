"""A corpus from raw documents: civil, without copies or near copies, mixed to weights, and tokenised.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. `run`
writes what each returns and reads it again as the next one's documents, all in the shared folder.

Defined cases (each stage but the last returns the columns of its documents, whatever their names and types)
- empty tables: empty results. Null and empty texts: civil; equal to each other, so one of them is left; linked
  with nothing; of size 0, taken as often as the mix takes them; no pieces.
- repeated rows and repeated ids: of rows that are equal in text one is left, the one with the smallest id (of its
  repeats the least row); rows that share an id but not the text are documents of their own. Null ids come last.
- very long texts: a task holds one small batch of them.
- no labels of one kind: nothing is toxic, unless all labels are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plenum.llm._shared import stash
from plenum.llm.exact_dedup import drop_exact_copies
from plenum.llm.mixing import mix
from plenum.llm.near_dedup import drop_near_copies
from plenum.llm.sentence_pieces import piece_digests
from plenum.llm.toxicity import keep_civil, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learnt from the labelled training rows among them."""
    return keep_civil(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity of 0.8 or more) the row with the smallest id."""
    return drop_near_copies(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mix(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's encoding, as digests."""
    return piece_digests(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentence_pieces", sentence_pieces),
]

#: Learnt scores, MinHash bands and the tokenizer can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
