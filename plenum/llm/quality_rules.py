"""Quality rules with a verdict on hosts.

Each document is measured by expressions alone, so no text leaves its task. Each host's documents that
fail a rule are counted; the rates are shrunk towards the hosts' common rate with a beta prior whose
two parameters are estimated from the hosts themselves (method of moments); and the verdict on a host
is joined back to its documents: a host is refused when the shrunk rate of a rule is above `refuse`.

Only DataFrame operations are used. Defined cases
- null and empty texts: no words, so they fail the length rule.
- a null host is a host of its own. Hosts are summed before the shuffle, so one host may hold any share.
- empty table: empty result. Repeated rows count each. Extra columns are ignored.
- fewer than two hosts, or hosts that all agree: the prior is the common rate with weight `prior_docs`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.llm._shared import BLANKS, named, stash, text_or_empty

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
REFUSE = 0.6
PRIOR_DOCS = 20.0
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """`keep` and the measures of each whole text (longs)."""
    rows = docs.select(*keep, text_or_empty(text).alias("__text"))
    rows = rows.withColumn("__words", F.filter(F.split("__text", BLANKS), lambda w: w != ""))
    # A window is known by the hash of its three words; windows are sorted with their places, so equal
    # ones are neighbours.
    windows = F.transform(
        F.sequence(F.lit(1), F.size("__words") - 2),
        lambda i: F.struct(F.xxhash64(F.element_at("__words", i), F.element_at("__words", i + 1), F.element_at("__words", i + 2)).alias("h"), i.alias("i")),
    )
    rows = rows.withColumn("__sorted", F.when(F.size("__words") > 3, F.sort_array(windows)))
    twice = F.filter("__sorted", lambda x, k: F.coalesce((k > 0) & (F.get("__sorted", k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get("__sorted", k + 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("__twice", twice)
    covered = F.array_distinct(F.flatten(F.transform("__twice", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("__lines", lines)
    return rows.select(
        *[F.col(c) for c in rows.columns if not c.startswith("__")],
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__twice").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"),
    )


def rules() -> dict[str, Column]:
    return {
        "short": F.col("n_words") < LEAST_WORDS,
        "repetitive": F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED,
    }


def host_verdicts(rows: DataFrame, host: str, failed: dict[str, Column], refuse: float = REFUSE, prior_docs: float = PRIOR_DOCS) -> DataFrame:
    """host, documents, rate_<rule> (shrunk), refused: one row per host."""
    counts = rows.groupBy(host).agg(F.count(F.lit(1)).alias("documents"), *[F.sum(c.cast("long")).alias(f"n_{r}") for r, c in failed.items()])
    counts = stash(counts, "host-counts")
    sums = [F.avg(1 / F.col("documents")).alias("inverse")]
    for r in failed:
        rate = F.col(f"n_{r}") / F.col("documents")
        sums += [(F.sum(f"n_{r}") / F.sum("documents")).alias(f"m_{r}"), F.var_samp(rate).alias(f"v_{r}")]
    prior = counts.agg(*sums).first()  # one row of a few numbers
    known = lambda name: F.lit(prior[name]).cast("double")
    shown = {}
    for r in failed:
        mean, spread = known(f"m_{r}"), known(f"v_{r}")
        # Between-host variance: what is left of the observed one after binomial noise.
        between = spread - mean * (1 - mean) * known("inverse")
        weight = F.when((between > 0) & (mean > 0) & (mean < 1), F.greatest(F.lit(1.0), mean * (1 - mean) / between - 1)).otherwise(F.lit(prior_docs))
        shown[r] = (F.col(f"n_{r}") + mean * weight) / (F.col("documents") + weight)
    refused = F.lit(False)
    for x in shown.values():
        refused = refused | (x > refuse)
    return counts.select(host, "documents", *[x.alias(f"rate_{r}") for r, x in shown.items()], refused.alias("refused"))


def quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", refuse: float = REFUSE) -> DataFrame:
    """id_col, the measures, base_failed, kept: one row per document."""
    rows = stash(measured(docs, [named(id_col).alias("id"), named(host).cast("string").alias("host")], text), "quality-measures")
    failed = rules()
    hosts = stash(host_verdicts(rows, "host", failed, refuse).select(F.col("host").alias("h"), "refused"), "host-verdicts")
    any_failed = F.lit(False)
    for c in failed.values():
        any_failed = any_failed | c
    judged = rows.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left").withColumn("base_failed", any_failed)
    return judged.select(F.col("id").alias(id_col), *MEASURES, "base_failed", (~F.col("base_failed") & ~F.coalesce("refused", F.lit(False))).alias("kept"))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, d.host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered c USING (doc_id)
), f AS (
  SELECT *, n_words < 50 AS a, 100 * n_repeat_words > 50 * n_words AS b FROM m
), h AS (
  SELECT host, count(*) AS docs, sum(a::INT) AS na, sum(b::INT) AS nb FROM f GROUP BY host
), p AS (
  SELECT sum(na) / sum(docs) AS ma, var_samp(na / docs) AS va, sum(nb) / sum(docs) AS mb, var_samp(nb / docs) AS vb, avg(1 / docs) AS inv FROM h
), k AS (
  SELECT *, CASE WHEN va - ma * (1 - ma) * inv > 0 AND ma > 0 AND ma < 1 THEN greatest(1.0, ma * (1 - ma) / (va - ma * (1 - ma) * inv) - 1) ELSE 20.0 END AS wa,
            CASE WHEN vb - mb * (1 - mb) * inv > 0 AND mb > 0 AND mb < 1 THEN greatest(1.0, mb * (1 - mb) / (vb - mb * (1 - mb) * inv) - 1) ELSE 20.0 END AS wb
  FROM p
), v AS (
  SELECT host, (na + ma * wa) / (docs + wa) > 0.6 OR (nb + mb * wb) / (docs + wb) > 0.6 AS refused FROM h CROSS JOIN k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a OR b AS base_failed, NOT (a OR b) AND NOT refused AS kept
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""
