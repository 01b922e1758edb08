"""Queries that compare documents, runs and truths."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plenum.operators import vote
from plenum.plans.stand_ins import READINGS, readings
from plenum.session import table


def _merged(r):
    return vote.first_by(r, ["case_id"], F.struct("source", "doc_type", "seq"), F.col("value").alias("merged")).withColumnRenamed("case_id", "c")


def letter_disagreement(spark, sf_dir):
    """C14: cases whose type-4 document says something other than the merged value."""
    r = readings(spark, sf_dir)
    letter = vote.first_by(r.where("doc_type = 4"), ["case_id"], F.struct("source", "seq"), F.col("value").alias("letter"))
    return letter.join(_merged(r), F.col("case_id") == F.col("c")).where("letter <> merged").select("case_id", "letter", "merged")


def registry_disagreement(spark, sf_dir):
    """Type-5 documents that disagree, unless another reading of the case agrees with both."""
    r = readings(spark, sf_dir)
    registry = vote.first_by(r.where("doc_type = 5"), ["case_id"], F.struct("source", "seq"), F.col("value").alias("registry"))
    differs = registry.join(_merged(r), F.col("case_id") == F.col("c")).where("registry <> merged")
    veto = r.where("doc_type = 5 AND source = 1").select(F.col("case_id").alias("v"), F.col("value").alias("vv"))
    return differs.join(veto, (F.col("case_id") == F.col("v")) & (F.col("vv") == F.col("merged")), "left_anti").select("case_id", "registry", "merged")


def hidden_truth_join(spark, sf_dir):
    """C20: keys planted in hidden text against the truth."""
    o = table(spark, sf_dir, "orders")
    planted = o.where("o_orderkey % 50 = 6").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("O").alias("claimed"))
    j = planted.join(o.select("o_orderkey", "o_orderstatus"), F.col("k") == F.col("o_orderkey"))
    return j.groupBy("claimed", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def signals_left_truth(spark, sf_dir):
    """Derived signals with labels where there are any; rows without stay."""
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 2000).alias("x_long"))
    t = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("t_id"), F.col("quality").alias("t_quality"), F.col("toxic").alias("t_toxic"))
    return d.join(t, F.col("doc_id") == F.col("t_id"), "left").select("doc_id", "x_long", "t_quality", "t_toxic")


def field_hit_rates(spark, sf_dir):
    """Share of scorable cases that each field gets right."""
    o = table(spark, sf_dir, "orders")
    truth = {"status": F.col("o_orderstatus"), "priority": F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority"))}
    said = {"status": F.when(F.col("o_orderkey") % 7 == 0, "F").otherwise(F.col("o_orderstatus")), "priority": F.when(F.col("o_orderkey") % 5 == 0, "5-LOW").otherwise(F.col("o_orderpriority"))}
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), truth[f].alias("t"), said[f].alias("s")) for f in truth]))
    long = o.select(cells.alias("c")).select("c.*").where("t IS NOT NULL")
    g = long.groupBy("field").agg(F.count(F.lit(1)).alias("scorable"), F.sum((F.col("t") == F.col("s")).cast("long")).alias("hits"))
    return g.select("field", "scorable", "hits", (F.col("hits") / F.col("scorable")).alias("rate"))


def merge_ablation_diff(spark, sf_dir):
    """What trust order carries or harms against plain order, by parity of the id."""
    r = readings(spark, sf_dir)
    truth = r.groupBy("case_id").agg(F.max("value").alias("truth"))
    plain = vote.first_by(r, ["case_id"], F.col("seq"), F.col("value").alias("ablated")).withColumnRenamed("case_id", "a")
    j = truth.join(_merged(r), F.col("case_id") == F.col("c")).join(plain, F.col("case_id") == F.col("a")).where("merged <> ablated")
    kind = F.when(F.col("merged") == F.col("truth"), "carries").when(F.col("ablated") == F.col("truth"), "harms").otherwise("lateral")
    return j.groupBy(kind.alias("kind"), (F.col("case_id") % 2).alias("half")).agg(F.count(F.lit(1)).alias("n"))


def debug_counters(spark, sf_dir):
    """Pages, weak readings and missing fields per case."""
    r = readings(spark, sf_dir)
    return r.groupBy("case_id").agg(F.count_distinct("page").alias("pages"), F.count_if(F.col("conf") < 10).alias("weak"), (F.lit(6) - F.count_distinct("doc_type")).alias("missing_types"))


def volume_sample(spark, sf_dir):
    """F8: the cases with most readings and as many from the middle (a sampling operator)."""
    g = readings(spark, sf_dir).groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    counts = g.groupBy("n").agg(F.count(F.lit(1)).alias("cases"))
    w = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    spread = counts.select("n", F.coalesce(F.sum("cases").over(w), F.lit(0)).alias("before"), F.sum("cases").over(Window.partitionBy()).alias("total"))
    inner = F.row_number().over(Window.partitionBy("n").orderBy("case_id")) - 1
    placed = g.join(spread.withColumnRenamed("n", "m"), F.col("n") == F.col("m")).withColumn("place", F.col("before") + inner)
    middle = F.floor(F.col("total") / 2)
    return placed.where((F.col("place") < 10) | ((F.col("place") >= middle) & (F.col("place") < middle + 10))).select("case_id", F.col("place").cast("long").alias("place"))


def gram_tokens(spark, sf_dir):
    """Runs of one to four words with their counts."""
    words = F.regexp_extract_all(F.lower("p_name"), F.lit("[a-z0-9]+"), F.lit(0))
    p = table(spark, sf_dir, "part").select(words.alias("w"))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(4), F.size("w") - i + 1)), lambda k: F.array_join(F.slice(F.col("w"), i, k), ""))))
    return p.select(F.explode(F.filter(grams, lambda g: F.length(g) >= 4)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (letter_disagreement, registry_disagreement, hidden_truth_join, signals_left_truth, field_hit_rates, merge_ablation_diff, debug_counters, volume_sample, gram_tokens)}

_M = "m AS (SELECT case_id, value AS merged FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY source, doc_type, seq) AS k FROM readings) WHERE k = 1)"
_BY = "(SELECT case_id, value AS {1} FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY source, seq) AS k FROM readings WHERE doc_type = {0}) WHERE k = 1)"
ORACLES = {
    "letter_disagreement": f"WITH {READINGS}, {_M}, d AS {_BY.format(4, 'letter')} SELECT case_id, letter, merged FROM d JOIN m USING (case_id) WHERE letter <> merged",
    "registry_disagreement": f"WITH {READINGS}, {_M}, d AS {_BY.format(5, 'registry')} SELECT case_id, registry, merged FROM d JOIN m USING (case_id) WHERE registry <> merged AND NOT EXISTS (SELECT 1 FROM readings r WHERE r.case_id = d.case_id AND r.doc_type = 5 AND r.source = 1 AND r.value = merged)",
    "hidden_truth_join": "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'O' END AS claimed, o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey % 50 = 6 GROUP BY ALL",
    "signals_left_truth": "SELECT d.doc_id, n_chars > 2000 AS x_long, quality AS t_quality, toxic AS t_toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    "field_hit_rates": "WITH c AS (SELECT 'status' AS field, o_orderstatus AS t, CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS s FROM orders UNION ALL SELECT 'priority', CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END, CASE WHEN o_orderkey % 5 = 0 THEN '5-LOW' ELSE o_orderpriority END FROM orders) SELECT field, count(*) AS scorable, sum((t = s)::BIGINT)::BIGINT AS hits, sum((t = s)::INT) / count(*) AS rate FROM c WHERE t IS NOT NULL GROUP BY field",
    "merge_ablation_diff": f"WITH {READINGS}, {_M}, t AS (SELECT case_id, max(value) AS truth FROM readings GROUP BY case_id), a AS (SELECT case_id, value AS ablated FROM readings WHERE seq = 1) SELECT CASE WHEN merged = truth THEN 'carries' WHEN ablated = truth THEN 'harms' ELSE 'lateral' END AS kind, case_id % 2 AS half, count(*) AS n FROM t JOIN m USING (case_id) JOIN a USING (case_id) WHERE merged <> ablated GROUP BY ALL",
    "debug_counters": f"WITH {READINGS} SELECT case_id, count(DISTINCT page) AS pages, count(*) FILTER (conf < 10) AS weak, 6 - count(DISTINCT doc_type) AS missing_types FROM readings GROUP BY case_id",
    "volume_sample": f"WITH {READINGS}, g AS (SELECT case_id, count(*) AS n FROM readings GROUP BY case_id), p AS (SELECT case_id, row_number() OVER (ORDER BY n DESC, case_id) - 1 AS place, count(*) OVER () AS total FROM g) SELECT case_id, place FROM p WHERE place < 10 OR (place >= total // 2 AND place < total // 2 + 10)",
    "gram_tokens": "WITH w AS (SELECT regexp_extract_all(lower(p_name), '[a-z0-9]+') AS w FROM part), g AS (SELECT unnest(flatten([[array_to_string(w[i:i + k - 1], '') FOR k IN range(1, least(4, len(w) - i + 1) + 1)] FOR i IN range(1, len(w) + 1)])) AS gram FROM w) SELECT gram, count(*) AS n FROM g WHERE length(gram) >= 4 GROUP BY gram",
}
