"""Queries over votes, merges and agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from plenum.operators import vote
from plenum.plans.stand_ins import READINGS, readings
from plenum.session import table


def plurality_vote(spark, sf_dir):
    """D4."""
    r = readings(spark, sf_dir)
    return vote.plurality(r, ["case_id"], F.col("value"), F.lower("value"), F.col("seq"), F.col("page"), F.col("conf"))


def majority_id_vote(spark, sf_dir):
    """Each user's most frequent event type."""
    return vote.majority_id(table(spark, sf_dir, "events"), ["user_id"], "event_type", F.struct("ts", "event_id"))


def best_read_mass(spark, sf_dir):
    """Per case the source with the largest excess mass, the earliest on ties."""
    r = readings(spark, sf_dir).withColumn("mass", F.greatest(F.lit(0.0), F.col("conf") - 40) * (F.col("doc_type")))
    per = r.groupBy("case_id", "page").agg(F.sum("mass").alias("mass"))
    return vote.first_by(per, ["case_id"], F.struct((-F.col("mass")).alias("m"), F.col("page")), F.col("page").alias("best_page"), F.col("mass"))


def trust_ordered_merge(spark, sf_dir):
    """The first valid value by (source, document type, order), with provenance."""
    r = readings(spark, sf_dir).where(F.col("value") != "N")
    return vote.first_by(r, ["case_id"], F.struct("source", "doc_type", "seq"), F.col("value"), F.col("source"), F.col("doc_type"))


def vote_replaces_merge(spark, sf_dir):
    """K6: text-layer values stay, others give way to the vote."""
    r = readings(spark, sf_dir)
    merged = vote.first_by(r, ["case_id"], F.struct("source", "doc_type", "seq"), F.col("value").alias("merged"), F.col("source").alias("source"))
    voted = vote.plurality(r.where("source = 1"), ["case_id"], F.col("value"), F.lower("value"), F.col("seq"), F.col("page"), F.col("conf")).select(F.col("case_id").alias("c"), F.col("value").alias("voted"))
    j = merged.join(voted, F.col("case_id") == F.col("c"), "left")
    from_text = F.col("source") == 0
    return j.select("case_id", F.when(from_text, F.col("merged")).otherwise(F.coalesce("voted", "merged")).alias("value"), F.when(from_text, F.lit("text")).when(F.col("voted").isNotNull(), F.lit("vote")).otherwise(F.lit("ocr")).alias("provenance"))


def corroboration_challenge(spark, sf_dir):
    """A value on more documents than the incumbent's."""
    r = readings(spark, sf_dir)
    inc = vote.first_by(r, ["case_id"], F.struct("source", "doc_type", "seq"), F.col("value").alias("incumbent")).withColumnRenamed("case_id", "c")
    per = r.join(inc, F.col("case_id") == F.col("c")).groupBy("case_id", "value", "incumbent").agg(F.count_distinct("doc_type").alias("docs"), F.count_distinct("page").alias("pages"), F.count(F.lit(1)).alias("reads"))
    held = per.groupBy("case_id").agg(
        F.max(F.when(F.col("value") == F.col("incumbent"), F.col("docs"))).alias("incumbent_docs"),
        F.min(F.when((F.col("value") != F.col("incumbent")) & (F.col("docs") >= 2), F.struct((-F.col("docs")).alias("d"), (-F.col("pages")).alias("p"), (-F.col("reads")).alias("r"), F.col("value").alias("v")))).alias("best"),
    )
    return held.where(-F.col("best.d") > F.col("incumbent_docs")).select("case_id", F.col("best.v").alias("challenger"), (-F.col("best.d")).alias("docs"), "incumbent_docs")


def flag_union_quorum(spark, sf_dir):
    """Event types a user shows strongly, or twice on one day."""
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    q = vote.quorum(e, ["user_id"], "day", "event_type", F.col("value") > 90)
    return q.select("user_id", F.array_join("flags", "|").alias("flags"))


def unanimous_finding(spark, sf_dir):
    """D8, K9."""
    return vote.unanimous(readings(spark, sf_dir), ["case_id"], "value")


def cross_doc_conflict(spark, sf_dir):
    """C19."""
    return vote.conflicts(readings(spark, sf_dir), ["case_id"], "value")


def dedupe_first(spark, sf_dir):
    """First document of each text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    return d.groupBy("h").agg(F.min("doc_id").alias("doc_id"))


def rival_page_exists(spark, sf_dir):
    """A first-source reading contradicted on a page that doesn't show that value itself."""
    r = readings(spark, sf_dir)
    pages = r.groupBy("case_id", "page").agg(F.max((F.col("value") == "R").cast("int")).alias("own"), F.max((F.col("value") != "R").cast("int")).alias("other"))
    rivals = pages.where("own = 0 AND other = 1").select(F.col("case_id").alias("c")).distinct()
    claims = r.where((F.col("value") == "R") & (F.col("source") == 1)).select("case_id").distinct()
    return claims.join(rivals, F.col("case_id") == F.col("c"), "left_semi")


def tier_weakest(spark, sf_dir):
    """Cases by the weakest tier of their evidence."""
    r = readings(spark, sf_dir).groupBy("case_id").agg(F.max(F.when(F.col("source") == 0, 0).when(F.col("conf") >= 25, 1).otherwise(2)).alias("tier"), F.max("value").alias("verdict"))
    return r.groupBy("tier", "verdict").agg(F.count(F.lit(1)).alias("n"))


def provenance_class(spark, sf_dir):
    """Best source in which each case's R value is seen."""
    r = readings(spark, sf_dir).where("value = 'R'")
    g = r.groupBy("case_id").agg(F.max((F.col("source") == 0).cast("int")).alias("t"), F.max((F.col("conf") > 30).cast("int")).alias("o"))
    return g.select("case_id", F.when(F.col("t") == 1, "text").when(F.col("o") == 1, "raw_ocr").otherwise("restored_only").alias("provenance"))


def strategy_comparison(spark, sf_dir):
    """Fields matched by strategy: first reading, plurality, plurality of confident readings."""
    r = readings(spark, sf_dir)
    truth = r.groupBy("case_id").agg(F.max("value").alias("truth")).withColumnRenamed("case_id", "t")
    best = vote.first_by(r, ["case_id"], F.col("seq"), F.col("value")).withColumn("strategy", F.lit("best"))
    args = (["case_id"], F.col("value"), F.lower("value"), F.col("seq"), F.col("page"), F.col("conf"))
    plural = vote.plurality(r, *args).select("case_id", "value", F.lit("plurality").alias("strategy"))
    valid = vote.plurality(r.where("conf >= 20"), *args).select("case_id", "value", F.lit("plurality_valid").alias("strategy"))
    every = best.unionByName(plural).unionByName(valid).join(truth, F.col("case_id") == F.col("t"))
    return every.groupBy("strategy").agg(F.count(F.lit(1)).alias("cases"), F.sum((F.col("value") == F.col("truth")).cast("long")).alias("matched"))


QUERIES = {f.__name__: f for f in (plurality_vote, majority_id_vote, best_read_mass, trust_ordered_merge, vote_replaces_merge, corroboration_challenge, flag_union_quorum, unanimous_finding, cross_doc_conflict, dedupe_first, rival_page_exists, tier_weakest, provenance_class, strategy_comparison)}

_PLURAL = "SELECT case_id, value, reads, pages FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY pages DESC, reads DESC, conf DESC, seq) AS k FROM (SELECT case_id, value, count(*) AS reads, count(DISTINCT page) AS pages, max(conf) AS conf, min(seq) AS seq FROM readings WHERE {0} GROUP BY ALL)) WHERE k = 1"
_FIRST = "SELECT case_id, value, source, doc_type FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY {1} seq) AS k FROM readings WHERE {0}) WHERE k = 1"
_TRUST = "source, doc_type,"

ORACLES = {
    "plurality_vote": f"WITH {READINGS} " + _PLURAL.format("true"),
    "majority_id_vote": "SELECT user_id, event_type AS winner, votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, first) AS k FROM (SELECT user_id, event_type, count(*) AS votes, min((ts, event_id)) AS first FROM events WHERE event_type IS NOT NULL GROUP BY ALL)) WHERE k = 1",
    "best_read_mass": f"WITH {READINGS}, m AS (SELECT case_id, page, sum(greatest(0.0::DOUBLE, conf - 40) * doc_type) AS mass FROM readings GROUP BY ALL) SELECT case_id, page AS best_page, mass FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY mass DESC, page) AS k FROM m) WHERE k = 1",
    "trust_ordered_merge": f"WITH {READINGS} " + _FIRST.format("value <> 'N'", _TRUST),
    "vote_replaces_merge": f"WITH {READINGS}, m AS ({_FIRST.format('true', _TRUST)}), v AS ({_PLURAL.format('source = 1')}) SELECT m.case_id, CASE WHEN m.source = 0 THEN m.value ELSE coalesce(v.value, m.value) END AS value, CASE WHEN m.source = 0 THEN 'text' WHEN v.value IS NOT NULL THEN 'vote' ELSE 'ocr' END AS provenance FROM m LEFT JOIN v USING (case_id)",
    "corroboration_challenge": f"""WITH {READINGS}, inc AS ({_FIRST.format('true', _TRUST)}), p AS (SELECT r.case_id, r.value, inc.value AS incumbent, count(DISTINCT r.doc_type) AS docs, count(DISTINCT r.page) AS pages, count(*) AS reads FROM readings r JOIN inc USING (case_id) GROUP BY ALL),
        h AS (SELECT case_id, docs AS incumbent_docs FROM p WHERE value = incumbent), c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY docs DESC, pages DESC, reads DESC, value) AS k FROM p WHERE value <> incumbent AND docs >= 2) WHERE k = 1)
        SELECT c.case_id, c.value AS challenger, c.docs, h.incumbent_docs FROM c JOIN h USING (case_id) WHERE c.docs > h.incumbent_docs""",
    "flag_union_quorum": "WITH p AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, bool_or(value > 90) AS s, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS flags FROM p WHERE s OR n >= 2 GROUP BY user_id",
    "unanimous_finding": f"WITH {READINGS} SELECT case_id, min(value) AS value FROM readings GROUP BY case_id HAVING count(DISTINCT value) = 1",
    "cross_doc_conflict": f"WITH {READINGS} SELECT case_id, count(DISTINCT value) AS n_values FROM readings GROUP BY case_id HAVING count(DISTINCT value) > 1",
    "dedupe_first": "SELECT md5(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1",
    "rival_page_exists": f"WITH {READINGS} SELECT DISTINCT case_id FROM readings r WHERE value = 'R' AND source = 1 AND EXISTS (SELECT 1 FROM readings o WHERE o.case_id = r.case_id AND o.value <> 'R' AND NOT EXISTS (SELECT 1 FROM readings x WHERE x.case_id = o.case_id AND x.page = o.page AND x.value = 'R'))",
    "tier_weakest": f"WITH {READINGS}, g AS (SELECT case_id, max(CASE WHEN source = 0 THEN 0 WHEN conf >= 25 THEN 1 ELSE 2 END) AS tier, max(value) AS verdict FROM readings GROUP BY case_id) SELECT tier, verdict, count(*) AS n FROM g GROUP BY ALL",
    "provenance_class": f"WITH {READINGS} SELECT case_id, CASE WHEN bool_or(source = 0) THEN 'text' WHEN bool_or(conf > 30) THEN 'raw_ocr' ELSE 'restored_only' END AS provenance FROM readings WHERE value = 'R' GROUP BY case_id",
    "strategy_comparison": f"""WITH {READINGS}, t AS (SELECT case_id, max(value) AS truth FROM readings GROUP BY case_id), s AS (SELECT 'best' AS strategy, case_id, value FROM ({_FIRST.format('true', '')}) UNION ALL SELECT 'plurality', case_id, value FROM ({_PLURAL.format('true')}) UNION ALL SELECT 'plurality_valid', case_id, value FROM ({_PLURAL.format('conf >= 20')}))
        SELECT strategy, count(*) AS cases, sum((value = truth)::BIGINT) AS matched FROM s JOIN t USING (case_id) GROUP BY strategy""",
}
