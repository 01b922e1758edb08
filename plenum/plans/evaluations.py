"""Queries over corpus-wide evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plenum.operators import evaluate, folds, recurrence
from plenum.plans.decisions import decided
from plenum.plans.stand_ins import CASE_FACTS
from plenum.session import table


def _bimodal(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumn("k", F.when(F.col("o_orderkey") % 20 == 0, F.col("o_custkey") % 6).otherwise(1000000 + F.col("o_orderkey")))


def recurring_entities(spark, sf_dir):
    """D9, where the spectrum has a gap."""
    return recurrence.recurring(_bimodal(spark, sf_dir), "k")


def recurring_abstain(spark, sf_dir):
    """D9, where it must abstain."""
    return recurrence.recurring(table(spark, sf_dir, "orders"), "o_custkey")


def corpus_revision(spark, sf_dir):
    """Decisions tightened for recurring ids."""
    b = _bimodal(spark, sf_dir).select(F.col("o_orderkey").alias("key"), "k", F.col("o_orderpriority").alias("visa"))
    d = decided(spark, sf_dir).select("case_id", "decision", "branch").join(b, F.col("case_id") == F.col("key"))
    out = recurrence.revise(d, recurrence.recurring(b, "k"), "k", F.col("visa") == "5-LOW", F.col("branch").isin("adjudicator_finding", "disqualifying_flag"), F.col("case_id") % 11 == 0)
    return out.select("case_id", "decision", "branch")


def _labelled(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    l = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_id")  # noqa: E741
    return l.join(d, F.col("l_id") == F.col("doc_id")).withColumn("guess", F.when(F.col("n_chars") >= 600, 1).otherwise(0))


def shrunken_accuracy(spark, sf_dir):
    """D15."""
    return evaluate.shrunken_accuracy(_labelled(spark, sf_dir), "source", "guess", F.col("guess") == F.col("quality")).select("source", "n", "hits", F.round("prior", 9).alias("prior"), "confidence")


def cell_refinement(spark, sf_dir):
    """D16."""
    rows = _labelled(spark, sf_dir)
    hit = F.col("guess") == F.col("quality")
    return evaluate.cell_refinement(rows, evaluate.shrunken_accuracy(rows, "source", "guess", hit), "source", "lang", hit)


def lift_mining(spark, sf_dir):
    """D23."""
    out = evaluate.lift(_labelled(spark, sf_dir), ["lang", "source", "toxic"], F.col("quality") == 1)
    return out.select("feature", "value", "n", "hits", F.round("lift", 9).alias("lift"), F.round("z", 9).alias("z"))


def label_xtab(spark, sf_dir):
    """Modal class share per language with support."""
    g = _labelled(spark, sf_dir).groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy("lang").agg(F.sum("n").alias("n"), F.max("n").alias("modal")).where("n >= 12").select("lang", "n", (F.col("modal") / F.col("n")).alias("modal_share"))


def brier_calibration(spark, sf_dir):
    """D28."""
    rows = _labelled(spark, sf_dir).withColumn("conf", F.when(F.col("guess") == 1, 0.75).otherwise(0.25))
    out = evaluate.brier(rows, F.col("conf"), F.col("quality") == 1)
    return out.select("n", F.round("brier", 9).alias("brier"), F.round("points", 9).alias("points"))


def nearest_rank_pct(spark, sf_dir):
    """D29."""
    return evaluate.nearest_rank(table(spark, sf_dir, "orders"), "o_totalprice", [0, 10, 50, 90, 99, 100], ["o_orderpriority"])


def index_percentiles(spark, sf_dir):
    """sorted[int(n * q)] of document lengths."""
    return evaluate.index_percentiles(table(spark, sf_dir, "documents"), "n_chars", [50, 90, 99])


def runtime_stats(spark, sf_dir):
    """D31."""
    v = table(spark, sf_dir, "events").select("event_type", "value")
    stats = v.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("most"))
    p = evaluate.nearest_rank(v, "value", [50, 90, 99], ["event_type"]).groupBy(F.col("event_type").alias("e")).agg(*[F.max(F.when(F.col("q") == k, F.col("pick"))).alias(f"p{k}") for k in (50, 90, 99)])
    return stats.join(p, F.col("event_type") == F.col("e")).drop("e")


def max_gap_midpoint(spark, sf_dir):
    """Over all order dates; no row where no gap is long enough."""
    return evaluate.max_gap_midpoint(table(spark, sf_dir, "orders"), "o_orderdate")


def stale_cutoff(spark, sf_dir):
    """The middle of the longest gap between the days on which costly urgent orders of one customer in five came in, else a default."""
    o = table(spark, sf_dir, "orders")
    d = o.select((F.col("o_custkey") % 5).alias("g"), "o_orderdate", ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 150000)).alias("rare"))
    long = evaluate.max_gap_midpoint(d.where("g = 0 AND rare"), "o_orderdate", 4, "1995-07-01").withColumn("kind", F.lit("rare"))
    return long.unionByName(evaluate.max_gap_midpoint(d, "o_orderdate", 20, "1995-07-01").withColumn("kind", F.lit("all")))


def replay_diff(spark, sf_dir):
    """C5."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 101 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    new = o.where("o_orderkey % 103 <> 0").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 50 == 0, None).otherwise(F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 70 == 0, "2-HIGH").otherwise(F.col("o_orderpriority")).alias("priority"))
    return evaluate.replay_diff(old, new, "k", ["status", "priority"])


def rule_mining_all(spark, sf_dir):
    """Suppliers whose parts all meet the condition, with support."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    s = table(spark, sf_dir, "supplier")
    ok = F.col("l_discount") <= 0.09
    g = l.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.bool_and(ok).alias("every"), F.bool_and(F.when(F.col("l_returnflag") != "N", ok)).alias("every_known"), F.count_if(F.col("l_returnflag") != "N").alias("known"))
    rule = F.when((F.col("n") >= 6) & F.col("every"), "full").when((F.col("known") >= 4) & F.col("every_known"), "partial")
    return g.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select("l_suppkey", "n", "known", rule.alias("rule"))


def drift_audit(spark, sf_dir):
    """Class shares, margin to a cutoff and closed-domain escapes per year."""
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    g = o.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("f"), F.min(F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice") - 100000)).alias("margin"), F.sum((~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")).cast("long")).alias("escapes"))
    return g.select("y", "n", (F.col("f") / F.col("n")).alias("share_f"), F.round("margin", 6).alias("margin"), "escapes")


def top_escapes(spark, sf_dir):
    """most common values outside a closed domain, ties by first seen (a top-k report)."""
    p = table(spark, sf_dir, "part").where(~F.col("p_type").isin("STANDARD"))
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(5)


def headroom_transfer(spark, sf_dir):
    """Group means of one population carried over to another's shares."""
    d = decided(spark, sf_dir)
    a = d.where("case_id % 2 = 0").groupBy("branch").agg(F.avg((F.col("n") >= 3).cast("double")).alias("rate"))
    b = d.where("case_id % 2 = 1").groupBy(F.col("branch").alias("br")).agg(F.count(F.lit(1)).alias("n"))
    return b.join(a, F.col("branch") == F.col("br")).select("branch", "n", F.round(F.col("rate") * F.col("n"), 6).alias("projected"))


def margin_precision(spark, sf_dir):
    """Precision by bucket of each case's best margin."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    m = l.groupBy("l_orderkey").agg(F.max("l_quantity").alias("q"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("hit"))
    return m.groupBy(F.floor(F.col("q") / 10).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("hit").cast("double")), 9).alias("precision"))


def oracle_ceilings(spark, sf_dir):
    """Cases of which any reading has the right value."""
    from plenum.plans.stand_ins import readings

    r = readings(spark, sf_dir)
    g = r.groupBy("case_id").agg(F.max((F.col("value") == "A").cast("int")).alias("any_read"), F.max(((F.col("value") == "A") & (F.col("source") == 0)).cast("int")).alias("any_text"))
    return g.agg(F.count(F.lit(1)).alias("cases"), F.sum("any_read").alias("any_read"), F.sum("any_text").alias("any_text"))


def out_of_fold(spark, sf_dir):
    """Each fold's constant is fitted on the other folds, in one pass."""
    c = table(spark, sf_dir, "customer").withColumn("fold", (F.col("c_custkey") % 5).cast("int"))
    g = c.groupBy("c_mktsegment", "fold").agg(F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("c_mktsegment")
    rest = (F.sum("s").over(w) - F.col("s")) / (F.sum("n").over(w) - F.col("n"))
    return g.select("c_mktsegment", "fold", rest.alias("fitted_cents"))


def rules_out_of_fold(spark, sf_dir):
    """D40 with D20, D21: each fold's rules are mined on the other folds and tried on the one left out."""
    l = table(spark, sf_dir, "lineitem").withColumn("fold", (F.col("l_orderkey") % 5).cast("int"))  # noqa: E741
    ok = F.col("l_discount") <= 0.09
    known = F.col("l_returnflag") != "N"
    states = l.groupBy("l_suppkey", "fold").agg(F.count(F.lit(1)).alias("n"), F.bool_and(ok).alias("every"), F.count_if(known).alias("known"), F.bool_and(F.when(known, ok)).alias("every_known"), F.count_if(ok).alias("held"), F.collect_set("l_linestatus").alias("seen"))
    rest = folds.complement(states, ["l_suppkey"], "fold", {"n": "sum", "every": "and", "known": "sum", "every_known": "and", "seen": "union"})
    rule = F.when((F.coalesce("rest_n", F.lit(0)) >= 6) & F.col("rest_every"), "full").when((F.coalesce("rest_known", F.lit(0)) >= 4) & F.col("rest_every_known"), "partial")
    return rest.select("l_suppkey", "fold", F.col("n").alias("tried"), "held", rule.alias("rule"), F.array_join(F.sort_array(F.coalesce("rest_seen", F.array().cast("array<string>"))), "|").alias("seen"))


def gaps_out_of_fold(spark, sf_dir):
    """D40 with D22: the largest gap between distinct dates, fold by fold without the fold's own rows, and on which side of its middle they lie."""
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 5).cast("int").alias("fold"))
    gaps = folds.largest_gaps(o, "day", "fold", 5)
    tried = o.join(F.broadcast(gaps.withColumnRenamed("fold", "f")), F.col("fold") == F.col("f"))
    middle = F.date_add("lo", F.floor(F.col("gap") / 2).cast("int"))
    return tried.groupBy("fold", F.date_format("lo", "yyyy-MM-dd").alias("lo"), "gap").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("day") <= middle).alias("before"))


QUERIES = {
    f.__name__: f
    for f in (recurring_entities, recurring_abstain, corpus_revision, shrunken_accuracy, cell_refinement, lift_mining, label_xtab, brier_calibration, nearest_rank_pct, index_percentiles, runtime_stats, max_gap_midpoint, replay_diff, rule_mining_all, drift_audit, top_escapes, headroom_transfer, margin_precision, oracle_ceilings, out_of_fold, rules_out_of_fold, gaps_out_of_fold, stale_cutoff)
}

_K = "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 20 = 0 THEN o_custkey % 6 ELSE 1000000 + o_orderkey END AS k FROM orders"


def _recurring(source: str) -> str:
    return f"""c AS (SELECT k, count(*) AS n FROM ({source}) WHERE k IS NOT NULL GROUP BY k), sp AS (SELECT DISTINCT n FROM c), st AS (SELECT n AS lo, lead(n) OVER (ORDER BY n) AS hi FROM sp),
      b AS (SELECT hi / lo AS ratio, lo FROM st WHERE hi IS NOT NULL ORDER BY ratio DESC, lo DESC LIMIT 1),
      ok AS (SELECT lo FROM b WHERE ratio >= 3 AND (SELECT sum(n) FROM c) >= 50 AND (SELECT count(*) FROM c WHERE n > b.lo) <= 0.05 * (SELECT count(*) FROM c)),
      flagged AS (SELECT k, n FROM c, ok WHERE n > lo)"""


_LAB = "lab AS (SELECT l.*, d.lang, d.source, d.n_chars, CASE WHEN d.n_chars >= 600 THEN 1 ELSE 0 END AS guess FROM labels l JOIN documents d USING (doc_id))"
_ACC = f"""{_LAB}, cp AS (SELECT guess, avg((guess = quality)::INT) AS p FROM lab GROUP BY guess), br AS (SELECT source, count(*) AS n, sum((guess = quality)::BIGINT) AS hits, avg(cp.p) AS prior FROM lab JOIN cp USING (guess) GROUP BY source),
  acc AS (SELECT source, n, hits, prior, (hits + 10 * prior) / (n + 10) AS shrunk, round_even(greatest(0.05::DOUBLE, least(0.95::DOUBLE, (hits + 10 * prior) / (n + 10))), 3) AS confidence FROM br)"""
_RANK = "SELECT {g} q, pick FROM (SELECT {g} q, CAST(round_even(q / 100.0::DOUBLE * (n - 1), 0) AS BIGINT) AS place, vs FROM (SELECT {g} count(*) AS n, list_sort(list({v})) AS vs FROM {t} {by}), (SELECT unnest([{q}]) AS q)), LATERAL (SELECT vs[place + 1] AS pick)"

ORACLES = {
    "stale_cutoff": """WITH o AS (SELECT 'all' AS kind, CAST(o_orderdate AS DATE) AS d, 20 AS least FROM orders UNION SELECT 'rare', CAST(o_orderdate AS DATE), 4 FROM orders WHERE o_custkey % 5 = 0 AND o_orderpriority = '1-URGENT' AND o_totalprice > 150000),
        g AS (SELECT kind, d, lead(d) OVER (PARTITION BY kind ORDER BY d) - d AS gap, least FROM o), b AS (SELECT kind, max({'gap': gap, 'd': d}) FILTER (gap >= least) AS b FROM g GROUP BY kind)
        SELECT kind, strftime(b.d, '%Y-%m-%d') AS lo, CAST(b.gap AS BIGINT) AS gap, coalesce(strftime(b.d + CAST(floor(b.gap / 2) AS INT), '%Y-%m-%d'), '1995-07-01') AS midpoint FROM b""",
    "rules_out_of_fold": """WITH l AS (SELECT l_suppkey AS s, CAST(l_orderkey % 5 AS INT) AS fold, l_discount <= 0.09 AS ok, l_returnflag <> 'N' AS known, l_linestatus AS st FROM lineitem),
        g AS (SELECT s, fold, count(*) AS tried, count(*) FILTER (ok) AS held FROM l GROUP BY s, fold),
        r AS (SELECT g.s, g.fold, count(*) AS n, bool_and(ok) AS every, count(*) FILTER (known) AS k, bool_and(ok) FILTER (known) AS ek, string_agg(DISTINCT st, '|' ORDER BY st) AS seen FROM g JOIN l ON l.s = g.s AND l.fold <> g.fold GROUP BY g.s, g.fold)
        SELECT g.s AS l_suppkey, g.fold, tried, held, CASE WHEN n >= 6 AND every THEN 'full' WHEN k >= 4 AND ek THEN 'partial' END AS rule, coalesce(seen, '') AS seen FROM g LEFT JOIN r USING (s, fold)""",
    "gaps_out_of_fold": """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey % 5 AS INT) AS fold FROM orders), d AS (SELECT DISTINCT f AS fold, day FROM o, range(5) t(f) WHERE o.fold <> f),
        g AS (SELECT fold, day, lead(day) OVER (PARTITION BY fold ORDER BY day) - day AS gap FROM d), b AS (SELECT fold, max({'gap': gap, 'lo': day}) AS b FROM g WHERE gap IS NOT NULL GROUP BY fold)
        SELECT o.fold, strftime(b.lo, '%Y-%m-%d') AS lo, CAST(b.gap AS INT) AS gap, count(*) AS n, count(*) FILTER (day <= b.lo + CAST(floor(b.gap / 2) AS INT)) AS before FROM o JOIN b USING (fold) GROUP BY o.fold, b.lo, b.gap""",
    "recurring_entities": f"WITH {_recurring(_K)} SELECT k, n AS occurrences FROM flagged",
    "recurring_abstain": f"WITH {_recurring('SELECT o_custkey AS k FROM orders')} SELECT k AS o_custkey, n AS occurrences FROM flagged",
    "corpus_revision": f"""WITH {CASE_FACTS}, kk AS ({_K}), {_recurring(_K)}, j AS (SELECT d.case_id, d.decision, d.branch, f.k IS NOT NULL AND kk.o_orderpriority <> '5-LOW' AND d.branch NOT IN ('adjudicator_finding', 'disqualifying_flag') AND d.case_id % 11 <> 0 AND d.decision <> 'DENIED' AS hit
        FROM decided d JOIN kk ON kk.o_orderkey = d.case_id LEFT JOIN flagged f ON f.k = kk.k) SELECT case_id, CASE WHEN hit THEN 'DENIED' ELSE decision END AS decision, CASE WHEN hit THEN 'recurring_id' ELSE branch END AS branch FROM j""",
    "shrunken_accuracy": f"WITH {_ACC} SELECT source, n, hits, round(prior, 9) AS prior, confidence FROM acc",
    "cell_refinement": f"""WITH {_ACC}, ce AS (SELECT source, lang, count(*) AS n, sum((guess = quality)::INT) AS hits FROM lab GROUP BY ALL HAVING count(*) >= 5), v AS (SELECT ce.source, lang, ce.n, round_even(greatest(0.05::DOUBLE, least(0.95::DOUBLE, (ce.hits + 10 * acc.shrunk) / (ce.n + 10))), 3) AS value, acc.confidence FROM ce JOIN acc USING (source)) SELECT source, lang, n, value FROM v WHERE value <> confidence""",
    "lift_mining": f"WITH {_LAB}, u AS (SELECT unnest([{{'feature': 'lang', 'value': lang}}, {{'feature': 'source', 'value': source}}, {{'feature': 'toxic', 'value': toxic::VARCHAR}}]) AS c, (quality = 1)::INT AS y FROM lab), b AS (SELECT avg((quality = 1)::INT) AS base FROM lab), g AS (SELECT c.feature AS feature, c.value AS value, count(*) AS n, sum(y)::BIGINT AS hits FROM u WHERE c.value IS NOT NULL GROUP BY ALL HAVING count(*) >= 15) SELECT feature, value, n, hits, round(hits / n / base, 9) AS lift, round((hits / n - base) / sqrt(base * (1 - base) / n), 9) AS z FROM g, b",
    "label_xtab": f"WITH {_LAB}, g AS (SELECT lang, quality, count(*) AS n FROM lab GROUP BY ALL) SELECT lang, sum(n)::BIGINT AS n, max(n) / sum(n) AS modal_share FROM g GROUP BY lang HAVING sum(n) >= 12",
    "brier_calibration": f"WITH {_LAB}, b AS (SELECT count(*) AS n, avg(pow(CASE guess WHEN 1 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END - (quality = 1)::INT, 2)) AS brier FROM lab) SELECT n, round(brier, 9) AS brier, round(20 * greatest(0.0::DOUBLE, 1 - 2 * brier), 9) AS points FROM b",
    "nearest_rank_pct": _RANK.format(g="o_orderpriority,", v="o_totalprice", t="orders", by="GROUP BY o_orderpriority", q="0, 10, 50, 90, 99, 100"),
    "index_percentiles": "SELECT q, vs[CAST(floor(n * q / 100) AS BIGINT) + 1] AS pick FROM (SELECT count(*) AS n, list_sort(list(n_chars)) AS vs FROM documents), (SELECT unnest([50, 90, 99]) AS q)",
    "runtime_stats": "WITH s AS (SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, max(value) AS most, list_sort(list(value)) AS vs FROM events GROUP BY event_type) SELECT event_type, n, mean, most, vs[CAST(round_even(0.5::DOUBLE * (n - 1), 0) AS BIGINT) + 1] AS p50, vs[CAST(round_even(0.9::DOUBLE * (n - 1), 0) AS BIGINT) + 1] AS p90, vs[CAST(round_even(0.99::DOUBLE * (n - 1), 0) AS BIGINT) + 1] AS p99 FROM s",
    "max_gap_midpoint": "WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), g AS (SELECT d, lead(d) OVER (ORDER BY d) - d AS gap FROM d), b AS (SELECT * FROM g WHERE gap IS NOT NULL ORDER BY gap DESC, d DESC LIMIT 1) SELECT strftime(d, '%Y-%m-%d') AS lo, CAST(gap AS BIGINT) AS gap, strftime(d + CAST(floor(gap / 2) AS INT), '%Y-%m-%d') AS midpoint FROM b WHERE gap >= 20",
    "replay_diff": """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey % 101 <> 0),
        b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 70 = 0 THEN '2-HIGH' ELSE o_orderpriority END AS priority FROM orders WHERE o_orderkey % 103 <> 0),
        j AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' ELSE 'changed' END AS state, a.status AS s1, b.status AS s2, a.priority AS p1, b.priority AS p2 FROM a FULL JOIN b ON a.k = b.k)
        SELECT k, state, 'status' AS field, s1 AS old, s2 AS new FROM j WHERE s1 IS DISTINCT FROM s2 UNION ALL SELECT k, state, 'priority', p1, p2 FROM j WHERE p1 IS DISTINCT FROM p2""",
    "rule_mining_all": "WITH g AS (SELECT l_suppkey, count(*) AS n, bool_and(l_discount <= 0.09) AS e, bool_and(l_discount <= 0.09) FILTER (l_returnflag <> 'N') AS ek, count(*) FILTER (l_returnflag <> 'N') AS known FROM lineitem GROUP BY l_suppkey) SELECT l_suppkey, n, known, CASE WHEN n >= 6 AND e THEN 'full' WHEN known >= 4 AND ek THEN 'partial' END AS rule FROM g WHERE l_suppkey IN (SELECT s_suppkey FROM supplier)",
    "drift_audit": "SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n, sum((o_orderstatus = 'F')::INT) / count(*) AS share_f, round(min(CASE WHEN o_totalprice >= 100000 THEN o_totalprice - 100000 END), 6) AS margin, sum((o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))::BIGINT) AS escapes FROM orders GROUP BY 1",
    "top_escapes": "SELECT p_type, count(*) AS n, min(p_partkey) AS first_seen FROM part WHERE p_type NOT IN ('STANDARD') GROUP BY p_type ORDER BY n DESC, first_seen LIMIT 5",
    "headroom_transfer": f"WITH {CASE_FACTS}, a AS (SELECT branch, avg((n >= 3)::INT) AS rate FROM decided WHERE case_id % 2 = 0 GROUP BY branch), b AS (SELECT branch, count(*) AS n FROM decided WHERE case_id % 2 = 1 GROUP BY branch) SELECT branch, b.n, round(a.rate * b.n, 6) AS projected FROM b JOIN a USING (branch)",
    "margin_precision": "WITH m AS (SELECT l_orderkey, max(l_quantity) AS q, max((l_returnflag = 'R')::INT) AS hit FROM lineitem GROUP BY l_orderkey) SELECT CAST(floor(q / 10) AS INT) AS bucket, count(*) AS n, round(avg(hit), 9) AS precision FROM m GROUP BY 1",
    "oracle_ceilings": "WITH g AS (SELECT l_orderkey, max((l_returnflag = 'A')::INT) AS r, max((l_returnflag = 'A' AND l_suppkey % 2 = 0)::INT) AS t FROM lineitem GROUP BY l_orderkey) SELECT count(*) AS cases, sum(r)::BIGINT AS any_read, sum(t)::BIGINT AS any_text FROM g",
    "out_of_fold": "WITH g AS (SELECT c_mktsegment, CAST(c_custkey % 5 AS INT) AS fold, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS s, count(*) AS n FROM customer GROUP BY ALL) SELECT c_mktsegment, fold, CAST(sum(s) OVER w - s AS DOUBLE) / CAST(sum(n) OVER w - n AS DOUBLE) AS fitted_cents FROM g WINDOW w AS (PARTITION BY c_mktsegment)",
}
