"""Queries over the rule cascade."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plenum.operators.decide import all_fired, back_off, best_action, cascade
from plenum.session import table
from plenum.plans.stand_ins import CASE_FACTS, case_facts, deny_rules, review_rules

#: Points for deciding (second key) when the truth is the first key.
PAYOFF = {
    "APPROVED": {"APPROVED": 8, "DENIED": 0, "NEEDS_REVIEW": 2},
    "DENIED": {"APPROVED": -4, "DENIED": 8, "NEEDS_REVIEW": 2},
    "NEEDS_REVIEW": {"APPROVED": 1, "DENIED": 1, "NEEDS_REVIEW": 8},
}
SAFE_FIRST = ("NEEDS_REVIEW", "DENIED", "APPROVED")


def decided(spark, sf_dir):
    return cascade(case_facts(spark, sf_dir), F.col("finding"), deny_rules(), review_rules(), F.col("injected"))


def rule_cascade_orders(spark, sf_dir):
    """K1: decision and branch of every case."""
    return decided(spark, sf_dir).select("case_id", "decision", "branch")


def rule_branch_counts(spark, sf_dir):
    return decided(spark, sf_dir).groupBy("branch", "decision").agg(F.count(F.lit(1)).alias("n"))


def rule_fired_sets(spark, sf_dir):
    """K2: all rules that fire, in order."""
    return case_facts(spark, sf_dir).select("case_id", F.array_join(all_fired(deny_rules()), "|").alias("deny_hits"), F.array_join(all_fired(review_rules()), "|").alias("review_hits"))


def rule_ablation(spark, sf_dir):
    """Per rule left out, how many cases land elsewhere and where they land."""
    base = decided(spark, sf_dir).where("finding IS NULL").withColumns({"d": all_fired(deny_rules()), "r": all_fired(review_rules())})
    # Only cases whose first hit is the left-out rule can move; each such case has one such rule.
    first = F.coalesce(F.get("d", F.lit(0)), F.get("r", F.lit(0)))
    moved = base.withColumn("removed", first).where("removed IS NOT NULL")
    d = F.filter("d", lambda x: x != F.col("removed"))
    r = F.filter("r", lambda x: x != F.col("removed"))
    landed = F.when(F.size(d) > 0, "DENIED").when((F.size(r) > 0) | F.col("injected"), "NEEDS_REVIEW").otherwise("APPROVED")
    return moved.select("removed", "decision", landed.alias("landed")).groupBy("removed", "decision", "landed").agg(F.count(F.lit(1)).alias("n"))


def rule_ablation_truth(spark, sf_dir):
    """Per rule left out, the cases that the rule carries, harms or moves sideways, and the approvals of cases that are to be denied."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "F", "DENIED").when(F.col("o_orderstatus") == "O", "APPROVED").otherwise("NEEDS_REVIEW").alias("truth"))
    base = decided(spark, sf_dir).where("finding IS NULL").withColumns({"d": all_fired(deny_rules()), "r": all_fired(review_rules())})
    moved = base.withColumn("removed", F.coalesce(F.get("d", F.lit(0)), F.get("r", F.lit(0)))).where("removed IS NOT NULL")
    d, r = (F.filter(c, lambda x: x != F.col("removed")) for c in ("d", "r"))
    landed = F.when(F.size(d) > 0, "DENIED").when((F.size(r) > 0) | F.col("injected"), "NEEDS_REVIEW").otherwise("APPROVED")
    j = moved.withColumn("landed", landed).where("landed <> decision").join(status, F.col("case_id") == F.col("k"))
    return j.groupBy("removed").agg(
        F.count_if(F.col("decision") == F.col("truth")).alias("carries"), F.count_if(F.col("landed") == F.col("truth")).alias("harms"),
        F.count_if((F.col("decision") != F.col("truth")) & (F.col("landed") != F.col("truth"))).alias("lateral"), F.count_if((F.col("landed") == "APPROVED") & (F.col("truth") == "DENIED")).alias("wrong_approvals"),
    )


def co_fire_matrix(spark, sf_dir):
    """Pairs of deny rules that fire together."""
    hits = case_facts(spark, sf_dir).select(all_fired(deny_rules()).alias("h")).where(F.size("h") > 1)
    pairs = hits.select(F.explode("h").alias("a"), "h").select("a", F.explode("h").alias("b")).where("a < b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def confidence_back_off(spark, sf_dir):
    """K5: most specific of cell, branch and hand-set values."""
    cells = spark.createDataFrame([("clean_approve", "10", 0.91), ("clean_approve", "11", 0.95), ("fee_unknown", "01", 0.4)], "b string, cell string, cell_value double")
    fitted = spark.createDataFrame([("clean_approve", 0.88), ("fee_unknown", 0.55), ("embargo_world", 0.97)], "b2 string, fit_value double")
    d = decided(spark, sf_dir).withColumn("bits", F.concat(F.col("soft").cast("int").cast("string"), (F.col("fee") == "paid").cast("int").cast("string")))
    joined = d.join(F.broadcast(cells), (F.col("branch") == F.col("b")) & (F.col("bits") == F.col("cell")), "left").join(F.broadcast(fitted), F.col("branch") == F.col("b2"), "left")
    hand = F.when(F.col("branch") == "transit_visa", F.lit(0.9))
    return joined.select("case_id", "branch", back_off(F.col("cell_value"), F.col("fit_value"), hand).alias("confidence"))


def display_fill_isolated(spark, sf_dir):
    """K7: display columns are filled after the decision and never feed it."""
    d = decided(spark, sf_dir)
    return d.select("case_id", "decision", "branch", F.when(F.col("fee") == "unknown", F.when(F.col("n") >= 3, "paid").otherwise("unknown")).otherwise(F.col("fee")).alias("display_fee"), F.coalesce("visa", F.lit("3-MEDIUM")).alias("display_visa"))


def ev_argmax(spark, sf_dir):
    """Per branch, the action with the best expected payoff under the observed truth shares."""
    d = decided(spark, sf_dir).where("finding IS NULL")
    truth = F.when(F.col("case_id") % 3 == 0, "DENIED").when(F.col("case_id") % 7 < 3, "NEEDS_REVIEW").otherwise("APPROVED")
    share = lambda c: (F.sum((F.col("truth") == c).cast("long")) / F.count(F.lit(1)))
    g = d.withColumn("truth", truth).groupBy("branch").agg(*[share(c).alias(c) for c in PAYOFF], F.count(F.lit(1)).alias("n"))
    chances = {c: F.col(c) for c in PAYOFF}
    return g.select("branch", "n", best_action(chances, PAYOFF, SAFE_FIRST).alias("action"), best_action(chances, PAYOFF, SAFE_FIRST, F.lit("APPROVED")).alias("action_without_approval"))


def payoff_attribution(spark, sf_dir):
    """Points scored, and left by relabelling or splitting, per (branch, decision)."""
    d = decided(spark, sf_dir)
    truth = F.when(F.col("case_id") % 3 == 0, "DENIED").when(F.col("case_id") % 7 < 3, "NEEDS_REVIEW").otherwise("APPROVED")
    d = d.select("branch", "decision", truth.alias("truth"))
    g = d.groupBy("branch", "decision").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col("truth") == t).cast("long")).alias(t) for t in PAYOFF])
    points = {p: sum((F.col(t) * PAYOFF[t][p] for t in PAYOFF), F.lit(0)) for p in PAYOFF}
    best = F.greatest(*points.values())
    now = F.coalesce(*[F.when(F.col("decision") == p, v) for p, v in points.items()])
    # A row per branch and decision: the total comes from these.
    scale = F.lit(80.0) / (F.lit(8.0) * F.sum("n").over(Window.partitionBy()))
    return g.select("branch", "decision", "n", (now * scale).alias("scored"), ((best - now) * scale).alias("relabel"), ((F.col("n") * 8 - best) * scale).alias("split"))


QUERIES = {f.__name__: f for f in (rule_cascade_orders, rule_branch_counts, rule_fired_sets, rule_ablation, rule_ablation_truth, co_fire_matrix, confidence_back_off, display_fill_isolated, ev_argmax, payoff_attribution)}

_DENY = "list_filter([CASE WHEN d1 THEN 'disqualifying_flag' END, CASE WHEN d2 THEN 'embargo_world' END, CASE WHEN d3 THEN 'embargo_world_partial' END, CASE WHEN d4 THEN 'revoked_sponsor' END, CASE WHEN d5 THEN 'transit_visa' END, CASE WHEN d6 THEN 'fee_unpaid' END, CASE WHEN d7 THEN 'stale_arrival' END], lambda x: x IS NOT NULL)"
_REVIEW = "list_filter([CASE WHEN r1 THEN 'fee_unknown' END, CASE WHEN r2 THEN 'waived_non_dip' END, CASE WHEN r3 THEN 'missing_arrival' END, CASE WHEN r4 THEN 'review_flag' END, CASE WHEN r5 THEN 'missing_sponsor' END, CASE WHEN r6 THEN 'missing_visa' END, CASE WHEN r7 THEN 'b13_census' END], lambda x: x IS NOT NULL)"
_TRUTH = "CASE WHEN case_id % 3 = 0 THEN 'DENIED' WHEN case_id % 7 < 3 THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END"

ORACLES = {
    "rule_cascade_orders": f"WITH {CASE_FACTS} SELECT case_id, decision, branch FROM decided",
    "rule_branch_counts": f"WITH {CASE_FACTS} SELECT branch, decision, count(*) AS n FROM decided GROUP BY ALL",
    "rule_fired_sets": f"WITH {CASE_FACTS} SELECT case_id, array_to_string({_DENY}, '|') AS deny_hits, array_to_string({_REVIEW}, '|') AS review_hits FROM hits",
    "rule_ablation": f"""WITH {CASE_FACTS}, base AS (SELECT *, {_DENY} AS d, {_REVIEW} AS r FROM decided WHERE finding IS NULL),
        m AS (SELECT *, coalesce(d[1], r[1]) AS removed FROM base)
        SELECT removed, decision, CASE WHEN len(list_filter(d, lambda x: x <> removed)) > 0 THEN 'DENIED'
                 WHEN len(list_filter(r, lambda x: x <> removed)) > 0 OR injected THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS landed, count(*) AS n
        FROM m WHERE removed IS NOT NULL GROUP BY ALL""",
    "rule_ablation_truth": f"""WITH {CASE_FACTS}, base AS (SELECT *, {_DENY} AS d, {_REVIEW} AS r FROM decided WHERE finding IS NULL),
        m AS (SELECT *, coalesce(d[1], r[1]) AS removed FROM base),
        l AS (SELECT case_id, removed, decision, CASE WHEN len(list_filter(d, lambda x: x <> removed)) > 0 THEN 'DENIED'
                 WHEN len(list_filter(r, lambda x: x <> removed)) > 0 OR injected THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS landed FROM m WHERE removed IS NOT NULL),
        t AS (SELECT l.*, CASE o_orderstatus WHEN 'F' THEN 'DENIED' WHEN 'O' THEN 'APPROVED' ELSE 'NEEDS_REVIEW' END AS truth FROM l JOIN orders ON o_orderkey = case_id WHERE landed <> decision)
        SELECT removed, count(*) FILTER (decision = truth) AS carries, count(*) FILTER (landed = truth) AS harms, count(*) FILTER (decision <> truth AND landed <> truth) AS lateral,
               count(*) FILTER (landed = 'APPROVED' AND truth = 'DENIED') AS wrong_approvals FROM t GROUP BY removed""",
    "co_fire_matrix": f"WITH {CASE_FACTS}, h AS (SELECT case_id, unnest({_DENY}) AS x FROM hits) SELECT p.x AS a, q.x AS b, count(*) AS n FROM h p JOIN h q ON p.case_id = q.case_id AND p.x < q.x GROUP BY ALL",
    "confidence_back_off": f"""WITH {CASE_FACTS} SELECT case_id, branch, CAST(CASE
        WHEN branch = 'clean_approve' AND soft::INT || (fee = 'paid')::INT = '10' THEN 0.91 WHEN branch = 'clean_approve' AND soft::INT || (fee = 'paid')::INT = '11' THEN 0.95
        WHEN branch = 'fee_unknown' AND soft::INT || (fee = 'paid')::INT = '01' THEN 0.4 WHEN branch = 'clean_approve' THEN 0.88 WHEN branch = 'fee_unknown' THEN 0.55
        WHEN branch = 'embargo_world' THEN 0.97 WHEN branch = 'transit_visa' THEN 0.9 ELSE 0.5 END AS DOUBLE) AS confidence FROM decided""",
    "display_fill_isolated": f"WITH {CASE_FACTS} SELECT case_id, decision, branch, CASE WHEN fee = 'unknown' THEN CASE WHEN n >= 3 THEN 'paid' ELSE 'unknown' END ELSE fee END AS display_fee, coalesce(visa, '3-MEDIUM') AS display_visa FROM decided",
    "ev_argmax": f"""WITH {CASE_FACTS}, s AS (SELECT branch, count(*) AS n, sum(({_TRUTH} = 'APPROVED')::INT) / count(*) AS a, sum(({_TRUTH} = 'DENIED')::INT) / count(*) AS d, sum(({_TRUTH} = 'NEEDS_REVIEW')::INT) / count(*) AS r
        FROM decided WHERE finding IS NULL GROUP BY branch), v AS (SELECT branch, n, a * 8 + d * -4 + r * 1 AS va, a * 0 + d * 8 + r * 1 AS vd, a * 2 + d * 2 + r * 8 AS vr FROM s)
        SELECT branch, n, CASE WHEN vr >= vd AND vr >= va THEN 'NEEDS_REVIEW' WHEN vd >= va THEN 'DENIED' ELSE 'APPROVED' END AS action, CASE WHEN vr >= vd THEN 'NEEDS_REVIEW' ELSE 'DENIED' END AS action_without_approval FROM v""",
    "payoff_attribution": f"""WITH {CASE_FACTS}, g AS (SELECT branch, decision, count(*) AS n, sum(({_TRUTH} = 'APPROVED')::INT) AS a, sum(({_TRUTH} = 'DENIED')::INT) AS d, sum(({_TRUTH} = 'NEEDS_REVIEW')::INT) AS r
        FROM decided GROUP BY ALL), v AS (SELECT *, 8 * a - 4 * d + r AS va, 8 * d + r AS vd, 2 * a + 2 * d + 8 * r AS vr, 80.0::DOUBLE / (8.0::DOUBLE * (SELECT count(*) FROM decided)) AS scale FROM g),
        w AS (SELECT *, greatest(va, vd, vr) AS best, CASE decision WHEN 'APPROVED' THEN va WHEN 'DENIED' THEN vd ELSE vr END AS now FROM v)
        SELECT branch, decision, n, CAST(now AS DOUBLE) * scale AS scored, CAST(best - now AS DOUBLE) * scale AS relabel, CAST(n * 8 - best AS DOUBLE) * scale AS split FROM w""",
}
