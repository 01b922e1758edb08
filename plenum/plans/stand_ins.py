"""Deterministic stand-ins for case evidence, derived from the relational tables.

`CASE_FACTS` and the others are SQL that Spark and DuckDB both run, used on the oracle side; the Spark
side builds the same rows with DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.operators.decide import Rule
from plenum.session import table


def case_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the facts that the rules read."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)).cast("int")).alias("hard"),
        F.max(((F.col("l_returnflag") == "A") & (F.col("l_quantity") <= 2)).cast("int")).alias("soft"),
    )
    key = F.col("o_orderkey")
    fee = F.when(key % 4 == 1, "unknown").when(key % 20 == 2, "unpaid").when(key % 20 == 3, "waived").otherwise("paid")
    status = F.col("o_orderstatus")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        key.alias("case_id"),
        F.when(key % 10 != 7, F.col("o_orderpriority")).alias("visa"),
        F.when(key % 9 != 4, F.col("o_custkey")).alias("sponsor"),
        F.when(key % 13 != 5, F.col("o_orderdate")).alias("arrival"),
        (F.col("o_custkey") % 17).alias("world"),
        fee.alias("fee"),
        F.when(key % 12 == 0, F.when(status == "F", "DENIED").when(status == "O", "APPROVED").otherwise("NEEDS_REVIEW")).alias("finding"),
        (F.coalesce("hard", F.lit(0)) == 1).alias("hard"),
        (F.coalesce("soft", F.lit(0)) == 1).alias("soft"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        (key % 50 == 6).alias("injected"),
    )


def deny_rules() -> list[Rule]:
    visa, known = F.col("visa"), F.col("visa").isNotNull() & (F.col("visa") != "5-LOW")
    return [
        Rule("disqualifying_flag", F.col("hard")),
        Rule("embargo_world", F.col("world").isin(3, 11)),
        Rule("embargo_world_partial", (F.col("world") == 5) & known),
        Rule("revoked_sponsor", F.col("sponsor").isin(10, 20, 30, 40, 50, 60) & known),
        Rule("transit_visa", (visa == "1-URGENT") & (F.col("world") == 7)),
        Rule("fee_unpaid", F.col("fee") == "unpaid"),
        Rule("stale_arrival", (F.col("arrival") < F.lit("1995-07-01").cast("timestamp")) & known),
    ]


def review_rules() -> list[Rule]:
    open_visa = ~F.col("visa").eqNullSafe(F.lit("5-LOW"))
    return [
        Rule("fee_unknown", F.col("fee") == "unknown"),
        Rule("waived_non_dip", (F.col("fee") == "waived") & open_visa),
        Rule("missing_arrival", F.col("arrival").isNull()),
        Rule("review_flag", F.col("soft")),
        Rule("missing_sponsor", F.col("sponsor").isNull() & open_visa),
        Rule("missing_visa", F.col("visa").isNull()),
        Rule("b13_census", F.col("n") < 2),
    ]


CASE_FACTS = """
lines AS (
  SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R' AND l_quantity >= 48) AS hard,
         bool_or(l_returnflag = 'A' AND l_quantity <= 2) AS soft
  FROM lineitem GROUP BY l_orderkey
), facts AS (
  SELECT o_orderkey AS case_id, CASE WHEN o_orderkey % 10 <> 7 THEN o_orderpriority END AS visa,
         CASE WHEN o_orderkey % 9 <> 4 THEN o_custkey END AS sponsor,
         CASE WHEN o_orderkey % 13 <> 5 THEN o_orderdate END AS arrival, o_custkey % 17 AS world,
         CASE WHEN o_orderkey % 4 = 1 THEN 'unknown' WHEN o_orderkey % 20 = 2 THEN 'unpaid'
              WHEN o_orderkey % 20 = 3 THEN 'waived' ELSE 'paid' END AS fee,
         CASE WHEN o_orderkey % 12 = 0 THEN CASE o_orderstatus WHEN 'F' THEN 'DENIED' WHEN 'O' THEN 'APPROVED' ELSE 'NEEDS_REVIEW' END END AS finding,
         coalesce(hard, false) AS hard, coalesce(soft, false) AS soft, coalesce(n, 0) AS n, o_orderkey % 50 = 6 AS injected
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
), hits AS (
  SELECT *,
    hard AS d1, world IN (3, 11) AS d2, world = 5 AND visa IS NOT NULL AND visa <> '5-LOW' AS d3,
    coalesce(sponsor IN (10, 20, 30, 40, 50, 60), false) AND visa IS NOT NULL AND visa <> '5-LOW' AS d4,
    coalesce(visa = '1-URGENT', false) AND world = 7 AS d5, fee = 'unpaid' AS d6,
    coalesce(arrival < TIMESTAMP '1995-07-01', false) AND visa IS NOT NULL AND visa <> '5-LOW' AS d7,
    fee = 'unknown' AS r1, fee = 'waived' AND visa IS DISTINCT FROM '5-LOW' AS r2, arrival IS NULL AS r3, soft AS r4,
    sponsor IS NULL AND visa IS DISTINCT FROM '5-LOW' AS r5, visa IS NULL AS r6, n < 2 AS r7
  FROM facts
), named AS (
  SELECT *,
    CASE WHEN d1 THEN 'disqualifying_flag' WHEN d2 THEN 'embargo_world' WHEN d3 THEN 'embargo_world_partial'
         WHEN d4 THEN 'revoked_sponsor' WHEN d5 THEN 'transit_visa' WHEN d6 THEN 'fee_unpaid' WHEN d7 THEN 'stale_arrival' END AS deny,
    CASE WHEN r1 THEN 'fee_unknown' WHEN r2 THEN 'waived_non_dip' WHEN r3 THEN 'missing_arrival' WHEN r4 THEN 'review_flag'
         WHEN r5 THEN 'missing_sponsor' WHEN r6 THEN 'missing_visa' WHEN r7 THEN 'b13_census' END AS review
  FROM hits
), decided AS (
  SELECT *,
    CASE WHEN finding IS NOT NULL THEN finding WHEN deny IS NOT NULL THEN 'DENIED'
         WHEN review IS NOT NULL OR injected THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS decision,
    CASE WHEN finding IS NOT NULL THEN 'adjudicator_finding'
         ELSE coalesce(deny, review, CASE WHEN injected THEN 'injected_approval_review' END, 'clean_approve') END AS branch
  FROM named
)
"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per line item, with a total order within the case (`seq`)."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("case_id"),
        F.col("l_returnflag").alias("value"),
        (F.col("l_suppkey") % 3).cast("int").alias("page"),
        (F.col("l_suppkey") % 2).cast("int").alias("source"),
        (F.col("l_partkey") % 6 + 1).cast("int").alias("doc_type"),
        F.col("l_quantity").alias("conf"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate").alias("seq"),
    )


READINGS = """
readings AS (
  SELECT l_orderkey AS case_id, l_returnflag AS value, CAST(l_suppkey % 3 AS INT) AS page, CAST(l_suppkey % 2 AS INT) AS source,
         CAST(l_partkey % 6 + 1 AS INT) AS doc_type, l_quantity AS conf,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS seq
  FROM lineitem
)
"""
