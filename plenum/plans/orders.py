"""Queries over order-sensitive and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plenum.operators import running, sequences
from plenum.session import table
from plenum.sources import ordered


def forward_fill(spark, sf_dir):
    """The last purchase value a user has shown."""
    e = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    return sequences.forward_fill(e, ["user_id"], [F.col("ts"), F.col("event_id")], value, "filled").select("event_id", "filled")


def islands(spark, sf_dir):
    """Runs of equal event types."""
    e = table(spark, sf_dir, "events")
    return sequences.islands(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type"), "run").select("event_id", "run")


def island_lengths(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    runs = sequences.islands(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type"), "run")
    return runs.groupBy("user_id", "run", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("event_type", "n").agg(F.count(F.lit(1)).alias("runs"))


def nearest_asof_fill(spark, sf_dir):
    """The purchase value nearest in time, the earlier one on ties."""
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return sequences.nearest_fill(e, ["user_id"], F.col("us"), [F.col("event_id")], F.when(F.col("event_type") == "purchase", F.col("value")), "nearest").select("event_id", "nearest")


def kfold_round_robin(spark, sf_dir):
    """Per nation, by key."""
    return sequences.round_robin_fold(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.col("c_custkey")], 5).select("c_custkey", "fold")


def stratified_split(spark, sf_dir):
    """E12."""
    return sequences.stratified_split(table(spark, sf_dir, "documents"), "lang", "doc_id", "8090", 0.3).select("doc_id", "split")


def stratified_sample(spark, sf_dir):
    """The first rows per class, topped up with one row for an uncovered property (a sampling operator)."""
    d = table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_orderpriority").orderBy("o_orderkey")
    ranked = d.withColumn("rn", F.row_number().over(w)).where("rn <= 5")
    covered = ranked.agg(F.max((F.col("o_totalprice") > 400000).cast("int")).alias("has"))
    extra = d.where("o_totalprice > 400000").agg(F.min("o_orderkey").alias("o_orderkey")).join(F.broadcast(covered), (F.col("has") == 0) & F.col("o_orderkey").isNotNull()).select("o_orderkey")
    return ranked.select("o_orderkey").union(extra)


def hard_first_round_robin(spark, sf_dir):
    """Hardest first, in turn over the classes; `place` is the interleaved order."""
    d = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    turns = running.cumulate(d, [F.col("o_orderpriority")], [F.desc("o_totalprice"), F.col("o_orderkey")], {"turn": F.lit(1)}, "turns")
    turns = turns.select("o_orderkey", "o_orderpriority", (F.col("turn_before") + 1).cast("int").alias("turn"))
    # At most one order of a class has a turn, so turn and class are a total order.
    placed = running.cumulate(turns, [], [F.col("turn"), F.col("o_orderpriority").asc_nulls_last()], {"place": F.lit(1)}, "places")
    return placed.select("o_orderkey", "o_orderpriority", "turn", (F.col("place_before") + 1).cast("long").alias("place"))


def adjacent_ratio(spark, sf_dir):
    """Steps of the spectrum of order counts."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("customers"))
    return c.select("n", "customers", (F.lead("n").over(Window.orderBy("n")) / F.col("n")).alias("ratio"))


def negation_lookback(spark, sf_dir):
    """A token counts unless one of the two before it negates it."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split(F.lower("text"), " ").alias("t"))
    hits = F.filter(F.transform("t", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: (s["x"] == "the") & ~F.exists(F.slice(F.col("t"), F.greatest(s["i"] - 1, F.lit(1)), F.least(s["i"], F.lit(2))), lambda p: p.isin("of", "and")))
    return d.select("doc_id", F.size(hits).alias("n"))


def semi_split(spark, sf_dir):
    """Orders of a split."""
    o = table(spark, sf_dir, "orders")
    split = table(spark, sf_dir, "customer").where("c_custkey % 3 = 1").select("c_custkey")
    return o.join(split, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


def anti_missing(spark, sf_dir):
    """C4: customers without an order, and orders without a known customer."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    no_order = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.lit("customer").alias("side"), F.col("c_custkey").alias("k"))
    unknown = o.join(c.where("c_custkey % 50 <> 0"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.lit("order").alias("side"), F.col("o_orderkey").alias("k"))
    return no_order.unionByName(unknown)


def resume_merge(spark, sf_dir):
    """Only keys not yet done are added; the old result stays."""
    o = table(spark, sf_dir, "orders")
    done = o.where("o_orderkey % 4 < 3").select(F.col("o_orderkey").alias("k"), F.lit("old").alias("run"), "o_totalprice")
    todo = o.select(F.col("o_orderkey").alias("k"), F.lit("new").alias("run"), "o_totalprice").join(done.select(F.col("k").alias("d")), F.col("k") == F.col("d"), "left_anti")
    return done.unionByName(todo)


def alignment_check(spark, sf_dir):
    """Two key lists agree, without repeats."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    b = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    g = a.withColumn("a", F.lit(1)).withColumn("b", F.lit(0)).unionByName(b.withColumn("a", F.lit(0)).withColumn("b", F.lit(1))).groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return g.agg(F.count_if(F.col("a") > 1).alias("repeats"), F.count_if((F.col("a") > 0) & (F.col("b") == 0)).alias("only_a"), F.count_if((F.col("a") == 0) & (F.col("b") > 0)).alias("only_b"))


def set_algebra(spark, sf_dir):
    """Sizes of intersection, difference and symmetric difference of key sets."""
    o = table(spark, sf_dir, "orders")
    a, b = o.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct(), o.where("o_orderstatus = 'F'").select("o_custkey").distinct()
    part = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return part(a.intersect(b), "both").unionByName(part(a.exceptAll(b), "only_a")).unionByName(part(a.exceptAll(b).union(b.exceptAll(a)), "one"))


def three_way_join(spark, sf_dir):
    """Predictions, debug rows and truth on one key."""
    o, c, n = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def interval_overlap(spark, sf_dir):
    """Items that an interval of their own order crosses, tested in an array per order."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    strikes = l.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.struct("l_quantity", F.col("l_linenumber").alias("y"))).alias("s"))
    spans = l.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 5).alias("x1"))
    j = spans.join(strikes, F.col("l_orderkey") == F.col("k"))
    return j.where(F.exists("s", lambda s: (s["l_quantity"] < F.col("x1")) & (s["l_quantity"] + 3 > F.col("x0")) & (F.abs(s["y"] - F.col("l_linenumber")) <= 2))).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("struck"))


def ordered_sink(spark, sf_dir):
    """All orders written in order of price and key, part by part, and read back: how many, and whether any part runs into the next."""
    import uuid

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    path = f"{running.shared_dir(spark)}/plenum/ordered-{uuid.uuid4().hex}"
    ordered.register(spark)
    o.orderBy("cents", "o_orderkey").write.format("ordered").mode("append").save(path)
    back = ordered.read_ordered(spark, path, "o_orderkey long, cents long")
    parts = back.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.min(F.struct("cents", "o_orderkey")).alias("lo"), F.max(F.struct("cents", "o_orderkey")).alias("hi"))
    apart = F.coalesce(F.lag("hi").over(Window.orderBy("part")) < F.col("lo"), F.lit(True))  # a row for each part
    return parts.select("n", "keys", apart.alias("apart")).agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.bool_and("apart").alias("in_order"))


def left_join_pages(spark, sf_dir):
    """Every order with its readings, or none."""
    o = table(spark, sf_dir, "orders")
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return o.join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(F.count("l_orderkey").alias("reads"))


QUERIES = {
    f.__name__: f
    for f in (forward_fill, islands, island_lengths, nearest_asof_fill, kfold_round_robin, stratified_split, stratified_sample, hard_first_round_robin, adjacent_ratio, negation_lookback, semi_split, anti_missing, resume_merge, alignment_check, set_algebra, three_way_join, interval_overlap, left_join_pages, ordered_sink)
}

_RUN = "f AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM f)"
ORACLES = {
    "forward_fill": "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events",
    "islands": f"WITH {_RUN} SELECT event_id, run FROM r",
    "island_lengths": f"WITH {_RUN}, g AS (SELECT user_id, run, event_type, count(*) AS n FROM r GROUP BY ALL) SELECT event_type, n, count(*) AS runs FROM g GROUP BY ALL",
    "nearest_asof_fill": "WITH p AS (SELECT *, epoch_us(ts) AS us FROM events), q AS (SELECT event_id, us, last_value(CASE WHEN event_type = 'purchase' THEN us END IGNORE NULLS) OVER a AS pu, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER a AS pv, first_value(CASE WHEN event_type = 'purchase' THEN us END IGNORE NULLS) OVER b AS lu, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER b AS lv FROM p WINDOW a AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT event_id, CASE WHEN lu IS NOT NULL AND (pu IS NULL OR lu - us < us - pu) THEN lv ELSE pv END AS nearest FROM q",
    "kfold_round_robin": "SELECT c_custkey, CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) % 5 AS INT) AS fold FROM customer",
    "stratified_split": "WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('8090' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, CASE WHEN k <= round_even(n * 0.3::DOUBLE, 0) THEN 'holdout' ELSE 'dev' END AS split FROM r",
    "stratified_sample": "WITH r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 5), x AS (SELECT min(o_orderkey) AS o_orderkey FROM orders WHERE o_totalprice > 400000) SELECT o_orderkey FROM r UNION ALL SELECT o_orderkey FROM x WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE o_totalprice > 400000)",
    "hard_first_round_robin": "WITH t AS (SELECT o_orderkey, o_orderpriority, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INT) AS turn FROM orders) SELECT *, row_number() OVER (ORDER BY turn, o_orderpriority NULLS LAST) AS place FROM t",
    "adjacent_ratio": "WITH c AS (SELECT n, count(*) AS customers FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY n) SELECT n, customers, lead(n) OVER (ORDER BY n) / n AS ratio FROM c",
    "negation_lookback": "WITH d AS (SELECT doc_id, string_split(lower(text), ' ') AS t FROM documents) SELECT doc_id, CAST(len([i FOR i IN range(1, len(t) + 1) IF t[i] = 'the' AND NOT (coalesce(CASE WHEN i > 1 THEN t[i - 1] IN ('of', 'and') END, false) OR coalesce(CASE WHEN i > 2 THEN t[i - 2] IN ('of', 'and') END, false))]) AS INT) AS n FROM d",
    "semi_split": "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 1)",
    "anti_missing": "SELECT 'customer' AS side, c_custkey AS k FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT 'order', o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 50 <> 0)",
    "resume_merge": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 < 3 THEN 'old' ELSE 'new' END AS run, o_totalprice FROM orders",
    "alignment_check": "WITH b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem) SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS repeats, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM b)) AS only_a, (SELECT count(*) FROM b WHERE k NOT IN (SELECT o_orderkey FROM orders)) AS only_b",
    "set_algebra": "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT 'both' AS part, count(*) AS n FROM a JOIN b USING (k) UNION ALL SELECT 'only_a', count(*) FROM a ANTI JOIN b USING (k) UNION ALL SELECT 'one', (SELECT count(*) FROM a ANTI JOIN b USING (k)) + (SELECT count(*) FROM b ANTI JOIN a USING (k))",
    "three_way_join": "SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name",
    "interval_overlap": "WITH s AS (SELECT * FROM lineitem WHERE l_returnflag = 'R') SELECT l_orderkey, count(*) AS struck FROM lineitem a WHERE l_returnflag = 'A' AND EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = a.l_orderkey AND s.l_quantity < a.l_quantity + 5 AND s.l_quantity + 3 > a.l_quantity AND abs(s.l_linenumber - a.l_linenumber) <= 2) GROUP BY l_orderkey",
    "ordered_sink": "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS in_order FROM orders",
    "left_join_pages": "SELECT o_orderkey, count(l_orderkey) AS reads FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
}
