"""Queries read their whole tables: counted again by plain Python over small written ones."""

import random
from datetime import datetime, timedelta

from plenum.catalogue import QUERIES


def written(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_negation_lookback_reads_long_documents(spark, tmp_path):
    rng = random.Random(3)
    texts = ["", "the", "of the", "and x the", "of x y the", "x " * 200 + "The", "x " * 199 + "of the the x the", *[" ".join(rng.choices(["the", "of", "and", "x", ""], k=k)) for k in (199, 200, 201, 1_000, 20_000)]]
    sf = written(spark, tmp_path, documents=(list(enumerate(texts)), "doc_id long, text string"))

    def brute(text):
        t = text.lower().split(" ")
        return sum(w == "the" and not {"of", "and"} & set(t[max(0, k - 2) : k]) for k, w in enumerate(t))

    assert dict(QUERIES["negation_lookback"](spark, sf).collect()) == {k: brute(t) for k, t in enumerate(texts)}


def test_hard_first_round_robin_gives_every_order_its_turn(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, rng.randrange(100), rng.choice(["1-URGENT", "1-URGENT", "1-URGENT", "2-HIGH", None]), rng.choice([None, 1.5, 2.5, rng.random() * 9])) for k in range(3_000)]
    sf = written(spark, tmp_path, orders=(rows, "o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double"))
    want, turn = {}, {}
    for k, _, priority, price in sorted(rows, key=lambda r: (r[3] is None, -(r[3] or 0), r[0])):
        turn[priority] = turn.get(priority, 0) + 1
        want[k] = (priority, turn[priority])
    got = QUERIES["hard_first_round_robin"](spark, sf).collect()
    assert len(got) == len(rows)
    assert {r["o_orderkey"]: (r["o_orderpriority"], r["turn"]) for r in got} == want


def test_max_gap_midpoint_reads_all_orders(spark, tmp_path):
    day = lambda n, hour=0: datetime(1996, 1, 1) + timedelta(days=n, hours=hour)
    schema = "o_orderkey long, o_custkey long, o_orderdate timestamp"
    group = [(0, 3, day(0)), (1, 100, day(90))]  # customers whose own dates have a gap that the table's have not
    dense = [*group, *((k + 2, 5, day(k, k % 24)) for k in range(0, 91, 19))]
    assert QUERIES["max_gap_midpoint"](spark, written(spark, tmp_path / "dense", orders=(dense, schema))).collect() == []
    planted = [*group, *((k + 2, 5, day(k)) for k in range(0, 91) if not 30 < k < 61), (99, 5, None)]
    assert [tuple(r) for r in QUERIES["max_gap_midpoint"](spark, written(spark, tmp_path / "planted", orders=(planted, schema))).select("lo", "gap", "midpoint").collect()] == [("1996-01-31", 31, "1996-02-15")]


def test_left_join_pages_keeps_every_order(spark, tmp_path):
    orders = [(k,) for k in range(1, 41)]
    lines = [(k, float(q)) for k in range(1, 41) if k % 5 for q in (10, 45, 46, 50)[: k % 4 + 1]]
    sf = written(spark, tmp_path, orders=(orders, "o_orderkey long"), lineitem=(lines, "l_orderkey long, l_quantity double"))
    want = {k: sum(key == k and q > 45 for key, q in lines) for (k,) in orders}
    assert dict(QUERIES["left_join_pages"](spark, sf).collect()) == want


def test_sponsor_support_takes_the_least_id_of_one_place(spark, tmp_path):
    # Order 10, line 1, part 0 shows 0010, 0011 and 0012, which a page reads as 00l0, 00ll and 00l2; order 19 shows 0019 and 0020.
    # Parts 5 and 3,000,005 of order 50 stand in one place, too.
    items = [(10, 0, 2, 1), (10, 0, 1, 1), (10, 0, 0, 1), (19, 5, 1, 1), (19, 5, 0, 1), (50, 3_000_005, 0, 1), (50, 5, 1, 4), (50, 10, 1, 1)]
    sf = written(spark, tmp_path, lineitem=(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"))
    got = {r["case_id"]: (r["sponsor_id"], r["pages"]) for r in QUERIES["sponsor_support"](spark, sf).collect()}
    assert got == {"10": ("SPN-0010", 1), "19": ("SPN-0019", 1), "50": ("SPN-0051", 1)}
