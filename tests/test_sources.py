"""Stamps and their guard, page text made once, the packet source, lines of packets, and the stream's first records."""

import json
import time

import pytest
from pyspark.sql import functions as F

from plenum.sources import materialise, ordered, page_text, provenance, tables
from plenum.streaming import ingest


def test_a_join_of_different_pipelines_is_refused(spark):
    a, b = (spark.createDataFrame([(1, x)], "k int, v string") for x in "ab")
    same = provenance.PlanSettings().stamp()
    assert provenance.guarded_join(a, b.withColumnRenamed("v", "w"), "k", "inner", same, same).count() == 1
    with pytest.raises(ValueError, match="restore"):
        provenance.guarded_join(a, b, "k", "inner", same, same | {"restore": "off"})
    with pytest.warns(UserWarning, match="git_rev"):
        provenance.require_agreement(spark, {"a": same | {"git_rev": "1"}, "b": same | {"git_rev": "2"}})
    with pytest.warns(UserWarning, match="no stamp"):
        provenance.require_agreement(spark, {"a": same, "b": {}})
    provenance.require_agreement(spark, {"a": same, "b": {"schema": "5"}})  # a key that is missing is tolerated


def test_settings_come_from_the_session(spark):
    spark.conf.set("plenum.restore", "off")
    try:
        assert provenance.PlanSettings.of(spark).stamp()["restore"] == "off"
    finally:
        spark.conf.unset("plenum.restore")


def test_page_text_is_made_once_and_errors_are_rows(spark, tmp_path):
    def read(stem):
        if stem == "bad":
            raise ValueError("torn file")
        return [{"page_no": 0, "visible_lines": [f"line of {stem}"], "reads": [{"lines": ["a", "b"]}]}]

    made = materialise.materialise(spark.createDataFrame([("x",), ("bad",), ("y",)], "stem string"), read, f"{tmp_path}/text")
    got = {r["stem"]: r for r in made.collect()}
    assert got["bad"]["error"] == "ValueError: torn file" and got["bad"]["pages"] is None
    assert [p["visible_lines"] for p in materialise.with_pages(made).where("stem = 'x'").first()["pages"]] == [["line of x"]]
    assert {r["q"] for r in materialise.cost_quantiles(made).collect()} == {50, 90, 99}
    materialise.register(spark)
    made.createOrReplaceTempView("made")
    lines = spark.sql("SELECT m.stem, l.* FROM made m, LATERAL packet_lines(m.pages) l WHERE m.stem = 'x'").collect()
    assert [(r["channel"], r["ord"], r["line"]) for r in lines] == [("visible", 0, "line of x"), ("read 0", 0, "a"), ("read 0", 1, "b")]


def test_packet_source_reads_files_as_partitions(spark, tmp_path):
    for k in range(3):
        rows = [{"_meta": {"schema": "5"}}] + [{"stem": f"{k}-{n}", "cost_ms": n, "error": None, "pages": [{"page_no": n}]} for n in range(k)]
        (tmp_path / f"part-{k}.json").write_text("\n".join(map(json.dumps, rows)) + ("\n" if k % 2 else ""))
    materialise.register(spark)
    got = spark.read.format("packets").load(str(tmp_path))
    assert sorted(r["stem"] for r in got.collect()) == ["1-0", "2-0", "2-1"] and got.rdd.getNumPartitions() == 3


def test_of_several_lines_of_a_case_the_first_counts(spark):
    rows = [("a", 2, "f2", 0), ("a", 1, "f1", 7), ("a", 3, "f1", 9), ("b", 4, "f2", 1)]
    batch = spark.createDataFrame(rows, "stem string, cost_ms long, file string, block int").withColumn("error", F.lit(None).cast("string")).withColumn("pages", F.array())
    assert {r["stem"]: r["cost_ms"] for r in ingest.first_cases(batch).collect()} == {"a": 1, "b": 4}


RECORD = ("a", "b", "c", "XW-1", "SPN-1", "d", "e", "none", "paid", "APPROVED", 0.5, "clean_approve")


def test_the_first_record_of_a_case_wins_over_batches(spark, tmp_path):
    schema = ingest.RECORDS.removesuffix(", batch long")

    def add(number, *cases):
        spark.createDataFrame([(c, by, *RECORD[1:]) for c, by in cases], schema).write.parquet(f"{tmp_path}/in/batch={number}")
        ingest.first_records_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        return sorted((r["case_id"], r["applicant_name"], r["batch"]) for r in ingest.current(spark, f"{tmp_path}/out").collect())

    assert add(0, ("x", "first"), ("y", "only")) == [("x", "first", 0), ("y", "only", 0)]
    assert add(1, ("x", "second"), ("z", "new")) == [("x", "first", 0), ("y", "only", 0), ("z", "new", 1)]
    assert add(2, ("z", "third"), ("x", "fourth"), ("w", "last")) == [("w", "last", 2), ("x", "first", 0), ("y", "only", 0), ("z", "new", 1)]


def test_the_state_of_a_case_expires():
    class State:
        exists, hasTimedOut, removed, kept = False, False, False, None  # noqa: N815

        def update(self, value):
            self.exists = value

        def remove(self):
            self.removed = True

        def setTimeoutTimestamp(self, ms):  # noqa: N802
            self.kept = ms

    import pandas as pd

    first, state = ingest._first_of(5), State()
    rows = pd.DataFrame({"case_id": ["x", "x"], "batch": [3, 2], "branch": ["b", "a"], "confidence": [0.1, 0.2], "written": pd.to_datetime([1000, 2000], unit="ms")})
    assert [f["batch"].tolist() for f in first(("x",), iter([rows]), state)] == [[2]] and state.exists == (2,) and state.kept == 2005
    assert list(first(("x",), iter([rows]), state)) == []
    state.hasTimedOut = True
    assert list(first(("x",), iter([]), state)) == [] and state.removed


def test_late_corrections_only_tighten(spark, tmp_path):
    rows = [(f"s{k}", *RECORD[:3], "XW-1", f"SPN-{k:04d}", *RECORD[5:], 0) for k in range(200)]
    rows += [(f"r{k}", *RECORD[:3], "DIP-1" if k == 0 else "XW-1", "SPN-9999", *RECORD[5:9], "DENIED" if k == 1 else "APPROVED", 0.5, "adjudicator_finding" if k == 2 else "clean_approve", 0) for k in range(20)]
    spark.createDataFrame(rows, ingest.RECORDS).write.parquet(f"{tmp_path}/out")
    filled = spark.createDataFrame([("r3",)], "case_id string")
    before = {r["case_id"]: r["adjudication"] for r in ingest.current(spark, f"{tmp_path}/out").collect()}
    assert ingest.tighten(spark, f"{tmp_path}/out", (), filled) == 16
    assert ingest.tighten(spark, f"{tmp_path}/out", (), filled) == 0
    after = {r["case_id"]: r for r in ingest.current(spark, f"{tmp_path}/out").collect()}
    changed = {c for c, r in after.items() if r["adjudication"] != before[c]}
    assert changed == {f"r{k}" for k in range(4, 20)} and all(after[c]["adjudication"] == "DENIED" and after[c]["branch"] == "recurring_id" for c in changed)


def test_a_killed_run_leaves_a_valid_beginning(spark, tmp_path):
    ordered.register(spark)
    path = f"file://{tmp_path}/out"
    assert ordered.read_ordered(spark, path, "id long").count() == 0

    def stops(batches):
        from pyspark import TaskContext

        if TaskContext.get().partitionId() == 2:
            time.sleep(4)
            raise RuntimeError("killed")
        yield from batches

    rows = spark.range(0, 100, 1, 4)
    with pytest.raises(Exception, match="killed"):
        rows.mapInArrow(stops, "id long").write.format("ordered").mode("append").save(path)
    assert sorted(r["id"] for r in ordered.read_ordered(spark, path, "id long").collect()) == list(range(50))
    rows.write.format("ordered").mode("append").save(path)
    got = ordered.read_ordered(spark, path, "id long").collect()
    assert sorted((r["part"], r["id"]) for r in got) == [(k // 25, k) for k in range(100)]
    with pytest.raises(Exception, match="killed"):  # what was whole stays
        rows.mapInArrow(stops, "id long").write.format("ordered").mode("append").save(path)
    assert ordered.read_ordered(spark, path, "id long").count() == 100


def test_damaged_lines_are_rows_with_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_meta": {"v": "1"}}\n{"stem": "a", "cost_ms": 1, "error": null, "pages": []}\n{"stem": "b", \n[1]\n')
    materialise.register(spark)
    got = sorted(((r["stem"], (r["error"] or "")[:7]) for r in spark.read.format("packets").load(str(tmp_path)).collect()), key=repr)
    assert got == [("a", ""), (None, "no JSON"), (None, "no JSON")]


def test_small_tables(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("case_id,applicant_name,species_code,home_world,visa_class,sponsor_id,arrival_date,declared_purpose,risk_flags,fee_status,adjudication\nMIB-000001,A B,X,Y,XW-1,SPN-0001,2026-01-01,transit,none,paid,APPROVED\n")
    (tmp_path / "splits.json").write_text('{"seed": 1,\n "dev": ["a", "b"], "holdout": ["c"]}')
    (tmp_path / "keys.txt").write_text("one\n# none\n\n two \n")
    row = tables.labels(spark, str(tmp_path / "labels.csv")).first()
    assert (row["case_id"], row["fee_status"], row["adjudication"]) == ("MIB-000001", "paid", "APPROVED")
    assert sorted(tuple(r) for r in tables.splits(spark, str(tmp_path / "splits.json")).collect()) == [("a", "dev"), ("b", "dev"), ("c", "holdout")]
    assert sorted(r[0] for r in tables.keys(spark, str(tmp_path / "keys.txt")).collect()) == ["one", "two"]


def test_word_tables_become_lines(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext"
    words = [(1, 1, 0, 0, 0, 0, 0, 0, 100, 200, -1, ""), (5, 1, 1, 1, 1, 1, 0, 20, 5, 5, 90, "Case"), (5, 1, 1, 1, 1, 2, 9, 21, 5, 5, 80, "ID"), (5, 1, 1, 1, 2, 1, 0, 50, 5, 5, 70.5, "x\"y"), (5, 1, 1, 1, 2, 2, 0, 50, 5, 5, -1, "lost"), (5, 1, 1, 1, 2, 3, 0, 50, 5, 5, 60, " ")]
    (tmp_path / "w.tsv").write_text("\n".join([head, *("\t".join(map(str, w)) for w in words)]))
    got = sorted((r["text"], r["mean"], r["n"], r["y"]) for r in tables.word_lines(spark, str(tmp_path / "w.tsv")).collect())
    assert got == [("Case ID", 85.0, 2, 0.1), ('x"y', 70.5, 1, 0.25)]


def test_caches_are_written_and_read_again(spark, tmp_path):
    one = {"page_no": 0, "visible_lines": ["x"], "hidden_lines": [], "struck": [], "ocr_lines": None, "reads": [], "image_count": 0}
    (tmp_path / "in.json").write_text("\n".join(json.dumps(x) for x in ({"_meta": {"v": "1"}}, {"stem": "a", "cost_ms": 1, "error": None, "pages": [one]}, {"stem": "b", "cost_ms": 2, "error": "boom", "pages": []})))
    cases = page_text.read_cases(spark, str(tmp_path / "in.json"))
    page_text.write_cases(cases, str(tmp_path / "out"), {"v": "2"})
    back = page_text.read_cases(spark, str(tmp_path / "out"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, cases.collect())) and back.count() == 2
    assert [tuple(r) for r in page_text.read_meta(spark, str(tmp_path / "out.meta")).collect()] == [("v", "2")]
