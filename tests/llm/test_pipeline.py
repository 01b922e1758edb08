"""The pipeline's stages against brute force, each on its own input."""

import hashlib

import pytest

from tests.llm.test_operators import SCHEMA, brute_components, corpus, squeezed

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, tmp_path):
    rows = [r[:5] for r in corpus(seed=21, n=80)]
    schema = ", ".join(SCHEMA.split(", ")[:5])
    docs = spark.createDataFrame(rows, schema).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 0, 0) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentence_pieces"]
    civil = stages["toxicity"](spark, docs, str(tmp_path))
    assert civil.columns == docs.columns and civil.count() == len(rows)  # none is marked toxic

    single = stages["exact_dedup"](spark, civil, str(tmp_path))
    first = {}
    for r in rows:
        first[squeezed(r[1])] = min(r[0], first.get(squeezed(r[1]), r[0]))
    kept = [tuple(r) for r in single.collect()]
    assert single.columns == docs.columns and {r[0] for r in kept} == set(first.values())

    apart = stages["near_dedup"](spark, spark.createDataFrame(kept, schema), str(tmp_path))
    want = {i for i, (_, root) in brute_components(kept, 80).items() if i == root}
    assert {r["doc_id"] for r in apart.collect()} == want

    mixed = stages["mixing"](spark, apart, str(tmp_path))
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= want

    from sentencepiece import SentencePieceProcessor

    from plenum.llm.sentence_pieces import default_model

    library = SentencePieceProcessor(model_file=default_model())
    texts = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    got = stages["sentence_pieces"](spark, mixed, str(tmp_path)).collect()
    expected = sorted((i, hashlib.sha256(",".join(map(str, library.encode(t or ""))).encode()).hexdigest()) for i, t in texts)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in got) == expected
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in pipeline.run(spark, str(tmp_path)).collect()) == expected


ODD = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, row string, id int, th long, copy int, n long, m map<string,int>"


def odd(rows):
    return [(i, t, None, s, 0, 1, "r", 2, 3, 4, 5, {"k": i or 0}) for i, t, s in rows]


def test_toxic_rows_go_and_civil_ones_stay(spark, tmp_path):
    import random

    from plenum.llm import toxicity

    rng = random.Random(6)
    civil = ["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(civil) for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["vilethug", "grobnik"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0, int(i % 4 == 0)))
    rows += [(rows[0][0], rows[0][1], "s"), (None, "vilethug " * 3, None), (700, None, "s"), (701, "", "s")]
    docs = spark.createDataFrame(odd(rows), ODD)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = dict(pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path))
    assert kept.schema.simpleString() == docs.schema.simpleString()
    scorer = toxicity.Scorer(toxicity.learn(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    want = [(i, t) for i, t, _ in rows if scorer.score(t or "") < toxicity.THRESHOLD]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert {i for i, _ in want} == {i for i, _, _ in rows if i is not None and (i % 4 or i > 600)}


def test_empty_tables_pass_all_stages(spark, tmp_path):
    spark.createDataFrame([], ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_odd_names_pass_all_stages(spark, tmp_path):
    words = "one two three four five six seven eight nine ten"
    rows = [(1, words, "s"), (1, words, "s"), (2, words + "  more", "s"), (None, words, None), (None, "p q r s t u v w", "t"), (3, "", "s"), (4, None, "s"), (5, "far away from all the other texts here", "t")]
    spark.createDataFrame(odd(rows), ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        if name != "sentence_pieces":
            assert made.schema.simpleString() == docs.schema.simpleString(), name
        if name == "near_dedup":
            # The copy with more words is as near as 6 of 7 shingles; of the rows without words one is left.
            assert sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in made.collect()) == [(0, "p q"), (1, "one"), (3, ""), (5, "far")]
        docs = spark.createDataFrame(made.collect(), made.schema)
    assert {r["doc_id"] for r in docs.collect()} <= {None, 1, 3, 5} and "ids_sha256" in docs.columns
