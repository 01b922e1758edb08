import random

from plenum.llm import toxicity


def test_a_word_as_frequent_and_more_precise_replaces_its_beginning():
    counts = [("lose", 97, 13), ("loser", 97, 0), ("loser$", 97, 0), ("grob", 60, 2), ("grobn", 40, 0), ("grobn$", 20, 0)]
    assert toxicity.choose_terms(counts, 200) == ["grob", "loser$"]


def test_short_terms_admit_substitutions_that_civil_words_leave_free():
    lexicon = toxicity.Lexicon(["scum$", "blor", "dumb$"], loose=["scum$", "blor"])
    near = {"scvm": 1, "5cum": 1, "scums": None, "scm": None, "bl0rk": 1, "blor": 0, "dvmb": None}
    for word, edits in near.items():
        assert lexicon.nearest(word) == edits, word


def test_misspelled_insults_are_hits(spark):
    rng = random.Random(4)
    civil = ["".join(rng.choice("aeioutlnr") for _ in range(7)) for _ in range(200)]
    rows, labels = [], []
    for i in range(1_200):
        words = [rng.choice(civil) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["loser", "scum", "dumb"])
        elif i % 5 == 0:
            words[rng.randrange(30)] = rng.choice(["lose", "damb"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    nearest = toxicity.Lexicon(model.terms, loose=model.loose).nearest
    assert {w: nearest(w) for w in ("loser", "l0ser", "looser", "scum", "scvm", "dumb")} == {"loser": 0, "l0ser": 1, "looser": 1, "scum": 0, "scvm": 1, "dumb": 0}
    assert nearest("damb") is None and nearest("lose") != 0  # civil words


def edits(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
        row = new
    return row


def test_nearest_equals_plain_distances():
    rng = random.Random(8)
    terms = ["moron$", "stupid$", "blorkfee", "vilethug", "idiot$", "scum$", "veju"]
    lexicon = toxicity.Lexicon(terms, loose=["scum$"])

    def brute(word):
        found = [0 for t in terms if (word == t[:-1] if t.endswith("$") else word.startswith(t))]
        for t in terms:
            letters = t.rstrip("$")
            if lexicon.tolerance(t):
                row = edits(letters, word)
                found.append(row[-1] if t.endswith("$") else min(row))
            elif t == "scum$" and len(word) == 4:
                found.append(sum(a != b for a, b in zip(word, letters, strict=True)))
        return min((d for d in found if d <= 1), default=None)

    for _ in range(4000):
        letters = list(rng.choice(terms).rstrip("$") + rng.choice(["", "", "s", "ish"]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(letters) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                letters.insert(at, rng.choice("abcxyz"))
            elif at < len(letters):
                if kind == 1:
                    del letters[at]
                else:
                    letters[at] = rng.choice("aeiouzq")
        word = "".join(letters)
        assert lexicon.nearest(word) == brute(word), word


def test_memory_does_not_change_scores():
    model = toxicity.Model(["moron$", "blorkfee"], [-1.0, 1, 1, 1, 1, 1], 0.1)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["moron", "moronn,", "a", "word", "blorkfeeb", "\"x\"", "you"]) for _ in range(30)) for _ in range(50)] + ["", "moron " * 50_000]
    few, many = toxicity.Scorer(model, 2), toxicity.Scorer(model, 10_000)
    assert [few.score(t) for t in texts] == [many.score(t) for t in texts]


def test_repeated_labels_and_documents_and_an_empty_table(spark):
    docs = spark.createDataFrame([(i, ("vilethug " if i % 2 else "calm ") * 8) for i in range(80)] * 2, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(i, 0) for i in range(80)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.scores(docs, model).collect()
    assert len(got) == 160 and all((r["score"] >= 0.3) == (r["doc_id"] % 2 == 1) for r in got)
    assert toxicity.scores(docs.limit(0), model).count() == 0
    none = toxicity.learn(docs, marks.where("toxic = 0"))
    assert {r["score"] for r in toxicity.scores(docs, none).collect()} == {0.0}


def test_held_out_documents_of_the_given_table(spark):
    """On the given labels (some 4,000): toxic held-out documents that are caught, civil ones that are left alone."""
    import os

    import pytest

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("the given tables are not here")
    got = toxicity.op9_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic, civil = [r for r in got if r["toxic"] == 1], [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic) and sum(r["predicted"] for r in civil) <= 0.1 * len(civil)
