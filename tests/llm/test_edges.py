"""Empty tables, null and repeated ids, odd names and very long texts, for operators that give a row for each row."""

import random
from collections import Counter

import pytest

from plenum.llm import language_model, mixing, personal_data, quality_rules, sentence_pieces, sharding

OPERATORS = {
    "pieces": sentence_pieces.piece_digests, "encode": sentence_pieces.encode, "personal": personal_data.find_personal_data, "quality": quality_rules.quality,
    "language": language_model.score, "mix": mixing.mix_counts, "shard": sharding.shard,
}
SCHEMA = "doc_id long, text string, source string, `a.b` int, id int, held boolean, block long, shard int, size long, host string"


def rows():
    rng = random.Random(4)
    words = [rng.choice(["mail a@b.co", "10.0.0.1", "word", "Été", "the"]) for _ in range(60_000)]
    texts = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, ""), (3, " \t\n"), (4, "🦄 a@b.co"), (5, " ".join(words)), (6, "x" * 300_000)]
    return [(i, t, None if i is None else "s", 1, 2, True, 3, 4, 5, "h") for i, t in texts]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(spark, name):
    made = OPERATORS[name](spark.createDataFrame(rows(), SCHEMA).repartition(3))
    assert Counter(r["doc_id"] for r in made.collect()) == Counter(r[0] for r in rows())
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0
