"""The transducer against plain byte offsets, and the query's columns against a plain count of all links."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from plenum.llm import token_alignment
from plenum.llm.sentence_pieces import MARK, default_model
from plenum.llm.token_files import default_tokenizer
from plenum.llm.word_tokens import ByteTokens

SCHEMA = "doc_id long, text string, id int, n_a string, codes int, `text.x` int"
TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "", None, " lead", "trail ", "two  spaces and   three", "tab\tand\nline \n x", "Été à l'été naïve œuvre", "数字 漢字かな 12 345 6",
    "a<|endoftext|> b <s> </s> <unk> <0x41> x", f"a mark {MARK} inside", "🦄 emoji 👩‍👩‍👧 end", "nul\x00in", "the the the The", "internationalisation 1234567890", "x" * 5000, " \n\t ", "é" * 300,
]


def rows():
    rng = random.Random(8)
    words = "the of and über Straße données 2024 e.g. co-operate naïve 東京 don't (x) — …".split()
    more = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    made = [(k, t) for k, t in enumerate(TEXTS + more)]
    return [(*r, 1, "n", 2, 3) for r in [*made, (7, more[0]), (7, more[0]), (None, "no id at all")]]


def plain_tokens(text):
    """(ids, bytes) of both sides by the libraries alone, or None."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(plain_tokens, "models"):
        tok = Tokenizer.from_file(default_tokenizer())
        tok.encode_special_tokens = True
        plain_tokens.models = tok, SentencePieceProcessor(model_file=default_model()), ByteTokens(default_tokenizer()).token_bytes()
    tok, sp, a_bytes = plain_tokens.models
    if not text:
        return None
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    of_b = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace(MARK, " ").encode() for k in b]
    of_a = [a_bytes[k] for k in a]
    return ((a, of_a), (b, of_b)) if b"".join(of_a) == b"".join(of_b) == (" " + text).encode() else None


def plain(made):
    docs, counts = [], Counter()
    for i, t, *_ in made:
        tokens = plain_tokens(t)
        if tokens is None:
            docs.append((i, 0, 0, 0, [], ""))
            continue
        ends = [list(np.cumsum([len(x) for x in side[1]])) for side in tokens]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, low = [], [], 0
        for edge in both:
            ids = [[k for k, e in zip(side[0], side_ends, strict=True) if low < e <= edge] for side, side_ends in zip(tokens, ends, strict=True)]
            groups.append("|".join(",".join(map(str, x)) for x in ids))
            links += [(a, b) for a, ea in zip(tokens[0][0], ends[0], strict=True) if ea == edge for b, eb in zip(tokens[1][0], ends[1], strict=True) if eb == edge]
            low = edge
        counts.update(links)
        docs.append((i, len(tokens[0][0]), len(tokens[1][0]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(((i, a, b, g, len(x), sum(counts[p] == highest[p[1]] for p in x), sum(counts[p] for p in x), sha) for i, a, b, g, x, sha in docs), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def test_digests_equal_the_plain_count(docs):
    got = sorted((tuple(r) for r in token_alignment.alignment_digests(docs).collect()), key=repr)
    assert got == plain(rows())
    assert sum(r[1] == 0 for r in got) == 3  # the empty one, the null one and the one with a mark


def test_groups_as_ids_and_ends(docs):
    shas = Counter((r["doc_id"], r["groups_sha256"]) for r in token_alignment.alignment_digests(docs).collect())
    for r in token_alignment.align_tokens(docs).collect():
        starts = zip([0, *r["a_ends"]], r["a_ends"], [0, *r["b_ends"]], r["b_ends"], strict=False)
        shown = ";".join(f"{','.join(map(str, r['a_ids'][p:q]))}|{','.join(map(str, r['b_ids'][s:t]))}" for p, q, s, t in starts)
        shas[r["doc_id"], hashlib.sha256(shown.encode()).hexdigest() if shown else ""] -= 1
    assert not any(shas.values())


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_alignment.alignment_digests(empty).count() == 0 and token_alignment.align_tokens(empty).count() == 0


@pytest.mark.parametrize("most", [3, 500_000])
def test_transducer_against_offsets_with_little_memory(most):
    rng = random.Random(2)
    spelled = [[bytes(rng.choices(b"ab", k=rng.randrange(1, 4))) for _ in range(12)] + [b"a", b"b"] for _ in range(2)]
    machine = token_alignment.Transducer(*spelled, most=most)

    def tokens(text, side):
        out = []
        while text:
            fits = [k for k, x in enumerate(spelled[side]) if text.startswith(x)]
            out.append(rng.choice(fits))
            text = text[len(spelled[side][out[-1]]) :]
        return out

    for _ in range(200):
        text = bytes(rng.choices(b"ab", k=rng.randrange(0, 60)))
        a, b = tokens(text, 0), tokens(text, 1)
        ends = [np.cumsum([len(spelled[s][k]) for k in x]).tolist() if x else [] for s, x in enumerate((a, b))]
        both = sorted(set(ends[0]) & set(ends[1]))
        assert machine.groups(a, b) == ([ends[0].index(e) + 1 for e in both], [ends[1].index(e) + 1 for e in both])
        assert machine.known <= most


def test_different_bytes_are_an_error():
    with pytest.raises(ValueError, match="different"):
        token_alignment.Transducer([b"a"], [b"b"]).groups([0], [0])


def test_sums_of_pairs_with_a_small_buffer():
    rng = np.random.default_rng(3)
    sums, want = token_alignment.PairSums(most=10), Counter()
    for _ in range(50):
        codes, counts = np.unique(rng.integers(0, 30, 12)), None
        counts = rng.integers(1, 5, len(codes))
        sums.add(codes, counts)
        want.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
    sums.merge()
    assert dict(zip(sums.codes.tolist(), sums.counts.tolist(), strict=True)) == want
    empty = token_alignment.PairSums()
    empty.merge()
    assert len(empty.codes) == 0
