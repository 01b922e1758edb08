"""Token files against the tokenizers library itself, and their parts one by one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import zstandard

from plenum.llm import token_files, word_tokens
from plenum.llm.sentence_pieces import default_model

SCHEMA = "doc_id long, text string, id int, start int, frame string, `path` string"
TEXTS = [
    "plain words here", "", None, " lead", "trail ", "two  spaces", "tab\tand\nline \n x", "it's we'll I'd 've", "Été à l'été ▁ mark▁ a", "数字 漢字かな 12 345 6", "a<|endoftext|> b <|endoftext|>", "x\x1cy \x1c z \x85 w v   u　t",
    "🦄 emoji 👩‍👩‍👧 end", "nul\x00in side", "-- __ ## !!! a.b,c;d", "word " * 5000, "y" * 70_000, "r\r\nr\r r",
]


def rows():
    made = [(7 * k % 101, t, 1, 2, "f", "p") for k, t in enumerate(TEXTS)]
    return made + [(200, "same text", 1, 2, "f", "p")] * 2 + [(200, "other text", 1, 2, "f", "p"), (None, "no id", 1, 2, "f", "p"), (None, "no id", 1, 2, "f", "p"), (-5, "first of all", 1, 2, "f", "p")]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.default_tokenizer())


def want(made):
    """(doc_id, start, ids) by the plain library, rows that share an id in any order."""
    tok, at, out = library(), 0, []
    for i, t, *_ in sorted(made, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, ids))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def manifest(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('tokens')}/all"
    return token_files.write_tokens(spark.createDataFrame(rows(), SCHEMA).repartition(3), path)


def test_files_give_back_the_librarys_ids(manifest):
    got = sorted(((r["doc_id"], r["start"], list(r["ids"])) for r in token_files.read_tokens(manifest).collect()), key=lambda r: r[1])
    plain = want(rows())
    assert [r[0] for r in got] == [r[0] for r in plain]
    assert sorted(map(repr, ((r[0], r[2]) for r in got))) == sorted(map(repr, ((r[0], r[2]) for r in plain)))
    at = 0
    for _, start, ids in got:
        assert start == at
        at += len(ids)


def test_digests(manifest):
    by_start = {r["start"]: (r["doc_id"], list(r["ids"])) for r in token_files.read_tokens(manifest).collect()}
    for r in token_files.token_digests(manifest).collect():
        doc_id, ids = by_start[r["start"]]
        assert (r["doc_id"], r["n_tokens"], r["ids_crc32"]) == (doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_single_documents_are_fetched(spark, manifest):
    asked = spark.createDataFrame([(200,), (-5,), (7,), (7,), (99_999,), (None,)], "doc_id long")
    got = sorted((r["doc_id"], r["start"], list(r["ids"])) for r in token_files.fetch_tokens(manifest, asked).collect())
    whole = sorted((r["doc_id"], r["start"], list(r["ids"])) for r in token_files.read_tokens(manifest).collect() if r["doc_id"] in (200, -5, 7))
    assert got == whole and len(got) == 5
    assert token_files.fetch_tokens(manifest, asked.where("doc_id IS NULL")).count() == 0


def test_every_file_names_its_dictionary_and_reads_by_its_directory(manifest):
    for path in {r["path"] for r in manifest.collect()}:
        reader = token_files.ShardReader(path)
        folder = path.rpartition("/")[0].removeprefix("file://")
        data = open(f"{folder}/{reader.dictionary_sha.hex()}.zdict", "rb").read()
        assert hashlib.sha256(data).digest() == reader.dictionary_sha
        told = [(r["block"], r["frames_at"], r["ids_before"]) for r in manifest.collect() if r["path"] == path]
        assert sorted(told) == [(k, b["frames_at"], b["ids_before"]) for k, b in enumerate(reader.directory())]


def test_a_changed_dictionary_is_refused(spark, tmp_path):
    made = token_files.write_tokens(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), f"file://{tmp_path}/t")
    (old,) = (tmp_path / "t").glob("*.zdict")
    old.write_bytes(b"changed")
    with pytest.raises(Exception, match="dictionary"):
        token_files.read_tokens(made).collect()


def test_empty_table_and_blocks_of_few_documents(spark, tmp_path, monkeypatch):
    empty = token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/e")
    assert empty.count() == 0 and token_files.read_tokens(empty).count() == 0
    path = tmp_path / "x.tok"
    (tmp_path / f"{hashlib.sha256(b'').hexdigest()}.zdict").write_bytes(b"")
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 3)
    writer = token_files.ShardWriter(str(path), 2, hashlib.sha256(b"").digest())
    arrays = [np.arange(k, dtype="<u2") for k in range(1, 9)]
    for k, x in enumerate(arrays):
        writer.add(k, len(x), zstandard.ZstdCompressor().compress(x.tobytes()))
    blocks = writer.close()
    assert [b[5] for b in blocks] == [3, 3, 2] and [b[7] for b in blocks] == [0, 6, 21]
    reader = token_files.ShardReader(str(path))
    back = [x for b in blocks for x in reader.block(*b[2:5])]
    assert [(i, before, x.tolist()) for i, before, x in back] == [(k, k * (k + 1) // 2, list(range(k + 1))) for k in range(8)]


def test_a_shared_dictionary_makes_short_documents_smaller():
    rng = np.random.default_rng(1)
    common = [rng.integers(0, 50_000, 30).astype("<u2") for _ in range(20)]
    docs = [np.concatenate([common[k] for k in rng.integers(0, 20, 3)]).tobytes() for _ in range(3000)]
    dictionary = token_files.train(docs[:1000])
    with_it = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert sum(len(with_it.compress(d)) for d in docs[1000:]) < 0.5 * sum(len(zstandard.compress(d)) for d in docs[1000:])
    assert token_files.train([]) == b"" and token_files.train([b"ab", b"cd"]) == b"abcd"


def test_parts_remembered_are_bounded_and_change_nothing():
    tokens, tok = word_tokens.ByteTokens(token_files.default_tokenizer()), library()
    tokens.memo.most = 10
    texts = [t or "" for t in TEXTS]
    for _ in range(3):
        assert [x.tolist() for x in tokens(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(w) <= tokens.memo.longest for w in tokens.memo.known)
    assert tokens.parts("plain") and tokens.parts("a <|endoftext|>") is None and tokens.parts("\u0558") is None
    pieces = word_tokens.PieceTokens(default_model())
    assert pieces.plain
    assert [x.tolist() for x in pieces(texts)] == [pieces.codec.whole.encode(t) for t in texts]


def test_random_texts_of_odd_characters():
    rng, tok = random.Random(12), library()
    plain = word_tokens.ByteTokens(token_files.default_tokenizer(), plain_specials=True)
    tokens, pieces = word_tokens.ByteTokens(token_files.default_tokenizer()), word_tokens.PieceTokens(default_model())
    odd = list("ab  \n\t'sé.,-1²数\u2028\xa0\x1c▁𐐀\u0558🦄") + ["'ll", "<|endoftext|>", "  ", "the", "\r\n"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(400)]
    assert [x.tolist() for x in tokens(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in pieces(texts)] == [pieces.codec.whole.encode(t) for t in texts]
    tok.encode_special_tokens = True
    assert [x.tolist() for x in plain(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_pattern_cuts_every_sure_character_as_the_library_does():
    tok, own = library(), word_tokens.ByteTokens(token_files.default_tokenizer())
    sure = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x20000))) if not word_tokens.UNSURE.search(c)]
    assert len(sure) > 35_000
    for c in sure:
        text = f"a{c}1{c}. {c}  {c}"
        assert [text[p:q] for _, (p, q) in tok.pre_tokenizer.pre_tokenize_str(text)] == own.parts(text), repr(c)


def test_encoder_remembers_the_parts_of_several_batches(monkeypatch):
    monkeypatch.setattr(token_files.SparkFiles, "get", lambda name: token_files.default_tokenizer())
    monkeypatch.setattr(token_files, "_ENCODERS", {})
    memo, asked = token_files.encoder("any").memo, []
    memo.encode = lambda parts: asked.extend(parts) or [p.encode() for p in parts]
    batches = [[f" {k}" for k in range(first, first + 10_000)] for first in range(0, 120_000, 10_000)]
    for batch in [*batches, *batches]:
        assert memo([batch]) == ["".join(batch).encode()]
    assert len(asked) == 120_000
