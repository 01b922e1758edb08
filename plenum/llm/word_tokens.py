"""Token ids of whole texts by public tokenizers.

A byte-level tokenizer cuts a text by its pattern and merges within the parts only, so a text's ids are those of its
parts in turn. The parts are found by the same pattern here, and the library's model encodes those that aren't
remembered, many in a row: the bytes that each id stands for tell where a part ends. Where a model's settings, a
special token or characters on which Unicode versions differ leave a doubt, a text is given to the library whole.
What is remembered is bounded and no result depends on it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np

from plenum.llm.sentence_pieces import MARK, PieceCodec

#: Characters outside the blocks in which old and new versions of Unicode agree on letters, numbers and white space.
UNSURE = re.compile("[^\x00-\u0557\u2000-\u206f\u20a0-\u20bf\u2100-\u2bff\u3000-\u9fff\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001faff]")
#: Parts remembered in a worker (twice as many at most), and the longest of them in characters.
REMEMBERED = 30_000
LONGEST = 48
#: Parts that are given to a model in one text.
TOGETHER = 1000
#: Characters of text that are encoded at once.
AT_ONCE = 4 << 20


def slices(column, most: int = AT_ONCE) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of an Arrow column's texts, a bounded number of characters at a time; null: empty."""
    first, held, size = 0, [], 0
    for k, item in enumerate(column):
        text = item.as_py() or ""
        if held and size + len(text) > most:
            yield first, held
            first, held, size = k, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


class PartMemo:
    """Serialised ids of texts that are given as parts, from a function that encodes many parts at once.

    When it is full, what has been asked for since it last was stays a while longer.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = REMEMBERED, longest: int = LONGEST) -> None:
        self.encode, self.most, self.longest = encode, most, longest
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[list[str]]) -> list[bytes]:
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*texts).difference(known)
        known.update((w, older[w]) for w in new.intersection(older))
        new = list(new.difference(older))
        known.update(zip(new, self.encode(new), strict=True))
        out = [b"".join(map(known.__getitem__, parts)) for parts in texts]
        for part in new:
            if len(part) > self.longest:
                del known[part]
        return out


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteTokens:
    """Ids by a tokenizers file. `plain_specials`: special tokens' strings inside texts are plain text."""

    def __init__(self, path: str, plain_specials: bool = False, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.spelled = self._spelled(vocabulary)
        self.widths = np.array([len(x) for x in self.spelled], np.int64)
        self.pattern, self.latin = self._patterns(spec, vocabulary)
        added = [t["content"] for t in spec.get("added_tokens", []) if not plain_specials or not t["special"]]
        self.special = re.compile("|".join(map(re.escape, added))).search if added else (lambda text: None)
        # The same model without the cutting; parts are told apart by a space, which byte-level characters never are.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        shown = {b: c for c, b in _byte_of().items()} | {0xFF: " "}  # no UTF-8 text holds this byte
        self.shown = str.maketrans({chr(b): c for b, c in shown.items()})
        self.memo = PartMemo(self._encode, remembered)

    @staticmethod
    def _spelled(vocabulary: dict[str, int]) -> list[bytes]:
        byte_of, out = _byte_of(), [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            out[k] = bytes(byte_of.get(c, 0) for c in token)
        return out

    @staticmethod
    def _patterns(spec: dict, vocabulary: dict[str, int]):
        """Functions that cut any text, and one of Latin-1, into the parts that are merged by themselves; None if the settings leave a doubt."""
        parting, model = spec.get("pre_tokenizer") or {}, spec["model"]
        free = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        plain = spec.get("normalizer") is None and spec.get("post_processor") is None and all(c in vocabulary for c in _byte_of())
        cuts = parting.get("type") == "ByteLevel" and parting.get("use_regex", True) and not parting.get("add_prefix_space")
        if not (free and plain and cuts):
            return None, None
        import public_tokenizers
        import regex

        pattern = public_tokenizers.PATTERN
        # Classes spelled out are found faster, and letters first: no other alternative begins as theirs do.
        letters, numbers, spaces = ("".join(re.escape(chr(c)) for c in range(256) if regex.match(k, chr(c))) for k in (r"\p{L}", r"\p{N}", r"\s"))
        latin = "|".join(sorted(pattern.split("|"), key=lambda x: not x.startswith(r" ?\p")))
        latin = latin.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\S", f"[^{spaces}]")
        latin = latin.replace(r"\s", f"[{spaces}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        return regex.compile(pattern).findall, re.compile(latin).findall

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(parts), TOGETHER):
            raw = [p.encode("utf-8", "replace") for p in parts[k : k + TOGETHER]]
            shown = b"\xff".join(raw).decode("latin-1").translate(self.shown)
            ids = np.asarray(self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum([len(x) for x in raw])) + 1
            data, width, at = ids.tobytes(), self.dtype.itemsize, 0
            for end in (ends * width).tolist():
                out.append(data[at:end])
                at = end
        return out

    def parts(self, text: str) -> list[str] | None:
        """None if the text is to be encoded whole."""
        if self.pattern is None or self.special(text):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None if UNSURE.search(text) else self.pattern(text)
        return self.latin(text)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        parted = [self.parts(t) for t in texts]
        made = self.memo([p or [] for p in parted])
        return [np.frombuffer(self._whole(t) if p is None else x, self.dtype) for t, p, x in zip(texts, parted, made, strict=True)]

    def token_bytes(self) -> list[bytes]:
        """What each id stands for."""
        return self.spelled


class PieceTokens:
    """Ids by a piece model, without begin or end ids. The library is fast on whole texts, so nothing is remembered."""

    def __init__(self, path: str) -> None:
        self.codec = PieceCodec(path)
        self.plain = not self.codec.normalize.map.units and not self.codec.normalize.squeeze and self.codec.normalize.prefix
        self.size = self.codec.whole.get_piece_size()
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")

    def _ids(self, text: str) -> np.ndarray:
        if not text or not self.plain:
            return self.codec.encode(text).ids
        parts = [self.codec.merger.encode_as_numpy(x) for x in self.codec.parts(MARK + text.replace(" ", MARK))]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(t).astype(self.dtype) for t in texts]

    def token_bytes(self) -> list[bytes]:
        """What each id stands for: byte pieces their byte, marks a space."""
        model = self.codec.whole
        names = [model.id_to_piece(k) for k in range(self.size)]
        return [bytes([int(n[3:5], 16)]) if model.is_byte(k) else n.replace(MARK, " ").encode() for k, n in enumerate(names)]
