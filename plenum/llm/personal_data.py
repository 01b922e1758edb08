"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over the text finds anchors: at-signs, plus signs, digits, URL
schemes and identifier cues. From each anchor a small deterministic parser expands to the left and right
and validates what it has found. No parser reads a stretch again that it has settled before, so the work
grows with the length of the text whatever the text holds.

Base kinds, leftmost and non-overlapping within each kind (a match that fails its check is dropped and
not retried): email, ip (four parts of at most 255), card (14 to 19 digits passing Luhn), phone (10 to 15
digits after a plus sign). Added kinds: login (URL with user and password), iban (mod 97 right), account
(a number with at least six digits after a cue), handle (a name after a lone at-sign).
What an added kind admits is part of what it is: user names and passwords of up to 128 characters and hosts of up to 253 in a
login, numbers of 6 to 34 digits and up to three words or signs between cue and number in an account, up to three
other characters before an iban, names of 3 to 30 characters in a handle. Base kinds have no such bounds.

Defined cases
- null and empty texts: no spans. Empty table: empty result. Repeated rows: each by itself.
- offsets count code points, ends are exclusive; spans are ordered by start, then kind as listed.
- extra columns are ignored. Very long texts: time and memory grow with the length only.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from plenum.llm._shared import named, text_or_empty

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account", "handle")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "ssn")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_RUN = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:]{1,128}:[^\s/@]{1,128}@[A-Za-z0-9.-]{1,253}")
_IBAN = re.compile(r"[^A-Za-z0-9]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
_IBAN_SIZE = {c[:2]: int(c[2:]) for c in "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SE24 SI19 SK24 SM27 TN24 TR26 UA29 VA22 VG24 XK20".split()}
_NUMBER = re.compile(r"(?:[ \t]*(?:number|no\.?|nr\.?|num\.?|#|:|=)){0,3}[ \t]*([0-9](?:[ -]?[0-9]){5,33})(?![0-9A-Za-z])", re.IGNORECASE)
_HANDLE = re.compile(r"[A-Za-z][A-Za-z0-9_]{2,29}(?![A-Za-z0-9_@])")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _mod97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _iban_size(found: str) -> int:
    """Characters of the IBAN that `found` begins with, 0 if none; a capital word may have been taken with it."""
    ends = [len(found), *[k for k in range(len(found) - 1, 0, -1) if found[k] == " "]]
    sizes = {end: len(found[:end].replace(" ", "")) for end in ends}
    # The end that the country asks for comes first, then the farthest.
    for end in sorted(ends, key=lambda e: (sizes[e] != _IBAN_SIZE.get(found[:2]), -e)):
        if 15 <= sizes[end] <= 34 and _mod97(found[:end].replace(" ", "")):
            return end
    return 0


class Finder:
    """Finds spans in one text after another."""

    def __init__(self) -> None:
        import ahocorasick

        anchors = ahocorasick.Automaton()
        for c in "0123456789":
            anchors.add_word(c, (1, "digit"))
        anchors.add_word("@", (1, "at"))
        anchors.add_word("+", (1, "plus"))
        for scheme in SCHEMES:
            anchors.add_word(scheme, (len(scheme), "scheme"))
        for cue in CUES:
            for form in (cue, cue.upper(), cue.capitalize()):
                anchors.add_word(form, (len(form), "cue"))
        anchors.make_automaton()
        self.anchors = anchors

    def __call__(self, text: str) -> list[Span]:
        spans: list[Span] = []
        floor = ip_next = card_next = phone_next = cue_next = 0
        for last, (size, anchor) in self.anchors.iter(text):
            at = last + 1 - size
            if anchor == "digit":
                if at >= ip_next:
                    m = _IP.match(text, at)
                    if m:
                        ip_next = m.end()
                        if all(map(_byte, m.group().split("."))):
                            spans.append(Span(at, 1, ip_next))
                    else:
                        ip_next = _RUN.match(text, at).end()
                if at >= card_next:
                    m = _CARD.match(text, at)
                    card_next = m.end() if m else at + 1
                    if m:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            spans.append(Span(at, 2, card_next))
            elif anchor == "at":
                start = floor + len(text[floor:at].rstrip(_LOCAL))
                floor = at + 1
                domain = _DOMAIN.match(text, at + 1) if start < at else None
                if domain:
                    floor = domain.end()
                    spans.append(Span(start, 0, floor))
                elif start == at and (at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "@")):
                    m = _HANDLE.match(text, at + 1)
                    if m:
                        spans.append(Span(at, 7, m.end()))
            elif anchor == "plus":
                if at >= phone_next:
                    m = _PHONE.match(text, at)
                    if m:
                        phone_next = m.end()
                        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                            spans.append(Span(at, 3, phone_next))
            elif anchor == "scheme":
                m = _LOGIN.match(text, last + 1)
                if m:
                    spans.append(Span(at, 4, m.end()))
            elif at >= cue_next and (at == 0 or not text[at - 1].isalnum()):
                m = _IBAN.match(text, last + 1)
                if m and (size := _iban_size(m.group(1))):
                    spans.append(Span(m.start(1), 5, m.start(1) + size))
                    cue_next = m.start(1) + size
                elif m := _NUMBER.match(text, last + 1):
                    spans.append(Span(m.start(1), 6, m.end(1)))
                    cue_next = m.end()
        spans.sort()
        return spans


_FINDER: list[Finder] = []


def finder() -> Finder:
    """One finder for each worker process."""
    if not _FINDER:
        _FINDER.append(Finder())
    return _FINDER[0]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, found: array of (kind, start, end) in each text."""
    slim = docs.select(named(id_col), text_or_empty(text).alias("text"))
    kind = slim.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        find = finder()
        for batch in batches:
            found = [[{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in find(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], [id_col, "found"])

    return slim.mapInArrow(run, f"`{id_col}` {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns, every span of the text replaced by its kind in brackets (of overlapping ones, the first)."""
    names = docs.columns

    def run(batches):
        find = finder()
        at = names.index(text)
        for batch in batches:
            out = []
            for item in batch.column(at):
                body, done, parts = item.as_py(), 0, []
                for s in find(body or ""):
                    if s.start >= done:
                        parts += [body[done : s.start], f"[{KINDS[s.kind]}]"]
                        done = s.end
                out.append(None if body is None else "".join(parts) + body[done:])
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def digests(found: list[Span]) -> tuple[list[int], str, str]:
    """(counts of the base kinds, SHA-256 of the base spans, all spans) as one document's row shows them."""
    counts = [sum(s.kind == k for s in found) for k in range(len(BASE))]
    shown = [f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in found]
    base = ",".join(x for x, s in zip(shown, found, strict=True) if s.kind < len(BASE))
    return counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(shown)


def op5_personal_data(spark, sf_dir: str) -> DataFrame:
    slim = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_or_empty("text").alias("text"))

    def run(batches):
        find = finder()
        for batch in batches:
            rows = [digests(find(t.as_py())) for t in batch.column(1)]
            counts = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(BASE))]
            texts = [pa.array([r[k] for r in rows], pa.string()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *texts], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return slim.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
