"""Column functions for the small languages of ids, dates, names and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Glyphs misread for digits, in order, and the digits they stand for.
GLYPHS = "OoQlIi|STZBG"
DIGITS = "000111157286"
_CELL = r"[0-9OoQlIi|STZBG]"
_DASH = r"[-–—:\s]"

CASE_ID = r"MIB-[0-9]{6}"
SPONSOR_ID = r"SPN-[0-9]{4}"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def normal(text: Column) -> Column:
    """Stripped, white space collapsed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def alnum(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def case_ids(text: Column) -> Column:
    """All well-formed case ids, duplicates and order kept."""
    return F.regexp_extract_all(text, F.lit(rf"\b({CASE_ID})\b"), F.lit(1))


def sponsor_ids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"\b({SPONSOR_ID})\b"), F.lit(1))


def iso_dates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"\b({ISO_DATE})\b"), F.lit(1))


def is_whole(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


def _repaired(cell: Column) -> Column:
    return F.translate(cell, GLYPHS, DIGITS)


def coerce_case_id(text: Column) -> Column:
    """A well-formed case id from a misread one, or null; never a half-repaired value."""
    cell = F.regexp_extract(F.trim(text), rf"(?i)M[iI1l]B{_DASH}*({_CELL}{{6}})", 1)
    return F.when(is_whole(_repaired(cell), "[0-9]{6}"), F.concat(F.lit("MIB-"), _repaired(cell)))


# Fixed value: what a sponsor id is read as.
_SPONSOR_LIKE = rf"[Ss5][PpFf][NnHhMm][-–—:.\s]*({_CELL}{{4}})"


def coerce_sponsor_id(text: Column) -> Column:
    cell = _repaired(F.regexp_extract(F.trim(text), _SPONSOR_LIKE, 1))
    return F.when(is_whole(cell, "[0-9]{4}"), F.concat(F.lit("SPN-"), cell))


def coerce_sponsor_ids(text: Column) -> Column:
    """All sponsor ids that can be rebuilt, in order."""
    cells = F.transform(F.regexp_extract_all(text, F.lit(_SPONSOR_LIKE), F.lit(1)), _repaired)
    return F.transform(F.filter(cells, lambda c: is_whole(c, "[0-9]{4}")), lambda c: F.concat(F.lit("SPN-"), c))


def coerce_date(text: Column, last_year: int = 2026) -> Column:
    """An ISO date from a misread one; a year past the last possible one becomes the last."""
    pattern = r"([0-9]{4})[-–—/.]([0-9]{2})[-–—/.]([0-9]{2})"
    year, month, day = (F.regexp_extract(F.trim(text), pattern, k) for k in (1, 2, 3))
    fixed = F.when(year.cast("int") > last_year, F.lit(str(last_year))).otherwise(year)
    return F.when(year != "", F.concat_ws("-", fixed, month, day))


def valid_date(text: Column, first_year: int = 2020, last_year: int = 2026) -> Column:
    """A real calendar day in the window of years."""
    day = F.when(is_whole(text, ISO_DATE), F.try_to_date(text, "yyyy-MM-dd"))
    return F.coalesce(F.year(day).between(first_year, last_year), F.lit(False))


def one_glyph_apart(a: Column, b: Column) -> Column:
    """Same length and at most one place that differs."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    return (F.length(a) == F.length(b)) & (F.aggregate(pairs, F.lit(0), lambda s, x: s + x) <= 1)


def stands_in(value: Column, text: Column) -> Column:
    """Value inside text at token boundaries; null for values that say nothing."""
    v = F.lower(F.trim(value))
    quoted = F.regexp_replace(v, r"([^a-z0-9 ])", r"\\$1")
    found = F.rlike(F.lower(text), F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])")))
    return F.when(~v.isin("", "none", "unknown", "n/a"), found)


def edge_strip(text: Column) -> Column:
    """Each token without the marks at its ends."""
    return F.array_join(F.transform(F.split(normal(text), " "), lambda t: F.regexp_replace(t, "^[^a-z0-9]+|[^a-z0-9]+$", "")), " ")


def name_strokes(text: Column) -> Column:
    """Names that differ only by strokes often misread share one key."""
    return F.regexp_replace(F.regexp_replace(text, "rn", "m"), r"ri\b", "n")


def waiver_code(*parts: Column) -> Column:
    """The first part that isn't empty; `n/a` and `none` say that there is no code."""
    v = F.coalesce(*[F.when(F.trim(p) != "", F.trim(p)) for p in parts], F.lit(""))
    return F.when(F.lower(v).isin("n/a", "none"), "").otherwise(v)


def split_line(line: Column) -> tuple[Column, Column]:
    """Label and value of a `Label: value` line, else empty strings."""
    pattern = r"^([A-Za-z0-9][A-Za-z _0-9]{1,28}?)\s*[:.;]\s*(.+)$"
    return F.lower(F.regexp_extract(line, pattern, 1)), F.trim(F.regexp_extract(line, pattern, 2))


# Quotes that readings scatter, and what the prefixes of ids are read as.
STRAY_QUOTES = "‘’“”"
READ_AS_MIB = r"\bM[iI1l][bB]-"
READ_AS_SPN = r"\b[S5]PN[-–—]"


def clean_ocr_line(line: Column) -> Column:
    """A line without stray quotes and leading junk, the prefixes of ids put right."""
    plain = F.regexp_replace(F.translate(line, STRAY_QUOTES, ""), "^[^A-Za-z0-9]+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, READ_AS_MIB, "MIB-"), READ_AS_SPN, "SPN-"))
