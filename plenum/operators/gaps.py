"""What the readings of a page still lack: page scores, short values, and properties of cases.

Input is one row per line: (case_id, page_no, seq, line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions import fuzzy, grammar, snap
from plenum.functions.labels import NEAR, resolve_head
from plenum.operators.quarantine import is_injection

# The score below which a page is weak, the characters below which a value is torn, the words of
# watermarks, and the similarity from which a head is a label.
WEAK, TORN, LABEL_BAR = 6, 3, 0.80
WATERMARK = r"(?i)\b(sample|denial|specimen|copy|void)\b"
#: Labels whose values are never short, so that a short one is torn.
LONG_VALUED = ("case id", "applicant", "purpose", "declared purpose", "species code", "home world", "visa class", "sponsor id", "arrival date", "registry name", "observed flags")
WORDS = (*snap.VISAS, *snap.SPECIES, *snap.WORLDS, *snap.FLAGS)
PAGE = ["case_id", "page_no"]


def page_scores(lines: DataFrame) -> DataFrame:
    """(case_id, page_no, seq, score): lines led by a label, near ones too, plus id-like tokens, plus distinct known words."""
    kept = lines.where(~is_injection(F.col("line")) & ~F.col("line").rlike(WATERMARK))
    head = F.lower(F.trim(F.regexp_extract("line", r"^([^:.;]*)", 1)))
    several = F.size(F.filter(F.split("line", r"\s+"), lambda w: w != "")) >= 2
    heads = fuzzy.on_distinct(kept.withColumn("head", F.when(several, head)), "head", lambda v: v.withColumn("label", resolve_head("__v")), "label")
    ids = F.regexp_count("line", F.lit(rf"\b(?:{grammar.CASE_ID}|{grammar.SPONSOR_ID}|{grammar.ISO_DATE})\b"))
    said = F.array_compact(F.array(*[F.when(F.col("line").rlike(rf"\b{w}\b"), F.lit(w)) for w in WORDS]))
    scored = heads.select(*PAGE, "seq", F.col("label.near").isNotNull().cast("long").alias("led"), ids.cast("long").alias("ids"), said.alias("said"))
    g = scored.groupBy(*PAGE, "seq").agg(F.sum("led").alias("led"), F.sum("ids").alias("ids"), F.array_distinct(F.flatten(F.collect_set("said"))).alias("said"))
    return g.select(*PAGE, "seq", (F.col("led") + F.col("ids") + F.size("said")).alias("score"))


def weak_pages(lines: DataFrame, pages: DataFrame, bar: int = WEAK) -> DataFrame:
    """(case_id, page_no) of `pages` of which no reading scores as much as the bar; pages without readings are weak."""
    best = page_scores(lines).groupBy(F.col("case_id").alias("bc"), F.col("page_no").alias("bp")).agg(F.max("score").alias("best"))
    return pages.join(best, (F.col("case_id") == F.col("bc")) & (F.col("page_no") == F.col("bp")), "left").where(F.coalesce("best", F.lit(0)) < bar).select(*PAGE)


def torn_labels(lines: DataFrame, least: int = TORN) -> DataFrame:
    """(case_id, page_no, label): labels whose longest value over all readings of the page has at most `least` characters.

    Only labels whose values are never short are told of, and only lines of two words or more are looked at.
    """
    parts = F.split("line", "[:.;]", 2)
    several = F.size(F.filter(F.split("line", r"\s+"), lambda w: w != "")) >= 2
    shown = lines.where(~is_injection(F.col("line")) & several & (F.size(parts) == 2)).select(*PAGE, F.lower(F.trim(F.get(parts, F.lit(0)))).alias("head"), F.length(F.regexp_replace(F.get(parts, F.lit(1)), r"\s", "")).alias("size"))
    heads = shown.select("head").where("head <> ''").distinct()
    pairs = heads.select("head", F.explode(F.array(*[F.struct(F.lit(k).alias("nth"), F.lit(x).alias("label")) for k, x in enumerate(LONG_VALUED)])).alias("x")).select("head", "x.*")
    # Lengths alone rule most pairs out.
    fits = F.abs(F.length("head") - F.length("label")) <= (1 - LABEL_BAR) * F.greatest(F.length("head"), F.length("label"))
    near = pairs.where(fits).where(fuzzy.weighted_similarity(F.col("head"), F.col("label")) >= LABEL_BAR).groupBy(F.col("head").alias("h")).agg(F.min_by("label", "nth").alias("label"))
    return shown.join(near, F.col("head") == F.col("h")).groupBy(*PAGE, "label").agg(F.max("size").alias("size")).where(F.col("size") <= least).select(*PAGE, "label")


def coverage(pages: DataFrame, decided: DataFrame) -> DataFrame:
    """(case_id, scanned, inferred, hidden): does a case have a scanned page, a flag that no reading states, hidden text?

    `pages` has case_id, is_scan_only, hidden_lines; `decided` has case_id, flags, emitted.
    """
    g = pages.groupBy("case_id").agg(F.bool_or("is_scan_only").alias("scanned"), F.bool_or(F.size("hidden_lines") > 0).alias("hidden"))
    inferred = decided.select(F.col("case_id").alias("dc"), (F.size(F.array_except("flags", "emitted")) > 0).alias("inferred"))
    return g.join(inferred, F.col("case_id") == F.col("dc"), "left").select("case_id", "scanned", F.coalesce("inferred", F.lit(False)).alias("inferred"), "hidden")


def only_removes(before: Column, after: Column) -> Column:
    """Is everything that is left afterwards in what was there before? The invariant of filters that only suppress."""
    return F.size(F.array_except(after, before)) == 0


__all__ = ["NEAR", "coverage", "only_removes", "page_scores", "torn_labels", "weak_pages"]
