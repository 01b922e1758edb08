"""Text spans of pages: which are hidden, which a strike crosses, and the lines that they make.

Spans are rows (page, line, seq, text, color, size, x0, y0, x1, y1), drawings rows (page, r, g, b, straight, x0, y0, x1, y1),
pages rows (page, x0, y0, x1, y1). Strikes meet spans in bands of y: a strike's middle lies in one band, a span is dealt to
the bands it reaches, so what is compared is what lies at one height of one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The brightness from which a colour is white, the size below which text is tiny, how red and flat a
# strike is, and how far beyond a span's edge its middle may lie.
WHITE, TINY, RED, NOT_RED, FLAT, LEAST_WIDTH, SLACK = 240, 2.0, 0.5, 0.45, 4, 3, 2
#: Height of a band; a span of usual height reaches two.
BAND = 16.0


def whitish(color: Column) -> Column:
    """Are all three bytes of a packed colour nearly full?"""
    return (F.shiftright(color, 16).bitwiseAND(255) > WHITE) & (F.shiftright(color, 8).bitwiseAND(255) > WHITE) & (color.bitwiseAND(255) > WHITE)


def strikes(drawings: DataFrame) -> DataFrame:
    """(page, s0, s1, middle): straight reddish strokes that are flat and wide enough."""
    red = (F.col("r") > RED) & (F.col("g") < NOT_RED) & (F.col("b") < NOT_RED)
    flat = (F.col("y1") - F.col("y0") < FLAT) & (F.col("x1") - F.col("x0") > LEAST_WIDTH)
    return drawings.where(red & F.col("straight") & flat).select("page", F.col("x0").alias("s0"), F.col("x1").alias("s1"), ((F.col("y0") + F.col("y1")) / 2).alias("middle"))


def _inside(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """`spans` with `off`: does the span lie outside of its page's crop? A span that only touches it does."""
    crop = pages.select(F.col("page").alias("cp"), *[F.col(c).alias(f"c{c}") for c in ("x0", "y0", "x1", "y1")])
    meets = (F.greatest("x0", "cx0") < F.least("x1", "cx1")) & (F.greatest("y0", "cy0") < F.least("y1", "cy1"))
    return spans.join(crop, F.col("page") == F.col("cp")).withColumn("off", ~meets).select(*spans.columns, "off")


def struck_spans(spans: DataFrame, drawings: DataFrame) -> DataFrame:
    """(page, line, seq) of spans that a strike crosses: they overlap in x, and the strike's middle lies in the span's height or nearly."""
    band = lambda y: F.floor(y / BAND)
    s = strikes(drawings).withColumn("band", band(F.col("middle"))).withColumnRenamed("page", "sp")
    low, high = F.col("y0") - SLACK, F.col("y1") + SLACK
    dealt = spans.select("page", "line", "seq", "x0", "x1", low.alias("low"), high.alias("high"), F.explode(F.sequence(band(low), band(high))).alias("b"))
    meets = (F.col("page") == F.col("sp")) & (F.col("b") == F.col("band")) & (F.col("s0") <= F.col("x1")) & (F.col("s1") >= F.col("x0")) & F.col("middle").between(F.col("low"), F.col("high"))
    return dealt.join(s, meets, "left_semi").select("page", "line", "seq").distinct()


def page_lines(spans: DataFrame, drawings: DataFrame, pages: DataFrame) -> DataFrame:
    """(page, line, visible, hidden, struck): a line's spans as seen, those that are white, tiny or off the page, and whether a strike
    crosses one that is seen; null where there are none."""
    said = _inside(spans.where(F.trim("text") != ""), pages)
    said = said.withColumn("unseen", whitish(F.col("color")) | (F.col("size") < TINY) | F.col("off"))
    marked = struck_spans(said.where(~F.col("unseen")), drawings).select(F.col("page").alias("mp"), F.col("line").alias("ml"), F.col("seq").alias("ms"))
    same = (F.col("page") == F.col("mp")) & (F.col("line") == F.col("ml")) & (F.col("seq") == F.col("ms"))
    told = said.join(marked, same, "left")
    shown = lambda which: F.array_sort(F.collect_list(F.when(which, F.struct("seq", "text"))))
    g = told.groupBy("page", "line").agg(shown(~F.col("unseen")).alias("v"), shown(F.col("unseen")).alias("h"), F.bool_or(F.col("mp").isNotNull()).alias("struck"))
    joined = lambda c: F.when(F.size(c) > 0, F.trim(F.array_join(F.transform(c, lambda x: x["text"]), " ")))
    return g.select("page", "line", joined("v").alias("visible"), joined("h").alias("hidden"), "struck")
