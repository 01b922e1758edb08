"""Rasters as rows: thresholds, border lines, seams, skew and row shifts of images as relational plans.

A raster is one row per cell: (image, y, x, v), v from 0 (ink) to 255 (paper). Sums over boxes are differences of prefix
sums, along columns first and then along rows, so a window of any size costs four look-ups a cell; what must be told per
line of cells is a window over one row or column of one image. Images may be many without bound, a row or column of
one image is some thousands of cells. Rasters need not be complete: boxes count the cells that are there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cuts between ink and paper, and when a page counts as faint.
INK, FAINT_HI, PAPER_CUT, INK_CEIL = 128, 210, 245, 230
STARVED, FAINT_RATIO, LEAST_SUB = 0.01, 5.0, 200
# Evidence that a border needs, and how near two readings of it must be.
BORDER_ROWS, WIDTH_TOL, EDGE, SNAP = 20, 6, 0.35, 10
SUPPORT_ROWS, SUPPORT_LEAST, COLUMN_LEAST, REACH = 9, 6, 12, 2
# Jumps that are seams, and what a lag must show to count.
SEAM_JUMP, LEAST_MASS, LEAST_CORRELATION, LAG_EDGE, LAG_SPAN, LAG_STEP = 15, 40, 0.4, 150, 160, 2
MAX_SKEW, SKEW_STEP, SKEW_LEAST = 8.0, 0.25, 50


def _banded(value: Column, keys: list[str], axis: str, radius: int) -> Column:
    """Sum of a value within `radius` along an axis, as the difference of two prefix sums."""
    line = Window.partitionBy(*keys).orderBy(axis)
    upto = F.sum(value).over(line.rangeBetween(Window.unboundedPreceding, radius))
    before = F.sum(value).over(line.rangeBetween(Window.unboundedPreceding, -radius - 1))
    return F.coalesce(upto, F.lit(0)) - F.coalesce(before, F.lit(0))


def box_sums(cells: DataFrame, size: int) -> DataFrame:
    """`cells` with n, s, q: count, sum and sum of squares over the box around each cell, cut off at the borders."""
    radius = max(1, size // 2)
    v = F.col("v").cast("long")
    parts = {"n": F.lit(1).cast("long"), "s": v, "q": v * v}
    down = cells.select("image", "y", "x", "v", *[_banded(c, ["image", "x"], "y", radius).alias(f"c_{k}") for k, c in parts.items()])
    return down.select("image", "y", "x", "v", *[_banded(F.col(f"c_{k}"), ["image", "y"], "x", radius).alias(k) for k in parts])


def local_threshold(cells: DataFrame, size: int = 25, k: float = 0.34, spread: float = 128.0) -> DataFrame:
    """(image, y, x, ink): is the cell no lighter than its neighbourhood's mean, lowered where there is little contrast?"""
    mean = F.col("s") / F.col("n")
    deviation = F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0)))
    bar = mean * (1 + k * (deviation / spread - 1))
    return box_sums(cells, size).select("image", "y", "x", (F.col("v") <= bar).alias("ink"))


def histograms(cells: DataFrame) -> DataFrame:
    """(image, v, n): at most 256 rows for each image; everything about global thresholds follows from them."""
    return cells.groupBy("image", "v").agg(F.count(F.lit(1)).alias("n"))


def split_thresholds(hist: DataFrame) -> DataFrame:
    """(image, split): the value after which two classes differ most, by between-class variance; the least on ties."""
    upto = Window.partitionBy("image").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("image")
    mass = F.col("n") * F.col("v")
    h = hist.select("image", "v", F.sum("n").over(upto).alias("w0"), F.sum(mass).over(upto).alias("s0"), F.sum("n").over(whole).alias("w"), F.sum(mass).over(whole).alias("s"))
    w1 = F.col("w") - F.col("w0")
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1
    between = F.when(w1 == 0, 0.0).otherwise(F.col("w0").cast("double") * w1 * apart * apart)
    best = h.groupBy("image").agg(F.min_by(F.struct("v", between.alias("b")), F.struct((-between).alias("b"), "v")).alias("best"))
    return best.select("image", F.when(F.col("best.b") > 0, F.col("best.v")).otherwise(0).alias("split"))


def faintness(cells: DataFrame, cut: int = INK) -> DataFrame:
    """(image, ink_frac, starved, faint, threshold): a page whose ink is gray gets a cut of its own between ink and paper."""
    hist = histograms(cells)
    share = lambda below: F.sum(F.when(F.col("v") < below, F.col("n")).otherwise(0)) / F.sum("n")
    g = hist.groupBy("image").agg(share(cut).alias("ink_frac"), share(FAINT_HI).alias("gray_frac"), F.sum(F.when(F.col("v") < PAPER_CUT, F.col("n")).otherwise(0)).alias("sub"))
    split = split_thresholds(hist.where(F.col("v") < PAPER_CUT)).withColumnRenamed("image", "i")
    g = g.join(split, F.col("image") == F.col("i"), "left")
    starved = F.col("ink_frac") < STARVED
    faint = starved & (F.col("gray_frac") >= FAINT_RATIO * F.greatest(F.col("ink_frac"), F.lit(1e-6))) & (F.col("sub") >= LEAST_SUB)
    return g.select("image", "ink_frac", starved.alias("starved"), faint.alias("faint"), F.when(faint, F.least("split", F.lit(INK_CEIL))).otherwise(cut).cast("int").alias("threshold"))


def pair_offsets(dark: DataFrame, width: int) -> DataFrame:
    """(image, y, at): the left end of rows whose ink spans the usual width; of images with enough of such rows.

    `dark` has a row (image, y, x) for each inked cell.
    """
    spans = dark.groupBy("image", "y").agg(F.min("x").alias("at"), (F.max("x") - F.min("x")).alias("span")).where("span > 0")
    usual = spans.groupBy(F.col("image").alias("i")).agg(F.floor(F.median("span")).alias("usual"), F.count(F.lit(1)).alias("rows"))
    usual = usual.where((F.col("rows") >= BORDER_ROWS) & (F.col("usual") >= width // 2))
    fits = spans.join(usual, F.col("image") == F.col("i")).where(F.abs(F.col("span") - F.col("usual")) <= WIDTH_TOL)
    return _enough(fits.select("image", "y", F.col("at").cast("double").alias("at")))


def _enough(offsets: DataFrame) -> DataFrame:
    rows = offsets.groupBy(F.col("image").alias("i")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= BORDER_ROWS)
    return offsets.join(rows, F.col("image") == F.col("i"), "left_semi")


def _supported(edges: DataFrame, width: int) -> DataFrame:
    """Edges (image, y, x) that a column of others bears out: near ones within some rows, and enough down the image."""
    reach = F.explode(F.array(*[F.lit(d) for d in range(-REACH, REACH + 1)]))
    near = edges.select("image", "y", F.col("x").alias("own"), reach.alias("d"))
    near = near.select("image", "y", F.pmod(F.col("own") + F.col("d"), F.lit(width)).alias("x"), (F.col("d") == 0).alias("edge"))
    near = near.groupBy("image", "y", "x").agg(F.bool_or("edge").alias("edge"))
    rows = _banded(F.lit(1), ["image", "x"], "y", SUPPORT_ROWS).alias("rows")
    told = near.select("image", "y", "x", "edge", rows, F.count(F.lit(1)).over(Window.partitionBy("image", "x")).alias("all_rows"))
    return told.where(F.col("edge") & (F.col("rows") >= SUPPORT_LEAST) & (F.col("all_rows") >= COLUMN_LEAST)).select("image", "y", "x")


def line_offsets(dark: DataFrame, width: int) -> DataFrame:
    """(image, y, at): the left border's place in each row, from either border line that is tracked by itself."""
    row = Window.partitionBy("image", "y").orderBy("x")
    ends = dark.select("image", "y", "x", F.coalesce(F.col("x") - F.lag("x").over(row) > 1, F.lit(True)).alias("begins"), F.coalesce(F.lead("x").over(row) - F.col("x") > 1, F.lit(True)).alias("ends"))
    left = _supported(ends.where("begins").select("image", "y", "x"), width).where(F.col("x") < int(width * EDGE)).groupBy("image", "y").agg(F.min("x").alias("l"))
    right = _supported(ends.where("ends").select("image", "y", "x"), width).where(F.col("x") >= int(width * (1 - EDGE))).groupBy(F.col("image").alias("ri"), F.col("y").alias("ry")).agg(F.max("x").alias("r"))
    both = left.join(right, (F.col("image") == F.col("ri")) & (F.col("y") == F.col("ry")), "full_outer").select(F.coalesce("image", "ri").alias("image"), F.coalesce("y", "ry").alias("y"), "l", "r")
    span = F.col("r") - F.col("l")
    usual = both.where(span.isNotNull()).groupBy(F.col("image").alias("i")).agg(F.median(span).alias("usual"), F.count(F.lit(1)).alias("rows"))
    usual = usual.where((F.col("rows") >= BORDER_ROWS) & (F.col("usual") >= width / 2))
    at = F.when(F.col("r").isNull(), F.col("l")).when(F.col("l").isNull(), F.col("r") - F.col("usual")).when(F.abs(span - F.col("usual")) <= WIDTH_TOL, F.col("l"))
    found = both.join(usual, F.col("image") == F.col("i")).select("image", "y", at.cast("double").alias("at")).where("at IS NOT NULL")
    return _enough(found)


def merged_offsets(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(image, y, at): rows measured by the pair of borders; the tracked lines fill the others, as the nearest measured row has
    it unless they differ by more than a tolerance."""
    p = pairs.select("image", "y", F.col("at").alias("pair"))
    q = lines.select(F.col("image").alias("qi"), F.col("y").alias("qy"), F.col("at").alias("line"))
    rows = p.join(q, (F.col("image") == F.col("qi")) & (F.col("y") == F.col("qy")), "full_outer").select(F.coalesce("image", "qi").alias("image"), F.coalesce("y", "qy").alias("y"), "pair", "line")
    w = Window.partitionBy("image").orderBy("y")
    known = F.when(F.col("pair").isNotNull(), F.struct("y", "pair"))
    rows = rows.withColumn("before", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("after", F.first(known, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    later = F.col("before").isNull() | (F.col("after.y") - F.col("y") < F.col("y") - F.col("before.y"))
    nearest = F.when(later & F.col("after").isNotNull(), F.col("after.pair")).otherwise(F.col("before.pair"))
    filled = F.when(F.abs(F.col("line") - nearest) <= SNAP, nearest).otherwise(F.col("line"))
    return rows.select("image", "y", F.coalesce("pair", filled).alias("at"))


def profiles(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """(image, y, at, home): the last known offset at each row of `rows` (image, y), and the image's median offset; images without any are left out."""
    home = offsets.groupBy(F.col("image").alias("hi")).agg(F.median("at").alias("home"))
    known = offsets.select(F.col("image").alias("oi"), F.col("y").alias("oy"), "at")
    all_rows = rows.select("image", "y").distinct().join(home, F.col("image") == F.col("hi")).join(known, (F.col("image") == F.col("oi")) & (F.col("y") == F.col("oy")), "left")
    last = F.last("at", ignorenulls=True).over(Window.partitionBy("image").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return all_rows.select("image", "y", F.coalesce(last, F.col("home")).alias("at"), "home")


def shifted(cells: DataFrame, profile: DataFrame, width: int) -> DataFrame:
    """`cells` with each row rolled by what brings its offset home; rows of images without a profile stay."""
    moves = profile.select(F.col("image").alias("pi"), F.col("y").alias("py"), F.rint(F.col("home") - F.col("at")).cast("int").alias("by"))
    placed = cells.join(moves, (F.col("image") == F.col("pi")) & (F.col("y") == F.col("py")), "left")
    return placed.select("image", "y", F.pmod(F.col("x") + F.coalesce("by", F.lit(0)), F.lit(width)).cast("int").alias("x"), "v")


def seams(profile: DataFrame, within: int) -> DataFrame:
    """(image, first, last): runs of jumps of the profile no further apart than `within`; y is the row above a jump."""
    w = Window.partitionBy("image").orderBy("y")
    jumps = profile.select("image", "y", (F.lead("at").over(w) - F.col("at")).alias("jump")).where(F.abs("jump") > SEAM_JUMP)
    new = F.coalesce(F.col("y") - F.lag("y").over(w) > within, F.lit(True))
    runs = jumps.select("image", "y", new.cast("int").alias("new")).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy("image", "run").agg(F.min("y").alias("first"), F.max("y").alias("last")).drop("run")


def lag_of(below: Column, above: Column, span: int = LAG_SPAN, step: int = LAG_STEP) -> Column:
    """Struct (lag, correlation): the shift that lays one array of counts best on another of its length, rolled; the first on ties."""
    n = F.size(above)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    dot = lambda a, b: total(F.zip_with(a, b, lambda x, y: (x * y).cast("double")))
    rolled = lambda s: F.concat(F.slice(below, n - F.pmod(s, n) + 1, F.pmod(s, n)), F.slice(below, F.lit(1), n - F.pmod(s, n)))
    centre = total(below) * total(above) / n
    power = F.sqrt((dot(below, below) - total(below) * total(below) / n) * (dot(above, above) - total(above) * total(above) / n))
    each = F.transform(F.sequence(F.lit(-span), F.lit(span), F.lit(step)), lambda s: F.struct(((dot(rolled(s), above) - centre) / F.when(power == 0, 1.0).otherwise(power)).alias("c"), (-s).alias("order")))
    best = F.array_max(each)
    return F.struct((-best["order"]).alias("lag"), best["c"].alias("correlation"))


def seam_lags(ink: DataFrame, runs: DataFrame, half: int, width: int) -> DataFrame:
    """(image, first, last, lag, correlation, counts): the shift between the inked columns just above and just below each seam.

    `counts` tells whether both sides hold enough ink, the halves fit, and the lag isn't at the edge of the search.
    """
    r = runs.select(F.col("image").alias("si"), "first", "last")
    near = ink.join(r, (F.col("image") == F.col("si")) & F.col("y").between(F.col("first") - half + 1, F.col("last") + half))
    side = F.when(F.col("y") <= F.col("first"), "above").when(F.col("y") > F.col("last"), "below")
    counted = near.select("image", "first", "last", side.alias("side"), "x").where("side IS NOT NULL").groupBy("image", "first", "last", "side", "x").agg(F.count(F.lit(1)).alias("n"))
    maps = counted.groupBy("image", "first", "last").agg(*[F.map_from_entries(F.collect_list(F.when(F.col("side") == s, F.struct("x", "n")))).alias(s) for s in ("above", "below")])
    dense = lambda m: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda x: F.coalesce(F.try_element_at(m, x), F.lit(0)))
    laid = maps.select("image", "first", "last", dense(F.col("above")).alias("above"), dense(F.col("below")).alias("below"))
    mass = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    found = laid.select("image", "first", "last", mass(F.col("above")).alias("up"), mass(F.col("below")).alias("down"), lag_of(F.col("below"), F.col("above")).alias("fit"))
    enough = (F.col("up") >= LEAST_MASS) & (F.col("down") >= LEAST_MASS) & (F.col("fit.correlation") >= LEAST_CORRELATION) & (F.abs("fit.lag") < LAG_EDGE)
    return found.select("image", "first", "last", "fit.lag", "fit.correlation", enough.alias("counts"))


def skews(ink: DataFrame, limit: float = MAX_SKEW, step: float = SKEW_STEP) -> DataFrame:
    """(image, angle): the shear under which the inked cells' row profile is sharpest, the least angle on ties; 0 where ink is scarce.

    Cells of a row and angle that fall on one profile row are counted where they are read, so what is shuffled is
    profiles, not points.
    """
    n = round(2 * limit / step) + 1
    angles = [-limit + i * step for i in range(n)]
    tangents = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(math.tan(math.radians(a))).alias("t")) for i, a in enumerate(angles)])
    points = ink.select("image", "y", "x", F.explode(tangents).alias("a"))
    profile = points.groupBy("image", F.col("a.i").alias("i"), F.rint(F.col("y") - F.col("x") * F.col("a.t")).cast("int").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    scores = profile.groupBy("image", "i").agg(F.sum(F.col("n") * F.col("n")).alias("score"), F.sum("n").alias("points"))
    best = scores.groupBy("image").agg(F.min_by("i", F.struct((-F.col("score")).alias("s"), "i")).alias("i"), F.max("points").alias("points"))
    return best.select("image", F.when(F.col("points") < SKEW_LEAST, 0.0).otherwise(-limit + F.col("i") * step).alias("angle"))
