"""Queries over rasters made of given tables: embeddings as gray cells, orders as the rows of pages with a border."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plenum.operators import raster, spans
from plenum.session import table

#: Rows of an image, and the width of the pages made from orders.
TALL, WIDE = 256, 96


def _gray(spark, sf_dir) -> DataFrame:
    """(image, y, x, v): 256 vectors by id are an image, a component is a cell; every third image is pale."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("x", "c"))
    v = F.least(F.greatest(F.floor(128 + 256 * F.coalesce(F.nanvl("c", F.lit(0.5)), F.lit(0.5)).cast("double")), F.lit(0)), F.lit(255)).cast("int")
    image = F.floor(F.col("vec_id") / TALL)
    pale = image % 3 == 1
    return e.select(image.alias("image"), (F.col("vec_id") % TALL).cast("int").alias("y"), "x", F.when(pale, F.floor(170 + v / 3).cast("int")).otherwise(v).alias("v"))


def _page(spark, sf_dir) -> DataFrame:
    """(image, y, x): the inked cells of pages; an order is a row with two border cells, moved by its band, and some text."""
    o = table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / TALL).alias("image"), (F.col("o_orderkey") % TALL).cast("int").alias("y"), F.col("o_custkey").alias("c"))
    band = F.floor(F.col("y") / 64).cast("int")
    by = F.when((F.col("image") + band) % 3 == 1, 18).when((F.col("image") + band) % 3 == 2, -4).otherwise(0)
    o = o.select("image", "y", "c", (by + 6).alias("left"), F.explode(F.sequence(F.lit(0), F.lit(WIDE - 1))).alias("x"))
    left = (F.col("x") == F.col("left")) & (F.col("y") % 11 != 3)
    right = (F.col("x") == F.col("left") + 70) & (F.col("y") % 7 != 2)
    text = F.col("x").between(F.col("left") + 8, F.col("left") + 60) & ((F.col("x") - F.col("left")) * 7 % 13 + F.floor(F.col("y") / 8) < 6) & (F.col("y") % 8 < 5)
    return o.where(left | right | text).select("image", "y", "x")


def local_ink(spark, sf_dir):
    """Local thresholds by summed areas; inked cells by row."""
    ink = raster.local_threshold(_gray(spark, sf_dir))
    return ink.groupBy("image", "y").agg(F.count_if("ink").alias("n"), F.sum(F.when(F.col("ink"), F.col("x")).otherwise(0)).alias("places"))


def page_faintness(spark, sf_dir):
    """L: starved, faint, and the threshold between two classes."""
    return raster.faintness(_gray(spark, sf_dir)).select("image", F.round("ink_frac", 12).alias("ink_frac"), "starved", "faint", "threshold")


def border_offsets(spark, sf_dir):
    """E16, L: border pairs, tracked lines with vertical support, and both merged."""
    dark = _page(spark, sf_dir)
    return raster.merged_offsets(raster.pair_offsets(dark, WIDE), raster.line_offsets(dark, WIDE))


def _profile(dark: DataFrame) -> DataFrame:
    return raster.profiles(dark, raster.merged_offsets(raster.pair_offsets(dark, WIDE), raster.line_offsets(dark, WIDE)))


def realigned_rows(spark, sf_dir):
    """L: rows brought home by their last known offset."""
    dark = _page(spark, sf_dir)
    moved = raster.shifted(dark.withColumn("v", F.lit(0)), _profile(dark), WIDE)
    return moved.groupBy("image", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("rows"))


def seam_shifts(spark, sf_dir):
    """L: jumps of the offsets, and the shift that the text on both sides of each shows."""
    dark = _page(spark, sf_dir)
    runs = raster.seams(_profile(dark), 4)
    return raster.seam_lags(dark, runs, 8, WIDE).select("image", "first", "last", "lag", F.round("correlation", 9).alias("correlation"), "counts")


def page_skews(spark, sf_dir):
    """L: the angle that lays the rows of pages flat."""
    tilt = F.floor((F.col("image") % 5 - 2) * F.col("x") / 20).cast("int")
    return raster.skews(_page(spark, sf_dir).select("image", (F.col("y") + tilt).alias("y"), "x"))


def span_lines(spark, sf_dir):
    """Spans of pages, here line items; strokes, here orders; lines with what is seen, hidden and struck out."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    page = F.floor(F.col("l_orderkey") / 50)
    x, y = (F.col("l_partkey") % 400).cast("double"), (F.col("l_orderkey") % 50 * 14).cast("double")
    color = F.when(F.col("l_linenumber") % 5 == 2, 16777215 - (F.col("l_suppkey") % 20) * 65793).otherwise(F.col("l_partkey") * 40503 % 16777216).cast("int")
    seq = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    text = F.when(F.col("l_partkey") % 17 == 0, " ").otherwise(F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
    made = l.select(page.alias("page"), F.col("l_orderkey").alias("line"), seq.alias("seq"), text.alias("text"), color.alias("color"), (F.col("l_discount") * 100 + 1).alias("size"), x.alias("x0"), y.alias("y0"), (x + F.col("l_quantity") * 4).alias("x1"), (y + 10).alias("y1"))
    o = table(spark, sf_dir, "orders")
    sx, sy = (F.col("o_custkey") % 400).cast("double"), (F.col("o_orderkey") % 50 * 14 + F.col("o_custkey") % 16 - 3).cast("double")
    shade = (F.col("o_orderkey") % 10) / 10
    drawn = o.where("o_orderkey % 3 <> 0").select(F.floor(F.col("o_orderkey") / 50).alias("page"), (1 - shade / 2).alias("r"), shade.alias("g"), (shade / 2).alias("b"), (F.col("o_orderkey") % 7 != 1).alias("straight"), sx.alias("x0"), sy.alias("y0"), (sx + F.col("o_custkey") % 60).alias("x1"), (sy + F.col("o_orderkey") % 6).alias("y1"))
    pages = l.select(page.alias("page")).distinct().select("page", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(380.0).alias("x1"), F.lit(690.0).alias("y1"))
    return spans.page_lines(made, drawn, pages)


QUERIES = {f.__name__: f for f in (local_ink, page_faintness, border_offsets, realigned_rows, seam_shifts, page_skews, span_lines)}

_GRAY = f"""e AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS INT) AS x, unnest(embedding)::DOUBLE AS c FROM embeddings),
b AS (SELECT CAST(floor(vec_id / {TALL}.0) AS BIGINT) AS image, CAST(vec_id % {TALL} AS INT) AS y, x, CAST(least(greatest(floor(128 + 256 * CASE WHEN c IS NULL OR isnan(c) THEN 0.5::DOUBLE ELSE c END), 0), 255) AS INT) AS v FROM e),
g AS (SELECT image, y, x, CASE WHEN image % 3 = 1 THEN CAST(floor(170 + v / 3) AS INT) ELSE v END AS v FROM b)"""
_PAGE = f"""o AS (SELECT CAST(floor(o_orderkey / {TALL}.0) AS BIGINT) AS image, CAST(o_orderkey % {TALL} AS INT) AS y FROM orders),
l AS (SELECT *, 6 + CASE (image + y // 64) % 3 WHEN 1 THEN 18 WHEN 2 THEN -4 ELSE 0 END AS lf, CAST(unnest(range({WIDE})) AS INT) AS x FROM o),
d AS (SELECT image, y, x FROM l WHERE (x = lf AND y % 11 <> 3) OR (x = lf + 70 AND y % 7 <> 2) OR (x BETWEEN lf + 8 AND lf + 60 AND (x - lf) * 7 % 13 + y // 8 < 6 AND y % 8 < 5))"""
# Offsets by plain loops over lists: each row's pair, each row's lines, then the fills.
_OFFSETS = f"""{_PAGE},
sp AS (SELECT image, y, min(x) AS a, max(x) - min(x) AS s FROM d GROUP BY image, y HAVING max(x) > min(x)),
us AS (SELECT image, floor(median(s)) AS u FROM sp GROUP BY image HAVING count(*) >= 20 AND floor(median(s)) >= {WIDE // 2}),
pr AS (SELECT image, y, a::DOUBLE AS a, count(*) OVER (PARTITION BY image) AS m FROM sp JOIN us USING (image) WHERE abs(s - u) <= 6),
be AS (SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM d p WHERE p.image = d.image AND p.y = d.y AND p.x = d.x - 1)),
en AS (SELECT d.* FROM d WHERE NOT EXISTS (SELECT 1 FROM d p WHERE p.image = d.image AND p.y = d.y AND p.x = d.x + 1)),
ba AS (SELECT DISTINCT image, y, (x + k + {WIDE}) % {WIDE} AS x FROM be, range(-2, 3) t(k)), ea AS (SELECT DISTINCT image, y, (x + k + {WIDE}) % {WIDE} AS x FROM en, range(-2, 3) t(k)),
bt AS (SELECT image, y, x, count(*) OVER (PARTITION BY image, x ORDER BY y RANGE BETWEEN 9 PRECEDING AND 9 FOLLOWING) AS n, count(*) OVER (PARTITION BY image, x) AS t FROM ba),
et AS (SELECT image, y, x, count(*) OVER (PARTITION BY image, x ORDER BY y RANGE BETWEEN 9 PRECEDING AND 9 FOLLOWING) AS n, count(*) OVER (PARTITION BY image, x) AS t FROM ea),
lf AS (SELECT image, y, min(x) AS l FROM bt JOIN be USING (image, y, x) WHERE n >= 6 AND t >= 12 AND x < {int(WIDE * 0.35)} GROUP BY image, y),
rt AS (SELECT image, y, max(x) AS r FROM et JOIN en USING (image, y, x) WHERE n >= 6 AND t >= 12 AND x >= {int(WIDE * 0.65)} GROUP BY image, y),
bo AS (SELECT coalesce(lf.image, rt.image) AS image, coalesce(lf.y, rt.y) AS y, l, r FROM lf FULL JOIN rt ON lf.image = rt.image AND lf.y = rt.y),
lu AS (SELECT image, median(r - l) AS u FROM bo WHERE r - l IS NOT NULL GROUP BY image HAVING count(*) >= 20 AND median(r - l) >= {WIDE / 2}),
li AS (SELECT image, y, CASE WHEN r IS NULL THEN l WHEN l IS NULL THEN r - u WHEN abs(r - l - u) <= 6 THEN l END::DOUBLE AS a FROM bo JOIN lu USING (image)),
ln AS (SELECT image, y, a, count(*) OVER (PARTITION BY image) AS m FROM li WHERE a IS NOT NULL),
p AS (SELECT image, y, a FROM pr WHERE m >= 20), q AS (SELECT image, y, a FROM ln WHERE m >= 20),
gaps AS (SELECT q.image, q.y, q.a AS line, arg_min(p.a, abs(p.y - q.y) * 1000 + p.y) AS near FROM q LEFT JOIN p ON p.image = q.image WHERE NOT EXISTS (SELECT 1 FROM p z WHERE z.image = q.image AND z.y = q.y) GROUP BY ALL),
off AS (SELECT image, y, a AS plc FROM p UNION ALL SELECT image, y, CASE WHEN abs(line - near) <= 10 THEN near ELSE line END FROM gaps)"""
_PROFILE = f"""{_OFFSETS},
home AS (SELECT image, median(plc) AS home FROM off GROUP BY image),
prof AS (SELECT r.image, r.y, home, coalesce(last_value(plc IGNORE NULLS) OVER (PARTITION BY r.image ORDER BY r.y ROWS UNBOUNDED PRECEDING), home) AS plc FROM (SELECT DISTINCT image, y FROM d) r JOIN home ON home.image = r.image LEFT JOIN off ON off.image = r.image AND off.y = r.y)"""
_LAGS = list(range(-raster.LAG_SPAN, raster.LAG_SPAN + 1, raster.LAG_STEP))
_ANGLES = ", ".join(f"({i}, {math.tan(math.radians(-8.0 + i * 0.25))!r}::DOUBLE)" for i in range(65))
ORACLES = {
    "local_ink": f"""WITH {_GRAY},
c AS (SELECT *, count(*) OVER w AS n1, sum(v) OVER w AS s1, sum(v::BIGINT * v) OVER w AS q1 FROM g WINDOW w AS (PARTITION BY image, x ORDER BY y RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
t AS (SELECT image, y, x, v, CAST(sum(n1) OVER w AS DOUBLE) AS n, CAST(sum(s1) OVER w AS DOUBLE) AS s, CAST(sum(q1) OVER w AS DOUBLE) AS q FROM c WINDOW w AS (PARTITION BY image, y ORDER BY x RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
k AS (SELECT image, y, x, v <= (s / n) * (1 + 0.34::DOUBLE * (sqrt(greatest(q / n - (s / n) * (s / n), 0.0::DOUBLE)) / 128.0::DOUBLE - 1)) AS ink FROM t)
SELECT image, y, count(*) FILTER (ink) AS n, CAST(coalesce(sum(x) FILTER (ink), 0) AS BIGINT) AS places FROM k GROUP BY image, y""",
    "page_faintness": f"""WITH {_GRAY}, s AS (SELECT image, v FROM g WHERE v < 245),
h AS (SELECT image, t.v, count(*) FILTER (s.v <= t.v) AS w0, sum(s.v) FILTER (s.v <= t.v) AS s0, count(*) AS w, sum(s.v) AS sw FROM s JOIN (SELECT DISTINCT image, v FROM s) t USING (image) GROUP BY image, t.v),
bw AS (SELECT image, v, CASE WHEN w = w0 THEN 0 ELSE w0::DOUBLE * (w - w0) * (s0::DOUBLE / w0 - (sw - s0)::DOUBLE / (w - w0)) * (s0::DOUBLE / w0 - (sw - s0)::DOUBLE / (w - w0)) END AS b FROM h),
m AS (SELECT image, CASE WHEN max(b) > 0 THEN arg_min(v, (-b, v)) ELSE 0 END AS split FROM bw GROUP BY image),
f AS (SELECT image, count(*) FILTER (v < 128)::DOUBLE / count(*) AS i, count(*) FILTER (v < 210)::DOUBLE / count(*) AS h, count(*) FILTER (v < 245) AS sub FROM g GROUP BY image)
SELECT image, round(i, 12) AS ink_frac, i < 0.01 AS starved, i < 0.01 AND h >= 5 * greatest(i, 1e-6) AND sub >= 200 AS faint, CAST(CASE WHEN i < 0.01 AND h >= 5 * greatest(i, 1e-6) AND sub >= 200 THEN least(split, 230) ELSE 128 END AS INT) AS threshold FROM f LEFT JOIN m USING (image)""",
    "border_offsets": f'WITH {_OFFSETS} SELECT image, y, plc AS "at" FROM off',
    "realigned_rows": f"WITH {_PROFILE}, m AS (SELECT d.image, d.y, CAST((d.x + CAST(round_even(coalesce(home - plc, 0), 0) AS INT) + {10 * WIDE}) % {WIDE} AS INT) AS x FROM d LEFT JOIN prof USING (image, y)) SELECT image, x, count(*) AS n, CAST(sum(y) AS BIGINT) AS rows FROM m GROUP BY image, x",
    "seam_shifts": f"""WITH {_PROFILE},
j AS (SELECT image, y, lead(plc) OVER (PARTITION BY image ORDER BY y) - plc AS jump FROM prof), k AS (SELECT image, y, coalesce(y - lag(y) OVER (PARTITION BY image ORDER BY y) > 4, true)::INT AS new FROM j WHERE abs(jump) > 15),
r AS (SELECT image, min(y) AS first, max(y) AS last FROM (SELECT *, sum(new) OVER (PARTITION BY image ORDER BY y) AS run FROM k) GROUP BY image, run),
cc AS (SELECT r.image, first, last, c.x, count(*) FILTER (d.x = c.x AND d.y <= first) AS a, count(*) FILTER (d.x = c.x AND d.y > last) AS b FROM r JOIN (SELECT CAST(range AS INT) AS x FROM range({WIDE})) c ON true LEFT JOIN d ON d.image = r.image AND d.x = c.x AND d.y BETWEEN first - 7 AND last + 8 GROUP BY ALL),
w AS (SELECT image, first, last, list(a::DOUBLE ORDER BY x) AS a, list(b::DOUBLE ORDER BY x) AS b FROM cc GROUP BY ALL),
s AS (SELECT w.*, lag, ([(b[CAST((i - lag + {10 * WIDE}) % {WIDE} AS INT) + 1]) * a[i + 1] FOR i IN range({WIDE})]) AS pr FROM w, (SELECT unnest({_LAGS}) AS lag)),
t AS (SELECT image, first, last, lag, list_sum(a) AS up, list_sum(b) AS down, (list_sum(pr) - list_sum(b) * list_sum(a) / {WIDE}) / CASE WHEN sqrt((list_sum([x * x FOR x IN b]) - list_sum(b) * list_sum(b) / {WIDE}) * (list_sum([x * x FOR x IN a]) - list_sum(a) * list_sum(a) / {WIDE})) = 0 THEN 1 ELSE sqrt((list_sum([x * x FOR x IN b]) - list_sum(b) * list_sum(b) / {WIDE}) * (list_sum([x * x FOR x IN a]) - list_sum(a) * list_sum(a) / {WIDE})) END AS c FROM s)
SELECT image, first, last, CAST(arg_min(lag, (-c, lag)) AS INT) AS lag, round(max(c), 9) AS correlation, any_value(up) >= 40 AND any_value(down) >= 40 AND max(c) >= 0.4 AND abs(arg_min(lag, (-c, lag))) < 150 AS counts FROM t GROUP BY image, first, last""",
    "span_lines": """WITH s AS (SELECT CAST(floor(l_orderkey / 50.0) AS BIGINT) AS page, l_orderkey AS line, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS seq, CASE WHEN l_partkey % 17 = 0 THEN ' ' ELSE 'part ' || l_partkey END AS t,
  CAST(CASE WHEN l_linenumber % 5 = 2 THEN 16777215 - (l_suppkey % 20) * 65793 ELSE l_partkey * 40503 % 16777216 END AS INT) AS c, l_discount * 100 + 1 AS z, (l_partkey % 400)::DOUBLE AS x0, (l_orderkey % 50 * 14)::DOUBLE AS y0, l_partkey % 400 + l_quantity * 4 AS x1, (l_orderkey % 50 * 14 + 10)::DOUBLE AS y1 FROM lineitem),
k AS (SELECT CAST(floor(o_orderkey / 50.0) AS BIGINT) AS page, (o_orderkey % 10) / 10.0::DOUBLE AS g, o_custkey % 400 AS x0, o_custkey % 400 + o_custkey % 60 AS x1, o_orderkey % 50 * 14 + o_custkey % 16 - 3 AS y0, o_orderkey % 6 AS h FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 1),
r AS (SELECT page, x0, x1, y0 + h / 2.0::DOUBLE AS m FROM k WHERE 1 - g / 2 > 0.5 AND g < 0.45 AND g / 2 < 0.45 AND h < 4 AND x1 - x0 > 3),
u AS (SELECT *, ((c >> 16) & 255 > 240 AND (c >> 8) & 255 > 240 AND c & 255 > 240) OR z < 2 OR NOT (greatest(x0, 0) < least(x1, 380) AND greatest(y0, 0) < least(y1, 690)) AS unseen FROM s WHERE trim(t) <> '')
SELECT page, line, trim(string_agg(t, ' ' ORDER BY seq) FILTER (NOT unseen)) AS visible, trim(string_agg(t, ' ' ORDER BY seq) FILTER (unseen)) AS hidden,
       bool_or(NOT unseen AND EXISTS (SELECT 1 FROM r WHERE r.page = u.page AND r.x0 <= u.x1 AND r.x1 >= u.x0 AND r.m BETWEEN u.y0 - 2 AND u.y1 + 2)) AS struck FROM u GROUP BY page, line""",
    "page_skews": f"WITH {_PAGE}, k(i, t) AS (VALUES {_ANGLES}), pt AS (SELECT image, i, CAST(round_even(y + CAST(floor((image % 5 - 2) * x / 20.0) AS INT) - x * t, 0) AS INT) AS row, count(*) AS n FROM d, k GROUP BY ALL), sc AS (SELECT image, i, sum(n * n) AS s, sum(n) AS p FROM pt GROUP BY image, i) SELECT image, CASE WHEN max(p) < 50 THEN 0 ELSE -8.0 + arg_min(i, (-s, i)) * 0.25 END::DOUBLE AS angle FROM sc GROUP BY image",
}
