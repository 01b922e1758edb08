"""Raster operators against plain loops over arrays."""

import numpy as np
from pyspark.sql import functions as F

from plenum.operators import raster


def cells(spark, images):
    rows = [(k, y, x, int(v)) for k, image in enumerate(images) for (y, x), v in np.ndenumerate(image)]
    return spark.createDataFrame(rows, "image long, y int, x int, v int").repartition(3)


def points(spark, masks):
    rows = [(k, int(y), int(x)) for k, m in enumerate(masks) for y, x in zip(*np.nonzero(m), strict=True)]
    return spark.createDataFrame(rows, "image long, y int, x int")


def test_local_threshold_and_box_sums(spark):
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 256, (17, 23)), rng.integers(0, 256, (3, 40))]
    got = {(r["image"], r["y"], r["x"]): (r["n"], r["s"], r["q"]) for r in raster.box_sums(cells(spark, images), 7).collect()}
    ink = {(r["image"], r["y"], r["x"]): r["ink"] for r in raster.local_threshold(cells(spark, images), 7).collect()}
    for k, image in enumerate(images):
        for (y, x), v in np.ndenumerate(image):
            box = image[max(0, y - 3) : y + 4, max(0, x - 3) : x + 4].astype(np.int64)
            assert got[k, y, x] == (box.size, box.sum(), (box * box).sum())
            mean = box.sum() / box.size
            bar = mean * (1 + 0.34 * (np.sqrt(max((box * box).sum() / box.size - mean * mean, 0.0)) / 128 - 1))
            assert ink[k, y, x] == (v <= bar)


def plain_split(values):
    best, at = 0.0, 0
    for t in range(256):
        low, high = values[values <= t], values[values > t]
        if len(low) and len(high):
            between = len(low) * len(high) * (low.mean() - high.mean()) ** 2
            if between > best * (1 + 1e-12):
                best, at = between, t
    return at


def test_splits_and_faintness(spark):
    rng = np.random.default_rng(2)
    pale = np.where(rng.random((40, 40)) < 0.2, 180, 250)
    dark = np.where(rng.random((40, 40)) < 0.2, 10, 250)
    images = [pale, dark, np.full((30, 30), 250), rng.integers(0, 245, (20, 20)), np.full((20, 20), 200)]
    got = {r["image"]: r["split"] for r in raster.split_thresholds(raster.histograms(cells(spark, images))).collect()}
    assert got == {k: plain_split(i.ravel()) for k, i in enumerate(images)}
    faint = {r["image"]: (r["starved"], r["faint"], r["threshold"]) for r in raster.faintness(cells(spark, images)).collect()}
    assert faint[0] == (True, True, 0) and faint[1] == (False, False, 128) and faint[2] == (True, False, 128) and faint[4] == (True, True, 0)


def bordered(shifts, width=80, left=5, span=60):
    out = np.zeros((len(shifts), width), bool)
    for y, s in enumerate(shifts):
        out[y, left + s] = out[y, left + span + s] = True
    return out


def test_borders_are_tracked_seams_found_and_rows_brought_home(spark):
    shifts = [0] * 40 + [9] * 40 + [-3] * 40
    whole = bordered(shifts)
    torn = whole.copy()
    torn[10:30, 60:] = False  # the right border is lost: one line is enough
    torn[50, :] = False
    pairs, lines = ({(r["image"], r["y"]): r["at"] for r in f(points(spark, [whole, torn]), 80).collect()} for f in (raster.pair_offsets, raster.line_offsets))
    assert all(pairs[0, y] == lines[0, y] == 5 + s for y, s in enumerate(shifts))
    assert (1, 15) not in pairs and lines[1, 15] == 5
    merged = raster.merged_offsets(raster.pair_offsets(points(spark, [whole, torn]), 80), raster.line_offsets(points(spark, [whole, torn]), 80))
    rows = spark.createDataFrame([(k, y) for k in (0, 1) for y in range(120)], "image long, y int")
    profile = raster.profiles(rows, merged)
    at = {(r["image"], r["y"]): r["at"] for r in profile.collect()}
    assert at[1, 50] == 14 and at[1, 15] == 5
    home = raster.shifted(points(spark, [whole]).withColumn("v", F.lit(0)), profile, 80)
    assert {r["x"] for r in home.collect()} == {5, 65}
    found = sorted(tuple(r) for r in raster.seams(profile.select("image", "y", (F.col("at") * 3).alias("at")), 5).where("image = 0").collect())
    assert found == [(0, 39, 39), (0, 79, 79)]
    assert raster.pair_offsets(points(spark, [whole[:10]]), 80).count() == 0 and raster.line_offsets(points(spark, [whole[:10]]), 80).count() == 0


def plain_lag(below, above):
    best, at = -1.0, 0
    ref = above - above.mean()
    for s in range(-raster.LAG_SPAN, raster.LAG_SPAN + 1, raster.LAG_STEP):
        p = np.roll(below, s) - below.mean()
        c = p @ ref / ((np.linalg.norm(p) * np.linalg.norm(ref)) or 1.0)
        if c > best + 1e-12:
            best, at = c, s
    return at, best


def test_lags_across_seams(spark):
    rng = np.random.default_rng(4)
    mask = np.zeros((40, 400), bool)
    mask[10:20] = rng.random(400) < 0.3
    mask[20:30] = np.roll(mask[10:20], 14, axis=1)
    runs = spark.createDataFrame([(0, 19, 19), (0, 33, 34)], "image long, first int, last int")
    got = {r["first"]: r for r in raster.seam_lags(points(spark, [mask]), runs, 8, 400).collect()}
    lag, c = plain_lag(mask[20:28].sum(axis=0).astype(float), mask[12:20].sum(axis=0).astype(float))
    assert got[19]["lag"] == lag == -14 and abs(got[19]["correlation"] - c) < 1e-9 and got[19]["counts"]
    assert 33 not in got or not got[33]["counts"]


def test_skews(spark):
    masks = []
    for degrees in (0.0, 3.0, -5.5):
        m = np.zeros((200, 300), bool)
        for row in range(40, 160, 20):
            for x in range(300):
                m[int(np.rint(row + x * np.tan(np.deg2rad(degrees)))), x] = True
        masks.append(m)
    masks.append(np.eye(10, dtype=bool))
    got = {r["image"]: r["angle"] for r in raster.skews(points(spark, masks)).collect()}
    assert abs(got[0]) <= 0.25 and abs(got[1] - 3.0) <= 0.25 and abs(got[2] + 5.5) <= 0.25 and got[3] == 0.0
