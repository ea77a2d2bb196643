"""Exact geometry and neighbourhoods against plain twins."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldlark.operators import raster, zonal


def polygons(spark, shapes):
    rows = [(k, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(rows, "uid string, geom array<array<struct<x: double, y: double>>>")


def clipped(ring, row, col):
    """Area of a ring within a pixel, by clipping it at the pixel's four sides."""
    for axis, bound, keep in ((0, col, 1), (0, col + 1, -1), (1, row, 1), (1, row + 1, -1)):
        out = []
        for i, q in enumerate(ring):
            p = ring[i - 1]
            inp, inq = keep * (p[axis] - bound) >= 0, keep * (q[axis] - bound) >= 0
            if inp != inq:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if inq:
                out.append(q)
        ring = out
    return abs(sum(ring[i - 1][0] * q[1] - q[0] * ring[i - 1][1] for i, q in enumerate(ring))) / 2


def star(r, cx, cy, n):
    return [(cx + math.cos(2 * math.pi * i / n) * (d := r.uniform(1, 4)), cy + math.sin(2 * math.pi * i / n) * d) for i in range(n)]


def test_coverage_is_exact(spark):
    r = random.Random(2)
    shapes = {f"t{i}": [[(r.uniform(-4, 4), r.uniform(-4, 4)) for _ in range(3)]] for i in range(12)}
    shapes |= {f"s{i}": [star(r, r.uniform(-9, 9), 1e5 if i == 3 else 0, 11)[:: r.choice([1, -1])]] for i in range(6)}
    square, hole, island = [(0, 0), (6, 0), (6, 6), (0, 6)], [(1.5, 1.5), (4.5, 1.5), (4.5, 4.5), (1.5, 4.5)], [(2.25, 2.25), (2.25, 3.5), (3.5, 3.5), (3.5, 2.25)]
    shapes |= {"holes": [square, hole, island], "turned": [island, hole[::-1], square[::-1]], "sliver": [[(0.1, 0.1), (9.9, 0.1001), (9.9, 0.1002)]], "two": [[(0, 0), (1, 0), (0, 1)], [(1, 1), (1, 2), (2, 2)]]}
    got = {(x.uid, x.row, x.col): x.fraction for x in zonal.coverage_fractions(polygons(spark, shapes)).collect()}
    for k, rings in shapes.items():
        signs = {"holes": (1, -1, 1), "turned": (1, -1, 1)}.get(k, (1,) * len(rings))
        xs, ys = [p[0] for g in rings for p in g], [p[1] for g in rings for p in g]
        for row in range(math.floor(min(ys)) - 1, math.ceil(max(ys)) + 1):
            for col in range(math.floor(min(xs)) - 1, math.ceil(max(xs)) + 1):
                want = sum(s * clipped(g, row, col) for s, g in zip(signs, rings, strict=True))
                assert abs(got.get((k, row, col), 0) - want) < 2e-9 * (1e5 if k == "s3" else 1), (k, row, col)
    half = {(x.uid, x.row, x.col) for x in zonal.coverage_fractions(polygons(spark, {"h": [[(0, 0), (1, 0), (1, 1)]]}), 0.5).collect()}
    assert half == {("h", 0, 0), ("h", 0, 1), ("h", 1, 1)}


def test_faults(spark):
    shapes = {
        "good": [[(0, 0), (4, 0), (4, 4), (0, 4)]], "closed": [[(0, 0), (4, 0), (4, 0), (4, 4), (0, 0)]], "hole touching in a corner": [[(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (2, 1), (1, 2)]],
        "bow": [[(0, 0), (2, 2), (2, 0), (0, 2)]], "line": [[(0, 0), (1, 0), (2, 0)]], "spike": [[(0, 0), (4, 0), (4, 4), (2, 4), (2, 9), (2, 4), (0, 4)]], "back": [[(0, 0), (4, 0), (2, 0), (2, 3)]],
        "touch": [[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)]], "hole across": [[(0, 0), (4, 0), (4, 4), (0, 4)], [(3, 1), (6, 1), (6, 2), (3, 2)]], "none": [[(0, 0), (1, 1)]], "empty": [],
    }
    rows = polygons(spark, shapes).unionByName(spark.createDataFrame([("null", None)], "uid string, geom array<array<struct<x: double, y: double>>>"))
    for band in (0.3, 1.0, 50.0):
        got = {x.uid: x.fault for x in zonal.polygon_faults(rows, band).collect()}
        assert got == {"bow": "no area", "line": "no area", "spike": "repeated point", "back": "crossing", "touch": "crossing", "hole across": "crossing", "none": "no ring", "empty": "no ring", "null": "no ring"}
    good, bad = zonal.valid_polygons(rows)
    assert {x.uid for x in good.collect()} == {"good", "closed", "hole touching in a corner"} and "fault" in bad.columns


def test_within(spark):
    """Touching edges, holes, parcels that reach out between two pixel centres, a dent, and a parcel without any pixel centre."""
    foot = polygons(spark, {"f": [[(0, 0), (10, 0), (10, 10), (5, 7), (0, 10)], [(2, 2), (4, 2), (4, 4), (2, 4)]]})
    box = lambda x, y, w, h=None: [[(x, y), (x + w, y), (x + w, y + (h or w)), (x, y + (h or w))]]
    inside = {"in": box(5, 1, 3), "touch side": box(0, 0, 2, 2), "touch hole": box(4, 2, 2, 2), "tiny": box(1.1, 1.1, 0.1), "on both": box(0, 0, 10, 2), "itself": [[(0, 0), (10, 0), (10, 10), (5, 7), (0, 10)], [(2, 2), (4, 2), (4, 4), (2, 4)]]}
    outside = {"out": box(20, 1, 3), "over hole": box(1, 1, 4), "in hole": box(2.5, 2.5, 1), "corner out": [[(9, 1), (10.2, 1.5), (9, 2)]], "dent": box(3, 5, 4, 3), "over dent": [[(0, 10), (10, 10), (10, 0), (0, 0)]], "through corner": [[(8, 5), (12, 13), (8, 6)]], "filled hole": [[(0, 0), (10, 0), (10, 10), (5, 7), (0, 10)]], "equals hole": box(2, 2, 2)}
    for band in (0.7, 3.0):
        got = {x.uid for x in zonal.within_footprint(polygons(spark, inside | outside), foot, band).collect()}
        assert got == set(inside)


def test_negative_buffer_meets_few_edges(spark):
    """A ring of 3000 edges around some 70 000 pixels, against the distance from a circle; pixels meet the edges of their block only."""
    n, radius = 3000, 150.0
    circle = [(200 + radius * math.cos(2 * math.pi * i / n), 200 + radius * math.sin(2 * math.pi * i / n)) for i in range(n)]
    rows = polygons(spark, {"c": [circle], "small": [[(0, 0), (3, 0), (3, 3), (0, 3)]]})
    cells = zonal.rasterised(rows).persist()
    near = zonal.near_edges(cells, rows, 2.5)
    assert cells.count() > 70_000 and near.count() < 6 * cells.count()  # of 3000 edges for each pixel
    kept = {(x.row, x.col) for x in zonal.eroded(cells, rows, 2.5).where("uid = 'c'").collect()}
    for x in cells.where("uid = 'c'").collect():
        d = radius - math.hypot(x.col + 0.5 - 200, x.row + 0.5 - 200)
        if abs(d - 2.5) > 0.01:
            assert ((x.row, x.col) in kept) == (d > 2.5)
    assert [x.uid for x in zonal.emptied(rows, buffer=1.6).collect()] == ["small"] and zonal.emptied(rows, buffer=1.0).count() == 0


@pytest.mark.parametrize("half", [1, 3])
def test_neighbourhoods_with_gaps(spark, half):
    """Images with holes, single pixels and nulls, against plain loops; no pixel is copied beyond the cells at gaps."""
    r = random.Random(half)
    cells = {(t, i, j): None if r.random() < 0.1 else r.uniform(-1, 1) for t in (0, 1) for i in range(14) for j in range(20) if r.random() < (0.9 if t else 0.25)}
    df = spark.createDataFrame([(t, i, j, v, r.choice([4, 5, 9, None])) for (t, i, j), v in cells.items()], "tile int, row long, col long, value double, scl int").persist()
    scl = {(x.tile, x.row, x.col): x.scl for x in df.collect()}
    around = lambda p: [q for q in cells if q[0] == p[0] and abs(q[1] - p[1]) <= half and abs(q[2] - p[2]) <= half]
    means = {(x.tile, x.row, x.col): x.focal_mean for x in raster.focal_mean(df, 2 * half + 1).collect()}
    clouds = {(x.tile, x.row, x.col): x.near_cloud for x in raster.dilated_cloud(df, half).collect()}
    scores = {(x.tile, x.row, x.col): x.dtc for x in raster.distance_score(df.withColumn("image", F.lit("i")), half, 1.0).collect()}
    mass = sum(math.exp(-i * i / 2) for i in range(-half, half + 1)) ** 2
    assert set(means) == set(clouds) == set(scores) == set(cells)
    for p in cells:
        near = [cells[q] for q in around(p) if cells[q] is not None]
        assert means[p] is None and not near or math.isclose(means[p], sum(near) / len(near), abs_tol=1e-12)
        assert clouds[p] == any(scl[q] == 9 for q in around(p))
        assert math.isclose(scores[p], 1 - sum(math.exp(-((q[1] - p[1]) ** 2 + (q[2] - p[2]) ** 2) / 2) for q in around(p) if scl[q] == 9) / mass, abs_tol=1e-12)
    twice = {x.col: x.focal_mean for x in raster.focal_mean(spark.createDataFrame([(0, 0, c, v) for c, v in ((0, 1.0), (0, 3.0), (1, 5.0), (9, 7.0))], "tile int, row long, col long, value double"), 3).collect()}
    assert twice == {0: 3.0, 1: 3.0, 9: 7.0}
    dense = spark.range(900).select(F.lit(0).alias("tile"), F.floor(F.col("id") / 30).alias("row"), (F.col("id") % 30).alias("col"), F.col("id").cast("double").alias("value"))
    assert raster._with_gaps(dense, half).count() == 30 * (30 + 2 * half)


@pytest.mark.parametrize("name", ["footprint_parcels", "polygon_faults", "coverage_fractions", "emptied_parcels", "zonal_eroded", "zonal_half_pixels", "zonal_coverage", "polygon_validity", "lost_parcels", "zonal_polygons", "run_time_series"])
def test_edges_and_pixels_are_never_broadcast(spark, name):
    import __spark_entry__

    plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    # only the one polygon of an image is sent to all tasks
    assert plan.count("BroadcastHashJoin") == (3 if name == "footprint_parcels" else 0)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def slices(spark, rows, cols, n=3):
    """Pixels of n slices with gaps, repeated values, nulls, a NaN and a pixel that is there twice."""
    r = random.Random(5)
    cells = [(f"s{k}", k % 2 or None, i, j, None if r.random() < 0.1 else float("nan") if r.random() < 0.01 else float(r.randrange(5)) - 2) for k in range(n) for i in rows for j in cols if r.random() < 0.9]
    return spark.createDataFrame(cells + cells[:1], "profile string, part int, row long, col long, value double")


@pytest.mark.parametrize("home, boxes, values", [(128, 1 << 20, 1 << 21), (8, 40, 50)])
def test_pixels_come_to_parcels(spark, monkeypatch, home, boxes, values):
    """Parcels with holes, faults, many points, a wide box, without pixels, below 0: as if all were dealt out as pixels; also in groups of few."""
    for name, x in (("HOME", home), ("SENT", max(4, home // 4)), ("MOST_BOXES", boxes), ("MOST_VALUES", values)):
        monkeypatch.setattr(zonal, name, x)
    r = random.Random(3)
    shapes = {f"p{i}": [[(x + 5 * math.cos(a) * r.uniform(0.3, 1), y + 5 * math.sin(a) * r.uniform(0.3, 1)) for a in (0, 1, 2, 3, 4, 5)]] for i in range(60) for x, y in [(r.uniform(-30, 30), r.uniform(-30, 30))]}
    circle = [(3 + 9 * math.cos(2 * math.pi * i / 90), 3 + 9 * math.sin(2 * math.pi * i / 90)) for i in range(90)]
    shapes |= {"hole": [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 9)], [(3, 3), (5, 3), (5, 5), (3, 5)]], "bow": [[(0, 0), (2, 2), (0, 2), (2, 0)]], "line": [[(0, 0), (5, 0), (9, 0)]], "spike": [[(0, 0), (4, 0), (4, 4), (8, 4), (4, 4), (0, 4)]], "many": [circle], "wide": [[(-300, 0.2), (300, 0.2), (300, 1.9)]], "far": [[(900, 900), (905, 900), (905, 905)]], "thin": [[(1, 1.6), (8, 1.6), (8, 1.9)]], "empty": [], "two points": [[(0, 0), (3, 3)]], "corners": [[(2.5, 2.5), (6.5, 2.5), (6.5, 6.5), (2.5, 6.5)]]}
    rows = polygons(spark, shapes).unionByName(spark.createDataFrame([("null", None)], "uid string, geom array<array<struct<x: double, y: double>>>"))
    pixels, keys = slices(spark, range(-35, 36), range(-35, 36)), ["profile", "part"]
    digits = lambda df: sorted(tuple(round(x, 9) + 0.0 if isinstance(x, float) else x for x in row) for row in map(tuple, df.na.fill(-1, ["part"]).na.fill(-99.0).collect()))
    plain = zonal.zonal_stats(pixels, zonal.valid_polygons(rows)[0], keys)
    got = zonal.valid_stats(pixels, rows, keys)
    assert got.columns == plain.columns and [f.dataType for f in got.schema] == [f.dataType for f in plain.schema]
    assert str(digits(got)) == str(digits(plain)) and {"hole", "many", "wide", "p1"} <= {x.uid for x in got.collect()}
    assert {x.uid for x in zonal._faultless(rows.where(zonal.few()), "geom").collect()} == {x.uid for x in zonal.valid_polygons(rows.where(zonal.few()))[0].collect()}
    twice = rows.unionByName(rows.where("uid = 'hole'"))
    assert str(digits(zonal.valid_stats(pixels, twice, keys))) == str(digits(zonal.zonal_stats(pixels, zonal.valid_polygons(twice)[0], keys)))
    assert zonal.valid_stats(pixels, rows.limit(0), keys).count() == 0 and zonal.valid_stats(pixels.limit(0), rows, keys).count() == 0


def test_shuffles_do_not_grow_with_pixels_in_parcels(spark):
    """3000 parcels on the same 50 pixels of 12 slices: more than a million pairs, of which none is shuffled."""
    from fieldlark.plans import pipelines

    rows = polygons(spark, {f"p{i}": [[(1, 1), (11, 1), (11, 6), (1, 6)]] for i in range(3000)})
    images = {"a": slices(spark, range(8), range(13), 12).where("value = value").select(F.lit("a").alias("image_profile"), F.date_add(F.lit("2024-01-01").cast("date"), F.substring("profile", 2, 2).cast("int")).alias("start_date"), F.lit(0).alias("tile"), "row", "col", F.col("value").alias("b"))}
    sc = spark.sparkContext
    sc.setJobGroup("shuffled", "")
    got = pipelines.time_series(images, rows, ["a"]).collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    store, tracker = sc._jsc.sc().statusStore(), sc.statusTracker()
    stages = {i for job in tracker.getJobIdsForGroup("shuffled") for i in tracker.getJobInfo(job).stageIds}
    assert len(got) == 3000 * 12 and all(30 <= x["count"] <= 51 for x in got)
    assert 3000 <= sum(store.lastStageAttempt(i).shuffleWriteRecords() for i in stages) < 40_000
