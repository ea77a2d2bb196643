"""Exact values and every branch of the parcel operators on rows of their own."""

import datetime as dt
import fractions
import math
import statistics

import pytest
from pyspark.sql import functions as F

from fieldlark.functions import bands, dates, nulls, values
from fieldlark.operators import consolidate, cover, features, labels, raster, report, sampling, zonal

D = dt.date


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


@pytest.mark.parametrize(
    "day, before, after, b2, a2",
    [
        ("2024-01-05", D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 1), D(2024, 1, 15)),
        ("2024-01-10", D(2024, 1, 8), D(2024, 1, 15), D(2024, 1, 1), D(2024, 1, 15)),
        ("2023-01-01", D(2022, 12, 26), D(2023, 1, 2), D(2022, 12, 19), D(2023, 1, 2)),
        ("2024-02-05", D(2024, 2, 5), D(2024, 2, 5), D(2024, 1, 29), D(2024, 2, 12)),
    ],
)
def test_mondays(spark, day, before, after, b2, a2):
    d = F.to_date(F.lit(day))
    assert tuple(one(spark, a=dates.monday_before(d), b=dates.monday_after(d), c=dates.biweekly_before(d), d=dates.biweekly_after(d))) == (before, after, b2, a2)


@pytest.mark.parametrize("start, end, kind, n", [("2024-01-01", "2024-01-17", "weekly", 2), ("2024-01-02", "2024-01-17", "weekly", 1), ("2024-03-03", "2024-03-20", "weekly", 2), ("2024-01-01", "2024-01-30", "biweekly", 2), ("2024-01-02", "2024-01-30", "biweekly", 1)])
def test_periods(spark, start, end, kind, n):
    assert dates.periods(spark, start, end, kind, today="2024-06-01").count() == n


def test_periods_between_equal_days_are_an_error(spark):
    with pytest.raises(ValueError):
        dates.periods(spark, "2024-01-02", "2024-01-09", "weekly", today="2024-06-01")


def test_no_period_reaches_past_today(spark):
    assert dates.periods(spark, "2024-01-01", "2024-01-29", "weekly", today="2024-01-10").count() == 1


def test_missing_values_differ(spark):
    n, a = F.lit(None).cast("string"), F.lit("a")
    assert tuple(one(spark, a=nulls.differs(n, n), b=nulls.differs(a, n), c=nulls.differs(a, a), d=nulls.same(n, n))) == (True, True, False, False)


def test_bands_of_nothing(spark):
    z, n = F.lit(0.0), F.lit(None).cast("double")
    assert tuple(one(spark, a=bands.ndvi(z, z), b=bands.pack(n, "ndvi"), c=bands.pack(F.lit(5.0), "ndvi"), d=bands.pack(F.lit(-1.0), "ndvi"), e=bands.decibel(z))) == (None, 255, 250, 0, None)


def test_bins_and_rounding(spark):
    r = one(spark, a=values.binned(F.lit(0)), b=values.binned(F.lit(6)), c=values.binned(F.lit(20000)), d=values.percent(F.lit(0.125)), e=values.trailing_number(F.lit("A_2.5")), f=values.trailing_number(F.lit("A_x")), g=values.code_key(F.lit(60.0)))
    assert tuple(r) == ("[0, 1]", "(5, 10]", None, 0.12, 2.5, 0.0, "60")


def test_label_rules(spark):
    parcels = spark.createDataFrame([("1", "60", "A,B", None, None), ("2", "60", "SER", "MON_TEELTEN_VROEGE", "BG"), ("3", "99", "CON", "MON_TEELTEN_VROEGE", None), ("4", "7", None, "x", None)], "uid string, cropcode string, prod_method string, early_late string, grass_status string")
    lut = spark.createDataFrame([("60", "GRASS"), ("99", "nvt")], "cropcode string, cls string")
    got = {r["uid"]: r["classname"] for r in labels.prepare(parcels, lut, "CROPGROUP", 1, "cls").collect()}
    assert got == {"1": "GRASS", "2": "MON_CG_OVERK_LOO", "3": "MON_CG_CONTAINERS", "4": "UNKNOWN"}
    early = {r["uid"]: r["classname"] for r in labels.prepare(parcels, lut, "CROPGROUP-EARLY", 1, "cls").collect()}
    assert early == {"1": labels.NEW_GRASS, "2": "MON_CG_OVERK_LOO", "3": "MON_CG_CONTAINERS", "4": labels.LATE}
    assert {r["classname"] for r in labels.prepare(parcels, lut, "FABACEAE", 9, "cls").collect()} == {labels.FEW}
    with pytest.raises(ValueError):
        labels.checked_lookup(lut.union(lut), "cropcode")


def test_consolidation_ladder(spark):
    rows = spark.createDataFrame(
        [("1", "UNKNOWN", "A", 0.9, "B", 0.05, 20), ("2", "A", "NODATA", None, None, None, 20), ("3", "A", "A", 0.4, "B", 0.3, 20), ("4", "A", "B", 0.5, "A", 0.1, 20), ("5", None, "B", 0.5, "A", 0.1, 20), ("6", "A", "A", 0.15, "B", 0.01, 20), ("7", "A", "A", 0.9, "B", 0.1, 2), ("8", "A", "A", 0.9, "B", 0.1, 20)],
        "uid string, classname_declared string, pred1 string, pred1_prob double, pred2 string, pred2_prob double, pixcount int",
    )
    got = {r["uid"]: (r["pred_consolidated"], r["pred_consolidated_prob"]) for r in consolidate.consolidated(rows, ["IGN"]).collect()}
    assert got == {
        "1": ("IGNORE:NOT_DECLARED", 1.0), "2": ("NODATA", -1.0), "3": ("DOUBT:PROBA1<2*PROBA2", -1.0), "4": ("DOUBT:PRED<>INPUT-PROBA1<X", -1.0), "5": ("DOUBT:PRED<>INPUT-PROBA1<X", -1.0),
        "6": ("DOUBT:PRED=INPUT-PROBA1<X", -1.0), "7": ("DOUBT:NOT_ENOUGH_PIXELS", -1.0), "8": ("A", -1.0),
    }
    with pytest.raises(ValueError):
        consolidate.consolidated(rows, [], consolidate.Doubt(retain_top=9))


def test_quotas_are_exact(spark):
    rows = spark.range(100).select(F.col("id").alias("uid"), F.when(F.col("id") < 90, "big").otherwise("small").alias("c"))
    tiers = (sampling.Tier(50, 20), sampling.Tier(0, 30, True))
    got = {r["c"]: r["n"] for r in sampling.class_counts(sampling.balanced(rows, tiers, "c"), "c").collect()}
    assert got == {"big": 20, "small": 30}
    folds = {(r["c"], r["fold"]): r["count"] for r in sampling.fold_ids(rows, 4, "c").groupBy("c", "fold").count().collect()}
    assert max(v for (c, _), v in folds.items() if c == "big") - min(v for (c, _), v in folds.items() if c == "big") <= 1


def test_scores_of_labels_that_only_one_side_has(spark):
    rows = spark.createDataFrame([("A", "A"), ("A", "B"), ("C", "A")], "t string, p string")
    got = report.accuracy(rows, "t", "p").first()
    assert round(got["accuracy"], 3) == 33.333 and round(got["f1_macro"], 3) == round(100 * (0.5 + 0 + 0) / 3, 3)


def test_zonal_rectangle_and_hole(spark):
    square = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    parcels = spark.createDataFrame([("r", [square(1.0, 1.0, 5.0, 4.0)]), ("h", [square(0.0, 0.0, 6.0, 6.0), square(2.0, 2.0, 4.0, 4.0)])], "uid string, geom array<array<struct<x:double,y:double>>>")
    got = {r["uid"]: r["count"] for r in zonal.rasterised(parcels).groupBy("uid").count().collect()}
    assert got == {"r": 12, "h": 32}
    pixels = spark.range(100).select(F.lit("i").alias("image"), F.floor(F.col("id") / 10).alias("row"), (F.col("id") % 10).alias("col"), F.lit(2.0).alias("value"))
    stats = {r["uid"]: (r["count"], r["mean"]) for r in zonal.zonal_stats(pixels, parcels, ["image"], rule="centre_2x").collect()}
    assert stats == {"r": (12.0, 2.0), "h": (32.0, 2.0)}
    half = {r["uid"]: r["count"] for r in zonal.covered(parcels).groupBy("uid").count().collect()}
    assert half == {"r": 12, "h": 32}
    inner = {r["uid"]: r["count"] for r in zonal.eroded(zonal.rasterised(parcels), parcels, 1.0).groupBy("uid").count().collect()}
    assert inner == {"r": 2, "h": 0} or inner == {"r": 2}  # the frame is two pixels wide: no centre keeps the distance


def test_focal_mean_at_a_corner(spark):
    px = spark.range(9).select(F.lit(0).alias("tile"), F.floor(F.col("id") / 3).alias("row"), (F.col("id") % 3).alias("col"), F.col("id").cast("double").alias("value"))
    got = {(r["row"], r["col"]): r["focal_mean"] for r in raster.focal_mean(px, 3).collect()}
    assert got[(0, 0)] == 2.0 and got[(1, 1)] == 4.0


def test_best_week_mixes_rows(spark):
    rows = spark.createDataFrame([("1", D(2024, 1, 1), 0.9, None), ("1", D(2024, 1, 8), 0.5, "x")], "uid string, start_date date, pred1_prob double, c string")
    assert cover.best_week(rows, ["c"]).first().asDict() == {"uid": "1", "c": "x", "pred1_prob": 0.9}


def test_features_without_data_are_an_error(spark):
    parcels = spark.createDataFrame([("1",)], "uid string")
    with pytest.raises(ValueError):
        features.feature_matrix(spark.createDataFrame([], "uid string, feature string, value double"), parcels)


def test_tables_round_trip(spark, tmp_path):
    from fieldlark.sources import tables

    df = spark.createDataFrame([(1, 0.5, "a"), (2, None, "b")], "k long, x double, s string").coalesce(1)
    for kind in ("csv", "tsv", "parquet", "sqlite"):
        path = f"{tmp_path}/t.{kind}"
        tables.write(df, path)
        assert sorted((r["k"], r["x"], r["s"]) for r in tables.read(spark, path, ["k", "x", "s"]).collect()) == [(1, 0.5, "a"), (2, None, "b")]
    with pytest.raises(Exception):
        tables.write(df, f"{tmp_path}/t.parquet")
    assert tables.refresh(df, f"{tmp_path}/slices", ["s"]) == 2
    assert tables.refresh(df, f"{tmp_path}/slices", ["s"]) == 0


def test_weekly_stream_matches_its_batch_twin(spark, tmp_path):
    from fieldlark.streaming.weekly import weekly

    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i), "a", float(i)) for i in range(20)], "ts timestamp, k string, value double")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = weekly(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), ["k"])
    q = stream.writeStream.outputMode("complete").format("memory").queryName("weeks").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.table("weeks").collect())) == sorted(map(tuple, weekly(rows, ["k"]).collect()))


def test_statistics_keep_digits_of_large_means(spark):
    """Variances around 1e9, against the engine's own; ties, nulls and empty groups."""
    rows = [("a", 1e9 + k) for k in (1, 2, 3)] + [("b", 1e9 + k * 0.25) for k in range(50) for _ in range(k % 4)] + [("c", None), ("d", 5.0), ("d", None), ("e", -1e9), ("e", 1e9), ("e", 1e9)]
    df = spark.createDataFrame(rows, "k string, value double")
    got = {r["k"]: r for r in features.statistics(df, ["k"]).collect()}
    want = df.groupBy("k").agg(F.count("value").alias("n"), F.var_pop("value").alias("var"), F.stddev_pop("value").alias("std"), F.percentile("value", F.lit(0.5)).alias("median"), F.avg("value").alias("mean")).collect()
    for w in want:
        g = got[w["k"]]
        assert g["count"] == w["n"] and g["median"] == w["median"] and g["mean"] == w["mean"]
        xs = [x for k, x in rows if k == w["k"] and x is not None]
        if not xs:
            assert g["variance"] is None and g["std"] is None and w["var"] is None
            continue
        exact = statistics.pvariance([fractions.Fraction(x) for x in xs])
        for mine, theirs, true in ((g["variance"], w["var"], exact), (g["std"], w["std"], math.sqrt(exact))):
            assert math.isclose(mine, true, rel_tol=1e-9) and math.isclose(mine, theirs, rel_tol=1e-7)
    assert (got["e"]["majority"], got["e"]["minority"], got["a"]["majority"]) == (1e9, -1e9, 1e9 + 1)
