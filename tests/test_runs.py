"""Errors, sources, models and whole runs on rows of their own."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fieldlark.functions import values
from fieldlark.operators import features, labels, models, raster, report, sampling, zonal
from fieldlark.plans import pipelines, runs
from fieldlark.sources import tables


def test_errors(spark):
    rows = spark.createDataFrame([("1", "IGNORE:X", 9), ("2", "A", 9)], "uid string, classname string, pixcount int")
    with pytest.raises(ValueError, match="IGNORE:X"):
        sampling.training_candidates(rows, 1, [], [])
    with pytest.raises(ValueError, match="checked"):
        report.join_truth(rows, spark.createDataFrame([("9", "A")], "uid string, truth string"))
    with pytest.raises(ValueError, match="out of"):
        zonal.check_inside(spark.createDataFrame([("1", 0.0, 0.0, 5.0, 5.0)], "uid string, minx double, miny double, maxx double, maxy double"), (1.0, 0.0, 9.0, 9.0))
    slices = spark.createDataFrame([("a", 1), ("b", 2)], "p string, d int")
    with pytest.raises(ValueError, match="missing"):
        raster.missing_slices(slices, slices.where("d = 1"), ["p", "d"], "calculate_raise")
    with pytest.raises(ValueError, match="policy"):
        raster.missing_slices(slices, slices, ["p"], "else")
    with pytest.raises(Exception, match="greatest score is 0"):
        labels.corrections(spark.createDataFrame([("A_0",), ("B",)], "c string"), "c").collect()
    with pytest.raises(ValueError, match="unknown class type"):
        labels.prepare(rows, rows, "NO-SUCH-TYPE", 1, "classname")


def test_text_in_another_encoding(spark, tmp_path):
    for name, encoding in (("u", "utf-8"), ("w", "cp1252")):
        (tmp_path / f"{name}.csv").write_bytes("k,s\n1,crème 5 € „x“\n2,plain\n".encode(encoding))
        assert [tuple(r) for r in tables.read(spark, str(tmp_path / f"{name}.csv"), schema="k long, s string").collect()] == [(1, "crème 5 € „x“"), (2, "plain")]


def test_views_of_the_caller_stay(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("info")
    path = str(tmp_path / "t.parquet")
    spark.range(7).write.parquet(path)
    assert tables.read(spark, path, sql="SELECT id FROM info WHERE id > 4").count() == 2
    assert spark.table("info").count() == 3
    spark.catalog.dropTempView("info")


def test_slices_without_rows_add_none(spark, tmp_path):
    df = spark.createDataFrame([("1", 0.5)], "uid string, mean double")
    df.coalesce(1).write.parquet(str(tmp_path / "s1-grd_2024-01-01_2024-01-07_vv_mean.parquet"))
    df.limit(0).coalesce(1).write.parquet(str(tmp_path / "s1-grd_2024-01-08_2024-01-14_vv_mean.parquet"))
    got = tables.slices(spark, f"{tmp_path}/*", lambda p: features.from_path(F.regexp_extract(p, r"([^/]+\.parquet)/[^/]*$", 1))).collect()
    assert [(r["uid"], r["image_profile"], r["start_date"], r["band"]) for r in got] == [("1", "s1-grd", dt.date(2024, 1, 1), "vv")]


def test_metadata_files(spark, tmp_path):
    (tmp_path / "a.tif.json").write_text(json.dumps({"imageprofile": "s2-agri", "start_date": "2024-03-04", "end_date": "2024-03-10 00:00:00", "bands": ["B02", "B03"], "roi_bounds": [1, 2, 3, 4], "more": {"x": 1}}, indent=4))
    r = tables.sidecars(spark, f"{tmp_path}/*.json").first()
    assert (r["imageprofile"], r["start_date"], r["end_date"], r["end_date_incl"], r["bands"], r["roi_bounds"]) == ("s2-agri", dt.date(2024, 3, 4), dt.date(2024, 3, 10), None, ["B02", "B03"], [1.0, 2.0, 3.0, 4.0])


def test_converted_tables(spark, tmp_path):
    source = str(tmp_path / "a.parquet")
    spark.range(3).withColumn("x", F.lit(0.5)).write.parquet(source)
    tables.converted(spark, source, str(tmp_path / "a.csv"))
    assert tables.table_info(tables.read(spark, str(tmp_path / "a.csv"))) == {"rows": 3, "columns": ["id", "x"]}
    tables.copied(spark, source, str(tmp_path / "b.parquet"), "id > 0")
    assert tables.read(spark, str(tmp_path / "b.parquet")).count() == 2


def test_refresh_by_stream(spark, tmp_path):
    from fieldlark.streaming.weekly import refresh_slices

    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    for i in range(2):  # the second stream starts anew and gives the same table
        q = refresh_slices(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", ["k"], f"{tmp_path}/c{i}")
        q.processAllAvailable()
        q.stop()
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", 1), ("b", 2)]


def test_ranges_of_groups_and_nulls(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), ("b", 4.0)], "g string, x double")
    got = {(r["g"], r["x"]): r["min_max"] for r in values.min_max(rows, "x", "g").collect()}
    assert got == {("a", 1.0): 0.0, ("a", 3.0): 1.0, (None, 5.0): 0.0, (None, 9.0): 1.0, ("b", 4.0): None}


def test_ranks_are_those_of_one_sort(spark):
    """A class with most of the rows, and rows without a class."""
    rows = spark.range(900).select(F.col("id").alias("uid"), F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").alias("c"))
    got = {r["uid"]: (r["_rank"], r["_n"]) for r in sampling.by_hash(rows, "c", "uid", "s").collect()}
    import hashlib

    for c in ("hot", "b", None):
        ids = [r["uid"] for r in rows.where(F.col("c").eqNullSafe(c)).collect()]
        order = sorted(ids, key=lambda i: (hashlib.md5(f"s:{i}".encode()).hexdigest(), i))
        assert [got[i] for i in order] == [(k + 1, len(ids)) for k in range(len(ids))]


def clusters(spark, n=240):
    """Three classes that two features tell apart, and noise."""
    k = F.col("id") % 3
    return spark.range(n).select(F.col("id").cast("string").alias("uid"), F.concat(F.lit("C"), k.cast("string")).alias("classname"), (k + F.rand(1) * 0.4).alias("x1"), ((2 - k) * 2 + F.rand(2) * 0.4).alias("x2"), F.rand(3).alias("x3"), (F.col("id") % 4).cast("int").alias("fold")).persist()


@pytest.mark.parametrize("kind, options", [("randomforest", {"numTrees": 8, "maxDepth": 4}), ("gradientboosting", {"maxIter": 3, "maxDepth": 2}), ("multilayer_perceptron", {"maxIter": 60}), ("svm", {"maxIter": 20})])
def test_models_learn(spark, kind, options):
    rows, names = clusters(spark), ["x1", "x2", "x3"]
    learn, own = sampling.split_folds(rows, 0)
    scores = []
    for _ in range(2):
        model = models.train(learn, names, "classname", kind, **options)
        found, classes = models.probabilities(model, own.withColumn("surplus", F.lit(1)), ["uid", "classname"])
        assert classes == ["C0", "C1", "C2"]
        scores.append(sorted((r["uid"], r["classname"], *(round(r[c], 9) for c in classes)) for r in found.collect()))
    assert scores[0] == scores[1]  # a seed repeats
    assert all(abs(sum(r[2:]) - 1) < 1e-6 and min(r[2:]) >= 0 for r in scores[0])
    right = sum(max(zip(r[2:], classes))[1] == r[1] for r in scores[0])
    assert right > 0.9 * len(scores[0])
    with pytest.raises(ValueError, match="needs"):
        models.probabilities(model, own.drop("x2"), ["uid"])


def test_cross_prediction_and_neighbours(spark):
    rows, names = clusters(spark), ["x1", "x2", "x3"]
    got = models.cross_predict(rows, names, "classname", 4, numTrees=6, maxDepth=4).join(rows, "uid")
    assert got.count() == 240 and got.where("pred1 = classname").count() > 216
    learn, own = sampling.split_folds(rows, 1)
    whole = sorted(map(tuple, models.nearest_neighbours(learn, own, names, "classname", 5).collect()))
    assert len(whole) == 60 and all(0 < p <= 1 for _, _, p in whole)
    assert models.nearest_neighbours(learn.limit(0), own, names, "classname").where("pred1 is null").count() == 60


def plain_neighbours(learn, own, names, k):
    import math

    known, out = [(r["uid"], r["classname"], [r[c] for c in names]) for r in learn.collect()], {}
    for r in own.collect():
        near = sorted((round(math.dist([r[c] for c in names], x), 9), i, c) for i, c, x in known)[:k]
        n = {c: sum(c == x for _, _, x in near) for _, _, c in near}
        best = min(n, key=lambda c: (-n[c], c))
        out[r["uid"]] = (best, n[best] / len(near))
    return out


@pytest.mark.parametrize("chunk", [4096, 7])
def test_neighbours_skip_far_cells(spark, monkeypatch, chunk):
    """Against plain loops, with ties and cells in chunks; on clustered features less than half of the pairs are compared."""
    monkeypatch.setattr(models, "CHUNK", chunk)
    rows, names = clusters(spark, 1600).withColumn("x1", F.round("x1", 1)).withColumn("x2", F.round("x2", 1)).withColumn("x3", F.lit(0.0)), ["x1", "x2", "x3"]
    learn, own = sampling.split_folds(rows, 1)
    report = {}
    got = {r["uid"]: (r["pred1"], r["pred1_prob"]) for r in models.nearest_neighbours(learn, own, names, "classname", 5, report=report).collect()}
    assert got == plain_neighbours(learn, own, names, 5)
    assert report["pairs"] == 1200 * 400 and report["compared"] < 0.5 * report["pairs"]
    few = {r["uid"]: (r["pred1"], r["pred1_prob"]) for r in models.nearest_neighbours(learn.limit(3), own, names, "classname", 5).collect()}
    assert few == plain_neighbours(learn.limit(3), own, names, 5)


def test_kernel_machine_separates_rings(spark, tmp_path):
    """Two rings that no line separates; held-out log loss beats the class shares, also after saving and loading."""
    import math

    angle = F.rand(7) * 2 * math.pi
    radius = F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.0) + F.rand(8) * 0.2
    rows = spark.range(500).select(F.col("id").cast("string").alias("uid"), F.when(F.col("id") % 2 == 0, "in").otherwise("out").alias("classname"), (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"), (F.col("id") % 5).alias("fold")).persist()
    learn, own = rows.where("fold > 0"), rows.where("fold = 0")
    model = models.trained(learn, ["x", "y"], "classname", str(tmp_path / "m"), "svm", gamma=1.0, maxIter=30)
    again = models.trained(learn, ["x", "y"], "classname", str(tmp_path / "m"), "svm", gamma=1.0, maxIter=30)
    found, classes = models.probabilities(model, own, ["uid", "classname"])
    got = found.collect()
    assert classes == ["in", "out"] and sum((r["in"] > 0.5) == (r["classname"] == "in") for r in got) > 0.95 * len(got)
    assert sum(-math.log(r[r["classname"]]) for r in got) / len(got) < 0.5 * math.log(2)
    assert sorted(map(tuple, got)) == sorted(map(tuple, models.probabilities(again, own, ["uid", "classname"])[0].collect()))


def test_boosted_probabilities_are_calibrated(spark):
    """A class that holds with a known chance: within bins of the predicted probability the share of the class is near it."""
    x = F.rand(11)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("uid"), x.alias("x"), F.rand(12).alias("noise"), F.rand(13).alias("u")).withColumn("classname", F.when(F.col("u") < 0.1 + 0.8 * F.col("x"), "yes").otherwise("no")).persist()
    own = rows.where("cast(uid as int) % 3 = 0")
    model = models.train(rows.where("cast(uid as int) % 3 <> 0"), ["x", "noise"], "classname", "gradientboosting", maxIter=8, maxDepth=3)
    found, _ = models.probabilities(model, own, ["uid", "classname"])
    bins = found.groupBy(F.floor(F.col("yes") * 4).alias("b")).agg(F.avg("yes").alias("p"), F.avg((F.col("classname") == "yes").cast("double")).alias("share"), F.count("*").alias("n")).collect()
    assert all(abs(r["no"] + r["yes"] - 1) < 1e-9 for r in found.collect())
    error = sum(abs(r["p"] - r["share"]) * r["n"] for r in bins) / sum(r["n"] for r in bins)
    assert error < 0.05 and len(bins) >= 3


def test_a_classification_run(spark, tmp_path):
    """Parcels of three classes, told apart by two weeks of two bands; a second run takes the saved model."""
    n = F.col("uid").cast("long")
    parcels = spark.range(300).select(F.col("id").cast("string").alias("uid"), F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("classname"), F.lit(20).alias("pixcount"), F.lit("60").alias("cropcode"))
    parcels = parcels.withColumn("classname_declared", F.when(n % 50 == 0, "UNKNOWN").when(n % 10 == 1, F.concat(F.lit("C"), ((n + 1) % 3).cast("string"))).otherwise(F.col("classname"))).persist()
    weeks = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 7)), (dt.date(2024, 1, 8), dt.date(2024, 1, 14))], "start_date date, end_incl date")
    bands = spark.createDataFrame([("vv", 0.1), ("vh", 0.3)], "band string, w double")
    zonal_rows = parcels.crossJoin(weeks).crossJoin(bands).select("uid", F.lit("s1-grd-asc").alias("image_profile"), "start_date", "end_incl", "band", (n % 3 * 0.3 * F.col("w") + F.rand(4) * 0.02).alias("mean")).persist()
    truth = parcels.where(n % 2 == 0).select("uid", F.col("classname").alias("classname_truth"))
    path = str(tmp_path / "model")
    run = pipelines.classification(parcels, zonal_rows, [], [], [], path, strategy="UPPER_LIMIT", truth=truth, numTrees=8, maxDepth=4)
    assert run.features.count() == 300 and len(run.features.columns) == 5
    accuracy = run.reports["test_accuracy"].first()
    assert accuracy["accuracy"] > 90 and 50 <= accuracy["n"] <= 70
    verdicts = {r["uid"]: r for r in run.predictions.collect()}
    assert len(verdicts) == 300 and verdicts["0"]["pred_consolidated"] == "IGNORE:NOT_DECLARED" and sum(r["used_for_train"] for r in verdicts.values()) == run.sample.count()
    assert {"errors", "conclusions", "alpha_pixcount", "theta_probability", "accuracy_truth", "rows"} <= set(run.reports) and len([k for k in run.reports if k.split("_")[0] in ("alpha", "beta", "theta")]) == 12
    assert run.reports["conclusions"].agg(F.sum("n")).first()[0] == 300 and run.reports["rows"].first()["reported"] == 300
    # the same run again computes nothing, other rules only what depends on them, and a half-written stage is written anew
    store = runs.RunStore(spark, run.store.root)
    again = pipelines.classification(parcels, zonal_rows, [], [], [], path, strategy="UPPER_LIMIT", truth=truth, store=store, numTrees=8, maxDepth=4)
    assert store.made == [] and len(store.reused) == len(run.store.made)
    assert sorted(map(tuple, again.predictions.collect())) == sorted(map(tuple, run.predictions.collect()))
    store = runs.RunStore(spark, run.store.root)
    strict = pipelines.classification(parcels, zonal_rows, [], [], [], path, strategy="UPPER_LIMIT", truth=truth, store=store, rules=pipelines.CO.Doubt(least_pixels=30), numTrees=8, maxDepth=4)
    assert {"long_features", "features", "sample", "probabilities", "report_test_accuracy"} <= set(store.reused) and "verdicts" in store.made and "features" not in store.made
    assert strict.reports["conclusions"].where("value = 'DOUBT'").first()["n"] > 200
    store.delete("probabilities")
    resumed = runs.RunStore(spark, run.store.root)
    pipelines.classification(parcels, zonal_rows, [], [], [], path, strategy="UPPER_LIMIT", truth=truth, store=resumed, numTrees=8, maxDepth=4)
    assert resumed.made == ["probabilities"] and "verdicts" in resumed.reused
    assert {r["stage"] for r in resumed.manifest().collect()} >= {"features", "verdicts", "report_errors"}
    # every table of the report is one scan of a stored stage, and none joins
    for name, df in run.reports.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert name == "parameters" or plan.count("FileScan") == 1 and "Join" not in plan, name
    # a model of another kind, of other options or features is refused
    for change in ({"kind": "gradientboosting"}, {"numTrees": 1}):
        with pytest.raises(ValueError, match="differs in"):
            pipelines.classification(parcels, zonal_rows, [], [], [], path, strategy="UPPER_LIMIT", **{"numTrees": 8, "maxDepth": 4, **change})
    model = models.PipelineModel.load(path)
    models.same_features(model, [c for c in run.features.columns if c != "uid"])
    with pytest.raises(ValueError, match="is of"):
        models.same_features(model, ["x"])
    stored = [str(tmp_path / x) for x in ("parcels", "probabilities")]
    parcels.write.parquet(stored[0])
    models.train_and_predict({"train": run.sample, "all": parcels.select("uid")}, run.features, "classname", path, numTrees=8, maxDepth=4)["all"][0].write.parquet(stored[1])
    tables_again = pipelines.reported_again(spark, *stored, ["C0", "C1", "C2"], [], [], [], pipelines.CO.Doubt(least_pixels=30), truth=None)
    assert tables_again["conclusions"].where("value = 'DOUBT'").first()["n"] > 200
    root = run.store._path(run.store.root)
    assert root[1].exists(root[0])
    run.store.delete()
    assert not root[1].exists(root[0])


def test_versions_of_inputs(spark, tmp_path):
    """A file that changes gives another version, and its stages are made again; a stage that fails leaves no manifest."""
    path = str(tmp_path / "in")
    spark.range(5).write.parquet(path)
    results = []
    for rows in (5, 5, 9):
        if rows == 9:
            spark.range(9).write.mode("overwrite").parquet(path)
        store = runs.RunStore(spark, str(tmp_path / "runs"))
        df = store.input("in", spark.read.parquet(path))
        results.append((store.stage("twice", lambda df=df: df.selectExpr("id * 2 AS x"), ["in"], factor=2).count(), store.made))
    assert results == [(5, ["twice"]), (5, []), (9, ["twice"])]
    store = runs.RunStore(spark, str(tmp_path / "runs"))
    store.input("in", spark.range(1), "v1")
    with pytest.raises(Exception, match="BROKEN"):
        store.stage("bad", lambda: spark.range(1).selectExpr("raise_error('BROKEN') AS x"), ["in"])
    assert store.stage("bad", lambda: spark.range(3), ["in"]).count() == 3 and store.made == ["bad"]


def test_mosaics_are_made_once(spark, tmp_path):
    """A second run writes nothing, a later week only itself, a derived profile reads its stored base; scans are pruned by tiles."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(0, 28, 3)]
    rows = [(i // 4, i, j, d, dt.datetime(d.year, d.month, d.day, 10), str(d), 4 if (i + j) % 5 else 9, float(i + j), float(i * j)) for d in days for i in range(8) for j in range(5)]
    pixels = spark.createDataFrame(rows, "tile long, row long, col long, day date, ts timestamp, image string, scl int, b08 double, b04 double")
    from fieldlark.functions import bands as B

    profiles = {"base": pipelines.Profile(("b08", "b04"), "max"), "ndvi": pipelines.Profile(base="base", index={"ndvi": lambda: B.ndvi(F.col("b04"), F.col("b08"))})}
    path = str(tmp_path / "mosaics")
    args = (profiles, ["ndvi"], "2024-01-01")
    written = [pipelines.kept_mosaics(pixels, *args, end, path).count() for end in ("2024-01-22", "2024-01-22", "2024-01-29", "2024-01-29")]
    assert written == [6, 0, 2, 0]  # three weeks of two profiles, then one week
    assert pipelines.kept_mosaics(pixels, *args, "2024-01-15", path, force=True).count() == 4
    direct = pipelines.mosaics(pixels, profiles, ["ndvi"], "2024-01-01", "2024-01-29")["ndvi"]
    kept = pipelines.images_at(spark, path, "ndvi", ("ndvi",))
    show = lambda df: sorted((r["start_date"], r["tile"], r["row"], r["col"], r["ndvi"] if r["ndvi"] is None else round(r["ndvi"], 9)) for r in df.collect())
    assert show(kept) == show(direct) and kept.count() == 4 * 40
    cells = spark.createDataFrame([("p", 1, 2), ("p", 2, 2)], "uid string, row long, col long")
    found = pipelines.pixels_of_parcels(kept, cells, lambda: F.floor(F.col("row") / 4))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and found.count() == 8 and {r["tile"] for r in found.collect()} == {0}
    with pytest.raises(ValueError, match="unknown"):
        pipelines.kept_mosaics(pixels, profiles, ["other"], "2024-01-01", "2024-01-29", path)


def test_folders_of_mosaics_do_not_grow_with_tiles(spark, tmp_path):
    """A slice has as many folders at most as there are blocks, whatever the number of its tiles."""
    when = dt.datetime(2024, 1, 2, 10)
    tiles = range(-100, 100)
    pixels = spark.createDataFrame([(i, 4 * i, 0, when.date(), when, "a", 4, float(i), 1.0) for i in tiles], "tile long, row long, col long, day date, ts timestamp, image string, scl int, b08 double, b04 double")
    profiles, path = {"base": pipelines.Profile(("b08", "b04"), "max")}, str(tmp_path / "mosaics")
    assert pipelines.kept_mosaics(pixels, profiles, ["base"], "2024-01-01", "2024-01-08", path).count() == 1
    folders = {p.parent for p in (tmp_path / "mosaics" / "images").rglob("*.parquet")}
    assert len(folders) == pipelines.TILE_BLOCKS
    kept = pipelines.images_at(spark, path, "base", ("b08", "b04"))
    assert sorted((r["tile"], r["row"], r["b08"]) for r in kept.collect()) == [(i, 4 * i, float(i)) for i in tiles]
    cells = spark.createDataFrame([("p", -396, 0), ("p", -396, 0), ("q", 128, 0), ("q", 132, 1)], "uid string, row long, col long")
    found = pipelines.pixels_of_parcels(kept, cells, lambda: F.floor(F.col("row") / 4))
    assert sorted((r["uid"], r["tile"], r["b08"]) for r in found.collect()) == [("p", -99, -99.0), ("p", -99, -99.0), ("q", 32, 32.0)]


def test_streamed_statistics_equal_the_batch(spark, tmp_path):
    """All eleven statistics, with late rows and a restart between files; weeks are emitted once, when the watermark passes."""
    import random

    from fieldlark.streaming import weekly as W

    r = random.Random(4)
    day = lambda n: dt.datetime(2024, 1, 1, 12) + dt.timedelta(n)
    parts = [[(day(r.randrange(7 * w, 7 * w + 7)), r.choice("ab"), r.choice([None, 1.0, 2.0, 2.0, 1e9, 1e9 + 1])) for _ in range(40)] for w in range(4)]
    parts[3] += [(day(1), "a", 77.0)]  # too late by now
    parts += [[(day(60), "z", 0.0)]]
    schema = "ts timestamp, uid string, value double"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = W.weekly_statistics(stream, ["uid"]).writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(out)  # a restart for each file
        q.processAllAvailable()
        q.stop()
    good = [x for part in parts[:4] for x in part if x[2] != 77.0]
    want = W.weekly_statistics(spark.createDataFrame(good, schema), ["uid"])
    show = lambda df: sorted((str(x["week"]["start"]), *(x[c] for c in want.columns[1:])) for x in df.collect())
    assert show(spark.read.parquet(out)) == show(want) and want.count() == 8
    cover = {str(x["week"]["start"])[:10]: x["row_pct"] for x in W.weekly_coverage(want, 4, []).collect()}
    assert set(cover.values()) == {50.0}


def test_run_classification_learns_from_all_rows_as_its_sql(spark, monkeypatch):
    import __spark_entry__

    from oracle import compare

    # an upper limit that small classes reach too
    monkeypatch.setitem(sampling.STRATEGIES, "UPPER_LIMIT", (sampling.Tier(2, 2), sampling.Tier(0, None)))
    compare(spark, __spark_entry__.queries()["run_classification"], __spark_entry__.oracle_sql()["run_classification"])


def test_kernel_features_keep_plans_small(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense([0.0, 1.0, 2.0]),), (Vectors.sparse(3, [1], [4.0]),)], ["x"]).repartition(3)
    out = models.RandomFourier(inputCol="x", outputCol="f", components=200, width=3, gamma=0.5, seed=7).transform(rows)
    # as literals the projections took 800 expressions of every later plan
    assert len(out._jdf.queryExecution().analyzed().toJSON()) < 40_000
    got = {tuple(r.x.toArray()): r.f.toArray() for r in out.collect()}
    (a, fa), (b, fb) = got.items()
    kernel = 2.718281828459045 ** (-0.5 * sum((p - q) ** 2 for p, q in zip(a, b)))
    assert len(fa) == 200 and abs(fa @ fa - 1) < 0.2 and abs(fa @ fb - kernel) < 0.2


def test_boosting_takes_all_its_trees(spark):
    """No option of the query shortens the boosting; its default is that of the reference's library."""
    from fieldlark.plans import queries_more

    seen = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(queries_more.MO, "train", lambda rows, names, column, kind, **options: seen.update({kind: options}))
        m.setattr(queries_more.MO, "probabilities", lambda model, rows, keep: (rows, []))
        queries_more.model_gradient_boosting(spark, "/root/testdata/sf0.001")
    boosted = models.CLASSIFIERS["gradientboosting"](2, 2, **seen["gradientboosting"]).getClassifier()
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (100, 5)
    learn, names = sampling.split_folds(clusters(spark, 60), 0)[0], ["x1", "x2", "x3"]
    fitted = next(s for s in models.train(learn, names, "classname", "gradientboosting", maxIter=3, maxDepth=2).stages if hasattr(s, "models"))
    assert [m.getNumTrees for m in fitted.models] == [3, 3, 3]


def test_kernel_machine_goes_on_to_its_tolerance(spark):
    """No option of the query stops the fit early: it is as good as one of many more steps, and better than one of five."""
    import numpy as np

    from fieldlark.plans import queries_more

    seen = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(queries_more.MO, "train", lambda rows, names, column, kind, **options: seen.update(options))
        m.setattr(queries_more.MO, "probabilities", lambda model, rows, keep: (rows, []))
        queries_more.model_svm(spark, "/root/testdata/sf0.001")
    rows = spark.range(120).select(F.when(F.rand(1) < 0.5 + 0.4 * F.signum(F.rand(2) - 0.5), "a").otherwise("b").alias("classname"), F.randn(3).alias("x"), F.randn(4).alias("y")).persist()
    n = rows.count()

    def objective(**options) -> float:
        """Mean hinge loss and penalty of the machine of the first class, by plain sums."""
        model = models.train(rows, ["x", "y"], "classname", "svm", gamma=1.0, components=40, **options)
        machine, ready = next(s for s in model.stages if hasattr(s, "models")).models[0], rows
        for stage in model.stages[:4]:
            ready = stage.transform(ready)
        w, b = machine.coefficients.toArray(), machine.intercept
        got = [(1.0 if r["_label"] == 0 else -1.0, r["_features"].toArray()) for r in ready.collect()]
        return sum(max(0.0, 1 - y * (float(np.dot(w, x)) + b)) for y, x in got) / n + float(np.dot(w, w)) / (2 * n)

    whole, long, short = objective(**seen), objective(maxIter=2000), objective(maxIter=5)
    assert abs(whole - long) < 1e-6 and whole < short - 1e-3
