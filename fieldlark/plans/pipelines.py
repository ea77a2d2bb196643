"""The runs that compose the operators: images, time series, parcels, classification, cover, consolidation, reports.

Each run is a function of DataFrames that returns DataFrames. Images, series and cover are lazy but for the checks that raise errors;
classification and reports keep their steps in a store of runs, and each table is read from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions.nulls import within
from ..functions.values import EDGES, bin_labels, binned, percent
from ..operators import consolidate as CO
from ..operators import cover as CV
from ..operators import features as FE
from ..operators import labels as LA
from ..operators import models as MO
from ..operators import raster as RA
from ..operators import report as RE
from ..operators import sampling as SA
from ..operators import zonal as ZO
from .runs import RunStore, shared_folder


@dataclass(frozen=True)
class Profile:
    """An image profile: bands and reducer of a mosaic, or, with `base`, band expressions over the mosaic of another profile."""

    bands: tuple[str, ...] = ()
    reducer: str = "mean"
    base: str | None = None
    index: dict[str, Callable[[], Column]] = field(default_factory=dict)
    most_cloud_pct: float | None = None


def mosaics(pixels: DataFrame, profiles: dict[str, Profile], wanted: list[str], start: str, end: str, day: str = "day", ts: str = "ts", image: str = "image", scl: str = "scl") -> dict[str, DataFrame]:
    """Weekly mosaics (image_profile, start_date, tile, row, col, bands) of the wanted profiles; those they are based on are made, not returned.

    Bad pixels are masked, images above a profile's cloud share left out. An unknown profile is an error.
    """
    unknown = [p for p in wanted if p not in profiles]
    if unknown:
        raise ValueError(f"unknown profiles {unknown}")
    monday = F.date_trunc("week", F.col(day)).cast("date")
    rows = pixels.withColumn("start_date", monday).where((F.col("start_date") >= F.to_date(F.lit(start))) & (F.date_add("start_date", 7) <= F.to_date(F.lit(end))))

    def made(name: str) -> DataFrame:
        p = profiles[name]
        if p.base is not None:
            return RA.derived(made(p.base).withColumn("image_profile", F.lit(name)), {c: f() for c, f in p.index.items()})
        clear = rows if p.most_cloud_pct is None else RA.without_cloudy_images(rows, [image], p.most_cloud_pct, scl)
        out = RA.composite(RA.masked(clear, list(p.bands), scl), ["start_date", *RA.PIXEL], list(p.bands), p.reducer, ts)
        return out.select(F.lit(name).alias("image_profile"), "start_date", *RA.PIXEL, *p.bands)

    return {name: made(name) for name in wanted}


#: How image tables are partitioned: readers of some profiles, periods and tiles open those folders alone. A block holds the
#: tiles of one remainder, so that a slice has as many folders, whatever the number of its tiles; files are sorted by tile.
IMAGE_KEYS = ("image_profile", "start_date", "tile_block")
TILE_BLOCKS = 32


def tile_block() -> Column:
    return F.pmod(F.col("tile").cast("long"), F.lit(TILE_BLOCKS)).cast("int")


def stored_slices(spark: SparkSession, path: str) -> DataFrame | None:
    """(image_profile, start_date) of the slices that are stored at a path, with a row for those without pixels too; None without any."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/slices")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema("image_profile string, start_date date").parquet(f"{path}/slices")


def images_at(spark: SparkSession, path: str, profile: str, bands: tuple[str, ...]) -> DataFrame:
    """The stored images of a profile: pixels with their bands, partitioned by IMAGE_KEYS; a band that older slices lack is null."""
    schema = "image_profile string, start_date date, tile_block int, tile long, row long, col long, " + ", ".join(f"{b} double" for b in bands)
    return spark.read.schema(schema).parquet(f"{path}/images").where(F.col("image_profile") == profile)


def kept_mosaics(pixels: DataFrame, profiles: dict[str, Profile], wanted: list[str], start: str, end: str, path: str, force: bool = False, **columns) -> DataFrame:
    """Weekly mosaics kept at `path`: only slices (profile, week) that aren't there are made and written; gives those it wrote.

    A derived profile reads the stored slices of its base, which are written first, wanted or not. Rows of a slice are written
    before its name, so that a run that was cut short makes it anew. With `force` all slices of the period are made and replaced.
    """
    spark, day = pixels.sparkSession, columns.get("day", "day")
    monday = F.date_trunc("week", F.col(day)).cast("date")
    found = pixels.select(monday.alias("start_date")).where((F.col("start_date") >= F.to_date(F.lit(start))) & (F.date_add("start_date", 7) <= F.to_date(F.lit(end)))).distinct()
    weeks = sorted(r["start_date"] for r in found.collect())  # a row for each week
    order = [p for p in dict.fromkeys(x for w in wanted for x in (*_bases(profiles, w), w))]
    written = None
    for name in order:
        known = None if force or not weeks else stored_slices(spark, path)
        there = set() if known is None else {r["start_date"] for r in known.where((F.col("image_profile") == name) & F.col("start_date").isin(weeks)).select("start_date").distinct().collect()}
        days = [d for d in weeks if d not in there]
        if days:
            p = profiles[name]
            if p.base is not None:
                base = images_at(spark, path, p.base, _bands_of(profiles, p.base)).where(F.col("start_date").isin(days))
                made = RA.derived(base.withColumn("image_profile", F.lit(name)), {c: f() for c, f in p.index.items()})
            else:
                made = mosaics(pixels.where(monday.isin(days)), profiles, [name], start, end, **columns)[name]
            bands = _bands_of(profiles, name)
            rows = made.select("image_profile", "start_date", tile_block().alias("tile_block"), F.col("tile").cast("long").alias("tile"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *(F.col(b).cast("double").alias(b) for b in bands))
            dealt = rows.hint("rebalance", *IMAGE_KEYS).sortWithinPartitions(*IMAGE_KEYS, "tile")
            writer = dealt.write.partitionBy(*IMAGE_KEYS).mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.parquet(f"{path}/images")
            spark.createDataFrame([(name, d) for d in days], "image_profile string, start_date date").coalesce(1).write.mode("append").parquet(f"{path}/slices")
            one = spark.createDataFrame([(name, d) for d in days], "image_profile string, start_date date")
            written = one if written is None else written.unionByName(one)
    return written if written is not None else spark.createDataFrame([], "image_profile string, start_date date")


def _bases(profiles: dict[str, Profile], name: str) -> list[str]:
    """The profiles that one is based on, the first of all first; an unknown one is an error."""
    if name not in profiles:
        raise ValueError(f"unknown profiles {[name]}")
    base = profiles[name].base
    return [] if base is None else [*_bases(profiles, base), base]


def _bands_of(profiles: dict[str, Profile], name: str) -> tuple[str, ...]:
    p = profiles[name]
    return p.bands if p.base is None else tuple(p.index)


def pixels_of_parcels(images: DataFrame, cells: DataFrame, tile_of: Callable[[], Column]) -> DataFrame:
    """(uid and the columns of stored images) of the parcels' pixels; only files of tiles that hold one are read.

    `tile_of` gives a cell's tile from `row` and `col`. The tiles are a small table on the other side of a join by a column
    that the images are partitioned by, so that the scan is pruned by it when it starts. They are stored, so that cells are
    made once for them and once for the join.
    """
    spark, placed = images.sparkSession, cells.withColumn("tile", tile_of())
    path = f"{shared_folder(spark)}/tiles"
    placed.select(F.col("tile").cast("long").alias("tile"), tile_block().alias("tile_block")).where("tile is not null").distinct().write.parquet(path)
    tiles = spark.read.schema("tile long, tile_block int").parquet(path)
    n, low, high = tiles.agg(F.count("tile"), F.min("tile"), F.max("tile")).first()
    between = F.col("tile").between(low, high)  # row groups beyond are left out by their statistics, blocks when the scan starts
    wanted = tiles.where(between)
    near = images.where(between).join(F.broadcast(wanted) if n <= MOST_TILES else wanted, ["tile_block", "tile"], "left_semi").drop("tile_block")
    return near.join(placed, ["tile", "row", "col"])


#: Tiles whose numbers are broadcast at most, 8 bytes each.
MOST_TILES = 1_000_000


def index_images(images: DataFrame, index: str, red: str = "b04", nir: str = "b08", blue: str = "b02", swir: str = "b11", packed: bool = True) -> DataFrame:
    """The keys of images with an index of their bands, as bytes or as values."""
    makers = {"ndvi": lambda: B.ndvi(F.col(red), F.col(nir)), "bsi": lambda: B.bsi(F.col(blue), F.col(red), F.col(nir), F.col(swir)), "dprvi": lambda: B.dprvi(F.col("vv"), F.col("vh")), "rvi": lambda: B.rvi(F.col("vv"), F.col("vh"))}
    if index not in makers:
        raise ValueError(f"unknown index {index}")
    value = makers[index]()
    return images.withColumn(index, B.pack(value, index) if packed else value).drop(red, nir, blue, swir, "vv", "vh")


def time_series(images: dict[str, DataFrame], parcels: DataFrame, wanted: list[str], roi: tuple[float, float, float, float] | None = None, expected: DataFrame | None = None, policy: str = "ignore", **zonal) -> DataFrame:
    """Zonal statistics (uid, image_profile, start_date, band, ...) of the wanted profiles; profiles that aren't known are passed over.

    Parcels out of `roi` are an error, and so are missing slices (image_profile, start_date) under the policy calculate_raise.
    """
    if roi is not None:
        ZO.check_inside(ZO.bounds(parcels), roi)
    out = None
    for name in wanted:
        if name not in images:
            continue
        keys = ("image_profile", "start_date", *RA.PIXEL)
        df = images[name]
        long = df.unpivot([c for c in keys if c in df.columns], [c for c in df.columns if c not in keys], "band", "value")
        out = long if out is None else out.unionByName(long)
    if out is None:
        raise ValueError(f"none of {wanted} is known")
    if expected is not None:
        RA.missing_slices(expected, out, ["image_profile", "start_date"], policy)
    return ZO.valid_stats(out, parcels, ["image_profile", "start_date", "band"], **zonal)


def prepared_parcels(parcels: DataFrame, lut: DataFrame, class_type: str, least: int, class_col: str, counts: DataFrame, fields: LA.Fields = LA.Fields(), key: str = "cropcode", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parcels with their class labels and pixel counts, reduced to the columns that a run needs."""
    rows = FE.with_pixel_count(LA.prepare(parcels, lut, class_type, least, class_col, fields, key), counts, fields.uid)
    return LA.whitelisted(rows, fields.uid, export=("pixcount", *keep), domain=(fields.crop, fields.method))


def consolidation(parcels: DataFrame, probabilities: DataFrame, classes: list[str], ignored: list[str], status: list[str], rules: CO.Doubt = CO.Doubt(), marker_rules: CO.Doubt | None = None, crop: str | None = None, class_type: str = "") -> DataFrame:
    """Every parcel with its three best classes, the plain verdict, the marker's verdict (pred_full_alpha), and its status."""
    found = CO.top_classes(probabilities, classes).drop(*classes)
    rows = CO.with_predictions(parcels, found, ignored)
    rows = CO.consolidated(rows, ignored, rules, crop=crop, class_type=class_type)
    rows = CO.consolidated(rows, ignored, marker_rules or replace(rules, marker_rules=True), "pred_full_alpha", crop=crop, class_type=class_type)
    return CO.with_status(rows, status, "pred_full_alpha")


#: The groupings of the error tables, and the rule that each leaves out of the verdict it looks at.
ERROR_TABLES = {"pixcount": "pixel_rule", "class": "marker_rules", "crop": "marker_rules", "probability": "percentages"}


def all_errors(rows: DataFrame, ignored: list[str], rules: CO.Doubt, crop: str = "cropcode", class_type: str = "", truth: str = "classname_truth") -> DataFrame:
    """The errors alpha, beta and theta by pixel count, declared class, declared crop and probability, in one pass: `name` is kind_grouping.

    Each table is of a verdict without the rule that looks at its grouping, and shows next to it the errors of the full verdict
    (pred_full_alpha).
    """
    rows = RE.truth_conclusions(rows, "pred_full_alpha", ignored, truth, prefix="full")
    of = {
        "pixcount": (binned(F.col("pixcount")), F.lit(None)),
        "class": (F.col("classname_declared"), F.lit(0)),
        "crop": (F.col(crop), F.lit(0)),
        "probability": (percent(F.col("pred1_prob")), -percent(F.col("pred1_prob"))),
    }
    for rule in sorted(set(ERROR_TABLES.values())):
        v = f"_without_{rule}"
        rows = CO.consolidated(rows, ignored, replace(rules, **{rule: False}), v, crop=crop, class_type=class_type)
        rows = RE.truth_conclusions(rows, v, ignored, truth, prefix=v)
    return RE.dealt_errors(rows, {g: (*of[g], f"_without_{rule}_conclusion") for g, rule in ERROR_TABLES.items()}, "full_conclusion", {"pixcount": bin_labels(EDGES)})


def error_tables(rows: DataFrame, ignored: list[str], rules: CO.Doubt, crop: str = "cropcode", class_type: str = "", truth: str = "classname_truth") -> dict[str, DataFrame]:
    """`all_errors` as {kind_grouping: table}, each to be ordered by pos and grp. Store the one table where several are read."""
    return _by_name(all_errors(rows, ignored, rules, crop, class_type, truth), [f"{k}_{g}" for g in ERROR_TABLES for k in ("alpha", "beta", "theta")])


def _by_name(table: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    return {name: table.where(F.col("name") == name).drop("name", "kind", "grouping") for name in names}


#: Share tables of a report: of all reported parcels, and of checked ones.
SHARES, CHECKED_SHARES = ("conclusions", "conclusion_details", "full_details"), ("truth_conclusions", "truth_conclusions_full")


def all_shares(rows: DataFrame, ignored: list[str], unimportant: list[str], not_for_training: list[str], truth: str | None = "classname_truth") -> DataFrame:
    """(name, value, n, pct): the shares of conclusions, and, with a ground truth, of those of the checked parcels, in one pass."""
    rows = RE.conclusion(rows, "pred_consolidated", unimportant, not_for_training, ignored)
    rows = RE.conclusion(rows, "pred_full_alpha", unimportant, not_for_training, ignored, name="full_conclusion_short")
    tables = dict(zip(SHARES, (F.col(c) for c in ("conclusion", "conclusion_detail", "full_conclusion_short_detail")), strict=True))
    if truth is None:
        return RE.dealt_shares(rows, tables)
    rows = RE.truth_conclusions(rows, "pred_consolidated", ignored, truth)
    rows = RE.truth_conclusions(rows, "pred_full_alpha", ignored, truth, prefix="full")
    tables |= dict(zip(CHECKED_SHARES, (F.col("gt_conclusion"), F.col("full_conclusion")), strict=True))
    return RE.dealt_shares(rows, tables, {name: F.col(truth).isNotNull() for name in CHECKED_SHARES})


def report(rows: DataFrame, ignored: list[str], unimportant: list[str], not_for_training: list[str], rules: CO.Doubt = CO.Doubt(), parameters: dict[str, str] | None = None, crop: str = "cropcode", class_type: str = "", truth: str | None = "classname_truth", truths: DataFrame | None = None, store: RunStore | None = None, name: str = "verdicts") -> dict[str, DataFrame]:
    """All tables of a run's report: its parameters, counts, shares of conclusions, and, with a ground truth, accuracies and errors.

    The ground truth is the column `truth` of the rows, or of `truths` (with uid), which covers some of the parcels; None: there is none.
    With a store, whose stage (or input) `name` the rows are, each pass is a stage, and every table a part of a stored one.
    """
    spark, keep = rows.sparkSession, {"ignored": ignored, "unimportant": unimportant, "not_for_training": not_for_training, "crop": crop, "class_type": class_type, "truth": truth}
    inputs = [name]

    def kept(stage: str, make: Callable[[], DataFrame], **more) -> DataFrame:
        return make() if store is None else store.stage(stage, make, inputs, **keep, **more)

    reported, aside = RE.split_unimportant(rows, unimportant)
    checked = reported if truth is not None else None
    if truth is not None and truths is not None:
        found = RE.join_truth(reported, truths).where(F.col(truth).isNotNull())
        if store is not None:
            store.input("truths", truths)
            inputs.append("truths")
        checked = kept("checked_verdicts", lambda: found)
    out = {"parameters": spark.createDataFrame(sorted((parameters or {}).items()), "name string, value string")}
    sizes = rows.agg(F.count("*").alias("all"), F.count_if(~within(F.col("classname_declared"), unimportant)).alias("reported"), F.count_if(within(F.col("classname_declared"), unimportant)).alias("unimportant"))
    out["rows"] = kept("report_rows", lambda: sizes)
    if checked is None or truths is None:
        shares = kept("report_shares", lambda: all_shares(reported, ignored, unimportant, not_for_training, truth))
        out |= _by_name(shares, [*SHARES, *(CHECKED_SHARES if truth is not None else ())])
    else:
        out |= _by_name(kept("report_shares", lambda: all_shares(reported, ignored, unimportant, not_for_training, None)), list(SHARES))
        out |= _by_name(kept("report_truth_shares", lambda: all_shares(checked, ignored, unimportant, not_for_training, truth)), list(CHECKED_SHARES))
    out["accuracy_declared"] = kept("report_accuracy_declared", lambda: RE.accuracies(reported, "classname_declared", "pred1", "pred_full_alpha", [*ignored, *not_for_training]))
    out["scores_declared"] = kept("report_scores_declared", lambda: RE.class_scores(reported, "classname_declared", "pred1"))
    if checked is not None:
        known = checked.where(F.col(truth).isNotNull())
        full = RE.truth_conclusions(RE.truth_conclusions(known, "pred_consolidated", ignored, truth), "pred_full_alpha", ignored, truth, prefix="full")
        out |= {"errors": kept("report_errors_all", lambda: RE.error_rates(full)), "errors_full": kept("report_errors_full", lambda: RE.error_rates(full, "full_conclusion"))}
        out |= {"accuracy_truth": kept("report_accuracy_truth", lambda: RE.accuracies(known, truth, "pred1", "pred_full_alpha", ignored)), "accuracy_per_pixcount": kept("report_accuracy_pixels", lambda: RE.accuracy_by_pixels(known, truth, "pred1"))}
        errors = kept("report_errors", lambda: all_errors(known, ignored, rules, crop, class_type, truth), rules=str(rules))
        out |= _by_name(errors, [f"{k}_{g}" for g in ERROR_TABLES for k in ("alpha", "beta", "theta")])
    return out


def cover_run(parcels: DataFrame, weeks: DataFrame, marker: str, columns: list[str], premiums: str = "all_best", crop: str = "cropcode", early: str = "earlycrop") -> DataFrame:
    """The marker's parcels with the cover of their best week: weekly labels, one row a parcel, final verdict and status."""
    own = CV.premium_parcels(parcels, marker, premiums, crop, early).select("uid")
    labelled = CV.weekly_cover(weeks.join(own, "uid", "left_semi"))
    return CV.final_cover(CV.best_week(labelled, columns))


def cover_report(selected: DataFrame, checks: DataFrame, parcels: DataFrame, cover: DataFrame, keys: list[str], premiums: str = "all_best") -> tuple[DataFrame, DataFrame]:
    """(located and judged field checks, statistics by reason)."""
    rows = CV.located_checks(selected, checks, parcels, cover, keys).withColumn("reason", CV.selection_reason(F.col(premiums)))
    truth = (F.col("finding"), F.col("checked_main"), F.col("checked_late"))
    rows = rows.withColumn("cover_check", CV.check_cover(F.col("ndvi"), F.col("reason")))
    rows = rows.withColumns({"ndvi_correct": CV.correctness(F.col("cover_check"), F.col("reason"), *truth), "s1_correct": CV.correctness(F.col("cover_s1"), F.col("reason"), *truth)})
    return rows, CV.reason_statistics(rows)


@dataclass
class Classification:
    """What a classification run gives; every table is a stage of the run's store."""

    features: DataFrame
    sample: DataFrame
    predictions: DataFrame
    reports: dict[str, DataFrame]
    classes: list[str]
    store: RunStore


def prepared(parcels: DataFrame, zonal: DataFrame, ignored: list[str], not_for_training: list[str], store: RunStore, strategy: str = "MEDIUM2", test_share: float = 0.2, least_pixels: int = 1, least_pct: float = 80.0, parcels_version: str | None = None, zonal_version: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stages before the model: (features, sample to learn from with its draws, samples to test and to predict)."""
    store.input("parcels", parcels, parcels_version)
    store.input("zonal", zonal, zonal_version)
    long = store.stage("long_features", lambda: FE.long_features(zonal, parcels, least_pct=least_pct), ["parcels", "zonal"], least_pct=least_pct)
    features = store.stage("features", lambda: FE.feature_matrix(long, parcels)[0], ["parcels", "long_features"])
    cut = {"test_share": test_share, "least_pixels": least_pixels, "ignored": ignored, "not_for_training": not_for_training}
    split = store.stage("split", lambda: SA.test_split(SA.training_candidates(parcels, least_pixels, not_for_training, ignored), test_share, "classname").select("uid", "classname", "is_test"), ["parcels"], **cut)
    sample = store.stage("sample", lambda: SA.balance(split.where("not is_test").drop("is_test"), strategy, "classname"), ["split"], strategy=strategy)
    return features, sample, split.where("is_test").select("uid", "classname")


def classification(parcels: DataFrame, zonal: DataFrame, ignored: list[str], not_for_training: list[str], unimportant: list[str], model_path: str, kind: str = "randomforest", strategy: str = "MEDIUM2", test_share: float = 0.2, least_pixels: int = 1, rules: CO.Doubt = CO.Doubt(), least_pct: float = 80.0, force: bool = False, truth: DataFrame | None = None, store: RunStore | None = None, parcels_version: str | None = None, zonal_version: str | None = None, **options) -> Classification:
    """Prepared parcels and zonal statistics to predictions and reports: features, balanced sample, model, verdicts.

    `truth` (uid, classname_truth) adds the tables on checked parcels. A fitting model at `model_path` is used again unless `force` is
    given. Each step is a stage of `store` (a new one below the shared folder, if none is given): a run that was cut short
    goes on after its last complete stage, and one with other rules shares all stages before the verdicts.
    """
    store = store or RunStore(parcels.sparkSession, shared_folder(parcels.sparkSession))
    features, sample, test = prepared(parcels, zonal, ignored, not_for_training, store, strategy, test_share, least_pixels, least_pct, parcels_version, zonal_version)
    everything = SA.predictable(parcels, ignored).select("uid")
    how = {"kind": kind, "model_path": model_path, "options": options}
    names = [c for c in features.columns if c != "uid"]
    model = MO.trained(MO.with_features(sample, features).where(F.col("classname").isNotNull()), names, "classname", model_path, kind, force, **options)
    classes = MO.classes_of(model)
    how["model"] = MO.fingerprint_at(parcels.sparkSession, model_path)
    predicted = lambda rows, keep: MO.probabilities(model, MO.with_features(rows, features), keep)[0]
    probabilities = store.stage("probabilities", lambda: predicted(everything, ["uid"]), ["parcels", "features", "sample"], ignored=ignored, **how)
    tested = store.stage("test_probabilities", lambda: predicted(test, ["uid", "classname"]), ["split", "features", "sample"], **how)
    flagged = lambda: RE.with_training_flag(consolidation(parcels, probabilities, classes, ignored, classes, rules), sample)
    rows = store.stage("verdicts", flagged, ["parcels", "probabilities", "sample"], ignored=ignored, rules=str(rules))
    reports = report(rows, ignored, unimportant, not_for_training, rules, {"kind": kind, "strategy": strategy}, truth=None if truth is None else "classname_truth", truths=truth, store=store)
    reports["test_accuracy"] = store.stage("report_test_accuracy", lambda: RE.accuracy(CO.top_classes(tested, classes, 1), "classname", "pred1"), ["test_probabilities"])
    return Classification(features, sample, rows, reports, classes, store)


def reported_again(spark: SparkSession, parcels: str, probabilities: str, classes: list[str], ignored: list[str], unimportant: list[str], not_for_training: list[str], rules: CO.Doubt, store: RunStore | None = None, **kw) -> dict[str, DataFrame]:
    """Verdicts and reports of a stored run under other rules: its parcels and probabilities are read from Parquet.

    The verdicts are a stage of `store` (a new one, if none is given), so that all tables read them and none makes them again.
    """
    store = store or RunStore(spark, shared_folder(spark))
    rows, found = store.input("reported_parcels", spark.read.parquet(parcels)), store.input("reported_probabilities", spark.read.parquet(probabilities))
    how = {"crop": kw.get("crop"), "class_type": kw.get("class_type", "")}
    make = lambda: consolidation(rows, found, classes, ignored, classes, rules, **how)
    verdicts = store.stage("verdicts_again", make, ["reported_parcels", "reported_probabilities"], classes=classes, ignored=ignored, rules=str(rules), **how)
    return report(verdicts, ignored, unimportant, not_for_training, rules, store=store, name="verdicts_again", **kw)
