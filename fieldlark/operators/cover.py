"""Cover pipeline: bare soil from radar and NDVI, weekly labels, selection and its check in the field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import same, within
from ..functions.values import cover_of_probability, has_any

# Premium codes of the markers and thresholds of the cover rules.
AFTER_SUMMER = ("BMG", "MEV", "MEG", "EEF", "TBG", "EBG")
PARCEL_FILTERS: dict[str, tuple[str, ...]] = {
    "COVER": (),
    "COVER_EEF_VOORJAAR": (),
    "ONBEDEKT_NA_ZOMER": AFTER_SUMMER,
    "COVER_BMG_MEG_MEV_EEF_NAJAAR": AFTER_SUMMER,
    "COVER_EEB_VOORJAAR": ("EEB",),
    "COVER_TBG_BMG_VOORJAAR": ("TBG", "BMG"),
    "COVER_TBG_BMG_NAJAAR": ("TBG", "BMG"),
}
BARE_VH = {"asc": 0.013, "desc": 0.015}


def premium_parcels(parcels: DataFrame, marker: str, premiums: str = "all_best", crop: str = "cropcode", early: str = "earlycrop") -> DataFrame:
    """Parcels that a marker looks at."""
    wanted = PARCEL_FILTERS[marker]
    rows = parcels.where(has_any(F.col(premiums), wanted)) if wanted else parcels
    if marker == "COVER_EEB_VOORJAAR":
        rows = rows.where(same(F.col(early).cast("string"), F.lit("83")) & within(F.col(crop).cast("string"), ["201", "202"]))
    return rows


def missing(x: Column) -> Column:
    """Absent statistics were filled with 0."""
    return x.isNull() | (x == 0)


def radar_cover(orbit: str, p: str = "") -> Column:
    """Label from the statistics vv_mean, vv_std, vv_median, vh_median, vh_std (with prefix `p`) of one orbit."""
    vv_mean, vv_std, vv_med, vh_med, vh_std = (F.col(f"{p}{c}") for c in ("vv_mean", "vv_std", "vv_median", "vh_median", "vh_std"))
    return (
        F.when(missing(vv_mean), "NODATA")
        .when((vh_std > 0.5) | (vv_std > 0.5), "multi")
        .when((vh_med < 0.07) & ((vv_med < 0.027) | (vh_std < 0.0027)), "water")
        .when((F.try_divide(vv_med, vh_med) >= 5.9) & (vh_med < BARE_VH[orbit]), "bare-soil")
        .when(vv_mean > 0.25, "urban")
        .otherwise("other")
    )


def combined_radar(asc: Column, desc: Column) -> Column:
    no = ("NODATA", "multi")
    return (
        F.when(asc.isin(*no), desc)
        .when(desc.isin(*no), asc)
        .when((asc == "water") & (desc == "water"), "water")
        .when(asc.isin("bare-soil", "water") & desc.isin("bare-soil", "water"), "bare-soil")
        .when((asc == "urban") | (desc == "urban"), "urban")
        .otherwise("other")
    )


def ndvi_cover(ndvi: Column) -> Column:
    return F.when(missing(ndvi), "NODATA").when(ndvi < 0.35, "bare-soil").otherwise("other")


def bare_probability(ndvi: Column, radar: Column, asc: Column) -> Column:
    return (
        F.when(ndvi >= 0.35, 0.0)
        .when((ndvi != 0) & (ndvi < 0.35), 1 - ndvi)
        .when(radar == "NODATA", F.lit(None).cast("double"))
        .when(asc == "bare-soil", 0.5)
        .otherwise(0.0)
    )


def weekly_cover(features: DataFrame) -> DataFrame:
    """Labels of a parcel and week from asc_*, desc_* radar statistics and ndvi."""
    rows = features.withColumns({"cover_asc": radar_cover("asc", "asc_"), "cover_desc": radar_cover("desc", "desc_"), "cover_ndvi": ndvi_cover(F.col("ndvi"))})
    rows = rows.withColumn("cover_s1", combined_radar(F.col("cover_asc"), F.col("cover_desc")))
    rows = rows.withColumn("pred1_prob", bare_probability(F.col("ndvi"), F.col("cover_s1"), F.col("cover_asc")))
    return rows.withColumn("pred1", cover_of_probability(F.col("pred1_prob")))


def best_week(weeks: DataFrame, columns: list[str], id_col: str = "uid", prob: str = "pred1_prob", tie: str = "start_date") -> DataFrame:
    """For each parcel the first value that is there of every column, from the most probable week down.

    A row may therefore mix weeks where values are missing.
    """
    w = Window.partitionBy(id_col).orderBy(F.desc_nulls_last(prob), tie).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc_nulls_last(prob), tie))
    picked = weeks.select(id_col, one.alias("_r"), *(F.first(c, ignorenulls=True).over(w).alias(c) for c in [*columns, prob] if c != id_col))
    return picked.where("_r = 1").drop("_r")


def final_cover(rows: DataFrame, prob: str = "pred1_prob") -> DataFrame:
    verdict = cover_of_probability(F.col(prob), "ONBEDEKT", "BEDEKT")
    return rows.withColumn("pred_consolidated", verdict).withColumn("pred_cons_status", F.when(F.col("pred_consolidated").isin("NODATA", "DOUBT"), "NOK").otherwise("OK"))


def premium_selection(rows: DataFrame, premiums: str = "all_best", ndvi: str = "ndvi", radar: str = "cover_s1") -> DataFrame:
    """Bare parcels with a premium that forbids it."""
    bare = (F.col(ndvi) != 0) & (F.col(ndvi) < 0.3) | (F.col(radar) == "bare-soil")
    return rows.where(has_any(F.col(premiums), ("BMG", "MEG", "MEV", "EEF")) & bare)


def bare_selection(rows: DataFrame, ndvi: str = "ndvi", radar: str = "cover_s1", premiums: str | None = None) -> DataFrame:
    """NDVI says bare, or the radar does where there is no NDVI; with `premiums` only EEF parcels."""
    bare = (F.col(ndvi) != 0) & (F.col(ndvi) < 0.35) | (F.col(radar) == "bare-soil") & (F.col(ndvi) == 0)
    rows = rows.where(bare)
    return rows if premiums is None else rows.where(has_any(F.col(premiums), ("EEF",)))


def selection_reason(premiums: Column) -> Column:
    """Of several premiums BMG counts first, then EEF, MEG, MEV."""
    out = F.when(F.lit(False), "")
    for code in ("BMG", "EEF", "MEG", "MEV"):
        out = out.when(premiums.contains(code), code)
    return out.otherwise("?")


# Crops that are no finding of bare soil, by reason.
_BMG_GREEN = ("60", "63", "638", "660", "700", "745", "9827", "9828")
_MEV, _MEG, _EEF = ("660", "700", "723", "732"), ("63",), "98"


def check_cover(ndvi: Column, reason: Column) -> Column:
    limit = F.when(reason == "BMG", 0.25).otherwise(0.3)
    return F.when(ndvi == 0, "NODATA").when(ndvi < limit, "bare-soil").otherwise("other")


def correctness(cover: Column, reason: Column, finding: Column, main: Column, late: Column) -> Column:
    """Whether a field check agrees with a cover label."""
    main, late = main.cast("string"), late.cast("string")
    bare = cover == "bare-soil"
    green = lambda crops: F.coalesce(main.isin(*crops), F.lit(False))
    not_in = lambda crops: main.isNotNull() & ~main.isin(*crops)
    other = lambda c, x: c.isNotNull() & (c != x)
    return (
        F.when(finding.isNull() & main.isNull() & late.isNull(), "no_groundtruth")
        .when(cover == "NODATA", "NODATA")
        .when((reason == "BMG") & bare & (finding.isNotNull() | not_in(_BMG_GREEN)), "yes")
        .when((reason == "BMG") & ~bare & finding.isNull(), "yes")
        .when((reason == "EEF") & bare & (other(main, _EEF) | other(late, _EEF) | finding.isNotNull()), "yes")
        .when((reason == "EEF") & ~bare & (main.isNull() | (main == _EEF)), "yes")
        .when((reason == "MEV") & bare & (not_in(_MEV) | finding.isNotNull()), "yes")
        .when((reason == "MEV") & ~bare & (main.isNull() | green(_MEV)), "yes")
        .when((reason == "MEG") & bare & (not_in(_MEG) | finding.isNotNull()), "yes")
        .when((reason == "MEG") & ~bare & (main.isNull() | green(_MEG)), "yes")
        .otherwise("no")
    )


def field_check(selected: DataFrame, checks: DataFrame, keys: list[str], premiums: str = "all_best") -> DataFrame:
    """Selected parcels with their field check (left join on several keys), reason and both correctness columns."""
    new = [*keys, *(c for c in checks.columns if c not in selected.columns)]
    rows = selected.join(checks.select(*new), keys, "left").withColumn("reason", selection_reason(F.col(premiums)))
    truth = (F.col("finding"), F.col("checked_main"), F.col("checked_late"))
    rows = rows.withColumn("cover_check", check_cover(F.col("ndvi"), F.col("reason")))
    return rows.withColumns({"ndvi_correct": correctness(F.col("cover_check"), F.col("reason"), *truth), "s1_correct": correctness(F.col("cover_s1"), F.col("reason"), *truth)})


def reason_statistics(rows: DataFrame) -> DataFrame:
    count = lambda c, v: F.count_if(F.col(c) == v)
    return rows.groupBy("reason").agg(
        F.count("*").alias("n"), count("ndvi_correct", "yes").alias("ndvi_yes"), count("ndvi_correct", "no").alias("ndvi_no"), count("ndvi_correct", "NODATA").alias("ndvi_nodata"),
        count("s1_correct", "yes").alias("s1_yes"), count("s1_correct", "no").alias("s1_no"), count("s1_correct", "NODATA").alias("s1_nodata"), count("ndvi_correct", "no_groundtruth").alias("unchecked"),
    )


def with_cover(parcels: DataFrame, cover: DataFrame, features: DataFrame, id_col: str = "uid") -> DataFrame:
    """Parcels that have a cover verdict and satellite features, with both; a column that the left side has isn't taken again."""
    out = parcels
    for part in (cover, features):
        out = out.join(part.select(id_col, *(c for c in part.columns if c not in out.columns)), id_col, "inner")
    return out


def located_checks(selected: DataFrame, checks: DataFrame, parcels: DataFrame, cover: DataFrame, keys: list[str], id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """Selected parcels with their field checks if there are any, their geometry by the same keys, and their cover by id.

    Keys are compared as whole numbers, which some sources give as text or doubles.
    """
    whole = lambda df: df.withColumns({k: F.col(k).cast("double").cast("long") for k in keys})
    new = lambda df, have: [c for c in df.columns if c not in have]
    out = whole(selected)
    out = out.join(whole(checks).select(*keys, *new(checks, [*out.columns, *keys])), keys, "left")
    out = out.join(whole(parcels).select(*keys, geometry), keys, "inner")
    return out.join(cover.select(id_col, *new(cover, out.columns)), id_col, "inner")
