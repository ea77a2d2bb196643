"""Weekly statistics to a coverage-checked feature matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import feature_name, scaled

KEYS = ("image_profile", "start_date", "end_incl", "band")


def statistics(values: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """The zonal statistics set of a value per group, in population form and with the exact median.

    Minority and majority are the least and most frequent values, the smaller one of equals. A group holds its distinct
    values with their counts, from which deviations are taken around the mean: large means cost no digits.
    """
    counts = values.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_m"))
    # all from the counts of distinct values, so that one group by the keys alone remains
    v, m = F.col("_v"), F.col("_m")
    there, x = v.isNotNull(), v.cast("double")
    out = counts.groupBy(*keys).agg(
        F.sum(F.when(there, m).otherwise(0)).alias("count"), F.sum(x * m).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.max_by("_v", F.when(there, F.struct("_m", -v))).alias("majority"), F.min_by("_v", F.when(there, F.struct("_m", "_v"))).alias("minority"),
        F.array_sort(F.collect_list(F.when(there, F.struct(x.alias("x"), m.alias("m"))))).alias("_values"),
    )
    out = out.withColumns({"mean": F.try_divide("sum", "count"), "range": F.col("max") - F.col("min")})
    squares = F.aggregate("_values", F.lit(0.0), lambda a, p: a + p["m"] * (p["x"] - F.col("mean")) * (p["x"] - F.col("mean")))
    out = out.withColumn("variance", F.when(F.col("min") == F.col("max"), 0.0).when(F.col("count") > 0, squares / F.col("count")))
    return out.withColumns({"std": F.sqrt("variance"), "median": _median(F.col("_values"), F.col("count"))}).select(*keys, "count", "sum", "mean", "median", "std", "min", "max", "range", "variance", "majority", "minority")


def _median(values: Column, n: Column) -> Column:
    """The median of ordered (x, m), each x standing for m equal values: the mean of the two middle ones."""
    low, high = F.floor((n - 1) / 2), F.ceil((n - 1) / 2)
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))

    def step(a: Column, p: Column) -> Column:
        reached = lambda k, old: F.when(a["before"] <= k, p["x"]).otherwise(a[old])
        return F.struct((a["before"] + p["m"]).alias("before"), reached(low, "low").alias("low"), reached(high, "high").alias("high"))

    return F.aggregate(values, start, step, lambda a: 0.5 * a["low"] + 0.5 * a["high"])


def wanted_slices(zonal: DataFrame, profiles: list[str], start: str, end: str, bands: list[str] | None = None, reducer: str | None = None) -> DataFrame:
    """Rows of the profiles' periods that begin at `start` or later and end (inclusive) before `end`; a missing reducer never fits."""
    ok = F.col("image_profile").isin(profiles) & (F.col("start_date") >= F.to_date(F.lit(start))) & (F.col("end_incl") < F.to_date(F.lit(end)))
    if bands is not None:
        ok = ok & F.col("band").isin(bands)
    if reducer is not None:
        ok = ok & F.coalesce(F.col("time_reducer") == reducer, F.lit(False))
    return zonal.where(ok)


def stat_columns(columns: list[str], stats: list[str], id_col: str = "uid") -> list[str]:
    """The id and the columns named after a statistic, or ending in one."""
    return [c for c in columns if c == id_col or any(c == s or c.endswith(f"_{s}") for s in stats)]


def coverage(zonal: DataFrame, parcels: DataFrame, stat: str = "mean", id_col: str = "uid") -> DataFrame:
    """For each slice its rows of known parcels and its nulls, as percentages of all parcels."""
    n = F.broadcast(parcels.select(id_col).distinct().agg(F.count("*").alias("parcels")))
    known = zonal.join(parcels.select(id_col).distinct(), id_col, "left_semi")
    found = known.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.count_if(F.col(stat).isNull()).alias("nulls")).crossJoin(n)
    return found.withColumns({"row_pct": F.try_divide(F.col("rows") * 100.0, F.col("parcels")), "value_pct": (1 - F.try_divide(F.col("nulls"), F.col("parcels"))) * 100.0})


def long_features(zonal: DataFrame, parcels: DataFrame, stat: str = "mean", least_pct: float = 80.0, id_col: str = "uid") -> DataFrame:
    """(uid, feature, value): scaled statistics of slices that pass both coverage tests, for known parcels only."""
    kept = coverage(zonal, parcels, stat, id_col)
    if least_pct > 0:
        kept = kept.where((F.col("row_pct") >= least_pct) & (F.col("value_pct") >= least_pct))
    known = zonal.join(parcels.select(id_col).distinct(), id_col, "left_semi").join(kept.select(*KEYS), list(KEYS), "left_semi")
    name = feature_name(F.col("image_profile"), F.col("start_date"), F.col("band"), F.lit(stat))
    return known.select(id_col, name.alias("feature"), scaled(F.col(stat), F.col("image_profile")).alias("value"))


def feature_matrix(long: DataFrame, parcels: DataFrame, max_null_share: float = 0.6, fill: float = 0.0, id_col: str = "uid", features: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(matrix, sparse): one row a parcel and one column a feature; parcels with too many nulls are set aside.

    One pivot takes the place of a join for each slice. `features` spares the pass that lists them.
    """
    names = features if features is not None else [r["feature"] for r in long.select("feature").distinct().orderBy("feature").collect()]
    if not names:
        raise ValueError("no slice has enough data")
    # nulls are counted on the rows: a predicate over all pivoted columns would multiply in the optimizer
    filled = long.where(F.col("feature").isin(names)).groupBy(id_col).agg(F.count("value").alias("_filled"))
    wide = parcels.select(id_col).distinct().join(long.groupBy(id_col).pivot("feature", names).agg(F.first("value")), id_col, "left").join(filled, id_col, "left")
    enough = F.coalesce(F.col("_filled"), F.lit(0)) >= len(names) - int(max_null_share * len(names))
    return wide.where(enough).drop("_filled").na.fill(fill, names), wide.where(~enough).drop("_filled")


def out_of_range(matrix: DataFrame, names: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(feature, lowest, highest) of the features that leave the range, in one pass."""
    bounds = matrix.agg(*(f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(names) for k, f in (("lo", F.min), ("hi", F.max))))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"lo{i}").cast("double").alias("lowest"), F.col(f"hi{i}").cast("double").alias("highest")) for i, c in enumerate(names)))
    return bounds.select(F.inline(rows)).where((F.col("lowest") < low) | (F.col("highest") > high))


def feature_rows(matrix: DataFrame, id_col: str = "uid") -> DataFrame:
    """The features as rows, one for each parcel and feature."""
    return matrix.unpivot(id_col, [c for c in matrix.columns if c != id_col], "feature", "value")


def one_parcel(matrix: DataFrame, uid: str, id_col: str = "uid") -> DataFrame:
    """A parcel's features as rows."""
    return feature_rows(matrix.where(F.col(id_col) == uid), id_col)


def with_features(sample: DataFrame, matrix: DataFrame, id_col: str = "uid") -> DataFrame:
    """The rows of a training, test or prediction sample that have features, with them."""
    new = [c for c in matrix.columns if c == id_col or c not in sample.columns]
    return sample.join(matrix.select(*new), id_col, "inner")


def largest(matrix: DataFrame, names: list[str], n: int = 1000, id_col: str = "uid") -> DataFrame:
    """(uid, highest): the n parcels with the greatest feature value; ties by id."""
    return matrix.select(id_col, F.greatest(*(F.col(f"`{c}`") for c in names)).alias("highest")).orderBy(F.desc_nulls_last("highest"), id_col).limit(n)


def best_pixel_count(zonal: DataFrame, profile_prefix: str = "s1", id_col: str = "uid") -> DataFrame:
    """(uid, pixcount) from the slice in which the most parcels have a pixel; ties go to the first by name and date."""
    own = zonal.where(F.col("image_profile").startswith(profile_prefix))
    best = own.groupBy("image_profile", "start_date", "band").agg(F.count_if(F.col("count") >= 1).alias("n")).orderBy(F.desc("n"), "image_profile", "start_date", "band").limit(1)
    return own.join(F.broadcast(best), ["image_profile", "start_date", "band"], "left_semi").select(id_col, F.col("count").alias("pixcount"))


def with_pixel_count(parcels: DataFrame, counts: DataFrame, id_col: str = "uid") -> DataFrame:
    return parcels.join(counts.select(id_col, "pixcount"), id_col, "left").na.fill({"pixcount": 0})


def from_path(path: Column) -> dict[str, Column]:
    """Metadata of a slice file from its name `profile_start_end_band_reducer.ext`; the orbit comes from the profile."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)
    part = lambda i: F.get(F.split(stem, "_"), F.lit(i))
    profile = part(0)
    return {
        "image_profile": profile,
        "start_date": F.to_date(part(1)),
        "end_incl": F.to_date(part(2)),
        "band": part(3),
        "time_reducer": part(4),
        "orbit": F.when(profile.contains("-asc"), "asc").when(profile.contains("-desc"), "desc"),
    }


def from_weekly_path(path: Column) -> dict[str, Column]:
    """The older naming `stem_week_date_profile`: a period of seven days."""
    parts = F.split(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1), "_")
    start = F.to_date(F.element_at(parts, -2))
    return {"image_profile": F.element_at(parts, -1), "week": F.element_at(parts, -3).try_cast("int"), "start_date": start, "end_incl": F.date_add(start, 6)}
