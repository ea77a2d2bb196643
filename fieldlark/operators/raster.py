"""Pixel tables: cloud masks, temporal composites, best available pixels, neighbourhood filters.

A pixel is (tile, row, col); an image is a pixel table of one acquisition. Neighbourhoods never collect a tile: a range frame
along each row and one along each column fold what lies near. Rows aren't copied; where an image has gaps, and at its edges,
cells without a pixel carry the first pass's folds on to the second.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.bands import date_score

PIXEL = ["tile", "row", "col"]
#: Scene classes: kept ones, clouds, and names by number.
CLEAR, CLOUDS = (4, 5, 6), (3, 8, 9, 10)
SCENES = ("no_data", "saturated", "dark", "cloud_shadow", "vegetation", "not_vegetated", "water", "unclassified", "cloud_medium", "cloud_high", "thin_cirrus", "snow")
#: Classes that make a parcel's image unusable.
BAD = ("no_data", "saturated", "dark", "cloud_medium", "cloud_high", "thin_cirrus", "snow")

REDUCERS = {
    "mean": lambda v, ts: F.avg(v),
    "min": lambda v, ts: F.min(v),
    "max": lambda v, ts: F.max(v),
    "median": lambda v, ts: F.median(v),
    "first": lambda v, ts: F.min_by(v, F.when(v.isNotNull(), ts)),
    "last": lambda v, ts: F.max_by(v, F.when(v.isNotNull(), ts)),
}


def masked(pixels: DataFrame, bands: list[str], scl: str = "scl") -> DataFrame:
    """Bands are null where the scene class isn't clear."""
    return pixels.withColumns({b: F.when(F.col(scl).isin(*CLEAR), F.col(b)) for b in bands})


def cloud_share(pixels: DataFrame, image: list[str], scl: str = "scl") -> DataFrame:
    """Share of cloud-free pixels (`coverage`) and of clouds of each image."""
    cloud = F.coalesce(F.col(scl), F.lit(0)).isin(*CLOUDS).cast("double")
    return pixels.groupBy(*image).agg(F.avg(1 - cloud).alias("coverage"), (100 * F.avg(cloud)).alias("cloud_pct"), F.count("*").alias("pixels"))


def without_cloudy_images(pixels: DataFrame, image: list[str], most_pct: float = 80.0, scl: str = "scl") -> DataFrame:
    good = cloud_share(pixels, image, scl).where(F.col("cloud_pct") <= most_pct)
    return pixels.join(good.select(*image), image, "left_semi")


def composite(pixels: DataFrame, keys: list[str], bands: list[str], reducer: str | list[str], ts: str = "ts") -> DataFrame:
    """One value a band for every key (pixel and period) from all images; of several reducers, as columns band_reducer, in one aggregation."""
    if isinstance(reducer, str):
        return pixels.groupBy(*keys).agg(*(REDUCERS[reducer](F.col(b), F.col(ts)).alias(b) for b in bands))
    return pixels.groupBy(*keys).agg(*(REDUCERS[r](F.col(b), F.col(ts)).alias(f"{b}_{r}") for b in bands for r in reducer))


def scene_counts(pixels: DataFrame, zone: list[str], scl: str = "scl") -> DataFrame:
    """Pixels of each scene class by zone, absent classes 0, and nb_bad_pixels."""
    names = F.array(*map(F.lit, SCENES))
    rows = pixels.where(F.col(scl).between(0, len(SCENES) - 1)).withColumn("_name", F.get(names, F.col(scl).cast("int")))
    out = rows.groupBy(*zone).pivot("_name", list(SCENES)).count().na.fill(0, list(SCENES))
    return out.withColumn("nb_bad_pixels", sum((F.col(c) for c in BAD), F.lit(0)))


Fold = Callable[[str, str, WindowSpec], Column]


def _frame(axis: str, half: int) -> WindowSpec:
    """The cells up to `half` away on a line along `axis`."""
    return Window.partitionBy("tile", "col" if axis == "row" else "row").orderBy(axis).rangeBetween(-half, half)


def _with_gaps(rows: DataFrame, half: int) -> DataFrame:
    """The rows, and up to `half` cells without a pixel (`_own` and all else null) on either side of each gap along the columns.

    `_again` marks all pixels of a cell but the first.
    """
    line = Window.partitionBy("tile", "row").orderBy("col")
    before = F.least(F.coalesce(F.col("col") - F.lag("col").over(line) - 1 - half, F.lit(half)), F.lit(half))  # what the left neighbour leaves
    after = F.least(F.coalesce(F.lead("col").over(line) - F.col("col") - 1, F.lit(half)), F.lit(half))
    again = F.coalesce(F.lag("col").over(line) == F.col("col"), F.lit(False))
    marked = rows.withColumns({"_before": F.greatest(before, F.lit(0)), "_after": F.greatest(after, F.lit(0)), "_again": again})
    offsets = F.filter(F.sequence(-F.col("_before"), F.col("_after")), lambda _: F.lit(True))
    rest = [c for c in rows.columns if c not in PIXEL]
    cells = F.when((F.col("_before") == 0) & (F.col("_after") == 0), F.array(F.lit(0).cast("long"))).otherwise(offsets.cast("array<long>"))
    near = marked.withColumn("_off", F.explode(cells))
    here = F.col("_off") == 0
    return near.select("tile", "row", (F.col("col") + F.col("_off")).alias("col"), *(F.when(here, F.col(c)).alias(c) for c in [*rest, "_again"]))


def window(pixels: DataFrame, half: int, start: dict[str, Column], fold: Fold) -> DataFrame:
    """Every pixel with folds over the square around it, along the rows first, then along the columns.

    `fold` (column, axis, frame) gives the fold of a column of `start` over a frame; cells without a pixel hold null.
    """
    own = F.struct(*(c for c in pixels.columns if c not in PIXEL)) if set(pixels.columns) - set(PIXEL) else F.struct(F.lit(0).alias("_none"))
    rows = _with_gaps(pixels.select(*PIXEL, own.alias("_own"), *(c.alias(n) for n, c in start.items())), half)
    rows = rows.withColumns({n: fold(n, "col", _frame("col", half)) for n in start})
    # a cell with several pixels stands for its line once
    rows = rows.withColumns({n: F.when(~F.coalesce("_again", F.lit(False)), F.col(n)) for n in start})
    rows = rows.withColumns({n: fold(n, "row", _frame("row", half)) for n in start})
    return rows.where(F.col("_own").isNotNull()).select(*PIXEL, "_own.*", *start).drop("_none")


def focal_mean(pixels: DataFrame, size: int, value: str = "value", without_centre: bool = False, name: str = "focal_mean") -> DataFrame:
    """The mean over the size x size window of every pixel; cells outside the table, and nulls, don't count."""
    start = {"_s": F.coalesce(F.col(value).cast("double"), F.lit(0.0)), "_n": F.col(value).isNotNull().cast("long")}
    near = window(pixels, size // 2, start, lambda c, axis, frame: F.sum(c).over(frame))
    s, n = F.col("_s"), F.col("_n")
    if without_centre:
        s, n = s - F.coalesce(F.col(value).cast("double"), F.lit(0.0)), n - F.col(value).isNotNull().cast("long")
    return near.withColumn(name, F.try_divide(s, n)).drop("_s", "_n")


def dilated_cloud(pixels: DataFrame, half: int, scl: str = "scl") -> DataFrame:
    """A flag `near_cloud`: a cloud within `half` pixels."""
    near = window(pixels, half, {"_near": F.coalesce(F.col(scl).isin(*CLOUDS), F.lit(False)).cast("int")}, lambda c, axis, frame: F.max(c).over(frame))
    return near.withColumn("near_cloud", F.col("_near") == 1).drop("_near")


def lee_enhanced(pixels: DataFrame, size: int, value: str = "value", looks: float = 10.0, damping: float = 10.0, without_centre: bool = True) -> DataFrame:
    """Speckle filter: the local mean where the variation is low, the pixel where it is high, a weighted mix between.

    The deviation is taken around the image of local means. `without_centre` leaves the middle of the kernel out.
    """
    mean = focal_mean(pixels, size, value, without_centre, "_mean")
    off = mean.withColumn("_sq", F.pow(F.col(value) - F.col("_mean"), 2.0))
    both = focal_mean(off, size, "_sq", without_centre, "_var").withColumn("_var", F.greatest("_var", F.lit(0.0)))
    m, x = F.col("_mean"), F.col(value)
    ci = F.try_divide(F.sqrt("_var"), m)
    cu, cmax = (1 / looks) ** 0.5, (1 + 2 * looks) ** 0.5
    w = F.exp(-damping * (ci - cu) / (cmax - ci))
    filtered = F.when(ci.isNull(), m).when(ci <= cu, m).when(ci >= cmax, x).otherwise(m * w + x * (1 - w))
    return both.withColumn("filtered", filtered).drop("_mean", "_sq", "_var")


def distance_score(pixels: DataFrame, half: int = 5, sigma: float = 1.0, scl: str = "scl", image: str = "image") -> DataFrame:
    """`dtc`: 1 minus the gaussian-smoothed cloud flag, in one pass along rows and one along columns."""
    weight = [2.718281828459045 ** (-(i * i) / (2 * sigma * sigma)) for i in range(-half, half + 1)]
    weights = F.array(*(F.lit(x / sum(weight)) for x in weight))
    cloud = F.coalesce(F.col(scl), F.lit(0)).isin(*CLOUDS).cast("double")
    keyed = pixels.withColumn("tile", F.struct("tile", image))  # images of their own

    def fold(c: str, axis: str, frame: WindowSpec) -> Column:
        line = F.collect_list(F.when(F.col(c) != 0, F.struct(F.col(axis).alias("at"), F.col(c).alias("x")))).over(frame)
        return F.aggregate(line, F.lit(0.0), lambda a, p: a + p["x"] * F.get(weights, (p["at"] - F.col(axis) + half).cast("int")))

    near = window(keyed, half, {"_s": cloud}, fold)
    return near.withColumns({"tile": F.col("tile.tile"), "dtc": 1 - F.col("_s")}).drop("_s")


def best_pixels(pixels: DataFrame, bands: list[str], day: str = "day", image: str = "image", scl: str = "scl", weights: tuple[float, float, float] = (1.0, 0.8, 0.5), tie: str | None = None) -> DataFrame:
    """For each pixel and month the image with the highest score of cloud distance, date and coverage.

    Needs `dtc`. No-data and cloudy pixels take no part; scores have nine digits, ties go to the first day, then to the least `tie` (the image).
    """
    cover = cloud_share(pixels, [image], scl).select(image, "coverage")
    a, b, c = weights
    rows = pixels.join(cover, image)
    rows = rows.withColumn("score", (a * F.col("dtc") + b * date_score(F.col(day)) + c * F.col("coverage")) / (a + b + c)).withColumn("score", F.round("score", 9))
    rows = rows.where(~F.coalesce(F.col(scl), F.lit(0)).isin(0, *CLOUDS)).withColumn("month", F.trunc(day, "month"))
    best = F.row_number().over(Window.partitionBy(*PIXEL, "month").orderBy(F.desc("score"), day, tie or image))
    return rows.withColumn("_r", best).where("_r = 1").select(*PIXEL, "month", day, "score", *bands)


def derived(pixels: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """An index image from its base image: keys kept, band expressions added."""
    keys = [c for c in ("image_profile", "start_date", *PIXEL) if c in pixels.columns]
    return pixels.select(*keys, *(c.alias(n) for n, c in columns.items()))


def missing_slices(expected: DataFrame, available: DataFrame, keys: list[str], policy: str = "ignore") -> DataFrame:
    """Expected slices that aren't there; an error under the policy calculate_raise if there is one."""
    if policy not in ("ignore", "calculate_raise", "calculate_ignore"):
        raise ValueError(f"unknown policy {policy}")
    gone = expected.select(*keys).distinct().join(available.select(*keys).distinct(), keys, "left_anti")
    if policy == "calculate_raise" and (row := gone.limit(1).collect()):
        raise ValueError(f"missing: {row[0].asDict()}")
    return gone
