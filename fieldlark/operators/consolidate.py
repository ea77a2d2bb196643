"""Class probabilities to a verdict for each parcel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import differs, same, within

UNDECLARED, NODATA = "UNKNOWN", "NODATA"


def top_classes(rows: DataFrame, classes: list[str], n: int = 3) -> DataFrame:
    """pred1..n and pred1_prob..n_prob from one column a class; of equal probabilities the later column comes first."""
    ranked = F.slice(F.sort_array(F.array(*(F.struct(F.col(c).cast("double").alias("p"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(classes))), asc=False), 1, n)
    out = rows.withColumn("_top", ranked)
    for i in range(1, n + 1):
        out = out.withColumns({f"pred{i}": F.get("_top", F.lit(i - 1))["c"], f"pred{i}_prob": F.get("_top", F.lit(i - 1))["p"]})
    return out.drop("_top")


def with_predictions(parcels: DataFrame, predictions: DataFrame, ignored: list[str], id_col: str = "uid", declared: str = "classname_declared") -> DataFrame:
    """Every parcel; without a prediction its declared class if that is ignored, else NODATA."""
    new = [c for c in predictions.columns if c == id_col or c not in parcels.columns]
    rows = parcels.join(predictions.select(*new), id_col, "left")
    return rows.withColumn("pred1", F.coalesce(F.when(within(F.col(declared), ignored), F.col(declared)), F.col("pred1"), F.lit(NODATA)))


@dataclass(frozen=True)
class Doubt:
    """Which rules a consolidation applies; percentages are 0..100 and 0 switches a rule off."""

    percentages: bool = True
    marker_rules: bool = False
    pixel_rule: bool = True
    twice_second: bool = True
    pct_opposed: float = 60.0
    pct_opposed_corrected: float = 0.0
    correction: str | None = None
    pct_agreeing: float = 20.0
    least_pixels: int = 10
    retain_top: int = 0
    retain_prob: float = 0.0


def declared_on_top(declared: Column, n: int, least: float) -> Column:
    """Whether the declared class is among the first n with at least that probability."""
    out = F.lit(False)
    for i in range(1, n + 1):
        out = out | (same(F.col(f"pred{i}"), declared) & F.coalesce(F.col(f"pred{i}_prob") >= least, F.lit(False)))
    return out


def consolidated(rows: DataFrame, ignored: list[str], rules: Doubt = Doubt(), name: str = "pred_consolidated", n_top: int = 3, declared: str = "classname_declared", crop: str | None = None, class_type: str = "") -> DataFrame:
    """The verdict `name` (first rule that fits) and `name`_prob, which is 1 for undeclared parcels and -1 otherwise."""
    if rules.retain_top > n_top:
        raise ValueError(f"only {n_top} classes are kept, {rules.retain_top} are asked for")
    if not 0 <= rules.retain_prob <= 1:
        raise ValueError("a probability is between 0 and 1")
    if max(rules.pct_opposed, rules.pct_agreeing, rules.pct_opposed_corrected) > 100:
        raise ValueError("a percentage is 100 at most")
    d, p1, pred = F.col(declared), F.col("pred1_prob"), F.col("pred1")
    verdict = F.when(same(d, F.lit(UNDECLARED)), "IGNORE:NOT_DECLARED").when(same(pred, F.lit(NODATA)) | within(d, ignored), pred)
    if rules.retain_top > 0:
        verdict = verdict.when(declared_on_top(d, rules.retain_top, rules.retain_prob), d)
    if rules.percentages:
        if rules.twice_second:
            verdict = verdict.when(p1 < 2 * F.col("pred2_prob"), "DOUBT:PROBA1<2*PROBA2")
        if rules.pct_opposed > 0:
            verdict = verdict.when(differs(pred, d) & (p1 < rules.pct_opposed / 100), "DOUBT:PRED<>INPUT-PROBA1<X")
        if rules.pct_opposed_corrected > 0 and rules.correction:
            verdict = verdict.when(differs(pred, d) & (F.expr(rules.correction) < rules.pct_opposed_corrected / 100), "DOUBT:PRED<>INPUT-PROBA1_CORRECTED<X")
        if rules.pct_agreeing > 0:
            verdict = verdict.when(same(pred, d) & (p1 < rules.pct_agreeing / 100), "DOUBT:PRED=INPUT-PROBA1<X")
    if rules.marker_rules and crop and class_type in ("LANDCOVER", "LANDCOVER-EARLY"):
        verdict = verdict.when(same(F.col(crop).cast("string"), F.lit("9534")) & same(pred, F.lit("MON_LC_FABACEAE")), "DOUBT:ARABLE-SEEN-AS-FABACEAE")
    if rules.pixel_rule:
        verdict = verdict.when(F.col("pixcount") < rules.least_pixels, "DOUBT:NOT_ENOUGH_PIXELS")
    return rows.withColumns({name: verdict.otherwise(pred), f"{name}_prob": F.when(same(d, F.lit(UNDECLARED)), 1.0).otherwise(-1.0)})


def with_status(rows: DataFrame, classes: list[str], verdict: str = "pred_consolidated", name: str = "pred_cons_status") -> DataFrame:
    return rows.withColumn(name, F.when(within(F.col(verdict), classes), "OK").otherwise("NOK"))


def export(rows: DataFrame, columns: list[str], marker: str, made: str) -> DataFrame:
    """Fixed columns and the constants of a delivery; the date is given, so that a repeat gives the same rows."""
    return rows.select(*columns, F.lit(marker).alias("markercode"), F.to_date(F.lit(made)).alias("cons_date"), F.to_date(F.lit(made)).alias("modify_date"))


def with_geometry(parcels: DataFrame, rows: DataFrame, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    return parcels.select(id_col, geometry).join(rows.drop(geometry), id_col, "inner")
