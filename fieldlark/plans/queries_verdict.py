"""Queries on verdicts: top classes, consolidation, conclusions, error rates, accuracy, and the cover pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import EDGES, bin_labels
from ..operators import consolidate as CO
from ..operators import cover as CV
from ..operators import report as RE
from .queries import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CLASSES = [f"C{i}" for i in range(5)]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def vectors(spark, sf_dir) -> DataFrame:
    """Vectors as parcels: the squares of five components are class scores, the label is the declared class."""
    e = table(spark, sf_dir, "embeddings").where("vec_id is not null")
    sq = [F.pow(F.col("embedding")[i].cast("double"), 2.0) for i in range(5)]
    whole = sq[0] + sq[1] + sq[2] + sq[3] + sq[4]
    declared = F.when(F.col("label") == 7, "UNKNOWN").when(F.col("label") == 8, "IGN").when(F.col("label") != 9, F.concat(F.lit("C"), (F.col("label") % 5).cast("string")))
    truth = F.when(F.col("vec_id") % 11 == 0, "IGN").otherwise(F.concat(F.lit("C"), (F.col("vec_id") * 7 % 6).cast("string")))
    return e.select(F.col("vec_id").cast("string").alias("uid"), declared.alias("classname_declared"), truth.alias("classname_truth"), (F.col("vec_id") % 50).alias("pixcount"), *(F.round(s / whole, 9).alias(c) for s, c in zip(sq, CLASSES, strict=True)))


_V = """
q AS (SELECT vec_id, label, list_transform(embedding[1:5], lambda x: pow(x::DOUBLE, 2)) AS s FROM embeddings WHERE vec_id IS NOT NULL),
v AS (SELECT vec_id::VARCHAR AS uid, CASE WHEN label = 7 THEN 'UNKNOWN' WHEN label = 8 THEN 'IGN' WHEN label <> 9 THEN 'C' || (label % 5) END AS classname_declared,
  CASE WHEN vec_id % 11 = 0 THEN 'IGN' ELSE 'C' || (vec_id * 7 % 6) END AS classname_truth, vec_id % 50 AS pixcount, list_transform([1, 2, 3, 4, 5], lambda i: round(s[i] / (s[1] + s[2] + s[3] + s[4] + s[5]), 9)) AS p FROM q),
r AS (SELECT *, list_sort(list_transform([1, 2, 3, 4, 5], lambda i: {'p': p[i], 'i': i}), 'DESC') AS o FROM v),
t AS (SELECT uid, classname_declared, classname_truth, pixcount, 'C' || (o[1].i - 1) AS pred1, o[1].p AS pred1_prob, 'C' || (o[2].i - 1) AS pred2, o[2].p AS pred2_prob, 'C' || (o[3].i - 1) AS pred3, o[3].p AS pred3_prob FROM r)
"""
_DECIDE = """CASE WHEN classname_declared = 'UNKNOWN' THEN 'IGNORE:NOT_DECLARED' WHEN pred1 = 'NODATA' OR classname_declared = 'IGN' THEN pred1 {keep}
 WHEN pred1_prob < 2 * pred2_prob THEN 'DOUBT:PROBA1<2*PROBA2' WHEN coalesce(pred1 <> classname_declared, true) AND pred1_prob < 0.6 THEN 'DOUBT:PRED<>INPUT-PROBA1<X'
 {corrected} WHEN pred1 = classname_declared AND pred1_prob < 0.5 THEN 'DOUBT:PRED=INPUT-PROBA1<X' WHEN pixcount < 10 THEN 'DOUBT:NOT_ENOUGH_PIXELS' ELSE pred1 END"""
_TOP3 = " OR ".join(f"(pred{i} = classname_declared AND pred{i}_prob >= 0.2)" for i in (1, 2))
_C = (
    _V
    + ", b AS (SELECT uid, classname_declared, classname_truth, pixcount, CASE WHEN classname_declared = 'IGN' THEN 'IGN' WHEN uid::BIGINT % 13 = 0 THEN 'NODATA' ELSE pred1 END AS pred1, "
    + ", ".join(f"CASE WHEN uid::BIGINT % 13 = 0 THEN NULL ELSE {c} END AS {c}" for c in ("pred1_prob", "pred2", "pred2_prob", "pred3", "pred3_prob"))
    + f" FROM t), c AS (SELECT *, {_DECIDE.format(keep='', corrected='')} AS pred_consolidated, {_DECIDE.format(keep=f'WHEN {_TOP3} THEN classname_declared', corrected='')} AS pred_full_alpha FROM b)"
)
_RULES = CO.Doubt(pct_opposed=60, pct_agreeing=50, least_pixels=10)


@query(f"WITH {_V} SELECT * FROM t")
def top_classes(spark, sf_dir):
    return CO.top_classes(vectors(spark, sf_dir), CLASSES).drop(*CLASSES)


def verdicts(spark, sf_dir) -> DataFrame:
    rows = vectors(spark, sf_dir)
    parcels = rows.select("uid", "classname_declared", "classname_truth", "pixcount")
    # every thirteenth parcel has no prediction
    found = CO.top_classes(rows, CLASSES).where(F.col("uid").cast("long") % 13 != 0).drop("classname_truth", *CLASSES)
    out = CO.with_predictions(parcels, found, ["IGN"])
    out = CO.consolidated(out, ["IGN"], _RULES)
    keep = CO.Doubt(pct_opposed=60, pct_agreeing=50, least_pixels=10, retain_top=2, retain_prob=0.2)
    return CO.consolidated(out, ["IGN"], keep, "pred_full_alpha")


@query(
    f"WITH {_C} SELECT uid, classname_declared, pred1, pred1_prob, pred_consolidated, CASE WHEN classname_declared = 'UNKNOWN' THEN 1.0 ELSE -1.0 END AS pred_consolidated_prob, pred_full_alpha, "
    "CASE WHEN pred_full_alpha IN ('C0', 'C1', 'C2', 'C3', 'C4') THEN 'OK' ELSE 'NOK' END AS pred_cons_status FROM c"
)
def consolidate(spark, sf_dir):
    out = CO.with_status(verdicts(spark, sf_dir), CLASSES, "pred_full_alpha")
    return out.select("uid", "classname_declared", "pred1", "pred1_prob", "pred_consolidated", "pred_consolidated_prob", "pred_full_alpha", "pred_cons_status")


_CONC = f"""{_C}, k AS (SELECT *, CASE WHEN classname_declared = 'C4' THEN 'IGNORE:UNIMPORTANT' WHEN classname_declared IN ('IGN', 'C3') THEN 'IGNORE' WHEN pred_consolidated LIKE 'DOUBT%' OR pred_consolidated = 'NODATA' THEN 'DOUBT'
  WHEN classname_declared = pred_consolidated THEN 'OK:PREDICTION=INPUT_CLASS' ELSE 'NOK:PREDICTION<>INPUT_CLASS' END AS conclusion FROM c)"""


def concluded(spark, sf_dir) -> DataFrame:
    return RE.conclusion(verdicts(spark, sf_dir), "pred_consolidated", ["C4"], ["C3"], ["IGN"])


@query(
    f"""WITH {_CONC} SELECT uid, conclusion, CASE conclusion WHEN 'IGNORE:UNIMPORTANT' THEN 'IGNORE:UNIMPORTANT:INPUTCLASSNAME=' || classname_declared WHEN 'IGNORE' THEN 'IGNORE:INPUTCLASSNAME=' || classname_declared
  WHEN 'DOUBT' THEN 'DOUBT:REASON=' || pred_consolidated ELSE conclusion END AS conclusion_detail FROM k"""
)
def conclusions(spark, sf_dir):
    return concluded(spark, sf_dir).select("uid", "conclusion", "conclusion_detail")


@query(f"WITH {_CONC} SELECT conclusion, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM k), 6) AS pct FROM k GROUP BY conclusion")
def conclusion_pct(spark, sf_dir):
    return RE.shares(concluded(spark, sf_dir), "conclusion").withColumn("pct", F.round("pct", 6))


def _gt(v: str) -> str:
    return f"""
f AS (SELECT *, CASE WHEN classname_declared = classname_truth AND classname_truth = 'IGN' THEN 'FARMER-CORRECT:IGNORE:DECLARED=GROUNDTRUTH=IGN' WHEN classname_declared = classname_truth THEN 'FARMER-CORRECT' ELSE 'FARMER-WRONG' END AS gt_farmer,
  CASE WHEN {v} = classname_truth AND {v} = 'IGN' THEN 'PRED-CORRECT:IGNORE:PREDICTION=GROUNDTRUTH=IGN' WHEN {v} = classname_truth THEN 'PRED-CORRECT' WHEN classname_declared = 'IGN' AND {v} LIKE 'DOUBT%' THEN 'PRED-DOUBT:REASON=' || {v} || ':DECLARED=' || classname_declared
  WHEN {v} LIKE 'DOUBT%' OR {v} = 'NODATA' THEN 'PRED-DOUBT:REASON=' || {v} WHEN classname_truth = 'IGN' THEN 'PRED-WRONG:IGNORE:GROUNDTRUTH=IGN' ELSE 'PRED-WRONG' END AS gt_pred FROM c),
g AS (SELECT *, CASE WHEN gt_farmer = 'FARMER-CORRECT' AND gt_pred = 'PRED-WRONG' THEN 'FARMER-CORRECT_PRED-WRONG:ERROR_ALPHA' WHEN gt_farmer = 'FARMER-CORRECT' THEN 'FARMER-CORRECT_' || gt_pred
  WHEN gt_farmer = 'FARMER-WRONG' AND classname_declared = {v} THEN 'FARMER-WRONG_PRED-DOESNT_OPPOSE:ERROR_BETA' WHEN gt_farmer = 'FARMER-WRONG' THEN 'FARMER-WRONG_' || gt_pred ELSE gt_farmer END AS gt_conclusion FROM f)
"""


_ALPHA = "gt_conclusion = 'FARMER-CORRECT_PRED-WRONG:ERROR_ALPHA'"
_ERR = {
    "alpha": (_ALPHA, f"({_ALPHA} OR gt_conclusion LIKE 'FARMER-WRONG_PRED-CORRECT%' OR gt_conclusion LIKE 'FARMER-WRONG_PRED-WRONG%')"),
    "beta": ("gt_conclusion = 'FARMER-WRONG_PRED-DOESNT_OPPOSE:ERROR_BETA'", "(gt_conclusion = 'FARMER-WRONG_PRED-DOESNT_OPPOSE:ERROR_BETA' OR gt_conclusion LIKE 'FARMER-CORRECT%')"),
    "theta": ("gt_conclusion LIKE 'FARMER-WRONG_PRED-DOUBT%'", "(gt_conclusion LIKE 'FARMER-WRONG_PRED-DOUBT%' OR gt_conclusion LIKE 'FARMER-CORRECT_PRED-DOUBT%')"),
}


def checked(spark, sf_dir) -> DataFrame:
    return RE.truth_conclusions(verdicts(spark, sf_dir), "pred_consolidated", ["IGN"])


@query(f"WITH {_C}, {_gt('pred_consolidated')} SELECT uid, gt_farmer, gt_pred, gt_conclusion FROM g")
def gt_conclusions(spark, sf_dir):
    return checked(spark, sf_dir).select("uid", "gt_farmer", "gt_pred", "gt_conclusion")


@query(f"WITH {_C}, {_gt('pred_consolidated')} " + " UNION ALL ".join(f"SELECT '{k}' AS error, count(*) FILTER ({a}) AS numerator, count(*) FILTER ({b}) AS denominator, round(100.0 * count(*) FILTER ({a}) / nullif(count(*) FILTER ({b}), 0), 6) AS pct FROM g" for k, (a, b) in _ERR.items()))
def error_rates(spark, sf_dir):
    return RE.error_rates(checked(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def _errors_sql(kind: str, grp: str, order: str, labels: list[str] | None) -> str:
    a, b = _ERR[kind]
    if labels:
        bins = ", ".join(f"({i}, '{x}')" for i, x in enumerate(labels))
        src = f"(SELECT l.pos, l.grp, coalesce(h.count_all, 0) AS count_all, coalesce(h.count_error, 0) AS count_error FROM (VALUES {bins}) l(pos, grp) LEFT JOIN h USING (grp))"
        err = "count_error"
    else:
        src, err = "(SELECT * FROM h WHERE count_all > 0)", "nullif(count_error, 0)"
    w = f"OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    return f"""WITH {_C}, {_gt('pred_consolidated')}, h AS (SELECT {grp} AS grp, count(*) FILTER ({b}) AS count_all, count(*) FILTER ({a}) AS count_error FROM g WHERE {grp} IS NOT NULL GROUP BY 1),
s AS (SELECT grp, count_all, {err} AS count_error, sum(count_all) {w} AS count_all_cumul, sum(count_error) {w} AS cum, sum(count_all) OVER () AS whole FROM {src})
SELECT grp, count_all, count_error, count_all_cumul::BIGINT AS count_all_cumul, CASE WHEN count_error IS NOT NULL THEN cum::BIGINT END AS count_error_cumul, round(100.0 * count_all_cumul / nullif(whole, 0), 6) AS pct_all_cumul,
round(100.0 * count_error / nullif(count_all, 0), 6) AS pct_error_all, CASE WHEN count_error IS NOT NULL THEN round(100.0 * cum / nullif(whole, 0), 6) END AS pct_error_cumul_vs_count_all FROM s"""


_EC = ["grp", "count_all", "count_error", "count_all_cumul", "count_error_cumul", "pct_all_cumul", "pct_error_all", "pct_error_cumul_vs_count_all"]


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c.startswith("pct") else c for c in _EC))


_BIN = "CASE WHEN pixcount < 0 THEN NULL " + " ".join(f"WHEN pixcount <= {hi} THEN '{x}'" for x, hi in zip(bin_labels(), EDGES[1:], strict=True)) + " END"


@query(_errors_sql("alpha", _BIN, "pos", bin_labels()))
def errors_per_bin(spark, sf_dir):
    return _shown(RE.errors_by_pixels(checked(spark, sf_dir), "alpha"))


@query(_errors_sql("beta", "classname_declared", "grp", None))
def errors_per_class(spark, sf_dir):
    return _shown(RE.errors_by_group(checked(spark, sf_dir), F.col("classname_declared"), "beta"))


@query(_errors_sql("theta", "round_even(pred1_prob, 2)", "grp DESC", None))
def errors_per_probability(spark, sf_dir):
    return _shown(RE.errors_by_probability(checked(spark, sf_dir), "theta"))


@query(f"WITH {_C} SELECT classname_truth AS class, " + ", ".join(f"count(*) FILTER (pred1 = '{c}') AS \"{c}\"" for c in [*CLASSES, "NODATA", "IGN"]) + " FROM c GROUP BY 1")
def confusion(spark, sf_dir):
    return RE.confusion(verdicts(spark, sf_dir), "classname_truth", "pred1", [*CLASSES, "NODATA", "IGN"])


_SCORES = """
n AS (SELECT label, sum(a)::BIGINT AS nb_input, sum(b)::BIGINT AS nb_predicted, sum(h)::BIGINT AS nb_predicted_correct FROM (SELECT {t} AS label, 1 AS a, 0 AS b, ({t} = {p})::INT AS h FROM {src} UNION ALL SELECT {p}, 0, 1, 0 FROM {src}) GROUP BY label),
m AS (SELECT *, coalesce(nb_predicted_correct / nullif(nb_predicted, 0), 0) AS precision, coalesce(nb_predicted_correct / nullif(nb_input, 0), 0) AS recall, coalesce(2.0 * nb_predicted_correct / nullif(nb_input + nb_predicted, 0), 0) AS f1 FROM n)
"""


@query(f"WITH {_C}, {_SCORES.format(t='classname_truth', p='pred1', src='c')} SELECT label, nb_input, nb_predicted, nb_predicted_correct, nb_predicted - nb_predicted_correct AS nb_predicted_wrong, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM m")
def class_scores(spark, sf_dir):
    out = RE.class_scores(verdicts(spark, sf_dir), "classname_truth", "pred1")
    return out.select("label", "nb_input", "nb_predicted", "nb_predicted_correct", "nb_predicted_wrong", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


def _acc(subset: str, kind: str, pred: str, where: str, i: int) -> str:
    return f"""SELECT * FROM (WITH src AS (SELECT * FROM c WHERE {where}), {_SCORES.format(t='classname_truth', p=pred, src='src')} SELECT '{subset}' AS subset, '{kind}' AS kind, round(100.0 * sum(nb_predicted_correct) / sum(nb_input), 6) AS accuracy, round(100 * avg(precision), 6) AS precision_macro,
round(100 * avg(recall), 6) AS recall_macro, round(100 * avg(f1), 6) AS f1_macro, round(100.0 * sum(f1 * nb_input) / sum(nb_input), 6) AS f1_weighted, sum(nb_input)::BIGINT AS n FROM m) x{i}"""


_USED = "classname_truth <> 'IGN'"
_SURE = _USED + " AND coalesce(pred_full_alpha NOT IN ('NODATA', 'DOUBT:NOT_ENOUGH_PIXELS'), true)"


@query(f"WITH {_C} " + " UNION ALL ".join(_acc(s, k, p, w, i) for i, (s, w, k, p) in enumerate((s, w, k, p) for s, w in (("all", "true"), ("used_classes", _USED), ("used_classes_with_data", _SURE)) for k, p in (("standard", "pred1"), ("consolidated", "pred_full_alpha")))))
def accuracy(spark, sf_dir):
    out = RE.accuracies(verdicts(spark, sf_dir), "classname_truth", "pred1", "pred_full_alpha", ["IGN"])
    return out.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes))


@query(f"WITH {_C} SELECT pixcount, count(*) AS n, round(100.0 * count(*) FILTER (classname_truth = pred1) / count(*), 6) AS oa, round(100.0 * count(*) / (SELECT count(*) FROM c), 6) AS pct_all FROM c WHERE pixcount BETWEEN 0 AND 39 GROUP BY pixcount")
def oa_per_pixcount(spark, sf_dir):
    return RE.accuracy_by_pixels(verdicts(spark, sf_dir), "classname_truth", "pred1").withColumns({"oa": F.round("oa", 6), "pct_all": F.round("pct_all", 6)})


@query(f"WITH {_C} SELECT DISTINCT label FROM (SELECT classname_truth AS label FROM c UNION ALL SELECT pred1 FROM c)")
def label_list(spark, sf_dir):
    return RE.labels_of(verdicts(spark, sf_dir), "classname_truth", "pred1")


# ---------------------------------------------------------------- cover

_BANDS = {"asc_vv_mean": ("view", 400.0), "asc_vv_std": ("view", 150.0), "asc_vv_median": ("click", 600.0), "asc_vh_median": ("purchase", 2500.0), "asc_vh_std": ("error", 300.0), "desc_vv_mean": ("error", 420.0), "desc_vv_std": ("signup", 180.0), "desc_vv_median": ("view", 500.0), "desc_vh_median": ("signup", 2200.0), "desc_vh_std": ("click", 250.0)}
_PREMIUM = "CASE user_id % 6 WHEN 0 THEN 'BMG;EEF' WHEN 1 THEN 'MEV' WHEN 2 THEN 'MEG;X' WHEN 3 THEN 'EEF' WHEN 4 THEN 'OTHER' END"
_W = (
    f"w AS (SELECT user_id::VARCHAR AS uid, {_PREMIUM} AS all_best, date_trunc('week', ts)::DATE AS start_date, "
    + ", ".join(f"round(coalesce(avg(value) FILTER (event_type = '{t}'), 0) / {s}, 9) AS {c}" for c, (t, s) in _BANDS.items())
    + ", round(coalesce(avg(value) FILTER (event_type = 'purchase'), 0) / 120, 9) AS ndvi FROM events GROUP BY ALL)"
)


def _radar_sql(p: str, limit: float) -> str:
    return f"""CASE WHEN {p}vv_mean = 0 THEN 'NODATA' WHEN {p}vh_std > 0.5 OR {p}vv_std > 0.5 THEN 'multi' WHEN {p}vh_median < 0.07 AND ({p}vv_median < 0.027 OR {p}vh_std < 0.0027) THEN 'water'
WHEN {p}vv_median / nullif({p}vh_median, 0) >= 5.9 AND {p}vh_median < {limit} THEN 'bare-soil' WHEN {p}vv_mean > 0.25 THEN 'urban' ELSE 'other' END"""


_COVER = f"""{_W}, a AS (SELECT *, {_radar_sql('asc_', 0.013)} AS cover_asc, {_radar_sql('desc_', 0.015)} AS cover_desc, CASE WHEN ndvi = 0 THEN 'NODATA' WHEN ndvi < 0.35 THEN 'bare-soil' ELSE 'other' END AS cover_ndvi FROM w),
s AS (SELECT *, CASE WHEN cover_asc IN ('NODATA', 'multi') THEN cover_desc WHEN cover_desc IN ('NODATA', 'multi') THEN cover_asc WHEN cover_asc = 'water' AND cover_desc = 'water' THEN 'water'
  WHEN cover_asc IN ('bare-soil', 'water') AND cover_desc IN ('bare-soil', 'water') THEN 'bare-soil' WHEN cover_asc = 'urban' OR cover_desc = 'urban' THEN 'urban' ELSE 'other' END AS cover_s1 FROM a),
k AS (SELECT *, CASE WHEN ndvi >= 0.35 THEN 0.0 WHEN ndvi <> 0 THEN 1 - ndvi WHEN cover_s1 = 'NODATA' THEN NULL WHEN cover_asc = 'bare-soil' THEN 0.5 ELSE 0.0 END::DOUBLE AS pred1_prob FROM s),
cov AS (SELECT *, CASE WHEN pred1_prob IS NULL THEN 'NODATA' WHEN pred1_prob > 0.5 THEN 'bare-soil' WHEN pred1_prob > 0.4 THEN 'DOUBT' ELSE 'other' END AS pred1 FROM k)"""


def weeks(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rest = F.col("user_id") % 6
    premium = F.when(rest == 0, "BMG;EEF").when(rest == 1, "MEV").when(rest == 2, "MEG;X").when(rest == 3, "EEF").when(rest == 4, "OTHER")
    e = e.select(F.col("user_id").cast("string").alias("uid"), premium.alias("all_best"), F.date_trunc("week", "ts").cast("date").alias("start_date"), "event_type", "value")
    mean = lambda t, s: F.round(F.coalesce(F.avg(F.when(F.col("event_type") == t, F.col("value"))), F.lit(0.0)) / s, 9)
    return CV.weekly_cover(e.groupBy("uid", "all_best", "start_date").agg(*(mean(t, s).alias(c) for c, (t, s) in _BANDS.items()), mean("purchase", 120.0).alias("ndvi")))


_COLS = "uid, start_date, ndvi, cover_asc, cover_desc, cover_ndvi, cover_s1, round(pred1_prob, 9) AS pred1_prob, pred1"


@query(f"WITH {_COVER} SELECT {_COLS} FROM cov")
def cover_labels(spark, sf_dir):
    return weeks(spark, sf_dir).select("uid", "start_date", "ndvi", "cover_asc", "cover_desc", "cover_ndvi", "cover_s1", F.round("pred1_prob", 9).alias("pred1_prob"), "pred1")


@query(
    f"""WITH {_COVER}, o AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pred1_prob DESC NULLS LAST, start_date) AS r FROM cov),
m AS (SELECT uid, arg_min(cover_s1, r) AS cover_s1, arg_min(ndvi, r) AS ndvi, max(pred1_prob) AS p FROM o GROUP BY uid)
SELECT uid, cover_s1, ndvi, round(p, 9) AS pred1_prob, CASE WHEN p IS NULL THEN 'NODATA' WHEN p > 0.5 THEN 'ONBEDEKT' WHEN p > 0.4 THEN 'DOUBT' ELSE 'BEDEKT' END AS pred_consolidated, CASE WHEN p IS NULL OR (p > 0.4 AND p <= 0.5) THEN 'NOK' ELSE 'OK' END AS pred_cons_status FROM m"""
)
def cover_best_week(spark, sf_dir):
    out = CV.final_cover(CV.best_week(weeks(spark, sf_dir), ["cover_s1", "ndvi"]))
    return out.withColumn("pred1_prob", F.round("pred1_prob", 9))


@query(f"WITH {_COVER} SELECT {_COLS} FROM cov WHERE (all_best LIKE '%BMG%' OR all_best LIKE '%MEG%' OR all_best LIKE '%MEV%' OR all_best LIKE '%EEF%') AND ((ndvi <> 0 AND ndvi < 0.3) OR cover_s1 = 'bare-soil')")
def cover_select_premiums(spark, sf_dir):
    return CV.premium_selection(weeks(spark, sf_dir)).select("uid", "start_date", "ndvi", "cover_asc", "cover_desc", "cover_ndvi", "cover_s1", F.round("pred1_prob", 9).alias("pred1_prob"), "pred1")


@query(f"WITH {_COVER} SELECT {_COLS} FROM cov WHERE (ndvi <> 0 AND ndvi < 0.35) OR (cover_s1 = 'bare-soil' AND ndvi = 0)")
def cover_select_bare(spark, sf_dir):
    return CV.bare_selection(weeks(spark, sf_dir)).select("uid", "start_date", "ndvi", "cover_asc", "cover_desc", "cover_ndvi", "cover_s1", F.round("pred1_prob", 9).alias("pred1_prob"), "pred1")


_CHECKS = "chk AS (SELECT uid, start_date, CASE WHEN uid::BIGINT % 4 = 0 THEN 'plough' END AS finding, CASE WHEN uid::BIGINT % 5 < 3 THEN (CASE uid::BIGINT % 7 WHEN 0 THEN '98' WHEN 1 THEN '660' WHEN 2 THEN '63' WHEN 3 THEN '745' ELSE '901' END) END AS checked_main, CASE WHEN uid::BIGINT % 9 = 0 THEN '98' END AS checked_late FROM (SELECT DISTINCT uid, start_date FROM cov))"


def _correct_sql(c: str) -> str:
    bare = f"{c} = 'bare-soil'"
    not_in = lambda x: f"(checked_main IS NOT NULL AND checked_main NOT IN ({x}))"
    bmg, mev = "'60','63','638','660','700','745','9827','9828'", "'660','700','723','732'"
    return f"""CASE WHEN finding IS NULL AND checked_main IS NULL AND checked_late IS NULL THEN 'no_groundtruth' WHEN {c} = 'NODATA' THEN 'NODATA'
WHEN reason = 'BMG' AND {bare} AND (finding IS NOT NULL OR {not_in(bmg)}) THEN 'yes' WHEN reason = 'BMG' AND NOT {bare} AND finding IS NULL THEN 'yes'
WHEN reason = 'EEF' AND {bare} AND (coalesce(checked_main <> '98', false) OR coalesce(checked_late <> '98', false) OR finding IS NOT NULL) THEN 'yes' WHEN reason = 'EEF' AND NOT {bare} AND (checked_main IS NULL OR checked_main = '98') THEN 'yes'
WHEN reason = 'MEV' AND {bare} AND ({not_in(mev)} OR finding IS NOT NULL) THEN 'yes' WHEN reason = 'MEV' AND NOT {bare} AND (checked_main IS NULL OR checked_main IN ({mev})) THEN 'yes'
WHEN reason = 'MEG' AND {bare} AND ({not_in("'63'")} OR finding IS NOT NULL) THEN 'yes' WHEN reason = 'MEG' AND NOT {bare} AND (checked_main IS NULL OR checked_main = '63') THEN 'yes' ELSE 'no' END"""


@query(
    f"""WITH {_COVER}, {_CHECKS}, j AS (SELECT cov.*, finding, checked_main, checked_late, CASE WHEN all_best LIKE '%BMG%' THEN 'BMG' WHEN all_best LIKE '%EEF%' THEN 'EEF' WHEN all_best LIKE '%MEG%' THEN 'MEG' WHEN all_best LIKE '%MEV%' THEN 'MEV' ELSE '?' END AS reason FROM cov LEFT JOIN chk USING (uid, start_date)),
x AS (SELECT *, CASE WHEN ndvi = 0 THEN 'NODATA' WHEN ndvi < CASE WHEN reason = 'BMG' THEN 0.25 ELSE 0.3 END THEN 'bare-soil' ELSE 'other' END AS cover_check FROM j),
y AS (SELECT reason, {_correct_sql('cover_check')} AS a, {_correct_sql('cover_s1')} AS b FROM x)
SELECT reason, count(*) AS n, count(*) FILTER (a = 'yes') AS ndvi_yes, count(*) FILTER (a = 'no') AS ndvi_no, count(*) FILTER (a = 'NODATA') AS ndvi_nodata, count(*) FILTER (b = 'yes') AS s1_yes, count(*) FILTER (b = 'no') AS s1_no, count(*) FILTER (b = 'NODATA') AS s1_nodata,
count(*) FILTER (a = 'no_groundtruth') AS unchecked FROM y GROUP BY reason"""
)
def cover_stats(spark, sf_dir):
    rows = weeks(spark, sf_dir)
    n = F.col("uid").cast("long")
    main = F.when(n % 5 < 3, F.when(n % 7 == 0, "98").when(n % 7 == 1, "660").when(n % 7 == 2, "63").when(n % 7 == 3, "745").otherwise("901"))
    checks = rows.select("uid", "start_date").distinct().select("uid", "start_date", F.when(n % 4 == 0, "plough").alias("finding"), main.alias("checked_main"), F.when(n % 9 == 0, "98").alias("checked_late"))
    return CV.reason_statistics(CV.field_check(rows, checks, ["uid", "start_date"]))
