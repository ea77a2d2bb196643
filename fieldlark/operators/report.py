"""Report tables: shares, confusion, accuracy, conclusions against declarations and ground truth, and error rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import same, starts, within
from ..functions.values import EDGES, bin_labels, binned, percent

ALPHA, BETA = "FARMER-CORRECT_PRED-WRONG:ERROR_ALPHA", "FARMER-WRONG_PRED-DOESNT_OPPOSE:ERROR_BETA"


def shares(rows: DataFrame, *by: str) -> DataFrame:
    """Count and percentage of the total for each group."""
    n = rows.groupBy(*by).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).select(*by, "n", (100.0 * F.col("n") / F.col("_all")).alias("pct"))


def conclusion(rows: DataFrame, verdict: str, unimportant: list[str], not_for_training: list[str], ignored: list[str], declared: str = "classname_declared", name: str = "conclusion") -> DataFrame:
    """Short and (`name`_detail) detailed conclusion on a prediction."""
    d, v = F.col(declared), F.col(verdict)
    doubt = starts(v, "DOUBT") | same(v, F.lit("NODATA"))
    unused = within(d, [*not_for_training, *ignored])
    short = F.when(within(d, unimportant), "IGNORE:UNIMPORTANT").when(unused, "IGNORE").when(doubt, "DOUBT").when(same(d, v), "OK:PREDICTION=INPUT_CLASS").otherwise("NOK:PREDICTION<>INPUT_CLASS")
    detail = (
        F.when(within(d, unimportant), F.concat(F.lit("IGNORE:UNIMPORTANT:INPUTCLASSNAME="), d))
        .when(unused, F.concat(F.lit("IGNORE:INPUTCLASSNAME="), d))
        .when(doubt, F.concat(F.lit("DOUBT:REASON="), v))
        .when(same(d, v), "OK:PREDICTION=INPUT_CLASS")
        .otherwise("NOK:PREDICTION<>INPUT_CLASS")
    )
    return rows.withColumns({name: short, f"{name}_detail": detail})


def truth_conclusions(rows: DataFrame, verdict: str, ignored: list[str], truth: str = "classname_truth", declared: str = "classname_declared", second: str | None = None, prefix: str = "gt") -> DataFrame:
    """Declaration against truth, prediction against truth, and both together."""
    t, d, v = F.col(truth), F.col(declared), F.col(verdict)
    d2 = F.col(second) if second else F.lit(None).cast("string")
    farmer = (
        F.when(same(d, t) & within(t, ignored), F.concat(F.lit("FARMER-CORRECT:IGNORE:DECLARED=GROUNDTRUTH="), t))
        .when(same(d, t) | same(d2, t), "FARMER-CORRECT")
        .otherwise("FARMER-WRONG")
    )
    unclear = starts(v, "DOUBT")
    pred = (
        F.when(same(v, t) & within(v, ignored), F.concat(F.lit("PRED-CORRECT:IGNORE:PREDICTION=GROUNDTRUTH="), v))
        .when(same(v, t), "PRED-CORRECT")
        .when(d2.isNotNull() & (same(v, d2) | same(v, d)), "PRED-CORRECT")
        .when(within(d, ignored) & unclear, F.concat(F.lit("PRED-DOUBT:REASON="), v, F.lit(":DECLARED="), d))
        .when(unclear | same(v, F.lit("NODATA")), F.concat(F.lit("PRED-DOUBT:REASON="), v))
        .when(within(t, ignored), F.concat(F.lit("PRED-WRONG:IGNORE:GROUNDTRUTH="), t))
        .otherwise("PRED-WRONG")
    )
    f, p = F.col(f"{prefix}_farmer"), F.col(f"{prefix}_pred")
    both = (
        F.when((f == "FARMER-CORRECT") & (p == "PRED-WRONG"), ALPHA)
        .when(f == "FARMER-CORRECT", F.concat(F.lit("FARMER-CORRECT_"), p))
        .when((f == "FARMER-WRONG") & same(d, v), BETA)
        .when(f == "FARMER-WRONG", F.concat(F.lit("FARMER-WRONG_"), p))
        .otherwise(f)
    )
    return rows.withColumns({f"{prefix}_farmer": farmer, f"{prefix}_pred": pred}).withColumn(f"{prefix}_conclusion", both)


def _error(kind: str, c: Column) -> tuple[Column, Column]:
    """(numerator, rest of the denominator) of an error as conditions on the combined conclusion."""
    if kind == "alpha":
        return same(c, F.lit(ALPHA)), starts(c, "FARMER-WRONG_PRED-CORRECT") | starts(c, "FARMER-WRONG_PRED-WRONG")
    if kind == "beta":
        return same(c, F.lit(BETA)), starts(c, "FARMER-CORRECT")
    if kind == "theta":
        return starts(c, "FARMER-WRONG_PRED-DOUBT"), starts(c, "FARMER-CORRECT_PRED-DOUBT")
    raise ValueError(f"unknown error {kind}")


def error_rates(rows: DataFrame, conclusion: str = "gt_conclusion") -> DataFrame:
    """(error, numerator, denominator, pct) of alpha, beta and theta; pct is null without a denominator."""
    counts = []
    for kind in ("alpha", "beta", "theta"):
        top, rest = _error(kind, F.col(conclusion))
        counts += [F.count_if(top).alias(f"{kind}_n"), F.count_if(top | rest).alias(f"{kind}_d")]
    lines = F.array(*(F.struct(F.lit(k).alias("error"), F.col(f"{k}_n").alias("numerator"), F.col(f"{k}_d").alias("denominator")) for k in ("alpha", "beta", "theta")))
    return rows.agg(*counts).select(F.inline(lines)).withColumn("pct", F.try_divide(100.0 * F.col("numerator"), F.col("denominator")))


def errors_by_group(rows: DataFrame, by: Column, kind: str, conclusion: str = "gt_conclusion", full: str | None = None, descending: bool = False, cumulative: bool = True, labels: list[str] | None = None) -> DataFrame:
    """Ten columns on the errors of each group, running totals in group order.

    count_error is null for a group without errors, unless `labels` lists all groups: then each is there and counts 0.
    """
    top, rest = _error(kind, F.col(conclusion))
    top_f, rest_f = _error(kind, F.col(full or conclusion))
    g = rows.select(by.alias("grp"), top.alias("e"), (top | rest).alias("a"), top_f.alias("ef"), (top_f | rest_f).alias("af")).where("grp is not null")
    c = g.groupBy("grp").agg(F.count_if("a").alias("count_all"), F.count_if("e").alias("count_error"), F.count_if("ef").alias("count_error_full_doubt"), F.count_if("af").alias("count_all_full_doubt"))
    if labels is not None:
        every = rows.sparkSession.createDataFrame([(i, x) for i, x in enumerate(labels)], "pos int, grp string")
        c = every.join(c, "grp", "left").na.fill(0)
        order = F.col("pos")
    else:
        c = c.where("count_all > 0").withColumn("count_error", F.when(F.col("count_error") > 0, F.col("count_error")))
        order = F.col("grp")
    order = order.desc() if descending else order.asc()
    if cumulative:
        w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        whole = F.sum("count_all").over(Window.partitionBy(F.lit(0)))
        run = F.when(F.col("count_error").isNotNull(), F.sum("count_error").over(w))
        c = c.withColumns({"count_all_cumul": F.sum("count_all").over(w), "count_error_cumul": run})
        c = c.withColumns({"pct_all_cumul": F.try_divide(100.0 * F.col("count_all_cumul"), whole), "pct_error_cumul": F.try_divide(100.0 * F.col("count_error_cumul"), F.col("count_all_cumul")), "pct_error_cumul_vs_count_all": F.try_divide(100.0 * F.col("count_error_cumul"), whole)})
    return c.withColumn("pct_error_all", F.try_divide(100.0 * F.col("count_error"), F.col("count_all"))).drop("pos")


def errors_by_pixels(rows: DataFrame, kind: str, conclusion: str = "gt_conclusion", pixels: str = "pixcount", **kw) -> DataFrame:
    return errors_by_group(rows, binned(F.col(pixels)), kind, conclusion, labels=bin_labels(EDGES), **kw)


def errors_by_probability(rows: DataFrame, kind: str, conclusion: str = "gt_conclusion", prob: str = "pred1_prob", **kw) -> DataFrame:
    return errors_by_group(rows, percent(F.col(prob)), kind, conclusion, descending=True, **kw)


def dealt_shares(rows: DataFrame, tables: dict[str, Column], where: dict[str, Column] | None = None) -> DataFrame:
    """(name, value, n, pct) of several tables in one pass: each row is dealt to the tables whose condition in `where` it meets."""
    where = where or {}
    parts = [F.when(where.get(name, F.lit(True)), F.struct(F.lit(name).alias("name"), c.cast("string").alias("value"))) for name, c in tables.items()]
    n = rows.select(F.inline(F.filter(F.array(*parts), lambda x: x.isNotNull()))).groupBy("name", "value").agg(F.count("*").alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("name")))


def dealt_errors(rows: DataFrame, groupings: dict[str, tuple[Column, Column, str]], full: str, listed: dict[str, list[str]]) -> DataFrame:
    """The error tables of several groupings and of all three errors in one pass.

    `groupings` gives for each name (group, order, conclusion): rows are dealt to (grouping, group), counted for each error, and the
    few counts are totalled in order. `listed` names groupings whose groups are all there, in their order, and count 0 without
    rows; elsewhere groups without a row in the denominator are left out, and count_error is null for one without errors.
    """
    kinds, deals, numbers = ("alpha", "beta", "theta"), [], ("count_all", "count_error", "count_error_full_doubt", "count_all_full_doubt")
    for name, (group, order, conclusion) in groupings.items():
        flags = []
        for kind in kinds:
            (top, rest), (top_f, rest_f) = _error(kind, F.col(conclusion)), _error(kind, F.col(full))
            flags.append(F.struct(F.lit(kind).alias("kind"), *(x.cast("int").alias(c) for x, c in zip((top | rest, top, top_f, top_f | rest_f), numbers, strict=True))))
        deals.append(F.struct(F.lit(name).alias("grouping"), group.cast("string").alias("grp"), order.cast("double").alias("pos"), F.array(*flags).alias("f")))
    dealt = rows.select(F.inline(F.array(*deals))).where("grp is not null")
    sums = [F.sum(F.col("f")[i][c]).alias(f"{c}{i}") for i in range(len(kinds)) for c in numbers]  # one row a group, whatever the kinds
    counted = dealt.groupBy("grouping", "grp", "pos").agg(*sums)
    lines = F.array(*(F.struct(F.lit(k).alias("kind"), *(F.col(f"{c}{i}").alias(c) for c in numbers)) for i, k in enumerate(kinds)))
    counted = counted.select("grouping", "grp", "pos", F.inline(lines))
    if listed:
        every = [(g, x, float(i), k, 0, 0, 0, 0) for g, xs in listed.items() for i, x in enumerate(xs) for k in kinds]
        zero = rows.sparkSession.createDataFrame(every, "grouping string, grp string, pos double, kind string, " + ", ".join(f"{c} long" for c in numbers))
        counted = counted.unionByName(zero).groupBy("grouping", "grp", "kind").agg(F.max("pos").alias("pos"), *(F.sum(c).alias(c) for c in numbers))
    all_there = F.col("grouping").isin(*listed)
    c = counted.where(all_there | (F.col("count_all") > 0)).withColumn("count_error", F.when(all_there | (F.col("count_error") > 0), F.col("count_error")))
    run = Window.partitionBy("grouping", "kind").orderBy("pos", "grp").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum("count_all").over(Window.partitionBy("grouping", "kind"))
    c = c.withColumns({"count_all_cumul": F.sum("count_all").over(run), "count_error_cumul": F.when(F.col("count_error").isNotNull(), F.sum("count_error").over(run))})
    pct = lambda a, b: F.try_divide(100.0 * a, b)
    c = c.withColumns({"pct_all_cumul": pct(F.col("count_all_cumul"), whole), "pct_error_cumul": pct(F.col("count_error_cumul"), F.col("count_all_cumul")), "pct_error_cumul_vs_count_all": pct(F.col("count_error_cumul"), whole), "pct_error_all": pct(F.col("count_error"), F.col("count_all"))})
    return c.withColumn("name", F.concat_ws("_", "kind", "grouping"))


def labels_of(rows: DataFrame, a: str, b: str) -> DataFrame:
    """All labels of two columns, in order."""
    return rows.select(F.col(a).alias("label")).union(rows.select(F.col(b).alias("label"))).distinct().orderBy("label")


def confusion(rows: DataFrame, truth: str, pred: str, labels: list[str]) -> DataFrame:
    """One row a true class, one column a predicted one."""
    return rows.groupBy(F.col(truth).alias("class")).pivot(pred, labels).count().na.fill(0)


def class_scores(rows: DataFrame, truth: str, pred: str, by: tuple[str, ...] = ()) -> DataFrame:
    """For each label of either column its counts, shares and F1, within each group of `by`; undefined ratios are 0."""
    pairs = rows.groupBy(*by, F.col(truth).alias("t"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    # each count stands once under its true and once under its predicted label: one more aggregation, no join
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(F.struct(F.col("t").alias("label"), F.col("n").alias("a"), F.lit(0).cast("long").alias("b"), hit.alias("h")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("a"), F.col("n").alias("b"), F.lit(0).cast("long").alias("h")))
    both = pairs.select(*by, F.inline(sides)).groupBy(*by, "label").agg(F.sum("a").alias("nb_input"), F.sum("h").alias("nb_predicted_correct"), F.sum("b").alias("nb_predicted"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    n, p, c = F.col("nb_input"), F.col("nb_predicted"), F.col("nb_predicted_correct")
    return both.withColumns({"nb_predicted_wrong": p - c, "pct_correct": zero(100.0 * c, n), "pct_wrong": zero(100.0 * (p - c), n), "precision": zero(c, p), "recall": zero(c, n), "f1": zero(2.0 * c, n + p)})


def accuracy(rows: DataFrame, truth: str, pred: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro precision, recall and F1 over the labels of both columns, and F1 weighted by truth, as percentages."""
    s = class_scores(rows, truth, pred, by)
    n = F.sum("nb_input")
    return s.groupBy(*by).agg(
        F.try_divide(100.0 * F.sum("nb_predicted_correct"), n).alias("accuracy"), (100 * F.avg("precision")).alias("precision_macro"), (100 * F.avg("recall")).alias("recall_macro"),
        (100 * F.avg("f1")).alias("f1_macro"), F.try_divide(100.0 * F.sum(F.col("f1") * F.col("nb_input")), n).alias("f1_weighted"), n.alias("n"),
    )


def accuracies(rows: DataFrame, truth: str, standard: str, full: str, not_used: list[str]) -> DataFrame:
    """Three subsets of parcels by two kinds of prediction; each row is dealt to its subsets and kinds at once."""
    used = ~within(F.col(truth), not_used)
    sure = used & ~within(F.col(full), ["NODATA", "DOUBT:NOT_ENOUGH_PIXELS"])
    subsets = F.filter(F.array(F.lit("all"), F.when(used, "used_classes"), F.when(sure, "used_classes_with_data")), lambda x: x.isNotNull())
    kinds = F.array(F.struct(F.lit("standard").alias("kind"), F.col(standard).alias("_pred")), F.struct(F.lit("consolidated").alias("kind"), F.col(full).alias("_pred")))
    dealt = rows.select(F.col(truth).alias("_truth"), F.explode(subsets).alias("subset"), kinds.alias("_k")).select("_truth", "subset", F.inline("_k"))
    return accuracy(dealt, "_truth", "_pred", ("subset", "kind"))


def accuracy_by_pixels(rows: DataFrame, truth: str, pred: str, pixels: str = "pixcount", most: int = 39) -> DataFrame:
    """Overall accuracy for each small pixel count, with its share of all rows."""
    n = F.broadcast(rows.agg(F.count("*").alias("_all")))
    few = rows.where(F.col(pixels).between(0, most)).groupBy(pixels).agg(F.count("*").alias("n"), F.avg(same(F.col(truth), F.col(pred)).cast("double")).alias("oa"))
    return few.crossJoin(n).select(pixels, "n", (100 * F.col("oa")).alias("oa"), (100.0 * F.col("n") / F.col("_all")).alias("pct_all"))


def split_unimportant(rows: DataFrame, unimportant: list[str], declared: str = "classname_declared") -> tuple[DataFrame, DataFrame]:
    """(rows that are reported, rows of unimportant classes); without a declared class a row is reported."""
    aside = within(F.col(declared), unimportant)
    return rows.where(~aside), rows.where(aside)


def with_training_flag(rows: DataFrame, train: DataFrame, id_col: str = "uid") -> DataFrame:
    ids = train.select(id_col).distinct().withColumn("used_for_train", F.lit(True))
    return rows.join(ids, id_col, "left").na.fill({"used_for_train": False})


def join_truth(rows: DataFrame, truth: DataFrame, id_col: str = "uid") -> DataFrame:
    """Predictions of checked parcels; an error if there is none."""
    new = [c for c in truth.columns if c == id_col or c not in rows.columns]
    found = rows.join(truth.select(*new), id_col, "inner")
    if not found.limit(1).count():
        raise ValueError("no checked parcel has a prediction")
    return found
