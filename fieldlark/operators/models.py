"""Classifiers on feature columns: training, prediction of class probabilities, and a registry of saved models."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .features import with_features
from .sampling import split_folds

class RandomFourier(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features in which a linear margin is one of a Gaussian kernel: cosines of random projections, the same for a seed."""

    components = Param(Params._dummy(), "components", "number of cosines", typeConverter=TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "number of input features", typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of the kernel exp(-gamma * distance ** 2)", typeConverter=TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the projections", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, components=None, width=None, gamma=None, seed=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, rows: DataFrame) -> DataFrame:
        get = self.getOrDefault
        lot = np.random.RandomState(get(self.seed))
        w = lot.normal(0, math.sqrt(2 * get(self.gamma)), (get(self.components), get(self.width)))
        shift = lot.uniform(0, 2 * math.pi, get(self.components))
        scale, width = math.sqrt(2 / get(self.components)), get(self.width)

        # a function of batches: as literals the projections would make every later plan thousands of expressions long
        @F.pandas_udf("array<double>")
        def cosines(x: pd.Series) -> pd.Series:
            return pd.Series(list(scale * np.cos(np.array(x.tolist(), float).reshape(-1, width) @ w.T + shift)), dtype=object)

        return rows.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(self.getInputCol()))))


class Calibrated(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Margins of each class to probabilities that add up to 1, and the prediction of the greatest.

    A class's curve is given by its points (margins in order, probabilities), with straight lines between and constant beyond; with
    one number for its points it is a sigmoid of slope * margin + offset.
    """

    margins = Param(Params._dummy(), "margins", "of the points, for each class", typeConverter=TypeConverters.identity)
    shares = Param(Params._dummy(), "shares", "at the points, for each class", typeConverter=TypeConverters.identity)

    @keyword_only
    def __init__(self, inputCol=None, margins=None, shares=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, rows: DataFrame) -> DataFrame:
        raw, curves = vector_to_array(self.getInputCol()), []
        for i, (xs, ys) in enumerate(zip(self.getOrDefault(self.margins), self.getOrDefault(self.shares), strict=True)):
            m = F.get(raw, F.lit(i))
            if len(xs) == 1:
                curves.append(1 / (1 + F.exp(-(xs[0] * m + ys[0]))))
                continue
            points = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in zip(xs, ys, strict=True)))
            low, high = F.array_max(F.filter(points, lambda p: p["x"] <= m)), F.array_min(F.filter(points, lambda p: p["x"] >= m))
            between = F.when(high["x"] == low["x"], low["y"]).otherwise(low["y"] + (m - low["x"]) / (high["x"] - low["x"]) * (high["y"] - low["y"]))
            curves.append(F.coalesce(between, low["y"], high["y"]))
        rows = rows.withColumn("_p", F.array(*(F.greatest(c, F.lit(1e-9)) for c in curves)))
        whole = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
        rows = rows.withColumn("_p", F.transform("_p", lambda x: x / whole))
        return rows.withColumns({"probability": array_to_vector("_p"), "prediction": (F.array_position("_p", F.array_max("_p")) - 1).cast("double")}).drop("_p")


#: Classes whose curves are fitted at the same time; values of the rows that all models fitted at the same time hold at most (1 GB).
TOGETHER_FITTED, MOST_HELD = 8, 1 << 27
#: Boosted trees of each class, and their depth (up to 32 leaves), unless given: the reference's library takes 100 trees of 31 leaves.
BOOSTS, DEPTH = 100, 5
#: Steps of a support vector machine at most, unless given: it ends by its tolerance long before.
UNTIL = 10_000
CLASSIFIERS: dict[str, Callable] = {
    "randomforest": lambda n, k, **kw: RandomForestClassifier(labelCol="_label", featuresCol="_features", seed=kw.pop("seed", 1), **kw),
    "gradientboosting": lambda n, k, **kw: OneVsRest(classifier=GBTClassifier(seed=kw.pop("seed", 1), maxIter=kw.pop("maxIter", BOOSTS), maxDepth=kw.pop("maxDepth", DEPTH), **kw), labelCol="_label", featuresCol="_features"),
    "multilayer_perceptron": lambda n, k, **kw: MultilayerPerceptronClassifier(layers=[n, *kw.pop("hidden", [max(2, n)]), k], labelCol="_label", featuresCol="_features", seed=kw.pop("seed", 1), **kw),
    "svm": lambda n, k, **kw: OneVsRest(classifier=LinearSVC(maxIter=kw.pop("maxIter", UNTIL), standardization=kw.pop("standardization", False), **kw), labelCol="_label", featuresCol="_features"),
}
#: Classifiers that give margins, and the curve that turns held-out ones into probabilities; folds of the rows that they are held out in.
CURVES, FOLDS = {"gradientboosting": "isotonic", "svm": "sigmoid"}, 3
#: Cosines that stand for the Gaussian kernel of the support vector machine.
COSINES = 200


def _sigmoid(rows: DataFrame, i: int) -> tuple[list[float], list[float]]:
    fit = LogisticRegression(labelCol="_y", featuresCol="_m", maxIter=50).fit(rows.select(array_to_vector(F.array(F.get("_raw", F.lit(i)))).alias("_m"), (F.col("_label") == i).cast("double").alias("_y")))
    return [float(fit.coefficients[0])], [float(fit.intercept)]


def _isotonic(rows: DataFrame, i: int) -> tuple[list[float], list[float]]:
    fit = IsotonicRegression(labelCol="_y", featuresCol="_m").fit(rows.select(array_to_vector(F.array(F.get("_raw", F.lit(i)))).alias("_m"), (F.col("_label") == i).cast("double").alias("_y")))
    xs, ys = [float(x) for x in fit.boundaries], [float(y) for y in fit.predictions]
    return (xs, ys) if len(xs) > 1 else (xs * 2, ys * 2)


def _kept(rows: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder, partitions in order: fits read the rows many times, and none of them plans or makes them again."""
    from ..plans.runs import shared_folder

    spark = rows.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return rows.checkpoint()


def _fitted(rows: DataFrame, make: Callable[[], Estimator], classes: int, width: int) -> tuple[Transformer, DataFrame]:
    """The model of all rows, and (_label, _raw): each row's margins by a classifier of the other folds; equal rows share a fold.

    Each fit of a class waits for small jobs most of the time and holds the rows: as many run at once as hold MOST_HELD values.
    """
    fold = F.pmod(F.xxhash64(vector_to_array("_features")), F.lit(FOLDS))
    together = max(1, MOST_HELD // max(1, rows.count() * width))
    models = min(FOLDS + 1, max(1, together // classes))
    with ThreadPoolExecutor(models) as pool:
        parts = [rows, *(rows.where(fold != i) for i in range(FOLDS))]
        whole, *others = pool.map(lambda part: make().setParallelism(max(1, min(classes, together // models))).fit(part), parts)
    out = None
    for i, model in enumerate(others):
        part = model.transform(rows.where(fold == i)).select("_label", vector_to_array("rawPrediction").alias("_raw"))
        out = part if out is None else out.unionByName(part)
    return whole, out


def train(rows: DataFrame, features: list[str], class_col: str, kind: str = "randomforest", **options) -> PipelineModel:
    """A pipeline of label index, feature vector (in name order) and classifier; its label list and features travel with it.

    The support vector machine has a Gaussian kernel, by random Fourier features of the standardised features. Its margins, and those
    of boosted trees, become probabilities by curves fitted to held-out margins of FOLDS folds (a sigmoid, and isotonic).
    """
    features = sorted(features)
    indexer = StringIndexer(inputCol=class_col, outputCol="_label", handleInvalid="skip", stringOrderType="alphabetAsc").fit(rows)
    steps: list = [VectorAssembler(inputCols=features, outputCol="_features" if kind != "svm" else "_raw_features")]
    if kind == "svm":
        gamma, components = options.pop("gamma", 1 / max(1, len(features))), options.pop("components", COSINES)
        steps += [StandardScaler(inputCol="_raw_features", outputCol="_scaled", withMean=True), RandomFourier(inputCol="_scaled", outputCol="_features", components=components, width=len(features), gamma=float(gamma), seed=options.pop("seed", 1))]
        # a penalty of 1 for a row's slack, as without `regParam` nothing bounds the margin of classes that can be told apart
        options.setdefault("regParam", 1 / max(1, rows.where(F.col(class_col).isNotNull()).count()))
    make = lambda: CLASSIFIERS[kind](len(features), len(indexer.labels), **options)
    prepared = Pipeline(stages=steps).fit(indexer.transform(rows))
    ready = prepared.transform(indexer.transform(rows)).select("_label", "_features")
    if kind in CURVES:  # fitted for each class, and again for each fold
        ready = _kept(ready)
        model, held = _fitted(ready, make, len(indexer.labels), len(features))
    else:
        model = make().fit(ready)
    stages = [indexer, *prepared.stages, model]
    if kind in CURVES:
        held = _kept(held)
        with ThreadPoolExecutor(TOGETHER_FITTED) as pool:
            curves = list(pool.map(lambda i: (_sigmoid if CURVES[kind] == "sigmoid" else _isotonic)(held, i), range(len(indexer.labels))))
        stages.append(Calibrated(inputCol="rawPrediction", margins=[c[0] for c in curves], shares=[c[1] for c in curves]))
    return PipelineModel([*stages, IndexToString(inputCol="prediction", outputCol="pred1", labels=indexer.labels)])


def check_features(model: PipelineModel, rows: DataFrame) -> list[str]:
    """The model's features, which are saved with it; an error if the rows lack one. Further columns are left out."""
    wanted = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    gone = [c for c in wanted if c not in rows.columns]
    if gone:
        raise ValueError(f"the model needs {gone}")
    return wanted


def same_features(model: PipelineModel, features: list[str]) -> None:
    """An error unless the model was made of exactly these features."""
    wanted = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    if sorted(wanted) != sorted(features):
        raise ValueError(f"the model is of {sorted(wanted)}, not of {sorted(features)}")


def probabilities(model: PipelineModel, rows: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """One column a class with its probability, besides `keep`; and the classes."""
    check_features(model, rows)
    labels, out = classes_of(model), rows
    for stage in model.stages[1:]:
        out = stage.transform(out)
    out = out.select(*keep, vector_to_array("probability").alias("_p"))
    return out.select(*keep, *(F.get("_p", F.lit(i)).alias(c) for i, c in enumerate(labels))), labels


#: Pivots of the training rows at most, rows of a chunk of a pivot's cell, and rows that are compared with a chunk at once.
MOST_PIVOTS, CHUNK, TOGETHER = 64, 4096, 1024


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rounded to nine digits; differences are taken around x's mean, which keeps digits."""
    mean = x.mean(0)
    q, x = q - mean, x - mean
    return np.round(np.sqrt(np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1) - 2 * q @ x.T, 0)), 9)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(batches: Iterator[pa.RecordBatch], pivots) -> Iterator[pa.RecordBatch]:
    """Training rows with the cell of the nearest pivot and the distance from it."""
    for batch in batches:
        d = _distances(_matrix(batch.column(2)), pivots.value) if batch.num_rows else np.zeros((0, 1))
        near = d.argmin(1) if batch.num_rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])], names=["_other", "_class", "_x", "_cell", "_far"])


def _cells_to_ask(batches: Iterator[pa.RecordBatch], known, k: int, first: bool) -> Iterator[pa.RecordBatch]:
    """(_id, _x, _cell): first the nearest cells that hold k rows together; then the others that may hold one as near as column 2."""
    pivots, count, far = known.value
    for batch in batches:
        d = _distances(_matrix(batch.column(1)), pivots) if batch.num_rows else np.zeros((0, len(pivots)))
        order = np.argsort(d, axis=1, kind="stable")
        before = np.zeros(d.shape, np.int64)
        np.put_along_axis(before, order, np.cumsum(count[order], axis=1) - count[order], axis=1)
        asked = before < k
        if not first:
            reached = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            asked = ~asked & (d - far <= np.where(np.isnan(reached), np.inf, reached)[:, None] + 1e-8)
        row, cell = np.nonzero(asked)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(cell.astype(np.int32))], names=["_id", "_x", "_cell"])


def _nearest_of_chunk(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k nearest rows of a chunk for every row that asks; ties by id."""
        schema = pa.schema([("_id", pa.string()), ("_other", pa.string()), ("_class", pa.string()), ("_d", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by("_other")
        x, out = _matrix(left["_x"]), []
        for lo in range(0, right.num_rows, TOGETHER):
            part = right.slice(lo, TOGETHER)
            d = _distances(_matrix(part["_x"]), x)
            best = np.argsort(d, axis=1, kind="stable")[:, :k]  # ids come in order
            take = pa.array(best.ravel())
            ids = part["_id"].combine_chunks().take(pa.array(np.repeat(np.arange(part.num_rows), best.shape[1])))
            out.append(pa.Table.from_arrays([ids, left["_other"].combine_chunks().take(take), left["_class"].combine_chunks().take(take), pa.array(np.take_along_axis(d, best, 1).ravel())], schema=schema))
        return pa.concat_tables(out)

    return run


def nearest_neighbours(train_rows: DataFrame, rows: DataFrame, features: list[str], class_col: str, k: int = 5, id_col: str = "uid", report: dict | None = None) -> DataFrame:
    """Exact votes of the k nearest training rows (distances in nine digits, ties by id): id, pred1, pred1_prob of every row.

    Training rows lie in the cells of their nearest pivots, which are a bounded sample of them. A row is compared with the cells of its
    nearest pivots until k rows are met, and then with those cells only that may hold a nearer one, by the triangle inequality.
    Cells are cut into chunks, so that no group grows with the table. Null features count as 0. Without training rows the class
    is null. `report` gets the pairs of rows there are, and those that were compared.
    """
    features, spark = sorted(features), rows.sparkSession
    x = F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features))
    sample = train_rows.where(F.col(class_col).isNotNull()).select(F.col(id_col).cast("string").alias("_other"), F.col(class_col).cast("string").alias("_class"), x.alias("_x"))
    n = sample.count()
    wanted = min(MOST_PIVOTS, max(1, int(n**0.5)))
    lot = sample.where(F.pmod(F.xxhash64("_other"), F.lit(1 << 20)) <= int((1 << 20) * min(1.0, 2 * wanted / max(n, 1)))).select("_x").limit(wanted).collect() or sample.select("_x").limit(wanted).collect()  # at most MOST_PIVOTS
    if not lot:
        return rows.select(id_col, F.lit(None).cast("string").alias("pred1"), F.lit(None).cast("double").alias("pred1_prob"))
    pivots = np.unique(np.array([r["_x"] for r in lot], float), axis=0)
    sent = spark.sparkContext.broadcast(pivots)
    placed = sample.mapInArrow(lambda b: _placed(b, sent), "_other string, _class string, _x array<double>, _cell int, _far double")
    sizes = placed.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_far").alias("far")).collect()  # a row for each pivot
    count, far = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
    for r in sizes:
        count[r["_cell"]], far[r["_cell"]] = r["n"], r["far"]
    known = spark.sparkContext.broadcast((pivots, count, far))
    chunks = F.get(F.array(*(F.lit(max(1, -(-int(c) // CHUNK))) for c in count)), F.col("_cell"))
    left = placed.withColumn("_chunk", F.pmod(F.xxhash64("_other"), chunks).cast("int")).groupBy("_cell", "_chunk")
    asking = rows.select(F.col(id_col).cast("string").alias("_id"), x.alias("_x")).distinct()

    def solved(asked: DataFrame) -> DataFrame:
        right = asked.withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).groupBy("_cell", "_chunk")
        return left.cogroup(right).applyInArrow(_nearest_of_chunk(k), "_id string, _other string, _class string, _d double")

    rank = F.row_number().over(Window.partitionBy("_id").orderBy("_d", "_other"))
    schema = "_id string, _x array<double>, _cell int"
    first = asking.mapInArrow(lambda b: _cells_to_ask(b, known, k, True), schema)
    near = solved(first).withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")
    reached = near.groupBy("_id").agg(F.when(F.count("*") >= k, F.max("_d")).alias("_reached"))
    second = asking.join(reached, "_id", "left").select("_id", "_x", "_reached").mapInArrow(lambda b: _cells_to_ask(b, known, k, False), schema)
    if report is not None:
        load = first.unionByName(second).groupBy("_cell").count().collect()  # a row for each pivot
        report |= {"pairs": n * asking.count(), "compared": sum(int(count[r["_cell"]]) * r["count"] for r in load)}
    every = near.unionByName(solved(second)).withColumn("_r", rank).where(F.col("_r") <= k)
    votes = every.groupBy("_id", "_class").agg(F.count("*").alias("_n"))
    best = votes.groupBy("_id").agg(F.min(F.struct(-F.col("_n"), "_class")).alias("_b"), F.sum("_n").alias("_all"))
    best = best.select("_id", F.col("_b._class").alias("pred1"), (-F.col("_b.col1") / F.col("_all")).alias("pred1_prob"))
    return rows.select(id_col).join(best, F.col(id_col).cast("string") == F.col("_id"), "left").drop("_id")


def cross_predict(rows: DataFrame, features: list[str], class_col: str, k: int, fold: str = "fold", id_col: str = "uid", kind: str = "randomforest", **options) -> DataFrame:
    """(uid, pred1, fold): each fold predicted by a model of the others."""
    out = None
    for i in range(k):
        learn, own = split_folds(rows, i, fold)
        one = train(learn, features, class_col, kind, **options).transform(own).select(id_col, "pred1", fold)
        out = one if out is None else out.unionByName(one)
    return out


def best_model(registry: DataFrame, metric: str = "metric") -> str:
    """Path of the saved model with the lowest combined metric."""
    row = registry.orderBy(metric, "path").select("path").first()
    if row is None:
        raise ValueError("no model is saved")
    return row["path"]


def classes_of(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if hasattr(s, "labels")).labels


def _fingerprint(rows: DataFrame, features: list[str], class_col: str, kind: str, options: dict) -> str:
    """What a model is of: its kind, options, feature names and classes."""
    classes = sorted(r[0] for r in rows.where(F.col(class_col).isNotNull()).select(F.col(class_col).cast("string")).distinct().collect())
    return json.dumps({"kind": kind, "options": {k: str(v) for k, v in sorted(options.items())}, "features": sorted(features), "classes": classes}, sort_keys=True)


def fingerprint_at(spark: SparkSession, path: str) -> str | None:
    """The fingerprint saved with the model at a path; None without one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/fingerprint")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.text(f"{path}/fingerprint").first()[0]


def trained(train_rows: DataFrame, features: list[str], class_col: str, path: str, kind: str = "randomforest", force: bool = False, **options) -> PipelineModel:
    """The model saved at `path`, which is trained and saved if it isn't there or `force` is given.

    A saved model of another kind, or with other options, features or classes, is an error, and so is one without a fingerprint.
    """
    spark = train_rows.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    wanted = _fingerprint(train_rows, features, class_col, kind, options)
    if not force and where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        saved = fingerprint_at(spark, path)
        if saved != wanted:
            other = [k for k, v in json.loads(wanted).items() if saved is None or json.loads(saved)[k] != v]
            raise ValueError(f"the model at {path} differs in {', '.join(other)}: use force or another path")
        return PipelineModel.load(path)
    model = train(train_rows, features, class_col, kind, **options)
    model.write().overwrite().save(path)
    spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/fingerprint")
    return model


def train_and_predict(samples: dict[str, DataFrame], matrix: DataFrame, class_col: str, path: str, kind: str = "randomforest", id_col: str = "uid", force: bool = False, **options) -> dict[str, tuple[DataFrame, list[str]]]:
    """Class probabilities of the samples `test` and `all`, by a model of the sample `train`; each sample is joined to the features.

    A sample that isn't given isn't predicted. A second call takes the saved model.
    """
    features = [c for c in matrix.columns if c != id_col]
    model = trained(with_features(samples["train"], matrix, id_col).where(F.col(class_col).isNotNull()), features, class_col, path, kind, force, **options)
    keep = lambda df: [c for c in df.columns if c in (id_col, class_col)]
    return {name: probabilities(model, with_features(df, matrix, id_col), keep(df)) for name, df in samples.items() if name != "train"}
