"""Queries on pixel tables, zonal overlays, small functions, models and sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import cover as CV
from ..operators import models as MO
from ..operators import raster as RA
from ..operators import report as RE
from ..operators import sampling as SA
from ..operators import zonal as ZO
from ..streaming.weekly import weekly, weekly_coverage, weekly_statistics
from .queries import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Events as pixels: an image is a day, the pixel the user, the scene class and the band value follow from type and value.
_P = """p AS (SELECT 0 AS tile, user_id // 50 AS row, user_id % 50 AS col, ts::DATE AS day, ts, value, event_id,
  CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 5 WHEN 'purchase' THEN 9 WHEN 'signup' THEN 6 ELSE 3 END AS scl FROM events)"""


def pixels(spark, sf_dir) -> DataFrame:
    e, t = table(spark, sf_dir, "events"), F.col("event_type")
    scl = F.when(t == "view", 4).when(t == "click", 5).when(t == "purchase", 9).when(t == "signup", 6).otherwise(3)
    return e.select(F.lit(0).alias("tile"), F.floor(F.col("user_id") / 50).alias("row"), (F.col("user_id") % 50).alias("col"), F.col("ts").cast("date").alias("day"), "ts", "value", "event_id", scl.alias("scl"))


@query(f"WITH {_P} SELECT day, round(avg(CASE WHEN scl IN (3, 8, 9, 10) THEN 0.0 ELSE 1.0 END), 9) AS coverage, round(100 * avg(CASE WHEN scl IN (3, 8, 9, 10) THEN 1.0 ELSE 0.0 END), 6) AS cloud_pct, count(*) AS pixels FROM p GROUP BY day")
def cloud_share(spark, sf_dir):
    return RA.cloud_share(pixels(spark, sf_dir), ["day"]).withColumns({"coverage": F.round("coverage", 9), "cloud_pct": F.round("cloud_pct", 6)})


@query(f"WITH {_P} SELECT row, col, " + ", ".join(f"count(*) FILTER (scl = {i}) AS {n}" for i, n in enumerate(RA.SCENES)) + ", count(*) FILTER (scl IN (0, 1, 2, 8, 9, 10, 11)) AS nb_bad_pixels FROM p GROUP BY row, col")
def scene_counts(spark, sf_dir):
    return RA.scene_counts(pixels(spark, sf_dir), ["row", "col"])


_CLEAR = "CASE WHEN scl IN (4, 5, 6) THEN value END"


@query(
    f"""WITH {_P}, m AS (SELECT *, date_trunc('week', day)::DATE AS start_date, {_CLEAR} AS v FROM p)
SELECT row, col, start_date, round(avg(v), 6) AS mean, round(median(v), 6) AS median, min(v) AS min, max(v) AS max, arg_min(v, ts) FILTER (v IS NOT NULL) AS first, arg_max(v, ts) FILTER (v IS NOT NULL) AS last FROM m GROUP BY ALL"""
)
def composites(spark, sf_dir):
    """Clear pixels of a week by all reducers."""
    rows = RA.masked(pixels(spark, sf_dir), ["value"]).withColumn("start_date", F.date_trunc("week", "day").cast("date"))
    out = RA.composite(rows, ["tile", "row", "col", "start_date"], ["value"], list(RA.REDUCERS)).withColumnsRenamed({f"value_{r}": r for r in RA.REDUCERS})
    return out.drop("tile").withColumns({"mean": F.round("mean", 6), "median": F.round("median", 6)})


_BLOCK = "FROM p a JOIN p b ON b.day = a.day AND b.row BETWEEN a.row - {h} AND a.row + {h} AND b.col BETWEEN a.col - {h} AND a.col + {h}"
_GAUSS = "exp(-0.5 * ({d} * {d}))"
_MASS = "(SELECT sum(exp(-0.5 * i * i)) FROM range(-5, 6) t(i))"
_DTC = f"dtc AS (SELECT a.event_id, 1 - sum(CASE WHEN b.scl IN (3, 8, 9, 10) THEN {_GAUSS.format(d='(b.row - a.row)')} * {_GAUSS.format(d='(b.col - a.col)')} ELSE 0 END) / ({_MASS} * {_MASS}) AS dtc {_BLOCK.format(h=5)} GROUP BY a.event_id)"


@query(f"WITH {_P} SELECT a.event_id, a.row, a.col, a.day, bool_or(b.scl IN (3, 8, 9, 10)) AS near_cloud {_BLOCK.format(h=2)} GROUP BY ALL")
def near_clouds(spark, sf_dir):
    """Pixels of a day's image with a cloud within two pixels."""
    rows = pixels(spark, sf_dir).drop("tile").withColumn("tile", F.col("day"))  # an image is a day
    return RA.dilated_cloud(rows, 2).select("event_id", "row", "col", F.col("tile").alias("day"), "near_cloud")


@query(f"WITH {_P}, {_DTC} SELECT event_id, round(dtc, 9) AS dtc FROM dtc")
def cloud_distance(spark, sf_dir):
    """1 minus the smoothed cloud flag of a day's image."""
    return RA.distance_score(pixels(spark, sf_dir), image="day").select("event_id", F.round("dtc", 9).alias("dtc"))


@query(
    f"""WITH {_P}, {_DTC}, c AS (SELECT day, avg(CASE WHEN scl IN (3, 8, 9, 10) THEN 0.0 ELSE 1.0 END) AS coverage FROM p GROUP BY day),
s AS (SELECT p.*, round((round(dtc, 9) + 0.8 * exp(-0.5 * pow((dayofmonth(p.day) - 15) * 0.2, 2)) * 0.07978845 + 0.5 * coverage) / 2.3, 9) AS score FROM p JOIN c USING (day) JOIN dtc USING (event_id) WHERE scl NOT IN (0, 3, 8, 9, 10)),
r AS (SELECT *, row_number() OVER (PARTITION BY row, col, date_trunc('month', day) ORDER BY score DESC, day, event_id) AS r FROM s)
SELECT row, col, date_trunc('month', day)::DATE AS month, day, score, value FROM r WHERE r = 1"""
)
def best_pixels(spark, sf_dir):
    """Best available pixel of a month by cloud distance, date and coverage."""
    rows = RA.distance_score(pixels(spark, sf_dir), image="day").withColumn("dtc", F.round("dtc", 9))
    return RA.best_pixels(rows, ["value"], image="day", tie="event_id").drop("tile")


@query(f"WITH {_P}, g AS (SELECT day FROM p GROUP BY day HAVING 100 * avg(CASE WHEN scl IN (3, 8, 9, 10) THEN 1.0 ELSE 0.0 END) <= 40) SELECT event_id, day FROM p WHERE day IN (SELECT day FROM g)")
def clear_images(spark, sf_dir):
    """Pixels of images with few clouds."""
    return RA.without_cloudy_images(pixels(spark, sf_dir), ["day"], 40.0).select("event_id", "day")


# Vectors as an image: row = vector, column = position.
_IMG = "img AS (SELECT vec_id AS row, pos AS col, x::DOUBLE AS value FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings))"


def image(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "value"))
    return e.select(F.lit(0).alias("tile"), "row", F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))


_NEAR = "FROM img a JOIN (SELECT unnest([-1, 0, 1]) AS dr) x ON true JOIN (SELECT unnest([-1, 0, 1]) AS dc) y ON true JOIN {src} b ON b.row = a.row + dr AND b.col = a.col + dc"


@query(f"WITH {_IMG} SELECT a.row, a.col, round(avg(b.value), 6) AS focal_mean {_NEAR.format(src='img')} GROUP BY a.row, a.col")
def focal_mean(spark, sf_dir):
    return RA.focal_mean(image(spark, sf_dir), 3).select("row", "col", F.round("focal_mean", 6).alias("focal_mean"))


@query(
    f"""WITH {_IMG}, m AS (SELECT a.row, a.col, any_value(a.value) AS value, avg(b.value) FILTER (dr <> 0 OR dc <> 0) AS mean {_NEAR.format(src='img')} GROUP BY a.row, a.col), q AS (SELECT *, pow(value - mean, 2) AS sq FROM m),
v AS (SELECT a.row, a.col, avg(b.sq) FILTER (dr <> 0 OR dc <> 0) AS var {_NEAR.format(src='q')} GROUP BY a.row, a.col), c AS (SELECT q.*, sqrt(var) / nullif(mean, 0) AS ci, sqrt(0.1) AS cu, sqrt(21) AS cm FROM q JOIN v USING (row, col))
SELECT row, col, round(CASE WHEN ci IS NULL OR ci <= cu THEN mean WHEN ci >= cm THEN value ELSE mean * exp(-10 * (ci - cu) / (cm - ci)) + value * (1 - exp(-10 * (ci - cu) / (cm - ci))) END, 6) AS filtered FROM c"""
)
def lee_filter(spark, sf_dir):
    return RA.lee_enhanced(image(spark, sf_dir), 3).select("row", "col", F.round("filtered", 6).alias("filtered"))


# Quadrilaterals around customers on a grid of parts.
_POLY = """pts AS (SELECT c_custkey::VARCHAR AS uid, c_custkey % 40 + 5.3 AS cx, (c_custkey * 7) % 30 + 5.7 AS cy FROM customer),
edge AS (SELECT uid, cx - 3.1 AS px, cy - 2.2 AS py, cx + 2.7 AS qx, cy - 3.4 AS qy FROM pts UNION ALL SELECT uid, cx + 2.7, cy - 3.4, cx + 3.9, cy + 2.6 FROM pts UNION ALL SELECT uid, cx + 3.9, cy + 2.6, cx - 1.8, cy + 3.3 FROM pts UNION ALL SELECT uid, cx - 1.8, cy + 3.3, cx - 3.1, cy - 2.2 FROM pts),
grid AS (SELECT p_partkey // 50 AS row, p_partkey % 50 AS col, p_size AS value FROM part),
hit AS (SELECT uid, g.row, g.col, any_value(g.value) AS value FROM grid g JOIN edge ON (py <= g.row + 0.5) <> (qy <= g.row + 0.5) AND g.col + 0.5 >= px + (g.row + 0.5 - py) / (qy - py) * (qx - px) GROUP BY uid, g.row, g.col HAVING count(*) % 2 = 1)"""


def polygons(spark, sf_dir, low: bool = False) -> DataFrame:
    """Quadrilaterals; `low` ones lie on the first rows of an image."""
    key = F.col("c_custkey")
    cx, cy = key % 40 + 5.3, key % 3 + 0.7 if low else key * 7 % 30 + 5.7
    ring = F.array(*(F.struct((cx + a).alias("x"), (cy + b).alias("y")) for a, b in ((-3.1, -2.2), (2.7, -3.4), (3.9, 2.6), (-1.8, 3.3))))
    return table(spark, sf_dir, "customer").select(key.cast("string").alias("uid"), F.array(ring).alias("geom"))


def grid(spark, sf_dir) -> DataFrame:
    """An image 50 pixels wide that the parts fill row by row."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(F.lit("img").alias("image_profile"), F.floor(key / 50).alias("row"), (key % 50).alias("col"), F.col("p_size").cast("double").alias("value"))


@query(f"WITH {_POLY} SELECT uid, count(value) AS count, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value)::DOUBLE AS min, max(value)::DOUBLE AS max, sum(value)::DOUBLE AS sum FROM hit GROUP BY uid")
def zonal_polygons(spark, sf_dir):
    out = ZO.zonal_stats(grid(spark, sf_dir), polygons(spark, sf_dir), ["image_profile"])
    return out.select("uid", "count", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "min", "max", "sum")


@query(
    f"""WITH {_POLY}, d AS (SELECT h.uid, h.row, h.col, h.value, e.*, least(greatest(((col + 0.5 - px) * (qx - px) + (row + 0.5 - py) * (qy - py)) / ((qx - px) * (qx - px) + (qy - py) * (qy - py)), 0), 1) AS t FROM hit h JOIN edge e ON e.uid = h.uid),
m AS (SELECT uid, row, col, any_value(value) AS value, min(sqrt(pow(col + 0.5 - px - t * (qx - px), 2) + pow(row + 0.5 - py - t * (qy - py), 2))) AS dist FROM d GROUP BY uid, row, col)
SELECT uid, count(*) AS count, round(avg(value), 6) AS mean FROM m WHERE dist >= 1.01 GROUP BY uid"""
)
def zonal_eroded(spark, sf_dir):
    out = ZO.zonal_stats(grid(spark, sf_dir), polygons(spark, sf_dir), ["image_profile"], buffer=1.01)
    return out.select("uid", "count", F.round("mean", 6).alias("mean"))


def hits(k: int) -> str:
    """SQL of (uid, row, col): cells of 1/k whose centre is inside, by even-odd counts over each polygon's box."""
    return f"""box AS (SELECT uid, floor(min(px) * {k})::BIGINT AS c0, ceil(max(px) * {k})::BIGINT AS c1, floor(min(py) * {k})::BIGINT AS r0, ceil(max(py) * {k})::BIGINT AS r1 FROM edge GROUP BY uid),
cell AS (SELECT uid, row, unnest(range(c0, c1 + 1)) AS col FROM (SELECT *, unnest(range(r0, r1 + 1)) AS row FROM box)),
inside AS (SELECT c.uid, c.row, c.col FROM cell c JOIN edge e ON e.uid = c.uid AND (py <= (c.row + 0.5) / {k}) <> (qy <= (c.row + 0.5) / {k}) AND (c.col + 0.5) / {k} >= px + ((c.row + 0.5) / {k} - py) / (qy - py) * (qx - px) GROUP BY ALL HAVING count(*) % 2 = 1)"""


@query(f"WITH {_POLY}, {hits(2)} SELECT uid, count(*) / 4.0 AS count, round(avg(value), 6) AS mean FROM inside i JOIN grid g ON g.row = i.row // 2 AND g.col = i.col // 2 GROUP BY uid")
def zonal_half_pixels(spark, sf_dir):
    """Statistics over half pixels, counted in quarters."""
    out = ZO.zonal_stats(grid(spark, sf_dir), polygons(spark, sf_dir), ["image_profile"], rule="centre_2x")
    return out.select("uid", F.col("count").cast("double").alias("count"), F.round("mean", 6).alias("mean"))


_GONE = "CASE WHEN {u} <= 0 THEN 0 WHEN {u} < 1 THEN {u} * {u} / 2 ELSE {u} - 0.5 END"
#: SQL of (uid, row, col, fraction): for each cell of a polygon's box and each edge the mean width right of the edge, by its height.
_FRACTION = f"""box AS (SELECT uid, floor(min(px))::BIGINT AS c0, ceil(max(px))::BIGINT AS c1, floor(min(py))::BIGINT AS r0, ceil(max(py))::BIGINT AS r1 FROM edge GROUP BY uid),
cell AS (SELECT uid, row, unnest(range(c0, c1 + 1)) AS col FROM (SELECT *, unnest(range(r0, r1 + 1)) AS row FROM box)),
part AS (SELECT c.uid, c.row, c.col, px, py, qx, qy, greatest(least(py, qy), c.row) AS y0, least(greatest(py, qy), c.row + 1) AS y1 FROM cell c JOIN edge e ON e.uid = c.uid AND least(py, qy) < c.row + 1 AND greatest(py, qy) > c.row),
side AS (SELECT *, col + 1 - (px + (y0 - py) / (qy - py) * (qx - px)) AS u, col + 1 - (px + (y1 - py) / (qy - py) * (qx - px)) AS v FROM part),
fraction AS (SELECT uid, row, col, sum(CASE WHEN qy > py THEN -1 ELSE 1 END * (y1 - y0) * CASE WHEN abs(u - v) < 1e-9 THEN least(greatest((u + v) / 2, 0), 1) ELSE ({_GONE.format(u="u")} - ({_GONE.format(u="v")})) / (u - v) END) AS fraction FROM side GROUP BY ALL)"""


@query(f"WITH {_POLY}, {_FRACTION} SELECT uid, row, col, round(fraction, 6) AS fraction FROM fraction WHERE fraction > 1e-9")
def coverage_fractions(spark, sf_dir):
    """The exact share of each pixel that a polygon covers."""
    return ZO.coverage_fractions(polygons(spark, sf_dir)).select("uid", "row", "col", F.round("fraction", 6).alias("fraction"))


@query(f"WITH {_POLY}, {_FRACTION} SELECT uid, count(*) AS count, round(avg(value), 6) AS mean FROM fraction JOIN grid USING (row, col) WHERE fraction >= 0.5 - 1e-9 GROUP BY uid")
def zonal_coverage(spark, sf_dir):
    """Statistics over pixels that are covered by half."""
    out = ZO.zonal_stats(grid(spark, sf_dir), polygons(spark, sf_dir), ["image_profile"], rule="coverage")
    return out.select("uid", "count", F.round("mean", 6).alias("mean"))


@query(f"WITH {_POLY}, b AS (SELECT uid, min(px) AS minx, min(py) AS miny, max(px) AS maxx, max(py) AS maxy FROM edge GROUP BY uid) SELECT uid, round(minx, 6) AS minx, round(miny, 6) AS miny, round(maxx, 6) AS maxx, round(maxy, 6) AS maxy FROM b WHERE minx <= 20 AND maxx >= 10 AND miny <= 20 AND maxy >= 10")
def bbox_filter(spark, sf_dir):
    out = ZO.in_box(ZO.bounds(polygons(spark, sf_dir)), (10, 10, 20, 20))
    return out.select("uid", *(F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")))


@query("SELECT c_custkey, CASE floor((c_nationkey * 10000 + c_custkey % 10000) / 10000) * 10000 WHEN 10000 THEN 'A' WHEN 20000 THEN 'B' WHEN 30000 THEN 'C' END AS province FROM customer")
def provinces(spark, sf_dir):
    code = (F.col("c_nationkey") * 10000 + F.col("c_custkey") % 10000).cast("long")
    return table(spark, sf_dir, "customer").select("c_custkey", V.province(code, {10000: "A", 20000: "B", 30000: "C"}).alias("province"))


_PREM = "CASE o_orderpriority WHEN '1-URGENT' THEN 'BMG;X' WHEN '2-HIGH' THEN 'EEB' WHEN '3-MEDIUM' THEN 'TBG' WHEN '5-LOW' THEN 'MEV' END"
_PARCELS = f"o AS (SELECT o_orderkey, {_PREM} AS all_best, CASE o_orderstatus WHEN 'F' THEN '201' WHEN 'O' THEN '202' ELSE '60' END AS cropcode, CASE WHEN o_custkey % 2 = 0 THEN '83' END AS earlycrop FROM orders)"


@query(f"WITH {_PARCELS} SELECT 'ONBEDEKT_NA_ZOMER' AS marker, o_orderkey FROM o WHERE regexp_matches(coalesce(all_best, ''), 'BMG|MEV|MEG|EEF|TBG|EBG') UNION ALL SELECT 'COVER_EEB_VOORJAAR', o_orderkey FROM o WHERE all_best LIKE '%EEB%' AND earlycrop = '83' AND cropcode IN ('201', '202') UNION ALL SELECT 'COVER_TBG_BMG_NAJAAR', o_orderkey FROM o WHERE regexp_matches(coalesce(all_best, ''), 'TBG|BMG')")
def premium_parcels(spark, sf_dir):
    p = F.col("o_orderpriority")
    premium = F.when(p == "1-URGENT", "BMG;X").when(p == "2-HIGH", "EEB").when(p == "3-MEDIUM", "TBG").when(p == "5-LOW", "MEV")
    crop = F.when(F.col("o_orderstatus") == "F", "201").when(F.col("o_orderstatus") == "O", "202").otherwise("60")
    o = table(spark, sf_dir, "orders").select("o_orderkey", premium.alias("all_best"), crop.alias("cropcode"), F.when(F.col("o_custkey") % 2 == 0, "83").alias("earlycrop"))
    out = None
    for marker in ("ONBEDEKT_NA_ZOMER", "COVER_EEB_VOORJAAR", "COVER_TBG_BMG_NAJAAR"):
        one = CV.premium_parcels(o, marker).select(F.lit(marker).alias("marker"), "o_orderkey")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT doc_id, n_chars, CASE WHEN n_chars < 0 THEN NULL " + " ".join(f"WHEN n_chars <= {hi} THEN '{x}'" for x, hi in zip(V.bin_labels(), V.EDGES[1:], strict=True)) + " END AS bin FROM documents")
def size_bins(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars", V.binned(F.col("n_chars")).alias("bin"))


@query("SELECT p.p_partkey AS uid, t.uid IS NOT NULL AS used_for_train FROM part p LEFT JOIN (SELECT DISTINCT l_partkey AS uid FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) t ON t.uid = p.p_partkey")
def training_flags(spark, sf_dir):
    train = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("uid"))
    return RE.with_training_flag(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid")), train)


@query("SELECT p_partkey AS uid, p_brand AS classname FROM part WHERE p_size >= 10 AND p_brand NOT IN ('Brand#1', 'Brand#2')")
def training_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), F.col("p_brand").alias("classname"), F.col("p_size").alias("pixcount"))
    return SA.training_candidates(rows, 10, ["Brand#1"], ["Brand#2"]).select("uid", "classname")


@query("SELECT date_trunc('week', ts)::DATE AS start_date, date_trunc('week', ts)::DATE + 7 AS end_date, event_type, count(value) AS count, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY ALL")
def weekly_windows(spark, sf_dir):
    """The batch twin of the weekly stream."""
    return weekly(table(spark, sf_dir, "events"), ["event_type"]).withColumn("mean", F.round("mean", 6))


def labelled_vectors(spark, sf_dir, n: int = 64) -> tuple[DataFrame, list[str]]:
    """Labelled vectors with all their components as features, in two folds."""
    names = [f"x{i:02d}" for i in range(n)]
    e = table(spark, sf_dir, "embeddings").where("label is not null")
    rows = e.select(F.col("vec_id").alias("uid"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("classname"), *(F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)))
    return SA.fold_ids(rows, 2, "classname"), names


def _predicted(spark, sf_dir, kind: str, **options) -> DataFrame:
    rows, names = labelled_vectors(spark, sf_dir)
    model = MO.train(rows.where("fold = 0"), names, "classname", kind, **options)
    return MO.probabilities(model, rows, ["uid", "classname"])[0]


@query()
def model_random_forest(spark, sf_dir):
    return _predicted(spark, sf_dir, "randomforest", numTrees=10, maxDepth=4)


@query()
def model_gradient_boosting(spark, sf_dir):
    return _predicted(spark, sf_dir, "gradientboosting")


@query()
def model_perceptron(spark, sf_dir):
    return _predicted(spark, sf_dir, "multilayer_perceptron", maxIter=10)


@query()
def model_svm(spark, sf_dir):
    return _predicted(spark, sf_dir, "svm")


@query(
    """WITH f AS (SELECT vec_id::VARCHAR AS uid, 'L' || label AS classname, embedding::DOUBLE[] AS x, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) % 2 AS fold FROM embeddings WHERE label IS NOT NULL),
d AS (SELECT a.uid, b.classname, row_number() OVER (PARTITION BY a.uid ORDER BY round(sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda p: pow(p[1] - p[2], 2)))), 9), b.uid) AS r FROM f a JOIN f b ON a.fold = 1 AND b.fold = 0),
v AS (SELECT uid, classname, count(*) AS n FROM d WHERE r <= 5 GROUP BY ALL)
SELECT uid::BIGINT AS uid, arg_max(classname, n * 1000 - ascii(right(classname, 1))) AS pred1, max(n) / 5.0 AS pred1_prob FROM v GROUP BY uid"""
)
def model_neighbours(spark, sf_dir):
    rows, names = labelled_vectors(spark, sf_dir)
    return MO.nearest_neighbours(rows.where("fold = 0"), rows.where("fold = 1"), names, "classname")


@query()
def model_cross_prediction(spark, sf_dir):
    rows, names = labelled_vectors(spark, sf_dir)
    return MO.cross_predict(rows, names, "classname", 2, numTrees=5, maxDepth=3)


_WSTAT = """o AS (SELECT user_id, event_type, value, date_trunc('week', ts)::DATE AS start_date FROM events),
c AS (SELECT user_id, event_type, start_date, value, count(*) AS n FROM o WHERE value IS NOT NULL GROUP BY ALL),
m AS (SELECT user_id, event_type, start_date, arg_max(value, n * 1e9 - value) AS majority, arg_min(value, n * 1e9 + value) AS minority FROM c GROUP BY ALL)"""


@query(
    f"""WITH {_WSTAT} SELECT o.user_id, o.event_type, start_date, count(value) AS count, round(sum(value), 4) AS sum, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max,
round(max(value) - min(value), 6) AS range, any_value(majority) AS majority, any_value(minority) AS minority FROM o LEFT JOIN m USING (user_id, event_type, start_date) GROUP BY ALL"""
)
def weekly_all_statistics(spark, sf_dir):
    """The batch twin of the stream of all zonal statistics."""
    out = weekly_statistics(table(spark, sf_dir, "events"), ["user_id", "event_type"])
    out = out.withColumns({c: F.round(c, 4 if c == "sum" else 6) for c in ("sum", "mean", "median", "std", "range")})
    return out.withColumn("start_date", F.col("week.start").cast("date")).drop("week", "variance")


@query("WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events), o AS (SELECT user_id, event_type, date_trunc('week', ts)::DATE AS start_date, count(value) AS k FROM events GROUP BY ALL) SELECT event_type, start_date, count(*) AS rows, count(*) FILTER (k = 0) AS nulls, round(100.0 * count(*) / any_value(n), 6) AS row_pct, round(100.0 * (1 - count(*) FILTER (k = 0) / any_value(n)), 6) AS value_pct FROM o, n GROUP BY ALL")
def weekly_slice_coverage(spark, sf_dir):
    """Coverage of the weekly slices, by the stream's operators."""
    events = table(spark, sf_dir, "events")
    out = weekly_coverage(weekly_statistics(events, ["user_id", "event_type"]), events.select("user_id").distinct().count(), ["event_type"])
    return out.select("event_type", F.col("week.start").cast("date").alias("start_date"), "rows", "nulls", F.round("row_pct", 6).alias("row_pct"), F.round("value_pct", 6).alias("value_pct"))
