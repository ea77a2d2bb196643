"""Queries on single operators: scans and names, filters, samples, images, zones, functions, checks and models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import dates as D
from ..functions import values as V
from ..operators import consolidate as CO
from ..operators import cover as CV
from ..operators import features as FE
from ..operators import labels as LA
from ..operators import models as MO
from ..operators import raster as RA
from ..operators import report as RE
from ..operators import sampling as SA
from ..operators import zonal as ZO
from ..sources import tables as TA
from . import queries as Q
from . import queries_more as QM
from . import queries_verdict as QV
from .queries import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return add


# ---------------------------------------------------------------- tables, file names

_TABLES = ("events", "lineitem", "orders", "part", "customer")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, (SELECT string_agg(column_name, ',' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = '{t}') AS columns FROM {t}" for t in _TABLES))
def table_info(spark, sf_dir):
    """Rows and columns of tables."""
    out = None
    for t in _TABLES:
        one = TA.table_summary(table(spark, sf_dir, t)).select(F.lit(t).alias("name"), "rows", F.array_join("columns", ",").alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


_PATHS = f"{Q._E}, d AS (SELECT DISTINCT image_profile, start_date, end_incl, band FROM e)"
_FILE = "'/data/' || image_profile || '/' || image_profile || '_' || start_date || '_' || end_incl || '_' || band || '_mean.parquet'"


def slice_keys(spark, sf_dir) -> DataFrame:
    return Q.observations(spark, sf_dir).select("image_profile", "start_date", "end_incl", "band").distinct()


@query(f"WITH {_PATHS} SELECT {_FILE} AS path, image_profile, start_date, end_incl, band, 'mean' AS time_reducer, CASE WHEN image_profile LIKE '%-asc%' THEN 'asc' END AS orbit FROM d")
def slice_metadata(spark, sf_dir):
    """What the names of slice files say."""
    d = slice_keys(spark, sf_dir)
    name = V.slice_name(F.col("image_profile"), F.col("start_date"), F.col("end_incl"), F.array("band"), F.lit("mean"))
    path = F.concat(F.lit("/data/"), F.col("image_profile"), F.lit("/"), name, F.lit(".parquet"))
    return d.select(path.alias("path")).withColumns(FE.from_path(F.col("path")))


@query(f"WITH {_PATHS} SELECT DISTINCT '/data/roi_' || strftime(start_date, '%W')::INT || '_' || start_date || '_' || image_profile || '.tif' AS path, image_profile, strftime(start_date, '%W')::INT AS week, start_date, start_date + 6 AS end_incl FROM d")
def weekly_file_metadata(spark, sf_dir):
    """What names of the older kind say."""
    d = slice_keys(spark, sf_dir)
    path = F.concat(F.lit("/data/roi_"), D.week_number(F.col("start_date")).cast("string"), F.lit("_"), F.col("start_date").cast("string"), F.lit("_"), F.col("image_profile"), F.lit(".tif"))
    return d.select(path.alias("path")).distinct().withColumns(FE.from_weekly_path(F.col("path")))


@query(f"WITH {_PATHS}, w AS (SELECT image_profile, start_date, end_incl, string_agg(replace(replace(band, '_', ''), '-', ''), '-' ORDER BY band) AS bands FROM d GROUP BY ALL) SELECT image_profile || '_' || start_date || '_' || end_incl || '_' || bands || '_median' AS slice FROM w")
def slice_names(spark, sf_dir):
    """Names of slices with all their bands."""
    d = slice_keys(spark, sf_dir).groupBy("image_profile", "start_date", "end_incl").agg(F.sort_array(F.collect_set("band")).alias("bands"))
    return d.select(V.slice_name(F.col("image_profile"), F.col("start_date"), F.col("end_incl"), F.col("bands"), F.lit("median")).alias("slice"))


@query(f"WITH {Q._E}, s AS (SELECT uid, image_profile, start_date, band, round(avg(value), 6) AS a_mean, count(value) AS a_count, max(value) AS mean FROM e GROUP BY ALL) SELECT uid, a_mean, mean FROM s")
def stat_columns(spark, sf_dir):
    """The id and the columns of one statistic."""
    s = Q.observations(spark, sf_dir).groupBy("uid", "image_profile", "start_date", "band").agg(F.round(F.avg("value"), 6).alias("a_mean"), F.count("value").alias("a_count"), F.max("value").alias("mean"))
    return s.select(*FE.stat_columns(s.columns, ["mean"]))


@query(f"{Q._WIDE}, f AS (SELECT * FROM matrix WHERE uid = (SELECT min(uid) FROM e)) SELECT uid, feature, value FROM (UNPIVOT f ON " + ", ".join(f'"{c}"' for c in Q.FEATURES) + " INTO NAME feature VALUE value)")
def one_parcel(spark, sf_dir):
    """The time series of the first parcel."""
    first = Q.observations(spark, sf_dir).agg(F.min("uid")).first()[0]
    return FE.one_parcel(Q.matrix(spark, sf_dir), first)


@query(f"{Q._WIDE} SELECT uid, greatest(" + ", ".join(f'"{c}"' for c in Q.FEATURES) + ") AS highest FROM matrix ORDER BY highest DESC, uid LIMIT 1000")
def largest_features(spark, sf_dir):
    return FE.largest(Q.matrix(spark, sf_dir), Q.FEATURES)


# ---------------------------------------------------------------- filters and samples

_P6 = "p AS (SELECT p_partkey::VARCHAR AS uid, p_brand AS classname, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 'IGN' ELSE p_type END AS classname_declared, p_size AS pixcount FROM part)"


def sample_parcels(spark, sf_dir) -> DataFrame:
    size = F.col("p_size")
    declared = F.when(size % 5 == 0, F.lit(None).cast("string")).when(size % 7 == 0, "IGN").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_brand").alias("classname"), declared.alias("classname_declared"), size.alias("pixcount"))


@query(f"WITH {_P6} SELECT uid, classname_declared FROM p WHERE coalesce(classname_declared <> 'IGN', true)")
def predictable_parcels(spark, sf_dir):
    return SA.predictable(sample_parcels(spark, sf_dir), ["IGN"]).select("uid", "classname_declared")


@query(f"WITH {_P6} SELECT classname, count(*) AS n FROM p GROUP BY classname")
def class_counts(spark, sf_dir):
    return SA.class_counts(sample_parcels(spark, sf_dir), "classname")


@query(f"WITH {_P6} SELECT uid, classname_declared, coalesce(classname_declared IN ('SMALL', 'PROMO'), false) AS aside FROM p")
def unimportant_parcels(spark, sf_dir):
    """Parcels that are reported, and those set aside."""
    kept, aside = RE.split_unimportant(sample_parcels(spark, sf_dir), ["SMALL", "PROMO"])
    return kept.withColumn("aside", F.lit(False)).unionByName(aside.withColumn("aside", F.lit(True))).select("uid", "classname_declared", "aside")


@query(f"WITH {_P6}, f AS (SELECT uid, (row_number() OVER (PARTITION BY classname ORDER BY uid) - 1) % 3 AS fold FROM p) SELECT uid, fold::INT AS fold, m::INT AS model, fold = m AS predicted FROM f, unnest([0, 1, 2]) t(m)")
def fold_roles(spark, sf_dir):
    """For each fold's model the rows it learns from, and those it predicts."""
    rows, out = SA.fold_ids(sample_parcels(spark, sf_dir), 3, "classname").select("uid", "fold"), None
    for i in range(3):
        learn, own = SA.split_folds(rows, i)
        one = learn.withColumn("predicted", F.lit(False)).unionByName(own.withColumn("predicted", F.lit(True))).withColumn("model", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {_P6} SELECT uid FROM p WHERE pixcount > 20 AND classname IN ('Brand#3', 'Brand#7')")
def training_expression(spark, sf_dir):
    """A sample chosen by a condition given as text."""
    return sample_parcels(spark, sf_dir).where(F.expr("pixcount > 20 and classname in ('Brand#3', 'Brand#7')")).select("uid")


@query(f"{Q._WIDE}, s AS (SELECT user_id::VARCHAR AS uid, count(*) AS classname FROM events WHERE event_type <> 'error' GROUP BY 1 HAVING count(*) % 2 = 0) SELECT s.uid, s.classname, " + ", ".join(f'"{c}"' for c in Q.FEATURES[:4]) + " FROM s JOIN matrix USING (uid)")
def sample_features(spark, sf_dir):
    """A sample joined to its features."""
    s = table(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(F.col("user_id").cast("string").alias("uid")).agg(F.count("*").alias("classname")).where("classname % 2 = 0")
    return FE.with_features(s, Q.matrix(spark, sf_dir)).select("uid", "classname", *Q.FEATURES[:4])


# ---------------------------------------------------------------- labels

_WHITE = "SELECT uid, cropcode, replace(prod_method, ',', ';') AS prod_method FROM parts"


@query(f"WITH {Q._PARTS} {_WHITE}")
def whitelisted_columns(spark, sf_dir):
    rows, _ = Q.parts(spark, sf_dir)
    return LA.whitelisted(LA.tidy(rows, LA.Fields()), classes=("classname",), export=("cropcode", "no_such_column"), domain=("prod_method", "uid"))


_SIMPLE = {"CROPGROUP": ("MON_CG", "cls IS NULL", "UNKNOWN"), "CROPROTATION": ("MON_VRU", "cls IS NULL", "UNKNOWN"), "CARBONSUPPLY": ("MON_OC", "cls IS NULL", "UNKNOWN"), "FABACEAE": ("MON", "cls IS NULL", "UNKNOWN"),
    "LANDCOVER": ("MON_LC", Q._NVT, "MON_LC_ONBEKEND_MET_KLASSIFICATIE"), "MULTICROP": ("MON_LC", Q._NVT, "MON_LC_ONBEKEND_MET_KLASSIFICATIE"), "RUGGENTEELT": ("MON_RUG", Q._NVT, "MON_RUG_ONBEKEND_MET_KLASSIFICATIE")}
_CROPS = "['60', '700', '660', '732', '723', '9', '8']"


def _all_types_sql() -> str:
    parts = []
    for marker, (prefix, absent, missing) in _SIMPLE.items():
        for early in (False, True):
            for truth in (False, True):
                least = 60 if not truth or marker in ("CROPROTATION", "CARBONSUPPLY") else None
                where = "cropcode IN ('60', '700', '660', '732', '723')" if marker == "FABACEAE" else "true"
                one = Q._label_sql(f"{prefix}_OVERK_LOO", f"{prefix}_CONTAINERS", absent, missing, least, early, where)
                one = one.replace("p_size::VARCHAR AS cropcode, CASE WHEN p_brand", f"{_CROPS}[p_size % 7 + 1] AS cropcode, CASE WHEN p_brand")
                one = one.replace("lut AS (SELECT DISTINCT p_size::VARCHAR AS cropcode,", f"lut AS (SELECT DISTINCT {_CROPS}[p_size % 7 + 1] AS cropcode,").replace("CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 9 = 0 THEN 'nvt_x' WHEN p_size >= 48 THEN 'MON_SMALL' ELSE 'MON_CLASS_' || (p_size % 7) END AS cls", "[NULL, 'nvt_x', 'MON_A', 'MON_B', 'MON_C', 'MON_D', 'MON_E'][p_size % 7 + 1] AS cls")
                name = f"{marker}{'-EARLY' if early else ''}{'-GROUNDTRUTH' if truth else ''}"
                parts.append(f"SELECT '{name}' AS classtype, * FROM ({one})")
    return " UNION ALL ".join(parts)


@query(_all_types_sql())
def labels_all_types(spark, sf_dir):
    """Every marker's labels, plain, early and ground truth."""
    rows, _ = Q.parts(spark, sf_dir)
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("uid"), (F.col("p_size") % 7).alias("k"))
    crop = F.get(F.array(*map(F.lit, ("60", "700", "660", "732", "723", "9", "8"))), F.col("k"))
    rows = rows.drop("cropcode").join(size, "uid").withColumn("cropcode", crop)
    cls = F.get(F.array(F.lit(None).cast("string"), *map(F.lit, ("nvt_x", "MON_A", "MON_B", "MON_C", "MON_D", "MON_E"))), F.col("k"))
    lut = size.select(crop.alias("cropcode"), cls.alias("cls")).distinct()
    out = None
    for kind in LA.CLASS_TYPES:
        if not kind.startswith("LATECROP"):
            one = LA.prepare(rows, lut, kind, 60, "cls").select(F.lit(kind).alias("classtype"), "uid", "prod_method", "classname", "classname_declared")
            out = one if out is None else out.unionByName(one)
    return out


@query(Q._LATE + "k AS (SELECT *, coalesce(a2, 'UNKNOWN') AS x FROM (SELECT j.*, c.cls AS a2 FROM j LEFT JOIN lut c ON c.cropcode = latecrop)), l AS (SELECT *, CASE WHEN x = 'UNKNOWN' AND prod_method = 'SER' THEN 'MON_CG_OVERK_LOO' WHEN x = 'UNKNOWN' AND permanent = 1 AND coalesce(grass, 0) <> 1 THEN 'IGNORE:PERMANENT_BEDEKKING' ELSE x END AS y FROM k), s AS (SELECT uid, y AS classname, coalesce(TRY_CAST(regexp_extract(y, '[^_]*$') AS DOUBLE), 0) AS v FROM l) SELECT uid, classname, round(v / (SELECT max(v) FROM s), 9) AS correction FROM s")
def labels_latecrop_truth_scores(spark, sf_dir):
    """Late crops as ground truth, with the scores at the end of their names."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    rows = p.select(
        F.col("p_partkey").cast("string").alias("uid"), F.when(size % 3 == 0, "201").when(size % 5 == 0, "71").otherwise(size.cast("string")).alias("cropcode"),
        F.when(F.col("p_partkey") % 4 != 0, ((size + 7) % 50 + 1).cast("string")).alias("latecrop"), ((size + 13) % 50 + 1).cast("string").alias("latecrop2"), F.when(F.col("p_brand") == "Brand#1", "SER").alias("prod_method"),
    )
    lut = p.select("p_size").distinct().select(size.cast("string").alias("cropcode"), F.when(size % 10 != 0, F.concat(F.lit("MON_CLASS_"), (size % 7).cast("string"))).alias("cls"), (size % 2).alias("permanent"), (size % 4 == 1).cast("int").alias("grass"))
    out = LA.late_labels(rows, LA.checked_lookup(lut, "cropcode"), "ALL", 40, "cls", ground_truth=True, score="classname")
    return out.select("uid", "classname", F.round("correction", 9).alias("correction"))


# ---------------------------------------------------------------- verdicts

_MARKED = f"""{QV._V}, b AS (SELECT uid, CASE WHEN uid::BIGINT % 4 = 0 THEN '9534' ELSE '60' END AS crop, classname_declared, pixcount, CASE WHEN pred1 = 'C2' THEN 'MON_LC_FABACEAE' ELSE pred1 END AS pred1, pred1_prob, pred2_prob FROM t)
SELECT uid, CASE WHEN classname_declared = 'UNKNOWN' THEN 'IGNORE:NOT_DECLARED' WHEN pred1 = 'NODATA' OR classname_declared = 'IGN' THEN pred1 WHEN pred1_prob < 2 * pred2_prob THEN 'DOUBT:PROBA1<2*PROBA2'
 WHEN coalesce(pred1 <> classname_declared, true) AND pred1_prob < 0.3 THEN 'DOUBT:PRED<>INPUT-PROBA1<X' WHEN coalesce(pred1 <> classname_declared, true) AND pred1_prob * 0.9 < 0.45 THEN 'DOUBT:PRED<>INPUT-PROBA1_CORRECTED<X' WHEN pred1 = classname_declared AND pred1_prob < 0.2 THEN 'DOUBT:PRED=INPUT-PROBA1<X'
 WHEN crop = '9534' AND pred1 = 'MON_LC_FABACEAE' THEN 'DOUBT:ARABLE-SEEN-AS-FABACEAE' WHEN pixcount < 10 THEN 'DOUBT:NOT_ENOUGH_PIXELS' ELSE pred1 END AS pred_consolidated FROM b"""


@query(f"WITH {_MARKED}")
def consolidate_marker_rules(spark, sf_dir):
    """The ladder with the marker's own rule and with corrected probabilities."""
    rows = CO.top_classes(QV.vectors(spark, sf_dir), QV.CLASSES).drop(*QV.CLASSES)
    rows = rows.withColumns({"crop": F.when(F.col("uid").cast("long") % 4 == 0, "9534").otherwise("60"), "pred1": F.when(F.col("pred1") == "C2", "MON_LC_FABACEAE").otherwise(F.col("pred1"))})
    rules = CO.Doubt(marker_rules=True, pct_opposed=30, pct_opposed_corrected=45, correction="pred1_prob * 0.9")
    return CO.consolidated(rows, ["IGN"], rules, crop="crop", class_type="LANDCOVER").select("uid", "pred_consolidated")


@query(f"WITH {QV._C} SELECT uid, pred1, pred_consolidated, 'COVER' AS markercode, DATE '2024-05-01' AS cons_date, DATE '2024-05-01' AS modify_date FROM c")
def export_rows(spark, sf_dir):
    return CO.export(QV.verdicts(spark, sf_dir), ["uid", "pred1", "pred_consolidated"], "COVER", "2024-05-01")


@query(f"WITH {QM._POLY}, {QV._C}, ring AS (SELECT uid, count(*) AS corners FROM edge GROUP BY uid) SELECT uid, corners, pred_consolidated FROM ring JOIN c USING (uid)")
def export_with_geometry(spark, sf_dir):
    out = CO.with_geometry(QM.polygons(spark, sf_dir), QV.verdicts(spark, sf_dir))
    return out.select("uid", F.size(F.element_at("geom", 1)).cast("long").alias("corners"), "pred_consolidated")


@query(f"WITH {QV._C}, truth AS (SELECT c_custkey::VARCHAR AS uid, c_mktsegment AS checked FROM customer WHERE c_nationkey < 10) SELECT uid, pred1, checked FROM c JOIN truth USING (uid)")
def checked_parcels(spark, sf_dir):
    """Predictions of parcels with a ground truth."""
    truth = table(spark, sf_dir, "customer").where("c_nationkey < 10").select(F.col("c_custkey").cast("string").alias("uid"), F.col("c_mktsegment").alias("checked"))
    return RE.join_truth(QV.verdicts(spark, sf_dir), truth).select("uid", "pred1", "checked")


@query(f"WITH {QV._COVER} SELECT {QV._COLS} FROM cov WHERE all_best LIKE '%EEF%' AND ((ndvi <> 0 AND ndvi < 0.35) OR (cover_s1 = 'bare-soil' AND ndvi = 0))")
def cover_select_eef(spark, sf_dir):
    out = CV.bare_selection(QV.weeks(spark, sf_dir), premiums="all_best")
    return out.select("uid", "start_date", "ndvi", "cover_asc", "cover_desc", "cover_ndvi", "cover_s1", F.round("pred1_prob", 9).alias("pred1_prob"), "pred1")


@query(f"WITH {QM._PARCELS} " + " UNION ALL ".join(
    f"SELECT '{m}' AS marker, o_orderkey FROM o WHERE " + (" OR ".join(f"all_best LIKE '%{c}%'" for c in codes) if codes else "true").join(("(", ")")) + (" AND earlycrop = '83' AND cropcode IN ('201', '202')" if m == "COVER_EEB_VOORJAAR" else "")
    for m, codes in CV.PARCEL_FILTERS.items()))
def premium_parcels_all(spark, sf_dir):
    """The parcels of every marker."""
    p = F.col("o_orderpriority")
    premium = F.when(p == "1-URGENT", "BMG;X").when(p == "2-HIGH", "EEB").when(p == "3-MEDIUM", "TBG").when(p == "5-LOW", "MEV")
    crop = F.when(F.col("o_orderstatus") == "F", "201").when(F.col("o_orderstatus") == "O", "202").otherwise("60")
    o = table(spark, sf_dir, "orders").select("o_orderkey", premium.alias("all_best"), crop.alias("cropcode"), F.when(F.col("o_custkey") % 2 == 0, "83").alias("earlycrop"))
    out = None
    for marker in CV.PARCEL_FILTERS:
        one = CV.premium_parcels(o, marker).select(F.lit(marker).alias("marker"), "o_orderkey")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- images

@query(f"WITH {Q._LB}, i AS (SELECT *, CASE WHEN (b08 - b04) / nullif(b08 + b04, 0) IS NULL THEN 255 ELSE trunc(greatest(least(((b08 - b04) / nullif(b08 + b04, 0) + 0.08) / 0.004, 250), 0))::INT END AS byte FROM b) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CASE WHEN byte <> 255 THEN round(byte * 0.004 - 0.08, 9) END AS ndvi FROM i")
def byte_unpack(spark, sf_dir):
    """Values of packed bytes."""
    byte = B.pack(B.ndvi(F.col("b04"), F.col("b08")), "ndvi")
    return Q.line_bands(spark, sf_dir).select(*Q._LKEY, F.round(B.unpack(byte), 9).alias("ndvi"))


@query(f"WITH {Q._LB}, i AS (SELECT *, CASE WHEN vv > 0 THEN 10 * log10(vv) END AS r, CASE WHEN vh > 0 THEN 10 * log10(vh) END AS g FROM b) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CASE WHEN r IS NULL THEN 255 ELSE trunc(least(greatest((r + 21) / 16 * 254, 0), 254))::INT END AS red, CASE WHEN g IS NULL THEN 255 ELSE trunc(least(greatest((g + 23) / 11 * 254, 0), 254))::INT END AS green, CASE WHEN r - g IS NULL THEN 255 ELSE trunc(least(greatest((r - g - 3) / 9 * 254, 0), 254))::INT END AS blue FROM i")
def sar_rgb_despeckled(spark, sf_dir):
    red, green, blue = B.sar_rgb_bytes(F.col("vv"), F.col("vh"), despeckled=True)
    return Q.line_bands(spark, sf_dir).select(*Q._LKEY, red.cast("int").alias("red"), green.cast("int").alias("green"), blue.cast("int").alias("blue"))


@query(f"WITH {QM._P} SELECT row, col, round((value - 2) / (value + 2), 9) AS nd FROM p WHERE value IS NOT NULL")
def derived_image(spark, sf_dir):
    """An index image computed from its base image."""
    rows = QM.pixels(spark, sf_dir).where("value is not null")
    return RA.derived(rows, {"nd": F.round(B.ndvi(F.lit(2.0), F.col("value")), 9)}).drop("tile")


@query(f"WITH {Q._E}, have AS (SELECT DISTINCT image_profile, start_date FROM e WHERE value > 200 AND band <> 'click'), want AS (SELECT DISTINCT image_profile, start_date FROM e) SELECT image_profile, start_date FROM want EXCEPT SELECT image_profile, start_date FROM have")
def missing_slices(spark, sf_dir):
    """Expected slices that aren't there."""
    o = Q.observations(spark, sf_dir)
    return RA.missing_slices(o, o.where("value > 200 and band <> 'click'"), ["image_profile", "start_date"])


# ---------------------------------------------------------------- zones

_TINY = """poly AS (SELECT c_custkey::VARCHAR AS uid, c_custkey % 40 + 0.6 AS x, (c_custkey * 7) % 30 + 0.6 AS y, (c_custkey % 9) / 10.0 AS w, c_custkey % 11 = 0 AS broken FROM customer)"""


def small_squares(spark, sf_dir) -> DataFrame:
    """Squares of up to eight tenths of a pixel; every eleventh is no polygon."""
    key = F.col("c_custkey")
    x, y, w = key % 40 + 0.6, key * 7 % 30 + 0.6, key % 9 / 10.0
    corner = lambda a, b: F.struct((x + a * w).alias("x"), (y + b * w).alias("y"))
    ring = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))
    return table(spark, sf_dir, "customer").select(key.cast("string").alias("uid"), F.array(F.when(key % 11 == 0, F.slice(ring, 1, 2)).otherwise(ring)).alias("geom"))


@query(f"WITH {_TINY} SELECT uid, NOT broken AND w > 0 AS valid FROM poly")
def polygon_validity(spark, sf_dir):
    """Polygons, and what is none, set aside."""
    good, bad = ZO.valid_polygons(small_squares(spark, sf_dir))
    return good.select("uid", F.lit(True).alias("valid")).unionByName(bad.select("uid", F.lit(False).alias("valid")))


@query(f"WITH {_TINY} SELECT uid FROM poly WHERE NOT broken AND w > 0 AND NOT (x + w > floor(x) + 1.5 AND y + w > floor(y) + 1.5)")
def lost_parcels(spark, sf_dir):
    """Parcels without the centre of any pixel."""
    good, _ = ZO.valid_polygons(small_squares(spark, sf_dir))
    return ZO.lost(good, ZO.rasterised(good)).select("uid")


@query(f"WITH {QM._POLY} SELECT round(min(px), 6) AS minx, round(min(py), 6) AS miny, round(max(px), 6) AS maxx, round(max(py), 6) AS maxy FROM edge")
def parcel_extent(spark, sf_dir):
    boxes = ZO.bounds(QM.polygons(spark, sf_dir))
    ZO.check_inside(boxes, (-100.0, -100.0, 1000.0, 1000.0))
    return ZO.total_bounds(boxes).select(*(F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")))


_SCL = "CASE value % 12 WHEN 7 THEN 9 WHEN 3 THEN 11 ELSE 4 END"


@query(f"WITH {QM._POLY}, s AS (SELECT *, {_SCL} AS scl FROM hit), bad AS (SELECT DISTINCT uid FROM s WHERE scl IN (0, 1, 2, 8, 9, 10, 11)) SELECT uid, count(value) AS count, round(avg(value), 6) AS mean FROM s WHERE uid NOT IN (SELECT uid FROM bad) GROUP BY uid")
def zonal_without_bad_pixels(spark, sf_dir):
    """Statistics of parcels without clouds, snow or missing data."""
    value = F.col("value")
    grid = QM.grid(spark, sf_dir).withColumn("scl", F.when(value % 12 == 7, 9).when(value % 12 == 3, 11).otherwise(4))
    out = ZO.zonal_stats(grid, QM.polygons(spark, sf_dir), ["image_profile"], scl="scl")
    return out.select("uid", "count", F.round("mean", 6).alias("mean"))


@query(f"WITH {QM._POLY}, n AS (SELECT uid, count(*) FILTER (value % 3 = 0) AS count, round(avg(value) FILTER (value % 3 = 0), 6) AS mean FROM hit GROUP BY uid) SELECT true AS kept, uid, count, mean FROM n UNION ALL SELECT false, uid, count, mean FROM n WHERE count > 0")
def zonal_null_rows(spark, sf_dir):
    """Rows without statistics, kept and dropped."""
    grid, out = QM.grid(spark, sf_dir).withColumn("value", F.when(F.col("value") % 3 == 0, F.col("value"))), None
    for kept in (True, False):
        one = ZO.zonal_stats(grid, QM.polygons(spark, sf_dir), ["image_profile"], drop_nulls=not kept).select(F.lit(kept).alias("kept"), "uid", "count", F.round("mean", 6).alias("mean"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {QM._POLY}, {QM.hits(1)}, t AS (SELECT DISTINCT row // 8 AS a, col // 8 AS b FROM inside) SELECT g.row, g.col, g.value::DOUBLE AS value FROM grid g JOIN t ON t.a = g.row // 8 AND t.b = g.col // 8")
def touched_tiles(spark, sf_dir):
    """The pixels of tiles that hold a parcel's pixel."""
    tiles = ZO.touched_tiles(ZO.rasterised(QM.polygons(spark, sf_dir)), 8)
    grid = QM.grid(spark, sf_dir).withColumns({"tile_row": F.floor(F.col("row") / 8), "tile_col": F.floor(F.col("col") / 8)})
    return grid.join(tiles, ["tile_row", "tile_col"], "left_semi").select("row", "col", "value")


@query(f"WITH {QM._POLY} SELECT uid FROM edge GROUP BY uid HAVING min(px) >= 6.4 AND max(px) <= 31.1 AND min(py) >= 8.2 AND max(py) <= 25.3")
def footprint_parcels(spark, sf_dir):
    """Parcels within the polygon of an image."""
    ring = F.array(*(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in ((6.4, 8.2), (31.1, 8.2), (31.1, 25.3), (6.4, 25.3))))
    foot = spark.range(1).select(F.lit("image").alias("uid"), F.array(ring).alias("geom"))
    return ZO.within_footprint(QM.polygons(spark, sf_dir), foot).select("uid")


@query(
    """SELECT c_custkey::VARCHAR AS uid, CASE c_custkey % 6 WHEN 0 THEN 'crossing' WHEN 1 THEN 'no area' WHEN 2 THEN 'repeated point' WHEN 3 THEN 'no ring' END AS fault FROM customer WHERE c_custkey % 6 < 4"""
)
def polygon_faults(spark, sf_dir):
    """Bow ties, polygons without area, rings that visit a point twice, and what is no ring."""
    key = F.col("c_custkey")
    shapes = (((0, 0), (2, 2), (2, 0), (0, 1)), ((0, 0), (1, 1), (3, 3)), ((0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1)), ((0, 0), (1, 1), (1, 1)), ((0, 0), (2, 0), (2, 2), (2, 2), (0, 2), (0, 0)), ((0, 2), (2, 2), (1, 1), (2, 0), (0, 0)))
    ring = lambda points: F.array(*(F.struct((key % 40 + float(a)).alias("x"), (key % 30 + float(b)).alias("y")) for a, b in points))
    pick = F.when(F.lit(False), ring(shapes[0]))
    for i, points in enumerate(shapes):
        pick = pick.when(key % 6 == i, ring(points))
    return ZO.polygon_faults(table(spark, sf_dir, "customer").select(key.cast("string").alias("uid"), F.array(pick).alias("geom")))


@query(
    f"""WITH {QM._POLY}, d AS (SELECT h.uid, h.row, h.col, e.*, least(greatest(((col + 0.5 - px) * (qx - px) + (row + 0.5 - py) * (qy - py)) / ((qx - px) * (qx - px) + (qy - py) * (qy - py)), 0), 1) AS t FROM ({{inside}}) h JOIN edge e ON e.uid = h.uid),
m AS (SELECT uid, row, col, min(sqrt(pow(col + 0.5 - px - t * (qx - px), 2) + pow(row + 0.5 - py - t * (qy - py), 2))) AS dist FROM d GROUP BY uid, row, col)
SELECT uid FROM m GROUP BY uid HAVING max(dist) < 2.3""".replace("{inside}", f"WITH {QM.hits(1)} SELECT * FROM inside")
)
def emptied_parcels(spark, sf_dir):
    """Parcels that a negative buffer leaves without a pixel."""
    return ZO.emptied(QM.polygons(spark, sf_dir), buffer=2.3).select("uid")


@query(f"WITH {QM._POLY} SELECT uid, round(min(px), 6) AS minx FROM edge GROUP BY uid")
def clustered_parcels(spark, sf_dir):
    """Parcels dealt out and sorted by their place."""
    return ZO.clustered(ZO.bounds(QM.polygons(spark, sf_dir)), "minx", "uid", partitions=8).select("uid", F.round("minx", 6).alias("minx"))


# ---------------------------------------------------------------- functions


@query("SELECT event_id, ts::DATE AS day, least(ts::DATE + 5, DATE '2024-01-20' - 3) AS last FROM events")
def effective_ends(spark, sf_dir):
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select("event_id", day.alias("day"), D.effective_end(F.date_add(day, 5), F.to_date(F.lit("2024-01-20"))).alias("last"))


@query(
    "SELECT event_id, CASE WHEN value > 0 THEN round(ln(value) * 0.21714724095 + 1, 9) END AS logged, round((value - min(value) OVER (PARTITION BY event_type)) / nullif(max(value) OVER (PARTITION BY event_type) - min(value) OVER (PARTITION BY event_type), 0), 9) AS own, "
    "round((value - min(value) OVER ()) / nullif(max(value) OVER () - min(value) OVER (), 0), 9) AS whole, CASE WHEN value > 90 THEN 90.0 WHEN value < 10 THEN 10.0 ELSE value END AS clip FROM events"
)
def normalised_values(spark, sf_dir):
    """The other normalisations: logarithm, ranges within groups and over all rows, clipping."""
    e = table(spark, sf_dir, "events")
    e = V.min_max(V.min_max(e, "value", "event_type", name="own"), "value", name="whole")
    return e.select("event_id", F.round(V.log_scaled(F.col("value")), 9).alias("logged"), F.round("own", 9).alias("own"), F.round("whole", 9).alias("whole"), V.clipped(F.col("value"), 10.0, 90.0).alias("clip"))


@query("SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(p_type || '_' || p_brand || '_' || x, '[^_]*$') AS DOUBLE), 0) AS score FROM (SELECT *, CASE WHEN p_size % 3 = 0 THEN 'x' || p_size ELSE (p_size / 4.0)::DOUBLE::VARCHAR END AS x FROM part)")
def trailing_numbers(spark, sf_dir):
    size = F.col("p_size")
    last = F.when(size % 3 == 0, F.concat(F.lit("x"), size.cast("string"))).otherwise((size / 4.0).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", V.trailing_number(F.concat_ws("_", "p_type", "p_brand", last)).alias("score"))


@query("SELECT unnest(['k', 'b', 't', 's']) AS name, unnest([true, (SELECT count(*) = 0 FROM part WHERE TRY_CAST(p_brand AS DOUBLE) IS NULL), (SELECT count(*) = 0 FROM part WHERE TRY_CAST(p_type AS DOUBLE) IS NULL), (SELECT count(*) = 0 FROM part WHERE TRY_CAST(p_size AS DOUBLE) IS NULL)]) AS numeric")
def numeric_columns(spark, sf_dir):
    """Which text columns hold numbers only."""
    p = table(spark, sf_dir, "part")
    return V.numeric_columns(p.select(F.col("p_partkey").cast("string").alias("k"), F.col("p_brand").alias("b"), F.col("p_type").alias("t"), F.col("p_size").cast("string").alias("s"), "p_retailprice"))


@query("SELECT p_name || '/' || p_partkey AS path FROM part ORDER BY p_retailprice, path LIMIT 1")
def best_model(spark, sf_dir):
    """The saved model with the lowest metric, of a registry of parts."""
    registry = table(spark, sf_dir, "part").select(F.concat_ws("/", "p_name", F.col("p_partkey").cast("string")).alias("path"), F.col("p_retailprice").alias("metric"))
    return spark.createDataFrame([(MO.best_model(registry),)], "path string")
