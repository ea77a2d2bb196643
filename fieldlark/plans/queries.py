"""Registered queries of the parcel operators over whole tables, each with the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands as B
from ..functions import dates as D
from ..operators import features as FE
from ..operators import labels as LA
from ..operators import sampling as SA

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


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- periods and features

_PROFILE = {"view": "s2-agri-weekly", "purchase": "s2-agri-weekly", "error": "s1-grd-sigma0-asc-weekly", "click": "s1-coh-weekly", "signup": "s2-ndvi-weekly"}
_PROFILE_SQL = "CASE " + " ".join(f"WHEN event_type = '{k}' THEN '{v}'" for k, v in _PROFILE.items()) + " END"
_E = f"e AS (SELECT user_id::VARCHAR AS uid, {_PROFILE_SQL} AS image_profile, date_trunc('week', ts)::DATE AS start_date, date_trunc('week', ts)::DATE + 6 AS end_incl, event_type AS band, value FROM events)"
_Z = f"{_E}, z AS (SELECT uid, image_profile, start_date, end_incl, band, count(value) AS count, avg(value) AS mean FROM e GROUP BY ALL)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: parcel = user, band = event type, slice = week."""
    profile = F.try_element_at(F.create_map(*(F.lit(x) for pair in _PROFILE.items() for x in pair)), F.col("event_type"))
    monday = D.monday_before(F.col("ts"))
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("uid"), profile.alias("image_profile"), monday.alias("start_date"), F.date_add(monday, 6).alias("end_incl"), F.col("event_type").alias("band"), "value")


def zonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("uid", *FE.KEYS).agg(F.count("value").alias("count"), F.avg("value").alias("mean"))


@query(
    """
WITH d AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT day, n, date_trunc('week', day)::DATE AS before, CASE WHEN isodow(day) = 1 THEN day ELSE date_trunc('week', day)::DATE + 7 END AS after FROM d)
SELECT day, n, before AS monday_before, after AS monday_after, strftime(day, '%W')::INT AS week,
  CASE WHEN strftime(before, '%W')::INT % 2 = 1 THEN before ELSE before - 7 END AS biweekly_before,
  CASE WHEN strftime(after, '%W')::INT % 2 = 1 THEN after ELSE after + 7 END AS biweekly_after FROM m
"""
)
def weekly_periods(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    d = F.col("day")
    return days.select("day", "n", D.monday_before(d).alias("monday_before"), D.monday_after(d).alias("monday_after"), D.week_number(d).alias("week"), D.biweekly_before(d).alias("biweekly_before"), D.biweekly_after(d).alias("biweekly_after"))


@query(
    """
WITH p AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-22', INTERVAL 7 DAY))::DATE AS start_date)
SELECT start_date, start_date + 7 AS end_date, count(e.event_id) AS n FROM p LEFT JOIN events e ON e.ts::DATE >= start_date AND e.ts::DATE < start_date + 7 GROUP BY ALL
"""
)
def period_counts(spark, sf_dir):
    p = D.periods(spark, "2024-01-01", "2024-01-31", "weekly", today="2024-06-01")
    days = table(spark, sf_dir, "events").groupBy(D.monday_before(F.col("ts")).alias("start_date")).agg(F.count("*").alias("n"))
    return p.join(days, "start_date", "left").select("start_date", "end_date", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    f"""
WITH {_E}, c AS (SELECT uid, image_profile, start_date, end_incl, band, value, count(*) AS n FROM e WHERE value IS NOT NULL GROUP BY ALL),
m AS (SELECT uid, image_profile, start_date, end_incl, band, arg_max(value, n * 1e9 - value) AS majority, arg_min(value, n * 1e9 + value) AS minority FROM c GROUP BY ALL),
s AS (SELECT uid, image_profile, start_date, end_incl, band, count(value) AS count, round(sum(value), 4) AS sum, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std,
  min(value) AS min, max(value) AS max, round(max(value) - min(value), 6) AS range FROM e GROUP BY ALL)
SELECT * FROM s JOIN m USING (uid, image_profile, start_date, end_incl, band)
"""
)
def slice_stats(spark, sf_dir):
    out = FE.statistics(observations(spark, sf_dir), ["uid", *FE.KEYS])
    return rounded(rounded(out.drop("variance"), "mean", "median", "std", "range"), "sum", digits=4)


@query(
    f"""
WITH {_Z}, n AS (SELECT count(DISTINCT uid) AS parcels FROM e)
SELECT image_profile, start_date, end_incl, band, count(*) AS rows, count(*) FILTER (mean IS NULL) AS nulls, round(100.0 * count(*) / any_value(parcels), 6) AS row_pct,
  round(100.0 * (1 - count(*) FILTER (mean IS NULL) / any_value(parcels)), 6) AS value_pct FROM z, n GROUP BY ALL
"""
)
def slice_coverage(spark, sf_dir):
    z = zonal(spark, sf_dir)
    return rounded(FE.coverage(z, observations(spark, sf_dir).select("uid")).drop("parcels"), "row_pct", "value_pct")


_WEEKS = ("20240101", "20240108", "20240115", "20240122")
FEATURES = sorted(f"{p}_{w}_{b}_mean" for b, p in _PROFILE.items() for w in _WEEKS)
_LONG = f"""
{_Z}, parcels AS (SELECT DISTINCT uid FROM e), n AS (SELECT count(*) AS n FROM parcels),
wanted AS (SELECT * FROM z WHERE start_date >= DATE '2024-01-01' AND end_incl < DATE '2024-01-29'),
kept AS (SELECT image_profile, start_date, band FROM wanted, n GROUP BY ALL HAVING count(*) * 100.0 / any_value(n) >= 80),
feature AS (SELECT w.uid, image_profile || '_' || strftime(start_date, '%Y%m%d') || '_' || band || '_mean' AS feature,
  CASE WHEN image_profile LIKE 's2-agri%' THEN least(mean / 10000, 1.0) WHEN image_profile LIKE 's1-grd%' THEN least(mean, 1.0) WHEN image_profile LIKE 's1-coh%' THEN mean / 300 ELSE mean END AS value
  FROM wanted w JOIN kept USING (image_profile, start_date, band))
"""


def table_of_wanted(spark, sf_dir) -> DataFrame:
    return FE.wanted_slices(zonal(spark, sf_dir), sorted(set(_PROFILE.values())), "2024-01-01", "2024-01-29")


def features_long(spark, sf_dir) -> DataFrame:
    return FE.long_features(table_of_wanted(spark, sf_dir), observations(spark, sf_dir).select("uid"))


@query(f"WITH {_LONG} SELECT uid, feature, round(value, 9) AS value FROM feature")
def feature_long(spark, sf_dir):
    return rounded(features_long(spark, sf_dir), "value", digits=9)


_WIDE = (
    f"WITH {_LONG}, wide AS (SELECT p.uid, "
    + ", ".join(f"max(value) FILTER (feature = '{c}') AS \"{c}\"" for c in FEATURES)
    + " FROM parcels p LEFT JOIN feature f USING (uid) GROUP BY p.uid), matrix AS (SELECT uid, "
    + ", ".join(f'round(coalesce("{c}", 0), 9) AS "{c}"' for c in FEATURES)
    + " FROM wide WHERE "
    + " + ".join(f'("{c}" IS NULL)::INT' for c in FEATURES)
    + f" <= {int(0.6 * len(FEATURES))})"
)


def matrix(spark, sf_dir) -> DataFrame:
    parcels = observations(spark, sf_dir).select("uid")
    return rounded(FE.feature_matrix(features_long(spark, sf_dir), parcels, features=FEATURES)[0], *FEATURES, digits=9)


@query(f"{_WIDE} SELECT * FROM matrix")
def feature_matrix(spark, sf_dir):
    """Flagship: which parcels have usable weekly features, and what they are."""
    return matrix(spark, sf_dir)


@query(_WIDE + " SELECT uid, feature, value FROM (UNPIVOT matrix ON " + ", ".join(f'"{c}"' for c in FEATURES) + " INTO NAME feature VALUE value)")
def feature_rows(spark, sf_dir):
    """The matrix turned back into rows."""
    return FE.feature_rows(matrix(spark, sf_dir))


@query(_WIDE + " SELECT feature, min(value) AS lowest, max(value) AS highest FROM (UNPIVOT matrix ON " + ", ".join(f'"{c}"' for c in FEATURES) + " INTO NAME feature VALUE value) GROUP BY feature HAVING min(value) < 0 OR max(value) > 1")
def feature_audit(spark, sf_dir):
    return FE.out_of_range(matrix(spark, sf_dir), FEATURES)


@query(
    f"""
WITH {_Z}, best AS (SELECT image_profile, start_date, band, count(*) FILTER (count >= 1) AS n FROM z WHERE image_profile LIKE 's1%' GROUP BY ALL ORDER BY n DESC, image_profile, start_date, band LIMIT 1)
SELECT p.uid, coalesce(z.count, 0) AS pixcount FROM (SELECT DISTINCT uid FROM e) p LEFT JOIN (SELECT z.* FROM z JOIN best USING (image_profile, start_date, band)) z USING (uid)
"""
)
def pixel_counts(spark, sf_dir):
    parcels = observations(spark, sf_dir).select("uid").distinct()
    return FE.with_pixel_count(parcels, FE.best_pixel_count(zonal(spark, sf_dir)))


# ---------------------------------------------------------------- labels

_CODE = "p_size"
_PARTS = """
parts AS (SELECT p_partkey::VARCHAR AS uid, p_size::VARCHAR AS cropcode, CASE WHEN p_brand = 'Brand#1' THEN 'SER' WHEN p_brand = 'Brand#2' THEN 'CON' WHEN p_brand = 'Brand#3' THEN 'A,B' END AS prod_method,
  CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN 'MON_TEELTEN_VROEGE' WHEN p_type = 'LARGE' THEN 'MON_TEELTEN_LATE' END AS early_late,
  CASE WHEN p_brand IN ('Brand#4', 'Brand#5') THEN 'BG1' WHEN p_brand = 'Brand#6' THEN 'BG' END AS grass_status FROM part),
lut AS (SELECT DISTINCT p_size::VARCHAR AS cropcode, CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 9 = 0 THEN 'nvt_x' WHEN p_size >= 48 THEN 'MON_SMALL' ELSE 'MON_CLASS_' || (p_size % 7) END AS cls FROM part)
"""


def parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Parts as parcels: size = crop code, brand = production method, type = early or late; and the lookup of sizes."""
    p = table(spark, sf_dir, "part")
    brand, size = F.col("p_brand"), F.col("p_size")
    rows = p.select(
        F.col("p_partkey").cast("string").alias("uid"), size.cast("string").alias("cropcode"),
        F.when(brand == "Brand#1", "SER").when(brand == "Brand#2", "CON").when(brand == "Brand#3", "A,B").alias("prod_method"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL", "PROMO"), LA.EARLY_GROUP).when(F.col("p_type") == "LARGE", "MON_TEELTEN_LATE").alias("early_late"),
        F.when(brand.isin("Brand#4", "Brand#5"), "BG1").when(brand == "Brand#6", "BG").alias("grass_status"),
    )
    cls = F.when(size % 10 == 0, F.lit(None).cast("string")).when(size % 9 == 0, "nvt_x").when(size >= 48, "MON_SMALL").otherwise(F.concat(F.lit("MON_CLASS_"), (size % 7).cast("string")))
    return rows, p.select("p_size").distinct().select(size.cast("string").alias("cropcode"), cls.alias("cls"))


def _label_sql(roofed: str, containers: str, absent: str, missing: str, least: int | None, early: bool, where: str = "true") -> str:
    declared = f"CASE WHEN prod_method IN ('SER', 'SGM', 'PLA', 'PLO', 'NPO', 'LOO') THEN '{roofed}' WHEN prod_method = 'CON' THEN '{containers}' WHEN {absent} THEN '{missing}' ELSE cls END"
    name = f"CASE WHEN count(*) OVER (PARTITION BY declared) < {least} THEN 'IGNORE:NOT_ENOUGH_SAMPLES' ELSE declared END" if least else "declared"
    late = "CASE WHEN cropcode = '60' AND (grass_status IS NULL OR grass_status = 'BG1') THEN 'IGNORE:NEW_GRASSLAND' WHEN coalesce(early_late, '') <> 'MON_TEELTEN_VROEGE' THEN 'IGNORE:LATE_CROP' ELSE {} END"
    pick = (late.format("name"), late.format("declared")) if early else ("name", "declared")
    return f"""
WITH {_PARTS}, j AS (SELECT p.*, {declared} AS declared FROM parts p LEFT JOIN lut USING (cropcode) WHERE {where}), k AS (SELECT *, {name} AS name FROM j)
SELECT uid, replace(prod_method, ',', ';') AS prod_method, {pick[0]} AS classname, {pick[1]} AS classname_declared FROM k
"""


_NVT = "cls IS NULL OR cls LIKE 'nvt%'"
_LABELS = {
    "cropgroup": ("CROPGROUP", 60, _label_sql("MON_CG_OVERK_LOO", "MON_CG_CONTAINERS", "cls IS NULL", "UNKNOWN", 60, False)),
    "cropgroup_early": ("CROPGROUP-EARLY", 60, _label_sql("MON_CG_OVERK_LOO", "MON_CG_CONTAINERS", "cls IS NULL", "UNKNOWN", 60, True)),
    "cropgroup_truth": ("CROPGROUP-GROUNDTRUTH", 60, _label_sql("MON_CG_OVERK_LOO", "MON_CG_CONTAINERS", "cls IS NULL", "UNKNOWN", None, False)),
    "croprotation_truth": ("CROPROTATION-GROUNDTRUTH", 60, _label_sql("MON_VRU_OVERK_LOO", "MON_VRU_CONTAINERS", "cls IS NULL", "UNKNOWN", 60, False)),
    "carbonsupply": ("CARBONSUPPLY", 60, _label_sql("MON_OC_OVERK_LOO", "MON_OC_CONTAINERS", "cls IS NULL", "UNKNOWN", 60, False)),
    "fabaceae": ("FABACEAE", 60, _label_sql("MON_OVERK_LOO", "MON_CONTAINERS", "cls IS NULL", "UNKNOWN", 60, False, "cropcode IN ('60', '700', '660', '732', '723')")),
    "landcover": ("LANDCOVER", 60, _label_sql("MON_LC_OVERK_LOO", "MON_LC_CONTAINERS", _NVT, "MON_LC_ONBEKEND_MET_KLASSIFICATIE", 60, False)),
    "multicrop_early": ("MULTICROP-EARLY", 60, _label_sql("MON_LC_OVERK_LOO", "MON_LC_CONTAINERS", _NVT, "MON_LC_ONBEKEND_MET_KLASSIFICATIE", 60, True)),
    "ruggenteelt": ("RUGGENTEELT", 60, _label_sql("MON_RUG_OVERK_LOO", "MON_RUG_CONTAINERS", _NVT, "MON_RUG_ONBEKEND_MET_KLASSIFICATIE", 60, False)),
}
for _name, (_type, _least, _sql) in _LABELS.items():
    if _name == "fabaceae":
        continue  # its crop codes are no part sizes: tested on rows of its own

    def _labelled(spark, sf_dir, _type=_type, _least=_least):
        rows, lut = parts(spark, sf_dir)
        return LA.prepare(rows, lut, _type, _least, "cls").select("uid", "prod_method", "classname", "classname_declared")

    query(_sql, f"labels_{_name}")(_labelled)


_LATE = """
WITH p AS (SELECT p_partkey::VARCHAR AS uid, CASE WHEN p_size % 3 = 0 THEN '201' WHEN p_size % 5 = 0 THEN '71' ELSE p_size::VARCHAR END AS cropcode, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE ((p_size + 7) % 50 + 1)::VARCHAR END AS latecrop,
  ((p_size + 13) % 50 + 1)::VARCHAR AS latecrop2, CASE WHEN p_brand = 'Brand#1' THEN 'SER' END AS prod_method FROM part),
lut AS (SELECT DISTINCT p_size::VARCHAR AS cropcode, CASE WHEN p_size % 10 = 0 THEN NULL ELSE 'MON_CLASS_' || (p_size % 7) END AS cls, (p_size % 2)::INT AS permanent, (p_size % 4 = 1)::INT AS grass FROM part),
j AS (SELECT p.*, coalesce(a.cls, b.cls) AS looked, m.permanent, m.grass, CASE WHEN p.cropcode = '71' THEN 'MON_CG_BIETEN' WHEN p.cropcode = '201' THEN 'MON_CG_MAIS_OF_MENGTEELT' END AS main
  FROM p LEFT JOIN lut a ON a.cropcode = latecrop LEFT JOIN lut b ON b.cropcode = latecrop2 LEFT JOIN lut m ON m.cropcode = p.cropcode),
"""
_LATE_END = """
l AS (SELECT *, CASE WHEN x = 'UNKNOWN' AND prod_method = 'SER' THEN 'MON_CG_OVERK_LOO' WHEN x = 'UNKNOWN' AND permanent = 1 AND coalesce(grass, 0) <> 1 THEN 'IGNORE:PERMANENT_BEDEKKING' ELSE x END AS y FROM k)
SELECT uid, CASE WHEN count(*) OVER (PARTITION BY y) < 40 THEN 'IGNORE:NOT_ENOUGH_SAMPLES' ELSE y END AS classname FROM l
"""


def _late(spark, sf_dir, scope):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    rows = p.select(
        F.col("p_partkey").cast("string").alias("uid"), F.when(size % 3 == 0, "201").when(size % 5 == 0, "71").otherwise(size.cast("string")).alias("cropcode"),
        F.when(F.col("p_partkey") % 4 != 0, ((size + 7) % 50 + 1).cast("string")).alias("latecrop"), ((size + 13) % 50 + 1).cast("string").alias("latecrop2"), F.when(F.col("p_brand") == "Brand#1", "SER").alias("prod_method"),
    )
    lut = p.select("p_size").distinct().select(size.cast("string").alias("cropcode"), F.when(size % 10 != 0, F.concat(F.lit("MON_CLASS_"), (size % 7).cast("string"))).alias("cls"), (size % 2).alias("permanent"), (size % 4 == 1).cast("int").alias("grass"))
    return LA.prepare(rows, lut, f"LATECROP-{scope}", 40, "cls").select("uid", "classname")


for _scope, _k in (
    ("ALL", "k AS (SELECT *, coalesce(looked, 'UNKNOWN') AS x FROM j),"),
    ("EARLY", "k AS (SELECT *, coalesce(main, looked, 'UNKNOWN') AS x FROM j),"),
    ("LATE", "k AS (SELECT *, CASE WHEN main IS NULL THEN 'IGNORE:EARLY_MAINCROP' ELSE coalesce(looked, 'UNKNOWN') END AS x FROM j),"),
):
    query(_LATE + _k + _LATE_END, f"labels_latecrop_{_scope.lower()}")(lambda spark, sf_dir, _scope=_scope: _late(spark, sf_dir, _scope))


@query("SELECT c_custkey, c_nationkey, n_name, n_regionkey, c_acctbal FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def lut_join(spark, sf_dir):
    lut = LA.checked_lookup(table(spark, sf_dir, "nation"), "n_nationkey")
    return LA.look_up(table(spark, sf_dir, "customer"), lut, "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey", "n_name", "n_regionkey", "c_acctbal")


@query(
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, a.n_name AS n_name_cust, b.n_name AS n_name_supp FROM lineitem l LEFT JOIN orders o ON o_orderkey = l_orderkey LEFT JOIN customer c ON c_custkey = o_custkey
LEFT JOIN supplier s ON s_suppkey = l_suppkey LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = s_nationkey
"""
)
def role_playing_lut(spark, sf_dir):
    lut = LA.checked_lookup(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = rows.join(orders, "l_orderkey", "left").join(customers, "c_custkey", "left").join(suppliers, "l_suppkey", "left")
    for on, role in (("c_nationkey", "_cust"), ("s_nationkey", "_supp")):
        rows = LA.look_up(rows, lut, on, "n_nationkey", role)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_name_cust", "n_name_supp")


# ---------------------------------------------------------------- sampling


@query("SELECT p_partkey AS uid, p_brand, ((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)) - 1) % 4 AS fold FROM part")
def fold_ids(spark, sf_dir):
    return SA.fold_ids(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), "p_brand"), 4, "p_brand")


_RANKED = "SELECT p_partkey AS uid, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY md5('{seed}:' || p_partkey), p_partkey) AS r, count(*) OVER (PARTITION BY p_brand) AS n FROM part"


@query(f"SELECT uid, p_brand, r <= round_even(0.2 * n, 0) AS is_test FROM ({_RANKED.format(seed='test')})")
def test_split(spark, sf_dir):
    return SA.test_split(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), "p_brand"), 0.2, "p_brand")


@query(f"SELECT uid, p_brand, 1 AS draw FROM ({_RANKED.format(seed='train')}) WHERE r <= round_even(0.25 * n, 0)")
def balance_none(spark, sf_dir):
    return SA.balance(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), "p_brand"), "NONE", "p_brand")


def scaled_tiers(strategy: str, by: float) -> tuple[SA.Tier, ...]:
    return tuple(SA.Tier(round(t.least / by), None if t.quota is None else round(t.quota / by), t.again) for t in SA.STRATEGIES[strategy])


def _balance_sql(tiers) -> str:
    take, draw, above = [], [], None
    for t in tiers:
        size = f"n >= {t.least}" + (f" AND n < {above}" if above is not None else "")
        if t.again:
            draw.append(f"SELECT DISTINCT p_brand, n, {t.quota} AS q FROM ranked WHERE {size}")
        else:
            take.append(f"({size}" + (f" AND r <= {t.quota})" if t.quota is not None else ")"))
        above = t.least
    sql = f"WITH ranked AS ({_RANKED.format(seed='train')}) SELECT uid, p_brand, 1 AS draw FROM ranked WHERE {' OR '.join(take) or 'false'}"
    if draw:
        sql += f" UNION ALL SELECT k.uid, d.p_brand, d.draw FROM (SELECT *, ('0x' || substr(md5('train:' || p_brand || ':' || draw), 1, 12))::BIGINT % n + 1 AS pick FROM (SELECT *, unnest(range(1, q + 1))::INT AS draw FROM ({' UNION ALL '.join(draw)}))) d JOIN ranked k ON k.p_brand = d.p_brand AND k.r = d.pick"
    return sql


#: The strategies' sizes over these numbers, so that brands of the small tables fall into several tiers.
for _strategy, _by in (("MEDIUM", 140), ("MEDIUM2", 1400), ("PROPORTIONAL_GROUPS", 1200), ("UPPER_LIMIT", 130), ("EQUAL", 20)):
    _tiers = scaled_tiers(_strategy, _by)

    def _balanced(spark, sf_dir, _tiers=_tiers):
        return SA.balanced(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("uid"), "p_brand"), _tiers, "p_brand")

    query(_balance_sql(_tiers), f"balance_{_strategy.lower()}")(_balanced)


# ---------------------------------------------------------------- bands

_LB = "b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount * 1000 AS b02, l_quantity * 10 AS b04, l_extendedprice / 10 AS b08, l_tax * 10000 AS b11, CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS vv, l_discount / 2 AS vh FROM lineitem)"
_LKEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]


def line_bands(spark, sf_dir) -> DataFrame:
    d, t, q = F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(*_LKEY, (d * 1000).alias("b02"), (q * 10).alias("b04"), (F.col("l_extendedprice") / 10).alias("b08"), (t * 10000).alias("b11"), F.when(t != 0, t).alias("vv"), (d / 2).alias("vh"))


@query(
    f"""
WITH {_LB} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, round((b08 - b04) / nullif(b08 + b04, 0), 9) AS ndvi, round(((b11 + b04) - (b08 + b02)) / nullif((b11 + b04) + (b08 + b02), 0), 9) AS bsi,
round((vh / vv) * (vh / vv + 3) / ((vh / vv + 1) * (vh / vv + 1)), 9) AS dprvi, round(4 * vh / nullif(vv + vh, 0), 9) AS rvi, round(vv / nullif(vh, 0), 9) AS vvvh FROM b
"""
)
def band_indices(spark, sf_dir):
    c = {n: F.col(n) for n in ("b02", "b04", "b08", "b11", "vv", "vh")}
    out = line_bands(spark, sf_dir).select(*_LKEY, B.ndvi(c["b04"], c["b08"]).alias("ndvi"), B.bsi(c["b02"], c["b04"], c["b08"], c["b11"]).alias("bsi"), B.dprvi(c["vv"], c["vh"]).alias("dprvi"), B.rvi(c["vv"], c["vh"]).alias("rvi"), B.ratio(c["vv"], c["vh"]).alias("vvvh"))
    return rounded(out, "ndvi", "bsi", "dprvi", "rvi", "vvvh", digits=9)


@query(
    f"""
WITH {_LB}, i AS (SELECT *, (b08 - b04) / nullif(b08 + b04, 0) AS ndvi, 4 * vh / nullif(vv + vh, 0) AS rvi FROM b)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CASE WHEN ndvi IS NULL THEN 255 ELSE trunc(greatest(least((ndvi + 0.08) / 0.004, 250), 0))::INT END AS ndvi, CASE WHEN rvi IS NULL THEN 255 ELSE trunc(greatest(least(rvi / 0.004, 250), 0))::INT END AS rvi FROM i
"""
)
def byte_pack(spark, sf_dir):
    c = {n: F.col(n) for n in ("b04", "b08", "vv", "vh")}
    return line_bands(spark, sf_dir).select(*_LKEY, B.pack(B.ndvi(c["b04"], c["b08"]), "ndvi").cast("int").alias("ndvi"), B.pack(B.rvi(c["vv"], c["vh"]), "rvi").cast("int").alias("rvi"))


@query(
    f"""
WITH {_LB}, i AS (SELECT *, CASE WHEN vv > 0 THEN 10 * log10(vv) END AS r, CASE WHEN vh > 0 THEN 10 * log10(vh) END AS g FROM b)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CASE WHEN r IS NULL THEN 255 ELSE trunc(least(greatest((r + 22) / 17 * 254, 0), 254))::INT END AS red,
CASE WHEN g IS NULL THEN 255 ELSE trunc(least(greatest((g + 23) / 11 * 254, 0), 254))::INT END AS green, CASE WHEN r - g IS NULL THEN 255 ELSE trunc(least(greatest((r - g - 2) / 11 * 254, 0), 254))::INT END AS blue FROM i
"""
)
def sar_rgb(spark, sf_dir):
    red, green, blue = B.sar_rgb_bytes(F.col("vv"), F.col("vh"))
    return line_bands(spark, sf_dir).select(*_LKEY, red.cast("int").alias("red"), green.cast("int").alias("green"), blue.cast("int").alias("blue"))
