"""Class labels of parcels: lookup of crop codes and ordered rules, by marker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import differs, same, starts, within
from ..functions.values import code_key, trailing_number

# Production methods, class names and crop codes of the label rules.
ROOFED, CONTAINERS = ("SER", "SGM", "PLA", "PLO", "NPO", "LOO"), ("CON",)
UNKNOWN, FEW, LATE, NEW_GRASS, PERMANENT, EARLY_MAIN = "UNKNOWN", "IGNORE:NOT_ENOUGH_SAMPLES", "IGNORE:LATE_CROP", "IGNORE:NEW_GRASSLAND", "IGNORE:PERMANENT_BEDEKKING", "IGNORE:EARLY_MAINCROP"
EARLY_GROUP, GRASS, GRASS_STATUS = "MON_TEELTEN_VROEGE", "60", "BG1"
BEETS, MAIZE = ("71", "91", "8532", "9532"), ("201", "202", "396")
BEET_CLASS, MAIZE_CLASS = "MON_CG_BIETEN", "MON_CG_MAIS_OF_MENGTEELT"
LEGUMES = ("60", "700", "660", "732", "723")


@dataclass(frozen=True)
class Fields:
    """Column names of a parcel table."""

    uid: str = "uid"
    crop: str = "cropcode"
    late: str = "latecrop"
    late2: str = "latecrop2"
    method: str = "prod_method"
    early_late: str = "early_late"
    grass_status: str = "grass_status"


@dataclass(frozen=True)
class Marker:
    """What a marker's rules differ in: class names under roofs and in containers, the class without a lookup, when to drop small classes."""

    roofed: str
    containers: str
    missing: str = UNKNOWN
    missing_prefix: str | None = None
    always_drop_small: bool = False
    crops: tuple[str, ...] | None = None


MARKERS = {
    "CROPGROUP": Marker("MON_CG_OVERK_LOO", "MON_CG_CONTAINERS"),
    "CROPROTATION": Marker("MON_VRU_OVERK_LOO", "MON_VRU_CONTAINERS", always_drop_small=True),
    "CARBONSUPPLY": Marker("MON_OC_OVERK_LOO", "MON_OC_CONTAINERS", always_drop_small=True),
    "FABACEAE": Marker("MON_OVERK_LOO", "MON_CONTAINERS", crops=LEGUMES),
    "LANDCOVER": Marker("MON_LC_OVERK_LOO", "MON_LC_CONTAINERS", "MON_LC_ONBEKEND_MET_KLASSIFICATIE", "nvt"),
    "RUGGENTEELT": Marker("MON_RUG_OVERK_LOO", "MON_RUG_CONTAINERS", "MON_RUG_ONBEKEND_MET_KLASSIFICATIE", "nvt"),
}
MARKERS["MULTICROP"] = MARKERS["LANDCOVER"]


def checked_lookup(lut: DataFrame, key: str) -> DataFrame:
    """The lookup with its key as text; an error if a key stands twice."""
    lut = lut.withColumn(key, code_key(F.col(key)))
    twice = lut.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} {twice[0][key]} is not unique")
    return lut


def look_up(rows: DataFrame, lut: DataFrame, on: str, key: str, suffix: str = "") -> DataFrame:
    """Left join of the (checked) lookup; columns that the rows already have are not taken, a role adds its suffix."""
    given = lut.withColumnsRenamed({c: f"{c}{suffix}" for c in lut.columns})
    new = [c for c in given.columns if c not in rows.columns and c != f"{key}{suffix}"]
    given = given.select(F.col(f"{key}{suffix}").alias("_key"), *new)
    return rows.join(given, code_key(F.col(on)) == F.col("_key"), "left").drop("_key")


def drop_small(rows: DataFrame, label: str, least: int, name: str = "classname") -> DataFrame:
    """Classes with fewer rows than `least` are ignored. The small ones are found by an aggregation and joined as a short list."""
    few = rows.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_few")).agg(F.count("*").alias("_n")).where(F.col("_n") < least).select("_few")
    out = rows.join(few, F.col(label) == F.col("_few"), "left")
    return out.withColumn(name, F.when(F.col("_few").isNotNull(), FEW).otherwise(F.col(label))).drop("_few")


def marker_class(looked_up: Column, method: Column, m: Marker) -> Column:
    """Production method before lookup, and the class of missing or not applicable lookups."""
    absent = looked_up.isNull() if m.missing_prefix is None else starts(looked_up, m.missing_prefix, missing=True)
    return F.when(within(method, ROOFED), m.roofed).when(within(method, CONTAINERS), m.containers).when(absent, m.missing).otherwise(looked_up)


def early_class(label: Column, f: Fields) -> Column:
    """After the small classes: late crops, then new grassland, which wins."""
    new_grass = same(code_key(F.col(f.crop)), F.lit(GRASS)) & (F.col(f.grass_status).isNull() | same(F.col(f.grass_status), F.lit(GRASS_STATUS)))
    return F.when(new_grass, NEW_GRASS).when(differs(F.col(f.early_late), F.lit(EARLY_GROUP)), LATE).otherwise(label)


def plain_labels(parcels: DataFrame, lut: DataFrame, marker: str, least: int, class_col: str, ground_truth: bool = False, early: bool = False, f: Fields = Fields(), key: str = "cropcode") -> DataFrame:
    """Columns classname (small classes dropped) and classname_declared (not dropped)."""
    m = MARKERS[marker]
    rows = parcels if m.crops is None else parcels.where(within(code_key(F.col(f.crop)), m.crops))
    rows = look_up(rows, lut.select(key, F.col(class_col).alias("_class")), f.crop, key)
    rows = rows.withColumn("classname_declared", marker_class(F.col("_class"), F.col(f.method), m)).drop("_class")
    if least > 1 and (m.always_drop_small or not ground_truth):
        rows = drop_small(rows, "classname_declared", least)
    else:
        rows = rows.withColumn("classname", F.col("classname_declared"))
    if early:
        rows = rows.withColumns({c: early_class(F.col(c), f) for c in ("classname", "classname_declared")})
    return tidy(rows, f)


def late_labels(parcels: DataFrame, lut: DataFrame, scope: str, least: int, class_col: str, ground_truth: bool = False, f: Fields = Fields(), key: str = "cropcode", permanent: str = "permanent", grass: str = "grass", score: str | None = None) -> DataFrame:
    """Classes of late crops in the scopes ALL, EARLY (early main crops get the class of the main crop) and LATE.

    The lookup is joined in three roles. `correction` is the score at the end of the class name over the greatest one.
    """
    if scope not in ("ALL", "EARLY", "LATE"):
        raise ValueError(f"unknown scope {scope}")
    kept = [c for c in (key, class_col, permanent, grass) if c in lut.columns]
    rows = parcels
    for column, suffix in ((f.late, "_late"), (f.late2, "_late2"), (f.crop, "_main")):
        rows = look_up(rows, lut.select(*kept), column, key, suffix) if column in parcels.columns else rows.withColumns({f"{c}{suffix}": F.lit(None).cast(lut.schema[c].dataType) for c in kept if c != key})
    main = code_key(F.col(f.crop))
    looked = F.coalesce(F.col(f"{class_col}_late"), *([] if ground_truth else [F.col(f"{class_col}_late2")]))
    by_main = F.when(within(main, BEETS), BEET_CLASS).when(within(main, MAIZE), MAIZE_CLASS)
    if scope == "EARLY":
        looked = F.coalesce(by_main, looked)
    label = F.coalesce(looked, F.lit(UNKNOWN))
    if scope == "LATE":
        label = F.when(by_main.isNull(), EARLY_MAIN).otherwise(label)
    method = F.col(f.method)
    label = F.when((label == UNKNOWN) & within(method, ROOFED), MARKERS["CROPGROUP"].roofed).when((label == UNKNOWN) & within(method, CONTAINERS), MARKERS["CROPGROUP"].containers).otherwise(label)
    rows = rows.withColumn("classname", label)
    if f"{permanent}_main" in rows.columns and f"{grass}_main" in rows.columns:
        lasting = same(F.col(f"{permanent}_main").cast("int"), F.lit(1)) & differs(F.col(f"{grass}_main").cast("int"), F.lit(1))
        rows = rows.withColumn("classname", F.when((F.col("classname") == UNKNOWN) & lasting, PERMANENT).otherwise(F.col("classname")))
    if least > 1 and not ground_truth:
        rows = drop_small(rows, "classname", least)
    rows = rows.withColumn("classname_declared", F.col("classname"))
    if score is not None:
        rows = corrections(rows, score)
    return tidy(rows, f)


def corrections(rows: DataFrame, score: str, name: str = "correction") -> DataFrame:
    """Scores at the end of class names as shares of the greatest; an error if that is 0."""
    value = trailing_number(F.col(score))
    most = rows.agg(F.max(value).alias("_most"))  # one row
    share = F.when(F.col("_most") == 0, F.raise_error(F.lit("the greatest score is 0")).cast("double")).otherwise(value / F.col("_most"))
    return rows.crossJoin(F.broadcast(most)).withColumn(name, share).drop("_most")


def whitelisted(rows: DataFrame, id_col: str = "uid", classes: tuple[str, ...] = ("classname", "classname_declared"), export: tuple[str, ...] = (), domain: tuple[str, ...] = ()) -> DataFrame:
    """The id, the class columns, and those export and domain columns that are there, in this order, once each."""
    wanted = dict.fromkeys((id_col, *classes, *export, *domain))
    return rows.select(*(c for c in wanted if c in rows.columns))


def tidy(rows: DataFrame, f: Fields) -> DataFrame:
    """Commas in production methods become semicolons."""
    return rows.withColumn(f.method, F.translate(F.col(f.method), ",", ";")) if f.method in rows.columns else rows


def prepare(parcels: DataFrame, lut: DataFrame, class_type: str, least: int, class_col: str, f: Fields = Fields(), key: str = "cropcode") -> DataFrame:
    """Rules by name: a marker, with -EARLY for early crops, LATECROP[-EARLY|-LATE|-ALL], and -GROUNDTRUTH after either."""
    name, truth = class_type.removesuffix("-GROUNDTRUTH"), class_type.endswith("-GROUNDTRUTH")
    if name.startswith("LATECROP"):
        scope = name.rpartition("-")[2] if "-" in name else "ALL"
        return late_labels(parcels, checked_lookup(lut, key), scope, least, class_col, truth, f, key)
    early, base = name.endswith("-EARLY"), name.removesuffix("-EARLY")
    if base not in MARKERS:
        raise ValueError(f"unknown class type {class_type}")
    return plain_labels(parcels, checked_lookup(lut, key), base, least, class_col, truth, early, f, key)


#: Every class type: the markers, plain and for early crops, and late crops in their scopes; each as ground truth too.
CLASS_TYPES = [f"{m}{t}" for m in (*(f"{x}{e}" for x in MARKERS for e in ("", "-EARLY")), *(f"LATECROP{e}" for e in ("-ALL", "-EARLY", "-LATE"))) for t in ("", "-GROUNDTRUTH")]
