"""Scaling, binning, rounding and naming of feature values and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Edges of the right-closed bins of pixel counts; the divisors and the log constant of the scaling rules stand in them.
EDGES = (0, 1, 5, 10, 20, 30, 40, 50, 100, 200, 1000, 5000, 10000)


def scaled(value: Column, profile: Column) -> Column:
    """Features of an image profile brought to about 0..1."""
    return (
        F.when(profile.startswith("s2-agri"), F.least(value / 10000, F.lit(1.0)))
        .when(profile.startswith("s1-grd"), F.least(value, F.lit(1.0)))
        .when(profile.startswith("s1coh") | profile.startswith("s1-coh"), value / 300)
        .otherwise(value)
    )


def log_scaled(value: Column) -> Column:
    return F.when(value > 0, F.ln(value) * 0.21714724095 + 1)


def min_max(rows: DataFrame, value: str, *by: str, name: str = "min_max") -> DataFrame:
    """A column brought to 0..1 within each group of `by`, or over all rows; null where all values are equal."""
    ends = rows.groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = rows.join(ends, on) if by else rows.crossJoin(F.broadcast(ends))  # without groups a single row
    return joined.withColumn(name, F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi", *(f"_{c}" for c in by))


def numeric_columns(rows: DataFrame) -> DataFrame:
    """(name, numeric) of every text column: whether all values that are there read as numbers, and there is one. One pass."""
    names = [f.name for f in rows.schema if f.dataType.simpleString() == "string"]
    bad = lambda c: F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull())
    found = rows.agg(*(e.alias(f"{k}{i}") for i, c in enumerate(names) for k, e in (("b", bad(c)), ("n", F.count(f"`{c}`")))))
    return found.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), ((F.col(f"b{i}") == 0) & (F.col(f"n{i}") > 0)).alias("numeric")) for i, c in enumerate(names)))))


def clipped(value: Column, low: float | None = None, high: float | None = None) -> Column:
    value = value if high is None else F.when(value > high, high).otherwise(value)
    return value if low is None else F.when(value < low, low).otherwise(value)


def bin_labels(edges: tuple[int, ...] = EDGES) -> list[str]:
    return [f"{'[' if i == 0 else '('}{a}, {b}]" for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def binned(n: Column, edges: tuple[int, ...] = EDGES) -> Column:
    """Label of the bin; the first edge is included, values outside have none."""
    out = F.when(n < edges[0], F.lit(None).cast("string"))
    for label, high in zip(bin_labels(edges), edges[1:], strict=True):
        out = out.when(n <= high, label)
    return out


def percent(p: Column) -> Column:
    """Two decimals, halves to even."""
    return F.bround(p, 2)


def trailing_number(name: Column) -> Column:
    """The number after the last underscore of a class name, 0 if it isn't one."""
    return F.coalesce(F.element_at(F.split(name, "_"), -1).try_cast("double"), F.lit(0.0))


def cover_of_probability(p: Column, bare: str = "bare-soil", other: str = "other") -> Column:
    return F.when(p.isNull(), "NODATA").when(p > 0.5, bare).when(p > 0.4, "DOUBT").otherwise(other)


def province(municipality: Column, names: dict[int, str]) -> Column:
    """Name by the municipality code's ten thousands; without a code that of 990000, without a name null."""
    key = (F.floor(F.coalesce(municipality, F.lit(990000)) / 10000) * 10000).cast("long")
    pairs = [F.lit(x) for k, v in names.items() for x in (k, v)]
    return F.try_element_at(F.create_map(*pairs).cast("map<bigint,string>"), key)


def feature_name(profile: Column, start: Column, band: Column, stat: Column) -> Column:
    return F.concat_ws("_", profile, F.date_format(start, "yyyyMMdd"), band, stat)


def slice_name(profile: Column, start: Column, end_incl: Column, bands: Column, reducer: Column) -> Column:
    """Name of an image slice; bands (an array) lose their _ and -."""
    plain = F.array_join(F.transform(bands, lambda b: F.regexp_replace(b, "[_-]", "")), "-")
    return F.concat_ws("_", profile, F.date_format(start, "yyyy-MM-dd"), F.date_format(end_incl, "yyyy-MM-dd"), plain, reducer)


def code_key(code: Column) -> Column:
    """Crop codes as text, whether they come as integers, whole doubles or text."""
    as_number = code.cast("string").try_cast("double")
    whole = as_number.isNotNull() & (as_number == F.floor(as_number)) & ~code.cast("string").startswith("0")
    return F.when(whole, as_number.cast("long").cast("string")).otherwise(F.trim(code.cast("string")))


def has_any(codes: Column, wanted) -> Column:
    """Whether a text of premium codes names one of them."""
    out = F.lit(False)
    for w in wanted:
        out = out | F.coalesce(codes.contains(w), F.lit(False))
    return out
