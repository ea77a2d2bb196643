"""Deterministic sampling: folds, test splits and class balancing with exact quotas.

Random order is the order of md5(seed, id), which every engine computes alike. Ranks within a class are made in two levels: rows
fall into ordered buckets, a table of (class, bucket) counts gives each bucket its first rank, and only a bucket is sorted. A class that
holds most of the rows is dealt with by as many tasks as there are buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import starts, within


def shuffled(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_counts(rows: DataFrame, class_col: str) -> DataFrame:
    return rows.groupBy(class_col).agg(F.count("*").alias("n"))


def hash_bucket(hashed: Column) -> Column:
    """The order's first two hexadecimal digits: BUCKETS even buckets of a hash."""
    return F.conv(F.substring(hashed, 1, 2), 16, 10).cast("int")


def range_bucket(rows: DataFrame, column: str, buckets: int = 64) -> Column:
    """Buckets in the order of a column, with bounds from a bounded sample of its values; the bounds change no rank.

    The sample is of the values whose hash is low, taken where the rows are read, without a shuffle; of a small table all.
    """
    wanted, known = 20 * buckets, rows.where(F.col(column).isNotNull()).select(column)
    n = known.count()
    low = known.where(F.pmod(F.xxhash64(column), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, wanted / max(n, 1))))
    values = sorted({r[0] for r in low.limit(4 * wanted).collect()})
    bounds = [values[i * len(values) // buckets] for i in range(1, buckets)] if len(values) >= buckets else values
    kind = f"array<{rows.schema[column].dataType.simpleString()}>"
    return F.size(F.filter(F.array(*map(F.lit, bounds)).cast(kind), lambda b: b <= F.col(column))) if bounds else F.lit(0)


def ranked(rows: DataFrame, class_col: str, order: list[Column | str], bucket: Column) -> DataFrame:
    """Columns _rank (from 1, in `order`) and _n (rows of the class); `bucket` rises with the order."""
    rows = rows.withColumn("_b", F.coalesce(bucket, F.lit(-1)))
    counts = rows.groupBy(F.col(class_col).alias("_c"), "_b").agg(F.count("*").alias("_m"))
    w = Window.partitionBy("_c")  # of at most one row for each bucket
    first = counts.select("_c", F.col("_b").alias("_bb"), F.sum("_m").over(w).alias("_n"), (F.sum("_m").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")).alias("_before"))
    joined = rows.join(first, F.col(class_col).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_bb")))
    own = F.row_number().over(Window.partitionBy(class_col, "_b").orderBy(*order))
    return joined.withColumn("_rank", F.col("_before") + own).drop("_b", "_bb", "_c", "_before")


def by_hash(rows: DataFrame, class_col: str, id_col: str, seed: str) -> DataFrame:
    """`ranked` in random order."""
    h = shuffled(id_col, seed)
    return ranked(rows, class_col, [h, id_col], hash_bucket(h))


def fold_ids(rows: DataFrame, k: int, class_col: str, id_col: str = "uid", name: str = "fold") -> DataFrame:
    """Folds 0..k-1 whose sizes differ by one at most within each class, in id order."""
    out = ranked(rows, class_col, [id_col], range_bucket(rows, id_col))
    return out.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def test_split(rows: DataFrame, share: float, class_col: str, id_col: str = "uid", seed: str = "test") -> DataFrame:
    """A flag `is_test` on round(share * n) rows of each class, halves to even."""
    return by_hash(rows, class_col, id_col, seed).withColumn("is_test", F.col("_rank") <= F.bround(share * F.col("_n"), 0)).drop("_rank", "_n")


def training_candidates(rows: DataFrame, least_pixels: int, not_for_training: list[str], ignored: list[str], class_col: str = "classname") -> DataFrame:
    """Rows with enough pixels and a usable class; an error if an IGNORE class remains among them."""
    ok = (F.col("pixcount") >= least_pixels) & ~within(F.col(class_col), not_for_training) & ~within(F.col(class_col), ignored)
    if "ignore_for_training" in rows.columns:
        ok = ok & (F.col("ignore_for_training") == 0)
    kept = rows.where(ok)
    bad = kept.where(starts(F.col(class_col), "IGNORE")).select(class_col).limit(1).collect()
    if bad:
        raise ValueError(f"class {bad[0][0]} is left among the training rows")
    return kept


def predictable(rows: DataFrame, ignored: list[str], declared_col: str = "classname_declared") -> DataFrame:
    """Rows whose declared class isn't ignored; without a declared class they stay."""
    return rows.where(~within(F.col(declared_col), ignored))


@dataclass(frozen=True)
class Tier:
    """Classes of `least` rows or more (and of less than the tier before) give `quota` rows, all if None; `again`: with replacement."""

    least: int
    quota: int | None
    again: bool = False


# Class sizes and quotas of the balancing strategies.
STRATEGIES = {
    "MEDIUM": (Tier(10000, 10000), Tier(1000, None), Tier(0, 1000, True)),
    "MEDIUM2": (Tier(100000, 30000), Tier(50000, 20000), Tier(20000, 10000), Tier(10000, 10000), Tier(1000, None), Tier(0, 1000, True)),
    "PROPORTIONAL_GROUPS": (Tier(100000, 30000), Tier(50000, 20000), Tier(20000, 10000), Tier(10000, 5000), Tier(0, None)),
    "UPPER_LIMIT": (Tier(10000, 10000), Tier(0, None)),
    "EQUAL": (Tier(0, 2000, True),),
    "ALL": (Tier(0, None),),
}
NONE_SHARE = 0.25


def balanced(rows: DataFrame, tiers: tuple[Tier, ...], class_col: str, id_col: str = "uid", seed: str = "train") -> DataFrame:
    """The quota of every class. A draw with replacement picks the rank that a hash of (seed, class, draw) names.

    `draw` numbers the copies of a row; without replacement it is 1.
    """
    rows = by_hash(rows, class_col, id_col, seed)
    tier = F.when(F.lit(False), 0)
    for i, t in enumerate(tiers):
        tier = tier.when(F.col("_n") >= t.least, i)
    rows = rows.withColumn("_tier", tier)
    once = F.lit(False)
    for i, t in enumerate(tiers):
        if not t.again:
            once = once | ((F.col("_tier") == i) & (F.lit(True) if t.quota is None else F.col("_rank") <= t.quota))
    out = rows.where(once).withColumn("draw", F.lit(1))
    if any(t.again for t in tiers):
        wanted = F.when(F.lit(False), 0)
        for i, t in enumerate(tiers):
            if t.again:
                wanted = wanted.when(F.col("_tier") == i, t.quota)
        sizes = rows.groupBy(class_col).agg(F.first("_n").alias("_m"), F.first(wanted).alias("_wanted")).where("_wanted is not null")
        draws = sizes.select(class_col, "_m", F.explode(F.sequence(F.lit(1), F.col("_wanted"))).alias("draw"))
        text = F.md5(F.concat_ws(":", F.lit(seed), F.col(class_col), F.col("draw").cast("string")))
        pick = F.conv(F.substring(text, 1, 12), 16, 10).cast("long")
        draws = draws.select(class_col, "draw", (F.pmod(pick, F.col("_m")) + 1).cast("int").alias("_rank"))
        out = out.unionByName(rows.join(draws, [class_col, "_rank"]).select(*rows.columns, "draw"))
    return out.drop("_n", "_rank", "_tier")


def balance(rows: DataFrame, strategy: str, class_col: str, id_col: str = "uid", seed: str = "train") -> DataFrame:
    """A named strategy; NONE takes a fixed share of each class."""
    if strategy == "NONE":
        return test_split(rows, NONE_SHARE, class_col, id_col, seed).where("is_test").drop("is_test").withColumn("draw", F.lit(1))
    return balanced(rows, STRATEGIES[strategy], class_col, id_col, seed)


def split_folds(rows: DataFrame, fold: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(rows a fold's model learns from, rows it predicts)."""
    return rows.where(F.col(name) != fold), rows.where(F.col(name) == fold)
