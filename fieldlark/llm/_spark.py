"""Small helpers that several operators share: scratch tables, guarded broadcasts, skew-safe joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most a few long columns that a guarded broadcast may hold (some 30 MB).
BROADCAST_ROWS = 1_000_000
#: Rows and bytes of an Arrow batch in stored jobs: a task holds a few of them, in the JVM and in its Python workers.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder of spark.checkpoint.dir; where that is unset, in local mode, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[[^,]*\]|\[.*,\s*\d+\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="fieldlark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/fieldlark-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS rows and BATCH_BYTES bytes at most for the jobs that run within; as before afterwards."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage is cut, lost executors cost nothing."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._fieldlark_path = path
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that `scratch` named, and all in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that `stored` made, after their last use."""
    for df in tables:
        removed(df.sparkSession, df._fieldlark_path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a stored table of at most `rows` rows; beyond that the table as it is, for a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out round robin, so that the next join shuffles both its sides and AQE can split a hot key."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hot_join(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Join whose left side may hold a third of its rows under one key; `right` has one row for each key.

    The right side mostly comes from an aggregation over the same key, whose partitioning a join would reuse; dealt out
    anew, both sides are shuffled for the join, and AQE can split the hot key. A left side that already has the key's
    partitioning needs `spread` too.
    """
    return left.join(spread(right), on, how)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id for every node of undirected edges: rows (node, root).

    Large-star and small-star steps alternate until the edges stay the same; every step is an aggregation with
    map-side combine and a skew-safe join, so a node with very many neighbours is dealt with by many tasks.
    """
    spark = edges.sparkSession
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stored(e)
    before = None
    while True:
        # large star: every neighbour above u gets the least of u's neighbourhood
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = hot_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the lower neighbours of u, and u, get the least of them
        large, old = stored(large), e
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        lower = hot_join(large, least, "u")
        e = stored(
            lower.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        dropped(old, large)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
