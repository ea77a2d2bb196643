"""Weekly aggregates of observations as they arrive, and slices refreshed by each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import statistics
from ..sources.tables import refresh


def weekly(observations: DataFrame, keys: list[str], value: str = "value", ts: str = "ts", delay: str = "3 days") -> DataFrame:
    """Statistics of Monday-to-Sunday windows; observations later than `delay` are left out. Batch and stream alike."""
    rows = observations.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, delay) if rows.isStreaming else rows
    week = F.window(ts, "7 days", startTime="4 days")  # the epoch began on a Thursday
    out = rows.groupBy(week.alias("week"), *keys).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return out.select(F.col("week.start").cast("date").alias("start_date"), F.col("week.end").cast("date").alias("end_date"), *keys, "count", "mean", "min", "max")


def weekly_statistics(observations: DataFrame, keys: list[str], value: str = "value", ts: str = "ts", delay: str = "3 days") -> DataFrame:
    """All zonal statistics of Monday-to-Sunday windows, the median, majority and minority among them. Batch and stream alike.

    On a stream the state holds the counts of each window's distinct values; when the watermark passes a window's end they go on to
    a second aggregation, which emits its statistics once. Observations later than `delay` are left out.
    """
    rows = observations.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, delay) if rows.isStreaming else rows
    rows = rows.withColumn("week", F.window(ts, "7 days", startTime="4 days"))
    return statistics(rows, ["week", *keys], value)


def weekly_coverage(stats: DataFrame, parcels: int, slices: list[str]) -> DataFrame:
    """Percentages of all parcels that have a row, and a value, in each week's slice; of `weekly_statistics` by parcel and slice."""
    found = stats.groupBy("week", *slices).agg(F.count("*").alias("rows"), F.count_if(F.col("mean").isNull()).alias("nulls"))
    return found.withColumns({"row_pct": F.col("rows") * 100.0 / parcels, "value_pct": (1 - F.col("nulls") / parcels) * 100.0})


def refresh_slices(stream: DataFrame, path: str, by: list[str], checkpoint: str) -> StreamingQuery:
    """Each batch overwrites the slices it holds, and only those: repeating a batch gives the same table."""
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: refresh(df, path, by, force=True) and None).start()
