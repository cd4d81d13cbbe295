"""Sessions and exact deduplication over unbounded message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def message_stream(spark, path: str, ddl: str, max_files: int = 1000) -> DataFrame:
    """A folder of JSON lines as a stream."""
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", max_files).json(path)


def session_stream(events: DataFrame, entity: str, time: str, gap: str = "240 minutes", late: str = "1 day") -> DataFrame:
    """Sessions by native session windows: a gap of exactly the given length still merges. State is kept for ``late`` beyond the newest event."""
    s = events.where(F.col(entity).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late).groupBy(entity, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n_events"), F.min(time).alias("start"), F.max(time).alias("end"))
    return s.select(entity, "start", "end", "n_events")


def first_deliveries(events: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Drops repeated deliveries that arrive within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def write_once(df: DataFrame, path: str, checkpoint: str):
    """Appends to Parquet exactly once, for all data that is there, then ends."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
