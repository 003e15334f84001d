"""The keyed operators over streams: rows of a late load are dropped once per key, volumes are counted by window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(stream: DataFrame, keys: list[str], time: str, late: str = "2 days") -> DataFrame:
    """One row per key among rows no later than ``late``; state older than that is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def volumes(stream: DataFrame, keys: list[str], time: str, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows of each key and window, once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, every), *keys).agg(F.count("*").alias("linhas"))


def run_once(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    """Process what is there and stop."""
    return df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
