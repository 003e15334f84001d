"""Sinks: partitioned, idempotent, per unit, and compaction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, by: str) -> None:
    """Append to a partitioned table; new columns are merged on reading."""
    df.write.mode("append").partitionBy(by).parquet(path)


def overwrite_run(df: DataFrame, path: str, by: list[str]) -> None:
    """Write again whatever partitions the rows belong to, leave the others: running twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def export_shape(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns renamed and in the order of the mapping, ready for a sheet writer; missing ones are null."""
    return df.select(*(F.col(c).cast("string").alias(n) if c in df.columns else F.lit(None).cast("string").alias(n) for c, n in names.items()))


def per_unit(df: DataFrame, units: DataFrame, unit: str) -> tuple[DataFrame, DataFrame]:
    """Rows of enabled units, and how many rows each enabled unit gets, those without any included."""
    on = units.filter("enabled and unidades is not null").select(F.col("unidade").alias(unit)).distinct()
    return df.join(on, unit, "left_semi"), on.join(df.groupBy(unit).agg(F.count("*").alias("linhas")), unit, "left").fillna(0, ["linhas"])


def write_per_unit(df: DataFrame, path: str, unit: str) -> None:
    """A folder for each unit; rows of one unit come from many tasks, so a unit that holds a third of all rows isn't one task."""
    df.write.mode("overwrite").partitionBy(unit).parquet(path)


def of_unit(df: DataFrame, unit: str, wanted: str) -> DataFrame:
    """The rows of one unit; ``todas`` asks for all, those without a unit included."""
    return df if wanted == "todas" else df.filter(F.col(unit) == wanted)


def single_file(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One file, for small exports."""
    w = df.coalesce(1).write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)


def compact(spark: SparkSession, path: str, to: str, files: int, by: str | None = None) -> None:
    """Write a table again in fewer files."""
    df = spark.read.parquet(path).repartition(files)
    (df.write.mode("overwrite").partitionBy(by) if by else df.write.mode("overwrite")).parquet(to)


def payload(df: DataFrame, columns: list[str], name: str = "payload") -> DataFrame:
    """A message for each row as JSON; nothing is sent."""
    return df.withColumn(name, F.to_json(F.struct(*columns)))
