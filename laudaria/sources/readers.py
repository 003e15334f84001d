"""Sources: tables by run date, lexicons, unit settings, returned sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def by_run(spark: SparkSession, path: str, column: str, run_date: str) -> DataFrame:
    """The rows of one run; where the table is partitioned by the column only that partition is listed."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(run_date).cast("date"))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Ragged lexicon: ``classe, base, variantes`` from a CSV without header, quotes doubled, values over several lines."""
    raw = spark.read.csv(path, header=False, multiLine=True, quote='"', escape='"')
    rest = [F.trim(F.col(f"`{c}`")) for c in raw.columns[2:]]
    variants = F.filter(F.array(*rest), lambda x: x.isNotNull() & (x != "")) if rest else F.array().cast("array<string>")
    return raw.select(F.col(raw.columns[0]).alias("classe"), F.col(raw.columns[1]).alias("base"), variants.alias("variantes"))


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all strings."""
    return spark.read.csv(path, header=True, quote='"', escape='"')


def settings(spark: SparkSession, path: str, enabled_only: bool = True) -> DataFrame:
    """JSON settings over several lines."""
    df = spark.read.option("multiLine", True).json(path)
    return df.filter("enabled") if enabled_only else df


def returned(spark: SparkSession, paths: list[str], names: dict[str, str]) -> DataFrame:
    """Returned sheets: headers renamed, missing columns null, all strings, 'nan' and 'None' null, with the file's name."""
    raw = spark.read.csv(paths, header=True, quote='"', escape='"', multiLine=True)
    have = {c.strip(): c for c in raw.columns}

    def one(header: str, name: str) -> Column:
        if header not in have:
            return F.lit(None).cast("string").alias(name)
        v = F.col(f"`{have[header]}`").cast("string")
        return F.when(F.lower(F.trim(v)).isin("nan", "none", ""), None).otherwise(v).alias(name)

    return raw.select(*(one(h, n) for h, n in names.items()), F.col("_metadata.file_name").alias("arquivo"))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table of the given columns without rows."""
    return spark.createDataFrame([], schema)
