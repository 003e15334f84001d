"""Row selection, incremental loading, lookups and sampling as pure DataFrame functions.

Every ranking takes a total order, so results don't depend on how rows are spread. Ranks are window functions over the key only;
``latest`` is an aggregate (``max_by``), which combines before the shuffle and so bears a key that holds a third of all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one largest in ``order`` (nulls smallest), ties settled by the other columns.

    Null keys form a key of their own. An empty table gives an empty table.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*(F.struct(F.col(c).isNotNull(), F.col(c)) for c in [*order, *sorted(c for c in rest if c not in order and df.schema[c].dataType.typeName() != "map")]))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns)


def older(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """All rows but the first of each key in ``order``: what goes to history."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n > 1").drop("_n")


def rank_within(df: DataFrame, keys: list[Column | str], order: list[Column], name: str = "ordem") -> DataFrame:
    """Number the rows of each key from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def flag_first(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Keep all rows; 1 on the first of each key, else 0."""
    return rank_within(df, keys, order, "_n").withColumn(name, F.when(F.col("_n") == 1, 1).otherwise(0)).drop("_n")


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Incremental insert: rows of ``source`` whose key isn't in ``target``; rows with a null key are new."""
    return source.join(target.select(*keys).distinct(), keys, "left_anti")


def not_in(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """As ``NOT IN``, three-valued: nothing if the target holds a null key; rows with a null key go unless the target is empty."""
    known = target.select(F.col(key).alias("_k"))
    state = F.broadcast(known.agg(F.count("*").alias("_rows"), F.count_if(F.col("_k").isNull()).alias("_nulls")))
    kept = source.join(known.filter("_k is not null").distinct(), F.col(key) == F.col("_k"), "left_anti")
    return kept.join(state, F.lit(True)).filter(((F.col("_nulls") == 0) & F.col(key).isNotNull()) | (F.col("_rows") == 0)).drop("_rows", "_nulls")


def eliminate(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Cascading elimination: out goes a row that matches ``known`` by the first key, else by the second, and so on."""
    return reduce(lambda out, k: out.join(known.select(k).filter(F.col(k).isNotNull()).distinct(), k, "left_anti"), keys, df).select(*df.columns)


def lookup(df: DataFrame, table: DataFrame, key: str, fallback: str, value: str) -> DataFrame:
    """Two-step lookup: by key; what isn't found, by the fallback column. The smallest value stands for a key that has several."""
    by_key = table.groupBy(F.col(key).alias("_k")).agg(F.min(value).alias("_v1"))
    by_name = table.groupBy(F.col(fallback).alias("_f")).agg(F.min(value).alias("_v2"))
    out = df.join(by_key, F.col(key) == F.col("_k"), "left").join(by_name, F.col(fallback) == F.col("_f"), "left")
    return out.withColumn(value, F.coalesce("_v1", "_v2")).drop("_k", "_f", "_v1", "_v2")


def spine(units: DataFrame, first: Column | str, last: Column | str, day: str = "dia") -> DataFrame:
    """Every unit on every day: the days are generated in each row, nothing is joined."""
    return units.withColumn(day, F.explode(F.sequence(F.to_date(first), F.to_date(last))))


def restrict(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """The rows of a large dimension that are in play."""
    return dimension.join(facts.select(key).distinct(), key, "left_semi")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key (Spark limits each task's part before the shuffle)."""
    return rank_within(df, keys, order, "_n").filter(F.col("_n") <= k).drop("_n")


def stratified(df: DataFrame, strata: list[str], identity: list[str], k: int) -> DataFrame:
    """k rows of each stratum, chosen by a hash of their identity: the same at every run."""
    return top_k(df, strata, [F.md5(F.concat_ws("|", *identity)), *(F.col(c) for c in identity)], k)


def first_only(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Keep all rows, but the given columns only on the first of each key."""
    ranked = rank_within(df, keys, order, "_n")
    return ranked.withColumns({c: F.when(F.col("_n") == 1, F.col(c)) for c in columns}).drop("_n")


def joined_unique(df: DataFrame, keys: list[str], value: str, order: str, name: str, separator: str = " //-// ") -> DataFrame:
    """Distinct non-blank values of each key in order of first occurrence, as one string."""
    first = df.filter(F.length(F.trim(value)) > 0).groupBy(*keys, F.trim(value).alias("_v")).agg(F.min(order).alias("_o"))
    return first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]), separator).alias(name))
