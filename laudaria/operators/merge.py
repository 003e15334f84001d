"""MERGE, UPDATE and DELETE as functions from the old state to the new one.

Source keys must be unique where rows are matched (``ValueError`` isn't raised: the largest row is taken). Null keys never match.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: Mapping[str, Column] | None = None,
    when: Column | None = None,
    insert: bool = True,
    insert_when: Column | None = None,
    delete_when: Column | None = None,
) -> DataFrame:
    """New state of ``target``.

    ``update`` maps columns to values over ``t.<column>`` and ``s.<column>``, applied to matched rows for which ``when`` holds;
    ``insert`` adds rows of the source without a match for which ``insert_when`` holds (over ``s.<column>``);
    ``delete_when`` drops matched rows. One full outer join, or a left one without inserts.
    """
    columns = target.columns
    rest = [c for c in source.columns if c not in keys]
    unique = source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)) if rest else source.select(*keys).distinct()
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), unique.withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full" if insert else "left")
    matched = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    new = F.col("t._t").isNull()
    if insert_when is not None:
        both = both.filter(~new | insert_when)
    if delete_when is not None:
        both = both.filter(~(matched & F.coalesce(delete_when, F.lit(False))))
    apply = matched & (F.coalesce(when, F.lit(False)) if when is not None else F.lit(True))
    out = []
    for c in columns:
        value = F.col(f"t.{c}")
        if update and c in update:
            value = F.when(apply, update[c]).otherwise(value)
        if insert:
            value = F.when(new, F.col(f"s.{c}") if c in unique.columns else F.lit(None)).otherwise(value)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return both.select(*out)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows of the source whose key is new."""
    return merge(target, source, keys)


def fill_null(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Take a column from the source only where the target has none."""
    return merge(target, source, keys, {c: F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")) for c in columns}, insert=False)


def delete_matched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the rows of the target whose key is in the source."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").select(*target.columns)


def set_flag(target: DataFrame, log: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """True where the key is in the log, else as it was."""
    return merge(target, log.select(*keys).distinct(), keys, {flag: F.lit(True)}, insert=False)


def replace_partitions(old: DataFrame, new: DataFrame, keys: list[str], broadcast_rows: int = 10_000) -> DataFrame:
    """Idempotent re-run: the partitions that ``new`` holds are taken from it, the others stay.

    Here a null key is a partition like any other. The distinct keys are counted first and broadcast up to ``broadcast_rows``, else joined by shuffle.
    """
    held = new.select(*(F.col(k).alias(f"_new_{k}") for k in keys)).distinct()
    if held.limit(broadcast_rows + 1).count() <= broadcast_rows:
        held = F.broadcast(held)
    return old.join(held, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys], "left_anti").select(*old.columns).unionByName(new)
