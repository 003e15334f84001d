"""Daily series: running statistics, spikes, inactivity, drift. Windows are over one unit's days, not over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laudaria.operators.relational import spine


def running_mean(df: DataFrame, keys: list[str], day: str, value: str, name: str) -> DataFrame:
    """Mean of all days of a key so far."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.avg(value).over(w))


def rolling_sum(df: DataFrame, keys: list[str], day: str, value: str, n: int, name: str, least: int = 1) -> DataFrame:
    """Sum of the last n days; null while fewer than ``least`` are there."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.when(F.count(F.lit(1)).over(w) >= least, F.sum(value).over(w)))


def difference(df: DataFrame, keys: list[str], day: str, value: str, name: str) -> DataFrame:
    """Change from the day before that has a row."""
    return df.withColumn(name, F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(day)))


def spikes(daily: DataFrame, keys: list[str], day: str, value: str, up: tuple[float, float], down: tuple[float, float], length: int = 3) -> DataFrame:
    """Mark the last day of each block of ``length`` days that all lie above (or below) the running mean by both limits.

    ``up`` and ``down`` are (per cent, absolute). Blocks don't overlap and are counted within a key, so they never join two units;
    a last short block marks nothing. Adds ``media``, ``sinalizacao`` ('Aumento', 'Queda', 'Estável').
    """
    order = Window.partitionBy(*keys).orderBy(day)
    out = running_mean(daily, keys, day, value, "media").withColumn("_b", F.floor((F.row_number().over(order) - 1) / length))
    v, m = F.col(value), F.col("media")
    high = ((v >= m * (1 + up[0] / 100)) | (m <= 0)) & (v - m >= up[1])
    low = ((m >= v * (1 + down[0] / 100)) | (v <= 0)) & (m - v >= down[1])
    block = Window.partitionBy(*keys, "_b")
    out = out.withColumns({"_n": F.count(F.lit(1)).over(block), "_last": F.max(day).over(block), "_h": F.min(high.cast("int")).over(block), "_l": F.min(low.cast("int")).over(block)})
    here = (F.col("_n") == length) & (F.col(day) == F.col("_last"))
    mark = F.when(here & (F.col("_h") == 1), "Aumento").when(here & (F.col("_l") == 1), "Queda").otherwise("Estável")
    return out.withColumn("sinalizacao", mark).drop("_b", "_n", "_last", "_h", "_l")


def inactivity(daily: DataFrame, unit: str, day: str, value: str, first: str, last: str, quiet: int = 3, recent: int = 15, least: int = 10, days_back: int = 2) -> DataFrame:
    """Units without anything for ``quiet`` days that had at least ``least`` in the last ``recent``, seen on the last ``days_back`` days and today."""
    full = spine(daily.select(unit).distinct(), F.lit(first), F.lit(last), day).join(daily.select(unit, day, value), [unit, day], "left").fillna(0, [value])
    out = rolling_sum(full, [unit], day, value, quiet, "_q", quiet)
    out = rolling_sum(out, [unit], day, value, recent, "atividade_recente")
    return out.filter((F.col("_q") == 0) & (F.col("atividade_recente") >= least) & (F.col(day) >= F.date_sub(F.lit(last).cast("date"), days_back))).drop("_q")


def against_mean(daily: DataFrame, day: str, value: str, margin: float = 0.0) -> DataFrame:
    """Each day against the mean of its year: 'Aumento', 'Queda' or 'Estável'."""
    means = daily.groupBy(F.year(day).alias("ano")).agg(F.avg(value).alias("media"))
    out = daily.withColumn("ano", F.year(day)).join(F.broadcast(means), "ano")
    return out.withColumn("situacao", F.when(F.col(value) > F.col("media") * (1 + margin), "Aumento").when(F.col(value) < F.col("media") * (1 - margin), "Queda").otherwise("Estável"))


def drift(daily: DataFrame, keys: list[str], day: str, value: str, days: int = 7) -> DataFrame:
    """Mean and deviation of the days before, and how far today is from them."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(-days, -1)
    out = daily.withColumns({"media_anterior": F.avg(value).over(w), "desvio_anterior": F.stddev_pop(value).over(w)})
    return out.withColumn("variacao", (F.col(value) - F.col("media_anterior")) / F.nullif(F.col("media_anterior"), F.lit(0.0)))


def alerts(drifted: DataFrame, value: str, relevance: float = 0.15, volume: float = 0.20, deviations: float = 2.0) -> DataFrame:
    """Flags of a drifted series: rate moved, volume fell, more than some deviations away."""
    far: Column = F.abs(F.col(value) - F.col("media_anterior")) > deviations * F.col("desvio_anterior")
    return drifted.withColumns({"alerta_taxa": F.coalesce(F.abs("variacao") > relevance, F.lit(False)), "alerta_volume": F.coalesce(F.col("variacao") < -volume, F.lit(False)), "alerta_desvio": F.coalesce(far, F.lit(False))})
