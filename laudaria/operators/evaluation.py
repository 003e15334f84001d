"""Quality of predictions against labels: counts in Spark, small statistics from the counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, predicted: Column, actual: Column, keys: list[str] | None = None) -> DataFrame:
    """``tp, fp, fn, tn`` in one pass; rows with a null on either side are left out."""
    own = df.filter(predicted.isNotNull() & actual.isNotNull())
    counts = [F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn")]
    return own.groupBy(*(keys or [])).agg(*counts)


def metrics(c: DataFrame, beta: float = 2.0, digits: int = 6) -> DataFrame:
    """Precision, recall, F-beta, specificity, negative predictive value and kappa; null where a denominator is 0."""
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.round(a / F.nullif(b, F.lit(0.0)), digits)
    n = tp + fp + fn + tn
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / F.nullif(n * n, F.lit(0.0))
    agree = (tp + tn) / F.nullif(n, F.lit(0.0))
    b = beta * beta
    return c.withColumns({"precisao": over(tp, tp + fp), "revocacao": over(tp, tp + fn), "f_beta": over((1 + b) * tp, (1 + b) * tp + b * fn + fp), "especificidade": over(tn, tn + fp), "vpn": over(tn, tn + fn), "kappa": F.round((agree - chance) / F.nullif(1 - chance, F.lit(0.0)), digits)})


def mcnemar(b: int, c: int) -> tuple[float, float]:
    """Statistic with continuity correction, and its p-value, from the two counts of disagreement."""
    if b + c == 0:
        return 0.0, 1.0
    x = max(0, abs(b - c) - 1) ** 2 / (b + c)
    return x, math.erfc(math.sqrt(x / 2))


def cochran_q(df: DataFrame, outcomes: list[str]) -> DataFrame:
    """Cochran's Q of several 0/1 outcomes on the same rows; null where no row disagrees."""
    k = len(outcomes)
    row = sum((F.col(c) for c in outcomes), F.lit(0))
    sums = df.select(*outcomes, row.alias("_r")).agg(*(F.sum(c).alias(c) for c in outcomes), F.sum("_r").alias("_n"), F.sum(F.col("_r") * F.col("_r")).alias("_n2"))
    squares = sum((F.col(c) * F.col(c) for c in outcomes), F.lit(0))
    return sums.select(F.round((k - 1) * (k * squares - F.col("_n") * F.col("_n")) / F.nullif(k * F.col("_n") - F.col("_n2"), F.lit(0)).cast("double"), 6).alias("q"))


def bootstrap(df: DataFrame, value: str, rounds: int = 200, seed: int = 7) -> DataFrame:
    """Mean with a 95 % interval from Poisson resampling: every row is weighted in each round where it lies, so one pass and no copies."""
    draw = F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda i: F.pmod(F.xxhash64(F.col("_id"), i, F.lit(seed)), F.lit(1_000_000)) / 1e6)
    weight = lambda u: F.when(u < 0.367879, 0).when(u < 0.735759, 1).when(u < 0.919699, 2).when(u < 0.981012, 3).when(u < 0.996340, 4).otherwise(5)
    own = df.select(F.col(value).cast("double").alias("v"), F.xxhash64(*df.columns).alias("_id")).filter("v is not null").withColumn("w", F.transform(draw, weight))
    per = own.select("v", F.posexplode("w").alias("round", "w")).groupBy("round").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("m"))
    return per.agg(F.round(F.avg("m"), 6).alias("media"), F.round(F.percentile("m", 0.025), 6).alias("baixo"), F.round(F.percentile("m", 0.975), 6).alias("alto"))
