"""Session helpers shared by every operator: table access, lineage cuts, parallelism."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


SMALL_SPLIT = 64 << 20  #: bytes of a split below which a shuffle costs less than tasks that stand idle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; only where that is unset and all runs on this machine (tests), a folder of our own.

    Files of checkpoints are removed with their tables if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="laudaria-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a Python-heavy stage enough tasks where the input has fewer splits than there are cores.

    A large input already has many splits and passes through without a shuffle.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan()
    if re.search(r"\b(?:Join|Aggregate|Repartition|RepartitionByExpression|Window|Sort|Deduplicate|Distinct)\b", plan.toString()):
        # counting the splits of a plan with a shuffle would run it; its size says whether they can be few
        return df.repartition(n) if int(str(plan.stats().sizeInBytes())) < n * SMALL_SPLIT else df
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df
