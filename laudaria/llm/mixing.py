"""Mixing sources to target weights (problem 8).

Systematic sampling: within a source every record expects the same number of copies; the running sum
of the expected copies plus one random offset crosses an integer as often as the record is
used. The total is the largest at which no source needs a record more often than it may be used, unless one is given.

The running sum is made in two levels: records fall into blocks of about ``block_rows`` by a hash of their id, block
counts are summed over the blocks of a source, and each block adds its own places. So a source that
holds a third of all rows is no one task. Within a block records go by size, which keeps the sampled
sizes close to those of the source.

Defined results: records with a null id, a null or empty text, a null source or a source without a
positive weight are not used. The weights of sources that have no tokens are shared out among the others in proportion; the report
shows both. Repeated ids are separate records. Repeated weight rows count once, the largest. No records or weights: an empty selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laudaria.llm.tokens import TOKENIZER, token_counter
from laudaria.runtime import cut, spread

MOST_SOURCES = 10_000  #: weighted sources that one call may mix


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokenizer: str = TOKENIZER) -> DataFrame:
    """``id, source, tokens`` of the records that can be used, written once."""
    count = token_counter(tokenizer)
    own = docs.filter(F.col(id_col).isNotNull() & F.col(source_col).isNotNull() & (F.length(text_col) > 0))
    own = spread(own.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")))
    return cut(own.select("id", "source", count("text").alias("tokens")))


def plan(records: DataFrame, weights: DataFrame, total: float | None = None) -> list[tuple]:
    """Per weighted source: (source, weight, weight among those present, uses allowed, records, tokens, expected copies)."""
    w = weights.filter("peso > 0 and max_repeticoes >= 1 and source is not null").groupBy("source").agg(F.max("peso").alias("peso"), F.max("max_repeticoes").alias("most"))
    have = records.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    rows = w.join(have, "source", "left").fillna(0, ["n", "tokens"]).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} weighted sources")
    present = sum(r["peso"] for r in rows if r["tokens"] > 0)
    limits = [r["most"] * r["tokens"] * present / r["peso"] for r in rows if r["tokens"] > 0]
    size = min([*limits, *([total] if total is not None else [])], default=0.0)
    out = []
    for r in sorted(rows, key=lambda r: r["source"]):
        share = r["peso"] / present if r["tokens"] > 0 else 0.0
        copies = min(float(r["most"]), size * share / r["tokens"]) if r["tokens"] > 0 else 0.0
        out.append((r["source"], float(r["peso"]), share, int(r["most"]), int(r["n"]), int(r["tokens"]), copies))
    return out


def mix(records: DataFrame, planned: list[tuple], seed: int = 7, block_rows: int = 20_000) -> DataFrame:
    """``id, source, tokens, copies`` of every record used at least once."""
    spark = records.sparkSession
    rates = spark.createDataFrame(
        [(s, most, e, max(1, round(n / block_rows))) for s, _, _, most, n, _, e in planned if e > 0], "source string, most int, expected double, blocks int"
    )
    own = records.join(F.broadcast(rates), "source").withColumn("key", F.xxhash64("id", F.lit(seed))).withColumn("block", F.pmod("key", F.col("blocks")))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # blocks, not records
    offsets = own.groupBy("source", "block").agg(F.count("*").alias("k")).select("source", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("ahead"))
    place = Window.partitionBy("source", "block").orderBy("tokens", "key", "id")
    at = own.join(offsets, ["source", "block"]).withColumn("rank", F.col("ahead") + F.row_number().over(place))
    start = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(start + F.col("rank") * F.col("expected")) - F.floor(start + (F.col("rank") - 1) * F.col("expected"))
    return at.select("id", "source", "tokens", F.least(copies, F.col("most")).cast("int").alias("copies")).filter("copies > 0")


def report(mixed: DataFrame, planned: list[tuple]) -> DataFrame:
    """Per weighted source: its weight, target and reached share of the total size, tokens and records there and used, most uses of one record."""
    spark = mixed.sparkSession
    plan_df = spark.createDataFrame(
        [(s, p, share, n, t) for s, p, share, _, n, t, _ in planned], "source string, peso double, target_share double, records long, tokens_available long"
    )
    used = mixed.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens_used"), F.count("*").alias("records_used"), F.sum("copies").alias("copies_used"), F.max("copies").alias("most_copies")
    )
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per weighted source
    return (
        F.broadcast(plan_df)
        .join(used, "source", "left")
        .fillna(0)
        .withColumn("actual_share", F.round(F.col("tokens_used") / F.nullif(F.sum("tokens_used").over(every), F.lit(0)), 6))
        .select("source", "peso", F.round("target_share", 6).alias("target_share"), "actual_share", "records", "tokens_available", "records_used", "copies_used", "most_copies", "tokens_used")
    )
