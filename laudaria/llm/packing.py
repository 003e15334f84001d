"""Filling fixed-capacity containers with items (problem 7).

Bounded-space online best-fit: at most ``open_bins`` containers are open at once; a bitset has one bit per
amount of free space, so the container with the least space that still takes an item is the lowest
set bit at or above the item's size; when an item fits nowhere and all places are taken, the
fullest container closes. Items are dealt to groups of about ``group_items`` by a hash of their id, each
group packs by itself, and its size bounds the memory of a task. The only loss against one long
sequence is what a group's last open containers leave free.

Defined results: a null text is no item; an empty one is an item of size 0; every other row is an item, repeated ids
included; a null id makes an item of null id. An item larger than a capacity is cut: full containers
of its own, the rest packed like any item (``piece`` counts from 0). Null capacities and those below 1 are
left out. No documents or no containers give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.llm.tokens import TOKENIZER, token_counter
from laudaria.runtime import spread

MOST_SIZES = 1000  #: container sizes that one call may try


class BestFit:
    """Bounded-space best-fit for one capacity."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.bits = 0
        self.free: dict[int, list[int]] = {}
        self.n_open = self.n_bins = 0

    def new(self) -> int:
        self.n_bins += 1
        return self.n_bins - 1

    def _take(self, space: int) -> int:
        bins = self.free[space]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        self.n_open -= 1
        return number

    def _keep(self, number: int, space: int) -> None:
        bins = self.free.setdefault(space, [])
        if not bins:
            self.bits |= 1 << space
        bins.append(number)
        self.n_open += 1

    def put(self, size: int) -> int:
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, space = self.new(), self.capacity
        if space > size or size == 0:
            self._keep(number, space - size)
        return number


def _pack(frames: Iterator[pd.DataFrame], sizes: list[tuple[int, int]], open_bins: int) -> Iterator[pd.DataFrame]:
    """Groups arrive one after another, each sorted; (group, item, tokens) to (container size, container, item, piece, tokens)."""
    group, packers = None, {}
    for frame in frames:
        out: list[tuple] = []
        for g, item, tokens in zip(frame["grp"].tolist(), frame["item"].tolist(), frame["tokens"].tolist(), strict=True):
            if g != group:
                group, packers = g, {i: BestFit(c, open_bins) for i, c in sizes}
            item = None if item != item else int(item)
            for i, capacity in sizes:
                packer, piece, rest = packers[i], 0, tokens
                while rest > capacity:
                    out.append((i, capacity, (g << 32) + packer.new(), item, piece, capacity))
                    piece, rest = piece + 1, rest - capacity
                out.append((i, capacity, (g << 32) + packer.put(rest), item, piece, rest))
        yield pd.DataFrame(out, columns=["id_recipiente", "capacidade_tokens", "container", "item", "piece", "tokens"]).astype({"item": "Int64"})


def pack(
    docs: DataFrame,
    sizes: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    open_bins: int = 512,
    group_items: int = 50_000,
) -> DataFrame:
    """One row per item, piece and container size: ``id_recipiente, capacidade_tokens, container, <id>, piece, tokens``.

    ``sizes`` has ``id_recipiente, capacidade_tokens``, at most ``MOST_SIZES`` rows.
    """
    rows = sizes.filter("capacidade_tokens >= 1 and id_recipiente is not null").select("id_recipiente", "capacidade_tokens").distinct().limit(MOST_SIZES + 1).collect()
    if len(rows) > MOST_SIZES:
        raise ValueError(f"more than {MOST_SIZES} container sizes")
    capacities = sorted((int(r[0]), int(r[1])) for r in rows)
    groups = max(1, round(docs.count() / group_items))
    count = token_counter(tokenizer)
    items = spread(docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")))
    items = items.select("item", count("text").alias("tokens")).withColumn("key", F.xxhash64("item", "tokens"))
    items = items.withColumn("grp", F.pmod("key", F.lit(groups)))
    ordered = items.repartition("grp").sortWithinPartitions("grp", "key", "item").select("grp", "item", "tokens")
    schema = "id_recipiente int, capacidade_tokens int, container long, item long, piece int, tokens long"
    return ordered.mapInPandas(lambda f: _pack(f, capacities, open_bins), schema).withColumnRenamed("item", id_col)


def fill(packed: DataFrame) -> DataFrame:
    """Per container size: containers, tokens, and the share of the space that is used."""
    return packed.groupBy("id_recipiente", "capacidade_tokens").agg(
        F.countDistinct("container").alias("containers"),
        F.sum("tokens").alias("tokens"),
        F.round(F.sum("tokens") / (F.countDistinct("container") * F.col("capacidade_tokens")), 6).alias("used"),
    )
