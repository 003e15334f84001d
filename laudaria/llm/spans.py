"""Long exact spans shared between records (problem 9).

A sparse de Bruijn graph over token k-mers. Nodes are the token k-mers that are smallest in some
stretch of ``reach`` characters (minimizers), an edge is the text between neighbouring nodes, and the
chain of edges that covers the next ``core`` characters from a node is compacted to one key. A shared run of
``min_chars`` always holds a node that both records choose with the whole compacted chain behind
it, so joining equal keys loses no run. The source coordinates of repeated chains then
verify: every ``min_chars`` window that can lie on a repeated chain is compared in full (95 bits of
two independent polynomial hashes), and its characters are counted.

No pair of records is ever formed: keys and windows are counted per distinct record, so a group of copies that
holds a third of all rows costs as much as other rows of its length. Of records with the same
whole text only one has its windows compared.

Defined results: a null or empty text, or one shorter than ``min_chars``, shares nothing (0
characters, not found). Rows of one ``doc_id`` are one record and never count against each other. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.runtime import cut, spread

LONG_TOKEN = 32  #: words longer than this are taken apart into characters
K = 4  #: tokens in a k-mer
_P64 = np.uint64(0x9E3779B97F4A7C15 | 1)
_P31, _B31 = 2147483647, 1315423911 % 2147483647


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers of both bases and of their inverses, up to n."""
    inv64 = pow(int(_P64), -1, 1 << 64)
    inv31 = pow(_B31, -1, _P31)
    with np.errstate(over="ignore"):
        a = np.cumprod(np.full(n + 1, _P64, np.uint64)) * np.uint64(inv64)
        b = np.cumprod(np.full(n + 1, np.uint64(inv64), np.uint64)) * _P64

    def mod(base: int) -> np.ndarray:
        out = np.ones(n + 1, np.uint64)
        size, step = 1, base
        while size <= n:
            m = min(size, n + 1 - size)
            out[size : size + m] = out[:m] * np.uint64(step) % np.uint64(_P31)
            size, step = size * 2, step * step % _P31
        return out

    return a, b, mod(_B31), mod(inv31)


class _Hashes:
    """Hashes of any slice of an array of code points, all slices of one call at once."""

    def __init__(self, code: np.ndarray, second: bool):
        n = len(code)
        self.up, self.down, self.up31, self.down31 = _powers(n)
        x = code.astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            mixed = (x ^ (x << np.uint64(21))) * np.uint64(0xD6E8FEB86659FD93)
            self.sum64 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.up[:n])])
        self.sum31 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.up31[:n] % np.uint64(_P31))]) if second else None

    def h64(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sum64[e] - self.sum64[s]) * self.down[s]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(32))

    def h31(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return ((self.sum31[e] - self.sum31[s]) % np.uint64(_P31) * self.down31[s] % np.uint64(_P31)).astype(np.int32)


_WORD = np.zeros(0x10000, bool)
_WORD[[i for i in range(0x10000) if chr(i).isalnum()]] = True


def _token_starts(code: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where tokens begin: words of at most LONG_TOKEN characters, any other character by itself."""
    word = _WORD[np.minimum(code, 0xFFFF)]
    begins = ~word
    begins[1:] |= ~word[:-1]
    begins |= fresh
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(code)))
    long = np.repeat(length > LONG_TOKEN, length)
    return begins | long


def _nodes(code: np.ndarray, fresh: np.ndarray, hashes: _Hashes, reach: int) -> np.ndarray:
    """Positions of the minimizers: token k-mers smallest within some ``reach`` characters."""
    n = len(code)
    starts = np.flatnonzero(_token_starts(code, fresh))
    if len(starts) <= K:
        return starts[:0]
    value = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    value[starts[:-K]] = hashes.h64(starts[:-K], starts[K:]) >> np.uint64(1)
    # smallest of each window by doubling
    low, size = value.copy(), 1
    while size * 2 <= reach:
        low[: n - size] = np.minimum(low[: n - size], low[size:])
        size *= 2
    if n <= reach:
        return starts[:0]
    m = np.minimum(low[: n - reach + 1], low[reach - size : n - size + 1])
    # a position is chosen if its value is the smallest of a window that holds it: largest of the minima
    m = np.concatenate([np.zeros(reach - 1, np.uint64), m, np.zeros(reach - 1, np.uint64)])
    high, size = m, 1
    while size * 2 <= reach:
        high = np.maximum(high[:-size], high[size:])
        size *= 2
    best = np.maximum(high[:n], high[reach - size : reach - size + n])
    return np.flatnonzero((value == best) & (value != np.uint64(0xFFFFFFFFFFFFFFFF)))


def _chunks(ids: np.ndarray, texts: list[str], most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, code points of the texts one after another, offsets), about ``most`` characters at a time."""
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= most):
            total += len(texts[j])
            j += 1
        code = np.frombuffer("".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts[i:j]])])
        yield ids[i:j], code, offsets
        i = j


def _geometry(min_chars: int) -> tuple[int, int]:
    """(reach, core): from any run of min_chars a node and its next ``core`` characters lie inside it in each record."""
    reach = (min_chars - LONG_TOKEN - 1 - (K + 1) * LONG_TOKEN) // 2
    reach = min(reach, min_chars // 4)
    if reach < 8:
        raise ValueError(f"min_chars must be at least {LONG_TOKEN + 1 + (K + 1) * LONG_TOKEN + 16}")
    return reach, min_chars - LONG_TOKEN - 1 - reach


def _paths(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Compacted chains: (key, rep, at)."""
    reach, core = _geometry(min_chars)
    for batch in batches:
        for ids, code, off in _chunks(batch.column(0).to_numpy(), batch.column(1).to_pylist()):
            fresh = np.zeros(len(code), bool)
            fresh[off[:-1]] = True
            hashes = _Hashes(code, second=False)
            at = _nodes(code, fresh, hashes, reach)
            doc = np.searchsorted(off, at, side="right") - 1
            keep = at + core <= off[doc + 1]
            at, doc = at[keep], doc[keep]
            key = hashes.h64(at, at + core).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[doc]), pa.array((at - off[doc]).astype(np.int32))], ["key", "rep", "at"])


def _windows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Every window that can lie on a repeated chain: (h, g, rep, at)."""
    reach, _ = _geometry(min_chars)
    for batch in batches:
        spots = batch.column(2).to_pylist()
        done = 0
        for ids, code, off in _chunks(batch.column(0).to_numpy(), batch.column(1).to_pylist()):
            starts, doc = [], []
            for i in range(len(ids)):
                n = off[i + 1] - off[i]
                mark = np.zeros(n + 2, np.int32)
                for a in spots[done + i]:
                    lo, hi = max(0, a - LONG_TOKEN - 1 - reach), min(a, n - min_chars)
                    if lo <= hi:
                        mark[lo] += 1
                        mark[hi + 1] -= 1
                s = np.flatnonzero(np.cumsum(mark[: n + 1]) > 0)
                starts.append(s + off[i])
                doc.append(np.full(len(s), i))
            done += len(ids)
            s, d = np.concatenate(starts), np.concatenate(doc)
            hashes = _Hashes(code, second=True)
            e = s + min_chars
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.h64(s, e).astype(np.int64)), pa.array(hashes.h31(s, e)), pa.array(ids[d]), pa.array((s - off[d]).astype(np.int32))],
                ["h", "g", "rep", "at"],
            )


def shared_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 400, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Per record: its length, the characters that lie in a run of ``min_chars`` or more also found in another record, and how many runs.

    Columns ``id_col, n_chars, shared_chars, n_spans``: one row per distinct non-null id. The table of
    repeated chains (20 bytes a row) is broadcast up to ``broadcast_rows`` rows, counted first; beyond that the texts are shuffled to it.
    """
    keyed = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    long = keyed.filter(F.col("n") >= min_chars)
    # records of one text: the smallest id stands for them in the windows below
    members = long.select("rep", "n", F.md5("text").alias("copy"))
    copies = members.groupBy("copy").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    copied = cut(members.join(copies, "copy").select("rep", "n", "lo").distinct())
    paths = spread(long.select("rep", "text")).mapInArrow(lambda b: _paths(b, min_chars), "key long, rep long, at int")
    repeated = paths.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("key")
    spots = paths.join(repeated, "key", "left_semi").join(copied.filter("rep > lo").select("rep"), "rep", "left_anti")
    spots = cut(spots.groupBy("rep").agg(F.array_distinct(F.collect_list("at")).alias("spots"), F.count("*").alias("k")))
    rows = spots.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    chains = F.broadcast(spots.drop("k")) if rows <= broadcast_rows else spots.drop("k")
    on = spread(long.select("rep", "text").join(chains, "rep"))
    windows = on.mapInArrow(lambda b: _windows(b, min_chars), "h long, g int, rep long, at int").repartition("h", "g")
    twice = windows.groupBy("h", "g").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("h", "g")
    runs = (
        windows.join(twice, ["h", "g"], "left_semi")
        .groupBy("rep")
        .agg(F.array_sort(F.array_distinct(F.collect_list("at"))).alias("at"))
        .select("rep", F.aggregate("at", F.struct(F.lit(-1).alias("last"), F.lit(0).alias("chars"), F.lit(0).alias("spans")), lambda s, x: _step(s, x, min_chars)).alias("r"))
        .select("rep", F.col("r.chars").alias("chars"), F.col("r.spans").alias("spans"))
    )
    whole = copied.select("rep", F.col("n").alias("chars"), F.lit(1).alias("spans"))
    found = runs.unionByName(whole).groupBy("rep").agg(F.max_by("chars", "chars").alias("chars"), F.max_by("spans", "chars").alias("spans"))
    everyone = keyed.groupBy("rep").agg(F.max("n").alias("n"))
    return everyone.join(found, "rep", "left").select(
        F.col("rep").alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        F.coalesce("chars", F.lit(0)).cast("long").alias("shared_chars"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
    )


def _step(s, x, min_chars: int):
    """One more window in order: how many new characters it covers, and whether a new run begins."""
    apart = x > s["last"]
    new = F.when((s["last"] < 0) | apart, F.lit(min_chars)).otherwise(x + min_chars - s["last"])
    return F.struct((x + min_chars).alias("last"), (s["chars"] + new).alias("chars"), (s["spans"] + F.when((s["last"] < 0) | apart, 1).otherwise(0)).alias("spans"))
