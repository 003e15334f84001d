"""Deduplicating new batches against all history (problem 3).

Accepted records leave their minwise band keys, each with the signature of its record, and their words in an index that is partitioned by hash. A new batch
computes its own keys, reads only the buckets it has keys in, keeps the pairs that share a key and whose signatures agree, compares their
words, and appends what it accepts. The history's texts are read only in the buckets of records met; nothing of the history is computed again.

The index is a list of parts, each with its own number of buckets: a power of two that keeps a bucket near ``PER_BUCKET`` rows, so a
record that is checked by itself reads at most one bucket for each of its keys in each part, however long the history. Whenever ``FAN`` parts are of
one level they are merged into one of the next, so the parts grow as the logarithm of the batches and a key is written again once a level. A part is
written beside its place and renamed into it; ``History(spark, path)`` opens what is there.

The order is that of the rows (date, identifier, text). Inside a batch, records of one bucket of at most ``small_bucket`` are compared
with each other, and the sequential rule is met in rounds: an undecided record that has no earlier undecided
match is accepted, its later matches are rejected, and so on. Of a larger bucket only the front is compared with itself, the first 1, 4, 16, 64 and then
``FRONT`` undecided records; those of them that are accepted meet the rows behind. A bucket of copies costs one comparison per row, one of n records
that are no copies of each other the n * n / 2 that the rule asks for, in about n / ``FRONT`` rounds. Rounds go on until all is decided, and the rows
of a bucket meet what is accepted in ``SALTS`` tasks. All in all the outcome is that of taking the rows one by one.

Similarity: word edit distance of at most ``max_differ`` of the longer text, words compared without case, accents,
punctuation and spacing (``words_of``). Keys are ``BANDS`` bands of ``ROWS`` minwise values over two-word shingles, the same shingle counted
each time it comes: shingles of five and a similarity of 0.8 would lose pairs that differ in a word in ten. A tenth of the words changed
touches at most a fifth of these shingles on either side, so the similarity of copies is at least 0.8 / 1.2 at any length, in texts that repeat themselves
too, and the expected recall at least 0.997 for the worst pair (a tenth spread evenly), 0.999999 at a twentieth. Every text has a key of its whole, so equal texts always meet.

Defined results: null and empty texts count by identifier only; a null identifier never matches; null dates come first;
of rows equal in identifier, date and text all but one are rejected, so their key comes out as rejected; an empty batch gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laudaria.runtime import cut, ensure_checkpoint_dir, spread

BANDS, ROWS, BITS, SHORT = 64, 6, 128, 20
APART = 40  #: bits of the signature in which two texts may differ to be compared word by word; of copies 21 or fewer on average, more than 40 once in 100,000
PER_BUCKET, MOST_BUCKETS, FAN = 1 << 15, 1 << 16, 8  #: rows a bucket is meant to hold, most buckets of a part, parts of one level that are merged
FRONT, SALTS = 256, 8  #: most rows of a crowded bucket that can be accepted in a round; tasks for the rows behind them
_SEED = np.random.default_rng(20240501)
_MUL = _SEED.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = _SEED.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_FOLD = _SEED.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_NAME = _SEED.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def words_of(text: str) -> list[str]:
    """Words without case, accents, punctuation and spacing; markup and written-out line breaks are spacing."""
    text = re.sub(r"<[^<>]{1,200}>|\\[nrt]", " ", text)
    text = unicodedata.normalize("NFKD", text.lower())
    return re.sub(r"[^\w\s]|_", " ", "".join(c for c in text if not unicodedata.combining(c))).split()


@lru_cache(200_000)
def _word(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def _shingles(words: list[str]) -> np.ndarray:
    """Hashes of the runs of two words; of equal runs each has its number in it."""
    with np.errstate(over="ignore"):
        h = np.array([_word(w) for w in words], np.uint64)
        s = np.sort(_mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + _mix(h[1:] ^ np.uint64(77))))
        at = np.arange(len(s))
        first = np.maximum.accumulate(np.where(np.append(True, s[1:] != s[:-1]), at, 0))
        return _mix(s + (at - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _lowest(values: np.ndarray, of: slice) -> np.ndarray:
    """Minwise values."""
    mul, add = _MUL[of], _ADD[of]
    low = np.full(len(mul), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for i in range(0, len(values), 256):
            low = np.minimum(low, (values[i : i + 256, None] * mul[None, :] + add[None, :]).min(axis=0))
    return low >> np.uint64(20)


def signed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of a text and one of the whole; its signature of BITS bits, one of each minwise value: two texts differ in about half the share of their shingles that they don't share."""
    with np.errstate(over="ignore"):
        whole = _mix(np.array([_word(" ".join(words)) ^ 0x5555], np.uint64))
        if len(words) < 9:  # of shorter texts no other is within a tenth; one of nine words and one of ten can be
            return whole.astype(np.int64), np.zeros(2, np.int64)
        low = _lowest(_shingles(words), slice(0, BANDS * ROWS))
        keys = _mix((low.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64) ^ _NAME)
        if len(words) < SHORT:  # always compared word by word
            return np.concatenate([whole, keys]).astype(np.int64), np.zeros(2, np.int64)
        return np.concatenate([whole, keys]).astype(np.int64), np.packbits((_mix(low[:BITS]) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether the word edit distance is at most ``most``: by diagonals, in time of length times distance."""
    if abs(len(a) - len(b)) > most:
        return False
    reach = {0: -1}
    for d in range(most + 1):
        best = {}
        for k in range(-d, d + 1):
            if d == 0:
                i = 0
            else:
                i = max(reach.get(k - 1, -2), reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1)
            if i < 0 or i > len(a) or i + k < 0:
                continue
            i = min(i, len(a), len(b) - k)
            while i < len(a) and i + k < len(b) and a[i] == b[i + k]:
                i += 1
            best[k] = i
        if best.get(len(b) - len(a), -1) >= len(a):
            return True
        reach = best
    return False


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ident, date, again, text) to (node, ident, date, again, words, one, two, keys)."""
    for b in batches:
        words = [words_of(t) if t else [] for t in b.column(4).to_pylist()]
        signs = [signed(w) if w else (np.zeros(0, np.int64), np.zeros(2, np.int64)) for w in words]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k, _ in signs])]), pa.int32())
        keys = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *(k for k, _ in signs)])))
        joined = pa.array([" ".join(w) if w else None for w in words], pa.string())
        one, two = (pa.array(np.array([x[i] for _, x in signs], np.int64)) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([*b.columns[:4], joined, one, two, keys], ["node", "ident", "date", "again", "words", "one", "two", "keys"])


def _same(max_differ: float):
    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            if x == y:
                out.append(True)
                continue
            u, v = x.split(" "), y.split(" ")
            out.append(within(u, v, int(max(len(u), len(v)) * max_differ + 1e-9)))
        return pd.Series(out, dtype=bool)

    return same


class History:
    """The index of accepted records under one folder that all executors share."""

    KINDS = {"keys": "key long, node long, by_ident boolean, one long, two long, bucket int", "texts": "node long, words string, bucket int"}

    def __init__(self, spark: SparkSession, path: str | None = None, per_bucket: int = PER_BUCKET):
        self.spark, self.per_bucket = spark, per_bucket
        if path is None:
            ensure_checkpoint_dir(spark)
            path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/history-{uuid.uuid4().hex}"
        self.path = path
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.parts: list[dict] = []  # number, level, and the buckets of keys and texts
        self.read: dict[str, tuple[int, int]] = {}  # of the last probe: buckets read, buckets there
        if self.fs.exists(self._hadoop(path)):
            names = (str(f.getPath().getName()) for f in self.fs.listStatus(self._hadoop(path)))
            found = sorted(tuple(int(x) for x in n.split("-")[1:]) for n in names if n.startswith("part-"))
            covered = {n for number, level, *_ in found for n in self._under(number, level)}
            self.parts = [dict(zip(("number", "level", "keys", "texts"), p, strict=True)) for p in found if p[:2] not in covered]
        self.made = 1 + max((p["number"] for p in self.parts), default=-1)

    @staticmethod
    def _under(number: int, level: int) -> list[tuple[int, int]]:
        """The parts that a merged one stands for, if a job ended between its renaming and their removal: it has the number of the last of them."""
        return [(n, low) for low in range(level) for n in range(number - FAN**level + 1, number + 1)]

    def _name(self, part: dict) -> str:
        return f"{self.path}/part-{part['number']:08d}-{part['level']}-{part['keys']}-{part['texts']}"

    def _delete(self, folder: str) -> None:
        self.fs.delete(self._hadoop(folder), True)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a step of the batch at hand beside the index, and go on from there."""
        path = f"{self.path}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def done(self) -> None:
        """Delete the steps of batches that are done."""
        self._delete(f"{self.path}/work")

    def drop(self) -> None:
        """Delete the index."""
        self._delete(self.path)

    def buckets(self, kind: str) -> int:
        """Most buckets of any part: a power of two, as are the others."""
        return max((p[kind] for p in self.parts), default=1)

    def probe(self, kind: str, wanted: list[int] | None) -> DataFrame | None:
        """Rows of the buckets that hold a key (or node) whose bucket of the finest part is ``wanted`` (None: all)."""
        out, read = None, 0
        for p in self.parts:
            some = None if wanted is None else sorted({w & (p[kind] - 1) for w in wanted})
            rows = self._table(p, kind)
            if some is not None and len(some) < p[kind]:
                rows = rows.filter(F.col("bucket").isin(some))
            read += p[kind] if some is None else len(some)
            out = rows if out is None else out.unionByName(rows)
        self.read[kind] = (read, sum(p[kind] for p in self.parts))
        return out

    def _table(self, part: dict, kind: str) -> DataFrame:
        return self.spark.read.schema(self.KINDS[kind]).option("basePath", f"{self._name(part)}/{kind}").parquet(f"{self._name(part)}/{kind}")

    def _write(self, part: dict, tables: dict[str, DataFrame]) -> None:
        """Written whole beside its place, then renamed: a part is there or not."""
        aside = f"{self.path}/aside-{part['number']:08d}-{part['level']}"
        for kind, df in tables.items():
            by = "key" if kind == "keys" else "node"
            bucketed = df.withColumn("bucket", F.col(by).bitwiseAND(F.lit(part[kind] - 1)).cast("int"))
            n = min(part[kind], max(1, self.spark.sparkContext.defaultParallelism))
            bucketed.repartition(n, "bucket").sortWithinPartitions("bucket", by).write.mode("overwrite").partitionBy("bucket").parquet(f"{aside}/{kind}")
        self.fs.rename(self._hadoop(aside), self._hadoop(self._name(part)))

    def _fit(self, rows: int) -> int:
        n = 1
        while n < MOST_BUCKETS and n * self.per_bucket < rows:
            n *= 2
        return n

    def append(self, keys: DataFrame, texts: DataFrame, records: int) -> None:
        """Add a batch's accepted records; ``records`` is about how many they are."""
        part = {"number": self.made, "level": 0, "keys": self._fit(records * (BANDS + 2)), "texts": self._fit(records * 8)}
        self._write(part, {"keys": keys, "texts": texts})
        self.parts.append(part)
        self.made += 1
        while True:
            last = [p for p in self.parts if p["level"] == self.parts[-1]["level"]]
            if len(last) < FAN:
                return
            whole = {"number": last[-1]["number"], "level": last[-1]["level"] + 1} | {k: min(MOST_BUCKETS, self._fit(sum(p[k] for p in last) * self.per_bucket)) for k in self.KINDS}
            self._write(whole, {k: reduce(DataFrame.unionByName, (self._table(p, k).drop("bucket") for p in last)) for k in self.KINDS})
            for p in last:
                self._delete(self._name(p))
            self.parts = [p for p in self.parts if p not in last] + [whole]


def prepare(batch: DataFrame, ident: str, date: str, text: str) -> DataFrame:
    """``node, ident, date, again, words, one, two, keys`` of each distinct row: each by itself, nothing of other rows goes in."""
    own = batch.select(F.col(ident).cast("string").alias("ident"), F.col(date).cast("date").alias("date"), F.col(text).cast("string").alias("text"))
    own = own.withColumn("node", F.xxhash64("ident", F.col("date").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    own = own.groupBy("node").agg(*(F.first(c).alias(c) for c in ("ident", "date", "text")), (F.count("*") > 1).alias("again"))
    return spread(own.select("node", "ident", "date", "again", "text")).mapInArrow(_signed, "node long, ident string, date date, again boolean, words string, one long, two long, keys array<long>")


def _alike(a: str, b: str) -> F.Column:
    """Whether identifiers met, or signatures agree; those of short texts are empty and agree with any."""
    differ = sum((F.bit_count(F.col(f"{a}{x}").bitwiseXOR(F.col(f"{b}{x}"))) for x in ("one", "two")), F.lit(0))
    empty = [(F.col(f"{s}one") == 0) & (F.col(f"{s}two") == 0) for s in (a, b)]
    return F.col("by_ident") | (differ <= APART) | empty[0] | empty[1]


def _pairs(mine: DataFrame, known: DataFrame, old: bool) -> DataFrame:
    """``node, other, by_ident, old``: pairs that share a key and may be copies; of one batch the later with the earlier."""
    names = ["key", "by_ident", "node", "one", "two", *([] if old else ["ord"])]
    theirs = known.select("key", "by_ident", *(F.col(n).alias(f"_{n}") for n in names[2:]))
    met = theirs.join(mine, ["key", "by_ident"]).filter(_alike("", "_"))
    met = met if old else met.filter("_ord < ord")
    return met.select("node", F.col("_node").alias("other"), "by_ident", F.lit(old).alias("old"))


def _confirmed(met: DataFrame, left: DataFrame, right: DataFrame, max_differ: float, few: bool = False) -> DataFrame:
    """Of the distinct pairs (node, other, by_ident, old), those whose identifiers or words agree: node of ``left``, other of ``right``.

    With ``few`` pairs (counted) they are sent to where the texts lie, else both are shuffled; of the history only the texts met are moved.
    """
    met = met.groupBy("node", "other", "old").agg(F.bool_or("by_ident").alias("by_ident"))
    near = met.filter("not by_ident").select("node", "other", "old")
    sent = F.broadcast(near) if few else near
    a = left.select("node", "words").join(sent, "node")
    b = right.select(F.col("node").alias("other"), F.col("words").alias("words2")).join(sent.select("node", "other"), "other")
    same = a.join(b, ["node", "other"]).filter(_same(max_differ)("words", "words2"))
    return met.filter("by_ident").select("node", "other", "old").unionByName(same.select("node", "other", "old"))


def ingest(history: History, batch: DataFrame, ident: str, date: str, text: str, max_differ: float = 0.1, small_bucket: int = 64) -> DataFrame:
    """Check a batch against the history and within itself; append what is accepted.

    Returns ``ident, date, rejected`` with one row per distinct (identifier, date): rejected if any of its rows was.
    """
    own = history.keep(prepare(batch, ident, date, text), "own")
    crowded = not _keys(own).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > small_bucket).isEmpty()
    out = cut(_verdicts(decide(history, own, own.count(), crowded, max_differ, small_bucket)))
    history.done()
    return out


def _verdicts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ident", "date").agg(F.bool_or("rejected").alias("rejected"))


def _keys(own: DataFrame, *more: str | F.Column) -> DataFrame:
    """``key, node, by_ident, one, two``: the band keys of prepared rows, and one of each identifier."""
    each = F.expr("concat(transform(keys, k -> struct(k as key, false as by_ident)), if(ident is null, array(), array(struct(xxhash64('ident', ident) as key, true as by_ident))))")
    return own.select("node", "one", "two", *more, F.explode(each).alias("k")).select("k.key", "node", "k.by_ident", "one", "two", *(["ord"] if more else []))


def decide(history: History, own: DataFrame, rows: int, crowded: bool, max_differ: float = 0.1, small_bucket: int = 64, few_rows: int = 100_000) -> DataFrame:
    """``ident, date, rejected`` of each of the ``rows`` prepared rows of a batch, some of them in buckets over ``small_bucket`` if ``crowded``; what is accepted is appended.

    Up to ``few_rows`` rows or pairs are broadcast, counted first (at most 66 keys a row of 40 bytes each, and 20 bytes a pair); beyond that they are shuffled.
    """
    order = F.struct(F.coalesce(F.col("date").cast("string"), F.lit("")).alias("d"), F.coalesce("ident", F.lit("")).alias("i"), "node").alias("ord")
    keys = _keys(own, order)
    small, hot = keys, None
    if crowded:
        counted = history.keep(keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key"), "counted")
        small, hot = counted.filter(F.col("n") <= small_bucket), counted.filter(F.col("n") > small_bucket)
    sent = (lambda df: F.broadcast(df)) if rows <= few_rows // 10 else (lambda df: df)
    pairs = _pairs(sent(small), small, False)
    if history.parts:
        finest = history.buckets("keys")
        wanted = None  # with 20 keys a bucket all are met
        if rows * (BANDS + 2) < 20 * finest:
            wanted = [r[0] for r in keys.select(F.col("key").bitwiseAND(F.lit(finest - 1)).cast("int")).distinct().collect()]  # at most MOST_BUCKETS
        pairs = pairs.unionByName(_pairs(sent(keys.drop("ord")), history.probe("keys", wanted), True))
    met = history.keep(pairs, "met")
    finest = history.buckets("texts")
    n_met, seen = met.agg(F.count("*"), F.collect_set(F.when(F.col("old") & ~F.col("by_ident"), F.col("other").bitwiseAND(F.lit(finest - 1)).cast("int")))).first()  # at most MOST_BUCKETS
    right = own.select("node", "words")
    history.read["texts"] = (0, sum(p["texts"] for p in history.parts))
    if seen:
        right = right.unionByName(history.probe("texts", seen).select("node", "words"))
    bad, n_new = [], 0
    if n_met:
        links = history.keep(_confirmed(met, own, right, max_differ, n_met <= few_rows), "links")
        n_new = links.filter("not old").limit(1).count()
        bad.append(links.filter("old").select("node"))
    if n_new or crowded:
        bad += _rounds(history, own, links if n_met else met.select("node", "other", "old"), hot, max_differ)
    state = own.withColumn("bad", F.lit(False))
    if bad:
        gone = reduce(DataFrame.unionByName, bad).distinct().withColumn("bad", F.lit(True))
        state = history.keep(own.join(F.broadcast(gone) if rows <= few_rows else gone, "node", "left").withColumn("bad", F.coalesce("bad", F.lit(False))), "state")
    new = state.filter("not bad")
    history.append(_keys(new), new.filter("words is not null").select("node", "words"), rows)
    return state.select("ident", "date", (F.col("bad") | F.col("again")).alias("rejected"))


def _rounds(history: History, own: DataFrame, links: DataFrame, hot: DataFrame | None, max_differ: float) -> list[DataFrame]:
    """Records of the batch that the sequential rule rejects for others of the batch, by rounds. Links are of later records (node) with earlier ones (other) or old ones; ``hot`` has the keys of crowded buckets."""
    known = links.filter("old").select("node").distinct()
    links = links.filter("not old").select("node", "other")
    for side in ("node", "other"):
        links = links.join(known.withColumnRenamed("node", side), side, "left_anti")
    open_ = links.select("node").unionByName(links.select(F.col("other").alias("node")))
    if hot is not None:
        open_ = open_.unionByName(hot.join(known, "node", "left_anti").select("node"))
    links, open_ = history.keep(links, "fresh"), history.keep(open_.distinct(), "open")
    bad: list[DataFrame] = []
    width, turn = 1, 0  # rows at the front of a crowded bucket that are compared with each other in a round
    while not open_.isEmpty():  # the first of all open records is always taken
        left = links.join(open_, "node", "left_semi").join(open_.select(F.col("node").alias("other")), "other", "left_semi").select("node", "other")
        waits = left.select("node")
        if hot is not None:
            there = hot.join(open_, "node", "left_semi")
            front = history.keep(there.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("ord"))).filter(F.col("place") <= width).drop("place"), f"front-{turn}")
            rest = there.join(front.select("key", "node"), ["key", "node"], "left_anti")
            if width > 1:
                left = left.unionByName(history.keep(_confirmed(_pairs(front, front, False), own, own, max_differ).select("node", "other"), f"after-{turn}"))
            waits = left.select("node").unionByName(rest.select("node"))
        taken = open_.join(waits.distinct(), "node", "left_anti")
        if hot is not None:
            taken = history.keep(taken, f"taken-{turn}")
        out = left.join(taken.select(F.col("node").alias("other")), "other", "left_semi").select("node")
        if hot is not None:  # what is taken meets the rows behind the front, those of a bucket in several tasks
            salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
            ahead = front.join(taken, "node", "left_semi").select("key", "by_ident", F.col("node").alias("other"), F.col("ord").alias("_ord"), F.col("one").alias("_one"), F.col("two").alias("_two"), salts)
            behind = rest.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(ahead, ["key", "by_ident", "salt"]).filter("_ord < ord").filter(_alike("", "_"))
            out = out.unionByName(_confirmed(behind.select("node", "other", "by_ident", F.lit(False).alias("old")), own, own, max_differ).select("node"))
        step = open_.join(taken.withColumn("taken", F.lit(True)), "node", "left").join(out.distinct().withColumn("out", F.lit(True)), "node", "left")
        step = history.keep(step, f"step-{turn}")
        bad.append(step.filter("out").select("node"))
        open_ = step.filter("taken is null and out is null").select("node")
        width, turn = min(4 * width, FRONT), turn + 1
    return bad


def replay(records: DataFrame, ident: str, date: str, text: str, runs_per_batch: int = 6, history: History | None = None, rows_per_file: int = 50_000, small_bucket: int = 64) -> DataFrame:
    """All runs from the first to the last, ``runs_per_batch`` to a batch: ``ident, date, rejected``.

    A batch takes some ten small jobs, whatever its size, which is why a replay takes some runs together; a daily job passes each run to ``ingest``
    by itself. The rows are prepared once and laid out by run, as such a job would find them. Without a ``history`` an
    index is made for the call and deleted at its end. The outcome doesn't depend on ``runs_per_batch``.
    """
    own, history = history is None, history or History(records.sparkSession)
    sizes = {r[0]: r[1] for r in records.groupBy(F.col(date).cast("date")).count().collect()}  # runs, not records
    dates = sorted(sizes, key=lambda d: (d is not None, d))
    laid, verdicts = f"{history.path}/laid", f"{history.path}/verdicts"
    ready = prepare(records, ident, date, text)
    ready = ready.withColumn("run", F.coalesce(F.col("date").cast("string"), F.lit("none")))
    files = 1 + max(sizes.values(), default=0) // rows_per_file
    ready.repartition(F.col("run"), F.pmod("node", F.lit(files))).write.mode("overwrite").partitionBy("run").parquet(laid)
    runs = records.sparkSession.read.schema(ready.schema).parquet(laid)
    batches = [dates[i : i + runs_per_batch] for i in range(0, len(dates), runs_per_batch)]
    name = lambda d: "none" if d is None else str(d)
    number = F.create_map(*(F.lit(x) for i, some in enumerate(batches) for d in some for x in (name(d), i))) if dates else F.lit(0)
    keyed = _keys(runs.withColumn("batch", number[F.col("run")]), F.col("batch").alias("ord")) if dates else None
    crowded = {r[0] for r in keyed.groupBy("ord", "key").agg(F.count("*").alias("n")).filter(F.col("n") > small_bucket).select("ord").distinct().collect()} if dates else set()  # numbers of batches
    for i, some in enumerate(batches):
        mine = runs.filter(F.col("run").isin([name(d) for d in some])).drop("run")
        decide(history, mine, sum(sizes[d] for d in some), i in crowded, small_bucket=small_bucket).write.mode("append").parquet(verdicts)
        history.done()
    if not dates:
        return runs.select("ident", "date", F.lit(False).alias("rejected"))
    out = cut(_verdicts(records.sparkSession.read.schema("ident string, date date, rejected boolean").parquet(verdicts)))
    for folder in (laid, verdicts):
        history._delete(folder)
    if own:  # the outcome is kept apart from the index
        history.drop()
    return out
