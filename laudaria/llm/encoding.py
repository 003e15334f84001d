"""Text decoded with the wrong character encoding (problem 6).

Every distinct clean word of the corpus that holds an accented letter is garbled under all encoding
chains (written in one encoding, read in another, once or twice, or with the letters lost to a
replacement sign), and the table of garbled forms is hash-joined with the distinct tokens of the
texts. What matches is put back; a record is affected if at least one match is decisive.

A match is decisive unless (1) the token is an ordinary word itself, (2) the word is one letter
long and its form one sign or question marks only, (3) the form ends in a question mark after an ordinary word, which is then a question. A token that
holds a replacement sign beside letters is decisive by itself. In affected records the other matches are put
back too. Of several originals of one form the word found in most texts is taken.

Of a word with up to ``ALL_SUBSETS`` accented letters any of them may have been spared by the damage; of one with more (no word of the languages at hand) all
but a run of neighbouring ones, or only such a run, is garbled. Tokens of any length are looked up.

Words and forms are joined on hash-partitioned keys, never broadcast, as forms grow with the vocabulary; the table of matched tokens (distinct garbled tokens of the corpus) is broadcast up to
``broadcast_rows`` rows, counted first, and otherwise joined by shuffle.

Defined results: null and empty texts are never affected and stay as they are; rows of one key count together for
``affected``; ``restore`` goes by the text alone, so rows of one key or of none stay apart; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.runtime import cut, spread

#: Encodings text was written in, and those it is wrongly read in.
WRITTEN = ("utf-8", "cp1252", "mac_roman", "cp850", "cp437")
READ = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp1250", "iso8859_2", "iso8859_15", "cp1253", "iso8859_7", "cp1254", "cp866", "cp852")
TWICE = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437")
LOST = ("?", "�")
#: Letters of an ordinary word, and what parts tokens (ASCII signs and controls but the question mark).
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÉÊÍÓÔÕÚÜÇÑ"
CLEAN = "^([A-Za-z]?[a-záàâãéêíóôõúüçñ]+|[A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇÑ][a-záàâãéêíóôõúüçñ]*|[A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇÑ]+)$"
PARTS = "(?:\\\\[nrt]|[\\x00-\\x20!-/:->@\\[-`{-\\x7f])+"  # a line break may be written out as two signs
ALL_SUBSETS = 8  #: most accented letters of which all subsets are garbled


def _read(raw: bytes, encoding: str) -> str:
    """Decode as lenient readers do: bytes without a character become control characters."""
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        out = []
        for b in raw:
            try:
                out.append(bytes([b]).decode(encoding))
            except UnicodeDecodeError:
                out.append(chr(b))
        return "".join(out)


@cache
def _chains(letter: str) -> dict[str, str]:
    """The forms of one letter, by chain."""
    forms: dict[str, str] = {}
    for written, read in product(WRITTEN, READ):
        try:
            once = _read(letter.encode(written), read)
        except UnicodeEncodeError:
            continue
        forms[f"{written}>{read}"] = once
        if written == "utf-8" and read in TWICE:
            for again in TWICE:
                forms[f"{written}>{read}>{again}"] = _read(once.encode("utf-8"), again)
    for sign in LOST:
        forms[sign] = sign
        forms[sign * 2] = sign * len(letter.encode("utf-8"))
    return forms


def garbled(word: str) -> set[str]:
    """All forms of a word under the chains, without the word itself; some of its letters may have been spared."""
    at = [i for i, c in enumerate(word) if ord(c) > 127]
    if not at:
        return set()
    if len(at) <= ALL_SUBSETS:
        some = [set(x) for k in range(1, len(at) + 1) for x in combinations(at, k)]
    else:
        runs = [set(at[i:j]) for i in range(len(at)) for j in range(i + 1, len(at) + 1)]
        some = runs + [set(at) - r for r in runs if len(r) < len(at)]
    every = set.intersection(*(set(_chains(word[i])) for i in at))
    forms = {"".join(_chains(c)[chain] if i in hit else c for i, c in enumerate(word)) for hit in some for chain in every}
    for form in list(forms):  # invisible characters are often dropped on the way
        forms.add("".join(c for c in form if not (0x7F <= ord(c) <= 0xA0 or ord(c) == 0xAD)))
    forms.discard(word)
    return {f for f in forms if f and any(ord(c) > 127 or c == "?" for c in f)}


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, texts) to (form, word, texts), for the word as it stands, in capitals, in small letters and with one capital."""
    for batch in batches:
        forms, words, counts = [], [], []
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for variant in {word, word.upper(), word.lower(), word.capitalize()}:
                f = garbled(variant)
                forms += f
                words += [variant] * len(f)
                counts += [n if variant == word else 0] * len(f)
        yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["token", "word", "texts"])


def tokens_of(text):
    """The tokens of a text column that can be words, as an array."""
    return F.filter(F.split(text, PARTS), lambda t: (F.length(t) > 0) & t.rlike("[^0-9]"))


def count_tokens(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``token, texts``: in how many texts each distinct token occurs (combined before the shuffle)."""
    return texts.select(F.explode(F.array_distinct(tokens_of(F.col(text_col)))).alias("token")).groupBy("token").agg(F.count("*").alias("texts"))


def matches(counts: DataFrame, ordinary_share: float = 0.05) -> DataFrame:
    """``token, word, decisive``: garbled tokens of the corpus and their originals."""
    odd = F.col("token").rlike("[^\\x00-\\x7f]|\\?")
    clean = F.col("token").rlike(CLEAN)
    words = counts.filter(clean & F.col("token").rlike(f"[{ACCENTED}]"))
    forms = spread(words.select("token", "texts")).mapInArrow(_forms, "token string, word string, texts long")
    suspects = counts.filter(odd & ~clean).select("token")
    best = (
        forms.join(suspects.hint("merge"), "token")
        .groupBy("token", "word")
        .agg(F.max("texts").alias("texts"))
        .groupBy("token")
        .agg(F.max_by("word", F.struct("texts", "word")).alias("word"), F.max("texts").alias("texts"))
    )
    bare = counts.select(F.col("token").alias("bare"), F.col("texts").alias("bare_texts"))
    judged = best.withColumn("bare", F.regexp_replace("token", "\\?+$", "")).join(bare.hint("merge"), "bare", "left")
    question = F.col("token").endswith("?") & (F.length("bare") > 0) & (F.coalesce("bare_texts", F.lit(0)) > ordinary_share * F.col("texts"))
    short = (F.length("word") == 1) & ((F.length(F.regexp_replace("token", "[\\u00a0\\u00ad]", "")) == 1) | F.col("token").rlike("^\\?+$"))  # "?? mm" is a blank
    found = judged.select("token", "word", (~question & ~short).alias("decisive"), question.alias("question"))
    lost = suspects.filter("token rlike '\\ufffd' and token rlike '[A-Za-z]'").join(found.hint("merge"), "token", "left_anti")
    return found.filter("not question").drop("question").unionByName(lost.select("token", F.lit(None).cast("string").alias("word"), F.lit(True).alias("decisive")))


def _sized(table: DataFrame, broadcast_rows: int) -> DataFrame:
    return F.broadcast(table) if table.count() <= broadcast_rows else table


def affected(texts: DataFrame, keys: list[str], text_col: str = "text", broadcast_rows: int = 200_000, corpus: DataFrame | None = None) -> DataFrame:
    """``keys, fixes``: each record with a decisive match, once, and its tokens with their originals; words are counted over ``corpus`` (column ``text``; if none, the texts)."""
    counts = count_tokens(texts, text_col) if corpus is None else count_tokens(corpus)
    table = _sized(cut(matches(cut(counts))), broadcast_rows)
    odd = F.filter(tokens_of(F.col(text_col)), lambda t: t.rlike("[^\\x00-\\x7f]|\\?"))
    held = texts.select(*keys, F.explode(F.array_distinct(odd)).alias("token")).join(table, "token")
    return held.groupBy(*keys).agg(F.bool_or("decisive").alias("hit"), F.collect_set(F.when(F.col("word").isNotNull(), F.struct("token", "word"))).alias("fixes")).filter("hit").drop("hit")


def restore(texts: DataFrame, keys: list[str], text_col: str = "text", broadcast_rows: int = 200_000) -> DataFrame:
    """``keys, text, restored, left_over``: every row with its text put right where the original is known, and how many garbled tokens are left."""
    own = texts.select(*keys, F.col(text_col).cast("string").alias("text"))
    odd = F.coalesce(F.col("text").rlike("[^\\x00-\\x7f]|\\?"), F.lit(False))
    each = own.filter(odd).withColumn("_id", F.md5("text"))
    fixes = affected(each.select("_id", "text").distinct(), ["_id"], "text", broadcast_rows, own)

    @F.pandas_udf("string")
    def put_back(text: pd.Series, fix: pd.Series) -> pd.Series:
        import re

        parts = re.compile(f"({PARTS})")

        def one(t, pairs):
            if t is None or pairs is None or len(pairs) == 0:
                return t
            known = {p["token"]: p["word"] for p in pairs}
            return "".join(known.get(x, x) for x in parts.split(t))

        return pd.Series([one(t, p) for t, p in zip(text, fix, strict=True)])

    joined = each.join(fixes, "_id", "left").drop("_id").unionByName(own.filter(~odd).withColumn("fixes", F.lit(None).cast(fixes.schema["fixes"].dataType)))
    out = joined.withColumn("restored", F.when(F.col("fixes").isNotNull(), put_back("text", "fixes")).otherwise(F.col("text")))
    left = F.when(F.col("fixes").isNotNull(), F.size(F.filter(tokens_of(F.col("restored")), lambda t: t.rlike("[A-Za-z]") & t.rlike("\\ufffd")))).otherwise(0)
    return out.select(*keys, "text", "restored", left.alias("left_over"))
