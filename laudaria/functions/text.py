"""Column functions over text. All but ``similarity`` stay inside the JVM."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks and their plain forms.
MARKED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyAAAAAAEEEEIIIIOOOOOUUUUCNY"
SPACES = "[\\u00a0\\u2007\\u202f]"


def fold(c: Column) -> Column:
    """Letters without their marks; length stays, so places stay."""
    return F.translate(c, MARKED, PLAIN)


def norm(c: Column) -> Column:
    """Small letters, no marks, single spaces, none at the ends."""
    return F.trim(F.regexp_replace(norm_in_place(c), "\\s+", " "))


def norm_in_place(c: Column) -> Column:
    """Small letters without marks; every character keeps its place."""
    return F.lower(fold(c))


def ascii_lower(c: Column) -> Column:
    """Small letters without marks; other characters outside ASCII are dropped."""
    return F.lower(F.regexp_replace(fold(c), "[^\\x00-\\x7f]", ""))


def plain_spaces(c: Column) -> Column:
    """Non-breaking spaces become spaces."""
    return F.regexp_replace(c, SPACES, " ")


def alphanumeric(c: Column) -> Column:
    """ASCII letters and digits only."""
    return F.regexp_replace(c, "[^a-zA-Z0-9]", "")


def without_point_zero(c: Column) -> Column:
    """Numbers read as text: '12.0' becomes '12'."""
    return F.regexp_replace(c, "\\.0$", "")


def contains_any(c: Column, terms: list[str]) -> Column:
    """Whether any term occurs, whatever its case; null counts as empty."""
    return F.coalesce(c, F.lit("")).rlike("(?i)" + "|".join(re.escape(t) for t in terms))


def any_term(terms: list[str]) -> str:
    """Pattern of whole terms that tolerates marks and runs of spaces."""
    classes = {"a": "[aáàâãä]", "e": "[eéèêë]", "i": "[iíìîï]", "o": "[oóòôõö]", "u": "[uúùûü]", "c": "[cç]", "n": "[nñ]"}
    one = lambda t: "".join(classes.get(x, "\\s+" if x == " " else re.escape(x)) for x in t.lower())
    return "(?iU)(?<![\\p{L}\\p{N}_])(" + "|".join(one(t) for t in sorted(terms, key=len, reverse=True)) + ")(?![\\p{L}\\p{N}_])"


def find_terms(c: Column, terms: list[str]) -> Column:
    """All whole terms found, in order."""
    return F.regexp_extract_all(c, F.lit(any_term(terms)), 1)


def replaced(c: Column, table: list[tuple[str, str]]) -> Column:
    """Ordered corrections of whole words."""
    for wrong, right in table:
        c = F.regexp_replace(c, f"(?<![\\p{{L}}\\p{{N}}]){re.escape(wrong)}(?![\\p{{L}}\\p{{N}}])", right)
    return c


def stem(c: Column) -> Column:
    """Light Portuguese stem of a folded word: joining signs, plurals and the last a or o, one rule after the other, each with its guard of length; words of up to three letters stay."""
    word = F.regexp_replace(c, "[-_/]", "")
    w = word
    for ending, new, least in (("oes", "ao", 5), ("ais", "al", 5), ("eis", "el", 5), ("s", "", 5), ("[ao]", "", 6)):
        w = F.when(F.length(w) >= least, F.regexp_replace(w, f"{ending}$", new)).otherwise(w)
    return F.when(F.length(word) <= 3, word).otherwise(w)


def decimal(c: Column) -> Column:
    """A number written by hand: comma or point, 'inferior a' dropped; null where there is none."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "inferior a|superior a|[<>]", ""), ",", ".").try_cast("double")


def exam_type(c: Column) -> Column:
    """CT before MRI before ultrasound, by words in a folded title; null for none."""
    t = norm(c)
    return F.when(t.rlike("tomografia|(^|[^a-z])tc([^a-z]|$)"), "TC").when(t.rlike("ressonancia|(^|[^a-z])rm([^a-z]|$)|entero?rresson"), "RM").when(t.rlike("ultrass?on|(^|[^a-z])us([^a-z]|$)"), "US")


def similarity():
    """Ratcliff-Obershelp ratio of two columns, in Arrow batches: it has no counterpart among built-in functions."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio


def token_sort(c: Column) -> Column:
    """Words in order, as token-sort comparisons take them."""
    return F.array_join(F.array_sort(F.split(norm(c), " ")), " ")
