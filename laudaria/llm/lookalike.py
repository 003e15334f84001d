"""Visually identical text with different characters (problem 4).

1. Compatibility normalization, character by character, but for signs that are meant as such (``MEANT``); separate
   accents are composed with their letter.
2. Ignorable (invisible) characters are deleted, every kind of space becomes a space.
3. In a token that still holds letters of another script, each letter has the Latin letters it looks like as
   alternatives. A Viterbi search finds the likeliest path through that lattice under a character trigram model of the corpus,
   in which a path pays for every change of script. A single Greek letter that has no Latin twin (alpha, beta, delta ...) stays a symbol.

The trigram model is counted over the distinct tokens of all texts. It only has letters of the Latin alphabet and a word
boundary, so it has at most ``len(ALPHABET) ** 3`` entries however large the corpus is, and is sent to the tasks.

Defined results: null stays null, an empty text empty; rows of one key count together in ``found``; a letter that looks
like none of Latin stays as it is; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Signs that mean themselves although they have a plainer form or look like one.
MEANT = "°ºª²³¹½¼¾⅓⅔⅛⅜⅝⅞±×÷≤≥≠≈<>–—‒―−…“”‘’„‚«»‹›•·§µ™©®€£¥¢¿¡"
ALPHABET = "abcdefghijklmnopqrstuvwxyzáàâãéêíóôõúüçñ"
#: Letters of other scripts and the Latin letters they look like.
TWINS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ѵ": "v", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "п": "n", "г": "r", "ӏ": "l", "ё": "ë", "ї": "ï",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I", "Ґ": "G", "З": "3",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "υ": "u", "ι": "i", "κ": "k", "γ": "y", "χ": "x", "η": "n", "τ": "t", "ω": "w", "ε": "e", "σ": "o", "ϲ": "c", "ϳ": "j", "ό": "ó", "ί": "í", "ά": "á", "έ": "é", "ύ": "ú",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ά": "Á", "Έ": "É", "Ί": "Í", "Ό": "Ó",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "L", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g", "ԍ": "G", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
#: Greek letters that are symbols where they stand alone; their capital and small twins of Latin form are not.
SYMBOLS = "αβγδεζηθικλμνξπρστυφχψωΓΔΘΛΞΠΣΦΨΩ"
#: Signs of punctuation that look like plainer ones without being normalized to them.
SIGNS = {"‐": "-", "‑": "-", "⁃": "-", "˗": "-", "∕": "/", "⁄": "/", "∶": ":", "ː": ":", "꞉": ":", "‚": ",", "٫": ",", "ꓸ": ".", "․": ".", "׃": ":", "ʹ": "'", "ʼ": "'", "′": "'", "‵": "'", "ǃ": "!", "∗": "*", "⁎": "*", "；": ";", ";": ";"}
del SIGNS["‚"]

#: Every character outside this class makes a text worth a look; anything else stays as it is.
PLAIN = "\\x09\\x0a\\x0c\\x0d\\x20-\\x7eÀ-ÖØ-öø-ÿ" + MEANT.replace("×", "").replace("÷", "").replace("<", "").replace(">", "")
SWITCH, UNSEEN = -6.0, -9.0


def _invisible(c: str) -> bool:
    return unicodedata.category(c) in ("Cf", "Cc") and c not in "\t\n\r\f\x85" or c in "͏ᅟᅠ឴឵᠎ㅤﾠ" or 0xFE00 <= ord(c) <= 0xFE0F


def _plain(text: str) -> str:
    """Steps 1 and 2."""
    out = []
    for c in text:
        if c < "\x7f" and (c >= " " or c in "\t\n\r\f") or c in MEANT:
            out.append(c)
        elif _invisible(c):
            continue
        elif unicodedata.category(c) in ("Zs", "Zl", "Zp") or c == "\x85":
            out.append("\n" if c in "\x85  " else " ")
        elif c in SIGNS:
            out.append(SIGNS[c])
        else:
            out.append(unicodedata.normalize("NFKC", c))
    return unicodedata.normalize("NFC", "".join(out))


def _script(c: str) -> str:
    return "" if not c.isalpha() else "L" if c < "ɐ" and c != "ı" else unicodedata.name(c, "?").split(" ")[0]


class Lattice:
    """Viterbi search over look-alikes."""

    def __init__(self, trigrams: dict[str, float]):
        self.p = trigrams
        self.best = lru_cache(100_000)(self._best)

    def token(self, token: str) -> str:
        if len(token) == 1:  # a letter by itself: a symbol, unless only its form is Latin
            return token if token in SYMBOLS and not (token.lower() == "ο" or token == "ν") else TWINS.get(token, token)
        return self.best(token)

    def _best(self, token: str) -> str:
        states = {("^", "^", "L"): (0.0, "")}
        for c in token:
            options = {c, TWINS.get(c, c)}
            step: dict = {}
            for (a, b, script), (score, path) in states.items():
                for o in options:
                    own = _script(o) or script
                    low = o.lower() if o.isalpha() else "^"
                    s = score + (self.p.get(a + b + low, UNSEEN) if own == "L" else UNSEEN + SWITCH / 3) + (SWITCH if own != script else 0)
                    key = (b, low, own)
                    if key not in step or s > step[key][0]:
                        step[key] = (s, path + o)
            states = step
        best = max(states.values())[1]
        scripts = lambda t: {_script(c) for c in t} - {""}
        return token if len(scripts(best)) > 1 and len(scripts(token)) == 1 else best  # a word that is all of one script and can't be read in Latin stays


def model(texts: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Logarithms of trigram probabilities of Latin letters, counted over the distinct tokens of all texts."""
    low = F.lower(F.col(text_col))
    tokens = texts.select(F.explode(F.split(low, f"[^{ALPHABET}]+")).alias("t")).filter("length(t) > 0").groupBy("t").agg(F.count("*").alias("n"))
    marked = tokens.select(F.concat(F.lit("^^"), "t", F.lit("^")).alias("t"), F.log1p("n").alias("n"))
    grams = marked.select(F.explode(F.expr("transform(sequence(1, length(t) - 2), i -> substring(t, i, 3))")).alias("g"), "n").groupBy("g").agg(F.sum("n").alias("n"))
    rows = grams.collect()  # at most len(ALPHABET) ** 3
    total: dict[str, float] = {}
    for g, n in rows:
        total[g[:2]] = total.get(g[:2], 0.0) + n
    return {g: math.log(n / (total[g[:2]] + 1)) for g, n in rows}


def normalizer(trigrams: dict[str, float]) -> Callable[[str], str]:
    """A function of one text."""
    import re

    lattice = Lattice(trigrams)
    token = re.compile(r"[^\W_]+")

    def foreign(m: re.Match) -> str:
        t = m.group()
        return lattice.token(t) if any(c in TWINS for c in t) else t

    return lambda text: token.sub(foreign, _plain(text))


def normalize(texts: DataFrame, keys: list[str], text_col: str = "text", trigrams: dict[str, float] | None = None) -> DataFrame:
    """``keys, text, uniform``: every row with its text in one form. Texts of plain characters never leave the JVM."""
    p = model(texts, text_col) if trigrams is None else trigrams

    @F.pandas_udf("string")
    def uniform(text: pd.Series) -> pd.Series:
        one = normalizer(p)
        return text.map(lambda t: None if t is None else one(t))

    text = F.col(text_col)
    odd = text.rlike(f"[^{PLAIN}]")
    own = texts.select(*keys, text.alias("text"))
    return own.filter(odd).withColumn("uniform", uniform("text")).unionByName(own.filter(~odd | F.col("text").isNull()).withColumn("uniform", F.col("text")))


def found(texts: DataFrame, keys: list[str], text_col: str = "text", trigrams: dict[str, float] | None = None) -> DataFrame:
    """``keys`` of the records whose text is not in its one form."""
    return normalize(texts, keys, text_col, trigrams).filter("text <> uniform").select(*keys).distinct()
