"""Noise in text from scanned pages (problem 1).

Three kinds of noise are found and repaired: words divided at a line end (``hifenizacao``), misread characters in words
(``caractere``), and running headers, footers and page numbers between or after the lines of the report (``pagina``).

*Words.* All distinct words are counted once, over distinct texts. Those seen in few texts beside their neighbours are suspects; they meet the
frequent words through an inverted join on padded character q-grams, and a gradient-boosted model ranks the candidates by how well the
usual confusions of scanning explain the difference, how much more frequent the candidate is, how many q-grams they share, and how many q-grams of the
word stand in no other word of the corpus. A difference that the usual confusions don't explain is accepted for one letter within the word, if the ranker takes it and at least
``STRANGE`` q-grams of the word stand in no other: so "calihre" is misread, and "direita" beside "direito" is a word. Words under ``least_length`` letters are left alone: "T1" or "L5" are as they should be.
Frequencies enter as ratios, so the outcome is alike at every size. The model is fitted on clean words of the corpus
misread by the confusion table or by any letter (positives) and on rare clean words against their look-alikes (negatives).

*Lines.* A second boosted model sees pairs of neighbouring lines: whether the first ends in a mark of division and
the halves join to a known word (a join), or whether the second is furniture: short, of digits and page words,
in the way of a sentence that goes on behind it, repeated in the text apart from its digits, or the line that follows such a line. It is
fitted on pairs made from clean lines by dividing words and inserting furniture: page lines, headers, both, or headers alone. A text without a page line, a form feed, a line that begins with a page word and
a number, or a repeated line can hold nothing that tells furniture from a title, and isn't put to the model.

Both models are fitted on a bounded sample (``training_rows``); counts, candidates and decisions cover all data.
The table of corrections (distinct misread words) is broadcast up to ``broadcast_rows`` rows, counted first, else joined by shuffle.

Defined results: null and empty texts have no noise and stay as they are; rows of one key count together in ``found`` and stay apart in
``repair``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.runtime import cut, spread

#: What scanning confuses, as it should be and as it is read.
CONFUSIONS = [
    ("i", "1"), ("l", "1"), ("o", "0"), ("s", "5"), ("b", "6"), ("g", "9"), ("a", "@"), ("i", "!"), ("l", "|"), ("i", "|"), ("s", "$"), ("z", "2"), ("b", "8"), ("g", "q"), ("q", "g"), ("ó", "6"), ("t", "7"),
    ("e", "3"), ("a", "4"), ("á", "@"), ("ã", "@"), ("â", "@"), ("í", "1"), ("í", "!"), ("l", "!"), ("t", "f"), ("f", "t"), ("e", "c"), ("c", "e"), ("é", "c"), ("ê", "c"), ("í", "f"), ("i", "l"), ("l", "i"), ("h", "b"), ("h", "li"), ("n", "ri"),
    ("u", "ii"), ("d", "cl"), ("m", "rn"), ("rn", "m"), ("cl", "d"), ("ri", "n"), ("li", "h"), ("nn", "m"), ("m", "nn"), ("w", "vv"), ("u", "v"), ("v", "u"), ("ú", "ii"), ("ú", "u"), ("ã", "ä"), ("õ", "ö"), ("ã", "a"), ("ç", "c"), ("ç", "g"), ("ó", "o"), ("é", "e"), ("á", "a"),
    ("o", "c"), ("n", "u"), ("y", "v"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("í", "i"), ("ê", "é"), ("o", "ö"), ("ô", "o"), ("a", "ä"),
]
HYPHENS = "-¬‐­‑⁃=~"
LETTERS = "a-zA-ZáàâãäéêëíïóôõöúüçñÁÀÂÃÉÊÍÓÔÕÚÜÇ"
_WORD = f"[{LETTERS}0-9@!|$ﬁﬂ]+"
_TOKEN = re.compile(_WORD)
_LINES = re.compile(r"\r\n|\\r\\n|\\n|\n|\x0c(?=.)|<br ?/?>")
Q = 3
STRANGE = 2  #: q-grams of a word that stand in no other, for it to be misread in a way that CONFUSIONS doesn't have
_PLAIN = str.maketrans("áàâãéêíóôõúç", "aaaaeeiooouc")

_PAGE = re.compile(r"(?i)(?<![a-z])(?:p\s*[aáà@]\s*g\s*(?:i\s*n\s*a)?s?|fl|fls|folhas?|page|sheet)(?![a-z])")
_PAGE_LINE = re.compile(r"(?i)^[\W_]*(?:(?:p\s*[aáà@4]\s*[g9]\s*(?:[i1!l]\s*n\s*[a@4])?|fls?|folha|page)[\W_]*)?\d{1,4}(?:\s*(?:/|de|of|-|\|)\s*\d{1,4})?[\s\-–—\]|_>]*$")


_PAGE_HEAD = re.compile(r"(?i)^[\W_]*(?:p\s*[aáà@4]?\s*g\s*(?:i\s*n\s*a)?|fls?|folha|page)[\W_]*\d{1,4}(?!\d)")


def _masked(line: str) -> str:
    """A line apart from its digits and the spaces around it."""
    return re.sub(r"\d+", "#", line.strip(" \t\x0c\r"))


def _again(times: Counter) -> bool:
    """Whether a line that could be a header comes more than once."""
    return any(n > 1 and len(x) >= 8 and x[-1:] not in ".:;," for x, n in times.items())


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.3) -> list:
    """Gradient-boosted trees for two classes over a small matrix: a list of trees."""
    score, trees = np.zeros(len(y)), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int):
        value = rate * g[rows].sum() / (h[rows].sum() + 1.0)
        if level == 0 or len(rows) < 8:
            return value
        best = (1e-6, None, None)
        base = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for f in range(x.shape[1]):
            v = x[rows, f]
            order = np.argsort(v, kind="stable")
            gs, hs, vs = np.cumsum(g[rows][order]), np.cumsum(h[rows][order]), v[order]
            gain = gs**2 / (hs + 1.0) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1.0) - base
            gain[:-1][vs[1:] == vs[:-1]] = -1
            gain[-1] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, (vs[k] + vs[k + 1]) / 2)
        if best[1] is None:
            return value
        left = x[rows, best[1]] <= best[2]
        return (best[1], best[2], grow(rows[left], g, h, level - 1), grow(rows[~left], g, h, level - 1))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(y)), y - p, p * (1 - p), depth)
        trees.append(tree)
        score += _apply(tree, x)
    return trees


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, at, low, high = tree
    left = x[:, f] <= at
    out = np.empty(len(x))
    out[left], out[~left] = _apply(low, x[left]), _apply(high, x[~left])
    return out


def predict(trees: list, x: np.ndarray) -> np.ndarray:
    """Probability of the positive class."""
    return 1 / (1 + np.exp(-sum(_apply(t, x) for t in trees))) if len(x) else np.zeros(0)


def explained(read: str, meant: str) -> tuple[int, int]:
    """(confusions used, edits left over) of the cheapest way from the word as meant to the word as read; an edit costs three confusions."""
    n, m = len(meant), len(read)
    if abs(n - m) > 3:
        return (0, 99)
    cost = [[(9999, 0, 0)] * (m + 1) for _ in range(n + 1)]
    cost[0][0] = (0, 0, 0)
    for i in range(n + 1):
        for j in range(m + 1):
            c, a, b = cost[i][j]
            if c >= 9999 or abs(i - j) > 4:
                continue
            if i < n and j < m and meant[i] == read[j]:
                cost[i + 1][j + 1] = min(cost[i + 1][j + 1], (c, a, b))
            for w, r in _BY_FIRST.get(meant[i], ()) if i < n else ():
                if meant.startswith(w, i) and read.startswith(r, j):
                    t = (i + len(w), j + len(r))
                    cost[t[0]][t[1]] = min(cost[t[0]][t[1]], (c + 1, a + 1, b))
            for di, dj in ((1, 1), (1, 0), (0, 1)):
                if i + di <= n and j + dj <= m:
                    cost[i + di][j + dj] = min(cost[i + di][j + dj], (c + 3, a, b + 1))
    return cost[n][m][1], cost[n][m][2]


_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _w, _r in CONFUSIONS:
    _BY_FIRST.setdefault(_w[0], []).append((_w, _r))


def misread(word: str, rng: np.random.Generator) -> str:
    """The word with one or two confusions."""
    for _ in range(int(rng.integers(1, 3))):
        can = [(w, r, m.start()) for w, r in CONFUSIONS for m in re.finditer(re.escape(w), word)]
        if can:
            w, r, at = can[int(rng.integers(len(can)))]
            word = word[:at] + r + word[at + len(w) :]
    return word


def _grams(word: str) -> set[str]:
    padded = f"^{word}$"
    return {padded[i : i + Q] for i in range(len(padded) - Q + 1)}


def strange(word: str, n: float, weights: dict[str, float], total: float) -> int:
    """How many q-grams of the word stand in hardly any other text than those of the word itself; ``weights`` has the texts of the clean words by q-gram."""
    return sum(weights.get(g, 0.0) - n <= 0.0005 * total for g in _grams(word))


def _inside(read: str, meant: str) -> bool:
    """Whether the words differ in one letter, neither the first nor one of the last two: endings are grammar."""
    apart = [i for i, (a, b) in enumerate(zip(read, meant, strict=False)) if a != b]
    return len(read) == len(meant) >= 5 and len(apart) == 1 and 0 < apart[0] < len(read) - 2


def _features(read: str, meant: str, n_read: float, n_meant: float, odd: int) -> list[float]:
    used, left = explained(read, meant)
    a, b = _grams(read), _grams(meant)
    return [odd, used, left, np.log((n_meant + 1) / (n_read + 1)), len(a & b) / len(a | b), len(meant), abs(len(read) - len(meant)), float(any(not c.isalpha() for c in read)), float(read[:1] == meant[:1])]


_DIVIDED = re.compile(f"[{LETTERS}0-9]+[{HYPHENS}](?:\\r?\\n|\\\\n|<br>)[{LETTERS}0-9]+")
_COMPOUND = re.compile(f"[{LETTERS}]+-[{LETTERS}]+")


def words_in(text: str) -> set[str]:
    """Lower-case words of at least two signs, a letter among them."""
    return {w for w in _TOKEN.findall(text.lower()) if len(w) >= 2 and not w.isdigit()}


def _count(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Texts to (word, texts), added up over the task and let go whenever ``most`` words are held."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "texts"])
        held.clear()
        return batch

    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                whole = _DIVIDED.sub(" ", text)
                held.update(words_in(whole))
                held.update({c.lower() for c in _COMPOUND.findall(whole)})
        if len(held) > most:
            yield out()
    yield out()


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, texts``: lower-case words and hyphenated compounds and in how many distinct texts they stand; words divided at a line end are left out."""
    own = texts.select(F.col(text_col).cast("string").alias("text")).distinct()  # copies of a scanned text don't make its misread words frequent
    return own.mapInArrow(_count, "word string, texts long").groupBy("word").agg(F.sum("texts").alias("texts"))


def corrections(counts: DataFrame, ratio: float = 12.0, least_length: int = 4, training_rows: int = 4000, accept: float = 0.5) -> tuple[DataFrame, list]:
    """``word, meant``: misread words and what they stand for; and the model.

    Suspects are words at least ``ratio`` times rarer than a candidate; candidates come from the q-gram join.
    """
    clean = counts.filter(F.col("word").rlike("^[a-záàâãéêíóôõúüç]+$"))
    total = counts.agg(F.max("texts")).first()[0] or 0
    sample = [(r[0], r[1]) for r in clean.filter((F.col("texts") >= max(3, total * 0.002)) & (F.length("word") >= least_length)).orderBy(F.xxhash64("word")).limit(training_rows // 4).collect()]
    padded = F.concat(F.lit("^"), "word", F.lit("$"))
    own = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - Q + 1), lambda i: F.substring(padded, i, Q)))
    weights = {r[0]: float(r[1]) for r in clean.select(F.explode(own).alias("g"), "texts").groupBy("g").agg(F.sum("texts")).collect()}  # at most 41 ** Q
    model = fit_words(sample, weights, total)

    gram = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(F.concat(F.lit("^"), c, F.lit("$")), i, Q)))
    frequent = clean.filter(F.length("word") >= least_length).select(F.col("word").alias("meant"), F.col("texts").alias("n_meant"), F.explode(gram(F.col("word"))).alias("gram"))
    suspects = counts.filter(F.length("word") >= least_length).select("word", F.col("texts").alias("n"), F.explode(gram(F.col("word"))).alias("gram"))
    met = suspects.join(frequent, "gram").filter((F.col("n_meant") >= ratio * F.col("n")) & (F.abs(F.length("word") - F.length("meant")) <= 2))
    pairs = met.groupBy("word", "meant").agg(F.first("n").alias("n"), F.first("n_meant").alias("n_meant"), F.count("*").alias("shared"))
    pairs = pairs.filter(F.levenshtein("word", "meant", 4) >= 0)

    clean_word = re.compile("^[a-záàâãéêíóôõúüç]+$")

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            odd = {w: strange(w, n if clean_word.match(w) else 0, weights, total) for w, n in zip(b["word"], b["n"], strict=True)}
            x = np.array([_features(*t, odd[t[0]]) for t in zip(b["word"], b["meant"], b["n"], b["n_meant"], strict=True)], float).reshape(len(b), 9)
            p = predict(model, x)
            inside = np.array([_inside(w, m) and odd[w] >= STRANGE for w, m in zip(b["word"], b["meant"], strict=True)], bool)
            plain = [str.translate(w, _PLAIN) == str.translate(m, _PLAIN) for w, m in zip(b["word"], b["meant"], strict=True)]  # only without its accents
            keep = (p >= accept) & ((x[:, 2] == 0) | inside) & ~np.array(plain, bool)
            yield pd.DataFrame({"word": b["word"][keep], "meant": b["meant"][keep], "p": p[keep], "n_meant": b["n_meant"][keep]})

    ranked = pairs.mapInPandas(rank, "word string, meant string, p double, n_meant long")
    return ranked.groupBy("word").agg(F.max_by("meant", F.struct("p", "n_meant", "meant")).alias("meant")), model


def fit_words(sample: list[tuple[str, int]], weights: dict[str, float], total: float, seed: int = 11) -> list:
    """Model over pairs of words: misread clean words are positive; other look-alikes of them, and pairs of clean words, negative."""
    rng = np.random.default_rng(seed)
    known = {w for w, _ in sample}
    by_gram: dict[str, list[tuple[str, int]]] = {}
    for w, n in sample:
        for g in _grams(w):
            by_gram.setdefault(g, []).append((w, n))
    x, y = [], []
    for w, n in sample:
        for k in range(4):
            bad = misread(w, rng)
            if k == 3 and len(w) >= 6:  # a letter that the table doesn't have
                at = int(rng.integers(1, len(w) - 2))
                bad = w[:at] + "abcdefghijlmnopqrstuvxz"[int(rng.integers(23))] + w[at + 1 :]
            odd = strange(bad, 0, weights, total)
            if bad == w or bad in known or k == 3 and odd < STRANGE:
                continue
            seen = max(1.0, n / float(rng.integers(15, 3000)))
            x.append(_features(bad, w, seen, n, odd))
            y.append(1)
            near = [c for g in list(_grams(bad))[:4] for c in by_gram.get(g, [])[:4] if c[0] != w]
            for c, m in near[:3]:
                x.append(_features(bad, c, seen, m, odd))
                y.append(0)
        near = [c for g in list(_grams(w))[:4] for c in by_gram.get(g, [])[:6] if c[0] != w and abs(len(c[0]) - len(w)) <= 2]
        for c, m in near[:4]:
            x.append(_features(w, c, max(1.0, m / float(rng.integers(15, 3000))), m, strange(w, n, weights, total)))
            y.append(0)
    return boost(np.array(x, float).reshape(len(x), 9), np.array(y, float)) if x else []


def line_features(lines: list[str], i: int, width: float, heads: set[str], times: Counter) -> list[float]:
    """Whether line i is furniture: seen with the lines before and after it."""
    line = lines[i].strip(" \t\x0c\r")
    before = next((x.strip() for x in reversed(lines[:i]) if x.strip()), "")
    after = next((x.strip() for x in lines[i + 1 :] if x.strip()), "")
    digits = sum(c.isdigit() for c in line)
    return [
        float(bool(_PAGE_LINE.match(line))), float(bool(_PAGE.search(line))), digits / max(1, len(line)), len(line) / max(1.0, width), float(i == 0), float(not after),
        float(bool(before) and before[-1] not in ".:;!?"), float(after[:1].islower() or after[:1].isdigit()), float(bool(_PAGE_LINE.match(before))), float("\x0c" in lines[i]), float(line.endswith(".") or line.endswith(":")), float(re.sub(r"\d+", "#", line) in heads), float(bool(re.search(r"\s{2,}|[|]|\.\.", line))), float(line[:1].islower()),
        float(min(times[_masked(line)], 4)), float(bool(_PAGE_HEAD.match(line))), float(bool(before) and before[-1:].isalpha() and before[-1:].islower()),
    ]


def _heads(lines: list[str]) -> set[str]:
    """Lines (digits aside) that follow a page line or a form feed."""
    out = set()
    for i in range(1, len(lines)):
        line = lines[i].strip(" \t\x0c\r")
        if line and (_PAGE_LINE.match(lines[i - 1].strip(" \t\x0c\r")) and lines[i - 1].strip() or "\x0c" in lines[i]):
            out.add(re.sub(r"\d+", "#", line))
    return {h for h in out if sum(re.sub(r"\d+", "#", x.strip(" \t\x0c\r")) == h for x in lines) > 1 or re.search(r"\||\s{2}|\.\.|(?i:servi[cç]o|hospital|cl[ií]nica|centro|unidade|laudo de exame|via digitalizada)", h)}


def fit_lines(clean: list[str], seed: int = 12) -> list:
    """Model over lines: furniture put into clean reports is positive, their own lines negative."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    forms = ["- {n} -", "{n}", "[pág {n}]", "fl. {n}", "Folha {n} de {m}", "Página {n} de {m}", "Pág. {n}/{m}", "P á g i n a  {n}", "pag {n}", "{n}/{m}", "Page {n} of {m}", "fls. {n}", "PÁGINA {n}", "Página {n} de {m} - {t}", "pg. {n}", "Pág. {n} | {t}", "{t} - pág. {n}"]
    heads = ["LAUDO DE EXAME | {t}", "Serviço de Imagem - {t}", "{t}  ..  via digitalizada", "Hospital {t}", "{t}"]
    for text in clean * max(1, 400 // max(1, len(clean))):
        lines = [x for x in _LINES.split(text) if x.strip()]
        if len(lines) < 4 or _again(Counter(map(_masked, lines))):  # may hold headers itself
            continue
        width = float(np.median([len(v) for v in lines]))
        for i in range(len(lines)):
            if rng.random() < 0.3 or i in (0, len(lines) - 1):
                x.append(line_features(lines, i, width, _heads(lines), Counter(map(_masked, lines))))
                y.append(0)
        form, head = forms[int(rng.integers(len(forms)))], heads[int(rng.integers(len(heads)))] if rng.random() < 0.6 else None
        alone = head is not None and rng.random() < 0.3  # headers without page numbers
        made, marks, step, m = [], [], int(rng.integers(2, min(12, max(4, len(lines)))) if not alone else rng.integers(1, max(3, len(lines) // 2))), 1 + len(lines) // 4
        tails: set[int] = set()
        title = " ".join(lines[int(rng.integers(len(lines)))].split()[:4]).strip(".,:;")[:40]
        title = (title.title(), title.upper(), title.lower())[int(rng.integers(3))]
        for i, v in enumerate(lines):
            words = v.split(" ")
            if len(words) > 4 and not _PAGE_LINE.match(words[-1]) and rng.random() < 0.1:  # the end of a sentence on a line of its own
                made += [" ".join(words[:-1]), words[-1]]
                marks += [0, 0]
                tails.add(len(made) - 1)
            else:
                made.append(v)
                marks.append(0)
            if rng.random() < 0.05 and not alone:  # a report's own line that comes again
                made.append(lines[int(rng.integers(i + 1))])
                marks.append(0)
            if (i + 1) % step == 0 or i == len(lines) - 1 and rng.random() < 0.7:
                if not alone:
                    made.append(form.format(n=1 + sum(marks), m=m, t=title))
                    marks.append(1)
                if head and i < len(lines) - 1:
                    made.append(("\x0c" if rng.random() < 0.5 else "") + head.format(t=title))
                    marks.append(1)
        hs, times = _heads(made), Counter(map(_masked, made))
        for i, mark in enumerate(marks):
            if mark or i in tails and rng.random() < 0.5 or times[_masked(made[i])] > 1 or rng.random() < 0.1:
                x.append(line_features(made, i, width, hs, times))
                y.append(mark)
    return boost(np.array(x, float).reshape(len(x), 17), np.array(y, float)) if x else []


def halves_features(a: str, b: str, sign: str, joined: float, compound: float, n_a: float, n_b: float, total: float) -> list[float]:
    """Whether two halves at a line end are one divided word; counts are shares of the most frequent word's."""
    share = lambda n: float(np.log((n + 0.1) / (total + 0.1)))
    return [share(joined), share(compound), share(min(n_a, n_b)), share(joined) - share(compound), float(sign == "-"), float(a.isalpha()), float(b[:1].islower()), min(len(a), len(b))]


def fit_halves(counts: dict[str, int], total: float, seed: int = 13) -> list:
    """Model over halves: divided words are positive, compounds and pairs of words negative."""
    rng = np.random.default_rng(seed)
    words = [w for w in counts if "-" not in w and len(w) >= 5]
    x, y = [], []
    for w in words:
        k = int(rng.integers(2, len(w) - 1))
        a, b, sign = w[:k], w[k:], HYPHENS[int(rng.integers(4))]
        x.append(halves_features(a, b, sign, counts[w], 0, counts.get(a, 0), counts.get(b, 0), total))
        y.append(1)
    pairs = [tuple(w.split("-", 1)) for w in counts if "-" in w] * 3 + [(words[int(rng.integers(len(words)))], words[int(rng.integers(len(words)))]) for _ in words]
    for a, b in pairs:
        x.append(halves_features(a, b, "-", counts.get(a + b, 0), counts.get(f"{a}-{b}", 0), counts.get(a, 0), counts.get(b, 0), total))
        y.append(0)
    return boost(np.array(x, float).reshape(len(x), 8), np.array(y, float)) if x else []


class Reader:
    """Finds and repairs the noise of one text."""

    def __init__(self, lines_model: list):
        self.lines_model = lines_model
        self.split = re.compile(f"([{LETTERS}0-9@!|$]+)([{HYPHENS}])$")
        self.begin = re.compile(f"^([{LETTERS}0-9@!|$]+)")

    def furniture(self, lines: list[str]) -> list[bool]:
        if len(lines) < 3:
            return [False] * len(lines)
        times = Counter(map(_masked, lines))
        if not _again(times) and not any("\x0c" in x or x.strip() and (_PAGE_LINE.match(x.strip(" \t\x0c\r")) or _PAGE_HEAD.match(x)) for x in lines):
            return [False] * len(lines)
        width = float(np.median([len(v) for v in lines if v.strip()] or [1]))
        heads = _heads(lines)
        x = np.array([line_features(lines, i, width, heads, times) for i in range(len(lines))], float)
        p = predict(self.lines_model, x)
        return [bool(a >= 0.5 and v.strip()) for a, v in zip(p, lines, strict=True)]

    def halves(self, lines: list[str], furniture: list[bool]) -> list[tuple[int, int, str, str, str]]:
        """(line, next line of the report, first half, second half, sign) of every word that may be divided."""
        out = []
        for i, line in enumerate(lines):
            m = None if furniture[i] else self.split.search(line.rstrip())
            if m:
                j = next((k for k in range(i + 1, len(lines)) if lines[k].strip() and not furniture[k]), None)
                n = self.begin.match(lines[j].strip(" \t\x0c")) if j is not None else None
                if n:
                    out.append((i, j, m.group(1).lower(), n.group(1).lower(), m.group(2)))
        return out

    def repair(self, text: str, meant: dict[str, str], divided: set[str]) -> str:
        """The text as continuous paragraphs: furniture out, divided words and lines together, misread words put right."""
        lines = _LINES.split(text)
        out = self.furniture(lines)
        gone = {i: sign for i, _, a, b, sign in self.halves(lines, out) if f"{a} {b} {sign}" in divided}
        noisy = any(out) or bool(gone)
        kept: list[str] = []
        glue = ""
        for i, line in enumerate(lines):
            if out[i]:
                continue
            line = line.replace("\x0c", "").rstrip() if noisy else line
            flows = noisy and kept and line.strip() and kept[-1].strip() and not re.match(r"\s*(?:[-•*]\s|[A-ZÁÉÍÓÚÂÊÔÃÕÇ][A-ZÁÉÍÓÚÂÊÔÃÕÇ ]+:)", line) and not kept[-1].rstrip().endswith((".", ":", ";", "!", "?")) and len(kept[-1].strip()) > 3 and kept[-1].upper() != kept[-1]
            if glue == "word" and kept:
                kept[-1] += line.lstrip()
            elif flows:
                kept[-1] = kept[-1].rstrip() + " " + line.strip()
            else:
                kept.append(line)
            glue = ""
            if i in gone and kept:
                kept[-1] = kept[-1].rstrip()[:-1]
                glue = "word"

        def put(m: re.Match) -> str:
            w = m.group()
            good = meant.get(w.lower())
            if good is None:
                return w
            letters = [c for c in w if c.isalpha()]
            return good.upper() if len(letters) > 1 and all(c.isupper() for c in letters) else good.capitalize() if letters and w[0].isupper() else good

        whole = "\n".join(kept) if noisy else text
        return _TOKEN.sub(put, whole) if meant else whole


def _lines(batches: Iterator[pa.RecordBatch], model: list, misread_words: set[str] | None = None) -> Iterator[pa.RecordBatch]:
    """Text last; out go the other columns, whether there is furniture, the halves at line ends, and whether a word is a misread one."""
    reader = Reader(model)
    for b in batches:
        page, halves, bad = [], [], []
        for text in b.columns[-1].to_pylist():
            lines = _LINES.split(text) if text else []
            out = reader.furniture(lines)
            page.append(any(out))
            halves.append(sorted({f"{a} {c} {s}" for _, _, a, c, s in reader.halves(lines, out)}))
            bad.append(bool(text and misread_words and not misread_words.isdisjoint(words_in(text))))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(page, pa.bool_()), pa.array(halves, pa.list_(pa.string())), pa.array(bad, pa.bool_())], [*b.schema.names[:-1], "page", "halves", "bad"])


class Noise:
    """The models and tables of one corpus, ready to be applied to its texts."""

    def __init__(self, texts: DataFrame, text_col: str = "text", training_rows: int = 4000, broadcast_rows: int = 200_000):
        self.text_col, self.broadcast_rows = text_col, broadcast_rows
        self.counts = cut(word_counts(texts, text_col))
        meant, self.word_model = corrections(self.counts, training_rows=training_rows)
        meant = cut(meant)
        few = [r[0] for r in meant.select("word").limit(broadcast_rows + 1).collect()]  # bounded
        self.misread = set(few) if len(few) <= broadcast_rows else None
        self.meant = F.broadcast(meant) if self.misread is not None else meant
        clean = texts.filter(F.col(text_col).isNotNull() & ~F.col(text_col).rlike("\\x0c|(?i:p\\s?[aá]\\s?g|folha|\\bfls?\\b)|(?m:^[^\\p{L}\\n]*\\d{1,4}[^\\p{L}\\n]*$)")).select(text_col)  # fit on texts without any line that could be furniture
        self.line_model = fit_lines([r[0] for r in clean.filter(F.length(text_col).between(200, 20000)).orderBy(F.md5(text_col)).limit(training_rows // 10).collect()])
        common = self.counts.filter(F.col("word").rlike(f"^[{LETTERS}]+(-[{LETTERS}]+)?$")).orderBy(F.desc("texts"), "word").limit(training_rows // 2).collect()
        self.total = max([r[1] for r in common], default=0)
        self.halves_model = fit_halves({r[0]: r[1] for r in common}, self.total)

    def _sized(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= self.broadcast_rows else df

    def seen(self, texts: DataFrame, keys: list[str]) -> DataFrame:
        """``keys, page, halves, bad`` of every row."""
        model, known, fields = self.line_model, self.misread, {f.name: f.dataType.simpleString() for f in texts.schema.fields}
        schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "page boolean, halves array<string>, bad boolean"])
        return spread(texts.select(*keys, F.col(self.text_col).cast("string").alias("_text"))).mapInArrow(lambda b: _lines(b, model, known), schema)

    def divided(self, halves: DataFrame) -> DataFrame:
        """``half``: of the distinct halves at line ends, those that are one word."""
        parts = F.split("half", " ")
        own = halves.distinct().select("half", parts[0].alias("a"), parts[1].alias("b"), parts[2].alias("sign"))
        for name, word in (("joined", F.concat("a", "b")), ("compound", F.concat_ws("-", "a", "b")), ("n_a", F.col("a")), ("n_b", F.col("b"))):
            own = own.withColumn("_w", word).join(self.counts.select(F.col("word").alias("_w"), F.col("texts").alias(name)), "_w", "left").drop("_w")
        model, total = self.halves_model, self.total

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                b = b.fillna(0)
                x = np.array([halves_features(*t, total) for t in zip(b["a"], b["b"], b["sign"], b["joined"], b["compound"], b["n_a"], b["n_b"], strict=True)], float).reshape(len(b), 8)
                yield b.loc[predict(model, x) >= 0.5, ["half"]]

        return own.mapInPandas(judge, "half string")

    def found(self, texts: DataFrame, keys: list[str]) -> DataFrame:
        """``keys, tipo``: one row per record and kind of noise."""
        seen = cut(self.seen(texts, keys).filter("page or bad or size(halves) > 0"))
        pages = seen.filter("page").select(*keys, F.lit("pagina").alias("tipo"))
        split = seen.select(*keys, F.explode("halves").alias("half"))
        words = split.join(self._sized(cut(self.divided(split.select("half")))), "half", "left_semi").select(*keys, F.lit("hifenizacao").alias("tipo"))
        bad = seen.filter("bad").select(*keys)
        if self.misread is None:  # too many misread words to send along
            low = F.array_distinct(F.regexp_extract_all(F.lower(F.col(self.text_col)), F.lit(f"({_WORD})"), 1))
            bad = texts.select(*keys, F.explode(low).alias("word")).join(self.meant, "word", "left_semi").select(*keys)
        return pages.unionByName(words).unionByName(bad.select(*keys, F.lit("caractere").alias("tipo"))).distinct()

    def repair(self, texts: DataFrame, keys: list[str]) -> DataFrame:
        """``keys, text, repaired``: every row with its text as continuous readable paragraphs."""
        own = texts.select(*keys, F.col(self.text_col).cast("string").alias("text"))
        each = own.filter("text <> ''").withColumn("_id", F.md5("text"))
        once = each.select("_id", "text").distinct()  # copies are looked at once
        low = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(f"({_WORD})"), 1))
        bad = once.select("_id", F.explode(low).alias("word")).join(self.meant, "word").groupBy("_id").agg(F.map_from_entries(F.collect_set(F.struct("word", "meant"))).alias("_meant"))
        split = self.seen(once.withColumnRenamed("text", self.text_col), ["_id"]).select("_id", F.explode("halves").alias("half"))
        parts = split.join(self._sized(cut(self.divided(split.select("half")))), "half").groupBy("_id").agg(F.collect_set("half").alias("_divided"))
        model = self.line_model

        @F.pandas_udf("string")
        def put_right(text: pd.Series, meant: pd.Series, divided: pd.Series) -> pd.Series:
            reader = Reader(model)
            ready = lambda m: dict(m) if m is not None else {}
            return pd.Series([None if t is None else reader.repair(t, ready(m), set(d) if d is not None else set()) for t, m, d in zip(text, meant, divided, strict=True)])

        fixes = bad.join(parts, "_id", "full")
        joined = each.join(fixes, "_id", "left")
        done = joined.select(*keys, "text", put_right("text", "_meant", "_divided").alias("repaired"))
        return done.unionByName(own.filter("text is null or text = ''").withColumn("repaired", F.col("text")))
