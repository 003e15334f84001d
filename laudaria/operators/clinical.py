"""Configurable engines over report texts: lexicons with negation, categories, measures, rule ladders.

Everything is one expression per row (that of ``category_words`` in Arrow batches, as it runs to a fixpoint): no report is exploded and gathered again, so no shuffle is needed. The lexicon is a parameter;
what belongs to one specialty lives in its configuration, not here.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laudaria.functions.report import blocks, sentences, words
from laudaria.functions.text import norm_in_place, stem


@dataclass(frozen=True)
class Lexicon:
    """Folded terms: organs that open a block, keywords that make it worth a look, findings, negators."""

    findings: dict[str, list[str]]
    organs: list[str] = field(default_factory=list)
    keywords: list[str] = field(default_factory=list)
    negators: list[str] = field(default_factory=lambda: ["sem", "nao", "ausencia", "ausente", "negativo"])
    before: int = 7
    after: int = 7


def _pattern(terms: list[str]) -> str:
    return "(?<![a-z0-9_])(?:" + "|".join(t.replace(" ", "\\s+") for t in terms) + ")(?![a-z0-9_])"


def _terms(lexicon: Lexicon) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("finding"), F.array(*(F.lit(w) for w in t.split())).alias("term")) for k, terms in lexicon.findings.items() for t in terms))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def has_any(tokens: Column, terms: list[str]) -> Column:
    """Whether a token list holds any term: single words by membership, several as a run."""
    single = [t for t in terms if " " not in t]
    out = F.arrays_overlap(tokens, F.array(*(F.lit(t) for t in single))) if single else F.lit(False)
    for t in terms:
        if " " in t:
            out = out | F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" ")).contains(f" {t} ")
    return F.coalesce(out, F.lit(False))


def hits(tokens: Column, lexicon: Lexicon, strict_start: bool = False) -> Column:
    """``array<struct<finding, position, negated>>``: terms found in a token list.

    A hit is negated by a negator among the ``before`` tokens to its left, the ``after`` to its right, or at its own start.
    With ``strict_start`` a hit nearer to the start than ``before`` has no left side, as in slices that begin below zero.
    """
    return let(tokens, lambda bound: _hits(bound, lexicon, strict_start))


def _hits(tokens: Column, lexicon: Lexicon, strict_start: bool) -> Column:
    def at(i: Column) -> Column:
        def one(t: Column) -> Column:
            k = F.size(t["term"])
            start = F.greatest(i - lexicon.before, F.lit(1))
            size = i - start
            if strict_start:
                size = F.when(i - 1 < lexicon.before, F.lit(0)).otherwise(size)
            left = F.slice(tokens, start, size)
            right = F.slice(tokens, i + k, F.lit(lexicon.after))
            own = F.slice(tokens, i, F.lit(1))
            return F.struct(t["finding"].alias("finding"), i.cast("int").alias("position"), (has_any(left, lexicon.negators) | has_any(right, lexicon.negators) | has_any(own, lexicon.negators)).alias("negated"))

        here = F.filter(_terms(lexicon), lambda t: F.slice(tokens, i, F.size(t["term"])) == t["term"])
        return F.transform(here, one)

    first = F.array(*(F.lit(w) for w in sorted({t.split()[0] for terms in lexicon.findings.values() for t in terms})))
    numbered = F.transform(tokens, lambda t, i: F.when(F.array_contains(first, t), i + 1))
    return F.flatten(F.transform(F.filter(numbered, lambda i: i.isNotNull()), at))


def find_in_sentences(text: Column, lexicon: Lexicon) -> Column:
    """Hits of every sentence of a text; a negator never reaches into the next sentence."""
    return F.flatten(F.transform(sentences(text, "\\n+|(?<=[.;!?])\\s+"), lambda s: hits(words(s), lexicon)))


def confidence(negated: Column) -> Column:
    return F.when(negated, 0.35).otherwise(0.9)


def assess(df: DataFrame, text: str, lexicon: Lexicon) -> DataFrame:
    """Add ``achados`` (findings not negated, each once), ``negados`` and ``relevante``."""
    out = df.withColumn("_hits", F.coalesce(find_in_sentences(F.col(text), lexicon), F.array().cast("array<struct<finding:string,position:int,negated:boolean>>")))
    names = lambda wanted: F.array_sort(F.array_distinct(F.transform(F.filter("_hits", lambda h: h["negated"] == wanted), lambda h: h["finding"])))
    return out.withColumns({"achados": names(F.lit(False)), "negados": names(F.lit(True))}).withColumn("relevante", F.size("achados") > 0).drop("_hits")


def assess_blocks(df: DataFrame, text: str, lexicon: Lexicon, strict_start: bool = True, whole: bool = False) -> DataFrame:
    """Block rule: a block opens at each sentence with an organ; findings count only in blocks with a keyword. With ``whole`` the document is one block.

    Adds ``blocos``: ``array<struct<bloco, relevante, achados>>``, and ``relevante``.
    """

    def one(b: Column) -> Column:
        found = F.when(norm_in_place(b).rlike("|".join(lexicon.keywords) or "^"), hits(words(b), lexicon, strict_start)).otherwise(F.array().cast("array<struct<finding:string,position:int,negated:boolean>>"))
        good = F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda h: ~h["negated"]), lambda h: h["finding"])))
        return let(good, lambda g: F.struct(b.alias("bloco"), (F.size(g) > 0).alias("relevante"), g.alias("achados")))

    out = df.withColumn("blocos", F.transform(F.when(F.col(text).isNotNull(), F.array(text)) if whole else blocks(F.col(text), _pattern(lexicon.organs)), one))
    return out.withColumn("relevante", F.coalesce(F.exists("blocos", lambda b: b["relevante"]), F.lit(False)))


def _places(text: Column, term: str) -> Column:
    """Where a term begins, from 1, overlapping ones included."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.when((a["at"] > 1) | text.startswith(term), F.array_append(a["found"], a["at"])).otherwise(a["found"]).alias("found"))
    return F.aggregate(F.split(text, f"(?={re.escape(term)})"), start, step, lambda a: a["found"])


def near(text: Column, finding: str, organ: str, reach: int = 200) -> Column:
    """Whether a finding begins within ``reach`` characters of the start or end of a mention of the organ; null for a null text."""
    places = let(norm_in_place(text), lambda t: F.struct(_places(t, finding).alias("f"), _places(t, organ).alias("o")))
    return let(places, lambda p: F.exists(p["f"], lambda f: F.exists(p["o"], lambda o: F.least(F.abs(f - o), F.abs(f - (o + len(organ)))) <= reach)))


def valid_terms(candidates: Column, seeds: list[str], generic: list[str]) -> Column:
    """Of folded candidate terms those that can stand for the seeds: not empty, of two words or more if any seed is, no generic word by itself, and sharing a word or a stem with a seed."""
    known = sorted({w for s in seeds for w in s.split()})
    roots = F.array(*(stem(F.lit(w)) for w in known)) if known else F.array().cast("array<string>")
    least = 2 if any(" " in s for s in seeds) else 1

    def valid(t: Column) -> Column:
        w = F.filter(F.split(F.trim(t), "\\s+"), lambda x: F.length(x) > 0)
        shared = F.arrays_overlap(w, F.array(*(F.lit(x) for x in known))) | F.arrays_overlap(F.transform(w, stem), roots) if known else F.lit(False)
        return let(w, lambda _: (F.size(w) >= least) & ~((F.size(w) == 1) & F.element_at(F.concat(w, F.array(F.lit(""))), 1).isin(generic)) & shared)

    return F.filter(candidates, lambda t: F.coalesce(valid(t), F.lit(False)))


def spans(text: Column, lexicon: Lexicon) -> Column:
    """``array<struct<finding, start, end>>``: where the terms of each finding stand in a text, from 1, end exclusive; whole words only, nested terms included."""
    low = norm_in_place(text)

    def of(t: Column, finding: str, term: str) -> Column:
        edge = lambda at: F.concat(F.lit(" "), t, F.lit(" ")).substr(at, F.lit(len(term) + 2)).rlike("^[^a-z0-9_].*[^a-z0-9_]$")
        return F.transform(F.filter(_places(t, term), edge), lambda at: F.struct(F.lit(finding).alias("finding"), at.cast("int").alias("start"), (at + len(term)).cast("int").alias("end")))

    return let(low, lambda t: F.array_sort(F.concat(*(of(t, k, x) for k, terms in lexicon.findings.items() for x in terms)), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["end"] - b["end"])))


def nearest_in_sentences(text: Column, finding: str, organs: dict[str, list[str]], target: str, margin: int = 25) -> Column:
    """Whether some sentence has the finding with the target as its nearest organ, by the middles of all mentions; an organ that is nearer by no more than ``margin`` doesn't count.

    A sentence that doesn't name the target keeps its finding. All organs have to be given, not only the target. Null text: false.
    """

    def sentence(s: Column) -> Column:
        def middle_of(t: str) -> Column:
            return F.transform(_places(s, t), lambda at: at + len(t) / 2.0)

        middles = lambda terms: F.concat(*(middle_of(t) for t in terms))
        away = lambda f, terms: F.array_min(F.transform(middles(terms), lambda o: F.abs(f - o)))
        others = [t for name, terms in organs.items() if name != target for t in terms]

        def kept(f: Column) -> Column:
            mine, theirs = away(f, organs[target]), away(f, others) if others else F.lit(None).cast("double")
            return F.coalesce(mine <= theirs + margin, F.lit(True))

        return F.exists(middles([finding]), kept)

    return F.coalesce(F.exists(sentences(norm_in_place(text), "\n+|(?<=[.;!?])\\s+"), sentence), F.lit(False))


def nearest(distances: dict[str, Column], target: str, margin: int = 25) -> Column:
    """Whether the target is the nearest of several organs, or loses by no more than the margin; null distances are absent organs."""
    others = [d for k, d in distances.items() if k != target]
    best = F.least(*others, F.lit(None).cast("int")) if others else F.lit(None).cast("int")
    return F.coalesce(distances[target] <= best + margin, F.lit(True))


#: What isn't a category in a structured breast report, in the order in which it goes; the whole list is run until nothing changes.
NOT_A_CATEGORY = [
    (r"\b\d{1,2}[.,]?\d*\s*(?:cm|h)\b", ""), (r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", ""), (r"\b0(\d)\b", r"\1"),
    (r"\b(?:ha|existem|existe|esquerda|esquerdo|controle|direito|direita)\s*(?!\(\s*\d+\s+\w+\s*\))\d+\b", ""), (r"\b\d{1,2}\s*mes(?:es)?\b", ""),
    (r"(?m)^\d+\s*-\s*", ""), (r"(\d+)\s*-\s*[A-Za-z]{1,2}\b", r"\1"), (r"(\d+)\s*-\s*", r"\1"), (r"-", "_"), (r"\n(?:iv|v|iii)", " "), (r"\b\d+\s*(?:horas?|anos?)\b", " "),
    (r"\n(?:ii|i)?", " "), (r"[^\w\s()]", ""), (r"\s+", " "), (r" _ ", " "), (r"categoria", " categoria "), (r"\d+\s*mes(?:es)?", " "), (r"\((\d+)\s+bi_rads\)", r"(bi_rads \1)"), (r"[^\w\s]", ""),
]
#: Spellings of the keyword, sizes, and the citation of the standard with what follows it.
KEYWORD = r"\b(?:bi[ _]?rads?|br[ _]?rads|birads_acr|brads_acr|acr[ _]?(?:bi|br)rads|acrbi[ _]?rads|acr b[a-z][ _]?rads)\b"
CITATIONS = [r"colegio americano (?:de )?radiologia bi_rads 5.? ed(?:icao)? 2013", r"relatorio baseado 5a edicao acr bi_rads", r"relatorio baseado.{25}", r"colegio americano.{30}", r"\b\d+\s*(?:mm|x|cm)\b"]
SMALL_WORDS = ["ao", "aos", "as", "com", "da", "das", "de", "do", "dos", "em", "na", "nas", "no", "nos", "os", "ou", "para", "pela", "pelo", "por", "que", "se", "um", "uma"]


def category_words(text: Column) -> Column:
    """Words of a structured report, ready for ``category``: normalised until nothing changes, spellings of the keyword made one, citations and small words (of two letters and more) left out."""

    @F.pandas_udf("array<string>")
    def ready(texts: pd.Series) -> pd.Series:
        rules = [(re.compile(p), r) for p, r in NOT_A_CATEGORY]
        keyword, citations = re.compile(KEYWORD), [re.compile(p) for p in CITATIONS]

        def one(t: str | None) -> list[str] | None:
            if t is None:
                return None
            before = None
            while t != before:  # every rule shortens the text or leaves it as it is, but for signs that become others once
                before = t
                t = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
                for pattern, new in rules:
                    t = pattern.sub(new, t)
                t = t.strip()
            t = keyword.sub(" bi_rads ", t.replace("bi _rads", "bi_rads"))
            for pattern in citations:
                t = pattern.sub(" ", " ".join(t.split()))
            return [w for w in t.split() if w not in SMALL_WORDS]

        return texts.map(one)

    return ready(text)


def category(text: Column, before: int = 3, after: int = 2) -> Column:
    """Category of a structured report: the numbers among the words near its keyword, or in the keyword itself.

    Sizes, dates, ages, months of control and the citation of the standard are no categories (``category_words``). Small roman numerals between others
    count as numbers; only single digits count; keyword without a number: 0; a 9 beside exactly one other number, 7, 8: -1; the largest wins; no keyword or null: -1.
    """
    roman = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5"}
    key = "^(?:bi_rads|birads|categoria)"

    def judge(w: Column) -> Column:
        keys = F.filter(F.transform(w, lambda x, i: F.when(x.rlike(key), i + 1)), lambda x: x.isNotNull())
        around = F.flatten(F.transform(keys, lambda k: F.concat(F.slice(w, F.greatest(k - before, F.lit(1)), k - F.greatest(k - before, F.lit(1))), F.slice(w, k, F.lit(after + 1)))))
        written = F.transform(around, lambda x: F.coalesce(*(F.when(x == r, d) for r, d in roman.items()), x))
        digits = F.filter(F.flatten(F.transform(written, lambda x: F.regexp_extract_all(x, F.lit("([0-9]+)"), 1))), lambda x: F.length(x) == 1)
        value = lambda g: F.array_max(F.transform(g, lambda d: F.when(d.isin("7", "8", "9"), F.lit(-1)).otherwise(d.cast("int"))))
        found = lambda g: F.when(F.size(g) == 0, 0).when((F.size(g) == 2) & F.array_contains(g, "9"), -1).otherwise(value(g))
        return F.when(F.size(keys) > 0, let(digits, found)).otherwise(-1)

    return F.coalesce(let(category_words(text), judge), F.lit(-1))


#: What comes before a measure, and what may stand between; else a nodule and the measure behind it.
MEASURED = "(?iU)\\b(?:medindo|com|inferiores a|menores)(?:\\s+(?:cerca\\s+de|aprox\\.?|aproximadamente|que|do que|que fizeram|até|ate|em\\s+torno\\s+de))?\\s+(\\d+(?:\\.\\d+)?(?:\\s*x\\s*\\d+(?:\\.\\d+)?){0,2}\\s*(?:mm|cm))\\b"
NODULE = "(?iU)\\bn[óo]dulos?\\b[^.]{0,120}?(?:\\bde\\b\\s*)?(\\d+(?:\\.\\d+)?\\s*(?:mm|cm))\\b"


def largest_measure(sentence: Column) -> Column:
    """Largest axis in millimetres of the measures that a cue announces ("medindo", "com", "menores que"), or else of those after "nódulo"; null for none.

    What stands in brackets about an earlier exam or a comparison doesn't count. ``×`` is ``x``, a comma a point.
    """
    s = F.regexp_replace(sentence, "(?i)\\([^)]*(?:anterior|pr[eé]vio|comparad)[^)]*\\)", "")
    s = F.replace(F.replace(s, F.lit("×"), F.lit("x")), F.lit(","), F.lit("."))
    one = lambda m: F.array_max(F.transform(F.regexp_extract_all(m, F.lit("(\\d+(?:\\.\\d+)?)"), 1), lambda n: n.cast("double"))) * F.when(F.lower(m).endswith("cm"), 10.0).otherwise(1.0)
    largest = lambda pattern: F.array_max(F.transform(F.regexp_extract_all(s, F.lit(pattern), 1), one))
    return F.coalesce(largest(MEASURED), largest(NODULE))


def gated_sentences(text: Column, terms: list[str], least_mm: float) -> Column:
    """Sentences that name one of the terms and hold a measure of at least ``least_mm``."""
    return F.filter(sentences(text, "\\n+|;|(?<=[.!?])\\s+"), lambda s: norm_in_place(s).rlike(_pattern(terms)) & (F.coalesce(largest_measure(s), F.lit(0.0)) >= least_mm))


def context_positive(text: Column, terms: list[str], negators: list[str], confirmations: list[str], ignore: list[str], reach: int = 70) -> Column:
    """Positive if any sentence names a term without a negator within ``reach`` characters on either side, or a confirmation; sentences of history don't count."""
    t, n = _pattern(terms), _pattern(negators)
    kept = F.filter(sentences(norm_in_place(text), "[.!?\\n]+"), lambda s: (F.size(F.split(s, "\\s+")) > 1) & (~s.rlike(_pattern(ignore)) if ignore else F.lit(True)))
    named = F.exists(kept, lambda s: s.rlike(t) & ~s.rlike(f"(?:{n}).{{0,{reach}}}(?:{t})|(?:{t}).{{0,{reach}}}(?:{n})"))
    return F.coalesce(named | (F.exists(kept, lambda s: s.rlike(_pattern(confirmations))) if confirmations else F.lit(False)), F.lit(False))


def ladder(rules: list[tuple[Column, Column | str]], default: str | None = None) -> Column:
    """Ordered rules of which the last that holds wins."""
    out = None
    for cond, value in reversed(rules):
        v = F.lit(value) if isinstance(value, str) else value
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def summary_line(text: Column, term: Column, width: int = 300, negators: tuple[str, ...] = ("sem", "nao", "ausencia", "ausente", "negativo")) -> Column:
    """The line that says best what was found: one of the conclusion, else the first that names the term, cut to ``width``; lines that deny something don't count, and without another there is none."""
    denied = lambda s: norm_in_place(s).rlike(_pattern(list(negators)))
    named = F.filter(sentences(text), lambda s: F.contains(norm_in_place(s), term) & ~denied(s))
    late = F.filter(F.split(F.regexp_extract(text, "(?isU)(?:conclus[aã]o|impress[aã]o[^:\\n]*|opini[aã]o)\\s*:\\s*(.*)$", 1), "\n"), lambda s: F.contains(norm_in_place(s), term) & ~denied(s))
    return F.substring(F.coalesce(F.get(late, 0), F.get(named, 0)), 1, width)


def expand(candidates: DataFrame, seeds: DataFrame, text_col: str, vector_col: str, id_cols: list[str], least: float = 0.65, k: int = 24) -> DataFrame:
    """Semantic expansion: candidates that share a word with a seed, scored 0.75 cosine + 0.25 word overlap, best ``k`` of each seed.

    ``seeds`` has ``seed, seed_vector``; candidates and seeds meet by an equi-join on their words, never all with all.
    """
    from laudaria.functions.values import cosine
    from laudaria.operators.relational import top_k

    own = candidates.select(*id_cols, text_col, F.col(vector_col).alias("_v"), F.array_distinct(words(F.col(text_col))).alias("_w"))
    s = seeds.select("seed", "seed_vector", F.array_distinct(words(F.col("seed"))).alias("_sw"))
    met = own.withColumn("_x", F.explode("_w")).join(s.withColumn("_x", F.explode("_sw")), "_x").dropDuplicates([*id_cols, "seed"])
    overlap = F.size(F.array_intersect("_w", "_sw")) / F.size(F.array_union("_w", "_sw"))
    scored = met.withColumn("score", F.round(0.75 * cosine(F.col("_v"), F.col("seed_vector")) + 0.25 * overlap, 6)).filter(F.col("score") >= least)
    return top_k(scored.select(*id_cols, text_col, "seed", "score"), ["seed"], [F.desc("score"), *(F.col(c) for c in id_cols)], k)
