"""Cleaning and segmentation of report texts. Column functions of the JVM where patterns suffice; Arrow UDFs for markup."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from laudaria.functions.text import norm_in_place

_TAGS = "html|body|div|p|br|span|table|tr|td|font|b|strong|ul|li|h[1-6]"
_BREAKS = {"p", "div", "br", "tr", "li", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "header", "footer"}


def format_of(c: Column) -> Column:
    """'rtf', 'html' or 'plain', from the first characters; null for null."""
    head = F.lower(F.substring(c, 1, 2000))
    return F.when(c.isNull(), None).when(F.ltrim(F.substring(c, 1, 128)).rlike("^\\{?\\\\rtf"), "rtf").when(head.rlike(f"<\\s*/?\\s*({_TAGS})\\b"), "html").otherwise("plain")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "noscript")
        if tag in _BREAKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "noscript") and self.skip > 0
        if tag in _BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def html_to_text(text: str) -> str:
    """Text of a page: no scripts or styles, line breaks at blocks, entities resolved, blanks collapsed."""
    import unicodedata

    p = _Text()
    p.feed(text)
    p.close()
    text = unicodedata.normalize("NFKC", "".join(p.out))
    return re.sub(r"\n{2,}", "\n", re.sub(r" *\n *", "\n", re.sub(r"[ \t\r\f\v]+", " ", text))).strip()


_RTF = re.compile(r"\\'([0-9a-fA-F]{2})|\\u(-?\d+)\s?\??|\\([a-zA-Z]+)(-?\d+)? ?|\\([^a-zA-Z])|([{}])|([^\\{}\r\n]+)|[\r\n]+")


def rtf_to_text(text: str) -> str:
    """Text of a document: code-page and Unicode characters, paragraphs, lines and tabs; tables of fonts and colours are left out."""
    out: list[str] = []
    groups, skip = [], False
    for m in _RTF.finditer(text):
        hexa, uni, word, number, sign, brace, plain = m.groups()
        if brace == "{":
            groups.append(skip)
        elif brace == "}":
            skip = groups.pop() if groups else False
        elif word in ("fonttbl", "colortbl", "stylesheet", "info", "pict", "generator", "themedata") or sign == "*":
            skip = True
        elif skip:
            continue
        elif hexa:
            out.append(bytes([int(hexa, 16)]).decode("cp1252", "replace"))
        elif uni:
            out.append(chr(int(uni) % 65536))
        elif word in ("par", "line", "sect", "page"):
            out.append("\n")
        elif word == "tab":
            out.append("\t")
        elif sign:
            out.append({"~": " ", "-": "", "_": "-"}.get(sign, sign))
        elif plain:
            out.append(plain)
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip()


def to_text():
    """Arrow UDF: whatever the format, the plain text; null stays null."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            if re.match(r"\s*\{?\\rtf", t[:128]):
                return rtf_to_text(t)
            return html_to_text(t) if re.search(rf"(?i)<\s*/?\s*({_TAGS})\b", t[:2000]) else t

        return texts.map(one)

    return convert


def real_breaks(c: Column) -> Column:
    """Line breaks written out as characters become line breaks."""
    return F.regexp_replace(c, "\\\\r\\\\n|\\\\n|\\\\r|\\r\\n|\\r", "\n")


def spaced_capitals(c: Column) -> Column:
    """'C O N C L U S A O' becomes one word: blanks between single capitals go."""
    return F.regexp_replace(c, "(?<=(?:^|\\s)\\p{Lu}|\\s\\p{Lu})[ ](?=\\p{Lu}(?:[ ]\\p{Lu})*(?:[\\s:.,;]|$))", "")


def digit_prefix(c: Column) -> Column:
    """A stray digit before a word goes ('6reto'), units and dosages stay ('10mg')."""
    return F.regexp_replace(c, "(?<![\\p{L}\\p{N},.])\\d{1,2}(?=(?!(?:mm|cm|ml|mg|kg|mcg|ui|hu|uh|min|h|x|o|a|g|l)\\b)\\p{Ll}{3,})", "")


def split_accents(c: Column) -> Column:
    """A blank before an accented ending inside a word goes, as often as four times."""
    for _ in range(4):
        c = F.regexp_replace(c, "(?<=\\p{Ll}) (?=(?:ção|ções|são|ável|ível|ência|ância)(?!\\p{L}))", "")
    return c


#: Names of fonts, and what viewers write into reports.
FONTS = ["times", "times new roman", "arial", "calibri", "cambria", "courier", "courier new", "helvetica", "symbol", "wingdings", "opensymbol", "ms mincho", "simsun", "century", "cambria math"]
NOTICES = [
    "(?i)\\blaudo\\s+(?:gerado|liberado)\\s+por\\s+(?:um?\\s*)?sistema\\s+especialista\\b\\.?",
    "(?i)\\bpara\\s+visualiza\\w*\\s+(?:o\\s+conte[uú]do\\s+do\\s+)?laudo\\b.?\\b(?:acesse|acessar)\\b.?\\b(?:viewer|op[cç][aã]o\\s+imagem|imagem\\s+dispon[ií]vel)\\b\\.?",
    "(?i)\\blaudo\\s+pode\\s+n(?:ão|ao|aõ)\\s+estar\\s+completo\\s+na\\s+visualiza\\p{L}+\\s+em\\s+(?:rtf|imagem)\\b\\.?",
]


def without_boilerplate(c: Column) -> Column:
    """Viewer notices go out of their lines; lines of fonts, styles, generators, signs only or such notices go whole.

    Semicolons alone don't make boilerplate: a line of findings parted by them stays. Blank lines stay.
    """
    for notice in NOTICES:
        c = F.regexp_replace(c, notice, " ")

    def fonts(low: Column) -> Column:
        return sum((low.contains(f).cast("int") for f in FONTS), F.lit(0))

    def boilerplate(x: Column) -> Column:
        line, low, plain = F.trim(x), F.lower(F.trim(x)), norm_in_place(F.trim(x))
        many = F.length(line) - F.length(F.replace(line, F.lit(";"), F.lit(""))) >= 3
        listed = many & ((fonts(low) >= 1) | low.rlike("\\b(?:font|heading|colortbl|stylesheet|style)\\b") | line.rlike("^(?:[^;]{1,40};\\s*){5,}$"))
        notice = plain.contains("laudo") & plain.contains("visualiza") & plain.rlike("rtf|imagem|viewer|sistema|especialista")
        return listed | low.rlike("^(?:heading\\s*\\d+\\s*;\\s*){2,}heading\\s*\\d+\\s*;?$|created by|generator|html\\s*to\\s*rtf|jword|^[;,.\\-–—\\s]+$") | notice | (low.contains(";") & (fonts(low) >= 2) & (F.length(line) <= 160))

    return F.trim(F.array_join(F.filter(F.split(c, "\n"), lambda x: ~boilerplate(x)), "\n"))


def without_footer(c: Column) -> Column:
    """From a line 'Referências' on, and lines of notices and signatures, the text goes."""
    c = F.regexp_replace(c, "(?is)(?:^|\\n)\\s*refer[eê]ncias?(?: bibliogr[aá]ficas)?\\s*:?\\s*\\n.*$", "")
    return F.regexp_replace(c, "(?im)^\\s*(?:_{3,}|m[eé]dico respons[aá]vel.*|este laudo .*(?:assinado|eletronicamente).*|crm[ :/-].*)\\s*$", "")


def tidy(c: Column) -> Column:
    """No blanks before signs, one after, no doubled signs."""
    c = F.regexp_replace(c, "[ \\t]+([,.;:!?])", "$1")
    c = F.regexp_replace(c, "([;!?])(?=\\p{L})", "$1 ")
    return F.regexp_replace(F.regexp_replace(c, "([,;:])\\1+", "$1"), "[ \\t]{2,}", " ")


def without_blank_lines(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "(?m)^[ \\t]*\\n", ""), "\\n[ \\t]*$", "")


def before_section(c: Column, title: str) -> Column:
    """The text before a section title; all of it where the title doesn't occur."""
    at = F.locate(title.lower(), norm_in_place(c))
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)


def sentence_breaks(c: Column) -> Column:
    """A line break before bullets and section titles."""
    return F.regexp_replace(F.regexp_replace(c, "(?<=\\S)[ ]+(?=[-•*] \\p{Lu})", "\n"), "(?<=[.;])[ ]+(?=\\p{Lu}[\\p{Lu} ]{3,}:)", "\n")


def sentences(c: Column, by: str = "\\n+") -> Column:
    """Non-blank pieces of a text in order."""
    return F.filter(F.transform(F.split(c, by), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def tokens(c: Column) -> Column:
    """Words and single signs."""
    return F.regexp_extract_all(c, F.lit("([\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s])"), 1)


def words(c: Column) -> Column:
    """Folded words only."""
    return F.regexp_extract_all(norm_in_place(c), F.lit("([a-z0-9_]+)"), 1)


def without_stop_words(c: Column, stop: list[str], keep: list[str]) -> Column:
    """Words of each line that aren't stop words, or that deny something; lines stay lines."""
    drop = [w for w in stop if w not in keep]
    return F.array_join(F.transform(F.split(norm_in_place(c), "\n"), lambda x: F.array_join(F.filter(F.regexp_extract_all(x, F.lit("([a-z0-9_]+)"), 1), lambda w: ~w.isin(drop)), " ")), "\n")


def ngrams(c: Column, most: int = 3, least_length: int = 3) -> Column:
    """Distinct runs of up to ``most`` words of at least ``least_length`` letters."""
    kept = F.filter(words(c), lambda x: x.rlike("^[a-z]+$") & (F.length(x) >= least_length))
    return F.get(F.transform(F.array(kept), lambda w: _runs(w, most)), 0)  # the words are worked out once


def _runs(w: Column, most: int) -> Column:
    def of(k: int) -> Column:
        run = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) >= k, run).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*(of(k) for k in range(1, most + 1))))


HEADER = "^\\s*[-•*]?\\s*(\\p{Lu}[\\p{Lu} /]{2,60})\\s*:"


def sections(c: Column) -> Column:
    """``array<struct<title, body>>``: each line goes to the last title before it; lines before any title have a null title."""
    start = F.array().cast("array<struct<title:string,body:string>>")

    def step(done: Column, line: Column) -> Column:
        title = F.regexp_extract(line, HEADER, 1)
        rest = F.trim(F.regexp_replace(line, HEADER, ""))
        last = F.get(done, F.size(done) - 1)
        begun = F.concat(done, F.array(F.struct(F.nullif(norm_in_place(F.trim(title)), F.lit("")).alias("title"), rest.alias("body"))))
        joined = F.struct(last["title"].alias("title"), F.trim(F.concat_ws("\n", F.nullif(last["body"], F.lit("")), rest)).alias("body"))
        return F.when((F.length(title) > 0) | (F.size(done) == 0), begun).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)))

    return F.aggregate(sentences(c), start, step)


def canonical_title(title: Column, aliases: dict[str, list[str]]) -> Column:
    """The organ or part whose alias a folded title begins with, the longest alias first; null for none."""
    pairs = sorted(((a, name) for name, own in aliases.items() for a in own), key=lambda p: (-len(p[0]), p))
    return F.coalesce(*(F.when(title.startswith(a), F.lit(name)) for a, name in pairs), F.lit(None).cast("string"))


def anchored_sentences(c: Column, anchors: str) -> Column:
    """One block for each sentence that an anchor stands in."""
    return F.filter(sentences(c, "\n+|(?<=[.;!?])\\s+"), lambda s: norm_in_place(s).rlike(anchors))


def blocks(c: Column, starts: str) -> Column:
    """Sentences joined to blocks; a new one begins with each sentence that matches. What comes before the first is a block too."""

    def step(done: Column, s: Column) -> Column:
        fresh = norm_in_place(s).rlike(starts) | (F.size(done) == 0)
        last = F.concat_ws("\n", F.get(done, F.size(done) - 1), s)
        return F.when(fresh, F.concat(done, F.array(s))).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(last)))

    return F.aggregate(sentences(c), F.array().cast("array<string>"), step)
