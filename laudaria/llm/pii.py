"""Personal information inside free text (problem 5).

Anchor expansion: one Aho-Corasick pass over the folded text (small letters, no accents, look-alikes and invisible
characters undone, every digit a nought, positions kept) finds at-signs, schemes, identifier cues, the grouping signs of numbers, kinds of street and known
name words. Only around an anchor do the local parsers run: they expand to the whole e-mail address, telephone, document number, address or name, and
validate its boundary, its digits and its cue. A text without an anchor costs one pass.

Name words are those of the patients' own names (``name_words``), folded as the texts are. They are sent to the tasks up to ``most_names`` distinct words, counted
first; beyond that the words of each text are joined with them by shuffle and only the matches travel with the row, with the same outcome. A name is two
name words in a row, one beside an initial, or one (or capitalised words) after a cue such as "revisado por".

Defined results: null stays null and empty empty, without findings; overlapping findings keep the first of e-mail, document, telephone,
address, name; a kind without a marker is replaced by its own name in brackets; rows of one key count together in ``found`` and stay
apart in ``redact``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.llm.lookalike import TWINS
from laudaria.runtime import spread

KINDS = ("EMAIL", "DOCUMENTO", "TELEFONE", "ENDERECO", "NOME")
_ACCENTS = ("áàâãäéèêëíìîïóòôõöúùûüçñº°ª", "aaaaaeeeeiiiiooooouuuucnooa")
_ODD = re.compile("[^\\x00-\\x7f²³¹½¼¾±×÷≤≥≠≈–—…“”‘’«»αβδγ§·•]")  # what needs more than one sign for one
#: Cues by what may follow or precede them.
CUES = {
    "mail": ["@", "arroba", "[at]", "(at)", "{at}", "mailto:"],
    "phone": ["tel", "fone", "celular", "whatsapp", "zap", "contato", "duvidas", "ligar", "ramal", "cel"],
    "call": ["(0", "( 0", "(x", "(*", "+0", "+ 0"],
    "number": ["000.000.000"],
    "document": ["cpf", "c.p.f", "rg", "r.g", "identidade", "cns", "sus", "cartao nacional", "documento", "passaporte", "cnh", "habilitacao", "titulo de eleitor", "nis", "pis"],
    "street": ["rua ", "avenida ", "av.", "av ", "alameda ", "al. ", "travessa ", "tv. ", "trav. ", "rodovia ", "rod. ", "praca ", "estrada ", "largo ", "viela ", "vila ", "beco ", "quadra ", "qd", "cep", "ladeira ", "servidao "],
    "short": ["r. ", "r.  "],
    "person": ["paciente", "acompanhante", "revisado por", "responsavel", "aos cuidados de", "a/c", "assinado", "assina", "solicitado por", "sr.", "sra.", "dr.", "dra.", "dados cadastrais", "mae,", "pai,", "mae:", "pai:", "nome:", "relato d", "comunicado a", "liberado por", "laudado por", "medico"],
}
REACH = {"mail": (70, 120), "phone": (4, 110), "call": (6, 40), "number": (0, 8), "short": (0, 160), "document": (25, 70), "street": (2, 220), "person": (2, 90), "name": (0, 0)}  #: characters that a parser may need before and after its cue
_PART = "(?:da|de|do|das|dos|e|di|del|van|von)"

_EMAIL = re.compile(r"[a-z0-9][a-z0-9._%+-]{0,63} ?(?:@|\(arroba\)|\[arroba\]|\barroba\b|\[at\]|\(at\)|\{at\}) ?[a-z0-9-]{1,63}(?: ?(?:\.|\(ponto\)|\[ponto\]|\[dot\]|\(dot\)) ?[a-z0-9-]{1,63})*(?: ?(?:\.|\(ponto\)|\[ponto\]|\[dot\]|\(dot\)) ?[a-z]{2,24})(?![a-z0-9-])")
_PHONE = re.compile(r"(?<![\d/])(?<!\d[.,-])(?:\+ ?\d{1,3}[ .-]?|55[ .-]?(?=\(?\d\d\)?[ .-]?(?:9[ .-]?)?\d{4}[ .-]?\d{4}))?(?:\( ?0?(?:xx|\*\*)? ?\d{2} ?\)|0?(?:xx|\*\*)?\d{2})[ .-]{0,2}(?:9[ .-]?)?\d{4}[ .-]{0,2}\d{4}(?![\d/])(?![.,-]\d)")
_LOCAL = re.compile(r"(?<![\d/])(?<!\d[.,-])(?:9[ .-]?)?\d{4}[ .-]\d{4}(?![\d/])(?![.,-]\d)")
_PHONE_CUE = re.compile(r"(?:\btel(?:efone|s)?\b|\bfones?\b|telefone|\bcel(?:ular)?\b|whats|\bzap\b|contato|duvidas|ligar|ramal)")
_DOCUMENT = re.compile(
    r"(?<![a-z0-9])(?:c\. ?p\. ?f\.?|cpf(?:/mf)?|r\. ?g\.?|rg|(?:carteira de |cedula de |doc(?:umento)? de )?identidade|cns|(?:cartao (?:do )?)?sus|cartao nacional(?: de saude)?|(?:portador(?:a)? d[oe] )?documento|passaporte|cnh|habilitacao|titulo de eleitor|nis|pis)"
    r"(?:[ :.#,-]| ?n[o.]{0,2}|numero|n(?= ?\d)|=|/|\()*((?:[a-z]{1,3} ?-? ?)?\d(?:[ ./-]{0,2}\d){4,17}(?: ?-? ?x(?![a-z0-9]))?)(?![\d])"
)
_CPF = re.compile(r"(?<![\d.,/-])\d{3}\.\d{3}\.\d{3} ?[-/] ?\d{2}(?![\d]|[.,-]\d)")
_STREET = re.compile(
    r"(?<![a-z])(?:(?:rua|avenida|av\.?|alameda|al\.|travessa|trav\.|tv\.|rodovia|rod\.|praca|estrada|largo|viela|vila|beco|ladeira|servidao)\s+[a-z0-9][a-z0-9 .'-]{1,60}?(?:,? ?(?:n[o.]{0,2} ?)?\d{1,6}(?!\d)(?: ?[a-z](?![a-z]))?|,? ?s/n[o.]{0,2}|,? ?km ?\d+(?:[.,]\d+)?)|(?:quadra|qd\.?) ?\d+ ?,? ?(?:lote|lt\.?) ?\d+)"
    r"(?:(?: ?[,;/-] ?| )(?:apto\.?|ap\.?|apartamento|casa|bloco|bl\.?|fundos|sala|conj(?:unto|\.)?|lote|quadra|bairro|andar|torre|ed(?:ificio|\.)?) ?[a-z0-9]{1,14}(?: (?:da|de|do|das|dos)? ?[a-z]{3,14}(?= ?(?:[,.;\n]|$))){0,2})*(?:(?: ?[,;/-] ?| )cep:? ?\d{2}\.?\d{3}-?\d{3})?"
)
_SHORT_STREET = re.compile(r"(?<![a-z])r\.\s+(?:d[aeo]s? )?([a-z]+)(?: [a-z]+){0,3}?,? ?(?:(?:n[o.]{0,2} ?)?\d{1,6}(?!\d)|s/n[o.]{0,2})(?:(?: ?[,;/-] ?| )(?:apto\.?|apartamento|casa|bloco|bairro|conjunto) ?[a-z0-9]{1,14}(?: [a-z]{3,14}(?= ?(?:[,.;\n]|$)))?)*(?:(?: ?[,;/-] ?| )cep:? ?\d{2}\.?\d{3}-?\d{3})?")
_CEP = re.compile(r"(?<![a-z])cep:? ?\d{2}\.?\d{3}-?\d{3}(?!\d)")
_PERSON = re.compile(
    r"(?:(?:revisado|solicitado|liberado|laudado|assinado|comunicado|realizado|encaminhado) (?:por|a|ao|pel[ao])|aos cuidados d[eao]|a/c:?|(?:assinado|acompanhante|responsavel|nome|paciente|dados cadastrais|medico|medica)(?: responsavel)?:|contato com (?:a|o) (?:mae|pai|filh[ao]|espos[ao]|irma|irmao|responsavel),?|relato d[ao]|\bpaciente)\s+(?:(?:o|a) )?(?:(?:dra?|sra?)\.? )?$"
)
_TITLE = re.compile(r"(?<![a-z])(?:dra?|sra?)\. ?$")
_CAPITAL = re.compile(r"(?:[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ][a-záàâãéêíóôõúüç]+|[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ]\.)(?: (?:(?:da|de|do|das|dos|e) )?(?:[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ][a-záàâãéêíóôõúüç]+|[A-ZÁÀÂÃÉÊÍÓÔÕÚÇ]\.)){1,4}")
_STRONG_PERSON = re.compile(r"(?:revisado por|solicitado por|liberado por|laudado por|aos cuidados de|assinado:|acompanhante:|dados cadastrais:|residente responsavel:|com a mae,|com o pai,)\s+(?:(?:dra?|sra?)\.? )?$")
_WORD = re.compile(r"[a-z]+")
_GAP = re.compile(r"^(?:[ \n]{1,3}|, ?|[ \n]" + _PART + r"[ \n])$")


_DIGITS = str.maketrans("123456789", "000000000")


def fold(text: str) -> tuple[str, str, list[int] | None]:
    """The folded text, the same with its capitals, and the place in the text of each of its characters (None: the same places)."""
    low = text.lower()
    if len(low) == len(text):
        low = low.replace("\\n", "  ").replace("\\r", "  ").replace("\n", " ").replace("\r", " ").replace("\t", " ")
        if low.isascii():
            return low, text, None
        for a, b in zip(*_ACCENTS, strict=True):
            if a in low:
                low = low.replace(a, b)
        if not _ODD.search(low):
            return low, text, None
    out: list[str] = []
    at: list[int] = []
    for i, c in enumerate(text):
        if unicodedata.category(c) in ("Mn", "Cf"):
            continue
        c = TWINS.get(c, c)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).replace("º", "o").replace("°", "o").replace("ª", "a")
        plain = " " if plain.isspace() else "".join(TWINS.get(x, x) for x in plain)
        out.append(plain)
        at += [i] * len(plain)
    cased = "".join(out).replace("\\n", "  ").replace("\\r", "  ")
    low = "".join(x.lower() if len(x.lower()) == 1 else x for x in cased)  # a character for a character
    return low, cased, at


class Finder:
    """Anchors and parsers for one set of name words."""

    def __init__(self, names: set[str]):
        import ahocorasick

        self.names = names
        self.auto = ahocorasick.Automaton()
        for kind, cues in CUES.items():
            for cue in cues:
                self.auto.add_word(cue, (kind, len(cue), cue[0].isalpha(), cue[-1].isalpha()))
        for name in names:
            if name not in self.auto:
                self.auto.add_word(name, ("name", len(name), True, True))
        self.auto.make_automaton()

    def anchors(self, low: str) -> dict[str, list[tuple[int, int]]]:
        """Where the parsers have to look: stretches around whole cues, by kind, overlapping ones made one. A digit of a cue stands for any."""
        out: dict[str, list[tuple[int, int]]] = {}
        for last, (kind, n, alpha_first, alpha_last) in self.auto.iter(low.translate(_DIGITS)):
            start = last - n + 1
            if alpha_first and start and low[start - 1].isalpha() or alpha_last and low[last + 1 : last + 2].isalpha() and kind not in ("phone", "person"):
                continue
            before, after = REACH[kind]
            lo, hi = max(0, start - before), min(len(low), last + 1 + after)
            own = out.setdefault(kind, [])
            if own and lo <= own[-1][1]:
                own[-1] = (min(lo, own[-1][0]), max(hi, own[-1][1]))
            else:
                own.append((lo, hi))
        return out

    def spans(self, text: str, more: set[str] | None = None) -> list[tuple[int, int, str]]:
        """(start, end, kind) of all findings, without overlaps, in order."""
        low, cased, at = fold(text)
        kinds = self.anchors(low)
        names = self.names if not more else self.names | more
        if more:
            kinds["name"] = [(0, len(low))]
        found: list[tuple[int, int, str]] = []

        def add(start: int, end: int, kind: str) -> None:
            while end > start and low[end - 1] in " ,;/-.":
                end -= 1
            if end > start and not any(s < end and start < e for s, e, _ in found):
                found.append((start, end, kind))

        def near(kind: str, pattern: re.Pattern) -> Iterator[re.Match]:
            for lo, hi in kinds.get(kind, ()):
                yield from pattern.finditer(low, lo, hi)

        for m in near("mail", _EMAIL):
            add(m.start(), m.end(), "EMAIL")
        for m in near("document", _DOCUMENT):
            if 6 <= sum(c.isdigit() for c in m.group(1)) <= 16:
                add(m.start(1), m.end(1), "DOCUMENTO")
        for m in near("number", _CPF):
            add(m.start(), m.end(), "DOCUMENTO")
        for kind in ("call", "phone"):
            for m in near(kind, _PHONE):
                if m.group()[0] == "+" or "(" in m.group() or kind == "phone" and _PHONE_CUE.search(low, max(0, m.start() - 70), m.start()):
                    add(m.start(), m.end(), "TELEFONE")
        for m in near("phone", _LOCAL):
            if re.search(r"(?:\btel\.?|fone|celular|telefone|whatsapp):? ?$", low[max(0, m.start() - 14) : m.start()]):
                add(m.start(), m.end(), "TELEFONE")
        for m in near("street", _STREET):
            add(m.start(), m.end(), "ENDERECO")
        for m in near("street", _CEP):
            add(m.start(), m.end(), "ENDERECO")
        for m in near("short", _SHORT_STREET):
            if m.group(1) not in names:
                add(m.start(), m.end(), "ENDERECO")
        if "name" in kinds or "person" in kinds:
            self._people(cased, low, names, kinds, add)
        found.sort()
        return found if at is None else [(at[s], at[e - 1] + 1, k) for s, e, k in found]

    def _people(self, cased, low, names, kinds, add) -> None:
        if "name" in kinds:
            words = [(m.start(), m.end(), m.group() in names, m.end() - m.start() == 1) for m in _WORD.finditer(low)]
            i = 0
            while i < len(words):
                if not words[i][2]:
                    i += 1
                    continue
                start, end, n, initials = words[i][0], words[i][1], 1, 0
                if i and words[i - 1][3] and low[words[i - 1][1] : start] in (". ", ".", "."):  # an initial before
                    start, initials = words[i - 1][0], 1
                j = i + 1
                while j < len(words):
                    gap = low[end : words[j][0]]
                    if words[j][2] and (_GAP.match(gap) or gap in (". ", ".") and initials):
                        end, n = words[j][1], n + 1
                    elif words[j][3] and gap in (" ", ", ") and low[words[j][1] : words[j][1] + 1] == "." and not low[words[j][1] + 1 : words[j][1] + 2].isalpha() and not re.match(r"\. ?[gp]\.", low[words[j][1] :]):
                        end, initials = words[j][1], initials + 1
                    elif re.fullmatch(_PART, low[words[j][0] : words[j][1]]) and j + 1 < len(words) and words[j + 1][2] and gap == " " and low[words[j][1] : words[j + 1][0]] == " ":
                        end, n, j = words[j + 1][1], n + 1, j + 1
                    else:
                        break
                    j += 1
                before = low[max(0, start - 60) : start]
                if n > 1 or initials or _PERSON.search(before) or _TITLE.search(before):
                    add(start, end, "NOME")
                i = j
        if "person" in kinds:
            for m in (x for lo, hi in kinds["person"] for x in _CAPITAL.finditer(cased, lo, hi)):
                if _STRONG_PERSON.search(low[max(0, m.start() - 40) : m.start()]):
                    add(m.start(), m.end(), "NOME")


def _scan(batches: Iterator[pa.RecordBatch], names: set[str], markers: dict[str, str] | None) -> Iterator[pa.RecordBatch]:
    """Text second to last, the row's own name words last; out go the other columns, the kinds, and with markers the text without."""
    finder = Finder(names)
    for b in batches:
        kinds, clean = [], []
        for text, more in zip(b.columns[-2].to_pylist(), b.columns[-1].to_pylist(), strict=True):
            spans = finder.spans(text, set(more) if more else None) if text else []
            kinds.append([k for k in KINDS if any(k == s[2] for s in spans)])
            if markers is not None and text is not None:
                parts, done = [], 0
                for s, e, k in spans:
                    if s < done:
                        continue
                    parts += [text[done:s], markers.get(k, f"[{k}]")]
                    done = e
                clean.append("".join([*parts, text[done:]]))
            else:
                clean.append(None)
        yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(kinds, pa.list_(pa.string())), pa.array(clean, pa.string())], [*b.schema.names[:-2], "kinds", "clean"])


def _words(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, word): the distinct folded words of each text."""
    for b in batches:
        ids, words = [], []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            own = {w for w in _WORD.findall(fold(text)[0]) if len(w) >= least} if text else set()
            ids += [i] * len(own)
            words += own
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.string())], ["_id", "word"])


def name_words(names: DataFrame, name_col: str, least: int = 3) -> DataFrame:
    """Distinct folded words of a column of names: ``word``; words of fewer than ``least`` letters and particles are left out."""
    own = names.select(F.lit(None).cast("string").alias("_id"), F.col(name_col).cast("string").alias("text")).filter("text is not null").distinct()
    words = own.mapInArrow(lambda b: _words(b, least), "_id string, word string").select("word")
    return words.filter(~F.col("word").isin("das", "dos", "del", "van", "von", "filho", "neto", "junior", "sra", "dra")).distinct()


def scan(texts: DataFrame, keys: list[str], words: DataFrame, markers: dict[str, str] | None = None, text_col: str = "text", most_names: int = 200_000) -> DataFrame:
    """``keys, kinds, clean``: the kinds found in every row's text, and with ``markers`` the text with its findings replaced."""
    own = texts.select(*keys, F.col(text_col).cast("string").alias("_text"))
    few = [r[0] for r in words.limit(most_names + 1).collect()]  # bounded
    if len(few) <= most_names:
        names, given = set(few), own.withColumn("_more", F.lit(None).cast("array<string>"))
    else:
        own = own.withColumn("_id", F.md5("_text"))
        texts_once = spread(own.filter("_text <> ''").select("_id", "_text").distinct())
        held = texts_once.mapInArrow(lambda b: _words(b, 1), "_id string, word string").join(words, "word")
        names, given = set(), own.join(held.groupBy("_id").agg(F.collect_set("word").alias("_more")), "_id", "left").drop("_id")
    fields = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keys), "kinds array<string>, clean string"])
    return spread(given.select(*keys, "_text", "_more")).mapInArrow(lambda b: _scan(b, names, markers), schema)


def found(texts: DataFrame, keys: list[str], words: DataFrame, text_col: str = "text") -> DataFrame:
    """``keys, tipo``: one row per record and kind found."""
    return scan(texts, keys, words, None, text_col).select(*keys, F.explode("kinds").alias("tipo")).distinct()


def redact(texts: DataFrame, keys: list[str], words: DataFrame, markers: DataFrame, text_col: str = "text", most_markers: int = 1000) -> DataFrame:
    """``keys, kinds, clean``: every row with its text, findings replaced by the marker of their kind (``tipo, marcador``)."""
    rows = markers.filter("tipo is not null and marcador is not null").limit(most_markers + 1).collect()
    if len(rows) > most_markers:
        raise ValueError(f"more than {most_markers} markers")
    return scan(texts, keys, words, {r["tipo"]: r["marcador"] for r in rows}, text_col)
