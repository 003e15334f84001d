"""Template residue, filler, error pages and script notices (problem 2).

Normalised lines are counted by host (the unit that sent the report); a line that recurs in a host's records is boilerplate of that host and is
subtracted. A record is marked if what is left holds evidence of one of four kinds: ``modelo`` (an unfilled placeholder or blank),
``enchimento`` (filler or test text), ``erro`` (an error message), ``script`` (a notice that scripts or the like are needed).

Subtraction comes before judgement for every line with evidence of filler, errors or scripts. How often a line has to recur depends on what it says: a line
of words that reports say too (weak evidence) in ``recurrent_share`` of the host's records and ``recurrent_records`` of them; a line that says one thing
only (a stack trace, "habilite o JavaScript") in ``footer_share`` of the host's records and ``footer_records`` of them, as the footer of a portal does. So a
message that a part of the reports breaks off into is no footer. Two things can't be subtracted: an unfilled placeholder, which is a case wherever it
stands, and the evidence of a record that is nothing else (fewer than ``LEAST_LEFT`` letters outside the lines with evidence), so a host of which most records are one error page doesn't hide it.

Only lines with evidence need counting, as no other line can be what marks a record; their counts are over all
records, combined before the shuffle, and no host is one task. The texts are read once, in Arrow batches: some hundred patterns, each behind a plain
string, are several times faster there than as one generated expression.

Defined results: null and empty texts are not marked; rows of one key count together in ``found`` and stay apart in ``mark``;
a null host is a host; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laudaria.runtime import cut, spread

#: Accented letters and their plain forms.
FOLD = ("áàâãäéèêëíìîïóòôõöúùûüç", "aaaaaeeeeiiiiooooouuuuc")
_NAME = "[A-Za-z_][A-Za-z0-9_]*(?: [A-Za-z0-9_]+){0,3}"
_FIELD = "(?:[A-Z][A-Z_0-9]{2,}|[A-Za-z]+_[A-Za-z0-9_]+|(?i:opcao|campo|valor|nome|data|dt|lado|medida|tecnica|segmento|resultado|conclusao|descricao|achado|texto|paciente|laudo|exame|medico|crm|idade|sexo|unidade|orgao|titulo|observacao|comparacao|indicacao|impressao)(?: ?\\d+)?)"
_UNIT = "(?:mm|cm|ml|mL|%|x|HU|UH|kg|mg|anos|pontos|graus)"
_TAGS = "(?:/|!|(?:a|abbr|b|body|br|center|code|div|dd|dl|dt|em|font|footer|form|h[1-6]|head|header|hr|html|i|img|input|li|link|meta|noscript|ol|p|pre|script|small|span|strong|style|sub|sup|table|tbody|td|th|thead|title|tr|tt|u|ul)\\b)"

#: Strong evidence (fixed values): a plain string that must be there, and the pattern looked for only where it is. First on the text as it is.
TEMPLATE = [
    ("{", f"\\{{\\{{? ?{_NAME} ?\\}}"), ("[[", f"\\[\\[ ?{_NAME} ?\\]\\]"), ("@@", f"@@ ?{_NAME} ?@@"), ("<<", f"<< ?{_NAME} ?>>"), ("__", "(?<!_)__[A-Za-z][A-Za-z0-9_ ]{0,40}?[A-Za-z0-9]__(?!_)"), ("«", f"« ?{_FIELD} ?»"),
    ("%", f"%{_NAME}%"), ("#", f"#{_NAME}#"), ("#", "#(?:N/[DA]|REF!|VALOR!|VALUE!|DIV/0!|NOME\\?|NAME\\?|N[UÚ]M!|NULO!|NULL!)"), ("$", f"\\${_NAME}\\$"), ("&lt;", f"&lt; ?(?!{_TAGS}){_NAME} ?&gt;"), ("<", f"<(?!{_TAGS}) ?{_FIELD} ?>|<(?i:null|none|nan|undefined|vazio)>"),
    ("[", "\\[(?i:inserir|preencher|informar|digitar|digite|colocar|completar|selecionar|escolher|insert|fill in) [^\\]\\n]{1,60}\\]|\\[[^\\[\\]\\n]{1,60} (?i:aqui|here)\\]"), ("<", "<(?i:inserir|preencher|informar|digitar|digite|colocar|completar|selecionar|escolher) [^>\\n]{1,60}>"), ("(", "\\((?i:inserir|preencher|informar|digitar|digite|colocar|completar|selecionar|escolher) [^)\\n]{1,60}\\)"),
    ("___", f"_{{3,}} ?{_UNIT}(?![A-Za-z])|(?i:medindo|de|com|em|até|por|cerca de|a) _{{3,}}+(?!\\s*(?:\\n|$))"), ("....", f"\\.{{4,}} ?{_UNIT}(?![A-Za-z])"), (" ...", "(?i:medindo|medida|mede) \\.{3,}"),
    *((x, f"(?<![A-Za-z])(?:XX+|xx+|X,X+|x,x+|NaN|null|undefined|None|\\?{{2,}}) ?{_UNIT}(?![A-Za-z])") for x in ("XX", "xx ", "X,X", "x,x", "NaN", "null ", "undefined ", "None ", "?? ")),
    *((x, "(?i)(?<![a-z])(?:dd/mm/(?:aaaa|yyyy|aa)|hh:mm(?::ss)?)(?![a-z])") for x in ("dd/mm", "DD/MM", "hh:mm", "HH:MM", "HH:mm")),
]
#: On the text in small letters without accents.
FILLER = [
    ("lorem", "lorem ipsum"), ("asdf", "(?<![a-z])asdf"), ("qwer", "(?<![a-z])qwer"), ("zxcv", "(?<![a-z])zxcv"), ("*letters", "(?<![a-z0-9])([a-hj-z])\\1\\1++[ \\n]+([a-hj-z])\\2\\2++(?![a-z0-9])"),
    ("*words", "(?<![a-z])([a-z]{3,}+)(?:[ ,.\\n]+\\1(?![a-z])){2,}"), ("*words", "(?<![a-z])([a-z]{3,}+ [a-z]{2,}+)(?:[ ,.\\n]+\\1(?![a-z])){2,}"), ("*words", "(?<![a-z])([a-z]{3,}+ [a-z]{2,}+ [a-z]{2,}+)(?:[ ,.\\n]+\\1(?![a-z])){2,}"),
    ("texto do laudo", "(?:digite|insira|escreva|cole) (?:aqui )?o texto do laudo"), ("digite aqui", "digite aqui"), ("inserir ", "(?:^|\\n)\\W*inserir (?:a |o )?(?:conclusao|laudo|texto|descricao|impressao|analise)\\b"), ("preencher ", "(?:^|\\n)\\W*preencher (?:a |o )?(?:conclusao|laudo|texto|descricao|impressao|analise)\\b"), ("padrao do modelo", "texto padrao do modelo"), ("texto d", "(?:^|\\n|<br ?/?>|<p>)\\W*texto d[ae] (?:analise|conclusao|descricao|tecnica|impressao|indicacao)\\b"), ("teste de ", "testes? de (?:integracao|carga|envio|sistema|interface)(?: \\d+)?\\W*(?:$|\\n)"), ("antes de liberar", "substituir antes de liberar"),
    ("desconsiderar", "desconsiderar\\W*$|- desconsiderar"), ("favor ", "favor (?:ignorar|desconsiderar)"), (" de teste", "(?:carga|registro|laudo|dado|texto|mensagem|exame|paciente)s? de teste"), ("ficti", "(?:registro|laudo|paciente|exame) fictici[oa]"), ("para ", "para (?:treino|treinamento|homologacao)"), ("homologacao", "homologacao \\d+"), (". . . .", "(?:^|\\n)\\W*(?:\\. ){4,}\\.?"),
    ("", "^\\W*(?:testes?|laudo|laudo teste|teste laudo|texto|a definir|a preencher|tbd|todo|n/a|na|x+|em branco|exemplo)(?: ?\\d+)?\\W*$"), ("a definir", "(?:^|\\n)[^a-z\\n]*a definir[^a-z\\n]*(?:$|\\n)"), ("a preencher", "(?:^|\\n)[^a-z\\n]*a preencher[^a-z\\n]*(?:$|\\n)"),
]
ERROR = [
    ("traceback", "traceback \\(most recent call last\\)"), ("error", "(?<![a-z])[a-z]+error(?::|$|\\n)|internal server error|syntax error|\"error\" ?:"), ("exception", "[a-z]exception\\b"), ("\tat ", "\\tat [a-z_$][\\w.$<>]+\\("), (".java:", "\\.java:\\d+"), ("line ", "file \"[^\"\\n]+\", line \\d+"),
    *((x, f"(?<!\\d)[45]\\d\\d {x}") for x in ("bad gateway", "bad request", "unauthorized", "forbidden", "not found", "service unavailable", "gateway time", "proxy error", "too many requests")), ("http", "http(?:/\\d(?:\\.\\d)?| status| error)? ?-? ?[45]\\d\\d(?!\\d)"), ("\"status\"", "\"status\" ?: ?\"?[45]\\d\\d"), ("status code", "status code:? [45]\\d\\d"), ("bad gateway", "bad gateway"),
    *((x, x) for x in ("request blocked", "automated traffic", "access denied", "permission denied", "page not found", "connection refused", "connection reset", "connection timed out", "stack trace", "stacktrace", "segmentation fault", "sqlstate", "nao tem permissao para", "sessao expirada", "sessao encerrada", "sessao invalida", "pagina que voce procura", "temporariamente indisponivel", "fora do ar", "ocorreu um erro", "erro inesperado", "erro interno", "erro desconhecido", "protocolo do erro", "tempo limite da requisicao", "tempo limite da conexao", "tempo limite da sessao", "tempo limite de resposta", "nao foi possivel carregar", "nao foi possivel abrir", "nao foi possivel exibir", "nao foi possivel processar", "excecao nao tratada", "nullpointer", "null pointer")),
    ("acesso negado", "acesso negado\\W*(?:$|\\n)|acesso negado\\."), ("login", "faca (?:o )?login"), ("encontrada", "pagina nao (?:foi )?encontrada"), ("indisponivel", "(?:servico|sistema|servidor|recurso|site|pagina)[a-z ]{0,20} indisponivel"), ("erro ", "erro (?:ao (?:processar|carregar|abrir|gerar|consultar|conectar|obter|ler)|(?:n[.o]* ?)?[45]\\d\\d(?!\\d))"), ("falha ", "falha (?:ao|na) (?:processar|carregar|abrir|gerar|consultar|conexao|comunicacao|requisicao|autenticacao)"), ("tente novamente", "tente novamente (?:em|mais tarde|dentro)"), ("nao localizado", "recurso .{0,60}nao localizado|documento nao localizado"), ("nao encontrado", "recurso .{0,60}nao encontrado|documento nao encontrado"), ("ora-", "ora-\\d{5}"),
]
SCRIPT = [
    ("javascript", "javascript"), ("<noscript", "<noscript"), ("script", "(?:enable|requires?|ativ\\w+|habilit\\w+|permit\\w+) (?:os? |the )?scripts?(?![a-z])|scripts? (?:ativos|ativados|habilitados|to be enabled|(?:is|are) (?:required|disabled|blocked)|(?:estao|estejam) (?:bloqueados|desativados|ativos)|desabilitados)|suporte a scripts"), ("cookies", "(?:enable|ative|habilite|permita|ativar|aceite) (?:os? |the )?cookies"),
    ("navegador", "navegador (?:nao (?:oferece|tem|possui)|desatualizado|incompativel)"), ("conexao e segura", "verificando se a conexao e segura"), ("checking ", "checking (?:if|your) .{0,40}(?:secure|browser)"), ("carregando ", "carregando o (?:visualizador|laudo|documento)"), ("browser ", "(?:your|this) browser (?:does not|doesn't|is not)"),
]
#: Weak evidence: words that reports say too, by line (fixed values).
WEAK = {
    "enchimento": ["somente teste", "apenas um teste", "apenas teste", "texto de exemplo", "laudo modelo", "laudo exemplo", "placeholder", "dummy", "sample text"],
    "erro": ["timeout", "deadlock", "error code", "codigo do erro", "erro fatal", "fatal error", "unexpected error"],
    "script": ["cookies", "plug-in", "plugin", "applet", "flash player", "recarregue a pagina", "reload the page", "pop-up"],
}
_FILLED = "\\(\\s*[xX✓✔*]\\s*\\)|\\[\\s*[xX✓✔*]\\s*\\]"
_BOXES = "(?:\\(\\s*\\)|\\[\\s*\\]) ?[^\\W\\d_]{2,}[^\\n]{0,40}(?:\\(\\s*\\)|\\[\\s*\\]) ?[^\\W\\d_]{2,}"
LEAST_LEFT = 120  #: letters outside the lines with evidence, below which a record is nothing but them
LINES = "\\r\\n|\\\\r\\\\n|\\\\n|\\n|<br ?/?>|</p>"


class Evidence:
    """The patterns made ready; a pattern is run only on texts that hold its plain string, which is quick to see."""

    def __init__(self):
        ready = lambda pairs: [(g, re.compile(p) if p != g else None) for g, p in pairs]
        self.raw = {"modelo": ready(TEMPLATE)}
        self.low = {"enchimento": ready(FILLER), "erro": ready(ERROR), "script": ready(SCRIPT)}
        self.boxes, self.filled, self.lines, self.empty = re.compile(_BOXES), re.compile(_FILLED), re.compile(LINES), re.compile(r"\(\s*\)|\[\s*\]")

    @staticmethod
    def fold(text: str) -> str:
        """Small letters without accents."""
        text = text.lower()
        if not text.isascii():
            for a, b in zip(*FOLD, strict=True):
                text = text.replace(a, b)
        return text

    @staticmethod
    def repeats(low: str) -> set[str]:
        """Which patterns of repetition can apply at all."""
        words = low.split()
        held = set()
        if any(a == b and len(a) > 2 for n in (1, 2, 3) for a, b in zip(words, words[n:], strict=False)):
            held.add("*words")
        if any(c * 3 in low for c in "abcdefghjklmnopqrstuvwxyz"):
            held.add("*letters")
        return held

    def strong(self, text: str, low: str) -> list[str]:
        held = self.repeats(low)
        kinds = [k for patterns, t in ((self.raw, text), (self.low, low)) for k, pairs in patterns.items() if any((g in held if g[:1] == "*" else g in t) and (p is None or p.search(t)) for g, p in pairs)]
        if "modelo" not in kinds and self.empty.search(text) and any(self.boxes.search(x) and not self.filled.search(x) for x in self.lines.split(text)):
            kinds.append("modelo")
        return kinds

    def lines_of(self, low: str, kinds: list[str]) -> tuple[list[tuple[str, str, bool]], set[str], int]:
        """Lines with evidence as (line, kind, whether it says one thing only); the kinds that some line shows by itself; letters in the other lines."""
        out, shown, left = set(), set(), 0
        for x in self.lines.split(low):
            sure = {k for k in kinds if any(g[:1] != "*" and g and g in x and (p is None or p.search(x)) for g, p in self.low[k])}
            weak = {k for k, words in WEAK.items() if any(w in x for w in words)} - sure
            line = re.sub("[0-9]+", "0", x).strip()
            out |= {(line, k, True) for k in sure} | {(line, k, False) for k in weak}
            shown |= sure
            left += 0 if sure else sum(map(str.isalpha, x))
        return sorted(out), shown, left

    def of(self, text: str | None) -> dict:
        """``strong``: kinds that nothing can be subtracted from; ``lines``: evidence that counts where its line is not boilerplate."""
        if not text:
            return {"strong": [], "lines": []}
        low = self.fold(text)
        strong = self.strong(text, low)
        kinds = [k for k in strong if k in self.low]
        if not kinds and not any(w in low for words in WEAK.values() for w in words):
            return {"strong": strong, "lines": []}
        lines, shown, left = self.lines_of(low, kinds)
        kept = [k for k in strong if k not in shown or left < LEAST_LEFT]
        return {"strong": kept, "lines": [{"line": x, "kind": k, "sure": sure} for x, k, sure in lines if k not in kept]}


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the evidence to the columns before the text, which comes last and stays."""
    evidence = Evidence()
    kind = pa.list_(pa.struct([("line", pa.string()), ("kind", pa.string()), ("sure", pa.bool_())]))
    for b in batches:
        found = [evidence.of(t) for t in b.columns[-1].to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f["strong"] for f in found], pa.list_(pa.string())), pa.array([f["lines"] for f in found], kind)], [*b.schema.names, "strong", "lines"])


def _own(records: DataFrame, keys: list[str], host_col: str, text_col: str) -> DataFrame:
    return spread(records.select(*(F.col(k).cast("string").alias(k) for k in keys), F.col(host_col).cast("string").alias("_host"), F.col(text_col).cast("string").alias("_text")))


def _seen(own: DataFrame, keys: list[str]) -> DataFrame:
    schema = ", ".join([*(f"`{k}` string" for k in keys), "_host string, _text string, strong array<string>, lines array<struct<line: string, kind: string, sure: boolean>>"])
    return own.mapInArrow(_evidence, schema)


def _kinds(seen: DataFrame, own: DataFrame, recurrent: tuple[float, int], footer: tuple[float, int]) -> DataFrame:
    """Add ``kinds`` to records with lines of evidence: the lines are counted by host over all records, and recurrent ones subtracted."""
    held = seen.filter(F.size("lines") > 0)
    lines = held.select("_host", F.explode("lines").alias("x")).groupBy("_host", "x.line", "x.sure").agg(F.count("*").alias("n"))
    sizes = own.groupBy(F.col("_host").alias("h")).agg(F.count("*").alias("size"))
    often = lambda share, records: (F.col("n") >= records) & (F.col("n") >= share * F.col("size"))
    boilerplate = lines.join(sizes, F.col("_host").eqNullSafe(F.col("h"))).filter(F.when(F.col("sure"), often(*footer)).otherwise(often(*recurrent)))
    known = boilerplate.groupBy(F.col("_host").alias("h2")).agg(F.collect_set("line").alias("known"))  # few lines: each fills a share of its host's records
    residual = F.when(F.col("known").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("known"), x["line"])))
    kinds = F.array_sort(F.array_distinct(F.concat("strong", F.transform(residual, lambda x: x["kind"]))))
    return held.join(known, F.col("_host").eqNullSafe(F.col("h2")), "left").withColumn("kinds", kinds)


def mark(
    records: DataFrame, keys: list[str], host_col: str = "host", text_col: str = "text",
    recurrent_share: float = 0.03, recurrent_records: int = 5, footer_share: float = 0.5, footer_records: int = 20,
) -> DataFrame:
    """``keys, text, kinds``: every row with the kinds of evidence in it, an empty array where it is a report. The texts are read once and written once."""
    own = _own(records, keys, host_col, text_col)
    seen = cut(_seen(own, keys))
    weak = _kinds(seen, own, (recurrent_share, recurrent_records), (footer_share, footer_records)).select(*keys, F.col("_text").alias("text"), "kinds")
    return seen.filter(F.size("lines") == 0).select(*keys, F.col("_text").alias("text"), F.array_sort("strong").alias("kinds")).unionByName(weak)


def found(
    records: DataFrame, keys: list[str], host_col: str = "host", text_col: str = "text",
    recurrent_share: float = 0.03, recurrent_records: int = 5, footer_share: float = 0.5, footer_records: int = 20,
) -> DataFrame:
    """``keys`` of the marked records, each once; only records with evidence are written in between, without their texts."""
    own = _own(records, keys, host_col, text_col)
    hits = cut(_seen(own, keys).filter((F.size("strong") > 0) | (F.size("lines") > 0)).drop("_text"))
    strong = hits.filter(F.size("strong") > 0).select(*keys)
    return strong.unionByName(_kinds(hits, own, (recurrent_share, recurrent_records), (footer_share, footer_records)).filter(F.size("kinds") > 0).select(*keys)).distinct()
