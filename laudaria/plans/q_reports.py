"""Queries of the text pipeline and the clinical engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from laudaria.functions import report as rp
from laudaria.functions.text import MARKED, PLAIN, norm_in_place
from laudaria.operators import clinical as cl
from laudaria.plans.q_relational import COLON, DII, EXAM, NEURO
from laudaria.plans.registry import query
from laudaria.runtime import table

_KEY = ("exm_an", "dataExecucaoModelo")
_LOW = f"lower(translate(exm_laudo_texto, '{MARKED}', '{PLAIN}'))"
BOWEL = cl.Lexicon(
    findings={"espessamento": ["espessamento", "espessada"], "estenose": ["estenose"], "colecao": ["colecao"], "fistula": ["trajeto fistuloso"]},
    organs=["ileo", "colon", "figado", "pancreas", "baco"],
    keywords=["pariet", "calibre", "espess"],
    negators=["sem", "nao", "ausente", "ausencia"],
    before=3,
    after=3,
)


def _reports(s, d, t=DII):
    return table(s, d, t).filter("exm_laudo_texto is not null").select(*_KEY, F.col("exm_laudo_texto").alias("t"))


@query("txt1_format", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN regexp_matches(ltrim(left(exm_laudo_texto, 128)), '^\\{{?\\\\rtf') THEN 'rtf' WHEN regexp_matches(lower(left(exm_laudo_texto, 2000)), '<\\s*/?\\s*(html|body|div|p|br|span|table|tr|td|font|b|strong|ul|li|h[1-6])\\b') THEN 'html' ELSE 'plain' END AS formato FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.format_of(F.col("t")).alias("formato"))


@query("txt2_txt3_to_text")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.to_text()(F.col("t")).alias("texto"))


@query("txt5_real_breaks", f"SELECT exm_an, dataExecucaoModelo, md5(regexp_replace(exm_laudo_texto, '\\\\r\\\\n|\\\\n|\\\\r|\\r\\n|\\r', chr(10), 'g')) AS marca FROM {NEURO} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return _reports(s, d, NEURO).select(*_KEY, F.md5(rp.real_breaks(F.col("t"))).alias("marca"))


@query("txt6_txt8_scan_repairs")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.split_accents(rp.digit_prefix(rp.spaced_capitals(F.col("t")))).alias("texto"))


@query("txt9_txt10_boilerplate")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.without_footer(rp.without_boilerplate(rp.real_breaks(F.col("t")))).alias("texto"))


@query("txt11_tidy")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.tidy(F.col("t")).alias("texto"))


@query("txt12_blank_lines", f"SELECT exm_an, dataExecucaoModelo, len(list_filter(string_split(exm_laudo_texto, chr(10)), lambda x: trim(replace(x, chr(9), ' ')) <> '')) AS linhas FROM {DII} WHERE exm_laudo_texto IS NOT NULL AND trim(replace(replace(exm_laudo_texto, chr(9), ' '), chr(10), ' ')) <> ''")
def _(s, d):
    clean = F.split(rp.without_blank_lines(F.col("t")), "\n")
    return _reports(s, d).filter(F.col("t").rlike("[^ \\t\\n]")).select(*_KEY, F.size(clean).cast("long").alias("linhas"))


@query("txt13_stop_words", "SELECT doc_id, len(list_filter(regexp_extract_all(lower(translate(text, '" + MARKED + "', '" + PLAIN + "')), '[a-z0-9_]+'), lambda w: w NOT IN ('de', 'do', 'da', 'e', 'o', 'a', 'em', 'com'))) AS palavras FROM documents WHERE text IS NOT NULL")
def _(s, d):
    kept = rp.without_stop_words(F.col("text"), ["de", "do", "da", "e", "o", "a", "em", "com", "sem", "nao"], ["sem", "nao"])
    return table(s, d, "documents").filter("text is not null").select("doc_id", F.size(F.filter(F.split(kept, "[ \n]+"), lambda w: w != "")).cast("long").alias("palavras"))


@query("txt16_normalised_measures", f"SELECT exm_an, dataExecucaoModelo, len(regexp_extract_all(regexp_replace({_LOW}, '(\\d),(\\d)', '\\1.\\2', 'g'), '\\d+\\.\\d+ (mm|cm)')) AS medidas FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    t = F.regexp_replace(norm_in_place(F.col("t")), "(\\d),(\\d)", "$1.$2")
    return _reports(s, d).select(*_KEY, F.size(F.regexp_extract_all(t, F.lit("(\\d+\\.\\d+ (mm|cm))"), 1)).cast("long").alias("medidas"))


@query("txt17_breaks")
def _(s, d):
    return _reports(s, d).select(*_KEY, rp.sentence_breaks(F.col("t")).alias("texto"))


@query("txt18_sentences", f"SELECT exm_an, dataExecucaoModelo, len(list_filter(string_split(exm_laudo_texto, chr(10)), lambda x: trim(x) <> '')) AS frases FROM {COLON} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return _reports(s, d, COLON).select(*_KEY, F.size(rp.sentences(F.col("t"), "\n")).cast("long").alias("frases"))


@query("txt19_tokens", "SELECT doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) AS tokens FROM documents WHERE text IS NOT NULL")
def _(s, d):
    return table(s, d, "documents").filter("text is not null").select("doc_id", F.size(rp.tokens(F.col("text"))).cast("long").alias("tokens"))


@query("txt20_ngrams", f"SELECT exm_an, dataExecucaoModelo, len(list_distinct(list_concat(w, list_concat(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]), list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))))) AS ngramas FROM (SELECT exm_an, dataExecucaoModelo, list_filter(regexp_extract_all(lower(translate(exm_titulo, '{MARKED}', '{PLAIN}')), '[a-z0-9_]+'), lambda x: regexp_matches(x, '^[a-z]+$') AND length(x) >= 3) AS w FROM {DII} WHERE exm_titulo IS NOT NULL)")
def _(s, d):
    return table(s, d, DII).filter("exm_titulo is not null").select(*_KEY, F.size(rp.ngrams(F.col("exm_titulo"))).cast("long").alias("ngramas"))


@query("txt21_sections")
def _(s, d):
    return _reports(s, d).select(*_KEY, F.explode(rp.sections(F.col("t"))).alias("x")).select(*_KEY, F.col("x.title").alias("secao"), F.length("x.body").alias("tamanho"))


@query("txt22_organ_sections")
def _(s, d):
    aliases = {"metodo": ["tecnica", "metodo"], "conclusao": ["conclus", "impressao", "opiniao"]}
    secs = _reports(s, d).select(*_KEY, F.explode(rp.sections(F.col("t"))).alias("x")).filter("x.title is not null")
    return secs.select(*_KEY, F.coalesce(rp.canonical_title(F.col("x.title"), aliases), F.lit("corpo")).alias("parte"), F.length("x.body").alias("tamanho"))


@query("txt23_txt24_anchored_sentences", f"SELECT exm_an, dataExecucaoModelo, len(list_filter(string_split({_LOW}, chr(10)), lambda x: regexp_matches(x, '(^|[^a-z0-9_])(ileo|colon)([^a-z0-9_]|$)'))) AS blocos FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    anchored = F.filter(rp.sentences(norm_in_place(F.col("t")), "\n"), lambda x: x.rlike("(?<![a-z0-9_])(?:ileo|colon)(?![a-z0-9_])"))
    return _reports(s, d).select(*_KEY, F.size(anchored).cast("long").alias("blocos"))


@query("txt25_organ_blocks")
def _(s, d):
    return _reports(s, d).select(*_KEY, F.posexplode(rp.blocks(F.col("t"), "(?<![a-z0-9_])(?:ileo|colon|figado)(?![a-z0-9_])")).alias("ordem", "bloco"))


@query("txt26_before_section", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN strpos({_LOW}, 'conclusao:') > 0 THEN strpos({_LOW}, 'conclusao:') - 1 ELSE length(exm_laudo_texto) END AS tamanho FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return _reports(s, d).select(*_KEY, F.length(rp.before_section(F.col("t"), "conclusao:")).cast("long").alias("tamanho"))


# engines

def _forms(s, rows: list[tuple], schema: str):
    """Written forms with what is expected of each worked out by hand; the SQL has the same table."""
    return s.createDataFrame([(i, *r[:-1]) for i, r in enumerate(rows)], f"caso int, {schema}")


def _expected(rows: list[tuple], name: str, kind: str) -> str:
    said = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()
    return f"SELECT CAST(caso AS INTEGER) AS caso, CAST({name} AS {kind}) AS {name} FROM (VALUES {', '.join(f'({i}, {said(r[-1])})' for i, r in enumerate(rows))}) v(caso, {name})"


CATEGORIES = [
    ("Conclusão: BI-RADS 2. Controle em 6 meses.", 2), ("BI-RADS 3, 6 meses", 3), ("Categoria BI-RADS IV", 4), ("Impressão: BIRADS4", 4), ("Mamas sem achados", -1), ("BI-RADS a definir", 0), ("ACR BI-RADS 5 em 12/03/2024", 5),
    ("BI RADS 0", 0), ("Nódulo de 8 mm às 3 horas. BI-RADS 4", 4), ("Direita: BI-RADS 2. Esquerda: BI-RADS 4.", 4), ("Relatório baseado na 5a edição do ACR BI-RADS 2013", -1), ("BI-RADS 9 e 2", -1), ("Categoria 7", -1), ("BI-RADS 1, rever em 1 ano", 1), ("", -1), (None, -1),
]
MEASURES = [
    ("Nódulo medindo 30 × 12 mm", 30.0), ("Cortes de 50 mm; nódulo medindo 8 mm", 8.0), ("Nódulo medindo 8 mm (comparado a 20 mm)", 8.0), ("Nódulo de 1,2 cm", 12.0), ("Cisto de 3 cm", None), ("Nódulos menores que 4 mm", 4.0),
    ("Lesão com 2 x 3,5 x 1 cm (anterior de 9 cm)", 35.0), ("Nódulo sólido no lobo superior, 7 mm", None), ("Nódulo sólido no lobo superior com 7 mm", 7.0), ("Medindo cerca de 0,9 cm", 9.0), ("Sem nódulos", None), (None, None),
]
LINES = [
    ("Fígado: normal; baço: normal; rins: normais; pâncreas: normal", "Fígado: normal; baço: normal; rins: normais; pâncreas: normal"), ("Arial; Calibri; Symbol; x\nFígado normal.", "Fígado normal."), ("heading 1; heading 2; heading 3\nA", "A"), ("A\n---\nB", "A\nB"),
    ("um; dois; três; quatro; cinco;", ""), ("Laudo gerado por um sistema especialista. Normal.", "Normal."), ("Exame por habilitação de javascript", "Exame por habilitação de javascript"), (None, None),
]
NEAREST = [
    ("Íleo e cólon: espessamento do íleo.", True), ("Espessamento do cólon, distante trinta e tantos caracteres de todo o íleo.", False), ("Espessamento difuso.", True), ("Íleo normal. Espessamento do cólon.", True), ("Cólon com espessamento; íleo normal.", True), ("Íleo normal.", False), (None, False),
]
TERMS = [
    ("sinovite do joelho", True), ("lesoes meniscais", True), ("lesao", False), ("", False), ("cisto simples", False), ("espessamento sinovial", True), (None, False),
]
SUMMARIES = [
    ("Íleo com espessamento.\nCONCLUSÃO:\nEspessamento do íleo.", "Espessamento do íleo."), ("Espessamento parietal.\nCONCLUSÃO:\nSem espessamento.", "Espessamento parietal."), ("Sem espessamento.", None), (None, None),
]
SPANS = [("Estenose e nova estenose.", "estenose:1-9 estenose:17-25"), ("Coleções; coleção parietal", "colecao:11-18"), ("Preestenose", ""), (None, None)]


@query("eng14_eng15_txt14_txt15_forms", _expected(CATEGORIES, "categoria", "INTEGER"))
def _(s, d):
    return _forms(s, CATEGORIES, "t string").select("caso", cl.category(F.col("t")).alias("categoria"))


@query("eng19_mth4_forms", _expected(MEASURES, "eixo_mm", "DOUBLE"))
def _(s, d):
    return _forms(s, MEASURES, "t string").select("caso", cl.largest_measure(F.col("t")).alias("eixo_mm"))


@query("txt9_forms", _expected(LINES, "texto", "VARCHAR"))
def _(s, d):
    return _forms(s, LINES, "t string").select("caso", rp.without_boilerplate(F.col("t")).alias("texto"))


@query("eng9_forms", _expected(NEAREST, "alvo", "BOOLEAN"))
def _(s, d):
    return _forms(s, NEAREST, "t string").select("caso", cl.nearest_in_sentences(F.col("t"), "espessamento", {"ileo": ["ileo"], "colon": ["colon"]}, "ileo", 5).alias("alvo"))


@query("eng3_forms", _expected(TERMS, "valido", "BOOLEAN"))
def _(s, d):
    kept = cl.valid_terms(F.array("t"), ["sinovite", "lesao meniscal", "espessamento sinovial"], ["lesao", "cisto"])
    return _forms(s, TERMS, "t string").select("caso", (F.size(kept) > 0).alias("valido"))


@query("eng12_forms", _expected(SUMMARIES, "resumo", "VARCHAR"))
def _(s, d):
    return _forms(s, SUMMARIES, "t string").select("caso", cl.summary_line(F.col("t"), F.lit("espessamento")).alias("resumo"))


@query("eng6_forms", _expected(SPANS, "onde", "VARCHAR"))
def _(s, d):
    where = F.transform(cl.spans(F.col("t"), BOWEL), lambda x: F.concat(x["finding"], F.lit(":"), x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return _forms(s, SPANS, "t string").select("caso", F.array_join(where, " ").alias("onde"))


@query("eng6_spans", f"SELECT exm_an, dataExecucaoModelo, regexp_matches({_LOW}, '(^|[^a-z0-9_])estenose([^a-z0-9_]|$)') AS presente FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    lex = cl.Lexicon(findings={"estenose": ["estenose"]})
    return _reports(s, d).select(*_KEY, (F.size(cl.spans(F.col("t"), lex)) > 0).alias("presente"))


@query("txt24_whole_document", f"SELECT exm_an, dataExecucaoModelo, CAST(1 AS INTEGER) AS blocos FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return cl.assess_blocks(_reports(s, d), "t", BOWEL, whole=True).select(*_KEY, F.size("blocos").alias("blocos"))



@query("eng1_eng2_block_rule")
def _(s, d):
    return cl.assess_blocks(_reports(s, d), "t", BOWEL).select(*_KEY, "relevante", F.size("blocos").alias("blocos"))


_NEG = "(SELECT doc_id, list_filter(generate_series(1, len(w)), lambda i: w[i] = 'lesao' OR w[i] = 'lesoes') AS p, w FROM (SELECT doc_id, regexp_extract_all(lower(translate(text, '" + MARKED + "', '" + PLAIN + "')), '[a-z0-9_]+') AS w FROM documents WHERE text IS NOT NULL))"


@query("eng10_negation_window", f"SELECT doc_id, len(p) AS achados, len(list_filter(p, lambda i: len(list_filter(w[greatest(i - 7, 1):i + 7], lambda x: x IN ('sem', 'nao', 'ausencia', 'ausente', 'negativo'))) > 0)) AS negados FROM {_NEG} WHERE len(p) > 0")
def _(s, d):
    lex = cl.Lexicon(findings={"lesao": ["lesao", "lesoes"]})
    h = table(s, d, "documents").filter("text is not null").select("doc_id", cl.hits(rp.words(F.col("text")), lex).alias("h")).filter("size(h) > 0")
    return h.select("doc_id", F.size("h").cast("long").alias("achados"), F.size(F.filter("h", lambda x: x["negated"])).cast("long").alias("negados"))


@query("eng6_eng13_findings")
def _(s, d):
    return cl.assess(_reports(s, d), "t", BOWEL).select(*_KEY, F.array_join("achados", ",").alias("achados"), F.array_join("negados", ",").alias("negados"), "relevante")


@query("eng7_eng8_proximity", f"SELECT exm_an, dataExecucaoModelo, len(list_filter(string_split({_LOW}, chr(10)), lambda x: contains(x, 'estenose') AND contains(x, 'ileo'))) > 0 AS junto FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return _reports(s, d).select(*_KEY, F.exists(rp.sentences(norm_in_place(F.col("t")), "\n"), lambda x: x.contains("estenose") & x.contains("ileo")).alias("junto"))


@query("eng7_near")
def _(s, d):
    return _reports(s, d).select(*_KEY, cl.near(F.col("t"), "estenose", "ileo").alias("perto"))


_POS = "strpos(lower(text), '{}')"


@query("eng9_nearest_organ", f"SELECT doc_id, CASE WHEN {_POS.format('colon')} > 0 AND {_POS.format('ileo')} > 0 THEN abs({_POS.format('medindo')} - {_POS.format('ileo')}) <= abs({_POS.format('medindo')} - {_POS.format('colon')}) + 25 ELSE true END AS alvo FROM documents WHERE {_POS.format('medindo')} > 0")
def _(s, d):
    at = lambda w: F.locate(w, F.lower("text"))
    away = lambda w: F.when(at(w) > 0, F.abs(at("medindo") - at(w)))
    return table(s, d, "documents").filter(at("medindo") > 0).select("doc_id", cl.nearest({"ileo": away("ileo"), "colon": away("colon")}, "ileo").alias("alvo"))


@query("eng11_confidence", f"SELECT exm_an, dataExecucaoModelo, CAST(CASE WHEN fl_relevante = 1 THEN 0.9 ELSE 0.35 END AS DOUBLE) AS confianca FROM {DII}")
def _(s, d):
    return table(s, d, DII).select(*_KEY, cl.confidence(F.coalesce(F.col("fl_relevante") != 1, F.lit(True))).alias("confianca"))


@query("eng12_summary")
def _(s, d):
    return _reports(s, d).select(*_KEY, cl.summary_line(F.col("t"), F.lit("espessamento")).alias("resumo"))


@query("eng14_eng15_category", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -1 WHEN o_orderkey % 5 = 1 THEN 0 ELSE CAST(o_orderkey % 7 AS INTEGER) END AS categoria FROM orders")
def _(s, d):
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, "mamas sem achados").when(k % 5 == 1, "Conclusão: BI-RADS a definir").otherwise(F.concat(F.lit("Impressão: categoria BI-RADS "), (k % 7).cast("string"), F.lit(".")))
    return table(s, d, "orders").select("o_orderkey", cl.category(text).alias("categoria"))


@query("eng16_agreement", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN fl_relevante = CASE WHEN json_array_length(exm_laudo_achados) > 0 THEN 1 ELSE 0 END THEN 'SIMIL' ELSE 'DIF' END AS concordancia FROM {DII}")
def _(s, d):
    own = F.when(F.json_array_length("exm_laudo_achados") > 0, 1).otherwise(0)
    return table(s, d, DII).select(*_KEY, F.when(F.col("fl_relevante") == own, "SIMIL").otherwise("DIF").alias("concordancia"))


@query("eng18_gated_sentences")
def _(s, d):
    return _reports(s, d).select(*_KEY, F.explode(cl.gated_sentences(F.col("t"), ["nodulo", "imagem nodular", "lesao"], 6.0)).alias("frase"))


@query("eng19_mth4_measures", "SELECT l_orderkey, l_linenumber, greatest(CAST(l_linenumber AS DOUBLE), CAST(l_partkey % 30 AS DOUBLE)) * 10 AS eixo_mm FROM lineitem")
def _(s, d):
    text = F.concat(F.lit("Nódulo medindo "), F.col("l_linenumber"), F.lit(" x "), F.col("l_partkey") % 30, F.lit(" cm (exame anterior 99 cm)."))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", cl.largest_measure(text).alias("eixo_mm"))


@query("eng21_location", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN contains(t, 'direit') AND contains(t, 'esquerd') THEN 'bilateral' WHEN contains(t, 'direit') THEN 'direito' WHEN contains(t, 'esquerd') THEN 'esquerdo' ELSE 'indefinido' END AS lado FROM (SELECT exm_an, dataExecucaoModelo, {_LOW} AS t FROM {NEURO} WHERE exm_laudo_texto IS NOT NULL)")
def _(s, d):
    t = norm_in_place(F.col("t"))
    r, left = t.contains("direit"), t.contains("esquerd")
    return _reports(s, d, NEURO).select(*_KEY, F.when(r & left, "bilateral").when(r, "direito").when(left, "esquerdo").otherwise("indefinido").alias("lado"))


@query("eng22_eng24_rule_ladder", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'terceira' WHEN o_totalprice > 200000 THEN 'segunda' WHEN o_totalprice > 100000 THEN 'primeira' ELSE 'nenhuma' END AS degrau FROM orders")
def _(s, d):
    rules = [(F.col("o_totalprice") > 100000, "primeira"), (F.col("o_totalprice") > 200000, "segunda"), (F.col("o_orderstatus") == "F", "terceira")]
    return table(s, d, "orders").select("o_orderkey", cl.ladder(rules, "nenhuma").alias("degrau"))


@query("eng26_context_rule")
def _(s, d):
    c = cl.context_positive(F.col("t"), ["placa", "lesao", "lesoes"], ["sem", "nao", "ausencia de"], ["esclerose multipla"], ["historia de", "antecedente"])
    return _reports(s, d, NEURO).select(*_KEY, c.alias("positivo"))


@query("eng5_semantic_expand")
def _(s, d):
    e = table(s, d, "embeddings").select("vec_id", "embedding", F.concat(F.lit("grupo "), F.col("label")).alias("nome"))
    seeds = e.groupBy(F.col("nome").alias("seed")).agg(F.min_by("embedding", "vec_id").alias("seed_vector"))  # the first vector of each label
    return cl.expand(e, seeds, "nome", "embedding", ["vec_id"], least=0.3, k=24)


@query("eng27_legacy_overlap", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, len(list_intersect(list_distinct(regexp_extract_all(lower(translate(proced_descricao_ajustado, '{MARKED}', '{PLAIN}')), '[a-z0-9_]+')), ['tomografia', 'abdome', 'total', 'ressonancia', 'cranio'])) AS comuns FROM {EXAM} WHERE proced_descricao_ajustado IS NOT NULL")
def _(s, d):
    key = F.array(*(F.lit(w) for w in ("tomografia", "abdome", "total", "ressonancia", "cranio")))
    return table(s, d, EXAM).filter("proced_descricao_ajustado is not null").select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), F.size(F.array_intersect(F.array_distinct(rp.words(F.col("proced_descricao_ajustado"))), key)).cast("long").alias("comuns"))
