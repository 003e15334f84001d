"""Queries of the column functions and of monitoring and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from laudaria.functions import text as tx
from laudaria.functions import values as vl
from laudaria.operators import evaluation as ev
from laudaria.operators import series as ser
from laudaria.plans.q_relational import COLON, DII, EXAM, NEURO, PATIENT, daily_events
from laudaria.plans.registry import query
from laudaria.runtime import table

_FOLD = f"translate({{}}, '{tx.MARKED}', '{tx.PLAIN}')"


def _fold(c: str) -> str:
    return _FOLD.format(c)


def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower({_fold(c)}), '\\s+', ' ', 'g'))"


@query("str1_fold", f"SELECT exm_an, dataExecucaoModelo, {_fold('unidade')} AS unidade FROM {DII}")
def _(s, d):
    return table(s, d, DII).select("exm_an", "dataExecucaoModelo", tx.fold(F.col("unidade")).alias("unidade"))


@query("str2_ascii", f"SELECT id_paciente, lower(regexp_replace({_fold('cli_nome')}, '[^\\x00-\\x7f]', '', 'g')) AS nome FROM {PATIENT}")
def _(s, d):
    return table(s, d, PATIENT).select("id_paciente", tx.ascii_lower(F.col("cli_nome")).alias("nome"))


@query("str3_norm", f"SELECT exm_an, dataExecucaoModelo, {_norm('unidade')} AS unidade FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", tx.norm(F.col("unidade")).alias("unidade"))


@query("str4_norm_in_place", f"SELECT doc_id, length(lower({_fold('text')})) - length(text) AS deslocamento, md5(lower({_fold('text')})) AS marca FROM documents")
def _(s, d):
    t = tx.norm_in_place(F.col("text"))
    return table(s, d, "documents").select("doc_id", (F.length(t) - F.length("text")).cast("long").alias("deslocamento"), F.md5(t).alias("marca"))


@query("str5_plain_spaces", f"SELECT exm_an, dataExecucaoModelo, md5(translate(exm_laudo_texto, chr(160) || chr(8199) || chr(8239), '   ')) AS marca FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", F.md5(tx.plain_spaces(F.col("exm_laudo_texto"))).alias("marca"))


@query("str6_strip", f"SELECT id_exame, regexp_replace(num_pedido_integracao, '[^a-zA-Z0-9]', '', 'g') AS pedido, regexp_replace(cod_procedimento || '.0', '\\.0$', '') AS codigo FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", tx.alphanumeric(F.col("num_pedido_integracao")).alias("pedido"), tx.without_point_zero(F.concat("cod_procedimento", F.lit(".0"))).alias("codigo"))


@query("str7_extract_all", "SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '(medindo|espessura|calibre)'), ',') AS termos FROM documents WHERE text IS NOT NULL")
def _(s, d):
    return table(s, d, "documents").filter("text is not null").select("doc_id", F.array_join(F.regexp_extract_all(F.lower("text"), F.lit("(medindo|espessura|calibre)"), 1), ",").alias("termos"))


@query("str8_builtins", f"SELECT id_paciente, upper(trim(cli_nome)) AS nome, right(cli_telefone_numero, 4) AS fim, contains(cli_nome, 'a') AS tem_a, length(cli_nome) AS tamanho, split_part(cli_nome, ' ', 1) AS primeiro FROM {PATIENT}")
def _(s, d):
    return table(s, d, PATIENT).select("id_paciente", F.upper(F.trim("cli_nome")).alias("nome"), F.right("cli_telefone_numero", F.lit(4)).alias("fim"), F.col("cli_nome").contains("a").alias("tem_a"), F.length("cli_nome").cast("long").alias("tamanho"), F.split_part("cli_nome", F.lit(" "), F.lit(1)).alias("primeiro"))


@query("str9_crypto_round_trip", f"SELECT id_paciente, cli_nome AS nome, doc_cpf AS documento FROM {PATIENT}")
def _(s, d):
    from laudaria.sources.crypto import AesCodec

    codec = AesCodec("0123456789abcdef")  # an example key
    return table(s, d, PATIENT).select("id_paciente", codec.decrypt(codec.encrypt(F.col("cli_nome"))).alias("nome"), codec.decrypt_if_coded(codec.encrypt(F.col("doc_cpf"))).alias("documento"))


@query("str10_tolerant_terms", f"SELECT exm_an, dataExecucaoModelo, len(regexp_extract_all(lower({_fold('exm_laudo_texto')}), '(?:^|[^a-z0-9_])(lesao|nodulo)(?:$|[^a-z0-9_])')) > 0 AS tem FROM {DII} WHERE exm_laudo_texto IS NOT NULL")
def _(s, d):
    return table(s, d, DII).filter("exm_laudo_texto is not null").select("exm_an", "dataExecucaoModelo", (F.size(tx.find_terms(F.col("exm_laudo_texto"), ["lesao", "nodulo"])) > 0).alias("tem"))


@query("str11_similarity")
def _(s, d):
    t = table(s, d, PATIENT).filter("cli_nome is not null").select("id_paciente", "cli_nome")
    return t.select("id_paciente", F.round(tx.similarity()(F.lower("cli_nome"), F.lower(tx.token_sort(F.col("cli_nome")))), 6).alias("semelhanca"))


@query("str13_token_sort", f"SELECT id_paciente, array_to_string(list_sort(string_split({_norm('cli_nome')}, ' ')), ' ') AS nome FROM {PATIENT} WHERE cli_nome IS NOT NULL")
def _(s, d):
    return table(s, d, PATIENT).filter("cli_nome is not null").select("id_paciente", tx.token_sort(F.col("cli_nome")).alias("nome"))


def _rule(of: str, least: int, ending: str, new: str) -> str:
    return f"CASE WHEN length({of}) >= {least} THEN regexp_replace({of}, '{ending}$', '{new}') ELSE {of} END"


_STEM = "SELECT w, w AS r FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(" + _fold("text") + "), '[a-z]+')) AS w FROM documents WHERE text IS NOT NULL)"
for _least, _ending, _new in ((5, "oes", "ao"), (5, "ais", "al"), (5, "eis", "el"), (5, "s", ""), (6, "[ao]", "")):
    _STEM = f"SELECT w, {_rule('r', _least, _ending, _new)} AS r FROM ({_STEM})"


@query("str14_stem", f"SELECT w AS palavra, CASE WHEN length(w) <= 3 THEN w ELSE r END AS raiz FROM ({_STEM})")
def _(s, d):
    words = table(s, d, "documents").select(F.explode(F.regexp_extract_all(tx.norm_in_place(F.col("text")), F.lit("([a-z]+)"), 1)).alias("palavra")).distinct()
    return words.select("palavra", tx.stem(F.col("palavra")).alias("raiz"))


@query("str15_corrections", f"SELECT exm_an, dataExecucaoModelo, md5(regexp_replace(regexp_replace({_norm('exm_titulo')}, '(^|[^a-z0-9])rm([^a-z0-9]|$)', '\\1ressonancia\\2', 'g'), '(^|[^a-z0-9])cranio([^a-z0-9]|$)', '\\1cabeca\\2', 'g')) AS marca FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", F.md5(tx.replaced(tx.norm(F.col("exm_titulo")), [("rm", "ressonancia"), ("cranio", "cabeca")])).alias("marca"))


@query("str16_decimal", "SELECT l_orderkey, l_linenumber, TRY_CAST(replace(replace('Inferior a ' || CAST(l_quantity AS VARCHAR), '.', ',')[12:], ',', '.') AS DOUBLE) AS valor FROM lineitem")
def _(s, d):
    written = F.concat(F.lit("Inferior a "), F.regexp_replace(F.col("l_quantity").cast("string"), "\\.", ","))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", tx.decimal(written).alias("valor"))


@query("str17_exam_type", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN regexp_matches(t, 'tomografia|(^|[^a-z])tc([^a-z]|$)') THEN 'TC' WHEN regexp_matches(t, 'ressonancia|(^|[^a-z])rm([^a-z]|$)|entero?rresson') THEN 'RM' WHEN regexp_matches(t, 'ultrass?on|(^|[^a-z])us([^a-z]|$)') THEN 'US' END AS tipo FROM (SELECT exm_an, dataExecucaoModelo, {_norm('exm_titulo')} AS t FROM {DII})")
def _(s, d):
    return table(s, d, DII).select("exm_an", "dataExecucaoModelo", tx.exam_type(F.col("exm_titulo")).alias("tipo"))


_MONTH_END = "(last_day(exm_data) = exm_data AND last_day(pct_datanasc) = pct_datanasc)"


_AGES = f"SELECT exm_an, dataExecucaoModelo, CAST(date_diff('year', pct_datanasc, exm_data) - CASE WHEN strftime(exm_data, '%m%d') < strftime(pct_datanasc, '%m%d') AND NOT (month(exm_data) = month(pct_datanasc) AND {_MONTH_END}) THEN 1 ELSE 0 END AS INTEGER) AS anos, CAST(floor(date_diff('day', pct_datanasc, exm_data) / 365.25) AS INTEGER) AS anos_dias FROM {DII}"


@query("dat1_dat2_age", _AGES)
@query("dat1_dat2_age_whole", _AGES)  # the name it had beside a narrower query
def _(s, d):
    t = table(s, d, DII)
    return t.select("exm_an", "dataExecucaoModelo", vl.age_by_months(F.col("pct_datanasc"), F.col("exm_data")).alias("anos"), vl.age_by_days(F.col("pct_datanasc"), F.col("exm_data")).alias("anos_dias"))


@query("dat3_latest_past", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, greatest(CASE WHEN dt_dia_exame <= DATE '2024-06-30' THEN dt_dia_exame END, CASE WHEN CAST(dt_liberacao_laudo AS DATE) <= DATE '2024-06-30' THEN CAST(dt_liberacao_laudo AS DATE) END) AS ultima FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), vl.latest_past(F.lit("2024-06-30").cast("date"), F.col("dt_dia_exame"), F.to_date("dt_liberacao_laudo")).alias("ultima"))


@query("dat4_coalesce", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, coalesce(dt_liberacao_laudo, dt_previsao_laudo, etl_data_atualizacao_carga_gold) AS momento FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), F.coalesce("dt_liberacao_laudo", "dt_previsao_laudo", "etl_data_atualizacao_carga_gold").alias("momento"))


@query("dat5_distance", f"SELECT exm_an, dataExecucaoModelo, date_diff('day', exm_data, exm_laudo_dataliber) AS dias FROM {COLON}")
def _(s, d):
    return table(s, d, COLON).select("exm_an", "dataExecucaoModelo", F.datediff("exm_laudo_dataliber", "exm_data").cast("long").alias("dias"))


@query("dat6_dat9_calendar", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS data, year(o_orderdate) AS ano, dayofyear(o_orderdate) AS dia_ano, (dayofyear(o_orderdate) - 1) // 7 + 1 AS semana, list_extract(['domingo','segunda','terça','quarta','quinta','sexta','sábado'], dayofweek(o_orderdate) + 1) AS dia_semana, list_extract(['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro'], month(o_orderdate)) AS mes FROM orders")
def _(s, d):
    c = F.col("o_orderdate")
    return table(s, d, "orders").select("o_orderkey", F.date_format(c, "dd/MM/yyyy").alias("data"), F.year(c).cast("long").alias("ano"), F.dayofyear(c).cast("long").alias("dia_ano"), vl.week_of_year(c).cast("long").alias("semana"), vl.weekday_name(c).alias("dia_semana"), vl.month_name(c).alias("mes"))


@query("dat7_local_time", "SELECT event_id, ts - INTERVAL 3 HOUR AS local FROM events WHERE ts >= TIMESTAMP '2020-01-01'")
def _(s, d):
    return table(s, d, "events").filter("ts >= '2020-01-01'").select("event_id", vl.local_time(F.col("ts").cast("timestamp")).alias("local"))


@query("dat8_parse", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data FROM orders")
def _(s, d):
    c, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format(c, "yyyyMMdd")).when(k == 1, F.date_format(c, "dd/MM/yyyy")).when(k == 2, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "dd.MM.yyyy"))
    return table(s, d, "orders").select("o_orderkey", vl.parse_date(written).alias("data"))


_CR = "l_quantity / 10"


@query("mth1_clearance", f"SELECT l_orderkey, l_linenumber, round(CASE WHEN cr <= 0 THEN -2.0 WHEN fem THEN 142 * pow(cr / 0.7, -1.2) * pow(0.9938, age) * 1.012 ELSE 142 * pow(cr / 0.9, -1.2) * pow(0.9938, age) END, 6) AS clearance FROM (SELECT l_orderkey, l_linenumber, {_CR} AS cr, CAST(20 + l_partkey % 70 AS INTEGER) AS age, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS fem FROM lineitem)")
def _(s, d):
    v = vl.clearance(F.col("l_quantity") / 10, 20 + F.col("l_partkey") % 70, F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(v, 6).alias("clearance"))


@query("mth2_clearance_by_weight", "SELECT l_orderkey, l_linenumber, round(CASE WHEN age > 16 THEN (140 - age) * (50 + l_linenumber) / (72 * cr) * CASE WHEN l_returnflag = 'R' THEN 0.8 ELSE 1 END ELSE 0.55 * (100 + l_linenumber) / cr END, 6) AS clearance FROM (SELECT *, l_quantity / 10 AS cr, CAST(l_partkey % 70 AS INTEGER) AS age FROM lineitem)")
def _(s, d):
    n = F.col("l_linenumber")
    v = vl.cockcroft_gault(F.col("l_quantity") / 10, (F.col("l_partkey") % 70).cast("int"), n + 50, F.col("l_returnflag") == "R", n + 100)
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(v, 6).alias("clearance"))


@query("mth3_repaired_weight", "SELECT o_orderkey, round(CASE WHEN o_totalprice > 10000 AND o_totalprice < 100000 THEN o_totalprice / 1000 WHEN o_totalprice > 100000 THEN o_totalprice / 10000 WHEN o_totalprice > 250 THEN o_totalprice / 10 ELSE o_totalprice END, 6) AS peso FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", F.round(vl.repaired_weight(F.col("o_totalprice")), 6).alias("peso"))


@query("mth5_cosine", "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) AS DOUBLE[])), 5) AS cosseno FROM embeddings")
def _(s, d):
    e = table(s, d, "embeddings").select("vec_id", "embedding")
    one = F.broadcast(e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("q")))
    return e.join(one, F.lit(True)).select("vec_id", F.round(vl.cosine(F.col("embedding"), F.col("q")), 5).alias("cosseno"))


@query("arr1_joined_reports", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, CASE WHEN proced_lista_exames IS NOT NULL THEN coalesce(array_to_string(list_transform(proced_lista_exames, lambda x: x.nme_exame || ': ' || length(x.laudo_transformado)), ' | '), '') END AS resumo FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), F.array_join(F.transform("proced_lista_exames", lambda x: F.concat(x["nme_exame"], F.lit(": "), F.length(x["laudo_transformado"]).cast("string"))), " | ").alias("resumo"))


@query("arr2_exploded", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, len(proced_lista_exames) AS exames FROM {EXAM} WHERE len(proced_lista_exames) > 0")
def _(s, d):
    e = table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), F.size("proced_lista_exames").cast("long").alias("exames"))
    return e.filter("exames > 0")


_AUDIT = f"SELECT exm_an, dataExecucaoModelo, list_filter([CASE WHEN pct_nome IS NULL THEN 'sem nome' END, CASE WHEN pct_cpf IS NULL THEN 'sem documento' END, CASE WHEN nme_convenio IS NULL THEN 'sem convenio' END, CASE WHEN exm_laudo_dataliber < exm_data THEN 'liberado antes' END], lambda x: x IS NOT NULL) AS a FROM {DII}"


def _audited(s, d):
    t = table(s, d, DII)
    checks = vl.audit((F.col("pct_nome").isNull(), "sem nome"), (F.col("pct_cpf").isNull(), "sem documento"), (F.col("nme_convenio").isNull(), "sem convenio"), (F.col("exm_laudo_dataliber") < F.col("exm_data"), "liberado antes"))
    return t.select("exm_an", "dataExecucaoModelo", "fl_relevante", checks.alias("a"))


@query("arr3_mon6_audit", f"SELECT exm_an, dataExecucaoModelo, array_to_string(a, '; ') AS mensagens, len(a) AS quantas FROM ({_AUDIT})")
def _(s, d):
    return _audited(s, d).select("exm_an", "dataExecucaoModelo", F.array_join("a", "; ").alias("mensagens"), F.size("a").cast("long").alias("quantas"))


@query("arr4_arr5_first_of_type", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, list_extract(list_filter(proced_lista_exames, lambda x: x.nme_exame LIKE '%a%'), 1).nme_exame AS primeiro FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), F.get(F.filter("proced_lista_exames", lambda x: x["nme_exame"].contains("a")), 0)["nme_exame"].alias("primeiro"))


@query("arr6_mon7_inconsistencies", f"SELECT t.exm_an, t.dataExecucaoModelo, array_to_string(t.a, '; ') AS mensagens FROM ({_AUDIT.replace('SELECT exm_an', 'SELECT fl_relevante, exm_an')}) t WHERE t.fl_relevante = 1 AND len(t.a) > 0")
def _(s, d):
    return _audited(s, d).filter("fl_relevante = 1 and size(a) > 0").select("exm_an", "dataExecucaoModelo", F.concat_ws("; ", "a").alias("mensagens"))


@query("jsn1_to_json", f"SELECT exm_an, dataExecucaoModelo, CAST(json_array_length(exm_laudo_achados) AS BIGINT) AS achados, json_extract_string(exm_laudo_achados, '$[0]') AS primeiro FROM {DII} WHERE exm_laudo_achados IS NOT NULL")
def _(s, d):
    found = F.from_json("exm_laudo_achados", "array<string>")
    return table(s, d, DII).filter("exm_laudo_achados is not null").select("exm_an", "dataExecucaoModelo", F.json_array_length("exm_laudo_achados").cast("long").alias("achados"), F.get(found, 0).alias("primeiro"))


@query("cnd1_defaults", f"SELECT exm_an, dataExecucaoModelo, coalesce(pct_nome, 'SEM NOME') AS nome, CASE WHEN pct_cpf IS NULL THEN 'N' ELSE 'S' END AS tem_cpf FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", F.coalesce("pct_nome", F.lit("SEM NOME")).alias("nome"), F.when(F.col("pct_cpf").isNull(), "N").otherwise("S").alias("tem_cpf"))


@query("cnd2_four_way", "SELECT doc_id, CASE WHEN a AND b THEN 'ambos' WHEN a THEN 'medida' WHEN b THEN 'imagem' ELSE 'nenhum' END AS classe FROM (SELECT doc_id, coalesce(text LIKE '%medindo%', false) AS a, coalesce(text LIKE '%imagem%', false) AS b FROM documents)")
def _(s, d):
    a, b = (F.coalesce(F.col("text").contains(w), F.lit(False)) for w in ("medindo", "imagem"))
    return table(s, d, "documents").select("doc_id", F.when(a & b, "ambos").when(a, "medida").when(b, "imagem").otherwise("nenhum").alias("classe"))


# monitoring


@query("mon1_stage_volumes", f"WITH e AS (SELECT dt_dia_exame AS dia, id_unidade AS unidade, count(*) AS entrada FROM {EXAM} GROUP BY ALL), o AS (SELECT exm_data AS dia, idunidade AS unidade, count(*) AS saida, CAST(sum(fl_relevante) AS BIGINT) AS relevante FROM {DII} GROUP BY ALL) SELECT e.dia, e.unidade, e.entrada, coalesce(o.saida, 0) AS saida, coalesce(o.relevante, 0) AS relevante FROM e LEFT JOIN o ON e.dia = o.dia AND e.unidade = o.unidade")
def _(s, d):
    e = table(s, d, EXAM).groupBy(F.col("dt_dia_exame").alias("dia"), F.col("id_unidade").alias("unidade")).agg(F.count("*").alias("entrada"))
    o = table(s, d, DII).groupBy(F.col("exm_data").alias("dia"), F.col("idunidade").alias("unidade")).agg(F.count("*").alias("saida"), F.sum("fl_relevante").alias("relevante"))
    return e.join(o, ["dia", "unidade"], "left").fillna(0, ["saida", "relevante"])


@query("mon2_filled", f"SELECT idunidade, CAST(count_if(exm_status IS NOT NULL) AS BIGINT) AS preenchido, CAST(count_if(exm_status IS NULL) AS BIGINT) AS nao_preenchido FROM {NEURO} GROUP BY idunidade")
def _(s, d):
    return table(s, d, NEURO).groupBy("idunidade").agg(F.count_if(F.col("exm_status").isNotNull()).alias("preenchido"), F.count_if(F.col("exm_status").isNull()).alias("nao_preenchido"))


_DAILY = "SELECT user_id % 20 AS unidade, CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY ALL"


@query("mon3b_against_mean", f"SELECT dia, n, CASE WHEN n > m THEN 'Aumento' WHEN n < m THEN 'Queda' ELSE 'Estável' END AS situacao FROM (SELECT dia, n, avg(n) OVER (PARTITION BY year(dia)) AS m FROM (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1))")
def _(s, d):
    daily = table(s, d, "events").groupBy(F.to_date("ts").alias("dia")).agg(F.count("*").alias("n"))
    return ser.against_mean(daily, "dia", "n").select("dia", "n", "situacao")


@query("mon4_inactivity", f"WITH n AS (SELECT idunidade, dataExecucaoModelo AS dia, count(*) AS n FROM {DII} GROUP BY ALL), g AS (SELECT u.idunidade, CAST(x.d AS DATE) AS dia, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT idunidade FROM n) u CROSS JOIN (SELECT unnest(generate_series(DATE '2024-04-01', DATE '2024-05-19', INTERVAL 1 DAY)) AS d) x LEFT JOIN n ON n.idunidade = u.idunidade AND n.dia = x.d) SELECT idunidade, dia, n, CAST(r AS BIGINT) AS atividade_recente FROM (SELECT *, CASE WHEN count(*) OVER w3 >= 3 THEN sum(n) OVER w3 END AS q, sum(n) OVER (PARTITION BY idunidade ORDER BY dia ROWS 14 PRECEDING) AS r FROM g WINDOW w3 AS (PARTITION BY idunidade ORDER BY dia ROWS 2 PRECEDING)) WHERE q = 0 AND r >= 1 AND dia >= DATE '2024-05-19' - 2")
def _(s, d):
    daily = table(s, d, DII).groupBy("idunidade", F.col("dataExecucaoModelo").alias("dia")).agg(F.count("*").alias("n"))
    return ser.inactivity(daily, "idunidade", "dia", "n", "2024-04-01", "2024-05-19", least=1).select("idunidade", "dia", "n", "atividade_recente")


@query("mon5_pending", f"SELECT dataExecucaoModelo, count(*) AS pendentes FROM {DII} WHERE exm_status IS NULL GROUP BY 1")
def _(s, d):
    return table(s, d, DII).filter("exm_status is null").groupBy("dataExecucaoModelo").agg(F.count("*").alias("pendentes"))


@query("mon8_daily_new", f"SELECT dataExecucaoModelo AS dia, count(*) AS linhas FROM {COLON} WHERE dataExecucaoModelo NOT IN (SELECT dataExecucaoModelo FROM {DII} WHERE dataExecucaoModelo < DATE '2024-06-01') GROUP BY 1")
def _(s, d):
    from laudaria.operators.relational import new_rows

    daily = table(s, d, COLON).groupBy(F.col("dataExecucaoModelo").alias("dia")).agg(F.count("*").alias("linhas"))
    return new_rows(daily, table(s, d, DII).filter("dataExecucaoModelo < '2024-06-01'").select(F.col("dataExecucaoModelo").alias("dia")), ["dia"])


@query("mon9_run_metadata", f"SELECT 'dii' AS especialidade, dataExecucaoModelo, count(*) AS laudos, round(sum(fl_relevante) / count(*), 6) AS taxa_relevancia FROM {DII} GROUP BY 2")
def _(s, d):
    return table(s, d, DII).groupBy("dataExecucaoModelo").agg(F.count("*").alias("laudos"), F.round(F.sum("fl_relevante") / F.count("*"), 6).alias("taxa_relevancia")).withColumn("especialidade", F.lit("dii"))


_PRED = f"SELECT fl_relevante = 1 AS real, exm_laudo_texto LIKE '%com %' AND exm_laudo_texto LIKE '%realce%' AS prev FROM {DII} WHERE fl_relevante IS NOT NULL AND exm_laudo_texto IS NOT NULL"


@query("mon10_metrics", f"SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precisao, round(tp / nullif(tp + fn, 0), 6) AS revocacao, round(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 6) AS f_beta, round(tn / nullif(tn + fp, 0), 6) AS especificidade, round(tn / nullif(tn + fn, 0), 6) AS vpn, round(((tp + tn) / (tp + fp + fn + tn) - pe) / (1 - pe), 6) AS kappa FROM (SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS pe FROM (SELECT CAST(count_if(prev AND real) AS BIGINT) AS tp, CAST(count_if(prev AND NOT real) AS BIGINT) AS fp, CAST(count_if(NOT prev AND real) AS BIGINT) AS fn, CAST(count_if(NOT prev AND NOT real) AS BIGINT) AS tn FROM ({_PRED})))")
def _(s, d):
    c = F.col("exm_laudo_texto")
    return ev.metrics(ev.confusion(table(s, d, DII), c.contains("com ") & c.contains("realce"), F.col("fl_relevante") == 1))


@query("mon11_cochran", f"SELECT round(2 * (3 * (sa * sa + sb * sb + sc * sc) - n * n) / nullif(3 * n - n2, 0), 6) AS q FROM (SELECT sum(a) AS sa, sum(b) AS sb, sum(c) AS sc, sum(a + b + c) AS n, sum((a + b + c) * (a + b + c)) AS n2 FROM (SELECT CAST(contains(exm_laudo_texto, 'realce') AS INTEGER) AS a, CAST(contains(exm_laudo_texto, 'espess') AS INTEGER) AS b, CAST(contains(exm_laudo_texto, 'calibre') AS INTEGER) AS c FROM {DII} WHERE exm_laudo_texto IS NOT NULL))")
def _(s, d):
    t = table(s, d, DII).filter("exm_laudo_texto is not null")
    return ev.cochran_q(t.select(*(F.col("exm_laudo_texto").contains(w).cast("int").alias(n) for n, w in (("a", "realce"), ("b", "espess"), ("c", "calibre")))), ["a", "b", "c"])


@query("mon11_bootstrap")
def _(s, d):
    return ev.bootstrap(table(s, d, DII).select("exm_an", "dataExecucaoModelo", "fl_relevante"), "fl_relevante")


@query("mon12_drift", f"SELECT unidade, dia, n, round(avg(n) OVER w, 6) AS media_anterior, coalesce((n - avg(n) OVER w) / nullif(avg(n) OVER w, 0) < -0.2, false) AS alerta_volume FROM ({_DAILY}) WINDOW w AS (PARTITION BY unidade ORDER BY dia ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")
def _(s, d):
    out = ser.alerts(ser.drift(daily_events(s, d), ["unidade"], "dia", "n"), "n")
    return out.select("unidade", "dia", "n", F.round("media_anterior", 6).alias("media_anterior"), "alerta_volume")


@query("str12_best_match")
def _(s, d):
    known = table(s, d, DII).select(tx.norm(F.col("exm_titulo")).alias("conhecido")).filter("conhecido is not null").distinct()
    titles = table(s, d, EXAM).select(tx.norm(F.col("proced_descricao_ajustado")).alias("titulo")).filter("titulo is not null").distinct()
    # candidates share a word; the ratio is worked out for those alone
    word = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    met = titles.withColumn("_w", word("titulo")).join(known.withColumn("_w", word("conhecido")), "_w").select("titulo", "conhecido").distinct()
    scored = met.withColumn("nota", F.round(tx.similarity()("titulo", "conhecido"), 6)).filter("nota >= 0.3")
    return scored.groupBy("titulo").agg(F.max_by("conhecido", F.struct("nota", "conhecido")).alias("conhecido"), F.max("nota").alias("nota"))


@query("eng28_score_deciles", "SELECT vec_id, ntile(10) OVER (PARTITION BY label ORDER BY vec_id % 97, vec_id) AS decil FROM embeddings")
def _(s, d):
    from pyspark.sql import Window

    return table(s, d, "embeddings").select("vec_id", F.ntile(10).over(Window.partitionBy("label").orderBy(F.col("vec_id") % 97, "vec_id")).alias("decil"))
