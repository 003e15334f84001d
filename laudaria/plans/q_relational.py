"""Queries of the relational operators: scans, projections, filters, joins, aggregations, windows, sets, changes of state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laudaria.functions import text as tx
from laudaria.functions import values as vl
from laudaria.operators import merge as mg
from laudaria.operators import relational as rel
from laudaria.operators import series as ser
from laudaria.plans.registry import query
from laudaria.runtime import table

EXAM, PATIENT = "tb_gold_mov_exame", "tb_gold_mov_paciente"
DII, NEURO, COLON = "tb_diamond_mod_dii_saida", "tb_diamond_mod_neuroimunologia_saida", "tb_diamond_mod_dii_colonoscopia_saida"


# scans, projections, filters


@query("src1_run_scan", f"SELECT exm_an, id_pct, exm_mod FROM {DII} WHERE dataExecucaoModelo = DATE '2024-05-13'")
def _(s, d):
    return table(s, d, DII).filter(F.col("dataExecucaoModelo") == F.lit("2024-05-13").cast("date")).select("exm_an", "id_pct", "exm_mod")


@query("src8_exam_texts", f"SELECT id_exame, x.nme_exame AS nome, length(x.laudo_transformado) AS tamanho FROM (SELECT id_exame, unnest(proced_lista_exames) AS x FROM {EXAM})")
def _(s, d):
    return table(s, d, EXAM).select("id_exame", F.explode("proced_lista_exames").alias("x")).select("id_exame", F.col("x.nme_exame").alias("nome"), F.length("x.laudo_transformado").cast("long").alias("tamanho"))


@query("snk2_rerun_partition", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'reprocessado' ELSE o_orderpriority END AS situacao, o_orderstatus FROM orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("situacao"), "o_orderstatus")
    return mg.replace_partitions(o, o.filter("o_orderstatus = 'O'").withColumn("situacao", F.lit("reprocessado")), ["o_orderstatus"])


@query("snk3_empty_like", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS observacao FROM orders WHERE 1 = 0")
def _(s, d):
    return table(s, d, "orders").filter("1 = 0").select("o_orderkey", "o_orderstatus", F.lit(None).cast("string").alias("observacao"))


@query("snk5_export_shape", f"SELECT exm_an AS \"Exame\", pct_nome AS \"Nome\", strftime(exm_data, '%d/%m/%Y') AS \"Data\", CAST(NULL AS VARCHAR) AS \"Retorno\" FROM {NEURO}")
def _(s, d):
    from laudaria.sources.sinks import export_shape

    return export_shape(table(s, d, NEURO).withColumn("exm_data", F.date_format("exm_data", "dd/MM/yyyy")), {"exm_an": "Exame", "pct_nome": "Nome", "exm_data": "Data", "retorno": "Retorno"})


@query("snk6_unit_counts", f"SELECT u.unidade AS idunidade, count(t.exm_an) AS linhas FROM unidades_config u LEFT JOIN {DII} t ON t.idunidade = u.unidade WHERE u.enabled AND u.unidades IS NOT NULL GROUP BY u.unidade")
def _(s, d):
    from laudaria.sources.sinks import per_unit

    return per_unit(table(s, d, DII).select("exm_an", "idunidade"), table(s, d, "unidades_config"), "idunidade")[1].select("idunidade", F.col("linhas").cast("long").alias("linhas"))


@query("snk9_payload", "SELECT c_custkey, '{\"nome\":\"' || c_name || '\",\"segmento\":\"' || c_mktsegment || '\"}' AS payload FROM customer")
def _(s, d):
    from laudaria.sources.sinks import payload

    return payload(table(s, d, "customer").select("c_custkey", F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmento")), ["nome", "segmento"]).select("c_custkey", "payload")


@query("prj2_except", f"SELECT * EXCLUDE (exm_laudo_texto, exm_laudo_texto_tratado, exm_laudo_resultado, exm_laudo_achados) FROM {COLON}")
def _(s, d):
    return table(s, d, COLON).drop("exm_laudo_texto", "exm_laudo_texto_tratado", "exm_laudo_resultado", "exm_laudo_achados")


@query("prj3_lateral_alias", f"SELECT id_exame, lower(trim(tp_procedimento)) AS tipo, length(lower(trim(tp_procedimento))) AS tamanho FROM {EXAM}")
def _(s, d):
    return table(s, d, EXAM).selectExpr("id_exame", "lower(trim(tp_procedimento)) AS tipo", "CAST(length(tipo) AS BIGINT) AS tamanho")


@query("prj5_synthetic_key", f"SELECT exm_an, replace(CAST(exm_data AS VARCHAR), '-', '') || id_pct AS chave FROM {DII}")
def _(s, d):
    return table(s, d, DII).select("exm_an", F.concat(F.regexp_replace(F.col("exm_data").cast("string"), "-", ""), F.col("id_pct")).alias("chave"))


@query("flt1_any_substring", f"SELECT id_exame FROM {EXAM} WHERE coalesce(proced_descricao_ajustado, '') ILIKE '%abdome%' OR coalesce(proced_descricao_ajustado, '') ILIKE '%pelve%' OR coalesce(dsc_codigo, '') ILIKE '%abdome%' OR coalesce(dsc_codigo, '') ILIKE '%pelve%'")
def _(s, d):
    terms = ["abdome", "pelve"]
    return table(s, d, EXAM).filter(tx.contains_any(F.col("proced_descricao_ajustado"), terms) | tx.contains_any(F.col("dsc_codigo"), terms)).select("id_exame")


@query("flt2_word_edges", f"SELECT exm_an, exm_titulo FROM {NEURO} WHERE regexp_matches(lower(exm_titulo), '(^|[^a-z])rm([^a-z]|$)')")
def _(s, d):
    return table(s, d, NEURO).filter(F.lower("exm_titulo").rlike("(^|[^a-z])rm([^a-z]|$)")).select("exm_an", "exm_titulo")


@query("flt3_precedence", f"SELECT id_exame FROM {EXAM} WHERE (lower(proced_descricao_ajustado) LIKE '%tomografia%' AND lower(proced_descricao_ajustado) LIKE '%abdome%') OR lower(proced_descricao_ajustado) LIKE '%colonoscopia%'")
def _(s, d):
    c = F.lower("proced_descricao_ajustado")
    return table(s, d, EXAM).filter((c.contains("tomografia") & c.contains("abdome")) | c.contains("colonoscopia")).select("id_exame")


@query("flt4_type_gate", f"SELECT id_exame, upper(trim(tp_procedimento)) AS tipo FROM {EXAM} WHERE upper(trim(tp_procedimento)) IN ('IMG', 'IMA')")
def _(s, d):
    return table(s, d, EXAM).filter(F.upper(F.trim("tp_procedimento")).isin("IMG", "IMA")).select("id_exame", F.upper(F.trim("tp_procedimento")).alias("tipo"))


@query("flt5_date_window", f"SELECT id_exame, dt_dia_exame FROM {EXAM} WHERE dt_dia_exame BETWEEN DATE '2024-06-30' - 30 AND DATE '2024-06-30' - 1")
def _(s, d):
    run = F.lit("2024-06-30").cast("date")
    return table(s, d, EXAM).filter(F.col("dt_dia_exame").between(F.date_sub(run, 30), F.date_sub(run, 1))).select("id_exame", "dt_dia_exame")


@query("flt6_html_rejection", f"SELECT exm_an FROM {DII} WHERE exm_laudo_texto IS NOT NULL AND NOT regexp_matches(exm_laudo_texto, '<br|<p>|<html|align=|class=')")
def _(s, d):
    return table(s, d, DII).filter(~F.col("exm_laudo_texto").rlike("<br|<p>|<html|align=|class=")).select("exm_an")


@query("flt7_blank_rejection", f"SELECT exm_an FROM {NEURO} WHERE trim(exm_laudo_texto) <> '' AND strpos(exm_laudo_texto, chr(1)) = 0")
def _(s, d):
    c = F.col("exm_laudo_texto")
    return table(s, d, NEURO).filter((F.trim(c) != "") & ~c.contains("\x00") & ~c.contains("\x01")).select("exm_an")


@query("flt8_insurer_exclusion", f"SELECT exm_an, nme_convenio FROM {DII} WHERE NOT regexp_matches(nme_convenio, '(?i)(^|[^A-Za-z0-9_])rede')")
def _(s, d):
    return table(s, d, DII).filter(~F.col("nme_convenio").rlike(r"(?i)(?<!\w)rede")).select("exm_an", "nme_convenio")


@query("flt9_length_gate", "SELECT doc_id FROM documents WHERE length(trim(text)) > 10")
def _(s, d):
    return table(s, d, "documents").filter(F.length(F.trim("text")) > 10).select("doc_id")


@query("flt10_range_gate", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_quantity * 1.1 AS DECIMAL(10,0)) BETWEEN 1 AND 35")
def _(s, d):
    return table(s, d, "lineitem").filter(vl.in_range(F.col("l_quantity") * 1.1, 0.1, 35)).select("l_orderkey", "l_linenumber")


@query("flt11_duplicates", f"SELECT exm_an, count(*) AS qtd FROM {DII} GROUP BY exm_an HAVING count(*) > 1")
def _(s, d):
    return table(s, d, DII).groupBy("exm_an").agg(F.count("*").alias("qtd")).filter("qtd > 1")


@query("flt12_age_limit", f"SELECT exm_an, coalesce(CAST(idade_paciente AS INTEGER), CAST(floor(date_diff('day', pct_datanasc, DATE '2024-06-30') / 365.25) AS INTEGER)) AS idade FROM {NEURO} WHERE coalesce(CAST(idade_paciente AS INTEGER), CAST(floor(date_diff('day', pct_datanasc, DATE '2024-06-30') / 365.25) AS INTEGER)) <= 80")
def _(s, d):
    age = F.coalesce(F.col("idade_paciente").cast("int"), vl.age_by_days(F.col("pct_datanasc"), F.lit("2024-06-30").cast("date")))
    return table(s, d, NEURO).select("exm_an", age.alias("idade")).filter("idade <= 80")


@query("flt13_code_whitelist", f"SELECT id_exame, cod_procedimento FROM {EXAM} WHERE TRY_CAST(cod_procedimento AS BIGINT) % 3 = 0 AND TRY_CAST(cod_procedimento AS BIGINT) IN (SELECT TRY_CAST(cod_procedimento AS BIGINT) FROM {EXAM} WHERE tp_codigo IS NOT NULL)")
def _(s, d):
    e = table(s, d, EXAM).withColumn("_c", F.col("cod_procedimento").try_cast("bigint"))
    codes = e.filter("tp_codigo is not null and _c is not null").select("_c").distinct()
    return e.filter("_c % 3 = 0").join(codes, "_c", "left_semi").select("id_exame", "cod_procedimento")


@query("flt14_empty_guard", "SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1900-01-01'")
def _(s, d):
    return table(s, d, "orders").filter("o_orderdate < '1900-01-01'").select("o_orderkey")


@query("flt15_modality_split", f"SELECT 'CT' AS parte, count(*) AS n FROM {DII} WHERE exm_mod = 'CT' UNION ALL SELECT 'resto', count(*) FROM {DII} WHERE exm_mod <> 'CT'")
def _(s, d):
    t = table(s, d, DII)
    return t.filter("exm_mod = 'CT'").agg(F.count("*").alias("n")).select(F.lit("CT").alias("parte"), "n").unionByName(t.filter("exm_mod <> 'CT'").agg(F.count("*").alias("n")).select(F.lit("resto").alias("parte"), "n"))


# joins

_LATEST_PATIENT = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_paciente ORDER BY etl_data_atualizacao_carga_gold DESC NULLS LAST, cli_telefone_numero DESC NULLS LAST) AS n FROM {PATIENT}) WHERE n = 1)"


def latest_patients(s, d, *columns: str) -> DataFrame:
    """The newest row of each patient; only the columns asked for are read."""
    order = ["etl_data_atualizacao_carga_gold", "cli_telefone_numero"]
    return rel.latest(table(s, d, PATIENT).select("id_paciente", *order, *(c for c in columns if c not in order)), ["id_paciente"], order)


@query("jn1_exam_patient", f"SELECT e.id_exame, e.etl_data_atualizacao_carga_gold AS carga, e.id_patient, p.cli_nome FROM {EXAM} e LEFT JOIN {_LATEST_PATIENT} p ON p.id_paciente = e.id_patient")
def _(s, d):
    e = table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), "id_patient")
    p = latest_patients(s, d, "cli_nome").select(F.col("id_paciente").alias("id_patient"), "cli_nome")
    return e.join(p, "id_patient", "left").select("id_exame", "carga", "id_patient", "cli_nome")


@query("jn2_output_exam", f"SELECT DISTINCT t.exm_an, t.fl_relevante, e.id_unidade FROM {DII} t JOIN {EXAM} e ON e.id_exame = t.exm_an")
def _(s, d):
    return table(s, d, DII).select("exm_an", "fl_relevante").join(table(s, d, EXAM).select(F.col("id_exame").alias("exm_an"), "id_unidade"), "exm_an").distinct()


@query("jn3_incremental", f"SELECT id_exame, dt_dia_exame FROM {EXAM} e WHERE NOT EXISTS (SELECT 1 FROM {DII} t WHERE t.exm_an = e.id_exame)")
def _(s, d):
    return rel.new_rows(table(s, d, EXAM).select("id_exame", "dt_dia_exame"), table(s, d, DII).select(F.col("exm_an").alias("id_exame")), ["id_exame"])


@query("jn4_not_in", f"SELECT id_exame FROM {EXAM} WHERE id_patient NOT IN (SELECT id_pct FROM {NEURO} WHERE id_pct IS NOT NULL)")
def _(s, d):
    return rel.not_in(table(s, d, EXAM).select("id_exame", "id_patient"), table(s, d, NEURO).filter("id_pct is not null").select(F.col("id_pct").alias("id_patient")), "id_patient").select("id_exame")


@query("jn5_left_only", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(s, d):
    return rel.new_rows(table(s, d, "customer").select("c_custkey"), table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("jn6_semi", f"SELECT id_exame FROM {EXAM} WHERE id_exame IN (SELECT exm_an FROM {COLON})")
def _(s, d):
    return table(s, d, EXAM).select("id_exame").join(table(s, d, COLON).select(F.col("exm_an").alias("id_exame")), "id_exame", "left_semi")


_STATUS = " UNION ALL ".join(f"SELECT DISTINCT exm_an, '{t}' AS origem, fl_relevante FROM {t}" for t in (DII, NEURO))


@query("jn7_status_view", f"WITH o AS ({_STATUS}), r AS (SELECT exm_an, max(fl_relevante) AS rel FROM o GROUP BY exm_an), e AS (SELECT DISTINCT id_exame FROM {EXAM}) SELECT e.id_exame, 1 AS fl_entrada, CASE WHEN r.exm_an IS NOT NULL THEN 1 ELSE 0 END AS fl_saida, CASE WHEN r.rel = 1 THEN 1 ELSE 0 END AS fl_relevante, CASE WHEN c.exm_an IS NOT NULL THEN 1 ELSE 0 END AS fl_colono FROM e LEFT JOIN r ON r.exm_an = e.id_exame LEFT JOIN (SELECT DISTINCT exm_an FROM {COLON}) c ON c.exm_an = e.id_exame")
def _(s, d):
    out = reduce(DataFrame.unionByName, [table(s, d, t).select("exm_an", "fl_relevante") for t in (DII, NEURO)]).groupBy(F.col("exm_an").alias("id_exame")).agg(F.max("fl_relevante").alias("rel"), F.lit(1).alias("saida"))
    colon = table(s, d, COLON).select(F.col("exm_an").alias("id_exame")).distinct().withColumn("colono", F.lit(1))
    e = table(s, d, EXAM).select("id_exame").distinct()
    flag = lambda c: F.when(c, 1).otherwise(0)
    return e.join(out, "id_exame", "left").join(colon, "id_exame", "left").select("id_exame", F.lit(1).alias("fl_entrada"), flag(F.col("saida") == 1).alias("fl_saida"), flag(F.col("rel") == 1).alias("fl_relevante"), flag(F.col("colono") == 1).alias("fl_colono"))


@query("jn8_composite", f"WITH a AS (SELECT dataExecucaoModelo AS dia, idunidade, count(*) AS saidas FROM {DII} GROUP BY ALL), b AS (SELECT dataExecucaoModelo AS dia, idunidade, count(*) AS relevantes FROM {DII} WHERE fl_relevante = 1 GROUP BY ALL) SELECT a.dia, a.idunidade, a.saidas, coalesce(b.relevantes, 0) AS relevantes FROM a LEFT JOIN b ON a.dia = b.dia AND a.idunidade = b.idunidade")
def _(s, d):
    t = table(s, d, DII).select(F.col("dataExecucaoModelo").alias("dia"), "idunidade", "fl_relevante")
    a, b = t.groupBy("dia", "idunidade").agg(F.count("*").alias("saidas")), t.filter("fl_relevante = 1").groupBy("dia", "idunidade").agg(F.count("*").alias("relevantes"))
    return a.join(b, ["dia", "idunidade"], "left").fillna(0, ["relevantes"])


@query("jn9_latest_lookup", f"SELECT t.exm_an, t.dataExecucaoModelo, p.cli_genero FROM {NEURO} t JOIN {_LATEST_PATIENT} p ON p.id_paciente = t.id_pct")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", F.col("id_pct").alias("id_paciente")).join(latest_patients(s, d, "cli_genero").select("id_paciente", "cli_genero"), "id_paciente").select("exm_an", "dataExecucaoModelo", "cli_genero")


@query("jn10_derived_key", "SELECT o_orderkey, c_name FROM (SELECT o_orderkey, 'Customer/' || o_custkey AS ref FROM orders) o JOIN customer ON c_custkey = CAST(replace(ref, 'Customer/', '') AS BIGINT)")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("Customer/"), F.col("o_custkey")).alias("ref"))
    return o.withColumn("c_custkey", F.regexp_replace("ref", "^Customer/", "").cast("bigint")).join(table(s, d, "customer").select("c_custkey", "c_name"), "c_custkey").select("o_orderkey", "c_name")


@query("jn11_two_step", f"WITH k AS (SELECT idunidade, min(nme_regional_hospital) AS r FROM {DII} GROUP BY 1), f AS (SELECT lower(trim(unidade)) AS nome, min(nme_regional_hospital) AS r FROM {DII} GROUP BY 1) SELECT n.exm_an, n.dataExecucaoModelo, coalesce(k.r, f.r) AS regional FROM {NEURO} n LEFT JOIN k ON k.idunidade = n.idunidade LEFT JOIN f ON f.nome = lower(trim(n.unidade))")
def _(s, d):
    shape = lambda t: t.select("idunidade", F.lower(F.trim("unidade")).alias("nome"), F.col("nme_regional_hospital").alias("regional"))
    n = table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", "idunidade", F.lower(F.trim("unidade")).alias("nome"))
    return rel.lookup(n, shape(table(s, d, DII)), "idunidade", "nome", "regional").select("exm_an", "dataExecucaoModelo", "regional")


@query("jn12_cascade", f"SELECT exm_an, dataExecucaoModelo FROM {NEURO} n WHERE NOT EXISTS (SELECT 1 FROM {DII} x WHERE x.num_pedido_integracao = n.num_pedido_integracao) AND NOT EXISTS (SELECT 1 FROM {DII} x WHERE x.pct_cpf = n.pct_cpf) AND NOT EXISTS (SELECT 1 FROM {DII} x WHERE x.pct_nome = n.pct_nome)")
def _(s, d):
    keys = ["num_pedido_integracao", "pct_cpf", "pct_nome"]
    return rel.eliminate(table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", *keys), table(s, d, DII), keys).select("exm_an", "dataExecucaoModelo")


@query("jn13_padded_key", "SELECT o_orderkey, coalesce(c.c_name, 'sem cadastro') AS nome FROM orders LEFT JOIN (SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS k, c_name FROM customer WHERE c_custkey % 2 = 0) c ON c.k = lpad(CAST(o_custkey AS VARCHAR), 14, '0')")
def _(s, d):
    pad = lambda c: F.lpad(F.col(c).cast("string"), 14, "0")
    c = table(s, d, "customer").filter("c_custkey % 2 = 0").select(pad("c_custkey").alias("k"), "c_name")
    return table(s, d, "orders").select("o_orderkey", pad("o_custkey").alias("k")).join(c, "k", "left").select("o_orderkey", F.coalesce("c_name", F.lit("sem cadastro")).alias("nome"))


@query("jn14_spine", f"WITH u AS (SELECT DISTINCT idunidade FROM {DII}), n AS (SELECT idunidade, dataExecucaoModelo AS dia, count(*) AS linhas FROM {DII} GROUP BY ALL) SELECT u.idunidade, CAST(g.dia AS DATE) AS dia, coalesce(n.linhas, 0) AS linhas FROM u CROSS JOIN (SELECT unnest(generate_series(DATE '2024-05-01', DATE '2024-06-30', INTERVAL 1 DAY)) AS dia) g LEFT JOIN n ON n.idunidade = u.idunidade AND n.dia = g.dia")
def _(s, d):
    t = table(s, d, DII)
    n = t.groupBy("idunidade", F.col("dataExecucaoModelo").alias("dia")).agg(F.count("*").alias("linhas"))
    return rel.spine(t.select("idunidade").distinct(), F.lit("2024-05-01"), F.lit("2024-06-30")).join(n, ["idunidade", "dia"], "left").fillna(0, ["linhas"])


@query("jn15_nearest_mention", "SELECT doc_id, abs(strpos(lower(text), 'medindo') - strpos(lower(text), 'imagem')) AS distancia FROM documents WHERE strpos(lower(text), 'medindo') > 0 AND strpos(lower(text), 'imagem') > 0")
def _(s, d):
    at = lambda w: F.locate(w, F.lower("text"))
    return table(s, d, "documents").filter((at("medindo") > 0) & (at("imagem") > 0)).select("doc_id", F.abs(at("medindo") - at("imagem")).cast("long").alias("distancia"))


@query("jn16_phrases", "SELECT n_name || ' ' || r_name AS frase FROM nation CROSS JOIN region")
def _(s, d):
    regions = table(s, d, "region").agg(F.collect_list("r_name").alias("r"))  # a closed list of words goes with each row
    return table(s, d, "nation").join(F.broadcast(regions), F.lit(True)).select(F.explode(F.transform("r", lambda x: F.concat_ws(" ", F.col("n_name"), x))).alias("frase"))


@query("jn17_restricted", f"SELECT p.id_paciente, p.cli_nome FROM {_LATEST_PATIENT} p WHERE p.id_paciente IN (SELECT id_pct FROM {COLON})")
def _(s, d):
    p = rel.restrict(table(s, d, PATIENT), table(s, d, COLON).select(F.col("id_pct").alias("id_paciente")), "id_paciente")
    return rel.latest(p, ["id_paciente"], ["etl_data_atualizacao_carga_gold", "cli_telefone_numero"]).select("id_paciente", "cli_nome")


@query("jn18_fallback", f"SELECT DISTINCT t.exm_an, coalesce(t.nme_convenio, e.nme_convenio) AS convenio FROM {DII} t LEFT JOIN {EXAM} e ON e.id_exame = t.exm_an WHERE coalesce(t.nme_convenio, e.nme_convenio) IS NOT NULL")
def _(s, d):
    e = table(s, d, EXAM).select(F.col("id_exame").alias("exm_an"), F.col("nme_convenio").alias("outro"))
    return table(s, d, DII).select("exm_an", "nme_convenio").join(e, "exm_an", "left").select("exm_an", F.coalesce("nme_convenio", "outro").alias("convenio")).filter("convenio is not null").distinct()


# aggregations


@query("agg1_count_by_run", f"SELECT dataExecucaoModelo, count(*) AS linhas FROM {COLON} GROUP BY ALL")
def _(s, d):
    return table(s, d, COLON).groupBy("dataExecucaoModelo").agg(F.count("*").alias("linhas"))


@query("agg2_conditional", f"SELECT idunidade, CAST(count_if(fl_relevante = 1) AS BIGINT) AS relevantes, CAST(sum(CASE WHEN pct_nome IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sem_nome FROM {NEURO} GROUP BY idunidade")
def _(s, d):
    return table(s, d, NEURO).groupBy("idunidade").agg(F.count_if(F.col("fl_relevante") == 1).alias("relevantes"), F.sum(F.when(F.col("pct_nome").isNull(), 1).otherwise(0)).alias("sem_nome"))


@query("agg3_distinct", f"SELECT id_unidade, count(DISTINCT id_exame) AS exames, count(DISTINCT id_patient) AS pacientes FROM {EXAM} GROUP BY id_unidade")
def _(s, d):
    return table(s, d, EXAM).groupBy("id_unidade").agg(F.countDistinct("id_exame").alias("exames"), F.countDistinct("id_patient").alias("pacientes"))


@query("agg4_volumes", f"SELECT dataExecucaoModelo, nme_regional_hospital, idunidade, count(*) AS linhas, CAST(sum(fl_relevante) AS BIGINT) AS relevantes FROM {DII} GROUP BY 1, 2, 3")
def _(s, d):
    return table(s, d, DII).groupBy("dataExecucaoModelo", "nme_regional_hospital", "idunidade").agg(F.count("*").alias("linhas"), F.sum("fl_relevante").alias("relevantes"))


@query("agg5_aligned", f"SELECT idunidade, CAST(sum(a) AS BIGINT) AS dii, CAST(sum(b) AS BIGINT) AS neuro FROM (SELECT idunidade, 1 AS a, 0 AS b FROM {DII} UNION ALL SELECT idunidade, 0, 1 FROM {NEURO}) GROUP BY idunidade")
def _(s, d):
    part = lambda t, a, b: table(s, d, t).groupBy("idunidade").agg((F.count("*") * a).alias("a"), (F.count("*") * b).alias("b"))
    return part(DII, 1, 0).unionByName(part(NEURO, 0, 1)).groupBy("idunidade").agg(F.sum("a").alias("dii"), F.sum("b").alias("neuro"))


@query("agg6_last_load", f"SELECT id_unidade, strftime(max(etl_data_atualizacao_carga_gold), '%d/%m/%Y %H:%M') AS ultima FROM {EXAM} GROUP BY id_unidade")
def _(s, d):
    return table(s, d, EXAM).groupBy("id_unidade").agg(F.date_format(F.max("etl_data_atualizacao_carga_gold"), "dd/MM/yyyy HH:mm").alias("ultima"))


@query("agg7_joined_unique", f"WITH f AS (SELECT idunidade, trim(exm_titulo) AS v, min(exm_an) AS o FROM {DII} WHERE length(trim(exm_titulo)) > 0 GROUP BY 1, 2) SELECT idunidade, string_agg(v, ' //-// ' ORDER BY o, v) AS titulos FROM f GROUP BY idunidade")
def _(s, d):
    return rel.joined_unique(table(s, d, DII), ["idunidade"], "exm_titulo", "exm_an", "titulos")


@query("agg8_first_only", "SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(s, d):
    return rel.first_only(table(s, d, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderpriority"]).select("o_orderkey", "o_custkey", "o_orderpriority")


@query("agg9_daily_metrics", f"SELECT dataExecucaoModelo AS dia, count(*) AS linhas, count(DISTINCT id_pct) AS pacientes, CASE WHEN count(*) > 0 THEN round(100.0 * sum(fl_relevante) / count(*), 2) ELSE 0.0 END AS pct_relevante FROM {DII} GROUP BY 1")
def _(s, d):
    g = table(s, d, DII).groupBy(F.col("dataExecucaoModelo").alias("dia")).agg(F.count("*").alias("linhas"), F.countDistinct("id_pct").alias("pacientes"), F.sum("fl_relevante").alias("_r"))
    return g.withColumn("pct_relevante", F.when(F.col("linhas") > 0, F.round(F.lit(100.0) * F.col("_r") / F.col("linhas"), 2)).otherwise(0.0)).drop("_r")


@query("agg10_stratified", f"SELECT dataExecucaoModelo, exm_an FROM (SELECT DISTINCT dataExecucaoModelo, exm_an FROM {COLON}) QUALIFY row_number() OVER (PARTITION BY dataExecucaoModelo ORDER BY md5(exm_an), exm_an) <= 3")
def _(s, d):
    return rel.stratified(table(s, d, COLON).select("dataExecucaoModelo", "exm_an").distinct(), ["dataExecucaoModelo"], ["exm_an"], 3)


@query("agg11_value_counts", f"SELECT pct_sexo, exm_mod, count(*) AS n FROM {NEURO} GROUP BY 1, 2")
def _(s, d):
    return table(s, d, NEURO).groupBy("pct_sexo", "exm_mod").agg(F.count("*").alias("n"))


@query("agg12_keep_first", "SELECT o_custkey, o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1")
def _(s, d):
    return table(s, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("agg13_run_summary", f"SELECT dataExecucaoModelo, count(*) AS linhas, count(DISTINCT CASE WHEN fl_relevante = 1 THEN exm_an END) AS relevantes, min(exm_data) AS primeiro, max(exm_data) AS ultimo FROM {DII} GROUP BY 1")
def _(s, d):
    return table(s, d, DII).groupBy("dataExecucaoModelo").agg(F.count("*").alias("linhas"), F.countDistinct(F.when(F.col("fl_relevante") == 1, F.col("exm_an"))).alias("relevantes"), F.min("exm_data").alias("primeiro"), F.max("exm_data").alias("ultimo"))


# windows


@query("win1_latest_exam", f"SELECT e.id_exame, e.id_unidade, e.dt_dia_exame, e.etl_data_atualizacao_carga_gold AS carga, p.cli_nome FROM (SELECT * FROM {EXAM} QUALIFY row_number() OVER (PARTITION BY id_exame ORDER BY etl_data_atualizacao_carga_gold DESC NULLS LAST) = 1) e LEFT JOIN {_LATEST_PATIENT} p ON p.id_paciente = e.id_patient")
def _(s, d):
    e = table(s, d, EXAM).select("id_exame", "id_unidade", "id_patient", "dt_dia_exame", "etl_data_atualizacao_carga_gold")
    e = rel.latest(e, ["id_exame"], ["etl_data_atualizacao_carga_gold"])
    p = latest_patients(s, d, "cli_nome").select(F.col("id_paciente").alias("id_patient"), "cli_nome")
    return e.join(p, "id_patient", "left").select("id_exame", "id_unidade", "dt_dia_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), "cli_nome")


@query("win2_history", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga FROM {EXAM} QUALIFY row_number() OVER (PARTITION BY id_exame ORDER BY etl_data_atualizacao_carga_gold DESC NULLS LAST) > 1")
def _(s, d):
    return rel.older(table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga")), ["id_exame"], [F.desc_nulls_last("carga")])


_DUP = "PARTITION BY id_pct, exm_data, regexp_replace(exm_laudo_texto, '[^a-zA-Z0-9]', '', 'g') ORDER BY exm_an, dataExecucaoModelo"


@query("win3_duplicate_rank", f"SELECT exm_an, dataExecucaoModelo, row_number() OVER ({_DUP}) AS fl_laudo_duplicado FROM {DII}")
def _(s, d):
    keys = ["id_pct", "exm_data", F.md5(tx.alphanumeric(F.col("exm_laudo_texto")))]
    return rel.rank_within(table(s, d, DII), keys, [F.col("exm_an"), F.col("dataExecucaoModelo")], "fl_laudo_duplicado").select("exm_an", "dataExecucaoModelo", "fl_laudo_duplicado")


@query("win4_flag_first", f"SELECT exm_an, dataExecucaoModelo, CASE WHEN row_number() OVER (PARTITION BY exm_an ORDER BY dataExecucaoModelo, fl_relevante) = 1 THEN 1 ELSE 0 END AS an_duplicado FROM {NEURO}")
def _(s, d):
    return rel.flag_first(table(s, d, NEURO), ["exm_an"], [F.col("dataExecucaoModelo"), F.col("fl_relevante")], "an_duplicado").select("exm_an", "dataExecucaoModelo", "an_duplicado")


@query("win5_report_rank", f"SELECT exm_an, dataExecucaoModelo, row_number() OVER (PARTITION BY dataExecucaoModelo, pct_nome ORDER BY fl_relevante DESC NULLS LAST, exm_data NULLS FIRST, exm_an) AS ordem FROM {DII}")
def _(s, d):
    return rel.rank_within(table(s, d, DII), ["dataExecucaoModelo", "pct_nome"], [F.desc_nulls_last("fl_relevante"), F.asc_nulls_first("exm_data"), F.col("exm_an")]).select("exm_an", "dataExecucaoModelo", "ordem")


_DAILY = "SELECT user_id % 20 AS unidade, CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY ALL"


def daily_events(s, d) -> DataFrame:
    return table(s, d, "events").groupBy((F.col("user_id") % 20).alias("unidade"), F.to_date("ts").alias("dia")).agg(F.count("*").alias("n"))


@query("win6_running_mean", f"SELECT unidade, dia, round(avg(n) OVER (PARTITION BY unidade ORDER BY dia ROWS UNBOUNDED PRECEDING), 6) AS media FROM ({_DAILY})")
def _(s, d):
    return ser.running_mean(daily_events(s, d), ["unidade"], "dia", "n", "media").select("unidade", "dia", F.round("media", 6).alias("media"))


@query("win7_rolling_sum", f"SELECT unidade, dia, CAST(CASE WHEN count(*) OVER w >= 3 THEN sum(n) OVER w END AS BIGINT) AS s3, CAST(sum(n) OVER (PARTITION BY unidade ORDER BY dia ROWS 14 PRECEDING) AS BIGINT) AS s15 FROM ({_DAILY}) WINDOW w AS (PARTITION BY unidade ORDER BY dia ROWS 2 PRECEDING)")
def _(s, d):
    out = ser.rolling_sum(daily_events(s, d), ["unidade"], "dia", "n", 3, "s3", 3)
    return ser.rolling_sum(out, ["unidade"], "dia", "n", 15, "s15").select("unidade", "dia", "s3", "s15")


@query("win8_difference", f"SELECT unidade, dia, n - lag(n) OVER (PARTITION BY unidade ORDER BY dia) AS mudanca FROM ({_DAILY})")
def _(s, d):
    return ser.difference(daily_events(s, d), ["unidade"], "dia", "n", "mudanca").select("unidade", "dia", "mudanca")


_SPIKES = f"WITH a AS (SELECT *, avg(n) OVER (PARTITION BY unidade ORDER BY dia ROWS UNBOUNDED PRECEDING) AS m, (row_number() OVER (PARTITION BY unidade ORDER BY dia) - 1) // 3 AS b FROM ({_DAILY})), h AS (SELECT *, CASE WHEN (n >= m * 1.05 OR m <= 0) AND n - m >= 1 THEN 1 ELSE 0 END AS hi, CASE WHEN (m >= n * 1.05 OR n <= 0) AND m - n >= 1 THEN 1 ELSE 0 END AS lo FROM a) SELECT unidade, dia, n, CASE WHEN count(*) OVER g = 3 AND dia = max(dia) OVER g AND min(hi) OVER g = 1 THEN 'Aumento' WHEN count(*) OVER g = 3 AND dia = max(dia) OVER g AND min(lo) OVER g = 1 THEN 'Queda' ELSE 'Estável' END AS sinalizacao FROM h WINDOW g AS (PARTITION BY unidade, b)"


@query("win9_mon3_spikes", _SPIKES)
def _(s, d):
    return ser.spikes(daily_events(s, d), ["unidade"], "dia", "n", (5, 1), (5, 1)).select("unidade", "dia", "n", "sinalizacao")


# order, limits, sets


@query("srt1_region_order", f"SELECT exm_an, dataExecucaoModelo, row_number() OVER (ORDER BY CASE nme_regional_hospital WHEN 'RJ' THEN 1 WHEN 'SP' THEN 2 WHEN 'PE' THEN 3 ELSE 9 END, exm_an, dataExecucaoModelo, fl_relevante) AS posicao FROM {DII} QUALIFY posicao <= 100")
def _(s, d):
    region = F.when(F.col("nme_regional_hospital") == "RJ", 1).when(F.col("nme_regional_hospital") == "SP", 2).when(F.col("nme_regional_hospital") == "PE", 3).otherwise(9)
    first = table(s, d, DII).select("exm_an", "dataExecucaoModelo", "fl_relevante", region.alias("r")).orderBy("r", "exm_an", "dataExecucaoModelo", "fl_relevante").limit(100)
    return first.select("exm_an", "dataExecucaoModelo", F.row_number().over(Window.orderBy("r", "exm_an", "dataExecucaoModelo", "fl_relevante")).alias("posicao"))


@query("srt2_top_k", "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
def _(s, d):
    return rel.top_k(table(s, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_partkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 3).drop("l_extendedprice")


@query("srt3_most_severe", "SELECT o_custkey, arg_max(o_orderpriority, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 5 WHEN '2' THEN 4 WHEN '3' THEN 3 WHEN '4' THEN 2 ELSE 1 END) AS pior FROM orders GROUP BY o_custkey")
def _(s, d):
    level = F.coalesce(*(F.when(F.substring("o_orderpriority", 1, 1) == k, v) for k, v in {"1": 5, "2": 4, "3": 3, "4": 2}.items()), F.lit(1))
    return table(s, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", level).alias("pior"))


@query("srt4_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("set1_union_all", f"SELECT exm_an, exm_mod, 'dii' AS origem FROM {DII} UNION ALL SELECT exm_an, exm_mod, 'colonoscopia' FROM {COLON}")
def _(s, d):
    part = lambda t, o: table(s, d, t).select("exm_an", "exm_mod", F.lit(o).alias("origem"))
    return part(DII, "dii").unionByName(part(COLON, "colonoscopia"))


@query("set2_concat_missing", f"SELECT exm_an, record_id FROM {DII} UNION ALL SELECT exm_an, NULL FROM {COLON}")
def _(s, d):
    return table(s, d, DII).select("exm_an", "record_id").unionByName(table(s, d, COLON).select("exm_an"), allowMissingColumns=True)


@query("set3_distinct", f"SELECT DISTINCT idunidade, nme_regional_hospital FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("idunidade", "nme_regional_hospital").distinct()


# changes of state: the even orders are the table, those of a later range the changes

_T, _S = "(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 2 = 0)", "(SELECT o_orderkey, 'X' AS o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 100000)"


def _state(s, d) -> tuple[DataFrame, DataFrame]:
    o = table(s, d, "orders")
    t = o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return t, o.filter("o_totalprice > 100000").select("o_orderkey", F.lit("X").alias("o_orderstatus"), "o_orderpriority")


@query("dml1_insert_only", f"SELECT * FROM {_T} UNION ALL SELECT * FROM {_S} s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM {_T})")
def _(s, d):
    return mg.insert_only(*_state(s, d), ["o_orderkey"])


@query("dml2_upsert_subset", f"SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority FROM {_T} t FULL JOIN {_S} s ON t.o_orderkey = s.o_orderkey")
def _(s, d):
    return mg.merge(*_state(s, d), ["o_orderkey"], {"o_orderstatus": F.col("s.o_orderstatus")})


@query("dml3_update_changed", f"SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL AND coalesce(t.o_orderpriority, '') <> coalesce(s.o_orderpriority, '') THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus, t.o_orderpriority FROM {_T} t LEFT JOIN {_S} s ON t.o_orderkey = s.o_orderkey")
def _(s, d):
    changed = F.coalesce(F.col("t.o_orderpriority"), F.lit("")) != F.coalesce(F.col("s.o_orderpriority"), F.lit(""))
    return mg.merge(*_state(s, d), ["o_orderkey"], {"o_orderstatus": F.col("s.o_orderstatus")}, when=changed, insert=False)


@query("dml4_fill_null", f"SELECT t.o_orderkey, t.o_orderstatus, coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority FROM {_T} t LEFT JOIN {_S} s ON t.o_orderkey = s.o_orderkey")
def _(s, d):
    return mg.fill_null(*_state(s, d), ["o_orderkey"], ["o_orderpriority"])


@query("dml5_delete", f"SELECT * FROM {_T} t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM {_S})")
def _(s, d):
    return mg.delete_matched(*_state(s, d), ["o_orderkey"])


@query("dml6_set_flag", f"SELECT t.o_orderkey, s.o_orderkey IS NOT NULL AS enviado FROM {_T} t LEFT JOIN {_S} s ON t.o_orderkey = s.o_orderkey")
def _(s, d):
    t, log = _state(s, d)
    return mg.set_flag(t.select("o_orderkey", F.lit(False).alias("enviado")), log, ["o_orderkey"], "enviado")


@query("dml7_masked", "SELECT event_id, regexp_replace(props, '(\"?(?:ip|user|k)\"?\\s*[:=]\\s*)(\"[^\"]*\"|[^,;}\\s]+)', '\\1[OMITIDO]', 'gi') AS props FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", vl.masked(F.col("props"), ["ip", "user", "k"]).alias("props"))


@query("dml8_pad", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS codigo FROM customer")
def _(s, d):
    return table(s, d, "customer").select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("codigo"))


# contracts and keys


@query("prj1_contract", f"SELECT exm_an AS id_exame, id_pct AS id_paciente, exm_laudo_dataliber AS liberado, idunidade AS unidade FROM {COLON}")
def _(s, d):
    names = {"exm_an": "id_exame", "id_pct": "id_paciente", "exm_laudo_dataliber": "liberado", "idunidade": "unidade"}
    return table(s, d, COLON).select(*names).withColumnsRenamed(names)


@query("prj4_surrogate_id", f"SELECT exm_an, dataExecucaoModelo, sha256(exm_an || '|' || CAST(dataExecucaoModelo AS VARCHAR)) AS id FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", "dataExecucaoModelo", F.sha2(F.concat_ws("|", "exm_an", F.col("dataExecucaoModelo").cast("string")), 256).alias("id"))


@query("prj6_defaults", f"SELECT exm_an, 'neuro' AS origem, coalesce(nme_convenio, 'PARTICULAR') AS convenio, 0 AS enviado FROM {NEURO}")
def _(s, d):
    return table(s, d, NEURO).select("exm_an", F.lit("neuro").alias("origem"), F.coalesce("nme_convenio", F.lit("PARTICULAR")).alias("convenio"), F.lit(0).alias("enviado"))


@query("prj7_republish", f"SELECT exm_an AS an, dataExecucaoModelo AS dia, pct_nome AS nome FROM {DII}")
def _(s, d):
    from laudaria.sources.crypto import AesCodec

    codec = AesCodec("0123456789abcdef")  # an example key
    published = table(s, d, DII).select(F.col("exm_an").alias("an"), F.col("dataExecucaoModelo").alias("dia"), codec.encrypt(F.col("pct_nome")).alias("nome"))
    return published.withColumn("nome", codec.decrypt(F.col("nome")))
