"""Queries of sources and sinks: each writes a whole table in the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from laudaria.plans.q_relational import DII, EXAM, NEURO
from laudaria.plans.registry import query
from laudaria.runtime import ensure_checkpoint_dir, table
from laudaria.sources import readers, sinks


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


@query("src2_src4_lexicon", "SELECT r_name AS classe, n_name AS base, CAST(CASE WHEN length(n_name) > 6 THEN 2 ELSE 1 END AS BIGINT) AS variantes, 'diz \"' || n_name || '\", sim' AS primeira FROM nation JOIN region ON r_regionkey = n_regionkey")
def _(s, d):
    named = table(s, d, "nation").join(table(s, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    said = F.concat(F.lit('diz "'), "n_name", F.lit('", sim'))
    named.select("r_name", "n_name", said, F.when(F.length("n_name") > 6, F.concat("n_name", F.lit("\nem duas linhas")))).write.option("escape", '"').csv(path := scratch(s, "lexico"))
    return readers.lexicon(s, path).select("classe", "base", F.size("variantes").cast("long").alias("variantes"), F.get("variantes", 0).alias("primeira"))


@query("src3_mapping", "SELECT CAST(s_suppkey AS VARCHAR) AS codigo, s_name AS nome FROM supplier")
def _(s, d):
    table(s, d, "supplier").select(F.col("s_suppkey").alias("codigo"), F.col("s_name").alias("nome")).write.option("escape", '"').csv(path := scratch(s, "de-para"), header=True)
    return readers.mapping(s, path).select("codigo", "nome")


@query("src5_settings", "SELECT unidade, unidades, formato FROM unidades_config WHERE enabled")
def _(s, d):
    units = table(s, d, "unidades_config")  # a fixed few rows
    units.agg(F.to_json(F.collect_list(F.struct("unidade", "unidades", "enabled", "formato")), {"pretty": "true"}).alias("value")).write.text(path := scratch(s, "config"))
    return readers.settings(s, path).select("unidade", "unidades", "formato")


@query("src6_src7_returned", f"SELECT exm_an, nullif(trim(exm_status), '') AS situacao, CAST(fl_relevante AS VARCHAR) AS relevante, CAST(NULL AS VARCHAR) AS parecer, true AS de_arquivo FROM {NEURO}")
def _(s, d):
    sheet = table(s, d, NEURO).select(F.col("exm_an").alias("Exame "), F.coalesce("exm_status", F.lit("nan")).alias("Status"), F.col("fl_relevante").alias("Relevante"))
    sheet.write.option("escape", '"').csv(path := scratch(s, "retorno"), header=True)
    back = readers.returned(s, [path], {"Exame": "exm_an", "Status": "situacao", "Relevante": "relevante", "Parecer": "parecer"})
    return back.select("exm_an", F.trim("situacao").alias("situacao"), "relevante", "parecer", F.col("arquivo").isNotNull().alias("de_arquivo"))


@query("snk1_append", f"SELECT dataExecucaoModelo, count(*) AS linhas, count(CASE WHEN fl_relevante = 1 THEN 'novo' END) AS marcadas FROM {DII} GROUP BY dataExecucaoModelo")
def _(s, d):
    t = table(s, d, DII).select("exm_an", "dataExecucaoModelo", "fl_relevante")
    path, wanted = scratch(s, "saida"), F.coalesce(F.col("fl_relevante") == 1, F.lit(False))
    sinks.append(t.filter(~wanted).drop("fl_relevante"), path, "dataExecucaoModelo")
    sinks.append(t.filter(wanted).drop("fl_relevante").withColumn("marca", F.lit("novo")), path, "dataExecucaoModelo")  # a column more
    return sinks.read_merged(s, path).groupBy("dataExecucaoModelo").agg(F.count("*").alias("linhas"), F.count("marca").alias("marcadas"))


@query("snk4_overwrite_run", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_totalprice END AS valor FROM orders")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("valor"), "o_orderstatus")
    path, again = scratch(s, "pedidos"), o.filter("o_orderstatus = 'O'").withColumn("valor", F.lit(0.0))
    sinks.overwrite_run(o, path, ["o_orderstatus"])
    for _ in range(2):  # running twice changes nothing
        sinks.overwrite_run(again, path, ["o_orderstatus"])
    return s.read.parquet(path).select("o_orderkey", "o_orderstatus", "valor")


@query("snk7_export", f"SELECT 'todas' AS pedido, count(*) AS linhas FROM {NEURO} UNION ALL SELECT min(idunidade), count(*) FROM {NEURO} WHERE idunidade = (SELECT min(idunidade) FROM {NEURO})")
def _(s, d):
    t = table(s, d, NEURO).select("exm_an", "idunidade")
    first, out = t.agg(F.min("idunidade")).first()[0], None
    for wanted in ("todas", first):
        sinks.single_file(sinks.of_unit(t, "idunidade", wanted), path := scratch(s, "envio"), "parquet")
        part = s.read.parquet(path).agg(F.count("*").alias("linhas")).select(F.lit(wanted).alias("pedido"), "linhas")
        out = part if out is None else out.unionByName(part)
    return out


@query("mnt1_compact", f"SELECT id_exame, etl_data_atualizacao_carga_gold AS carga, id_unidade FROM {EXAM}")
def _(s, d):
    before, after = scratch(s, "feed"), scratch(s, "feed-compacto")
    table(s, d, EXAM).select("id_exame", F.col("etl_data_atualizacao_carga_gold").alias("carga"), "id_unidade").write.parquet(before)
    sinks.compact(s, before, after, 2)
    return s.read.parquet(after)
