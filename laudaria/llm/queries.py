"""Queries of the training-data operators, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laudaria.llm import encoding, history, lookalike, mixing, packing, pii, residue, scans, spans
from laudaria.runtime import table

DII = "tb_diamond_mod_dii_saida"
NEURO = "tb_diamond_mod_neuroimunologia_saida"
COLON = "tb_diamond_mod_dii_colonoscopia_saida"


def _texts(spark: SparkSession, sf_dir: str, tables: list[str], field: str = "exm_laudo_texto") -> DataFrame:
    """``tabela, exm_an, text`` of one field of several tables."""
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("tabela"), "exm_an", F.col(field).alias("text")) for t in tables]
    return reduce(DataFrame.unionByName, parts)


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, DII).select("exm_an", F.col("exm_laudo_texto").alias("text"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _scanned(spark, sf_dir)
    return scans.Noise(texts).found(texts, ["exm_an"]).filter("exm_an is not null")


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _scanned(spark, sf_dir)
    return scans.Noise(texts).repair(texts, ["exm_an"]).select("exm_an", "repaired")


def _hosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("tabela"), "exm_an", F.col("idunidade").alias("host"), F.col("exm_laudo_texto").alias("text")) for t in (DII, NEURO, COLON)]
    return reduce(DataFrame.unionByName, parts)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.found(_hosted(spark, sf_dir), ["tabela", "exm_an"]).filter("exm_an is not null")


def p2_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.mark(_hosted(spark, sf_dir), ["tabela", "exm_an"]).select("tabela", "exm_an", F.array_join("kinds", ",").alias("motivos"), (F.size("kinds") == 0).alias("fica"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, COLON).select("exm_an", "dataExecucaoModelo", "exm_laudo_texto")
    judged = history.replay(reports, "exm_an", "dataExecucaoModelo", "exm_laudo_texto")
    return judged.filter("rejected").select(F.col("ident").alias("exm_an"), F.date_format("date", "yyyy-MM-dd").alias("data_execucao"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, treated = _texts(spark, sf_dir, [NEURO]), _texts(spark, sf_dir, [COLON], "exm_laudo_texto_tratado")
    trigrams = lookalike.model(report.unionByName(treated))
    other = encoding.affected(report, ["tabela", "exm_an"]).select("tabela", "exm_an")
    first = lookalike.found(report, ["tabela", "exm_an"], trigrams=trigrams).join(other, ["tabela", "exm_an"], "left_anti")
    return first.unionByName(lookalike.found(treated, ["tabela", "exm_an"], trigrams=trigrams)).filter("exm_an is not null")


def p4_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir, [NEURO]).unionByName(_texts(spark, sf_dir, [COLON], "exm_laudo_texto_tratado"))
    return lookalike.normalize(texts, ["tabela", "exm_an"]).select("tabela", "exm_an", "uniform")


def _both_fields(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    reports = table(spark, sf_dir, NEURO)
    fields = [reports.select("exm_an", F.lit(f).alias("campo"), F.col(f).alias("text")) for f in ("exm_laudo_texto", "exm_laudo_texto_tratado")]
    return fields[0].unionByName(fields[1]), pii.name_words(reports, "pct_nome")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(*_keyed(*_both_fields(spark, sf_dir))).filter("exm_an is not null")


def _keyed(texts: DataFrame, words: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    return texts, ["exm_an", "campo"], words


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(*_keyed(*_both_fields(spark, sf_dir)), table(spark, sf_dir, "marcadores_pii")).select("exm_an", "campo", F.array_join("kinds", ",").alias("tipos"), F.col("clean").alias("texto"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.affected(_texts(spark, sf_dir, [NEURO, COLON]), ["tabela", "exm_an"]).select("tabela", "exm_an").filter("exm_an is not null")


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.restore(_texts(spark, sf_dir, [NEURO, COLON]), ["tabela", "exm_an"]).select("tabela", "exm_an", "restored", "left_over")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "recipientes"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(p7_packed(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple]]:
    records = mixing.sized(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    planned = mixing.plan(records, table(spark, sf_dir, "pesos_fontes"))
    return mixing.mix(records, planned), planned


def p8_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0].withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(*_mixed(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_shared(spark, sf_dir).filter("shared_chars > 0").select("doc_id")


def p9_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_repaired": p1_repaired,
    "p2_found": p2_found,
    "p2_marked": p2_marked,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_uniform": p4_uniform,
    "p5_found": p5_found,
    "p5_redacted": p5_redacted,
    "p6_found": p6_found,
    "p6_restored": p6_restored,
    "p7_packed": p7_packed,
    "p7_fill": p7_fill,
    "p8_mixed": p8_mixed,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_shared": p9_shared,
}

#: Nothing here can be said in SQL over whole tables; tests/llm holds each against brute force.
ORACLE: dict[str, str] = {}
