"""Small cases of the core operators, nulls and ties included."""

from __future__ import annotations

from pyspark.sql import functions as F

from laudaria.functions import report as rp
from laudaria.functions import text as tx
from laudaria.functions import values as vl
from laudaria.operators import clinical as cl
from laudaria.operators import evaluation as ev
from laudaria.operators import merge as mg
from laudaria.operators import relational as rel
from laudaria.operators import series as ser


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in cols.items())) if cols else spark.range(1)
    return df.select(expr).first()[0]


def test_latest_takes_newest_and_settles_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, None, "n"), ("b", None, "q")], "k string, t int, v string")
    assert sorted(map(tuple, rel.latest(df, ["k"], ["t"]).collect()), key=str) == [("a", 2, "z"), ("b", None, "q"), (None, None, "n")]
    assert rel.latest(df.limit(0), ["k"], ["t"]).count() == 0


def test_not_in_is_three_valued(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert [r[0] for r in rel.not_in(a, spark.createDataFrame([(1,)], "k int"), "k").collect()] == [2]
    assert rel.not_in(a, spark.createDataFrame([(1,), (None,)], "k int"), "k").count() == 0
    assert rel.not_in(a, spark.createDataFrame([], "k int"), "k").count() == 3


def test_incremental_insert_twice_adds_nothing(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    once = mg.insert_only(spark.createDataFrame([(1, "old")], "k int, v string"), src, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "old"), (2, "b")]
    assert sorted(map(tuple, mg.insert_only(once, src, ["k"]).collect())) == [(1, "old"), (2, "b")]


def test_merge_conditions(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, v string, n int")
    s = spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, None, 3)], "k int, v string, n int")
    out = mg.merge(t, s, ["k"], {"v": F.col("s.v")}, when=F.col("t.n").isNull(), insert_when=F.col("s.v").isNotNull())
    assert sorted(map(tuple, out.collect())) == [(1, "A", None), (2, "b", 5)]
    assert sorted(map(tuple, mg.fill_null(t, s, ["k"], ["n"]).collect())) == [(1, "a", 1), (2, "b", 5)]
    assert mg.merge(t, s, ["k"], delete_when=F.col("s.n") == 2, insert=False).count() == 1


def test_replaced_partitions_beyond_the_broadcast(spark):
    old = spark.range(12_000).selectExpr("cast(id as string) as k", "'old' as v")
    out = mg.replace_partitions(old, old.withColumn("v", F.lit("new")), ["k"])
    assert [tuple(r) for r in out.groupBy("v").count().collect()] == [("new", 12_000)]
    some = spark.createDataFrame([("a", "old"), (None, "old"), ("b", "old")], "k string, v string")
    for most in (10, 1):
        got = mg.replace_partitions(some, spark.createDataFrame([(None, "new"), ("b", "new")], "k string, v string"), ["k"], most)
        assert sorted(map(tuple, got.collect()), key=str) == [("a", "old"), ("b", "new"), (None, "new")]


def test_spikes_three_days_not_two(spark):
    rows = [("u", f"2024-01-{i + 1:02d}", v) for i, v in enumerate([10, 10, 10, 40, 50, 60, 10, 10, 10, 60, 60])]
    df = spark.createDataFrame(rows, "u string, d string, n int").withColumn("d", F.to_date("d"))
    marks = {r["d"].day for r in ser.spikes(df, ["u"], "d", "n", (50, 9), (1000, 99)).filter("sinalizacao = 'Aumento'").collect()}
    assert marks == {6}


def test_inactivity(spark):
    df = spark.createDataFrame([("u", f"2024-01-{i:02d}", 5) for i in range(1, 8)] + [("v", "2024-01-10", 1)], "u string, d string, n int").withColumn("d", F.to_date("d"))
    out = ser.inactivity(df, "u", "d", "n", "2024-01-01", "2024-01-10", least=10)
    assert {(r["u"], r["d"].day) for r in out.collect()} == {("u", 10)}


def test_clearance_guards(spark):
    v = lambda cr, age, fem: one(spark, vl.clearance(F.col("c"), F.col("a"), F.col("f") == "F"), c=cr, a=age, f=fem)
    assert v(0.0, 50, "F") == -2.0
    assert spark.range(1).select(vl.clearance(F.lit(1.0), F.lit(None).cast("int"), F.lit(True))).first()[0] == -2.0
    assert abs(v(1.0, 50, "F") - 142 * (1 / 0.7) ** -1.2 * 0.9938**50 * 1.012) < 1e-9


def test_ages_at_month_ends_and_of_nulls(spark):
    import datetime

    from laudaria.plans import catalog

    days = [datetime.date(y, m, x) for y, m, x in ((2000, 2, 28), (2000, 2, 29), (2000, 3, 31), (2001, 1, 31), (2003, 2, 28), (2003, 4, 30), (2004, 2, 28), (2004, 2, 29), (2005, 3, 30), (2005, 3, 31))]
    pairs = [(b, e) for b in [*days, None] for e in days if b is None or b <= e]

    def years(b, e):
        last = all((x + datetime.timedelta(1)).day == 1 for x in (b, e))
        return e.year - b.year - ((e.month, e.day) < (b.month, b.day) and not (b.month == e.month and last))

    df = spark.createDataFrame(pairs, "b date, e date")
    got = df.select("b", "e", vl.age_by_months(F.col("b"), F.col("e")), vl.age_by_days(F.col("b"), F.col("e"))).collect()
    assert {tuple(r) for r in got} == {(b, e, years(b, e) if b else None, int((e - b).days / 365.25) if b else None) for b, e in pairs}
    d = "/root/testdata/sf0.001"
    assert catalog.QUERIES["dat1_dat2_age_whole"](spark, d).count() == spark.read.parquet(f"{d}/tb_diamond_mod_dii_saida.parquet").count()


def test_rounding_before_range(spark):
    assert one(spark, vl.in_range(F.col("x"), 0.1, 60), x=0.4) is False
    assert one(spark, vl.in_range(F.col("x"), 0.1, 60), x=59.7) is True


def test_markup(spark):
    assert rp.html_to_text("<p>T&Eacute;CNICA:<br>A  b</p><script>x</script>") == "TÉCNICA:\nA b"
    assert rp.rtf_to_text(r"{\rtf1{\fonttbl{\f0 Arial;}}\pard T\'c9CNICA\par a\u231?ao}") == "TÉCNICA\naçao"
    assert one(spark, rp.format_of(F.col("t")), t="{\\rtf1 x}") == "rtf"
    assert one(spark, rp.real_breaks(F.col("t")), t="a\\nb\r\nc") == "a\nb\nc"


def test_scan_repairs_of_the_pipeline(spark):
    assert one(spark, rp.spaced_capitals(F.col("t")), t="C O N C L U S A O: x") == "CONCLUSAO: x"
    assert one(spark, rp.digit_prefix(F.col("t")), t="6reto com 10mg e 5mm") == "reto com 10mg e 5mm"
    assert one(spark, rp.split_accents(F.col("t")), t="avalia ção") == "avaliação"


def test_sections_and_blocks(spark):
    t = "TITULO\nTÉCNICA: cortes\nfinos\nANÁLISE:\nileo normal\nsem mais\ncolon normal"
    secs = spark.createDataFrame([(t,)], "t string").select(rp.sections(F.col("t"))).first()[0]
    assert [(x["title"], x["body"]) for x in secs] == [(None, "TITULO"), ("tecnica", "cortes\nfinos"), ("analise", "ileo normal\nsem mais\ncolon normal")]
    b = one(spark, rp.blocks(F.col("t"), "ileo|colon"), t=t)
    assert b[1:] == ["ileo normal\nsem mais", "colon normal"]
    assert one(spark, rp.before_section(F.col("t"), "análise:"), t="a\nANÁLISE: b") in ("a\nANÁLISE: b", "a\n")


def test_negation_windows(spark):
    lex = cl.Lexicon(findings={"n": ["nodulo"]}, before=7, after=7)
    neg = lambda t: [h["negated"] for h in one(spark, cl.find_in_sentences(F.col("t"), lex), t=t)]
    assert neg("sem a b c d e f nodulo") == [True]
    assert neg("sem a b c d e f g nodulo") == [False]
    assert neg("nodulo a b c d e f sem") == [True]
    assert neg("aspecto semelhante ao nodulo") == [False]
    assert neg("sem alteracoes.\nnodulo presente") == [False]
    strict = one(spark, cl.hits(rp.words(F.col("t")), cl.Lexicon(findings={"n": ["nodulo"]}, before=3, after=3), True), t="sem nodulo")
    assert [h["negated"] for h in strict] == [False]


def test_near_against_brute_force(spark):
    import random
    import re

    from laudaria.plans import catalog

    def near(text, finding, organ, reach):
        t = text.lower().translate(str.maketrans(tx.MARKED.lower(), tx.PLAIN.lower()))
        at = lambda p: [m.start() for m in re.finditer(f"(?={re.escape(p)})", t)]
        return any(min(abs(f - o), abs(f - o - len(organ))) <= reach for f in at(finding) for o in at(organ))

    rng = random.Random(4)
    texts = ["", "Íleo", "estenose", "Estenose\nno íleo", "ileoileo.estenose"]
    texts += ["ileo" + "x" * n + "estenose" for n in (199, 200, 201)] + ["estenose" + "\n" * n + "íleo" for n in (191, 192, 193)]
    texts += ["".join(rng.choice(["Íleo", "estenose", "\n", "ã" * rng.randrange(260), "a.b", "aa"]) for _ in range(rng.randrange(8))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for f, o, reach in (("estenose", "ileo", 200), ("aa", "a.b", 3), ("aaa", "ileo", 0)):
        got = df.select("t", cl.near(F.col("t"), f, o, reach).alias("n")).collect()
        assert [r["n"] for r in got if r["t"] is not None] == [near(t, f, o, reach) for t in texts]
        assert [r["n"] for r in got if r["t"] is None] == [None]

    d = "/root/testdata/sf0.001"
    reports = spark.read.parquet(f"{d}/tb_diamond_mod_dii_saida.parquet").filter("exm_laudo_texto is not null").collect()
    want = sorted((r["exm_an"] or "", str(r["dataExecucaoModelo"]), near(r["exm_laudo_texto"], "estenose", "ileo", 200)) for r in reports)
    assert sorted((r["exm_an"] or "", str(r["dataExecucaoModelo"]), r["perto"]) for r in catalog.QUERIES["eng7_near"](spark, d).collect()) == want


def test_seeds_of_every_label(spark, tmp_path):
    from laudaria.plans import catalog

    rows = [(3, "a", [1.0, 0.0]), (7, "a", [0.9, 0.1]), (9, "b", [0.0, 1.0]), (51, "b", [0.1, 0.9])]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    out = catalog.QUERIES["eng5_semantic_expand"](spark, str(tmp_path))
    assert {r["seed"] for r in out.collect()} == {"grupo a", "grupo b"}


def test_category(spark):
    v = lambda t: one(spark, cl.category(F.col("t")), t=t)
    assert v("Conclusão: BI-RADS 4") == 4
    assert v("impressao birads iv hoje") == 4
    assert v("BI-RADS nao informado") == 0
    assert v("mamas normais") == -1
    assert v("BI-RADS 9 e 2") == -1
    assert v("categoria 2 e depois BI-RADS 5") == 5
    assert v("BI-RADS a b 3") == 0


def test_measures(spark):
    v = lambda t: one(spark, cl.largest_measure(F.col("t")), t=t)
    assert v("nódulo de 7 x 9 mm") == 9.0
    assert v("nódulo de 0,7 cm") == 7.0
    assert v("nódulo de 7 mm (exame anterior 20 mm)") == 7.0
    assert v("nódulo") is None


def test_context_rule(spark):
    v = lambda t: one(spark, cl.context_positive(F.col("t"), ["lesao"], ["sem"], ["confirmado"], ["historia"], 70), t=t)
    assert v("presenca de lesao nova.") is True
    assert v("sem " + "x" * 60 + " lesao nova.") is False
    assert v("sem " + "x" * 75 + " lesao nova.") is True
    assert v("historia de lesao previa.") is False
    assert v("sem lesao aqui. quadro confirmado hoje.") is True


def test_ladder_last_rule_wins(spark):
    assert one(spark, cl.ladder([(F.col("x") > 1, "a"), (F.col("x") > 2, "b")], "z"), x=3) == "b"
    assert one(spark, cl.ladder([(F.col("x") > 1, "a"), (F.col("x") > 2, "b")], "z"), x=0) == "z"


def test_text_functions(spark):
    assert one(spark, tx.norm(F.col("t")), t="  ÁRea   Ç ") == "area c"
    assert one(spark, tx.stem(F.col("t")), t="lesoes") == "lesao"
    assert one(spark, tx.decimal(F.col("t")), t="Inferior a 0,5") == 0.5
    assert one(spark, tx.decimal(F.col("t")), t="ver nota") is None
    assert one(spark, tx.find_terms(F.col("t"), ["lesao"]), t="Lesão e semilesao") == ["Lesão"]


def test_evaluation(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, None)], "p int, a int")
    m = ev.metrics(ev.confusion(df, F.col("p") == 1, F.col("a") == 1)).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"], m["precisao"], m["kappa"]) == (1, 1, 1, 1, 0.5, 0.0)
    assert ev.mcnemar(0, 0) == (0.0, 1.0) and ev.mcnemar(10, 2)[1] < 0.05


def test_streaming_dedup(spark, tmp_path):
    from laudaria.streaming.ingest import first_per_key, run_once

    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 02:00:00")], "k string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
    run_once(first_per_key(stream, ["k"], "t"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sources_and_sinks(spark, tmp_path):
    from laudaria.sources import readers as rd
    from laudaria.sources import sinks as sk

    (tmp_path / "lex.csv").write_text('achado,nodulo,"nódulo, novo",\nachado,cisto,,\n')
    assert [(r[1], r[2]) for r in rd.lexicon(spark, str(tmp_path / "lex.csv")).collect()] == [("nodulo", ["nódulo, novo"]), ("cisto", [])]
    (tmp_path / "ret.csv").write_text("Nome,Extra\nAna,nan\n")
    row = rd.returned(spark, [str(tmp_path / "ret.csv")], {"Nome": "nome", "Extra": "extra", "Falta": "falta"}).first()
    assert (row["nome"], row["extra"], row["falta"], row["arquivo"]) == ("Ana", None, None, "ret.csv")
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "v int, d string")
    path = str(tmp_path / "t")
    sk.overwrite_run(df, path, ["d"])
    sk.overwrite_run(spark.createDataFrame([(9, "d2")], "v int, d string"), path, ["d"])
    assert sorted((r["v"], r["d"]) for r in sk.read_merged(spark, path).collect()) == [(1, "d1"), (9, "d2")]
    (tmp_path / "u.json").write_text('[{"unidade": "U1", "enabled": true}, {"unidade": "U2", "enabled": false}]')
    assert rd.settings(spark, str(tmp_path / "u.json")).count() == 1
