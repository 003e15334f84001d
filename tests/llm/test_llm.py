"""The operators for training data: brute force on small cases, and the defined results for nulls, empty tables, ties and clashing names."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from laudaria.llm import encoding, history, lookalike, mixing, packing, pii, residue, scans, spans

TOKENIZER = Path(packing.TOKENIZER)
needs_tokenizer = pytest.mark.skipif(not TOKENIZER.exists(), reason="no tokenizer files")
WORDS = "lesão nódulo ileíte cólon região difusão extensão atenuação página técnica análise conclusão medindo espessura calibre imagem série sem com de parede distal média órgão".split()


def report(rng: random.Random, n: int = 60) -> str:
    return " ".join(rng.choice(WORDS) if rng.random() < 0.7 else str(rng.randrange(1000)) for _ in range(n))


# p1


@pytest.fixture(scope="module")
def scanned():
    rng = random.Random(1)
    clean = []
    for i in range(120):
        body = [f"{rng.choice(['Fígado', 'Pâncreas', 'Intestino'])} com espessura habitual e calibre de {rng.randrange(99)} mm na região distal", f"sem extensão ao segmento vizinho, medindo {rng.randrange(99)} mm de parede (série {i}).", f"Conteúdo heterogêneo com atenuação média de {rng.randrange(99)} UH."]
        clean.append("TÉCNICA:\n" + body[0] + "\n" + body[1] + "\nCONCLUSÃO:\n" + body[2])
    bad = {
        "h": clean[0].replace("espessura", "espes-\nsura"),
        "c": clean[1].replace("segmento", "se9mento").replace("habitual", "habitua1"),
        "p": "TÉCNICA:\n" + clean[2][9:].replace("\nsem extensão", "\n- 1 -\nsem extensão") + "\n- 2 -",
    }
    return clean, bad


def test_scan_noise_found_and_repaired(spark, scanned):
    clean, bad = scanned
    rows = [(f"ok{i}", t, 1) for i, t in enumerate(clean[3:])] + [(k, t, 2) for k, t in bad.items()] + [("h", bad["h"], 3), ("null", None, 4), ("empty", "", 5), (None, bad["c"], 6)]
    df = spark.createDataFrame(rows, "exm_an string, text string, words int")  # a column of the operator's own names
    noise = scans.Noise(df)
    found = {(r["exm_an"], r["tipo"]) for r in noise.found(df, ["exm_an"]).collect()}
    assert found == {("h", "hifenizacao"), ("c", "caractere"), ("p", "pagina"), (None, "caractere")}
    fixed = {r["exm_an"]: r["repaired"] for r in noise.repair(df, ["exm_an"]).collect()}
    assert "espessura" in fixed["h"] and "segmento" in fixed["c"] and "habitual" in fixed["c"]
    assert "- 1 -" not in fixed["p"] and fixed["null"] is None and fixed["empty"] == "" and fixed["ok5"] == clean[8]


def test_headers_without_page_numbers_and_misreadings_beyond_the_table(spark, scanned):
    clean, _ = scanned
    lines = (clean[0] + "\n" + clean[1] + "\n" + clean[2]).split("\n")
    header = lines[:2] + ["Hospital Campo Belo - Setor de Imagem"] + lines[2:5] + ["Hospital Campo Belo - Setor de Imagem"] + lines[5:]
    rows = [(f"ok{i}", t) for i, t in enumerate(clean[3:])] + [("head", "\n".join(header)), ("pg", clean[4].replace("\nsem extensão", "\nPágina 2 de 5 - Hospital Campo Belo\nsem extensão"))]
    rows += [("h", clean[5].replace("calibre", "calihre")), ("m", clean[6].replace("segmento", "segmemto")), ("ending", clean[7].replace("heterogêneo", "heterogênea")), ("short", clean[8].replace("UH", "U1"))]
    df = spark.createDataFrame(rows, "exm_an string, text string")
    found = {(r["exm_an"], r["tipo"]) for r in scans.Noise(df).found(df, ["exm_an"]).collect()}
    assert found == {("head", "pagina"), ("pg", "pagina"), ("h", "caractere"), ("m", "caractere")}


def test_copies_of_a_scanned_text_hide_no_misread_word(spark, scanned):
    clean, bad = scanned
    rows = [(f"ok{i}", t) for i, t in enumerate(clean[3:])] + [(f"c{i}", bad["c"]) for i in range(60)]
    df = spark.createDataFrame(rows, "exm_an string, text string")
    noise = scans.Noise(df)
    assert {(r["exm_an"], r["tipo"]) for r in noise.found(df, ["exm_an"]).collect()} == {(f"c{i}", "caractere") for i in range(60)}
    fixed = {r["repaired"] for r in noise.repair(df, ["exm_an"]).filter("exm_an like 'c%'").collect()}
    assert fixed == {clean[1]}


def test_scan_noise_of_nothing(spark):
    df = spark.createDataFrame([], "exm_an string, text string")
    assert scans.Noise(df).found(df, ["exm_an"]).count() == 0


def test_boosting_on_held_out_rows():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = scans.boost(x[:400], y[:400])
    assert ((scans.predict(model, x[400:]) > 0.5) == y[400:]).mean() > 0.93


# p2


def test_residue(spark):
    texts = {
        "field": "medindo {{medida}} mm", "blank": "cisto de ____ x ____ cm", "boxes": "( ) sim ( ) não", "angle": "de «VALOR» mm", "filler": "lorem ipsum dolor", "repeat": "texto de teste texto de teste texto de teste",
        "error": "Fígado normal.\n502 Bad Gateway", "script": "É necessário habilitar o JavaScript para ver", "trace": "Traceback (most recent call last):",
        "sign": "Fígado normal.\n____________________\nMédico responsável", "html": "<p>Fígado <b>normal</b></p>", "filled": "( X ) sim ( ) não", "number": "Medida em [14 mm], 20% a 30% no campo", "words": "Acesso negado pelo paciente; teste rápido; erro de sincronismo", "empty": "", "null": None,
    }
    df = spark.createDataFrame([(k, "U1", t) for k, t in texts.items()] + [("field", "U1", texts["field"])], "exm_an string, host string, text string")
    got = {r[0] for r in residue.found(df, ["exm_an"]).collect()}
    assert got == {"field", "blank", "boxes", "angle", "filler", "repeat", "error", "script", "trace"}
    assert residue.mark(df, ["exm_an"]).count() == df.count()
    assert residue.found(df.limit(0), ["exm_an"]).count() == 0


def test_recurrent_weak_lines_are_boilerplate(spark):
    rows = [(str(i), "U1", f"Laudo {i}\nEste portal usa cookies") for i in range(40)] + [("x", "U2", "Aceita cookies?")]
    df = spark.createDataFrame(rows, "exm_an string, host string, text string")
    assert [r[0] for r in residue.found(df, ["exm_an"]).collect()] == ["x"]


@pytest.mark.parametrize("text", ["Clipe metálico a #N/D da lesão.", "Volume de #DIV/0! mL.", "Texto da conclusão haxum testim.", "TÉCNICA:\nTexto da análise opliqua.", "Laudo normal.\nTeste de integração 12"])
def test_values_of_broken_templates_and_filler(text):
    found = residue.Evidence().of(text)
    assert found["strong"] or any(x["sure"] for x in found["lines"])


@pytest.mark.parametrize("text", ["Série # 12 com contraste.", "No texto da análise anterior consta cisto.", "Teste de integração visual normal à beira do leito."])
def test_words_alike_are_no_residue(text):
    found = residue.Evidence().of(text)
    assert not found["strong"] and not found["lines"]


def test_a_footer_of_a_portal_is_no_residue(spark):
    body = "Fígado de dimensões normais, contornos regulares. Vesícula biliar sem cálculos. Baço e pâncreas sem alterações evidentes. Rins tópicos, sem dilatação. Exame {} sem líquido livre."
    footer = "Para ver as imagens habilite o JavaScript no navegador."
    rows = [(f"f{i}", "a", body.format(i) + "\n" + footer) for i in range(40)]
    rows += [(f"b{i}", "a", body.format(i) + "\n502 Bad Gateway") for i in range(12)]  # reports that break off, fewer than half of the host
    rows += [(f"e{i}", "b", "Erro 500\nOcorreu um erro inesperado.") for i in range(40)]  # a host of error pages
    rows += [(f"m{i}", "c", body.format(i) + "\nImpresso por {usuario}") for i in range(40)]  # a placeholder is a case wherever it stands
    df = spark.createDataFrame(rows, "exm_an string, host string, text string")
    got = {r[0] for r in residue.found(df, ["exm_an"]).collect()}
    assert got == {r[0] for r in rows if r[0][0] != "f"}
    marked = {r["exm_an"]: r["kinds"] for r in residue.mark(df, ["exm_an"]).collect()}
    assert marked["f0"] == [] and marked["b0"] == ["erro"] and marked["e0"] == ["erro"] and marked["m0"] == ["modelo"] and len(marked) == len(rows)



# p3


def greedy(rows):
    """The rule as it is stated, one row after another."""
    accepted, seen, case = [], set(), set()
    for date, ident, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        w = history.words_of(text) if text else []
        hit = ident is not None and ident in seen or any(history.within(w, v, int(max(len(w), len(v)) * 0.1 + 1e-9)) for v in accepted if w and v)
        if hit:
            case.add((ident, date))
        else:
            if ident is not None:
                seen.add(ident)
            accepted.append(w)
    return case


def changed(rng, text, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = "trocado"
    return " ".join(w)


@pytest.mark.parametrize("runs_per_batch", [1, 3, 10])
def test_batches_equal_the_sequential_rule(spark, runs_per_batch):
    rng = random.Random(5)
    base = [report(rng, 80) for _ in range(40)]
    rows = []
    for day in range(1, 7):
        for k in range(12):
            b = rng.choice(base)
            text = [b, b.upper(), changed(rng, b, 4), changed(rng, b, 12), report(rng, 80), None, "", changed(rng, b, 8)][rng.randrange(8)]
            rows.append((f"2024-01-{day:02d}", f"{rng.randrange(200):04d}", text))
    rows.append(("2024-01-07", "x1", base[0]))
    seen = set()
    rows = [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]
    df = spark.createDataFrame([(i, d, t, 1) for d, i, t in rows], "exm_an string, d string, t string, node int")
    out = history.replay(df, "exm_an", "d", "t", runs_per_batch=runs_per_batch)
    assert {(r["ident"], str(r["date"])) for r in out.filter("rejected").collect()} == greedy(rows)
    assert out.count() == len(rows)


def test_a_crowded_bucket_goes_by_rounds(spark):
    rng = random.Random(6)
    b = report(rng, 80)
    rows = [("2024-01-01", f"{i:03d}", changed(rng, b, rng.randrange(3))) for i in range(90)]
    df = spark.createDataFrame([(i, d, t) for d, i, t in rows], "exm_an string, d string, t string")
    out = history.ingest(history.History(spark), df, "exm_an", "d", "t", small_bucket=4)
    assert {r["ident"] for r in out.filter("not rejected").collect()} == {"000"}


def test_a_crowded_bucket_of_different_texts_takes_few_rounds(spark, monkeypatch):
    rng = random.Random(9)
    head = [f"m{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(80):
        own = " ".join([*head, *(f"p{rng.randrange(10**6)}" for _ in range(15))])
        rows.append(("2024-01-01", f"{i:03d}", own))
        if i % 8 == 0:
            rows.append(("2024-01-01", f"{(i * 37) % 80:03d}x", changed(rng, own, 3)))
    df = spark.createDataFrame([(i, d, t) for d, i, t in rows], "exm_an string, d string, t string")
    steps, plain = [], history.History.keep
    monkeypatch.setattr(history.History, "keep", lambda self, df, name: steps.append(name) or plain(self, df, name))
    out = history.ingest(history.History(spark), df, "exm_an", "d", "t", small_bucket=4)
    assert {(r["ident"], str(r["date"])) for r in out.filter("rejected").collect()} == greedy(rows)
    assert sum(s.startswith("step-") for s in steps) < 12


@pytest.mark.parametrize("runs_per_batch", [1, 10])
def test_copies_on_both_sides_of_the_short_texts(spark, runs_per_batch):
    rng = random.Random(8)
    rows = []
    for k, n in enumerate([8, 9, 9, 10, 38, 39, 39, 39, 40]):
        words = [f"p{rng.randrange(10**6)}" for _ in range(n)]
        more = [*words[: n // 2], "novo", *words[n // 2 :]]
        for day, w in enumerate((words, more) if k % 2 else (more, words)):
            rows.append((f"2024-01-{1 + day:02d}", f"{k}-{day}", " ".join(w)))
    words = [f"p{rng.randrange(10**6)}" for _ in range(39)]
    rows += [("2024-01-01", "x-0", " ".join(words)), ("2024-01-02", "x-1", " ".join([*words, "a", "b", "c", "d"]))]
    df = spark.createDataFrame([(i, d, t) for d, i, t in rows], "exm_an string, d string, t string")
    out = history.replay(df, "exm_an", "d", "t", runs_per_batch=runs_per_batch)
    got = {(r["ident"], str(r["date"])) for r in out.filter("rejected").collect()}
    assert got == greedy(rows) == {(i, d) for d, i, _ in rows if i.endswith("-1") and i[0] != "0"}


def test_one_record_reads_a_few_per_cent_of_the_history(spark, tmp_path):
    rng = random.Random(12)
    texts = [report(rng, 80) for _ in range(400)]
    index = history.History(spark, str(tmp_path / "index"), per_bucket=8)
    df = spark.createDataFrame([(f"{i:03d}", "2024-01-01", t) for i, t in enumerate(texts)], "i string, d string, t string")
    assert history.ingest(index, df, "i", "d", "t").filter("rejected").count() == 0
    index = history.History(spark, str(tmp_path / "index"), per_bucket=8)  # opened again, as a later job does
    assert index.buckets("keys") == 4096
    one = spark.createDataFrame([("new", "2024-01-02", changed(rng, texts[7], 8))], "i string, d string, t string")
    assert [r["rejected"] for r in history.ingest(index, one, "i", "d", "t").collect()] == [True]
    (keys, all_keys), (met, all_texts) = index.read["keys"], index.read["texts"]
    assert keys <= 66 < 0.02 * all_keys and met < 0.02 * all_texts


def test_merged_parts_hold_what_they_stand_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "FAN", 2)
    rng = random.Random(13)
    index = history.History(spark, str(tmp_path / "index"), per_bucket=64)
    texts = [report(rng, 80) for _ in range(5)]
    for day, t in enumerate(texts):
        history.ingest(index, spark.createDataFrame([(f"{day}", f"2024-01-0{day + 1}", t)], "i string, d string, t string"), "i", "d", "t")
    assert [p["level"] for p in index.parts] == [2, 0]
    index = history.History(spark, str(tmp_path / "index"), per_bucket=64)
    again = spark.createDataFrame([(f"x{k}", "2024-02-01", t) for k, t in enumerate(texts)] + [("3", "2024-02-02", None)], "i string, d string, t string")
    assert history.ingest(index, again, "i", "d", "t").filter("rejected").count() == 6


def test_recall_of_the_keys_at_a_tenth_spread_evenly():
    rng = random.Random(14)
    met = 0
    for k in range(300):
        base = [f"p{rng.randrange(300)}" for _ in range(100)] if k % 2 else [f"p{rng.randrange(10)}" for _ in range(100)]  # half of them repeat themselves
        other = [f"novo{i}" if i % 10 == 5 else w for i, w in enumerate(base)]
        (a, x), (b, y) = history.signed(base), history.signed(other)
        met += bool(set(a) & set(b)) and sum(bin(int(i) & (2**64 - 1) ^ int(j) & (2**64 - 1)).count("1") for i, j in zip(x, y, strict=True)) <= history.APART
    assert met >= 0.985 * 300


def test_history_edges(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", None, "x"), (None, "2024-01-01", None), (None, "2024-01-02", None)], "i string, d string, t string")
    out = {(r["ident"], str(r["date"])): r["rejected"] for r in history.replay(df, "i", "d", "t").collect()}
    assert out == {("a", "None"): True, (None, "2024-01-01"): False, (None, "2024-01-02"): False}
    assert history.replay(df.limit(0), "i", "d", "t").count() == 0


def test_edit_distance_against_the_table():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for most in range(6):
            assert history.within(a, b, most) == (row[-1] <= most)


# p4


def test_one_form(spark):
    rows = {
        "wide": ("ｌｅｓãｏ", "lesão"), "split": ("lesa\u0303o", "lesão"), "zero": ("le\u200bsão", "lesão"), "nbsp": ("a\u00a0b", "a b"), "cyr": ("lеsãо", "lesão"), "greek": ("nοdulο", "nodulo"), "unit": ("3 ㎜", "3 mm"), "bold": ("𝐜𝐨𝐦", "com"),
        "kept": ("18º ± 2 °C, ½ de mm² — “α” ≥ β…", "18º ± 2 °C, ½ de mm² — “α” ≥ β…"), "ru": ("печень", "печень"), "empty": ("", ""), "null": (None, None),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in rows.items()] + [(f"t{i}", " ".join(WORDS) + " nodulo") for i in range(20)], "exm_an string, text string")
    got = {r["exm_an"]: r["uniform"] for r in lookalike.normalize(df, ["exm_an"]).collect()}
    assert {k: got[k] for k in rows} == {k: v[1] for k, v in rows.items()}
    assert {r[0] for r in lookalike.found(df, ["exm_an"]).collect()} == {k for k, v in rows.items() if v[0] != v[1]}
    assert lookalike.found(df.limit(0), ["exm_an"]).count() == 0


# p5


def test_personal_information(spark):
    words = spark.createDataFrame([("Ana Quirosa",), ("Joel Murtosal",), (None,)], "nome string")
    texts = {
        "all": ("Paciente Ana Quirosa, CPF: 123.456.789-00, reside na Rua do Farol, 123, fone (30) 98888-7777, e-mail ana_q@mail.example.", {"NOME", "DOCUMENTO", "ENDERECO", "TELEFONE", "EMAIL"}),
        "low": ("laudo revisado por joel murtosal e liberado.", {"NOME"}),
        "initial": ("Contato com a mãe, J. Murtosal, pelo telefone 30 9 8888 7777.", {"NOME", "TELEFONE"}),
        "mail": ("Enviado a ana (arroba) mail.example hoje.", {"EMAIL"}),
        "clean": ("Hospital Ilha Nova, sala 5, aparelho 87412-6; lote 12-345-678, pedido 8741; TR 85 @ 1,5T; quadra do mapa 12.", set()),
        "none": (None, set()), "empty": ("", set()),
    }
    df = spark.createDataFrame([(k, v[0], 7) for k, v in texts.items()], "exm_an string, text string, kinds int")
    got: dict = {k: set() for k in texts}
    for r in pii.found(df, ["exm_an"], pii.name_words(words, "nome")).collect():
        got[r["exm_an"]].add(r["tipo"])
    assert got == {k: v[1] for k, v in texts.items()}
    markers = spark.createDataFrame([(k, f"[{k}]") for k in pii.KINDS], "tipo string, marcador string")
    clean = {r["exm_an"]: r["clean"] for r in pii.redact(df, ["exm_an"], pii.name_words(words, "nome"), markers).collect()}
    assert clean["low"] == "laudo revisado por [NOME] e liberado." and clean["clean"] == texts["clean"][0] and clean["none"] is None
    assert clean["all"].startswith("Paciente [NOME], CPF: [DOCUMENTO], reside na [ENDERECO], fone [TELEFONE], e-mail [EMAIL]")
    many = {(r["exm_an"], t) for r in pii.scan(df, ["exm_an"], pii.name_words(words, "nome"), None, most_names=1).collect() for t in r["kinds"]}
    assert many == {(k, t) for k, v in texts.items() for t in v[1]}  # the way of many names


def test_names_are_found_alike_with_few_and_many_words(spark):
    names = spark.createDataFrame([("Maria Souza",), ("João Alves",), (None,), ("",)], "nome string")
    texts = ["Exame.\\nMaria Souza sem queixas.", "Paciente Mаria Sоuza em uso de soro.", "Mari\u200ba Souza retornou.", "JOÃO ALVES, lesão de 3 μm.", "Nada a declarar.", None, ""]
    df = spark.createDataFrame([(f"{i}", t) for i, t in enumerate(texts)], "exm_an string, text string")
    for most in (200_000, 1):
        got = {r["exm_an"]: r["kinds"] for r in pii.scan(df, ["exm_an"], pii.name_words(names, "nome"), None, most_names=most).collect()}
        assert got == {"0": ["NOME"], "1": ["NOME"], "2": ["NOME"], "3": ["NOME"], "4": [], "5": [], "6": []}


@pytest.mark.parametrize("more", ["", " Lesão de 3 μm.", " Sem\u200b queixas."])
def test_a_name_after_a_cue_needs_no_plain_text(more):
    text = "Lesão estável." + more + " Revisado por Dr. Zoroastro Quintela em tempo."
    assert [(text[s:e], k) for s, e, k in pii.Finder(set()).spans(text)] == [("Zoroastro Quintela", "NOME")]


def test_numbers_are_found_from_their_signs():
    text = "Ficha 123.456.789-09 e 55 (30) 3916 4028, +55 11 93456-7890; mora na R. das Flores, 120. Série 1234 5678, lote 99.123.456-7."
    assert [(text[s:e], k) for s, e, k in pii.Finder(set()).spans(text)] == [("123.456.789-09", "DOCUMENTO"), ("55 (30) 3916 4028", "TELEFONE"), ("+55 11 93456-7890", "TELEFONE"), ("R. das Flores, 120", "ENDERECO")]



# p6


@pytest.mark.parametrize("written,read", [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("utf-8", "cp850"), ("cp1252", "cp1251")])
def test_wrong_encodings_round_trip(spark, written, read):
    clean = [f"Região com difusão e extensão até {i} mm, atenuação média." for i in range(30)]
    bad = "".join(encoding._read(c.encode(written), read) for c in clean[0])
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(clean[1:])] + [("bad", bad), ("bad", bad), ("q", "Compressão extrínseca? ou até peristalse?"), ("n", None), ("e", "")], "exm_an string, text string")
    assert [r["exm_an"] for r in encoding.affected(df, ["exm_an"]).collect()] == ["bad"]
    out = [r["restored"] for r in encoding.restore(df, ["exm_an"]).filter("exm_an = 'bad'").collect()]
    assert out == [clean[0]] * 2


def test_lost_letters_and_doubled_chains(spark):
    clean = [f"Região com difusão e extensão até {i} mm." for i in range(30)]
    twice = clean[0].encode().decode("cp1252", "replace").encode().decode("cp1252", "replace")
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(clean)] + [("twice", twice), ("mark", "Regi?o com difus?o"), ("sign", "Regi\ufffdo xyz\ufffdq")], "exm_an string, text string")
    assert {r["exm_an"] for r in encoding.affected(df, ["exm_an"]).collect()} == {"twice", "mark", "sign"}
    assert encoding.affected(df.limit(0), ["exm_an"]).count() == 0


def test_rows_without_a_key_are_restored(spark):
    words = "lesão região atenuação difusão extensão técnica".split()
    rows = [(f"k{i}", f"Exame com {words[i % 6]} e {words[(i + 1) % 6]} sem alteração ({i}).") for i in range(30)]
    bad = "Exame com lesÃ£o e regiÃ£o sem alteraÃ§Ã£o (x)."
    rows += [(None, bad), ("same", bad.replace("x", "y")), ("same", "Exame normal."), ("blank", "Medindo ?? mm à direita."), ("blank2", "Desvio à esquerda."), (None, None), ("e", "")]
    df = spark.createDataFrame(rows, "exm_an string, text string")
    out = [(r["exm_an"], r["text"], r["restored"]) for r in encoding.restore(df, ["exm_an"]).collect()]
    assert len(out) == len(rows)
    fixed = {(k, t): x for k, t, x in out}
    assert fixed[None, bad] == "Exame com lesão e região sem alteração (x)." and fixed["same", "Exame normal."] == "Exame normal." and fixed[None, None] is None and fixed["e", ""] == ""
    assert {r["exm_an"] for r in encoding.affected(df, ["exm_an"]).collect()} == {None, "same"}


def test_words_of_many_accents_have_all_their_forms():
    word = "áéíóúâêô"
    assert "Ã¡Ã©íóúâêô" in encoding.garbled(word) and "áéíÃ³úâÃªô" in encoding.garbled(word)
    assert len(encoding.garbled("á" * 12)) > 0


# p7


def brute_best_fit(sizes, capacity, most):
    bins, out = [], []  # (free, number) of open bins
    number = 0
    for s in sizes:
        fits = [b for b in bins if b[0] >= s]
        if fits:
            b = min(fits, key=lambda b: b[0])
            bins.remove(b)
        else:
            if len(bins) >= most:
                bins.remove(min(bins, key=lambda b: b[0]))
            b = (capacity, number)
            number += 1
        out.append(b[1])
        if b[0] > s:
            bins.append((b[0] - s, b[1]))
    return number


def test_best_fit_uses_as_many_bins_as_brute_force():
    rng = random.Random(8)
    for most in (1, 3, 50):
        sizes = [rng.randrange(1, 60) for _ in range(400)]
        packer = packing.BestFit(100, most)
        load: dict = {}
        for s in sizes:
            b = packer.put(s)
            load[b] = load.get(b, 0) + s
        assert packer.n_bins == brute_best_fit(sizes, 100, most) and max(load.values()) <= 100


@needs_tokenizer
def test_pack_keeps_items_whole(spark):
    rng = random.Random(9)
    docs = [(i, report(rng, rng.randrange(5, 400)), 1) for i in range(150)] + [(900, report(rng, 3000), 1), (901, None, 1), (902, "", 1), (None, "sem id", 1), (3, "de novo", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, tokens int")
    sizes = spark.createDataFrame([(1, 512), (2, 1024), (3, None), (4, 0)], "id_recipiente int, capacidade_tokens int")
    out = packing.pack(df, sizes, group_items=60).toPandas()
    assert set(out.id_recipiente) == {1, 2} and 901 not in set(out.doc_id.dropna())
    assert (out.groupby(["id_recipiente", "container"]).tokens.sum() <= out.groupby(["id_recipiente", "container"]).capacidade_tokens.first()).all()
    for (_, cap), part in out.groupby(["id_recipiente", "capacidade_tokens"]):
        total = part.groupby(part.doc_id.fillna(-1)).agg(n=("piece", "size"), t=("tokens", "sum"))
        assert ((total.n == 1) | (total.t > cap) | (total.index == 3)).all()
    assert packing.pack(df.limit(0), sizes).count() == 0 and packing.pack(df, sizes.limit(0)).count() == 0


# p8


@needs_tokenizer
def test_mix_reaches_its_shares(spark):
    rng = random.Random(10)
    docs = [(i, "a" if i % 3 else "b", report(rng, rng.randrange(20, 80))) for i in range(3000)] + [(9001, None, "x"), (9002, "c", "sem peso"), (9003, "a", ""), (9004, "a", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    weights = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 4), ("vazia", 0.2, 2)], "source string, peso double, max_repeticoes int")
    records = mixing.sized(df)
    planned = mixing.plan(records, weights)
    mixed = mixing.mix(records, planned, block_rows=300)
    rep = {r["source"]: r for r in mixing.report(mixed, planned).collect()}
    assert abs(rep["a"]["actual_share"] - 0.375) < 0.01 and abs(rep["b"]["actual_share"] - 0.625) < 0.01 and rep["vazia"]["actual_share"] == 0
    assert rep["a"]["most_copies"] <= 1 and rep["b"]["most_copies"] <= 4
    assert {r["source"] for r in mixed.select("source").distinct().collect()} == {"a", "b"}
    expected = {s: n * e for s, _, _, _, n, _, e in planned}
    got = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum("copies").alias("n")).collect()}
    assert all(abs(got[s] - expected[s]) <= 1 for s in got)
    assert mixing.mix(records, mixing.plan(records.limit(0), weights)).count() == 0


# p9


def brute_shared(docs, n):
    where: dict = {}
    for d, t in docs:
        for s in range(len(t or "") - n + 1):
            where.setdefault(t[s : s + n], set()).add(d)
    out: dict = {}
    for d, t in docs:
        mark = set()
        for s in range(len(t or "") - n + 1):
            if len(where[t[s : s + n]]) > 1:
                mark.update(range(s, s + n))
        out[d] = max(out.get(d, 0), len(mark))
    return out


def test_spans_equal_brute_force(spark):
    rng = random.Random(11)
    shared = [report(rng, 120)[:k] for k in (399, 400, 401, 650)]
    docs = [(i, report(rng, rng.randrange(20, 200))) for i in range(40)]
    docs += [(100 + i, report(rng, 60)[: rng.randrange(200)] + rng.choice(shared) + report(rng, 30)) for i in range(30)]
    docs += [(200, "a" * 900), (201, "b" + "a" * 450), (202, docs[0][1]), (203, docs[0][1] * 3), (204, docs[0][1] * 3), (205, None), (206, ""), (207, "ab" * 400), (208, "ba" * 230), (209, "x" * 33 + " " + shared[1]), (210, "\U0001f600" * 420), (211, "z" + "\U0001f600" * 410)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n int")
    want = brute_shared(docs, 400)
    for rows in (1_000_000, 0):  # broadcast, and the way beyond it
        got = {r["doc_id"]: r["shared_chars"] for r in spans.shared_spans(df, broadcast_rows=rows).collect()}
        assert got == want
    assert spans.shared_spans(df.limit(0)).count() == 0


# all queries run on the smallest tables


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_queries_run(spark):
    from laudaria.llm.queries import QUERIES

    for name, columns in {"p1_found": {"exm_an", "tipo"}, "p2_found": {"tabela", "exm_an"}, "p4_found": {"tabela", "exm_an"}, "p5_found": {"exm_an", "campo", "tipo"}, "p6_found": {"tabela", "exm_an"}, "p9_found": {"doc_id"}, "p3_found": {"exm_an", "data_execucao"}}.items():
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert set(df.columns) == columns and df.count() == df.distinct().count()
