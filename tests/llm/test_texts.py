"""Problems 8, 9 and 10 against brute force and edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimweave.functions.text import text_words
from claimweave.llm import leakage, mixing, truncation

WORDS = "la rueda mostraba desgaste después del viaje con combustible expediente abierto describe una grieta sobre el portón maletero carril verde céntimos franquicia cita día lote pintura procede caduca semanas inspectora anotó grados desviación espesor micras puerta delantera quien revise caso debe citar foto tomada descartar rayón".split()


def sentence(rng, n):
    return " ".join(str(rng.randrange(10, 99999)) if i % 7 == 3 else rng.choice(["Caneril", "Norduca", "Dorpiqui"]) + str(rng.randrange(9)) if i % 9 == 5 else rng.choice(WORDS) for i in range(n))


ITEM = "El expediente 9463 abierto en Olaquidor describe marcas de 6833 micras sobre el paragolpes. Con 3931 lecturas de la puerta en Zancami se obtuvo una holgura de 46160 décimas frente a las 14 admitidas. El lote 3523 procede de Ralujas y caduca a las 40 semanas."


def found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return rows(leakage.find_leaks(d, i).select("item_id", "doc_id"))


def test_quotes_edits_and_decoys(spark):
    words = ITEM.split()
    edited = [w for k, w in enumerate(words) if k % 11 != 4]
    edited[8] = "igualmente"
    edited.insert(15, "tampoco")
    other_figures = ITEM.replace("9463", "1").replace("6833", "2").replace("3931", "3").replace("46160", "4").replace("Olaquidor", "Fefe").replace("Zancami", "Lulu").replace("3523", "9").replace("Ralujas", "Xixi").replace("14", "77").replace("40", "88")
    docs = [
        "Hola. " + ITEM.upper() + " Saludos",
        "x " + " ".join(words[5:21]) + " y",
        "x " + " ".join(words[5:20]) + " y",
        " ".join(edited),
        other_figures,
        "<p>" + ITEM.replace(" ", "&nbsp; ", 9).replace("é", "é") + "</p>",
        "> " + "\n> ".join(ITEM.split(" ")),
        ITEM.encode().decode("latin-1"),
        None,
        "",
        "word " * 30_000 + ITEM,
    ]
    assert found(spark, docs, [(1, ITEM), (2, None), (3, "")]) == {(1, k) for k in (0, 1, 3, 5, 6, 7, 10)}


def test_recall_on_many_edited_items(spark):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(44, 110))) for i in range(60)]
    docs = []
    for _, t in items:
        w = t.split()
        for k in rng.sample(range(len(w)), len(w) // 6):
            w[k] = rng.choice(["quizá", "ahora", "", "otro " + w[k]])
        docs.append(sentence(rng, 40) + " " + " ".join(w) + " " + sentence(rng, 40))
    got = found(spark, docs, items)
    assert len(got & {(i, i) for i in range(60)}) >= 59
    assert all(i == d for i, d in got)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, sentence(random.Random(i), 60)) for i in range(8)]
    docs = [t for _, t in items[:5]]
    whole = found(spark, docs, items)
    monkeypatch.setattr(leakage, "MAX_ITEM_WINDOWS", 400)
    assert found(spark, docs, items) == whole == {(i, i) for i in range(5)}


def test_no_documents_or_items(spark):
    assert found(spark, [], [(1, ITEM)]) == set()
    assert found(spark, [ITEM], []) == set()


def test_alignment_matches_a_plain_table():
    rng = random.Random(4)
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        best = min((_edit(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)), default=len(a))
        edits, kept = leakage.align_inside(np.array(a), np.array(b, dtype="int64"))
        assert edits == best and kept.sum() >= len(a) - edits


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_words_of_a_text():
    assert text_words("<b>Hola</b>, &aacute;mbar\n> «TIPO» rozÃ³ 3.5") == ["hola", "ambar", "tipo", "rozo", "3", "5"]
    assert text_words(None) == text_words("") == []


# --- 9


def highest_quotients(weights, caps, seats):
    got = dict.fromkeys(weights, 0)
    for _ in range(seats):
        open_ones = [n for n in sorted(weights) if got[n] < caps.get(n, 0) and weights[n] > 0]
        if not open_ones:
            break
        n = max(open_ones, key=lambda x: (weights[x] / (2 * got[x] + 1), [-ord(c) for c in x]))
        got[n] += 1
    return got


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.tuples(st.integers(0, 50), st.integers(0, 30)), min_size=1), st.integers(0, 90))
def test_apportionment_is_by_highest_quotients(parties, seats):
    weights = {n: float(w) for n, (w, _) in parties.items()}
    caps = {n: c for n, (_, c) in parties.items()}
    got = mixing.sainte_lague(weights, caps, seats)
    want = highest_quotients(weights, caps, seats)
    assert sum(got.values()) == sum(want.values()) and all(got[n] <= caps[n] for n in got)
    # with ties either seat is right: the quotients given must be the same
    quotients = lambda g: sorted(round(weights[n] / (2 * k + 1), 9) for n in g for k in range(g[n]))
    assert quotients(got) == quotients(want)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    data = [(i, ["big", "mid", "small", "unlisted", None][rng.choices(range(5), (60, 25, 6, 5, 4))[0]], " ".join(rng.choices(WORDS, k=rng.randint(5, 120)))) for i in range(4000)] + [(9001, "big", None), (9002, "big", ""), (None, "big", "hola")]
    return spark.createDataFrame([(*d, 7) for d in data], "doc_id bigint, source string, text string, n_tokens int")


def test_mixture_reaches_its_shares(spark, corpus):
    weights = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.4, 2), ("small", 0.2, 4), ("empty", 0.0, 3)], "source string, target_share double, max_repeats int")
    m = mixing.mix(corpus, weights, block_tokens=256)
    report = {r["source"]: r for r in m.report.collect()}
    for s, share in (("big", 0.4), ("mid", 0.4), ("small", 0.2)):
        assert abs(report[s]["actual_share"] - share) < 0.02
        assert report[s]["most_repeats"] <= report[s]["max_repeats"]
    assert report["empty"]["tokens_mixed"] == 0
    picked = m.documents
    assert picked.select("doc_id").distinct().count() == picked.count()
    assert picked.where("source not in ('big', 'mid', 'small')").count() == 0
    again = mixing.mix(corpus, weights, block_tokens=256).documents
    assert rows(again.select("doc_id", "repeats")) == rows(picked.select("doc_id", "repeats"))


def test_caps_bind_when_the_mix_is_large(spark, corpus):
    weights = spark.createDataFrame([("small", 0.9, 2), ("big", 0.1, None)], "source string, target_share double, max_repeats int")
    m = mixing.mix(corpus, weights, total_tokens=10**7, block_tokens=256)
    for r in m.report.collect():
        assert r["tokens_mixed"] == r["tokens_available"] * (2 if r["source"] == "small" else 1)


def test_long_documents_do_not_shift_the_shares(spark):
    rng = random.Random(3)
    data = [(i, "long", " ".join(rng.choices(WORDS, k=4000))) for i in range(60)] + [(1000 + i, "short", " ".join(rng.choices(WORDS, k=200))) for i in range(1200)]
    df = spark.createDataFrame(data, "doc_id bigint, source string, text string")
    weights = spark.createDataFrame([("long", 0.5, 2), ("short", 0.5, 2)], "source string, target_share double, max_repeats int")
    for size in (200_000, 500_000):
        report = {r["source"]: r for r in mixing.mix(df, weights, total_tokens=size).report.collect()}
        assert all(abs(r["share_error"]) < 0.02 and r["most_repeats"] <= 2 for r in report.values())
        assert abs(sum(r["tokens_mixed"] for r in report.values()) / size - 1) < 0.03
    # within its tokens no document of either source is repeated
    assert mixing.mix(df, weights, total_tokens=200_000).documents.agg(F.max("repeats")).first()[0] == 1


def test_nothing_to_mix(spark, corpus):
    weights = spark.createDataFrame([("big", 1.0, 1)], "source string, target_share double, max_repeats int")
    m = mixing.mix(corpus.limit(0), weights)
    assert m.documents.count() == 0 and m.report.first()["tokens_mixed"] == 0
    assert mixing.mix(corpus, weights.limit(0)).documents.count() == 0


# --- 10

PLAIN = [
    "La pieza llega en {n} días laborables desde el almacén.", "Queda pendiente recibir {n} fotos más de el faro derecho.", "El carril propuesto es verde por un importe de {n} euros.", "La estimación ronda los {n} euros con impuestos incluidos.",
    "Conviene revisar los anclajes antes de montar de nuevo el estribo lateral.", "No se ven daños estructurales, aunque falta comprobar la holgura.", "La imagen a{n}bf está movida y no permite valorar el capó.",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    make = lambda k: " ".join(rng.choice(PLAIN).format(n=rng.randrange(10, 999)) for _ in range(k))
    whole = [make(rng.randint(2, 6)) + rng.choice(["", "", "", " un saludo", " y ya veremos..."]) for _ in range(500)]
    whole += [make(3)[:-1] for _ in range(20)]
    cut = []
    while len(cut) < 120:
        t = make(5)
        at = rng.randrange(60, len(t) - 3)
        piece = t[:at].rstrip()
        rest = t[len(piece) :]
        ends = piece[-1] in ".?" and not piece[-2].isdigit() or rest.startswith(".")
        if not ends:
            cut.append(piece + rng.choice(["", "", "…", "..."]))
    return whole, cut


def test_cuts_are_told_from_whole_texts(spark, texts):
    whole, cut = texts
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(whole + cut)], "doc_id bigint, text string, key string")
    got = {r["doc_id"] for r in truncation.find_truncated(df).where("cut").collect()}
    want = set(range(len(whole), len(whole) + len(cut)))
    assert len(got & want) >= 0.95 * len(want)
    assert len(got - want) <= 3


def test_every_copy_counts_and_blank_texts_do_not(spark, texts):
    whole, cut = texts
    some = [(i, t) for i, t in enumerate(whole)] + [(1000 + i, cut[0]) for i in range(300)] + [(2000, None), (2001, ""), (2002, "  "), (2003, "<p></p>"), (2004, "\n\n"), (None, cut[0])]
    got = {r["doc_id"] for r in truncation.find_truncated(spark.createDataFrame(some, "doc_id bigint, text string")).where("cut").collect()}
    assert {1000 + i for i in range(300)} <= got
    assert not got & {2000, 2001, 2002, 2003, 2004}


def test_a_longer_copy_shows_the_cut():
    body = " ".join(f"palabra{'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)}" for i in range(60))
    full = f"{body} catorce. Fin del texto"
    assert truncation.cut_by_copy(f"{body} cato", full) is True  # inside a word
    assert truncation.cut_by_copy(body, full) is True  # inside a sentence
    assert truncation.cut_by_copy(f"{body} catorce", full) is False
    assert truncation.cut_by_copy("otra cosa muy distinta de todo lo que hay aquí escrito", full) is None
    assert truncation.cut_by_copy(" ".join(full.split()[:40]), full) is True  # a third of it is enough
    words = full.split()
    assert truncation.cut_by_copy(" ".join([*words[:12], "sin", *words[12:40]]), full) is True  # a word added
    assert truncation.cut_by_copy(" ".join([*words[:30], "otra", *words[31:40]]), full) is True  # a word changed
    assert truncation.cut_by_copy(" ".join([*words[20:40], *words[:20]]), full) is None  # ends elsewhere
    assert truncation.cut_by_copy(full, full) is None


def invented(seed, n=4000):
    rng = random.Random(seed)
    return rng, ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(n)]


def copies(spark, data):
    df = spark.createDataFrame([(k, truncation._SEP.join(truncation.written_tokens(t))) for k, t in data], "key bigint, tokens string")
    return {r["key"]: r["cut"] for r in truncation.copy_verdicts(df).collect()}


@pytest.mark.parametrize("block", [24, 1])
def test_near_copies_at_any_length_kept(spark, monkeypatch, block):
    monkeypatch.setattr(truncation, "BLOCK", block)
    rng, vocabulary = invented(1)
    full = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 240))) + "." for _ in range(60)]
    cut = []
    for share in (0.9, 0.7, 0.5):
        for t in full:
            words = t[: int(len(t) * share)].split()
            for k in rng.sample(range(len(words) - 1), len(words) // 40):
                words[k] = rng.choice(vocabulary)
            cut.append(" ".join(words))
    got = copies(spark, [*enumerate(full), *((1000 + i, t) for i, t in enumerate(cut))])
    assert not any(v for k, v in got.items() if k < 1000)
    for i in range(3):
        found = sum(bool(got.get(1000 + 60 * i + k)) for k in range(60))
        assert found >= 56, (i, found)


def test_crowded_beginnings(spark):
    # one template sentence under all texts; each has one whole copy, and longer relatives that only begin like it
    rng, vocabulary = invented(5)
    shared = rng.choices(vocabulary, k=20)
    full = [f"{' '.join(shared)} {' '.join(rng.choices(vocabulary, k=60))} {word} final." for word in vocabulary[:40]]
    cut = [" ".join(t.split()[:n]) for t, n in zip(full, [24, 30, 40, 60] * 10, strict=True)]
    longest = [f"{' '.join(shared)} {' '.join(rng.choices(vocabulary, k=300))}." for _ in range(60)]
    got = copies(spark, [*enumerate(full), *((100 + i, t) for i, t in enumerate(cut)), *((900 + i, t) for i, t in enumerate(longest))])
    assert {k for k, v in got.items() if v} == {100 + i for i in range(40)}


def test_crowds_of_one_text_give_every_verdict(spark, monkeypatch):
    # versions of one text, each alike to any other and different in an early word: all bands are crowded
    rng, vocabulary = invented(6)
    body = rng.choices(vocabulary, k=140)
    full = [" ".join([f"{vocabulary[i]}", *body, vocabulary[100 + i], "fin"]) + "." for i in range(40)]
    cut = [" ".join([f"{vocabulary[200 + i]}", *body[: 132 + i % 6]]) for i in range(40)]
    monkeypatch.setattr(truncation, "SLICE", 7)
    got = copies(spark, [*enumerate(full), *((100 + i, t) for i, t in enumerate(cut))])
    assert {k for k, v in got.items() if v} == {100 + i for i in range(40)}


def test_prefix_filter_meets_all_that_hold_enough(spark):
    rng, vocabulary = invented(7, 300)
    data = [(i, truncation._SEP.join(rng.choices(vocabulary, k=rng.randint(10, 40)))) for i in range(40)]
    data += [(100 + i, truncation._SEP.join([*t.split(truncation._SEP)[: 8 + i % 9], "x"])) for i, t in data[:40]]
    df = spark.createDataFrame(data, "key bigint, tokens string")
    met = {tuple(r) for r in truncation._crowded_pairs(df, df.select("key")).collect()}
    texts = {k: truncation.asked_and_held(t) for k, t in data}
    hold = {(a, b) for a in texts for b in texts if a != b and len(texts[a][0]) and len(np.intersect1d(texts[a][0], texts[b][1])) >= 0.8 * len(texts[a][0])}
    written = {k: truncation.Written(t) for k, t in data}
    assert hold == {(a, b) for a in texts for b in texts if a != b and written[a].asked and written[b].holds(written[a].asked)}
    assert {(100 + i, i) for i in range(40)} <= hold <= met


def test_copies_that_contradict_each_other_decide_nothing(spark):
    rng, vocabulary = invented(9)
    words = rng.choices(vocabulary, k=40)
    text = " ".join(words)
    assert copies(spark, [(1, text), (2, text + " sigue."), (3, text + ". Otro.")]).get(1) is None
    assert copies(spark, [(1, text), (2, text + " sigue.")])[1] is True


def test_markup_does_not_make_a_cut_text_the_longer_one(spark):
    rng, vocabulary = invented(9)
    words = rng.choices(vocabulary, k=80)
    cut = "".join(f"<span>{w}</span> " for w in words[:75])
    assert copies(spark, [(1, " ".join(words) + "."), (2, cut)]) == {2: True}


def test_very_long_texts(spark, texts):
    whole, _ = texts
    long = "\n".join(whole * 12)
    data = [(i, t) for i, t in enumerate(whole[:200])] + [(900, long + "\nLa pieza llega en 12 días labora"), (901, long), (902, "x" * 300_000)]
    got = {r["doc_id"] for r in truncation.find_truncated(spark.createDataFrame(data, "doc_id bigint, text string")).where("cut").collect()}
    assert 900 in got and not got & {901, 902}


def test_no_documents(spark):
    assert truncation.find_truncated(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_report_and_queries_run(spark, sf_dir):
    from claimweave.llm import plans

    report = plans.p10_report(spark, sf_dir).collect()
    assert report and all(0 <= r["share_cut"] <= 1 for r in report)
    assert plans.p8_found(spark, sf_dir).where(F.col("item_id").isNull()).count() == 0


def test_what_verdicts_were_made_from_is_deleted_before_the_next(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("claimweave.operators.staging.stage_root", lambda spark: f"file://{tmp_path}")
    said, kept = truncation.stage, {}

    def watched(df, tag):
        kept[tag] = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
        return said(df, tag)

    monkeypatch.setattr(truncation, "stage", watched)
    whole = "Esta es una frase bastante larga que sigue hasta el final sin parar nunca de contar cosas."
    df = spark.createDataFrame([(1, whole), (2, whole[:70]), (3, "Otra frase.")], "doc_id bigint, text string")
    assert truncation.find_truncated(df).count() == 3
    assert kept["bands"] == {"texts", "closing"} and kept["copy"] == {"texts", "closing", "copy-pairs"}
