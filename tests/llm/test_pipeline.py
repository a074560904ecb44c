"""The pipeline on a small table, stage by stage, and the registration."""

import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import docs


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_keep_clean_documents(spark, tmp_path):
    words = [f"wort{k}" for k in range(200)]
    clean = "Ein sauberer Text ohne Wiederholung."
    texts = [clean, " ".join(words), " ".join(words) + " ", " ".join(words[:199] + ["ende"]), "12 34", None,
             "vorher " + " ".join(words[:80]) + " nachher ganz anders " + " ".join(f"neu{k}" for k in range(200))]
    df = docs(spark, texts, lang="de")
    for name, stage in corpus_pipeline.STAGES:
        df.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        before = df.columns
        df = stage(spark, df, str(tmp_path))
        if name != "packing":
            assert df.columns == before
        rows = {r.doc_id: r for r in df.collect()}
        if name == "language":
            assert set(rows) == {0, 1, 2, 3, 6}
        elif name == "exact":
            assert set(rows) == {0, 2, 3, 6}  # the longer of two equal texts stays
        elif name == "near":
            assert set(rows) == {0, 2, 6}
        elif name == "substring":
            assert rows[0].text == clean and rows[2].text == texts[2]
            assert rows[6].text.split()[:2] == ["vorher", "nachher"] and rows[6].n_chars == len(rows[6].text)
    assert set(rows) == {0, 2, 6}


FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni "
          "postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej deklaracji",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on "
          "toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в "
          "отношении друг друга в духе братства. Каждый человек должен обладать всеми правами и всеми свободами, провозглашенными здесь "
          "без какого бы то ни было различия",
    "random": " ".join("".join(np.random.default_rng(k).choice(list("abcdefghijklmnopqrstuvwxyz"), 3 + k % 6)) for k in range(80))}


@pytest.mark.parametrize("languages", [["de"], ["de", "en"], ["de", "en", "es", "fr"]])
def test_language_stage_rejects_what_fits_no_learned_language(spark, languages):
    base = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang").isin(languages))
    texts = {n: [r.text for r in base.where((F.col("lang") == n) & F.col("text").rlike("(?s)^.{1500}")).orderBy("doc_id").limit(6).collect()]
             for n in languages}
    other = spark.read.parquet(f"{SF_MID}/documents.parquet").where("lang = 'en' and length(text) > 1500").orderBy("doc_id").first().text
    both = [a[:700] + " " + b[:700] for n, m in zip(languages, [*languages[1:], languages[0]]) for a, b in zip(texts[n][:3], texts[m][3:])]
    both.append(texts["de"][0][:700] + " " + other[:700])  # half of it is in a learned language
    all_in_one = " ".join(texts[n][0][:300] for n in languages)
    stay = [*sum(texts.values(), []), *both, all_in_one, "krótki tekst"]
    planted = docs(spark, [*stay, *FOREIGN.values()], range(10**6, 10**6 + len(stay) + len(FOREIGN)), lang=None)
    table = base.select("doc_id", "text", "lang", "source", "n_chars").unionByName(planted.select("doc_id", "text", "lang", "source", "n_chars"))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, table, "").select("doc_id").collect()}
    assert {10**6 + k for k in range(len(stay))} <= kept
    assert not {10**6 + len(stay) + k for k in range(len(FOREIGN))} & kept
    clean = {r.doc_id for r in base.where("text rlike '[a-z]'").select("doc_id").collect()}
    assert len(clean - kept) <= 0.01 * len(clean)


def test_language_limits_loosen_with_fewer_letters():
    from marketlens.llm.langid import SURE, Known

    model = Known(["a"], np.zeros((1, 1), np.int32), np.array([-7.0]), np.array([-8.25]))
    least = [min(v for v in np.arange(-30, 0, 0.01) if model.accepts(0, v, n)) for n in (1, 10, 100, SURE, 10_000)]
    assert least == sorted(least) and least[-1] == pytest.approx(-8.26, abs=0.02) and least[1] > -14  # ten strange letters are rejected
    assert Known(["a"], np.zeros((1, 1), np.int32), np.zeros(1), np.array([-np.inf])).accepts(0, -99.0, 500)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and all(r.offset + r.length <= 4096 for r in rows)


def test_empty(spark):
    df = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, "")
    assert df.collect() == []
