from __future__ import annotations

import random
import zlib

import pytest

from regionpulse.llm import language


@pytest.fixture
def tongues():
    rng = random.Random(4)
    stems = {"aa": ["kal", "mok", "tir", "ska"], "bb": ["élo", "üwe", "nañ", "riß"], "cc": ["и", "жа", "по", "ку"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 3))) for _ in range(n))

    return text


def test_query(spark, tmp_path, tongues):
    rows = [(i, tongues(lang, 12), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 !? ²", "aa"), (None, tongues("bb", 5), None), (203, tongues("cc", 100_000), "cc"), (3, rows[3][1], "aa")]
    spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = language.query(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    for r in out:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in (200, 201, 202):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred == (truth[r.doc_id] or "bb")


def test_far_texts_are_rejected(spark, docs, tongues):
    rows = [(i, tongues("aa", 20)) for i in range(30)]
    model = language.train(docs(rows).select("text", "lang"))
    got = {r.doc_id: r for r in language.identify(docs([*rows, (99, "жжж ццц щщщ")]), model, least=0.5).collect()}
    assert got[99].lang_pred == "und" and got[1].lang_pred == "en" and got[1].shard == "x"


def test_nothing_learned_and_empty(spark, docs):
    model = language.train(docs([]).select("text", "lang"))
    assert [r.lang_pred for r in language.identify(docs([(1, "some words")]), model).collect()] == ["und"]
    assert language.identify(docs([]), model).count() == 0


def test_a_language_of_copies_is_learned(spark, tongues):
    # One text each: a share of the 4,000 rows would draw it with probability 0.21.
    rows = [(tongues("aa", 12), "aa") for _ in range(300)]
    for k in range(12):
        rows += [(f"{tongues('bb', 8)} {chr(0x0EC0 + k)}", f"l{k:02d}")] * 4000
    model = language.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert set(model[1]) == {"aa", *(f"l{k:02d}" for k in range(12))}


def test_the_sample_is_of_different_texts(spark, tongues, monkeypatch):
    def clustered(group):
        return language.pd.DataFrame({"lang": group["lang"].iloc[:1], "centre": [language.np.float32(len(group)).tobytes() + bytes(4 * language.SLOTS - 4)]})

    monkeypatch.setattr(language, "_clustered", clustered)
    rows = [(tongues("aa", 12), "aa") for _ in range(60)]
    rows += [r for r in rows for _ in range(200)]
    _, langs, centres = language.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert langs == ["aa"] and centres[0][0] == len(set(rows)) == 60


def test_more_languages_than_the_sample(spark, tongues):
    rows = [(tongues("cc", 6), f"l{k:02d}") for k in range(20) for _ in range(3)]
    _, langs, _ = language.train(spark.createDataFrame(rows, "text string, lang string"), total=8)
    assert set(langs) == {f"l{k:02d}" for k in range(20)}
