import random

import numpy as np
from cases import ROWS, documents, ids
from pyspark.sql import functions as F

from topicflow.llm import langid, quality


def _labelled(spark):
    r = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "river", "stone"]
    docs, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        text = " ".join(r.choice(words) for _ in range(r.randint(20, 60)))
        docs.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split())))
        labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        labels + [(5, 0), (5, 1), (None, 1), (7, None), (8, 9)], "doc_id long, quality int"), dict(labels)


def test_quality_held_out_accuracy_and_edges(spark):
    docs, labels, truth = _labelled(spark)
    model = quality.fit(spark, docs, labels, F.col("doc_id") % 2 == 0)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    held = [i for i in truth if i % 2]
    assert np.mean([(got[i] >= 0.5) == truth[i] for i in held]) > 0.95
    rows = quality.score(documents(spark), model).collect()
    assert ids(rows) == ids(documents(spark).collect()) and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[1] == by[2] and by[3] == by[4] and len(by[7]) == 1
    kept = quality.good(documents(spark), model, 0.0)
    assert kept.columns == documents(spark).columns and kept.count() == len(ROWS)
    assert quality.good(documents(spark), model, 1.1).count() == 0
    assert quality.score(documents(spark).limit(0), model).count() == 0


def test_quality_without_both_classes(spark):
    docs, labels, _ = _labelled(spark)
    assert quality.fit(spark, docs, labels.where("quality = 1 and doc_id % 3 = 1"), F.lit(True)) is None
    assert {r.score for r in quality.score(documents(spark), None).collect()} == {0.5}


SYLLABLES = {"en": ["the", "ing", "tion", "wh", "ou"], "de": ["sch", "ung", "ein", "ver", "tz"], "fr": ["eau", "oux", "ç", "que", "é"], "es": ["ción", "ñ", "ado", "ie", "os"]}


def _speech(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language_held_out_accuracy_and_edges(spark):
    r = random.Random(3)
    rows = [(i, _speech(r, lang, r.randint(5, 40)), lang) for i, lang in enumerate(list(SYLLABLES) * 80)]
    docs = spark.createDataFrame(rows + [(999, "...", "xx"), (1000, None, "xx"), (1001, "words", None)], "doc_id long, text string, lang string")
    model = langid.fit(spark, docs, F.col("doc_id") % 3 > 0)
    assert model.languages == ["de", "en", "es", "fr"] and len(model.pairs) == 2
    got = {x.doc_id: x for x in langid.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if i % 3 == 0]) > 0.97
    assert got[999].lang_pred == got[1000].lang_pred == "und" and got[999].score == 0
    out = langid.predict(documents(spark), model).collect()
    assert ids(out) == ids(documents(spark).collect()) and all(0 <= x.score <= 1 for x in out)
    assert {x.lang_pred for x in out if x.doc_id in (3, 4, 5)} == {"und"}
    kept = langid.determined(documents(spark), model, 0.0)
    assert kept.columns == documents(spark).columns and kept.count() == sum(langid.has_letter(t) for _, t, *_ in ROWS)
    assert langid.predict(documents(spark).limit(0), model).count() == 0


def test_texts_scored_together_score_as_alone():
    r = random.Random(4)
    rows = [(lang, langid.features(_speech(r, lang, 30))) for lang in list(SYLLABLES) * 20]
    model = langid.fit_rows([a for a, _ in rows], np.stack([x for _, x in rows]))
    texts = ["", "a", None] + [_speech(r, lang, 9) for lang in SYLLABLES]
    together = langid.margins(model, texts)
    for k, t in enumerate(texts):
        assert np.allclose(together[k], langid.margins(model, [t])[0], atol=1e-6)
        if k > 2:
            assert np.allclose(together[k], langid.features(t) @ model.weights + model.bias, atol=1e-3)


def test_without_languages(spark):
    assert langid.fit(spark, documents(spark).where("lang is null"), F.lit(True)) is None
    assert {x.lang_pred for x in langid.predict(documents(spark), None).collect()} == {"und"}


def test_language_sample_is_bounded(spark, monkeypatch):
    """The lowest hashes of each of the most frequent languages, counted
    exactly however many documents there are."""
    seen = []
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    monkeypatch.setattr(langid, "fit_rows", lambda langs, x: seen.append(sorted(langs)))
    r = random.Random(5)
    rows = [(i, _speech(r, lang, 3), lang) for i, lang in enumerate(["en"] * 900 + ["de"] * 30 + ["fr"] * 5)]
    docs = spark.createDataFrame(rows + [(1, "again", "en")], "doc_id long, text string, lang string")
    langid.fit(spark, docs, F.lit(True), max_per_language=20)
    langid.fit(spark, docs.repartition(7), F.lit(True), max_per_language=50)
    assert seen == [["de"] * 20 + ["en"] * 20, ["de"] * 30 + ["en"] * 50]
