import random
import re
import zlib

import pytest

from strata.llm.langid import fit, identify, predict
from strata.llm.toxicity import toxicity

SF = "/root/testdata/sf0.1"


def crc(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify(docs, 1000).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(lang) and all(r.held_out == (crc(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_edge_rows(spark, documents, none):
    rows = [(r.doc_id, r.lang_pred, r.score) for r in identify(documents).collect()]
    assert len(rows) == 8 and all(p == "und" and s == 0 for d, p, s in rows if d in (2, 3, 6, 7))
    assert all(p in ("en", "fr") for d, p, _ in rows if d in (1, 5, None))
    assert identify(none).count() == 0
    unknown = identify(documents.withColumn("lang", documents.source.substr(9, 1)).where("doc_id = 2"))
    assert [r.lang_pred for r in unknown.collect()] == ["und"]


def test_lang_is_no_input_of_a_prediction(spark):
    docs = spark.createDataFrame([(k, t, l) for k, (t, l) in enumerate([("la casa y el perro grande", "es"), ("the house and the big dog", "en")] * 30)], "doc_id long, text string, lang string")
    model = fit(docs, 100)
    told = predict(spark.createDataFrame([(1, "the big house", "es"), (2, "el perro y la casa", "en")], "doc_id long, text string, lang string"), model)
    assert [r.lang_pred for r in told.orderBy("doc_id").collect()] == ["en", "es"]


def auc(pairs):
    order = sorted(pairs)
    ranks = {}
    for k, (s, _) in enumerate(order):
        ranks.setdefault(s, []).append(k + 1)
    ones = [sum(ranks[s]) / len(ranks[s]) for s, y in pairs if y]
    return (sum(ones) - len(ones) * (len(ones) + 1) / 2) / (len(ones) * (len(pairs) - len(ones)))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(rows) == docs.count() and all(r.held_out == (crc(d, 4) == 2) for d, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows.values())
    held = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    assert auc(held) >= 0.93


def test_unseen_misspellings(spark):
    rng = random.Random(2)
    clean = ["garden", "letter", "window", "morning", "paper", "river", "music", "table", "summer"]
    docs, labels = [], []
    for k in range(600):
        words = [rng.choice(clean) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(5, 60))]
        if k % 4 == 0:
            words[rng.randrange(len(words))] = "zorgle" + "".join(rng.choice("abcdefghij") for _ in range(3))
        docs.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    docs += [(1000, "river music zorglexyz table"), (1001, "river music tables letter"), (1002, "Zorglevw")]
    rows = {r.doc_id: r.score for r in toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert rows[1000] > 0.3 > rows[1001] and rows[1002] > 0.3


def test_toxicity_of_edge_rows(spark, documents, none):
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 1), (3, 0, 1), (None, 1, 0), (5, None, 0), (5, 0, 0), (5, 0, 0), (7, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity(documents, labels).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id in (2, 3, 6)}) == 1
    assert toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity(documents, labels.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("size", [1, 400_000])
def test_long_texts(spark, size):
    docs = spark.createDataFrame([(1, "word " * size, "en"), (4, "mot " * size, "fr"), (8, "w" * size, "en"), (9, "m" * size, "fr")], "doc_id long, text string, lang string")
    assert len(identify(docs).collect()) == 4
    assert len(toxicity(docs, spark.createDataFrame([(k, k % 2) for k in range(1, 10)], "doc_id long, toxic int")).collect()) == 4


def test_every_language_is_learned(spark):
    """600 languages of one word each, in fewer feature buckets."""
    words = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(600)]
    rows = [(4 * k + c, f"{w * 3} {w}{w}", w) for k, w in enumerate(words) for c in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs, 3000)
    assert len(model.languages) == 600 and (1 << model.bits) * 600 <= 1 << 24
    told = predict(docs.where("doc_id % 4 = 0"), model).collect()
    assert len({r.lang_pred for r in told}) > 500


def test_samples_are_bounded(spark, monkeypatch):
    """An id that comes 20,000 times, in one text or in many, is not gathered whole."""
    import pandas as pd
    gathered = []
    whole = pd.DataFrame.sort_values

    def sort_values(self, *args, **kwargs):
        gathered.append(len(self))
        return whole(self, *args, **kwargs)

    monkeypatch.setattr(pd.DataFrame, "sort_values", sort_values)
    docs = spark.sql("SELECT 1L AS doc_id, 'the big dog' AS text, 'en' AS lang FROM range(20000) UNION ALL "
                     "SELECT 2L, concat('el perro ', id), 'es' FROM range(20000) UNION ALL SELECT id + 10, 'le chien', 'fr' FROM range(200)")
    fit(docs, 100)
    labels = spark.sql("SELECT id AS doc_id, CAST(id % 2 AS int) AS toxic FROM range(300)")
    toxicity(docs, labels, 100)
    assert len(gathered) == 2 and all(0 < n <= 250 for n in gathered)


def test_repeated_deliveries_train_a_model(spark):
    docs = spark.sql("SELECT k AS doc_id, IF(k % 2 = 0, 'la casa y el perro', 'the house and the dog') AS text, IF(k % 2 = 0, 'es', 'en') AS lang "
                     "FROM (SELECT id % 40 AS k FROM range(20000))")
    told = predict(docs.distinct(), fit(docs, 40)).collect()
    assert all(r.lang_pred == r.lang for r in told)


def test_scores_against_each_text_alone(spark):
    """The scorer over words against the model's own arrays, text by text."""
    import numpy as np

    from strata.llm import langid, subwords
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 400")
    model = langid.fit(docs, 200)
    for r in predict(docs, model).collect():
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", r.text or "") if w]
        if not words or r.lang_pred == "und":
            continue
        grams, _ = subwords.word_grams(words, langid.LEAST, langid.MOST, model.bits)
        buckets, times = np.unique(grams, return_counts=True)
        at, x = model.features(buckets, times)
        p = langid.softmax(x @ model.weights(at) / model.temperature)
        assert model.languages[int(p.argmax())] == r.lang_pred and abs(p.max() - r.score) < 1e-6


def test_one_ftrl_step_by_hand():
    import numpy as np

    from strata.llm.langid import Model
    model = Model(["a", "b"], np.ones(1024))
    model.learn(np.array([3]), np.array([2]), 0)
    g = 30.0 * (0.5 - 1)  # feature 30 (its whole text) times p - 1
    assert np.allclose(model.z[3], [g, -g]) and np.allclose(model.n[3], [g * g, g * g])
    w = -(g - np.sign(g) * model.l1) / ((model.beta + abs(g)) / model.alpha + model.l2)
    assert np.allclose(model.weights(np.array([3]))[0], [w, -w])
