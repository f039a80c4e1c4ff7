"""Bounds that hold for each class, exact medians, and stretches of like size."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skymetrics.llm import language_id, mixing, quality_classifier, quality_rules
from tests.llm.helpers import prose, table


@pytest.mark.parametrize("weights", ["0.1 + (id % 10 > 0) * 1.0", "0.1 + (id % 1000) / 1000", "exp((id % 61) - 30)"])
def test_stretches_are_of_like_size_for_any_weights(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "STRETCH", 500)
    rows = spark.range(200_000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'a', 'b') as source",
        f"cast({weights.replace('(id % 10 > 0)', 'if(id % 10 > 0, 1, 0)')} as double) as weight",
    )
    keyed = rows.withColumn("key", -F.ln(mixing.drawn(F.col("doc_id").cast("string"))) / F.col("weight"))
    joined = keyed.join(mixing._expected(rows), F.col("source") == F.col("name"))
    sizes = joined.groupBy("source", mixing._stretch(F.col("key")).alias("stretch")).count().toPandas()["count"]
    assert len(sizes) > 350 and sizes.max() <= 2 * sizes.median()


def test_rows_without_ids_are_spread(spark):
    docs = table(spark, [(None, f"text {i}", "en", "s", 1) for i in range(300)] + [(None, None, "en", "s", 1)], False)
    out = mixing.mix(mixing.sized(docs)).select("sample_key").distinct().count()
    assert out == 301


def test_a_rare_language_is_learnt(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_DOCUMENTS", 30)
    rng = random.Random(8)
    data = [(i, prose(rng, "en", 30), "en", "s", 1) for i in range(900)]
    data += [(1000 + i, prose(rng, "de", 30), "de", "s", 1) for i in range(12)]
    out = language_id.predict(table(spark, data, False)).collect()
    rare = [r for r in out if r.doc_id >= 1000]
    assert Counter(r.lang_pred for r in rare) == {"de": 12}
    assert sum(r.lang_pred == "en" for r in out) == 900


def by_hand(text, docs):
    """Scores of the languages of a text, from dictionaries, as the method says."""
    words_of = lambda t: language_id._LETTERS.findall(t.lower())
    langs = sorted({d[1] for d in docs}, key=lambda n: (-sum(d[1] == n for d in docs), n))
    words = {n: Counter(w for t, lang in docs if lang == n for w in words_of(t)) for n in langs}
    seen = set().union(*words.values())

    def shares(key, tables, keys, prior):
        return np.array([np.log((tables[n][key] + prior) / (sum(tables[n].values()) + prior * len(keys))) for n in langs])

    grams = {}
    for size in range(1, 6):
        grams[size] = {n: Counter() for n in langs}
        for n in langs:
            for w, c in words[n].items():
                for g in language_id._grams(w, size):
                    grams[size][n][g] += c
    total, found = np.zeros(len(langs)), words_of(text)
    for w in found:
        if w in seen:
            total += shares(w, words, seen, 0.1)
            continue
        for size in range(5, 0, -1):
            keys = set().union(*grams[size].values())
            known = [g for g in language_id._grams(w, size) if g in keys]
            if known:
                total += np.mean([shares(g, grams[size], keys, 0.5) for g in known], 0)
                break
    prior = np.log([sum(d[1] == n for d in docs) / len(docs) for n in langs])
    evidence = total / np.sqrt(len(found)) + 1e-3 * prior
    share = np.exp(evidence - evidence.max())
    return langs[int(evidence.argmax())], share.max() / share.sum()


def test_language_scores_equal_brute_force(spark):
    rng = random.Random(9)
    data = [(i, prose(rng, ("en", "de", "fr")[i % 3], 25), ("en", "de", "fr")[i % 3], "s", 1) for i in range(60)]
    out = {r.doc_id: r for r in language_id.predict(table(spark, data)).collect()}
    learnt = [(d[1], d[2]) for d in data if not out[d[0]].held_out]
    for d in data[:30]:
        lang, score = by_hand(d[1], learnt)
        assert out[d[0]].lang_pred == lang and out[d[0]].score == pytest.approx(score, abs=1e-9)


def test_a_rare_label_is_learnt(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "TRAIN_DOCUMENTS", 40)
    rng = random.Random(10)
    data, labels = [], []
    for i in range(600):
        bad = i % 50 == 1
        text = "\n".join(["BUY!! NOW!! $$$ ***"] * 12) if bad else prose(rng, "en", 60)
        data.append((i, text, "en", "s", 1))
        labels.append((i, int(not bad), 0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(table(spark, data, False), marks).collect()
    assert {r.predicted for r in out if r.doc_id % 50 == 1} == {0}
    assert {r.predicted for r in out if r.doc_id % 50 != 1} == {1}


@pytest.mark.parametrize("bins", [1, 7, 1_000_000])
def test_medians_are_exact(spark, monkeypatch, bins):
    monkeypatch.setattr(quality_rules, "BINS", bins)
    rng = np.random.default_rng(3)
    values = {"a": rng.random(30_001), "b": rng.random(20_000) ** 4, "c": np.repeat(0.25, 9), "d": np.array([0.9]),
              "e": np.repeat([0.1, 0.5], [50, 50])}
    rows = [(name, float(v)) for name, of in values.items() for v in of] + [("a", None), ("f", None)]
    df = spark.createDataFrame(rows, "language string, d double")
    got = {r.language: r.half for r in quality_rules.medians(df, "d", "half").collect()}
    assert got == {name: sorted(of.tolist())[(len(of) + 1) // 2 - 1] for name, of in values.items()}
