"""Codewords, decoding, held-out accuracy, odd rows."""

import numpy as np
import pytest

from freight.llm import language
from freight.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 4, 6, 30, 1500])
def test_codewords_tell_languages_apart(n):
    code = language.codewords(n)
    assert len({tuple(row) for row in code.tolist()}) == n
    if n > 2:
        distance = (code[:, None] != code[None]).sum(axis=2)
        assert distance[~np.eye(n, dtype=bool)].min() >= 2


def test_features_of_pieces_equal_the_whole(monkeypatch):
    text = "Häuser und die 12 Straßen, ok " * 50
    whole = language.features(text)
    monkeypatch.setattr(language, "POINTS_AT_ONCE", 17)
    assert np.allclose(language.features(text), whole)
    assert language.features("12 !") is None and language.features(None) is None


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_language"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == truth.count()


def test_odd_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 6)]
    rows += [(None, None, "en"), (3, "", None), (3, "12 ?!", "de"), (4, "x" * 300_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as Label", "2 as key", "3 as LANGUAGE")
    model = language.train(frame)
    assert model.languages == ["de", "en"]
    found = language.identify(frame, model).collect()
    assert len(found) == len(rows)
    by_text = {r.text: r.language for r in found}
    assert by_text["the cat and the dog"].lang_pred == "en" and by_text["der hund und die katze"].lang_pred == "de"
    assert by_text[None].lang_pred == by_text[""].lang_pred == by_text["12 ?!"].lang_pred == "und"
    nothing = language.train(frame.limit(0))
    assert {r.language.lang_pred for r in language.identify(frame, nothing).collect()} == {"und"}
    assert language.identify(frame.limit(0), model).count() == 0


def test_decoding_equals_a_plain_version():
    rng = np.random.default_rng(3)
    code = language.codewords(7)
    bits = code.shape[1]
    model = language.Model([str(i) for i in range(7)], code, rng.normal(size=(1 << language.BINS_LOG2, bits)), rng.normal(size=bits), rng.random(code.shape))
    vectors = rng.random((20, 1 << language.BINS_LOG2)) / 64
    best, share = model.decode(vectors)
    for vector, found, score in zip(vectors, best, share, strict=True):
        margins = [sum(vector * model.weights[:, b]) + model.bias[b] for b in range(bits)]
        losses = [sum(model.trust[c, b] * np.log1p(np.exp(-margins[b] * code[c, b])) for b in range(bits)) for c in range(7)]
        assert found == int(np.argmin(losses))
        assert np.isclose(score, np.exp(-min(losses)) / sum(np.exp(-x) for x in losses))


def test_a_text_with_a_third_of_the_rows_counts_once(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").where("lang is not null and text is not null").select("text", "lang")
    first = documents.orderBy("text").limit(1)
    copies = first.crossJoin(spark.range(documents.count() // 2)).select("text", "lang")
    plain, hot = language.train(documents), language.train(documents.unionByName(copies))
    assert plain.languages == hot.languages
    assert np.array_equal(plain.weights, hot.weights) and np.array_equal(plain.trust, hot.trust)


def test_fitting_in_pieces_equals_the_whole(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = language.train(documents)
    monkeypatch.setattr(language, "VECTORS_AT_ONCE", 17)
    pieces = language.train(documents)
    assert np.allclose(whole.weights, pieces.weights, atol=1e-3) and np.allclose(whole.trust, pieces.trust, atol=0.05)


def test_slices_do_not_change_the_sample(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sliced = language.train(documents, rows=60)
    monkeypatch.setattr(language, "SLICES", 1)
    assert np.array_equal(sliced.weights, language.train(documents, rows=60).weights)


def test_1500_languages(spark):
    spelled = lambda i: "".join(chr(0x4E00 + (i * 7919 + j * 104729) % 20000) for j in range(12))
    rows = [(i, spelled(i), f"l{i:04}") for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    assert len(model.languages) == 1500
    found = language.identify(frame, model).collect()
    assert np.mean([r.lang == r.language.lang_pred for r in found]) > 0.95
