import zlib

import numpy as np
import pytest

from quillspan.llm import language as module
from quillspan.llm.language import BITS, bits_for, document_frequencies, fit, fit_temperature, identify, language, with_language
from quillspan.llm.features import char_ngrams, has_letter, word_hashes


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language(docs).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert with_language(docs).count() >= 0.97 * docs.count()


def test_document_frequencies(spark):
    docs = spark.createDataFrame([("abc ab",), ("ab",), (None,), ("",)], "text string")
    df, n = document_frequencies(docs.repartition(3))
    assert n == 4
    want = np.zeros(1 << BITS, int)
    for t in ("abc ab", "ab"):
        want[np.unique(char_ngrams(t, BITS))] += 1
    assert (df == want).all()


def test_odd_rows(odd_docs, no_docs):
    rows = language(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 9)} == {"und"}
    assert language(no_docs).count() == 0
    assert with_language(odd_docs).columns == odd_docs.columns
    assert with_language(no_docs).count() == 0


def test_features():
    assert has_letter("1 2 é") and not has_letter("12 !") and not has_letter(None)
    assert (word_hashes("The cat, the cat") == word_hashes("the  CAT the9cat")).all()
    assert len(np.unique(word_hashes("a b a"))) == 2
    long = "ab " * 50_000
    assert len(np.unique(word_hashes(long))) == 1 and len(word_hashes(long)) == 50_000
    assert len(word_hashes("x" * 70_000)) == 2


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3)) * 2
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert abs(fit_temperature(z * 4, y) - 4) < 0.5


def test_predictions_by_brute_force(spark):
    """Each row's language and score are those of a plain product over the whole text's n-grams, one text at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit(docs)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in identify(docs, model).collect():
        x = np.zeros(len(model.idf))
        for g in char_ngrams(texts[r.doc_id], BITS).tolist():
            x[g] += 1
        x = np.log1p(x) * model.idf
        z = ((x / np.sqrt((x * x).sum())) @ model.weights + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.languages[int(p.argmax())] and abs(r.score - p.max()) < 1e-9


def test_all_languages_are_learned(spark, monkeypatch):
    """Many languages get fewer n-grams instead of going unlearned; too many are an error."""
    assert bits_for(1) == bits_for(128) == BITS and bits_for(129) == 15 and bits_for(32_768) == 8
    with pytest.raises(ValueError):
        bits_for(32_769)
    monkeypatch.setattr(module, "MOST_WEIGHTS", 1 << 17)
    rows = [(i, " ".join([chr(97 + i % 20) * 3 + chr(97 + i % 20 // 2)] * 9), f"l{i % 20}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs)
    assert len(model.languages) == 20 and len(model.idf) == 1 << 12
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in identify(docs, model).collect()]) > 0.95
