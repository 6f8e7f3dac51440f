"""Language labels: the chain against sums over all paths, held-out accuracy, odd texts."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeflow.llm import langid
from tapeflow.llm.words import Hasher, lower_az

SF = "/root/testdata/sf0.01"


def by_all_paths(emission, step, start):
    """Marginals and expected transitions of one chain, from every path's weight."""
    places, languages = emission.shape
    marginal, moved, total = np.zeros((places, languages)), np.zeros((languages, languages)), 0.0
    for path in itertools.product(range(languages), repeat=places):
        weight = start[path[0]] + sum(emission[t, k] for t, k in enumerate(path))
        weight = np.exp(weight + sum(step[a, b] for a, b in itertools.pairwise(path)))
        total += weight
        for t, k in enumerate(path):
            marginal[t, k] += weight
        for a, b in itertools.pairwise(path):
            moved[a, b] += weight
    return marginal / total, moved / total


def test_chain_equals_all_paths():
    rng = np.random.default_rng(1)
    emission, step, start = rng.normal(size=(3, 5, 3)) * 2, rng.normal(size=(3, 3)), rng.normal(size=3)
    _, _, marginal, expected = langid.chain(emission, step, start)
    plain = [by_all_paths(e, step, start) for e in emission]
    assert np.allclose(marginal, [m for m, _ in plain])
    assert np.allclose(expected, sum(t for _, t in plain))


@pytest.mark.parametrize("stretch", [1, 2, 3, 50])
def test_stretches_equal_one_chain(monkeypatch, stretch):
    monkeypatch.setattr(langid, "STRETCH", stretch)
    rng = np.random.default_rng(stretch)
    counts = np.array([3, 0, 1, 7, 2, 0, 6, 50])
    emission, step, start = rng.normal(size=(counts.sum(), 3)) * 3, rng.normal(size=(3, 3)), rng.normal(size=3)
    got, low = langid.posteriors(emission, counts, step, start), 0
    for n in counts:
        if n:
            assert np.allclose(got[low : low + n], langid.chain(emission[None, low : low + n], step, start)[2][0])
        low += n
    assert langid.posteriors(np.empty((0, 3)), np.zeros(4, int), step, start).shape == (0, 3)


def test_slope_is_that_of_the_likelihood():
    """One step of training goes up the log likelihood of its chains."""
    windows = [("aa ab ac ad ae af", 0), ("ba bb bc bd be bf", 1)] * 30
    lexicon = langid.Lexicon(np.zeros((langid.LEXICON, 2), np.int64))
    field = langid.fit(windows, lexicon, 2)
    data = np.frombuffer(b"aa ab ba bc ac ad", np.uint8)
    words, marginal = langid.label_words(data, np.array([0, len(data)]), Hasher(), langid.letter_words(), lexicon, field)
    assert words.counts.tolist() == [6]
    assert marginal.argmax(axis=1).tolist() == [0, 0, 1, 1, 0, 0]
    assert field.step[0, 0] > field.step[0, 1] and field.step[1, 1] > field.step[1, 0]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark):
    rows = langid.op13_language_id(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(right) / len(right) > 0.97


def test_words_of_a_switching_text(spark, model):
    languages, lexicon, field = model
    texts = {k: t for k, t in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars BETWEEN 900 AND 4000").select("lang", "text").collect()}
    parts = [" ".join(texts[k].split()[:60]) for k in ("de", "fr", "de", "en")]
    data = lower_az()[np.frombuffer(" ".join(parts).encode(), np.uint8)]
    words, marginal = langid.label_words(data, np.array([0, len(data)]), Hasher(), langid.letter_words(), lexicon, field)
    ends = np.cumsum([len(p.encode()) + 1 for p in parts])
    truth = np.array([languages.index(("de", "fr", "de", "en")[i]) for i in np.searchsorted(ends, words.starts, "right")])
    assert (marginal.argmax(axis=1) == truth).mean() > 0.9


def test_lexicon_counts_all_words(spark):
    texts = [("One two\ntwo", "en"), ("zwei two", "de"), ("", "de"), ("123", "en"), ("Über über", "de")]
    counts = langid.count_words(spark.createDataFrame(texts * 3, "text string, lang string").repartition(4), ["de", "en"])
    hashed = {}
    for word in ("one", "two", "zwei", "über", "Über"):
        data = np.frombuffer(word.encode(), np.uint8)
        hashed[word] = int(Hasher().spans(data, np.array([0]), np.array([len(data)]))[0] % np.uint64(langid.LEXICON))
    assert counts[hashed["two"]].tolist() == [3, 6] and counts[hashed["one"]].tolist() == [0, 3]
    assert counts[hashed["über"]].tolist() == [3, 0] and counts[hashed["Über"]].tolist() == [3, 0]
    assert counts.sum() == 3 * 7


def test_odd_texts(spark, model):
    texts = [None, "", " \n", "123 — 45 ♥ ...", "a", "é", "der die und nicht", "x" * 200_000, "der die und " * 40_000, "der die und nicht"]
    rows = [(i if i else None, t, 1, "z") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int, lang_pred string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame, *model, "doc_id").collect()}
    assert len(got) == len(texts)
    assert all(got[i or None] == ("und", 0.0) for i in range(4))
    assert all(got[i][0] in model[0] and 0 < got[i][1] <= 1 for i in range(4, 10))
    assert got[6][0] == got[8][0] == "de" and got[6] == got[9]
    assert langid.identify(frame.limit(0), *model, "doc_id").count() == 0


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "", "en")], "doc_id long, text string, lang string")
    model = langid.train(frame)
    assert model[0] == []
    assert {(r.lang_pred, r.score) for r in langid.identify(frame, *model, "doc_id").collect()} == {("und", 0.0)}


def test_windows_are_the_same_for_any_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert langid.sample_windows(docs.repartition(3)) == langid.sample_windows(docs.repartition(11))
