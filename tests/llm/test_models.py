from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallybrook.llm import langid, maxent, ranking
from tallybrook.llm.common import words
from tests.llm.support import documents, empty, prose, rows


def fold(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


# Language


def test_language_of_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    got = langid.identify(documents(spark)).collect()
    texts = Counter(i for i, _, _, _ in rows())
    assert Counter(r["doc_id"] for r in got) == texts
    undetermined = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert undetermined == {20, 21, 22, 23, None}
    assert all((r["lang_pred"] == "und") <= (r["score"] == 0) for r in got)
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de", "fr"}


def test_language_without_anything_to_learn(spark):
    assert langid.identify(empty(spark)).collect() == []
    unknown = documents(spark, [(1, "some words", None, "s"), (2, None, None, "s")])
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(unknown).collect()} == {("und", 0.0)}
    one = documents(spark, [(i, prose(i), "en", "s") for i in range(10)])
    assert {r["lang_pred"] for r in langid.identify(one).collect()} == {"en"}


def test_only_the_text_decides(spark):
    found = [(i, prose(i), "en", "s") for i in range(40)]
    found += [(100 + i, "der die das und nicht schön über größe " * 3 + str(i), "de", "s") for i in range(40)]
    model = langid.fit(documents(spark, found))
    other = [(i + 10**6, t, None, None) for i, t, _, _ in found]
    first = langid.predict(documents(spark, found), model).collect()
    again = langid.predict(documents(spark, other), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in first] == [(r["lang_pred"], r["score"]) for r in again]


def test_chunks_lose_no_ngram(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefghij éß") for _ in range(3000))
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_CHUNK", 500)
    assert np.abs(langid.features(text) - whole).max() < 1e-12


@pytest.mark.parametrize("classes", [1, 2, 3, 6, 13])
def test_a_certain_vote_is_one_at_any_number_of_classes(classes):
    certain = langid.Machine(np.array([1.0]), 0.0, 30.0, 0.0)
    even = langid.Machine(np.array([0.0]), 0.0, 1.0, 0.0)
    pairs = [(a, b) for a in range(classes) for b in range(a + 1, classes)]
    vote = langid.Vote([str(i) for i in range(classes)], {(a, b): even if a else certain for a, b in pairs})
    found = vote.probabilities(np.array([[1.0], [0.0]]))
    assert found.sum(axis=1) == pytest.approx([1, 1])
    assert found[0, 0] == pytest.approx(1)
    assert found[1] == pytest.approx(np.full(classes, 1 / classes))


# Quality


def test_quality_of_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r["doc_id"]: r for r in ranking.quality(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    good = [r["score"] for q, r in held if q == 1]
    bad = [r["score"] for q, r in held if q == 0]
    above = np.mean([g > b for g in good for b in bad])
    assert above >= 0.98
    assert np.mean([r["predicted"] == q for q, r in held]) >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())


def test_quality_of_awkward_rows(spark):
    found = rows() + [(100 + i, f"BUY NOW!!! {i} $$$ " * 5, None, None) for i in range(20)]
    labels = spark.createDataFrame(
        [(i, 1, None) for i in range(20)] + [(100 + i, 0, 1) for i in range(20)]
        + [(None, 1, 0), (3, None, 0), (4, 7, 0), (999, 1, 0), (5, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = ranking.quality(documents(spark, found), labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _, _ in found)
    by_id = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None}
    assert all(by_id[i] == 1 for i in range(20)) and all(by_id[100 + i] == 0 for i in range(20))
    assert ranking.quality(empty(spark), labels).collect() == []
    one_label = labels.where("quality = 1")
    assert {r["score"] for r in ranking.quality(documents(spark), one_label).collect()} == {0.5}


def test_the_samples_are_bounded_whatever_is_repeated(spark):
    """Rows without id, and of one id, are many; all are one text or each its own."""
    one = [(None, prose(1), "en", None)] * 3000 + [(7, prose(2), "de", None)] * 3000
    many = [(None, prose(i), "fr", None) for i in range(3000)]
    drawn = langid.learning_sample(documents(spark, one + many), 300)
    assert dict(drawn.groupBy("lang").count().collect()) == {"en": 100, "de": 100, "fr": 100}
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(7, prose(i), None, None) for i in range(900)] + [(8, prose(3), None, None)] * 900)
    assert ranking.fit(docs, labels, 80) is not None


def test_many_languages(spark):
    """Sixty codes of no known family: root of them many families, and each is learned."""
    rng = np.random.default_rng(3)
    letters = [chr(97 + i) for i in range(26)]
    alphabets = [rng.choice(letters, 6, replace=False) for _ in range(60)]
    found = []
    for i in range(600):
        of = alphabets[i % 60]
        words = ["".join(rng.choice(of, 5)) for _ in range(60)]
        found.append((i, " ".join(words), f"x{i % 60:02}", None))
    families = langid.families_of([code for _, _, code, _ in found])
    assert len(set(families.values())) == 8
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(documents(spark, found)).collect()}
    assert np.mean([got[i] == code for i, _, code, _ in found]) > 0.9


def test_ranking_orders_pairs():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (200, 5)), rng.normal(-1, 1, (50, 5))
    model = ranking.fit_ranking(good, bad, 0.2)
    assert np.mean(model.strength(good)[:, None] > model.strength(bad)[None, :]) > 0.97
    scores = np.concatenate((model.score(good), model.score(bad)))
    assert abs(np.mean(scores < 0.5) - 0.2) < 0.03


# Language model


def base_scores(found):
    tokens = [words(t) + [b""] for _, t, _, _ in found]
    counts = Counter(w for (i, *_), ts in zip(found, tokens) if fold(i, 7) != 2 for w in ts)
    total, types = sum(counts.values()), len(counts)
    scores = [sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ts) for ts in tokens]
    known = [sum(counts[w] > 0 for w in ts) for ts in tokens]
    return scores, known, total, tokens


@pytest.mark.parametrize("known", [5, maxent.KNOWN])
def test_base_scores_by_brute_force(spark, known):
    """Also when most words have to be joined, as only five are broadcast."""
    found = rows()
    got = maxent.score(documents(spark), known=known, steps=2).collect()
    scores, counted, total, tokens = base_scores(found)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 6))
    want = sorted(((i, len(t), k, s) for (i, *_), t, k, s in zip(found, tokens, counted, scores)), key=key)
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got), key=key)
    assert [r[:3] for r in have] == [r[:3] for r in want]
    assert [r[3] for r in have] == pytest.approx([r[3] for r in want])
    assert {r["train_tokens"] for r in got} == {total}
    assert all(r["held_out"] == (fold(r["doc_id"], 7) == 2) for r in got)
    assert all(r["score"] < 0 for r in got)


def test_nothing_to_score_or_learn(spark):
    assert maxent.score(empty(spark), steps=2).collect() == []
    held = next(i for i in range(100) if fold(i, 7) == 2)
    got = maxent.score(documents(spark, [(held, "a b", "en", "s")]), steps=2).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)]


def test_better_than_single_words_on_held_out_rows(spark, sf_dir):
    got = [r for r in maxent.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / tokens > sum(r["base_score"] for r in got) / tokens + 0.1


def test_probabilities_sum_to_one():
    counts = maxent.Counts(
        100, 50, {}, np.full(maxent.SPELLINGS, 1.0), np.full(maxent.SPELLINGS, 1.0), 30,
        np.where(np.arange(maxent.CORE) < 30, 2.0, 0.0),
    )
    weights = maxent.Weights.start(counts)
    rng = np.random.default_rng(1)
    weights.classes += rng.normal(0, 0.3, weights.classes.shape).astype(np.float32)
    weights.words[1:] += rng.normal(0, 0.3, weights.words[1:].shape).astype(np.float32)
    found = np.exp(weights.outcomes(np.arange(20), np.arange(20)[::-1].copy()))
    assert found.sum(axis=1) == pytest.approx(np.ones(20))
    assert found[:, 30 : maxent.CORE].max() < 1e-6


def test_gradient_is_the_slope():
    rng = np.random.default_rng(4)
    counts = maxent.Counts(
        100, 50, {}, np.ones(maxent.SPELLINGS), np.ones(maxent.SPELLINGS), maxent.CORE,
        np.full(maxent.CORE, 3.0),
    )
    weights = maxent.Weights.start(counts)
    weights.classes = weights.classes.astype(float)
    weights.words = weights.words.astype(float)
    contexts = np.array([5 * maxent.CONTEXTS + 7, 250 * maxent.CONTEXTS + 3])
    seen = rng.integers(0, 4, (2, maxent.OUTCOMES)).astype(float)

    def value():
        return (seen * weights.outcomes(contexts // maxent.CONTEXTS, contexts % maxent.CONTEXTS)).sum()

    of_classes, of_words = maxent.gradient(weights, contexts, seen)
    for matrix, slope in ((weights.classes, of_classes), (weights.words, of_words)):
        rows_, columns = np.nonzero(np.abs(slope) > 0.5)
        for at in list(zip(rows_, columns))[::97]:
            before = value()
            matrix[at] += 1e-4
            assert (value() - before) / 1e-4 == pytest.approx(slope[at], rel=1e-2, abs=1e-2)
            matrix[at] -= 1e-4
