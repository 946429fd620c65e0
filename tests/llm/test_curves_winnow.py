from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F
from tallybrook.llm import curves, winnow
from tests.llm.support import documents, empty, rows

VECTORS = "vec_id long, embedding array<float>, label int, score double, node long, rank int"


def vectors(spark, found):
    return spark.createDataFrame([(i, v, 0, 0.0, 1, 2) for i, v in found], VECTORS)


def nearest(found, query_ids, k=5):
    """By brute force: ids and cosines, ties by id."""
    ids, x = np.array([i for i, _ in found]), np.array([v for _, v in found], np.float32).astype(float)
    norms = np.linalg.norm(x, axis=1)
    result = {}
    for q in query_ids:
        at = list(ids).index(q)
        # Equal vectors have equal cosines, whatever rounding does.
        scores = np.round((x @ x[at]) / (norms * norms[at]), 12)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        result[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return result


def as_lists(rows_):
    found = defaultdict(list)
    for r in sorted(rows_, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def test_hilbert_visits_every_cell_by_steps_of_one():
    for dimensions, bits in ((2, 4), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        places = curves.hilbert(cells, bits)
        assert sorted(places) == list(range(len(cells)))
        path = cells[np.argsort(places)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = as_lists(curves.nearest(table, table.where("vec_id % 50 = 0")).collect())
    want = nearest(found, [i for i, _ in found if i % 50 == 0])
    assert got.keys() == want.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert recall >= 0.9
    for q, pairs in got.items():
        exact = dict(nearest(found, [q], len(found))[q])
        assert all(score == pytest.approx(exact[i]) for i, score in pairs)


def test_recall_of_vectors_without_structure(spark):
    rng = np.random.default_rng(8)
    found = [(i, rng.normal(size=32).tolist()) for i in range(3000)]
    table = vectors(spark, found)
    got = as_lists(curves.nearest(table, table.where("vec_id % 50 = 0")).collect())
    want = nearest(found, range(0, 3000, 50))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=8).astype(np.float32).tolist()
    found = [(i, same) for i in range(100)] + [
        (100 + i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)
    ]
    odd = [
        (200, None), (250, [0.0] * 8), (300, [float("nan")] * 8), (350, [None] * 8),
        (400, [float("inf")] + [1.0] * 7), (450, [1.0, 2.0]), (500, []), (None, same),
    ]
    table = vectors(spark, found + odd + [(7, same)])
    got = as_lists(curves.nearest(table, table.where("vec_id % 50 = 0")).collect())
    assert got.keys() == {0, 50, 100, 150}
    want = nearest(found, [0, 50, 100, 150])
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 4]


def test_few_vectors_and_none(spark):
    table = vectors(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])])
    got = as_lists(curves.nearest(table, table.where("vec_id = 0")).collect())
    assert [i for i, _ in got[0]] == [1, 2]
    assert [s for _, s in got[0]] == pytest.approx([math.sqrt(0.5), 0.0])
    none = vectors(spark, [])
    assert curves.nearest(none, none).collect() == []
    alone = vectors(spark, [(0, [1.0, 2.0])])
    assert curves.nearest(alone, alone).collect() == []


# Winnowing


def plain(text, k, window):
    """Winnowing as it is defined, with the hashes of the fast form."""
    if not text:
        return []
    k = min(k, len(text))
    hashes = [int(winnow.winnow(text[i : i + k], k, 1)[0][0]) for i in range(len(text) - k + 1)]
    kept = []
    for start in range(max(1, len(hashes) - window + 1)):
        part = hashes[start : start + window]
        at = start + max(i for i, h in enumerate(part) if h == min(part))
        if not kept or kept[-1][1] != at:
            kept.append((hashes[at], at))
    return kept


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefghij é\U0001f600"])
def test_winnow_by_its_definition(letters):
    rng = random.Random(letters)
    for length in (0, 1, 3, 5, 8, 9, 40, 200):
        text = "".join(rng.choice(letters) for _ in range(length))
        hashes, positions = winnow.winnow(text, 5, 4)
        assert list(zip(hashes.tolist(), positions.tolist())) == plain(text, 5, 4)


def test_shared_passages_share_a_hash():
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(50):
        passage = noise(winnow.K + winnow.WINDOW - 1)
        a, b = (noise(rng.randrange(300)) + passage + noise(100) for _ in range(2))
        assert winnow.likeness(winnow.winnow(a)[0], winnow.winnow(b)[0]) > 0


def test_edited_short_texts_stay_alike():
    """Two thirds of a text are unchanged; the rest comes from another one, long or short."""
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for length in [*range(17, 151)] * 3:
        text, other = noise(length), noise(rng.choice((3, 20, 200)))
        moved = length // 3
        changed = text[: length - moved] + other[:moved]
        prints = winnow.winnow(text)[0]
        assert winnow.likeness(prints, winnow.winnow(changed)[0]) > 0, length
        assert winnow.likeness(prints, winnow.winnow(noise(length))[0]) == 0


def edited(found):
    """Texts in descending order of id, NULLs last, equal ids by text, with their edited texts."""
    order = sorted(found, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    result = []
    for at, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        moved = len(text) // 3
        result.append((doc_id, text, text[: len(text) - moved] + following[:moved], following))
    return result


@pytest.mark.parametrize("rows_a_range", [3, 2000])
def test_edited_texts(spark, monkeypatch, rows_a_range):
    monkeypatch.setattr(winnow.with_next, "__defaults__", (rows_a_range,))
    got = winnow.edited_likeness(documents(spark)).collect()
    prints = lambda t: winnow.winnow(t)[0]
    want = [
        (
            i, len(t), hashlib.sha256(e.encode()).hexdigest(), winnow.as_text(prints(t)),
            winnow.as_text(prints(e)), winnow.likeness(prints(t), prints(e)),
            winnow.likeness(prints(t), prints(n)), len(prints(t)),
            winnow.as_text(winnow.winnow(t)[1]),
        )
        for i, t, e, n in edited(rows())
    ]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_large_ids_are_cut_by_text(spark, monkeypatch):
    """Many rows of one id and of none, equal rows among them: still in order, over many tasks."""
    monkeypatch.setattr(winnow.with_next, "__defaults__", (50,))
    found = [(5, f"large {i * 7919 % 1000:04}", "en", "s") for i in range(400)]
    found += [(None, f"none {i % 90:04}", "en", "s") for i in range(300)]
    found += [(6, "the same text again", "en", "s")] * 250
    found += [(i, f"other text {i}", "en", "s") for i in (*range(5), *range(7, 40))]
    docs = documents(spark, found)
    placed = winnow.with_next(docs)
    sizes = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 150
    got = winnow.edited_likeness(docs).select("doc_id", "n_chars", "edited_sha256").collect()
    want = [
        (i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in edited(found)
    ]
    assert Counter(map(tuple, got)) == Counter(want)


def test_fingerprints_keep_positions(spark):
    got = {r["doc_id"]: r for r in winnow.fingerprints(documents(spark)).collect()}
    hashes, positions = winnow.winnow(dict((i, t) for i, t, _, _ in rows())[25])
    assert got[25]["hashes"] == hashes.tolist() and got[25]["positions"] == positions.tolist()
    assert got[21]["hashes"] == []


def test_no_documents(spark):
    assert winnow.edited_likeness(empty(spark)).collect() == []
    one = winnow.edited_likeness(documents(spark, [(1, "abc" * 100, None, None)])).collect()
    assert [(r["near_next"], r["n_chars"]) for r in one] == [(1.0, 300)]
