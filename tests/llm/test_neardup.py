from __future__ import annotations

import random

import numpy as np
import pytest

from tallybrook.llm import graph, neardup
from tests.llm.support import documents, empty, prose, rows


def brute(found, width, percent):
    """component by every pair of documents."""
    sets = []
    for _, text in found:
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = words.encode().split()
        n = min(width, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    group = list(range(len(found)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * len(a | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(found):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [least.get(top(i)) for i in range(len(found))], [len(s) for s in sets]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_awkward_rows(spark, width, percent):
    found = [(i, t) for i, t, _, _ in rows()]
    want, sizes = brute(found, width, percent)
    got = neardup.duplicate_groups(documents(spark), width, percent).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=key) == sorted(
        ((i, n, c) for (i, _), n, c in zip(found, sizes, want)), key=key
    )
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_no_rows(spark):
    assert neardup.duplicate_groups(empty(spark)).collect() == []


def test_a_cloud_of_copies_of_copies(spark):
    """Many are not similar to the common centre but to each other: no link may be lost."""
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(400)}" for _ in range(80)]]
    while len(texts) < 500:
        words = list(rng.choice(texts[-200:]))
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        texts.append(words)
    found = [(i, " ".join(words)) for i, words in enumerate(texts)]
    found += [(1000 + i, prose(i)) for i in range(50)]
    want, _ = brute(found, 3, 85)
    got = neardup.duplicate_groups(documents(spark, [(i, t, None, None) for i, t in found]), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(
        zip([i for i, _ in found], want)
    )
    assert 20 < len(set(want)) < 500


def test_a_passage_that_many_share_links_nothing(spark):
    shared = " ".join(f"p{i}" for i in range(60))
    found = [(i, f"{shared} " + " ".join(f"d{i}x{j}" for j in range(30))) for i in range(200)]
    got = neardup.duplicate_groups(documents(spark, [(i, t, None, None) for i, t in found]), 3, 85)
    assert all(r["kept"] for r in got.collect())


def test_bands_find_similar_sets():
    count = neardup.bands_for(85)
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        other = np.concatenate((base[:368], rng.integers(0, 1 << 63, 32, dtype=np.uint64)))
        a, b = (neardup.bands(np.unique(x), count) for x in (base, other))
        same = a == b
        missed += not (same[:count].any() and same[count:].any())
    assert missed == 0
    assert neardup.bands_for(80) > count


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    edges = spark.createDataFrame([(names[a], names[b]) for a, b in chain], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    first = min(names[i] for i in range(61))
    second = min(names[i] for i in (100, 101, 103))
    assert all(got.get(names[i], names[i]) == first for i in range(61))
    assert all(got.get(names[i], names[i]) == second for i in (100, 101, 103))
    assert names[200] not in got
    assert graph.components(edges.limit(0)).collect() == []
