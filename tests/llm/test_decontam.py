from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from tallybrook.llm import decontam, oracle
from tests.llm.support import documents, empty, prose, rows

ITEMS = "item_id long, text string, doc_id long, words string, window int"
WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(decontam.UPPER, decontam.LOWER)


def words(text):
    return WORDS.findall((text or "").translate(LOWERED))


def brute(docs, items):
    windows = {}
    for item, text in items:
        found = words(text)
        n = min(len(found), 10)
        for i in range(len(found) - n + 1 if n else 0):
            windows.setdefault(tuple(found[i : i + n]), set()).add("" if item is None else str(item))
    result = []
    for doc_id, text in docs:
        found, hit, whose = words(text), set(), set()
        for n in {len(window) for window in windows}:
            for i in range(len(found) - n + 1):
                items_here = windows.get(tuple(found[i : i + n]))
                if items_here:
                    hit.update(range(i, i + n))
                    whose |= items_here
        digest = hashlib.sha256(",".join(sorted(whose)).encode()).hexdigest()
        result.append((doc_id, len(found), len(hit), len(whose), digest, bool(hit)))
    return in_order(result)


def in_order(found):
    return sorted((tuple(row) for row in found), key=lambda row: (row[0] is not None, row[0] or 0, *row[1:]))


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, "w", 2) for i, t in items], ITEMS)


def awkward():
    items = [
        (1, prose(3, 25)), (2, prose(5, 10)), (10, "two short"), (11, "One"), (12, ""), (None, None),
        (None, prose(7, 12)), (3, prose(3, 14)), (3, "straße über ALLES"), (4, "a a a a a a a a a a a a"),
    ]
    docs = [(i, t) for i, t, _, _ in rows()]
    docs += [
        (100, f"{prose(90)} {prose(3, 25)}, {prose(5, 10).upper()}!"),
        (101, "two-short one TWO\x00short Straße Über alles"),
        (102, "a " * 40),
        (103, prose(3, 24)),
        (104, " ".join(words(prose(3, 25))[3:12])),
        (105, (prose(60, 200) + " ") * 300 + prose(3, 25)),
    ]
    return docs, items


@pytest.mark.parametrize("most_sent", [decontam.MOST_SENT, 7])
def test_awkward_rows(spark, monkeypatch, most_sent):
    monkeypatch.setattr(decontam, "MOST_SENT", most_sent)
    docs, items = awkward()
    frame = documents(spark, [(i, t, None, None) for i, t in docs])
    got = decontam.contaminated(frame, benchmark(spark, items)).collect()
    assert in_order(got) == brute(docs, items)
    assert sum(row["contaminated"] for row in got) > 5


def test_windows_of_few_words(spark):
    """Many chance occurrences, overlaps and windows of the same shingles in another order."""
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 13)))) for i in range(40)]
    docs = [(i, " ".join(rng.choice("abc") for _ in range(60))) for i in range(60)]
    frame = documents(spark, [(i, t, None, None) for i, t in docs])
    got = decontam.contaminated(frame, benchmark(spark, items)).collect()
    assert in_order(got) == brute(docs, items)


def test_no_rows(spark):
    docs, items = awkward()
    frame = documents(spark, [(i, t, None, None) for i, t in docs])
    assert decontam.contaminated(empty(spark), benchmark(spark, items)).collect() == []
    got = decontam.contaminated(frame, benchmark(spark, [])).collect()
    assert in_order(got) == brute(docs, [])


def test_no_python_in_the_plan(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    shingles = decontam.window_shingles(decontam.windows(bench))
    plan = decontam.places(docs, shingles)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_sql_says_the_same(sf_dir):
    tables = duckdb.connect()
    for name in ("documents", "benchmark"):
        tables.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    docs = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    items = tables.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert in_order(tables.execute(oracle.OP12).fetchall()) == brute(docs, items)
