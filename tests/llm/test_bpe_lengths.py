from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from tallybrook.llm import bpe, lengths
from tests.llm.support import documents, empty, rows


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def encoded(codec, text):
    ids, decoded = codec.encode([bpe._pattern(public_tokenizers.PATTERN).findall(text)])
    return ids[0].as_py(), decoded[0].as_py()


def test_matches_the_library_on_random_texts(codec, library):
    rng = random.Random(11)
    for _ in range(150):
        letters = rng.choice(["ab", "abc ", "aA1 !\n", "    \n\t", "éß中x\U0001f600 ", "thering", "=-_ "])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 60, 70, 300])))
        ids, decoded = encoded(codec, text)
        assert ids == ",".join(map(str, library.encode_ordinary(text)))
        assert decoded == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 3000, " " * 4000, "=-" * 500 + "é" * 900])
def test_long_pieces(codec, library, text):
    ids, decoded = encoded(codec, text)
    assert ids == ",".join(map(str, library.encode_ordinary(text)))
    assert decoded == text.encode()


def test_rows_out_of_order_are_noticed(codec):
    start = bpe.pa.table({"k": [1, 0], "tok": [104, 103]})
    with pytest.raises(bpe.duckdb.Error, match="rows out of order"):
        codec._run(bpe.CONTRACT, start)


def test_forgets_without_losing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    for _, text, _, _ in rows():
        assert encoded(small, text or "")[0] == ",".join(map(str, library.encode_ordinary(text or "")))


def test_remembers_pieces_in_few_bytes():
    """Ids and decoded bytes are kept in arrays, not as Python objects of each piece."""
    fresh = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    pieces = [f"q{i}zx{i * 7}" for i in range(5000)]
    tracemalloc.start()
    _, decoded = fresh._remembered(pieces)
    fresh._remembered(["another piece"])  # Its rows take the place of the last query's.
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert decoded.to_pylist() == [piece.encode() for piece in pieces]
    assert kept / len(pieces) < 100


def test_digest_of_all_rows(spark, library):
    got = bpe.code_digest(bpe.encode_decode(documents(spark))).collect()
    want = []
    for doc_id, text, _, _ in rows():
        ids = library.encode_ordinary(text or "")
        hashed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), hashed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(want)
    assert bpe.code_digest(bpe.encode_decode(empty(spark))).collect() == []


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_decode(docs).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == ",".join(map(str, library.encode_ordinary(r["text"] or "")))


def test_histogram_answers_every_limit(spark):
    counted = lengths.with_length(documents(spark))
    own = [r["length"] for r in counted.collect()]
    codec = lengths.encoding(public_tokenizers.path(lengths.VOCABULARY))
    assert Counter(own) == Counter(len(codec.encode_ordinary(t or "")) for _, t, _, _ in rows())
    table = lengths.histogram(counted)
    for r in table.collect():
        at = r["length"]
        assert r["docs"] == own.count(at) and r["tokens"] == at * own.count(at)
        assert r["docs_within"] == sum(n <= at for n in own)
        assert r["docs_beyond"] == sum(n > at for n in own)
        assert r["tokens_within"] == sum(n for n in own if n <= at)
        assert r["tokens_beyond"] == sum(n for n in own if n > at)
        assert r["tokens_truncated"] == sum(min(n, at) for n in own)
        assert r["quantile"] == pytest.approx(sum(n <= at for n in own) / len(own))
    limits = [0, 1, 7, 50, 100, 10**6]
    assert lengths.truncated_totals(table, limits) == {c: sum(min(n, c) for n in own) for c in limits}
    half = lengths.length_quantiles(table, [0.5, 1.0])
    assert half[0.5] == sorted(own)[(len(own) + 1) // 2 - 1] and half[1.0] == max(own)


def test_histogram_of_nothing(spark):
    table = lengths.histogram(lengths.with_length(empty(spark)))
    assert table.collect() == []
    assert lengths.truncated_totals(table, [5]) == {5: 0}


def test_texts_that_overflow_the_library():
    codec = lengths.encoding(public_tokenizers.path(lengths.VOCABULARY))
    assert lengths.token_count(codec, " " * 600_000) > 0
    assert lengths.token_count(codec, "a b") == 2
