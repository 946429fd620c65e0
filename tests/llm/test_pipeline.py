from __future__ import annotations

import hashlib
import random
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
import tiktoken
import public_tokenizers

import __spark_entry__ as entry
from tallybrook.llm import bpe, langid
from tallybrook.llm.queries import ORACLES, QUERIES
from tests.llm.support import documents, empty, prose, rows


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality", "near_dedup", "mix_sources", "encode",
    ]


def test_one_query_an_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, sf_dir, name):
    got = Counter(map(tuple, QUERIES[name](spark, sf_dir).collect()))
    columns = QUERIES[name](spark, sf_dir).columns
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == Counter(want)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_and_bear_awkward_rows(spark, sf_dir, name, stage):
    docs = documents(spark)
    left = stage(spark, docs, sf_dir)
    assert left.columns == docs.columns
    texts = {(i, t) for i, t, _, _ in rows()}
    assert {(r["doc_id"], r["text"]) for r in left.collect()} <= texts
    assert stage(spark, empty(spark), sf_dir).collect() == []


def test_language_and_duplicates_that_go(spark, sf_dir):
    left = corpus_pipeline.language_id(spark, documents(spark), sf_dir)
    assert {20, 21, 22, 23} & {r["doc_id"] for r in left.collect()} == set()
    assert {*range(20), 25, 26} <= {r["doc_id"] for r in left.collect()}
    unique = corpus_pipeline.near_dedup(spark, documents(spark), sf_dir).collect()
    kept = Counter(r["doc_id"] for r in unique)
    # 24 copies 3, a row of 28 copies 5, and the nameless row copies 4.
    assert kept[24] == 0 and kept[3] == 1 and kept[4] == 1 and kept[5] == 1
    assert all(kept[i] == 1 for i in range(20))


def test_a_repeated_id_does_not_save_a_copy(spark, sf_dir):
    """Of (1, A), (2, A), (2, B) only the copy of A under the greater id goes."""
    a, b = prose(1, 40), prose(2, 40)
    found = [(1, a), (2, a), (2, b), (2, b), (None, a), (None, prose(3, 40)), (None, prose(3, 40)), (9, None)]
    left = corpus_pipeline.near_dedup(spark, documents(spark, [(i, t, None, None) for i, t in found]), sf_dir)
    got = Counter((r["doc_id"], r["text"]) for r in left.collect())
    assert got == Counter({(1, a): 1, (2, b): 1, (None, prose(3, 40)): 1, (9, None): 1})


def test_encoding_bears_awkward_rows(spark, sf_dir):
    docs = documents(spark)
    coded = corpus_pipeline.encode(spark, docs, sf_dir).collect()
    assert Counter(r["doc_id"] for r in coded) == Counter(i for i, _, _, _ in rows())
    assert all((r["n_tokens"] == 0) == (r["doc_id"] == 21 or not r["ids"]) for r in coded)
    assert corpus_pipeline.encode(spark, empty(spark), sf_dir).collect() == []


def test_many_families_keep_their_texts(spark, sf_dir):
    codes = "en de nl sv fr es it pt ru uk pl cs fi et hu tr az kk hi bn mr ar he mt ja ko".split()
    found = []
    for no, code in enumerate(codes):
        rng = random.Random(code)
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 12)
        vocabulary = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(50)]
        found += [(no * 100 + i, " ".join(rng.choices(vocabulary, k=60)), code, "s") for i in range(30)]
    left = corpus_pipeline.language_id(spark, documents(spark, found), sf_dir).collect()
    kept = Counter(r["lang"] for r in left)
    assert len(set(langid.families_of(codes).values())) >= 8
    assert all(kept[code] >= 29 for code in codes), kept


def test_mix_repeats_and_leaves_out(spark, sf_dir):
    words = " ".join(["word"] * 10)
    found = [(i, f"{words} {i}", "en", "a") for i in range(300)]
    found += [(1000 + i, f"{words} {i}", "en", "b") for i in range(100)]
    left = corpus_pipeline.mix_sources(spark, documents(spark, found), sf_dir).collect()
    per_source = Counter(r["source"] for r in left)
    # 400 documents at weights 1 to 2.
    assert abs(per_source["a"] - 133) <= 3 and abs(per_source["b"] - 267) <= 3
    assert max(Counter(r["doc_id"] for r in left).values()) == 3


def test_whole_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").collect()}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert got
    codec = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    library = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )
    for r in got:
        text = texts[r["doc_id"]]
        assert r["ids"] == ",".join(map(str, library.encode_ordinary(text)))
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    kept = {r["doc_id"] for r in got}
    assert len(kept & bad) <= 0.03 * len(bad)
    # Of equal texts one stays.
    assert len({texts[i] for i in kept}) == len(kept)
