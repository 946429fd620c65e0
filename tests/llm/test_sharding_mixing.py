from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F
from tallybrook.llm import mixing, sharding
from tests.llm.support import documents, empty, rows


def size_of(text):
    return len((text or "").encode()) + 16


def test_shards_hold_every_row_once(spark):
    got = sharding.shard_digest(documents(spark), shards=7).collect()
    want = Counter((i, size_of(t), zlib.crc32((t or "").encode())) for i, t, _, _ in rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_fewer_rows_than_shards(spark):
    got = sharding.shard_digest(documents(spark, rows()[:3]), shards=40).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard_digest(empty(spark)).collect() == []


def test_shards_are_shuffled_alike_each_time(spark):
    docs = documents(spark, [(i, f"text {i}", "en", "s") for i in range(2000)])
    first, again = (
        {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(
            docs.select("doc_id", F.lit(1 << 16).cast("long").alias("size"), "text"),
            ["doc_id"], "size",
        ).repartition(3).collect()}
        for _ in range(2)
    )
    assert first == again and len(first) == 2000
    neighbours = sum(first[i][0] == first[i + 1][0] for i in range(1999))
    assert neighbours < 200
    placed, _ = sharding.shuffled(
        docs.select("doc_id", F.lit(1 << 16).cast("long").alias("size")), ["doc_id"], "size"
    )
    order = [r["doc_id"] for r in placed.orderBy("position").collect()]
    assert sorted(order) == list(range(2000)) and order != sorted(order)


def test_records_keep_their_columns_and_are_written(spark, tmp_path):
    docs = documents(spark).withColumn("size", sharding.text_bytes())
    sharded = sharding.shard(docs, ["doc_id", "text"], "size", shards=4)
    assert set(sharded.columns) == set(docs.columns) | {"slot"}
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(rows())
    assert back.where("shard = 2").count() == 8


def shuffle_by_hand(records, buckets):
    """The order of two passes, given each record's bucket: buckets in order, each in any order."""
    by_bucket = defaultdict(Counter)
    for bucket, record in zip(buckets, records):
        by_bucket[bucket][record] += 1
    return [by_bucket[b] for b in sorted(by_bucket)]


def test_order_is_that_of_two_passes(spark):
    """Buckets by the seeded hash, end to end; inside each all of its records and no others."""
    found = [(i, f"text {i}", "en", "s") for i in range(3000)] + [(5, "text 5", "en", "s")] * 3
    docs = documents(spark, found).select("doc_id", "text", F.lit(1000).cast("long").alias("size"))
    total = len(found) * 1000
    buckets = -(-total // (1 << 18))
    key = F.xxhash64(F.lit(sharding.SEED), "doc_id", "text")
    numbered = docs.select("doc_id", F.pmod(key, F.lit(buckets)).alias("b")).collect()
    want = shuffle_by_hand([r["doc_id"] for r in numbered], [r["b"] for r in numbered])
    placed, rows_ = sharding.shuffled(docs, ["doc_id", "text"], "size", bucket_bytes=1 << 18)
    got = [r["doc_id"] for r in placed.orderBy("position").collect()]
    assert rows_ == len(got) == len(found)
    at = 0
    for bucket in want:
        n = sum(bucket.values())
        part = got[at : at + n]
        assert Counter(part) == bucket and (n < 9 or part != sorted(part))
        at += n


@pytest.mark.parametrize("text", ["the same text", None])
def test_equal_rows_spread_over_all_buckets(spark, text):
    """Two thirds of all rows are one record; no bucket gets more of it than its part."""
    same = spark.range(20_000).select(
        F.lit(None if text is None else 7).cast("long").alias("doc_id"), F.lit(text).alias("text")
    )
    others = spark.range(10_000).select("id", F.concat(F.lit("text "), "id").alias("text"))
    docs = same.union(others).withColumn("size", sharding.text_bytes())
    placed, rows_ = sharding.shuffled(docs, ["doc_id", "text"], "size", bucket_bytes=1 << 16)
    assert rows_ == 30_000
    order = [r["doc_id"] for r in placed.orderBy("position").collect()]
    assert len(order) == 30_000
    hot = None if text is None else 7
    shares = [sum(i == hot for i in order[n : n + 3000]) for n in range(0, 30_000, 3000)]
    assert min(shares) > 1500 and max(shares) < 2500
    again, _ = sharding.shuffled(
        docs.repartition(5), ["doc_id", "text"], "size", bucket_bytes=1 << 16
    )
    assert [r["doc_id"] for r in again.orderBy("position").collect()] == order
    assert Counter(i for i in order if i != hot) == Counter(i for i in range(10_000) if i != hot)


def test_whole_records_are_shuffled_once(spark):
    """Whatever the starts of buckets are thought to weigh, the records aren't dealt by them again."""
    docs = documents(spark).select("doc_id", "text", sharding.text_bytes().alias("size"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed, _ = sharding.shuffled(docs, ["doc_id", "text"], "size")
        plan = placed._jdf.queryExecution().executedPlan().toString()
        order = sorted(r["position"] for r in placed.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert order == list(range(len(rows())))
    assert "BroadcastHashJoin [bucket#" in plan and "SortMergeJoin [bucket#" not in plan


def test_digest_is_of_the_written_texts(spark, monkeypatch):
    """Whole texts are in the shards; what the query returns is read from there."""
    written = []
    write = sharding.write_shards
    monkeypatch.setattr(
        sharding, "write_shards", lambda frame, path: (written.append(path), write(frame, path))
    )
    got = sharding.shard_digest(documents(spark), shards=3).collect()
    back = spark.read.parquet(written[0]).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((i, t) for i, t, _, _ in rows())
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in back) == Counter(
        (r["doc_id"], r["shard"], r["slot"]) for r in got
    )


@pytest.mark.parametrize(
    ("sizes", "weights", "want"),
    [
        ([60, 60], [1, 2], [40, 80]),
        ([10, 110], [1, 1], [30, 90]),
        ([10, 10, 100], [3, 3, 1], [30, 30, 60]),
        ([0, 12], [5, 1], [0, 12]),
        ([], [], []),
        ([0], [1], [0]),
    ],
)
def test_targets(sizes, weights, want):
    assert mixing.targets(sizes, weights) == pytest.approx(want)


def test_mix_reaches_its_targets(spark):
    found = [(i, " ".join(["w"] * (5 + i % 17)), "en", f"s{min(i % 9, 3)}") for i in range(3000)]
    got = mixing.taken_words(documents(spark, found + rows())).collect()
    assert len(got) == len(found) + len(rows())
    taken, facts = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        facts[r["source"]] = (r["source_size"], r["target"])
        assert 0 <= r["taken"] <= 3 * r["size"]
    words = Counter()
    for _, text, _, source in found + rows():
        words[source] += len((text or "").encode().split())
    assert {s: f[0] for s, f in facts.items()} == dict(words)
    names = sorted((s for s in words if s is not None)) + [None]
    want = mixing.targets([words[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    for name, target in zip(names, want):
        assert facts[name][1] == pytest.approx(target)
        assert abs(taken[name] - target) <= max(8, 0.01 * target), name
    again = mixing.taken_words(documents(spark, found + rows())).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_small_sources_reach_their_targets_beside_a_large_one(spark):
    sizes = {f"a{n:04}-{i}": n for n in (10, 100, 300, 1500, 5000) for i in range(8)}
    sizes["z"] = 2_100_000
    found = [
        (no * 10_000 + i, " ".join(["w"] * min(1000, n - i * 1000)), "en", source)
        for no, (source, n) in enumerate(sizes.items())
        for i in range(-(-n // 1000))
    ]
    taken, targets = Counter(), {}
    for r in mixing.taken_words(documents(spark, found)).collect():
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    # At three times their size, within a few words or 1 %.
    for source, n in sizes.items():
        assert source == "z" or targets[source] == 3 * n
        assert abs(taken[source] - targets[source]) <= max(4, 0.01 * targets[source]), source


@pytest.mark.parametrize("size", [1, 10, 1023, 1024, 1025, 5000, 1 << 20, (1 << 20) + 1, 80_000_001])
def test_blocks_are_many_and_small(size):
    blocks = mixing.block_count(size)
    assert -(-size // blocks) <= 1024 and blocks >= min(size, 1024)


def test_mix_without_rows_or_words(spark):
    assert mixing.taken_words(empty(spark)).collect() == []
    got = mixing.taken_words(documents(spark, [(1, None, "en", None), (1, None, "en", None)]))
    assert [(r["size"], r["target"], r["taken"]) for r in got.collect()] == [(0, 0.0, 0)] * 2


def test_any_stretch_of_the_schedule_is_close_to_the_weights(spark):
    shares = [10_000.0, 20_000.0, 30_000.0]
    slots = mixing.schedule(spark, shares, [60_000] * 3, 1).orderBy("slot").collect()
    assert len(slots) == 60_000
    for start in (0, 777, 31_000):
        part = Counter(r["source_no"] for r in slots[start : start + 600])
        assert all(abs(part[i] - 100 * (i + 1)) <= 4 for i in range(3))
    blocks = [r["block"] for r in slots if r["source_no"] == 1]
    assert blocks == list(range(len(blocks)))


def test_pieces_cover_what_is_taken(spark):
    docs = documents(spark, [(i, "a b c d e", "en", "s") for i in range(50)])
    pieces = mixing.mix(docs).where("slot IS NOT NULL").collect()
    seen = {(r["doc_id"], w) for r in pieces for w in range(r["from_word"], r["to_word"])}
    assert seen == {(i, w) for i in range(50) for w in range(5)}
