"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import (
    bpe,
    curves,
    decontam,
    langid,
    lengths,
    maxent,
    mixing,
    neardup,
    oracle,
    ranking,
    runs,
    sharding,
    trie,
    winnow,
)
from tallybrook.llm.common import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.taken_words(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code_digest(bpe.encode_decode(table(spark, sf_dir, "documents")))


def op4_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.duplicate_groups(table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.histogram(lengths.with_length(table(spark, sf_dir, "documents")))


def op6_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


def op7_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return curves.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES = {
    run.__name__: run
    for run in (
        op1_language,
        op2_mix_sources,
        op3_byte_bpe,
        op4_minhash_groups,
        op5_token_lengths,
        op6_maxent_scores,
        op7_hilbert_neighbours,
        op8_winnowing,
        op9_quality,
        op10_shards,
        op11_prefix_trie,
        op12_decontamination,
        op13_periodic_runs,
    )
}

ORACLES = {
    "op4_minhash_groups": oracle.OP4,
    "op11_prefix_trie": oracle.OP11,
    "op12_decontamination": oracle.OP12,
    "op13_periodic_runs": oracle.OP13,
}
