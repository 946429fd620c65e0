"""Documents to token ids in five stages, one operator each.

Every stage but the last returns the columns it was given. Each is written as Parquet and read
back by the next, so a lost executor costs at most a stage's own work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm import bpe, langid, mixing, neardup, ranking
from tallybrook.llm.common import settled, table

#: Below this the language is too uncertain to keep a text.
LEAST_LANGUAGE_SCORE = 0.4
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language: with a letter, and a language that is certain enough.

    NULL and empty texts go. Without any known language to learn from all texts go.
    """
    found = langid.predict(docs, langid.fit(docs), ("_language", "_language_score"))
    kept = (F.col("_language") != langid.UNDETERMINED) & (
        F.col("_language_score") >= LEAST_LANGUAGE_SCORE
    )
    return found.where(kept).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score as good ones, by the labels' judgement; all if it can't be learned.

    NULL and empty texts are scored as empty ones, equal texts alike, each row by itself; scores
    of exactly one half stay. No documents give none.
    """
    model = ranking.fit(docs, table(spark, sf_dir, "labels"))
    scored = ranking.score(docs, model, ("_quality_score", "_quality"))
    return scored.where("_quality = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id; of equal rows one.

    Documents are told apart by id and text: where an id is repeated with other texts, each text
    stays or goes with its own group. Of a group's rows with the least id the one of least text
    hash stays; rows without an id stay only if the whole group has none. NULL texts and those
    without words are in no group. No documents give none.
    """
    rows = neardup.grouped(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_key")
    chosen = rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(order).alias("_row"))
    alone = rows.where(F.col("group").isNull()).select("doc_id", "text_key").distinct()
    kept = chosen.select("_row.doc_id", "_row.text_key").unionByName(alone).toDF("_kept", "_key")
    text_key = F.xxhash64("text")
    unique = docs.join(
        kept, docs["doc_id"].eqNullSafe(kept["_kept"]) & (text_key == kept["_key"]), "left_semi"
    )
    copies = Window.partitionBy("doc_id", text_key).orderBy("doc_id")
    return unique.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, rounded to whole documents.

    A text is left out where its source has more than its target, and comes up to three times
    where it has less; halves are rounded up. NULL texts and those without words go. Rows of one
    id and text are repeated by what all of them take together. No documents give none.
    """
    taken = (
        mixing.taken_words(docs)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"))
        .agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
        .where("_taken * 2 >= _size AND _size > 0")
        .withColumn("_times", F.round(F.col("_taken") / F.col("_size")).cast("int"))
    )
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    own = docs.withColumn("_own_crc", crc)
    met = own.join(
        taken, own["doc_id"].eqNullSafe(taken["_id"]) & (own["_own_crc"] == taken["_crc"])
    )
    return met.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, their number and hash, and the hash of the decoded text.

    NULL texts are encoded as empty ones, each row by itself, whole texts however long. No
    documents give no rows.
    """
    encoded = bpe.encode_decode(docs)
    return bpe.code_digest(encoded, "ids")


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Trained models, hashes and tokenizers: not for SQL. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
