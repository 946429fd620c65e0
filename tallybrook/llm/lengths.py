"""Token counts as an exact histogram of encoded lengths.

The texts are encoded once; from then on everything is a sum over distinct lengths, of which
there are far fewer than documents. Sums from the short end and from the long end then answer
totals, quantiles and truncated totals for every context limit.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import settled, shipped, with_starts

VOCABULARY = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=1)
def _pieces() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def token_count(codec: tiktoken.Encoding, text: str) -> int:
    """Tokens of the whole text. A text that overflows the library's matcher is cut here."""
    try:
        return len(codec.encode_ordinary(text))
    except BaseException as error:
        # The library ends so, which is no Exception, on long runs of white space.
        if type(error).__name__ != "PanicException":
            raise
    pieces = _pieces().finditer(text)
    return sum(len(codec._encode_single_piece(piece.group().encode())) for piece in pieces)


def with_length(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ``length``, the tokens of ``text``. NULL and empty texts have 0."""
    path = public_tokenizers.path(vocabulary)

    @F.pandas_udf("long")
    def length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = encoding(path)
        for texts in batches:
            counts = [token_count(codec, text) if text else 0 for text in texts]
            yield pd.Series(counts, dtype="int64")

    return shipped(docs).select("doc_id", length("text").alias("length"))


def histogram(lengths: DataFrame) -> DataFrame:
    """A row per distinct ``length`` L, which is a context limit too.

    ``docs`` and ``tokens`` of exactly that length; ``docs_within`` and ``docs_beyond`` with at
    most and more than L; ``quantile``, the share of documents within; ``tokens_within`` of the
    documents within; ``tokens_beyond`` of the others; ``tokens_truncated``, what is left of all
    documents when each is cut to L. An empty table gives no rows. Repeated rows count again.
    """
    counted = settled(
        lengths.groupBy("length")
        .agg(F.count(F.lit(1)).alias("docs"))
        .withColumn("tokens", F.col("docs") * F.col("length"))
        .withColumn("all", F.lit(0)),
        "token-lengths",
    )
    totals = counted.agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
    ).first()
    shorter = with_starts(counted, ["all"], "length", "docs").withColumnRenamed("start", "_docs")
    both = with_starts(shorter, ["all"], "length", "tokens")
    within = F.col("_docs") + F.col("docs")
    tokens = F.col("start") + F.col("tokens")
    beyond = F.lit(totals["docs"]) - within
    return both.select(
        "length",
        "docs",
        "tokens",
        within.alias("docs_within"),
        beyond.alias("docs_beyond"),
        (within / F.lit(max(totals["docs"], 1))).alias("quantile"),
        tokens.alias("tokens_within"),
        (F.lit(totals["tokens"]) - tokens).alias("tokens_beyond"),
        (tokens + F.col("length") * beyond).alias("tokens_truncated"),
    )


def truncated_totals(counts: DataFrame, limits: list[int]) -> dict[int, int]:
    """Tokens left when every document is cut to the limit, for any limits, from a histogram."""
    at = F.struct("length", "docs_beyond", "tokens_within")
    last = [F.max(F.when(F.col("length") <= limit, at)).alias(str(limit)) for limit in limits]
    row = counts.agg(F.sum("docs").alias("docs"), *last).first()
    totals = {}
    for limit in limits:
        known = row[str(limit)]
        beyond, within = (
            (known["docs_beyond"], known["tokens_within"]) if known else (row["docs"] or 0, 0)
        )
        totals[limit] = within + limit * beyond
    return totals


def length_quantiles(counts: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """The least length that at least this share of the documents doesn't exceed."""
    wanted = [
        F.min(F.when(F.col("quantile") >= share, F.col("length"))).alias(str(i))
        for i, share in enumerate(shares)
    ]
    row = counts.agg(*wanted).first()
    return {share: row[str(i)] for i, share in enumerate(shares)}
