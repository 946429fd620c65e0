"""Quality by pairwise ranking: a Bradley-Terry model over features of the text.

The chance that one document is preferred to another is the logistic function of the difference
of their scores, which are linear in the features. It is learned from pairs of a good and a bad
document; the threshold is the quantile of the scores that leaves out the share of bad ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from tallybrook.llm.common import fold, shipped, without

#: Labelled rows of each label that the model is fitted on: a bounded sample, drawn by a hash.
SAMPLE = 4000
PAIRS = 40_000
SEED = 23
FOLDS, HELD_OUT = 3, 1

_PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]
_SMALL = 1e-3


def features(text: str | None) -> np.ndarray:
    """What a text looks like, whatever its language and length: rates, on a scale of logarithms."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line.strip()]
    of_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, count = max(len(raw), 1), max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counted = Counter(words)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    upper, lower = of_byte[65:91].sum(), of_byte[97:123].sum() + of_byte[128:].sum()
    distinct_lines = len(set(lines))
    rates = [
        upper / max(upper + lower, 1),
        of_byte[48:58].sum() / size,
        of_byte[_PUNCTUATION].sum() / size,
        of_byte[10] / size,
        of_byte[32] / size,
        of_byte[:32].sum() / size,
        repeats / count,
        max(counted.values(), default=0) / count,
        (lengths > 20).mean() if words else 0.0,
        (lengths < 3).mean() if words else 0.0,
        1 - distinct_lines / max(len(lines), 1),
        *(of_byte[_PUNCTUATION] / size),
    ]
    plain = [
        len(counted) / count,
        np.log1p(len(words)) / 10,
        np.log1p(lengths.mean() if words else 0.0),
        np.log1p(len(words) / max(len(lines), 1)) / 5,
        float(not words),
    ]
    return np.concatenate((np.log1p(np.array(rates) / _SMALL), plain))


@dataclass
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -40, 40)))


def fit_ranking(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int = PAIRS) -> Ranking:
    """From features of good and bad documents. Rows should come in a fixed order."""
    both = np.vstack([good, bad])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    good, bad = (good - centre) / scale, (bad - centre) / scale
    rng = np.random.default_rng(SEED)
    total = min(pairs, len(good) * len(bad))
    better = rng.permutation(np.arange(total) % len(good))
    worse = rng.permutation(np.arange(total) % len(bad))
    apart = good[better] - bad[worse]
    w = np.zeros(apart.shape[1])
    for _ in range(25):
        wrong = 1 / (1 + np.exp(np.clip(apart @ w, -40, 40)))
        gradient = -apart.T @ wrong / total + 1e-3 * w
        curve = (apart * (wrong * (1 - wrong))[:, None]).T @ apart / total
        w = w - np.linalg.solve(curve + 1e-3 * np.eye(len(w)), gradient)
    scores = np.concatenate((good @ w, bad @ w))
    mass = np.concatenate(
        (np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad)))
    )
    order = np.argsort(scores, kind="stable")
    at = int(np.searchsorted(np.cumsum(mass[order]), bad_share - 1e-9))
    after = min(at + 1, len(order) - 1)
    threshold = (scores[order[at]] + scores[order[after]]) / 2
    return Ranking(centre, scale, w, float(threshold))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking | None:
    """Learns from labelled rows outside the held-out fold; None without both labels.

    Labels other than 0 and 1, and NULL ids, are left aside. The sample of labels is broadcast: it
    has about ``sample`` rows of each. Of their documents, an eighth more at most of each label
    are learned from, however often an id is repeated.
    """
    known = labels.where(
        (fold(F.col("doc_id"), FOLDS) != HELD_OUT)
        & F.col("doc_id").isNotNull()
        & F.col("quality").isin(0, 1)
    ).select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("quality") == 1, min(1.0, sample / counts[1])).otherwise(
        min(1.0, sample / counts[0])
    )
    drawn = known.where(
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) < share * (1 << 20)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(text.as_py()).tobytes() for text in batch["text"]]
            yield pa.record_batch(
                {"quality": batch["quality"], "features": pa.array(vectors, pa.binary())}
            )

    first = Window.partitionBy("quality").orderBy("_key", "_text_key")
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")
        .select(
            "quality",
            "text",
            F.xxhash64(F.lit(SEED), "doc_id").alias("_key"),
            F.xxhash64(F.lit(SEED), "text").alias("_text_key"),
        )
        .withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") <= sample + sample // 8)
        .select("quality", "text")
        .transform(shipped)
        .mapInArrow(run, "quality int, features binary")
        .collect()
    )
    found = {
        label: [
            np.frombuffer(f) for f in sorted(bytes(r["features"]) for r in rows if r["quality"] == label)
        ]
        for label in (0, 1)
    }
    if not found[0] or not found[1]:
        return None
    bad_share = counts[0] / (counts[0] + counts[1])
    return fit_ranking(np.stack(found[1]), np.stack(found[0]), bad_share)


NAMES = ("score", "predicted")


def score(docs: DataFrame, model: Ranking | None, names: tuple[str, str] = NAMES) -> DataFrame:
    """``docs`` with a score and the label it predicts; columns of those ``names`` are replaced.

    Every text gets a score; NULL counts as empty. Without a model all have 0.5.
    """
    kept = docs.select(*without(docs, names))
    schema = StructType([*kept.schema, StructField(names[0], DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if model and batch.num_rows:
                scores = model.score(np.stack([features(t.as_py()) for t in batch["text"]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, names[0]],
            )

    scored = kept.transform(shipped).mapInArrow(run, schema)
    return scored.withColumn(names[1], F.when(F.col(names[0]) >= 0.5, 1).otherwise(0))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, equal texts alike.

    Only the text is looked at for a score. An empty table gives no rows; columns besides
    doc_id and text are ignored.
    """
    named = docs.select("doc_id", "text")
    return score(named, fit(named, labels, sample)).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        "predicted",
    )
