"""Language identification in two steps: the family first, then the language within it.

A text is a bag of hashed letter n-grams. Linear support vector machines, one for each pair,
vote on the family; those of the chosen family's languages vote on the language. Margins are
turned into probabilities, coupled over all pairs, and a text's score is the product of both steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tallybrook.llm.common import fold, settled, shipped, without

#: Hashed features of a text.
FEATURES = 2048
#: Rows that the machines are fitted on, over all languages: a sample of the learning rows, as
#: many of each language, of which there are at least one of each.
SAMPLE = 3200
#: Counts of up to so many languages are sent to every task; more are joined.
MOST_SENT = 100_000
SEED = 5
UNDETERMINED = "und"
FOLDS, HELD_OUT = 3, 1

#: ISO 639-1 codes by family. Codes in none are dealt to families of their own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "mr", "ne", "pa", "gu", "ur", "sa"),
    "semitic": ("ar", "he", "am", "mt"),
}

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_CHUNK = 1 << 20


def families_of(languages: Iterable[str]) -> dict[str, str]:
    """The family of each language. k languages of no known family make about root k families."""
    known = {code: family for family, codes in FAMILIES.items() for code in codes}
    others = sorted(set(languages) - known.keys())
    size = isqrt(max(len(others) - 1, 0)) + 1
    dealt = {language: f"unlisted-{i // size}" for i, language in enumerate(others)}
    if size == 1:
        dealt = {language: language for language in others}
    return {language: known.get(language) or dealt[language] for language in languages}


def has_letter(text: str | None) -> bool:
    return bool(text) and next(filter(str.isalpha, text), None) is not None


def features(text: str) -> np.ndarray:
    """Hashed 2- and 3-grams of letters, square roots of their counts, of length 1."""
    codes = b" " + text.encode("utf-8", "surrogatepass").translate(_LETTERS)
    counts = np.zeros(FEATURES)
    for start in range(0, len(codes), _CHUNK):
        # Two bytes more than n-grams begin in a chunk, so that none is lost between chunks.
        part = np.frombuffer(codes[start : start + _CHUNK + 2], np.uint8).astype(np.uint32)
        pairs = part[:-1] << np.uint32(8) | part[1:]
        triples = pairs[:-1] << np.uint32(8) | part[2:]
        hashed = np.concatenate(
            (pairs[:_CHUNK] * np.uint32(2654435761), triples[:_CHUNK] * np.uint32(2246822519))
        )
        counts += np.bincount(hashed >> np.uint32(21), minlength=FEATURES)
    weights = np.sqrt(counts)
    return weights / max(np.linalg.norm(weights), 1e-12)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Machine:
    """A linear machine between two classes, with the line that makes its margin a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * (x @ self.weights + self.bias) + self.offset)


def fit_machine(x: np.ndarray, first: np.ndarray, penalty: float = 1e-4) -> Machine:
    """Squared hinge loss by accelerated gradient steps, classes weighted alike."""
    sign = np.where(first, 1.0, -1.0)
    share = np.where(first, 0.5 / max(first.sum(), 1), 0.5 / max((~first).sum(), 1))
    extended = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    w = ahead = np.zeros(extended.shape[1])
    step = 1.0 / (4.0 + penalty)
    for i in range(1, 151):
        slack = np.maximum(0, 1 - sign * (extended @ ahead))
        gradient = -2 * extended.T @ (share * sign * slack) + penalty * ahead
        following = ahead - step * gradient
        ahead = following + (i - 1) / (i + 2) * (following - w)
        w = following
    margin = extended @ w
    line = np.array([1.0, 0.0])
    both = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(30):
        p = _sigmoid(both @ line)
        gradient = both.T @ (share * (p - first)) + 1e-4 * (line - [1.0, 0.0])
        curve = (both * (share * p * (1 - p))[:, None]).T @ both + 1e-4 * np.eye(2)
        line = line - np.linalg.solve(curve, gradient)
    return Machine(w[:-1], float(w[-1]), float(line[0]), float(line[1]))


@dataclass
class Vote:
    """One machine for each pair of classes, whose probabilities are coupled to one for each class."""

    classes: list[str]
    machines: dict[tuple[int, int], Machine]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """1 for a class that all its machines are certain of, however many classes there are.

        The odds against a class are the sum of its odds against each other class.
        """
        against = np.zeros((len(x), len(self.classes)))
        for (a, b), machine in self.machines.items():
            p = machine.probability(x)
            against[:, a] += (1 - p) / p
            against[:, b] += p / np.maximum(1 - p, 1e-17)
        coupled = 1 / (1 + against)
        return coupled / coupled.sum(axis=1, keepdims=True)


@dataclass
class Model:
    families: Vote
    within: dict[str, Vote]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        families = self.families.probabilities(x)
        chosen = families.argmax(axis=1)
        names, scores = [""] * len(x), families.max(axis=1)
        for no, family in enumerate(self.families.classes):
            rows = np.flatnonzero(chosen == no)
            if len(rows):
                p = self.within[family].probabilities(x[rows])
                best = p.argmax(axis=1)
                scores[rows] *= p.max(axis=1)
                for row, b in zip(rows, best):
                    names[row] = self.within[family].classes[b]
        return names, scores


def learning_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang and text of at most ``sample`` learning rows, as many of each language.

    Those of least hash; a language with fewer rows gives all. Rows of one id, or without any,
    are told apart by their text, and equal rows count one by one.
    """
    rows = docs.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    key = F.xxhash64(F.lit(SEED), "doc_id")
    counted = rows.groupBy("lang").agg(F.approx_count_distinct(key).alias("_ids"))
    counts = settled(counted, "language-counts")
    languages = counts.count()
    each = max(1, sample // max(languages, 1))
    keyed = rows.select(
        "lang",
        "text",
        F.pmod(key, F.lit(1 << 20)).alias("_key"),
        F.xxhash64(F.lit(SEED), "text").alias("_text_key"),
    )
    # About twice as many ids and some more, so that there are enough; then exactly as many rows.
    likely = F.col("_key") * F.col("_ids") < (2 * each + 20) * (1 << 20)
    # Sent to every task while there are few: no text is shuffled but the sample's.
    sent = F.broadcast(counts) if languages <= MOST_SENT else counts
    drawn = keyed.join(sent, "lang").where(likely)
    first = Window.partitionBy("lang").orderBy("_key", "_text_key")
    return drawn.withColumn("_nth", F.row_number().over(first)).where(
        F.col("_nth") <= each
    ).select("lang", "text")


def _votes(languages: list[str]) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """Families, and each machine as (vote, first class, second class); vote "" is on families."""
    families = families_of(languages)
    machines = [("", a, b) for a, b in combinations(sorted(set(families.values())), 2)]
    for family in sorted(set(families.values())):
        own = sorted(language for language in languages if families[language] == family)
        machines += [(family, a, b) for a, b in combinations(own, 2)]
    return families, machines


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Machines from the texts and languages of the learning rows; None if there are none.

    Each machine is fitted in a task, on the sample's rows of its two classes.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (language.as_py(), features(text.as_py()).astype(np.float32).tobytes())
                for language, text in zip(batch["lang"], batch["text"])
                if has_letter(text.as_py())
            ]
            languages, values = zip(*found) if found else ((), ())
            yield pa.record_batch(
                {
                    "lang": pa.array(languages, pa.string()),
                    "features": pa.array(values, pa.binary()),
                }
            )

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("lang", "ascending"), ("features", "ascending")])
        x = np.stack([np.frombuffer(f.as_py(), np.float32) for f in rows["features"]])
        first = np.array(rows["is_first"].to_pylist())
        machine = fit_machine(x, first)
        values = [*machine.weights, machine.bias, machine.slope, machine.offset]
        return pa.table(
            {
                "machine": rows["machine"].slice(0, 1),
                "values": pa.array([np.array(values, np.float64).tobytes()], pa.binary()),
            }
        )

    spark = docs.sparkSession
    drawn = learning_sample(docs, sample).transform(shipped)
    rows = settled(drawn.mapInArrow(vectors, "lang string, features binary"), "language-sample")
    languages = sorted(row["lang"] for row in rows.select("lang").distinct().collect())
    if not languages:
        return None
    families, machines = _votes(languages)
    sides = [
        (no, language, side == a)
        for no, (vote, a, b) in enumerate(machines)
        for language in languages
        for side in [language if vote else families[language]]
        if side in (a, b) and (not vote or families[language] == vote)
    ]
    found: dict[int, np.ndarray] = {}
    if machines:
        dealt = spark.createDataFrame(sides, "machine int, lang string, is_first boolean")
        trained = rows.join(dealt, "lang").groupBy("machine")
        for row in trained.applyInArrow(fitted, "machine int, values binary").toLocalIterator():
            found[row["machine"]] = np.frombuffer(row["values"])

    def vote_on(name: str, classes: list[str]) -> Vote:
        place = {label: i for i, label in enumerate(classes)}
        return Vote(
            classes,
            {
                (place[a], place[b]): Machine(found[no][:-3], *found[no][-3:].tolist())
                for no, (vote, a, b) in enumerate(machines)
                if vote == name
            },
        )

    names = sorted(set(families.values()))
    within = {f: sorted(lang for lang in languages if families[lang] == f) for f in names}
    return Model(vote_on("", names), {f: vote_on(f, own) for f, own in within.items()})


NAMES = ("lang_pred", "score")


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = NAMES) -> DataFrame:
    """``docs`` with a language and its score; columns of those ``names`` are replaced.

    NULL texts and those without a letter are undetermined, with score 0; so is every text if
    there was nothing to learn from. Only the text is looked at.
    """
    kept = docs.select(*without(docs, names))
    added = [StructField(names[0], StringType()), StructField(names[1], DoubleType())]
    schema = StructType([*kept.schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            column = batch["text"]
            for start in range(0, batch.num_rows if model else 0, 1024):
                texts = column.slice(start, 1024).to_pylist()
                rows = [i for i, text in enumerate(texts) if has_letter(text)]
                if rows:
                    x = np.stack([features(texts[i]) for i in rows])
                    found, score = model.predict(x)
                    for i, name, s in zip(rows, found, score):
                        languages[start + i], scores[start + i] = name, s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores)],
                names=[*batch.schema.names, *names],
            )

    return kept.transform(shipped).mapInArrow(run, schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, equal rows alike.

    Learns from rows outside the held-out fold that have a language; doc_id, source and lang are
    no inputs of a prediction. An empty table gives no rows; other columns are ignored.
    """
    named = docs.select("doc_id", "lang", "text")
    predicted = predict(named.select("doc_id", "text"), fit(named, sample))
    return predicted.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
    )
