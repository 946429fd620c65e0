"""Periodic runs of words, by longest common extensions over a difference cover.

A run of period q and at least four periods holds two equal places q apart on a grid of step 3q,
and the common extensions of those two places, to the right and to the left, are the whole run.
The grids of all periods are harmonic: n/3 + n/6 + n/9 + ... places for n words.

Common extensions: compare a few words until both places, moved on together, are in the cover
(never more than ``COVER_SIZE`` steps); there the sorted sampled suffixes and a sparse table of
least common prefixes give the rest. Most places differ before that. Many documents are worked on
as one array of word numbers, parted by numbers that occur once, so nothing extends past a text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybrook.llm.common import shipped

#: A perfect difference cover, every difference modulo 31 once.
COVER_SIZE = 31
COVER = (0, 1, 3, 8, 12, 18)
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Texts are worked on together up to so many words; a longer text is alone.
WORDS_A_BATCH = 1 << 16
PAIRS_A_TIME = 1 << 20


def _moves() -> np.ndarray:
    """For places i, j modulo the cover's size: the least step that brings both into the cover."""
    members = np.zeros(COVER_SIZE, bool)
    members[list(COVER)] = True
    moves = np.full((COVER_SIZE, COVER_SIZE), -1, np.int64)
    at = np.arange(COVER_SIZE)
    for step in range(COVER_SIZE):
        sampled = members[(at + step) % COVER_SIZE]
        moves[(moves < 0) & sampled[:, None] & sampled[None, :]] = step
    return moves


MOVES = _moves()


class Extensions:
    """Longest common extensions to the right of pairs of places in ``values``."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.built = False

    def _build(self) -> None:
        n = len(self.values)
        residue = np.full(COVER_SIZE, -1, np.int64)
        residue[list(COVER)] = np.arange(len(COVER))
        # Sampled places, those of one residue together, so that +COVER_SIZE is the next one.
        each = [np.arange(r, n, COVER_SIZE) for r in COVER]
        places = np.concatenate(each)
        starts = np.cumsum([0, *[len(e) for e in each]])
        self.slot = lambda at: starts[residue[at % COVER_SIZE]] + at // COVER_SIZE
        count = len(places)
        following = np.arange(1, count + 1)
        following[starts[1:][starts[1:] > 0] - 1] = count

        # Blocks of COVER_SIZE words in the order of their bytes; padding is below all words.
        padded = np.concatenate([self.values + 1, np.zeros(COVER_SIZE, np.int64)])
        padded = padded.astype(np.int32 if padded.max() < 1 << 31 else np.int64)
        blocks = np.lib.stride_tricks.sliding_window_view(padded, COVER_SIZE)[places]
        as_bytes = blocks.view(f"V{blocks.itemsize * COVER_SIZE}").ravel()
        ranks, steps = [np.unique(as_bytes, return_inverse=True)[1]], [following]
        # Doubling: each round compares twice as many blocks; 0 stands for what is beyond the end.
        while ranks[-1].max() < count - 1:
            rank, step = ranks[-1], steps[-1]
            ahead = np.concatenate([rank + 1, [0]])[step]
            ranks.append(np.unique(rank * (count + 1) + ahead, return_inverse=True)[1])
            steps.append(np.concatenate([step, [count]])[step])
        self.rank = ranks[-1]
        order = np.empty(count, np.int64)
        order[self.rank] = np.arange(count)

        # Common prefixes of neighbours: as many whole blocks as have equal ranks, then words.
        # One that comes to the end is at ``count``, and equals nothing there.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            rank = np.append(ranks[level], -1)
            same = rank[a] == rank[b]
            common[same] += COVER_SIZE << level
            a[same], b[same] = steps[level][a[same]], steps[level][b[same]]
        blocks = np.concatenate([blocks, np.zeros_like(blocks[:1])])
        differ = blocks[a] != blocks[b]
        common += np.argmax(differ, axis=1)
        self.table = self._sparse(common)
        self.built = True

    @staticmethod
    def _sparse(common: np.ndarray) -> list[np.ndarray]:
        table = [common]
        width = 1
        while 2 * width <= len(common):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of sampled suffixes, by range minimum over the sorted ones."""
        if not self.built:
            self._build()
        ra, rb = self.rank[self.slot(a)], self.rank[self.slot(b)]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        power = np.frexp(np.maximum(high - low, 1).astype(np.float64))[1] - 1
        found = np.empty(len(a), np.int64)
        for k in np.unique(power):
            chosen = power == k
            row = self.table[k]
            found[chosen] = np.minimum(row[low[chosen]], row[high[chosen] - (1 << int(k))])
        return found

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are the same (``a < b`` in each pair)."""
        values, n = self.values, len(self.values)
        steps = MOVES[a % COVER_SIZE, b % COVER_SIZE]
        found = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        for done in range(COVER_SIZE):
            open_ = open_[steps[open_] > done]
            if not len(open_):
                break
            ahead = b[open_] + done
            same = (ahead < n) & (values[a[open_] + done] == values[np.minimum(ahead, n - 1)])
            open_ = open_[same]
            found[open_] = done + 1
        synced = np.flatnonzero((found == steps) & (b + steps < n))
        if len(synced):
            move = steps[synced]
            there, other = a[synced] + move, b[synced] + move
            # Where the first words differ, no suffixes need to be sorted.
            equal = values[there] == values[other]
            rest = np.flatnonzero(equal)
            if len(rest):
                found[synced[rest]] += self._sampled(there[rest], other[rest])
        return found


def _grids(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to look at, in portions of about ``PAIRS_A_TIME``."""
    most = lengths // LEAST_PERIODS
    texts = np.repeat(np.arange(len(starts)), most)
    periods = np.arange(len(texts)) - np.repeat(np.cumsum(most) - most, most) + 1
    # The last place whose partner is inside the text.
    counts = (lengths[texts] - 1 - periods) // ((LEAST_PERIODS - 1) * periods) + 1
    before = np.cumsum(counts)
    first = 0
    while first < len(texts):
        base = before[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(before, base + PAIRS_A_TIME, "right")))
        n = counts[first:last]
        q = np.repeat(periods[first:last], n)
        nth = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[texts[first:last]], n) + nth * (LEAST_PERIODS - 1) * q, q
        first = last


def find_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of start, length, period in ``values``, by start, then period.

    ``values`` holds texts of ``lengths`` words at ``starts``, each followed by a value that
    occurs nowhere else.
    """
    n = len(values)
    ahead, behind = Extensions(values), Extensions(values[::-1].copy())
    found = []
    for at, period in _grids(starts, lengths):
        same = values[at] == values[at + period]
        at, period = at[same], period[same]
        right = ahead.right(at, at + period)
        # To the left of a place, not counting it: to the right of its mirror's next one.
        left = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(at > 0)
        mirror = n - at[inner]
        left[inner] = behind.right(mirror - period[inner], mirror)
        enough = right + left >= (LEAST_PERIODS - 1) * period
        begin = (at - left)[enough]
        length = (left + right + period)[enough]
        found.append(np.stack([begin, length, period[enough]], axis=1))
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= LEAST_WORDS]
    # Multiples of the smallest period have the same extent.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten, by its id's CRC-32, goes on periodically from some word."""
    code = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if code % 10 or not n:
        return words
    g = code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    repeats = -(-(n - a) // p)
    return words[:a] + (unit * repeats)[: n - a]


def _digest(doc_id, words: list[bytes], runs: np.ndarray) -> tuple:
    """The result's columns; ``runs`` are those of this text, from its first word on."""
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs.tolist())
    best = (None, None, None, None)
    kept = words
    if len(runs):
        chosen = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]]
        start, length, period = (int(value) for value in chosen)
        best = (start, length, period, 1000 * length // period)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        dropped = np.cumsum(change)[:-1] > 0
        kept = [word for word, gone in zip(words, dropped.tolist()) if not gone]
    return (
        doc_id,
        len(runs),
        *best,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def _runs_of(texts: list[tuple]) -> Iterator[tuple]:
    """Result rows of (doc_id, words) worked on as one array."""
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(word, len(numbers)) for word in words] for _, words in texts]
    lengths = np.array([len(words) for words in coded], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    values = np.empty(int((lengths + 1).sum()), np.int64)
    for no, (start, words) in enumerate(zip(starts.tolist(), coded)):
        values[start : start + len(words)] = words
        values[start + len(words)] = len(numbers) + no
    runs = find_runs(values, starts, lengths)
    edges = np.searchsorted(runs[:, 0], [*starts.tolist(), len(values)])
    for no, (doc_id, words) in enumerate(texts):
        own = runs[edges[no] : edges[no + 1]] - np.array([starts[no], 0, 0])
        yield _digest(doc_id, words, own)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of at least four periods and six words in each text, and the text without repeats.

    NULL and empty texts have no words and no runs; a NULL id counts as an empty text where ids
    are hashed; repeated rows are documents of their own; no documents give no rows; columns
    besides doc_id and text are ignored. A very long text takes memory in proportion to its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(texts: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*_runs_of(texts)))
            arrays = [pa.array(values, field.type) for values, field in zip(columns, SCHEMA)]
            return pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)

        waiting, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_id, text = doc_id.as_py(), text.as_py()
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                waiting.append((doc_id, made_periodic(words, doc_id)))
                held += len(words) + 1
                if held >= WORDS_A_BATCH:
                    yield rows(waiting)
                    waiting, held = [], 0
        if waiting:
            yield rows(waiting)

    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return named.transform(shipped).mapInArrow(
        run,
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
        " runs_sha256 string, collapsed_sha256 string",
    )
