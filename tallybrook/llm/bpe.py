"""Byte-level BPE by recursive queries in DuckDB, one database per Spark task.

A text is cut into pieces by a pattern. The distinct pieces that are no token themselves become
rows of piece, position and token. Each round of the recursion joins neighbours with the merge
table and contracts every piece's leftmost pair of least rank, until no pair is left. An ordered
aggregation of the tokens' bytes decodes the ids again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import shipped

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Bytes of pieces in one recursive query, and characters of text cut into pieces at a time.
QUERY_BYTES = 1 << 18
TEXT_CHARS = 1 << 20
#: Pieces that a task remembers, twice over: the newer and the older half.
REMEMBERED = 350_000
#: Longer pieces contract many pairs a round, in queries of some rounds each.
LONG_PIECE = 64
ROUNDS = 12

# Keys are piece << 32 | position; a candidate is token << 32 | position, so the least one is the
# leftmost pair of least rank (a token's number is its rank).
NEIGHBOURS = """
  n AS (SELECT k, tok, lead(k) OVER {order} AS nk, lead(tok) OVER {order} AS ntok
        FROM s WHERE NOT done {also}),
  p AS (SELECT n.k, n.tok, m.made, m.made << 32 | (n.k & 4294967295) AS candidate
        FROM n LEFT JOIN merges m
        ON m.pair = CASE WHEN n.nk < n.k THEN error('rows out of order')
                         WHEN n.k >> 32 = n.nk >> 32 THEN n.tok << 20 | n.ntok END),
  b AS (SELECT k >> 32 AS piece, min(candidate) AS best FROM p GROUP BY ALL)
"""

# One thread keeps rows in the order of ``start``, so windows needn't sort; a row out of order is
# an error, and the query then runs with sorting windows.
CONTRACT_BY = """
WITH RECURSIVE s(k, tok, done) AS (
  SELECT k, tok, false FROM start
  UNION ALL
  (WITH {neighbours},
   h AS (SELECT p.k, p.tok, p.made, b.best, coalesce(p.candidate = b.best, false) AS hit
         FROM p LEFT JOIN b ON b.piece = p.k >> 32),
   x AS (SELECT *, lag(hit) OVER {order} AS gone FROM h)
   SELECT k, CASE WHEN hit THEN made ELSE tok END, best IS NULL FROM x WHERE gone IS NOT true)
)
SELECT k, tok, done FROM s WHERE done
"""
CONTRACT, CONTRACT_SORTED = (
    CONTRACT_BY.format(neighbours=NEIGHBOURS.format(order=order, also=""), order=order)
    for order in ("()", "(ORDER BY k)")
)

# The same for long pieces. All pairs of the least rank are contracted from the left, each second
# one in a run of overlapping pairs, up to the first whose new token makes a pair of lower rank
# with a neighbour: so the result is the one of contracting one after the other.
CONTRACT_LONG = f"""
WITH RECURSIVE s(k, tok, done, round) AS (
  SELECT k, tok, false, 0 FROM start
  UNION ALL
  (WITH {NEIGHBOURS.format(order="(ORDER BY k)", also="AND round < " + str(ROUNDS))},
   h AS (SELECT p.k, p.tok, p.made, b.best, coalesce(p.made = b.best >> 32, false) AS fits,
                row_number() OVER (ORDER BY p.k) AS nth
         FROM p JOIN b ON b.piece = p.k >> 32),
   r AS (SELECT *, nth - row_number() OVER (PARTITION BY k >> 32, fits ORDER BY k) AS run FROM h),
   t AS (SELECT *, fits AND row_number() OVER (PARTITION BY k >> 32, fits, run ORDER BY k) % 2 = 1
                AS hit FROM r),
   c AS (SELECT *, lag(hit) OVER o AS gone, lag(k) OVER o AS gone_with,
                CASE WHEN lag(hit, 2) OVER o THEN made ELSE lag(tok) OVER o END AS left_tok,
                lead(tok, 2) OVER o AS right_tok, lag(k >> 32) OVER o AS left_piece,
                lead(k >> 32, 2) OVER o AS right_piece
         FROM t WINDOW o AS (ORDER BY k)),
   d AS (SELECT c.*, hit AND least(l.made, a.made) < c.made AS lowers
         FROM c
         LEFT JOIN merges l ON l.pair =
              CASE WHEN hit AND left_piece = c.k >> 32 THEN left_tok << 20 | c.made END
         LEFT JOIN merges a ON a.pair =
              CASE WHEN hit AND right_piece = c.k >> 32 THEN c.made << 20 | right_tok END),
   e AS (SELECT *, coalesce(min(CASE WHEN lowers THEN k END) OVER (PARTITION BY k >> 32),
                            9223372036854775807) AS stop FROM d)
   SELECT k, CASE WHEN hit AND k <= stop THEN made ELSE tok END, best IS NULL,
          (SELECT max(round) + 1 FROM s)
   FROM e WHERE NOT (coalesce(gone, false) AND gone_with <= stop))
)
SELECT k, tok, done FROM s WHERE done OR round = {ROUNDS}
"""

# A piece's tokens in order. Aggregates take the rows as they come: sorted before, or, should
# that fail to decode to the piece, sorted by the aggregate itself.
DECODE_BY = """
SELECT piece, string_agg(number, ',' {each}) AS ids,
       from_hex(string_agg(bytes, '' {each})) AS decoded
FROM (SELECT k, k >> 32 AS piece, v.number, v.bytes
      FROM codes JOIN vocabulary v ON v.id = codes.tok ORDER BY k)
GROUP BY piece ORDER BY piece
"""
DECODE, DECODE_SORTED = (DECODE_BY.format(each=each) for each in ("", "ORDER BY k"))


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every pair of tokens whose bytes together are a token."""
    pairs, made = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.append(left << 20 | right)
                made.append(rank)
    return pa.table({"pair": pa.array(pairs, pa.int64()), "made": pa.array(made, pa.int64())})


class Remembered:
    """Pieces by number, and by that number their ids and the bytes that they decode to.

    Both are Arrow arrays: objects of Python's own would take a multiple of their bytes.
    """

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.decoded = pa.array([], pa.string()), pa.array([], pa.binary())

    def add(self, found: list[tuple[list[str], pa.Array, pa.Array]]) -> None:
        for pieces, _, _ in found:
            self.numbers.update(zip(pieces, range(len(self.numbers), len(self.numbers) + len(pieces))))
        self.ids = pa.concat_arrays([self.ids, *[ids for _, ids, _ in found]])
        self.decoded = pa.concat_arrays([self.decoded, *[decoded for _, _, decoded in found]])

    def of(self, pieces: list[str]) -> tuple[pa.Array, pa.Array]:
        at = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        return self.ids.take(pa.array(at)), self.decoded.take(pa.array(at))


class Codec:
    """A vocabulary with its merge table in a database of this process."""

    def __init__(self, path: str, memory: str = "256MB") -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        self.db.register("_merges", merge_table(self.ranks))
        self.db.execute("CREATE TABLE merges AS FROM _merges")
        vocabulary = {
            "id": list(self.ranks.values()),
            "number": list(map(str, self.ranks.values())),
            "bytes": [token.hex() for token in self.ranks],
        }
        self.db.register("_vocabulary", pa.table(vocabulary))
        self.db.execute("CREATE TABLE vocabulary AS FROM _vocabulary")
        self.newer, self.older = Remembered(), Remembered()

    def _run(self, sql: str, start: pa.Table) -> pa.Table:
        self.db.register("start", start)
        return self.db.sql(sql).to_arrow_table()

    def _codes(self, pieces: list[bytes]) -> pa.Table:
        """Rows of key and token for pieces that are no token themselves."""
        lengths = np.array([len(piece) for piece in pieces], np.int64)
        starts = np.cumsum(lengths) - lengths
        codes = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        at = np.arange(len(codes)) - np.repeat(starts, lengths)
        keys = np.repeat(np.arange(len(pieces)), lengths) << 32 | at
        start = pa.table({"k": keys, "tok": codes})
        if lengths.max() <= LONG_PIECE:
            try:
                return self._run(CONTRACT, start)
            except duckdb.Error as error:
                if "rows out of order" not in str(error):
                    raise
                return self._run(CONTRACT_SORTED, start)
        found = []
        while start.num_rows:
            rows = self._run(CONTRACT_LONG, start)
            done = rows["done"].to_numpy(zero_copy_only=False)
            found.append(rows.filter(pa.array(done)))
            start = rows.filter(pa.array(~done))
        return pa.concat_tables(found)

    def _query(self, pieces: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded bytes of each piece."""
        self.db.register("codes", self._codes(pieces))
        wanted = pa.array(pieces, pa.binary())
        for sql in (DECODE, DECODE_SORTED):
            rows = self.db.sql(sql).to_arrow_table()
            decoded = pa.concat_arrays(rows["decoded"].cast(pa.binary()).chunks)
            if decoded.equals(wanted):
                break
        return pa.concat_arrays(rows["ids"].cast(pa.string()).chunks), decoded

    def _learn(self, texts: Iterable[str]) -> None:
        """Encode pieces that aren't remembered, so many bytes a query, long ones apart."""
        tokens, short, long = [], [], []
        for text in texts:
            piece = text.encode("utf-8", "surrogatepass")
            if piece in self.ranks:
                tokens.append((text, piece))
            else:
                (short if len(piece) <= LONG_PIECE else long).append((text, piece))
        found = []
        if tokens:
            part, pieces = zip(*tokens)
            ids = pa.array([str(self.ranks[piece]) for piece in pieces], pa.string())
            found.append((part, ids, pa.array(pieces, pa.binary())))
        for encoded in (short, long):
            start, size = 0, 0
            for i, (_, piece) in enumerate(encoded):
                size += len(piece)
                if size >= QUERY_BYTES or i + 1 == len(encoded):
                    part, pieces = zip(*encoded[start : i + 1])
                    found.append((part, *self._query(list(pieces))))
                    start, size = i + 1, 0
        self.newer.add(found)

    def forget(self) -> None:
        """Free what is remembered: after its task a worker may go on with other work."""
        self.newer, self.older = Remembered(), Remembered()
        pa.default_memory_pool().release_unused()

    def _remembered(self, pieces: list[str]) -> tuple[pa.Array, pa.Array]:
        if len(self.newer.numbers) > REMEMBERED:
            self.newer, self.older = Remembered(), self.newer
        new = [piece for piece in pieces if piece not in self.newer.numbers]
        known = [piece for piece in new if piece in self.older.numbers]
        self.newer.add([(known, *self.older.of(known))])
        self._learn([piece for piece in new if piece not in self.newer.numbers])
        return self.newer.of(pieces)

    def encode(self, texts: list[list[str]]) -> tuple[pa.Array, pa.Array]:
        """For each list of pieces the ids, joined by commas, and the bytes they decode to."""
        counts = [0, *map(len, texts)]
        pieces = pa.array(chain.from_iterable(texts), pa.string(), size=sum(counts))
        coded = pieces.dictionary_encode()
        offsets = pa.array(np.cumsum(counts), pa.int32())
        ids, decoded = (
            pa.ListArray.from_arrays(offsets, of_piece.take(coded.indices))
            for of_piece in self._remembered(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        )
        return pc.binary_join(ids, ","), pc.binary_join(decoded, b"")


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    """One per worker process."""
    return Codec(path)


@lru_cache(maxsize=2)
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def encode_decode(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id, ``ids`` (decimal, joined by commas) and ``decoded`` (bytes) of whole texts.

    NULL and empty texts have no ids. Repeated rows are encoded each; an empty table gives no
    rows; columns besides doc_id and text are ignored. The vocabulary file is one of the public
    tokenizers' and read where the tasks run.
    """
    named = docs.select("doc_id", "text")
    kind = named.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, cut = _codec(public_tokenizers.path(vocabulary)), _pattern(pattern)

        def encoded(doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            ids, decoded = codec.encode([cut.findall(text) for text in texts])
            arrays = [doc_ids, ids, decoded]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"])

        for batch in batches:
            start, size, texts = 0, 0, []
            for i, text in enumerate(batch["text"]):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= TEXT_CHARS or i + 1 == batch.num_rows:
                    yield encoded(batch["doc_id"].slice(start, len(texts)), texts)
                    start, size, texts = i + 1, 0, []
        codec.forget()

    return named.transform(shipped).mapInArrow(run, f"doc_id {kind}, ids string, decoded binary")


def code_digest(encoded: DataFrame, *more: str) -> DataFrame:
    """Counts and hashes of what ``encode_decode`` returns, and ``more`` of its columns."""
    commas = F.length("ids") - F.length(F.replace("ids", F.lit(","), F.lit("")))
    return encoded.select(
        "doc_id",
        F.when(F.col("ids") == "", 0).otherwise(commas + 1).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
