"""Approximate nearest neighbours along shifted space-filling curves.

Vectors are projected at random to a few dimensions, shifted at random inside a cube and put in
order along its Hilbert curve; every curve has its own projection and shift. Near vectors are
often near on some curve. A query looks at the windows around its places on all curves; what
the windows find is merged and ranked by the cosines of the original vectors.

Recall is that of the share of rows that the windows see: vectors without any structure need
``CURVES * 2 * REACH`` well above 1, clustered ones far less. REACH is a share of the rows, so
recall is alike at every size; cost is that of the queries times the rows they look at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import settled, shipped, with_starts

CURVES = 16
#: Rows that a window sees on either side, as a share of all and at least.
REACH, LEAST_REACH = 0.05, 64
DIMENSIONS, BITS = 8, 7
#: Rows that are compared at a time; a window is some of these blocks.
BLOCK = 1024
SEED = 61


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points with integer coordinates (points x dimensions).

    Coordinates become transposed places by Gray code, one bit and dimension at a time, and the
    bits are then interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    one, dimensions = np.uint64(1), len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for axis in range(dimensions):
            inverted = (x[axis] & bit) != 0
            swapped = np.where(inverted, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inverted, low, swapped)
            x[axis] ^= swapped
    for axis in range(1, dimensions):
        x[axis] ^= x[axis - 1]
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        set_ = (x[-1] >> np.uint64(level)) & one
        turned ^= set_ * np.uint64((1 << level) - 1)
    x ^= turned
    places = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(dimensions):
            places = places << one | (x[axis] >> np.uint64(level)) & one
    return places.astype(np.int64)


@lru_cache(maxsize=4)
def _curves(count: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Projection and shift of every curve."""
    rng = np.random.default_rng(SEED)
    return [
        (rng.standard_normal((width, DIMENSIONS)), rng.random(DIMENSIONS)) for _ in range(count)
    ]


def places(vectors: np.ndarray, curves: int = CURVES) -> np.ndarray:
    """Places of vectors on all curves (curves x vectors); only directions count."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = []
    for projection, shift in _curves(curves, vectors.shape[1]):
        # A projected coordinate has a spread of about 1: three spreads fill half of the cube.
        inside = np.clip((unit @ projection + 3) / 6, 0, 1)
        cells = (inside + shift) / 2 * (1 << BITS)
        found.append(hilbert(np.minimum(cells, (1 << BITS) - 1).astype(np.int64)))
    return np.stack(found)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part.

    An id, an embedding without NULL, NaN or infinity that isn't all zero, and as many
    components as most embeddings have (of equally many the larger number).
    """
    finite = ~F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    kept = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    widths = kept.groupBy(F.size("embedding").alias("width")).count()
    most = widths.agg(F.max(F.struct("count", "width")).alias("most")).first()["most"]
    return kept.where(F.size("embedding") == (most["width"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _from_bytes(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """node, ``ids`` (the ``keep`` least) and ``vector`` (64-bit floats) of equal vectors.

    Each batch keeps the least ids of its own first, so that a vector that a third of the rows
    share brings few. ``node`` is a hash of the vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            if batch.num_rows:
                vectors = _matrix(batch["embedding"]) + 0.0  # a negative zero is a zero
                for vec_id, vector in zip(batch["vec_id"].to_pylist(), vectors):
                    found.setdefault(vector.tobytes(), []).append(vec_id)
            yield pa.record_batch(
                {
                    "node": pa.array([_node(v) for v in found], pa.int64()),
                    "ids": pa.array([sorted(i)[:keep] for i in found.values()], pa.list_(pa.int64())),
                    "vector": pa.array(list(found), pa.binary()),
                }
            )

    per_batch = rows.select(F.col("vec_id").cast("long"), "embedding").transform(shipped).mapInArrow(
        run, "node long, ids array<long>, vector binary"
    )
    least = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep)
    return per_batch.groupBy("node").agg(least.alias("ids"), F.first("vector").alias("vector"))


def _node(vector: bytes) -> int:
    return xxhash.xxh3_64_intdigest(vector) - (1 << 63)


def query_nodes(rows: DataFrame) -> DataFrame:
    """query_id and the node of its vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch["embedding"]) + 0.0 if batch.num_rows else []
            yield pa.record_batch(
                {
                    "query_id": batch["vec_id"],
                    "node": pa.array([_node(v.tobytes()) for v in vectors], pa.int64()),
                }
            )

    return rows.select(F.col("vec_id").cast("long"), "embedding").transform(shipped).mapInArrow(
        run, "query_id long, node long"
    )


def ranked(nodes: DataFrame, curves: int) -> DataFrame:
    """curve, node and ``rank``, its place among the nodes of that curve.

    Rows are range-partitioned by curve and place and sorted; a row's number in its partition
    and the counts of the partitions before give the rank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            found = places(_from_bytes(batch["vector"]), curves) if count else np.empty((curves, 0))
            yield pa.record_batch(
                {
                    "curve": pa.array(np.repeat(np.arange(curves), count), pa.int32()),
                    "place": pa.array(found.ravel(), pa.int64()),
                    "node": pa.array(np.tile(batch["node"].to_numpy(), curves), pa.int64()),
                }
            )

    placed = nodes.select("node", "vector").transform(shipped).mapInArrow(run, "curve int, place long, node long")
    ordered = placed.repartitionByRange("curve", "place", "node").sortWithinPartitions(
        "curve", "place", "node"
    )
    numbered = settled(
        ordered.select("curve", "node", F.monotonically_increasing_id().alias("row")), "ranked"
    )
    row = numbered.select(
        "curve",
        "node",
        F.shiftright("row", 33).alias("part"),
        F.col("row").bitwiseAND((1 << 33) - 1).alias("at"),
    )
    parts = row.groupBy("curve", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")
    )
    starts = with_starts(parts, ["curve"], "part", "n").drop("n")
    return row.join(starts, ["curve", "part"]).select(
        "curve", "node", (F.col("start") + F.col("at") - F.col("first")).alias("rank")
    )


def _best_in_block(k: int):
    """For each query of a block its ``k`` nearest rows of other nodes, by cosine."""

    def run(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        nodes = group["node"].to_numpy()
        queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        empty = {"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64())}
        if not len(queries) or not len(rows):
            return pa.table({**empty, "score": pa.array([], pa.float64())})
        vectors = _from_bytes(group["vector"])
        norms = np.linalg.norm(vectors, axis=1)
        found = []
        for start in range(0, len(queries), 512):
            part = queries[start : start + 512]
            scores = (vectors[part] @ vectors[rows].T) / np.outer(norms[part], norms[rows])
            scores[nodes[part][:, None] == nodes[rows][None, :]] = -np.inf
            take = min(k, len(rows))
            best = np.argpartition(-scores, take - 1, axis=1)[:, :take]
            # Scores as good as the last one taken belong to it: ties are settled by id later.
            last = np.take_along_axis(scores, best, axis=1).min(axis=1, keepdims=True)
            q, r = np.nonzero((scores >= last) & np.isfinite(scores))
            found.append((nodes[part][q], nodes[rows][r], scores[q, r]))
        q, r, s = map(np.concatenate, zip(*found))
        return pa.table({"query": q, "node": r, "score": s})

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    curves: int = CURVES,
    reach: float = REACH,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each query.

    ``queries`` are rows of ``vectors`` (vec_id, embedding); all others are candidates. Equal
    scores go by the smaller vec_id; equal vectors are compared once and share their result.
    Rows that ``usable`` leaves out take no part, and a query among them has no result. Repeated
    ids count as one. An empty table gives no rows; other columns are ignored.
    """
    rows = usable(vectors)
    nodes = settled(distinct_vectors(rows, k + 1), "vectors")
    asked = settled(
        query_nodes(rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")), "queries"
    )
    window = max(LEAST_REACH, math.ceil(nodes.count() * reach))
    order = ranked(nodes, curves)
    asking = asked.select("node").distinct()
    blocks = order.select("node", "curve", F.expr(f"rank div {BLOCK}").alias("block"))
    first = F.greatest(F.col("rank") - window, F.lit(0))
    windows = order.join(asking, "node").select(
        "node",
        "curve",
        F.explode(
            F.sequence(
                F.floor(first / BLOCK), F.floor((F.col("rank") + window) / BLOCK), F.lit(1)
            )
        ).alias("block"),
    )
    seen = blocks.withColumn("asks", F.lit(False)).unionByName(
        windows.withColumn("asks", F.lit(True))
    )
    compared = (
        seen.join(nodes.select("node", "vector"), "node")
        .groupBy("curve", "block")
        .applyInArrow(_best_in_block(k), "query long, node long, score double")
    )
    found = compared.groupBy("query", "node").agg(F.max("score").alias("score"))
    # A query takes k rows of other nodes at most, so the best k nodes are enough; ties stay.
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    short = found.withColumn("_no", F.rank().over(by_score)).where(F.col("_no") <= k).drop("_no")
    own = asking.select(F.col("node").alias("query"), "node", F.lit(1.0).alias("score"))
    named = short.unionByName(own).join(nodes.select("node", "ids"), "node")
    ids = named.select("query", "score", F.explode("ids").alias("vec_id"))
    results = asked.distinct().join(ids, asked["node"] == ids["query"]).where("vec_id <> query_id")
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    unique = results.select("query_id", "vec_id", "score").distinct()
    return (
        unique.withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
