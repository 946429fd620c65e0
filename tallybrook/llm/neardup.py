"""Near-duplicates by MinHash with tensored banding, every link confirmed on the full sets.

Texts with the same shingle set are one node. A node has two small collections of band hashes;
a table's key is a pair of one from each, so ``bands`` squared tables cost ``2 * bands`` bands of
min-hashes. Two nodes are candidates if they agree on a band of either collection.

A table's bucket may hold thousands of nodes, so its pairs are never listed. Instead:

1. Every node is compared with its bucket's centre, the node whose bands are the most common.
   Links found there already join most of a large group.
2. Let y be a node that is not linked with its centre r, and x another node of that bucket. If x
   and y are linked, their differences from r overlap: with D the size of a symmetric difference,
   disjoint differences mean D(x, y) = D(x, r) + D(y, r), and so a similarity of x and y of at
   most that of y and r. From the sizes follows how large the overlap is at least; prefixes of
   the differences (what r lacks first, in a fixed order) then have an element in common. So
   only nodes that share such an element with a node of another component are still open.
   Each open y is held against the open nodes of its centre, block by block.

Together that decides every candidate pair up to connection. What bands miss is bounded by the
number of bands: at the threshold about one pair in 7,000 with the defaults.
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

from tallybrook.llm.common import settled, shipped, words
from tallybrook.llm.graph import components

#: Min-hashes in a band; a table's key has two bands.
BAND = 3
#: Nodes of a centre that are compared with others at a time, and tasks that share a centre.
BLOCK = 512
SALTS = 32
#: A collection misses a pair at the threshold with this chance.
MISS = 1e-4
SEED = 97
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_AGAIN = np.uint64(0x94D049BB133111EB)
_SHIFT = np.uint64(31)


def bands_for(percent: int, band: int = BAND, miss: float = MISS) -> int:
    """Bands in a collection, so that one at least agrees but for a chance of ``miss``."""
    return max(2, math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** band)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _MIX
    values = (values ^ (values >> _SHIFT)) * _AGAIN
    return values ^ (values >> _SHIFT)


@lru_cache(maxsize=8)
def _odd(count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set of hashed word shingles, ascending. Fewer words than ``width`` are one shingle."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.array([xxhash.xxh3_64_intdigest(word) for word in found], np.uint64)
    width, salt = min(width, len(hashed)), np.uint64(len(hashed) if len(hashed) < width else 0)
    count = len(hashed) - width + 1
    total = np.full(count, salt, np.uint64)
    for i, odd in enumerate(_odd(width, SEED + 1)):
        total += hashed[i : i + count] * odd
    return np.unique(_mixed(total))


def bands(values: np.ndarray, count: int, band: int = BAND) -> np.ndarray:
    """``2 * count`` hashed bands of min-hashes: the first collection and then the second."""
    factors = _odd(2 * count * band, SEED)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 4096):
        part = values[start : start + 4096, None] * factors[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    rows = _mixed(least).reshape(2 * count, band) * _odd(band, SEED + 2)[None, :]
    return _mixed(rows.sum(axis=1) + np.arange(1, 2 * count + 1, dtype=np.uint64))


def node_of(values: np.ndarray) -> int | None:
    """A set's number: 64 bits, so that two of a billion sets meet with a chance of 1 in 37."""
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63) if len(values) else None


def signatures(docs: DataFrame, width: int, count: int) -> DataFrame:
    """doc_id, text_key (a hash), n_shingles, node and keys (its bands).

    node is NULL for texts without words.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.int64()),
            ("n_shingles", pa.int64()),
            ("node", pa.int64()),
            ("keys", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, keys = [], [], []
            for text in batch["text"]:
                values = shingles(text.as_py(), width)
                sizes.append(len(values))
                nodes.append(node_of(values))
                keys.append(bands(values, count).view(np.int64) if len(values) else None)
            made = map(pa.array, (sizes, nodes, keys), schema.types[2:])
            arrays = [batch["doc_id"], batch["text_key"], *made]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    named = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return named.transform(shipped).mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, node long, keys array<long>"
    )


def centres(nodes: DataFrame, count: int) -> DataFrame:
    """Distinct pairs of a node and a bucket's centre. ``nodes`` has node and keys."""
    single = nodes.select("node", F.posexplode("keys").alias("no", "key"))
    shared = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    alive = single.join(shared, "key").groupBy("node").agg(
        F.sum("n").alias("common"), F.collect_list(F.struct("no", "key")).alias("bands")
    )
    first = F.filter("bands", lambda x: x["no"] < count)
    second = F.filter("bands", lambda x: x["no"] >= count)
    keys = F.flatten(
        F.transform(first, lambda a: F.transform(second, lambda b: F.xxhash64(a["key"], b["key"])))
    )
    tables = settled(alive.select("node", "common", F.explode(keys).alias("key")), "tables")
    best = (
        tables.groupBy("key")
        .agg(F.max(F.struct("common", "node")).alias("best"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", F.col("best.node").alias("centre"))
    )
    return tables.join(best, "key").where("node <> centre").select("node", "centre").distinct()


def _prefix(own: np.ndarray, centre: np.ndarray, linked: bool, percent: int) -> np.ndarray:
    """Elements of the difference that a linked partner must share one of; see the module."""
    added = np.setdiff1d(own, centre, assume_unique=True)
    removed = np.setdiff1d(centre, own, assume_unique=True)
    apart = len(added) + len(removed)
    share = (100 - percent) / (100 + percent)
    overlap = apart - share * len(own) * (1 + 100 / percent)
    if linked:
        overlap = max(overlap, (apart + share * (len(centre) - len(own))) / 2)
    keep = apart - max(1, math.ceil(overlap - 1e-6)) + 1
    return np.concatenate((added, removed))[: max(keep, 0)]


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """node, centre, ``linked`` by their full sets, and ``prefix`` of their difference.

    ``texts`` has a node and a text of it. Both texts come by joins on the node, so a common
    centre is a skewed join that Spark splits, and no group is gathered.
    """
    left = pairs.join(texts, "node")
    right = texts.select(F.col("node").alias("centre"), F.col("text").alias("_centre_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, centre = None, None
        for batch in batches:
            linked, prefix = [], []
            for i, no in enumerate(batch["centre"].to_pylist()):
                if no != last:
                    last, centre = no, shingles(batch["_centre_text"][i].as_py(), width)
                own = shingles(batch["text"][i].as_py(), width)
                shared = len(np.intersect1d(own, centre, assume_unique=True))
                union = len(own) + len(centre) - shared
                linked.append(100 * shared >= percent * union)
                prefix.append(_prefix(own, centre, linked[-1], percent).view(np.int64))
            yield pa.record_batch(
                {
                    "node": batch["node"],
                    "centre": batch["centre"],
                    "linked": pa.array(linked, pa.bool_()),
                    "prefix": pa.array(prefix, pa.list_(pa.int64())),
                }
            )

    return left.join(right, "centre").transform(shipped).mapInArrow(
        run, "node long, centre long, linked boolean, prefix array<long>"
    )


def _with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` with the one row of ``facts`` for their centre; a common centre is salted."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(
        copies.withColumn("_salt", F.col("_salt").cast("long")), ["centre", "_salt"]
    ).drop("_salt")


def open_blocks(checked: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes that may be linked with another one of their centre but aren't connected with it.

    centre, block, node, component and ``asks``. All such nodes of a centre are dealt out over
    blocks of about ``BLOCK``; those not linked with the centre also ask in each of its blocks.
    """
    loose = checked.groupBy("centre").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("linked")).alias("rest")
    )
    open_ = _with_facts(checked, loose.where("n > 1 AND rest > 0").select("centre"))
    marked = settled(
        _with_component(open_, labels).select(
            "centre", "node", "component", "linked", F.explode("prefix").alias("element")
        ),
        "differences",
    )
    met = (
        marked.groupBy("centre", "element")
        .agg(
            F.min("component").alias("_least"),
            F.max("component").alias("_most"),
            F.count_if(~F.col("linked")).alias("_rest"),
        )
        .where("_least <> _most AND _rest > 0")
        .select("centre", "element")
    )
    active = (
        marked.join(met, ["centre", "element"])
        .select("centre", "node", "component", "linked")
        .distinct()
    )
    blocks = active.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = settled(_with_facts(active, blocks), "open-nodes")
    members = dealt.select(
        "centre",
        F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        "node",
        "component",
        F.lit(False).alias("asks"),
    )
    asking = dealt.where("NOT linked").select(
        "centre",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "node",
        "component",
        F.lit(True).alias("asks"),
    )
    return members.unionByName(asking)


class _Block:
    """The sets of a block's members, by shingle."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]]) -> None:
        self.nodes = np.array([node for node, _, _ in members])
        self.components = np.array([component for _, component, _ in members])
        self.sizes = np.array([len(values) for _, _, values in members])
        every = np.concatenate([values for _, _, values in members])
        order = np.argsort(every, kind="stable")
        self.values = every[order]
        self.owner = np.repeat(np.arange(len(members)), self.sizes)[order]

    def linked(self, component: int, values: np.ndarray, percent: int) -> np.ndarray:
        """A member of each other component that is linked with this set."""
        low = np.searchsorted(self.values, values, "left")
        high = np.searchsorted(self.values, values, "right")
        lengths = high - low
        starts = np.repeat(low - (np.cumsum(lengths) - lengths), lengths)
        shared = np.bincount(
            self.owner[starts + np.arange(len(starts))], minlength=len(self.nodes)
        )
        union = self.sizes + len(values) - shared
        found = (100 * shared >= percent * union) & (self.components != component)
        _, first = np.unique(self.components[found], return_index=True)
        return self.nodes[found][first]


def links_in_blocks(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a`` and ``b`` of asking nodes, one for each other component of a block.

    A block's members come first and are indexed; the asking nodes pass by one at a time. No
    pair is listed that isn't a link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, block = None, [], None
        for batch in batches:
            a, b = [], []
            names = ("centre", "block", "node", "component", "asks")
            columns = [batch[name].to_pylist() for name in names]
            for i, (centre, no, node, component, asks) in enumerate(zip(*columns)):
                if at != (centre, no):
                    at, members, block = (centre, no), [], None
                values = shingles(batch["text"][i].as_py(), width)
                if not asks:
                    members.append((node, component, values))
                    continue
                if members:
                    block = block or _Block(members)
                    found = block.linked(component, values, percent)
                    a.extend([node] * len(found))
                    b.extend(found.tolist())
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    spread = rows.join(texts, "node").repartition("centre", "block")
    return spread.sortWithinPartitions("centre", "block", "asks").transform(shipped).mapInArrow(run, "a long, b long")


def duplicate_groups(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row per row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets of
    ``width`` words (A-Z lower-cased). component_id is the least doc_id that can be reached.
    NULL and empty texts, and texts without words, are linked with nothing. Equal rows are
    linked. A NULL doc_id is never least; its group has the least of the others, or NULL. An
    empty table gives no rows; columns besides doc_id and text are ignored.
    """
    return grouped(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """As ``duplicate_groups``, with each row's text_key and the group's own number.

    ``group`` is NULL for texts without words.
    """
    count = bands_for(percent)
    signed = settled(signatures(docs, width, count), "signatures")
    named = signed.where("node IS NOT NULL")
    copies = settled(named.groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    keyed = named.select("node", "keys").dropDuplicates(["node"])
    pairs = settled(centres(keyed, count), "pairs")

    def texts_of(found: DataFrame) -> DataFrame:
        wanted = found.select("node").union(found.select("centre")).distinct()
        ids = copies.join(wanted, "node")
        by_id = docs.select(F.col("doc_id").cast("long"), "text").join(
            ids, F.col("doc_id").eqNullSafe(F.col("least"))
        )
        return _of_node(by_id.select("node", "text"), width)

    texts = settled(texts_of(pairs), "texts")
    checked = settled(verified(pairs, texts, width, percent), "checked")
    links = checked.where("linked").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    labels = components(links)
    found = settled(
        links_in_blocks(open_blocks(checked, labels), texts, width, percent), "more-links"
    )
    if found.head(1):
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = components(found.unionByName(known))
    labelled = _with_component(copies, labels)
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = labelled.join(least, "component").select(
        "node", "component_id", F.col("component").alias("group")
    )
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(by_node, "node", "left").select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
        "text_key",
        "group",
    )


def _of_node(rows: DataFrame, width: int) -> DataFrame:
    """One text for each node: a doc_id that comes twice may have brought a wrong one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch["node"].to_pylist()
            right = [
                node_of(shingles(text.as_py(), width)) == node
                for node, text in zip(nodes, batch["text"])
            ]
            yield batch.filter(pa.array(right, pa.bool_()))

    return rows.transform(shipped).mapInArrow(run, "node long, text string").dropDuplicates(["node"])
