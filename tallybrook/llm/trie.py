"""Conversations in a prefix trie, built as a burst trie.

A conversation is cut into segments of ``SEGMENT`` turns, so that no row grows with it; the
segments that follow one prefix hang under a trie head, the hash of that prefix, and all depths
are worked on at once. The distinct segments under a head are its container. A container of more
than ``CAPACITY`` suffixes bursts: its suffixes move to containers under their next turn's id,
at most ``SEGMENT`` times. What remains is sorted, and one sweep with a stack makes the nodes.

Equal conversations are counted before anything is compared. Turn ids are 128-bit hashes of role
and text, heads are pairs of 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybrook.llm.common import settled, shipped
from tallybrook.llm.mixing import word_count

SEGMENT = 32
CAPACITY = 4096
#: Turn numbers within a range of this many bits are ranked together.
RANGE_BITS = 10
#: Ids whose quotient by this is equal are joined to one text before they are hashed.
IDS_A_PIECE = 4096
FAMILY, MOST_BORROWED = 20, 4

HEAD = ["segment", "x1", "x2"]
BOX = [*HEAD, "level", "p1", "p2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

NODE_DDL = (
    "segment long, x1 long, x2 long, level int, p1 long, p2 long, up1 long, up2 long,"
    " is_head boolean, depth int, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ``at`` (0 for the first turn), the turn's ``id`` and its words.

    A NULL turn number comes first; equal numbers go by role, then by id. Rows without conv_id
    are of no conversation. A long conversation is ranked in ranges of its turn numbers.
    """
    role, text = (F.coalesce(conversations[name].cast("string"), F.lit("")) for name in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(content)).alias("id"),
        word_count(text).alias("words"),
    ).where("conv_id IS NOT NULL")
    ranged = turns.withColumn("_range", F.shiftright(F.col("turn").cast("long"), RANGE_BITS))
    inside = Window.partitionBy("conv_id", "_range").orderBy(
        F.col("turn").asc_nulls_first(), "role", "id"
    )
    counts = ranged.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    across = (
        Window.partitionBy("conv_id")
        .orderBy(F.col("_range").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = counts.select(
        F.col("conv_id").alias("_conv"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_base"),
    )
    ranked = ranged.withColumn("_rank", F.row_number().over(inside))
    return ranked.join(
        bases, (F.col("conv_id") == F.col("_conv")) & F.col("_range").eqNullSafe(F.col("_of"))
    ).select("conv_id", (F.col("_base") + F.col("_rank") - 1).alias("at"), "id", "words")


def with_family_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c begins with turns of conversation c - c % 20 instead of its own.

    The first crc32(c) % 4 turns are replaced, by as many as that conversation has. Returns
    conv_id, depth (from 1), id and words of all turns, and the conversations left without any.
    """
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    own = counts.select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string")) % MOST_BORROWED).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_family"),
    )
    of_family = counts.select(F.col("conv_id").alias("_family"), F.col("n").alias("_there"))
    plans = own.join(of_family, "_family", "left").select(
        "conv_id",
        "n",
        "h",
        "_family",
        F.least("h", F.coalesce("_there", F.lit(0))).alias("borrowed"),
    )
    firsts = turns.where(F.col("at") < MOST_BORROWED - 1).withColumnRenamed("conv_id", "_family")
    opening = plans.join(firsts, "_family").where("at < h")
    rest = turns.join(plans, "conv_id").where("at >= h")
    rebuilt = opening.select("conv_id", (F.col("at") + 1).alias("depth"), "id", "words").unionByName(
        rest.select("conv_id", (F.expr("borrowed + at - h") + 1).alias("depth"), "id", "words")
    )
    return rebuilt, plans.where("n <= h AND borrowed = 0").select("conv_id")


def segments(rebuilt: DataFrame, turnless: DataFrame) -> DataFrame:
    """Each conversation in rows of at most ``SEGMENT`` turns.

    ``x1, x2`` hash all segments before, ``f1, f2`` are the segment's own hashes, and ``ended``
    marks the last one. A conversation without turns has one segment without any.
    """
    cut = rebuilt.withColumn("segment", F.expr(f"(depth - 1) div {SEGMENT}"))
    gathered = cut.groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(F.struct("depth", "id", "words"))).alias("_turns")
    )
    filled = gathered.select(
        "conv_id", "segment", F.col("_turns.id").alias("ids"), F.col("_turns.words").alias("words")
    )
    none = turnless.select(
        "conv_id",
        F.lit(0).cast("long").alias("segment"),
        F.array().cast("array<binary>").alias("ids"),
        F.array().cast("array<long>").alias("words"),
    )
    hashed = filled.unionByName(none).withColumns(
        {f"f{i}": F.xxhash64(F.lit(i), "segment", "ids") for i in (1, 2)}
    )
    own = Window.partitionBy("conv_id").orderBy("segment")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    return hashed.withColumns(
        {f"x{i}": F.coalesce(F.bit_xor(f"f{i}").over(before), F.lit(0)) for i in (1, 2)}
    ).withColumn("ended", F.lead("segment").over(own).isNull())


def _next_head() -> list[Column]:
    """The head under which a segment's continuations hang."""
    return [
        (F.col("segment") + 1).alias("segment"),
        F.col("x1").bitwiseXOR(F.col("f1")).alias("x1"),
        F.col("x2").bitwiseXOR(F.col("f2")).alias("x2"),
    ]


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over consecutive rows' pieces, joined by commas."""
    names = [*HEAD, "f1", "f2"]
    schema = pa.schema([*[(name, pa.int64()) for name in names], ("ends_sha256", pa.string())])
    key, digest = None, None
    for batch in batches:
        done = []
        columns = [batch[name].to_pylist() for name in (*names, "piece")]
        for *found, piece in zip(*columns):
            if found == key:
                digest.update(b"," + piece.encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = found, hashlib.sha256(piece.encode())
        yield _batch(done, schema)
    if key is not None:
        yield _batch([(*key, digest.hexdigest())], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def ends(cut: DataFrame) -> DataFrame:
    """For each last segment the hash of the ids that end with it, ascending, comma-joined.

    Ids become texts of up to ``IDS_A_PIECE`` first; only those are brought together, and hashed
    one after the other.
    """
    key = [*HEAD, "f1", "f2"]
    pieces = (
        cut.where("ended")
        .groupBy(*key, F.expr(f"conv_id div {IDS_A_PIECE}").alias("_part"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("_ids"))
        .select(*key, "_part", F.array_join(F.col("_ids").cast("array<string>"), ",").alias("piece"))
    )
    in_order = pieces.repartition(*key).sortWithinPartitions(*key, "_part").drop("_part")
    ddl = ", ".join(f"{name} long" for name in key)
    return in_order.transform(shipped).mapInArrow(_hash_runs, f"{ddl}, ends_sha256 string")


def _burst(members: DataFrame, capacity: int) -> tuple[DataFrame, list[DataFrame]]:
    """Containers of at most ``capacity`` suffixes, and the heads that burst, by level."""
    waiting = members.withColumns(
        {
            "level": F.lit(0),
            **{name: F.lit(0).cast("long") for name in ("p1", "p2", "up1", "up2")},
        }
    )
    closed, heads = [], []
    while True:
        ending = F.size("ids") == F.col("level")
        sizes = (
            waiting.groupBy(*BOX, "up1", "up2", "up_conv")
            .agg(
                F.count(F.lit(1)).alias("_suffixes"),
                F.sum("n_convs").alias("n_convs"),
                F.min("conv_id").alias("conv_id"),
                F.max(F.when(ending, F.col("ends_sha256"))).alias("ends_sha256"),
                F.max(F.get("words", F.col("level") - 1)).alias("_words"),
            )
            .where(F.col("_suffixes") > capacity)
        )
        full = settled(sizes, "trie-heads")
        if full.head(1) == []:
            closed.append(waiting)
            break
        heads.append(full)
        # Below the first segment a container lacks those that end at its head.
        hanging = (F.col("level") == 0) & (F.col("segment") > 0)
        least = F.when(hanging, F.col("up_conv")).otherwise(F.col("conv_id"))
        mark = full.select(*BOX, least.alias("_head_conv"))
        met = settled(waiting.join(mark, BOX, "left"), "trie-suffixes")
        closed.append(met.where("_head_conv IS NULL").drop("_head_conv"))
        following = F.get("ids", F.col("level"))
        moving = met.where(F.col("_head_conv").isNotNull() & (F.size("ids") > F.col("level")))
        waiting = moving.withColumns(
            {
                "up1": F.col("p1"),
                "up2": F.col("p2"),
                "up_conv": F.col("_head_conv"),
                "p1": F.xxhash64(F.lit(1), "p1", following),
                "p2": F.xxhash64(F.lit(2), "p2", following),
                "level": F.col("level") + 1,
            }
        ).drop("_head_conv")
    together = closed[0]
    for part in closed[1:]:
        together = together.unionByName(part)
    return together, heads


class _Node:
    __slots__ = (
        "up", "depth", "words", "n_convs", "conv_id", "children", "leaves", "saved", "ends",
    )

    def __init__(self, up: int, depth: int, words: int):
        self.up, self.depth, self.words = up, depth, words
        self.n_convs = self.children = self.leaves = self.saved = 0
        self.conv_id, self.ends = None, EMPTY_SHA256


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose suffixes come one after the other and sorted.

    Depth first, so a node stands before its children; values are added up backwards.
    """
    schema = pa.schema(
        [
            *[(n, pa.int32() if n == "level" else pa.int64()) for n in BOX],
            ("up1", pa.int64()), ("up2", pa.int64()), ("is_head", pa.bool_()), ("depth", pa.int32()),
            ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
            ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
            ("ends_sha256", pa.string()),
        ]
    )

    def finished(box: tuple, nodes: list[_Node]) -> list[tuple]:
        *key, up_conv = box
        for node in reversed(nodes):
            node.leaves = node.leaves if node.children else 1
            node.saved += (node.n_convs - 1) * node.words
            if node.up >= 0:
                parent = nodes[node.up]
                parent.n_convs += node.n_convs
                parent.leaves += node.leaves
                parent.saved += node.saved
                parent.children += 1
                if parent.conv_id is None or node.conv_id < parent.conv_id:
                    parent.conv_id = node.conv_id
        return [
            (
                *key,
                node.up < 0,
                node.depth,
                node.conv_id,
                up_conv if node.up < 0 else nodes[node.up].conv_id,
                node.n_convs,
                node.children,
                node.leaves,
                node.saved,
                node.ends,
            )
            for node in nodes
        ]

    inputs = (
        *BOX, "up1", "up2", "up_conv", "ids", "words", "conv_id", "n_convs", "ends_sha256",
        "below_children", "below_leaves", "below_saved",
    )
    width = len(BOX) + 3
    box, nodes, path, last = None, [], [], []
    for batch in batches:
        for row in zip(*[batch[name].to_pylist() for name in inputs]):
            ids, words, conv_id, n_convs, ended, children, leaves, saved = row[width:]
            level = row[len(HEAD)]
            if row[:width] != box:
                if nodes:
                    yield _batch(finished(box, nodes), schema)
                box, last = row[:width], ids[:level]
                nodes, path = [_Node(-1, level, words[level - 1] if level else 0)], [0]
            shared = level
            while shared < min(len(ids), len(last)) and ids[shared] == last[shared]:
                shared += 1
            del path[shared - level + 1 :]
            for depth in range(shared + 1, len(ids) + 1):
                nodes.append(_Node(path[-1], depth, words[depth - 1]))
                path.append(len(nodes) - 1)
            node, last = nodes[path[-1]], ids
            node.n_convs += n_convs
            if node.conv_id is None or conv_id < node.conv_id:
                node.conv_id = conv_id
            node.ends = ended or EMPTY_SHA256
            node.children += children
            node.leaves += leaves
            node.saved += saved
    if nodes:
        yield _batch(finished(box, nodes), schema)


def _trie(members: DataFrame, capacity: int) -> DataFrame:
    """Nodes of all containers; ``is_head`` with level 0 is the prefix a container hangs under."""
    boxes, heads = _burst(members, capacity)
    in_order = boxes.repartition(*BOX).sortWithinPartitions(*BOX, "ids")
    nodes = settled(in_order.transform(shipped).mapInArrow(_sweep, NODE_DDL), "trie-nodes")
    # The heads of burst containers, from those that hang under them, deepest first.
    for full in reversed(heads):
        level = full.select("level").first()["level"]
        under = nodes.where(F.col("is_head") & (F.col("level") == level + 1))
        sums = under.groupBy(*HEAD, F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("_saved"),
        )
        own = F.coalesce("_words", F.lit(0)) * (F.col("n_convs") - 1)
        made = full.join(sums, [*HEAD, "p1", "p2"]).select(
            *BOX,
            "up1",
            "up2",
            F.lit(True).alias("is_head"),
            F.col("level").alias("depth"),
            "conv_id",
            F.col("up_conv").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("_saved") + own).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
        nodes = nodes.unionByName(settled(made, "trie-nodes"))
    return nodes


def _sums_below(members: DataFrame, cut: DataFrame, capacity: int) -> DataFrame:
    """For each head below the first segment, leaves and saved words of all that hangs under it.

    Every container is counted at the one conversation that owns it, and each conversation's
    containers are added up from its end: no chain of segments is followed step by step.
    """
    nodes = _trie(members, capacity)
    tops = nodes.where("is_head AND level = 0").select(
        *HEAD, "n_leaves", "saved_tokens", F.col("conv_id").alias("_owner")
    )
    met = cut.where("segment > 0").select("conv_id", *HEAD).join(tops, HEAD)
    from_here = (
        Window.partitionBy("conv_id")
        .orderBy(F.desc("segment"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def owned(name: str) -> Column:
        return F.sum(F.when(F.col("conv_id") == F.col("_owner"), F.col(name)).otherwise(0)).over(from_here)

    tails = met.select(*HEAD, owned("n_leaves").alias("_l"), owned("saved_tokens").alias("_s"))
    return tails.groupBy(*HEAD).agg(F.sum("_l").alias("below_leaves"), F.sum("_s").alias("below_saved"))


def prefix_trie(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per node of the trie over ``segments``.

    ``conv_id`` and ``parent_conv_id`` are the least members of the node and its parent. No
    conversations make no trie, not even a root.
    """
    key = [*HEAD, "f1", "f2"]
    counted = cut.groupBy(*key, "ids", "words").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    members = settled(counted.join(ends(cut), key, "left"), "trie-members")
    deeper = cut.where("segment > 0")
    zero = F.lit(0).cast("long")
    if deeper.head(1) == []:
        whole = members.withColumns(
            {
                "up_conv": F.lit(None).cast("long"),
                **{name: zero for name in ("below_children", "below_leaves", "below_saved")},
            }
        )
    else:
        above = members.select(*_next_head(), F.col("conv_id").alias("up_conv"))
        below = (
            deeper.select(*HEAD, F.get("ids", F.lit(0)).alias("_first"))
            .distinct()
            .groupBy(*HEAD)
            .agg(F.count(F.lit(1)).alias("below_children"))
        )
        hung = members.join(above, HEAD, "left")
        onward = [name.alias(f"_n{i}") for i, name in enumerate(_next_head())]

        def with_below(rows: DataFrame, sums: DataFrame, names: list[str]) -> DataFrame:
            renamed = sums.toDF(*[f"_n{i}" for i in range(3)], *names)
            joined = rows.select("*", *onward).join(renamed, ["_n0", "_n1", "_n2"], "left")
            return joined.drop("_n0", "_n1", "_n2").fillna(0, names)

        counted_below = settled(with_below(hung, below, ["below_children"]), "trie-members")
        none = {name: zero for name in ("below_leaves", "below_saved")}
        sums = _sums_below(counted_below.where("segment > 0").withColumns(none), cut, capacity)
        whole = with_below(counted_below, sums, ["below_leaves", "below_saved"])
    nodes = _trie(whole, capacity).where("NOT (is_head AND level = 0 AND segment > 0)")
    return nodes.select(
        "conv_id",
        (F.col("segment") * SEGMENT + F.col("depth")).cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


def conversation_trie(conversations: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The trie of all conversations with their family's openings.

    NULL roles and texts are empty, equal turn numbers go by role and id, repeated rows are turns
    of their own, rows without conv_id are left out, and columns besides conv_id, turn, role and
    text are ignored. Texts of any length are hashed where they are read.
    """
    turns = settled(ordered_turns(conversations), "trie-turns")
    cut = settled(segments(*with_family_openings(turns)), "trie-segments")
    return prefix_trie(cut, capacity)
