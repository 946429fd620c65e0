from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tallybrook.llm import oracle, trie

DDL = "conv_id long, turn long, role string, text string, segment int, LEVEL string, ids int"


def frame(spark, rows):
    """The turns with extra columns of names that the operator uses itself."""
    return spark.createDataFrame([(*row, 1, "x", 2) for row in rows], DDL)


def in_order(turns):
    def key(turn):
        number, role, text = turn
        content = f"{len(role)}:{role}{text}".encode()
        return number is not None, number or 0, role, hashlib.md5(content).digest()

    return [(role, text) for _, role, text in sorted(turns, key=key)]


def brute(rows):
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            found[conv_id].append((turn, role or "", text or ""))
    own = {conv_id: in_order(turns) for conv_id, turns in found.items()}
    rebuilt = {}
    for conv_id, turns in own.items():
        h = zlib.crc32(str(conv_id).encode()) % 4
        family = conv_id - int(conv_id / 20) * 20
        rebuilt[conv_id] = tuple(own.get(conv_id - family, [])[:h]) + tuple(turns[h:])
    members, children = defaultdict(list), defaultdict(int)
    for conv_id, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv_id)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, ids in members.items():
        words = len(path[-1][1].encode().split()) if path else 0
        for depth in range(len(path) + 1):
            saved[path[:depth]] += (len(ids) - 1) * words
            leaves[path[:depth]] += not children[path]
    nodes = []
    for path, ids in members.items():
        ends = ",".join(str(i) for i in sorted(ids) if len(rebuilt[i]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        counts = (len(ids), children[path], leaves[path], saved[path])
        nodes.append((min(ids), len(path), parent, *counts, digest))
    return sorted(nodes, key=lambda node: node[:2])


def nodes_of(spark, rows, capacity=trie.CAPACITY):
    found = trie.conversation_trie(frame(spark, rows), capacity).collect()
    return sorted((tuple(row) for row in found), key=lambda node: node[:2])


def awkward():
    """Shared openings of all lengths around the segment, ties, NULLs, negative and huge ids."""
    rng = random.Random(1)
    rows = []
    for conv_id in [*range(-45, 120), 10**12]:
        shared = rng.choice([0, 1, 3, 33, 64, 70, 97, 130])
        turns = [("ua"[i % 2], f"w {i} x") for i in range(shared)]
        turns = turns[: rng.randrange(len(turns) + 1)]
        turns += [("u", f"t{rng.randrange(3)}") for _ in range(rng.randrange(4))]
        for i, (role, text) in enumerate(turns):
            number = i if rng.random() < 0.98 else None
            rows.append((conv_id, number, role, text if rng.random() < 0.99 else None))
    rows += [(None, 1, "u", "x"), (3, None, None, None), (3, None, None, None)]
    return [*rows, (7, 2, "u", "z"), (7, 2, "a", "z"), (8, 0, "u", "long " * 50_000)]


@pytest.mark.parametrize("capacity", [trie.CAPACITY, 30])
def test_against_every_prefix(spark, capacity):
    rows = awkward()
    assert nodes_of(spark, rows, capacity) == brute(rows)


def test_copies_and_prefixes_of_one_conversation(spark):
    """Ends of many ids, over several pieces; every conversation a prefix of the next."""
    rows = [(i * 20, 0, "u", "same") for i in range(3 * trie.IDS_A_PIECE // 20)]
    rows += [(i * 20, t, "u", f"t{t}") for i in range(45) for t in range(1, i)]
    assert nodes_of(spark, rows, 11) == brute(rows)


def test_conversations_without_turns(spark):
    h = {i: zlib.crc32(str(i).encode()) % 4 for i in range(1, 20)}
    turnless = [i for i in h if h[i] > 0]
    rows = [(i, 0, "u", "only") for i in turnless]
    assert nodes_of(spark, rows) == brute(rows)
    assert [node[1] for node in nodes_of(spark, rows)] == [0]


def test_no_rows(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "u", "x")]) == []


def test_sql_says_the_same(sf_dir):
    turns = duckdb.connect()
    turns.execute(f"CREATE VIEW conversations AS FROM '{sf_dir}/conversations.parquet'")
    rows = turns.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert sorted(turns.execute(oracle.OP11).fetchall(), key=lambda node: node[:2]) == brute(rows)
