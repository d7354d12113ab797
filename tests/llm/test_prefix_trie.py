from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from tickloom.llm import prefix_trie


def order_of(role, text):
    """Hashes that put turns of one number in order."""
    def chain(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed)
        return seed - (1 << 64) if seed >> 63 else seed

    return chain(role.encode(), text.encode())


def rebuilt(rows, family=5, most=8):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), order_of(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = own.get(c - c % family, [])[:h] + turns[h:]
    return out


def nodes(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(
        (
            min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        )
        for path, who in members.items()
    )


def make(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 3, 8, 20])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["Hé", "b", "", None])))
    rows += [(n + 1, t, "user", "deep" * (t % 3)) for t in range(150)]  # deep, and half as deep beside it
    rows += [(n + 6, t, "user", "deep" * (t % 3)) for t in range(75)]
    rows += [(n + 20 + k, t, "user", "same") for k in range(40) for t in range(12)]  # one conversation again and again
    rows += [(7, 2, "user", "x"), (7, 2, "user", "x"), (7, 2, "user", "y"), (9, None, "user", "first"), (9, None, None, None), (None, 1, "user", "a")]
    rows += [(200, -5, "user", "early"), (200, 2**40, "user", "late")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("height,stretch", [(16, 4096), (2, 4), (3, 9)])
def test_trie_agrees_with_all_prefixes(spark, monkeypatch, height, stretch):
    monkeypatch.setattr(prefix_trie, "HEIGHT", height)
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    monkeypatch.setattr(prefix_trie, "IDS", 16)
    rows = make(height, 60)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS c", "2 AS p", "3 AS depth", "4 AS bytes").repartition(4)
    got = prefix_trie.conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == nodes(rows)


def test_an_empty_table_has_no_node(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_trie_of_turnless_conversations_is_a_root(spark):
    # 1 has one turn, which its branch point cuts off; 0 does not exist
    assert zlib.crc32(b"1") % 9 > 0
    rows = [(1, 0, "user", "a")]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())] == nodes(rows)
