from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tickloom.llm import suffix_decontamination as sd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def windows_of(items, size):
    out = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if n else ():
            out[tuple(w[k : k + n])].add("" if item is None else str(item))
    return out


def found(text, windows, size):
    w = words(text)
    hit, names = set(), set()
    for n in range(1, size + 1):
        for k in range(len(w) - n + 1):
            owners = windows.get(tuple(w[k : k + n]))
            if owners:
                hit |= set(range(k, k + n))
                names |= owners
    return w, hit, sorted(names)


def make(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(9)] + ["É", "7"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 40)))) for i in range(2, 30)]
    items += [(2, "A-b c"), (40, None), (41, "?!"), (None, "only words of nobody but this one here now then"), (42, items[5][1]), (42, items[5][1])]
    docs = []
    for i in range(120):
        w = rng.choices(vocab, k=rng.randint(0, 50))
        if i % 4 == 0:
            w[3:3] = words(rng.choice(items)[1])
        docs.append((i, rng.choice([" ", ", ", "\n-"]).join(w)))
    docs += [(200, None), (201, ""), (202, "."), (None, docs[4][1]), (4, docs[4][1]), (203, "a B c"), (204, "a b c")]
    docs += [(205, " ".join(rng.choices(vocab, k=20_000))), (206, "ONLY words of nobody; but this one here now then")]
    return docs, items


def as_df(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS spans", "'x' AS rest", "3 AS n_words")
    return df.repartition(4), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item")


@pytest.mark.parametrize("size,tile_bytes", [(10, 1 << 20), (4, 300), (2, 1 << 20), (1, 1 << 20)])
def test_hits_agree_with_every_window_of_every_document(spark, size, tile_bytes):
    docs, items = make(size)
    df, asked = as_df(spark, docs, items)
    windows = windows_of(items, size)
    want = []
    for i, text in docs:
        w, hit, names = found(text, windows, size)
        want.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    got = sd.digests(df, asked, size, tile_bytes=tile_bytes)
    assert got.dtypes == [
        ("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean"),
    ]
    key = lambda r: str(tuple(r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_longest_matches_agree_with_a_table_of_common_runs(spark):
    docs, items = make(7)
    docs = [d for d in docs if d[0] != 205]
    df, asked = as_df(spark, docs, items)
    want = set()
    for i, text in docs:
        a = words(text)
        for item, other in items:
            b = words(other)
            least = min(10, len(b))
            run = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for x in range(len(a) - 1, -1, -1):
                for y in range(len(b) - 1, -1, -1):
                    run[x][y] = run[x + 1][y + 1] + 1 if a[x] == b[y] else 0
            for x in range(len(a)):
                for y in range(len(b)):
                    longer = x and y and a[x - 1] == b[y - 1]
                    if run[x][y] >= max(1, least) and not longer:
                        want.add((i, "" if item is None else str(item), x, y, run[x][y]))
    assert {tuple(r) for r in sd.matches(df, asked).collect()} == want


def test_clean_documents_stay_as_they_are(spark):
    docs, items = make(10)
    df, asked = as_df(spark, docs, items)
    windows = windows_of(items, 10)
    want = sorted(((i, t) for i, t in docs if not found(t, windows, 10)[1]), key=str)
    kept = sd.decontaminate(df, asked)
    assert kept.dtypes == df.dtypes
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want


def test_empty_tables(spark):
    docs, items = make(10)
    df, asked = as_df(spark, docs, items)
    assert sd.digests(df.limit(0), asked).collect() == []
    got = sd.digests(df, asked.limit(0)).collect()
    assert len(got) == len(docs) and not any(r.contaminated or r.n_items or r.n_hit for r in got)
    assert {r.doc_id: r.n_words for r in got}[206] == 10
    assert sd.matches(df, asked.limit(0)).collect() == []
