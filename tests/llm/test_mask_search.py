from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tickloom.llm import mask_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    """Every document against every item, one after the other."""
    split = [(i, Counter(words(t))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, n_words = len(split), sum(sum(c.values()) for _, c in split)
    held = Counter(w for _, c in split for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in split:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_words
            score = 0
            for w in words(text):
                if w in c:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                    score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return Counter(out)


def make(seed, n):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(120)] + ["the"] * 30 + ["É", "x-y", "a_b", "ß z", "7"]
    docs = [(i, rng.choice([" ", "\n", ", "]).join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(500 + k, docs[3][1]) for k in range(20)] + [(600, docs[4][1])] * 15  # ties, and rows that repeat
    docs += [(700, None), (701, ""), (702, "--- !"), (None, docs[5][1]), (None, docs[5][1]), (703, " ".join(rng.choices(vocab, k=30_000)))]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 90)))) for i in range(12)]
    items += [(50, docs[3][1]), (50, docs[3][1]), (51, None), (52, "??"), (53, "unheardof"), (None, docs[4][1]), (54, " ".join(vocab))]
    return docs, items


@pytest.mark.parametrize("tile_bytes,block_docs,block_words", [(1 << 20, 16_384, 10**6), (700, 7, 10**6), (1 << 20, 10**6, 300)])
def test_search_agrees_with_scores_of_all_documents(spark, tile_bytes, block_docs, block_words):
    docs, items = make(3, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS score", "3 AS rank").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS copies")
    got = mask_search.search(df, asked, 10, tile_bytes=tile_bytes, block_docs=block_docs, block_words=block_words)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(tuple(r) for r in got.collect()) == ranked(docs, items, 10)


def test_empty_tables_and_tables_without_words_have_no_ranks(spark):
    docs, items = make(4, 5)
    kinds, asked = "doc_id long, text string", "item_id long, text string"
    none = spark.createDataFrame([], kinds)
    some = spark.createDataFrame(items, asked)
    assert mask_search.search(none, some).collect() == []
    assert mask_search.search(spark.createDataFrame([(1, None), (2, ".")], kinds), some).collect() == []
    assert mask_search.search(spark.createDataFrame(docs, kinds), spark.createDataFrame([], asked)).collect() == []


def test_a_term_that_all_documents_hold_weighs_nothing_in_a_large_corpus(spark):
    assert mask_search.weight(10**6, 10**6) == 0
    df = spark.createDataFrame([(i, "the") for i in range(2000)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert mask_search.search(df, asked).collect() == []
