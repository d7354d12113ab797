from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from conftest_words import split_words

from tickloom.llm import simhash
from tickloom.llm.components import components


def fingerprint(text, size=3):
    words = split_words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius):
    """Components of all pairs at most `radius` bits apart, by trying all pairs."""
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= radius:
                group[find(a)] = find(b)
    return {v: find(v) for v in values}


def expected(corpus, radius):
    marks = [(i, fingerprint(t)) for i, t, _, _ in corpus]
    root = roots({f for _, f in marks}, radius)
    least: dict = {}
    for i, f in marks:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return sorted(((i, f, least.get(root[f])) for i, f in marks), key=str)


@pytest.mark.parametrize("radius,hot", [(2, 20_000), (2, 1), (3, 1), (6, 20_000), (6, 1)])
def test_components_agree_with_all_pairs(docs, corpus, radius, hot):
    got = [(r.id, r.fp % 2**64, r.component) for r in simhash.near_duplicates(docs, radius=radius, hot=hot).collect()]
    assert sorted(got, key=str) == expected(corpus, radius)


@pytest.mark.parametrize("radius,hot", [(2, 20_000), (2, 3), (3, 3), (5, 20_000), (6, 3)])
def test_links_of_near_values(spark, radius, hot):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(rng.randint(0, 12)):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
            values.add(v)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long"), radius, hot).collect()
    assert all((r.a ^ r.b).bit_count() <= 64 for r in found)
    joined = roots_of_links(values, [(r.a % 2**64, r.b % 2**64) for r in found])
    want = roots(values, radius)
    assert {(a, b) for a in values for b in values if joined[a] == joined[b]} == {(a, b) for a in values for b in values if want[a] == want[b]}


def roots_of_links(values, links):
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for a, b in links:
        group[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(7, 7), (9, 8), (8, 9), (1, 3), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 500 for k in range(500, 540)} | {9: 8, 8: 8, 1: 1, 2: 1, 3: 1}
    assert got == want


def test_fingerprint_of_ties_and_odd_texts():
    for text in ("", " \n", "A", "a b", "A B c", "x " * 50, "É é z Q", "a b c d"):
        assert simhash.fingerprint(text.encode()) == fingerprint(text)
    assert np.uint64(simhash.fingerprint(b"one two three")) == xxhash.xxh64_intdigest("one two three", seed=42)


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.near_copies(empty).count() == 0


def wide_fingerprint(text, size=5):
    """Majority of the different shingles' scrambled hashes, bit by bit in plain integers."""

    def scrambled(z, k):
        z = (z + (k + 1) * 0x9E3779B97F4A7C15) % 2**64
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        return z ^ z >> 31

    words = split_words("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    out = 0
    for k in range(4 if grams else 0):
        hashes = [scrambled(xxhash.xxh64_intdigest(g.encode(), seed=42), k) for g in grams]
        for b in range(64):
            n = 2 * sum(h >> b & 1 for h in hashes)
            out |= (n > len(hashes) or n == len(hashes) and scrambled(0, k) >> b & 1) << 64 * k + b
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_near_copies_agree_with_all_pairs(docs, corpus, hot):
    marks = [(i, wide_fingerprint(t)) for i, t, _, _ in corpus]
    distinct = {f for _, f in marks}
    keys = simhash.bucket_keys(len(distinct))
    masks = [sum(1 << int(b) for b in k) for k in keys]
    linked = [(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 48 and any((a ^ b) & m == 0 for m in masks)]
    root, least = roots_of_links(distinct, linked), {}
    for i, f in marks:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = sorted(((i, least.get(root[f])) for i, f in marks), key=str)
    assert sorted(((r.id, r.component) for r in simhash.near_copies(docs, hot=hot).collect()), key=str) == want


def test_near_copies_are_found_and_others_left_alone(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(3_000)]
    shingles = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    rows = []
    for k in range(100):
        base = [rng.choice(vocab) for _ in range(rng.randint(60, 600))]
        copy = list(base)
        while True:
            changed = list(copy)
            changed[rng.randrange(len(copy))] = rng.choice(vocab)
            a, b = shingles(base), shingles(changed)
            if len(a & b) / len(a | b) < 0.8:
                break
            copy = changed
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(c in (i, i - i % 2) for i, c in got.items())
    assert sum(got[2 * k + 1] == 2 * k for k in range(100)) >= 90


def test_bucket_keys_follow_the_number_of_texts():
    few, many = simhash.bucket_keys(0), simhash.bucket_keys(10**9)
    assert len(few[0]) == 12 and len(few) < len(many) and 2 ** len(many[0]) * 512 >= 10**9
