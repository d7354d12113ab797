from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_words import split_words

from tickloom.llm import bwt_dedup, substring_dedup
from tickloom.llm.anchors import runs


def covered(items, length):
    """Marks of the positions inside windows found twice or more, by counting every window."""
    count = Counter(tuple(x[i : i + length]) for x in items for i in range(len(x) - length + 1))
    for x in items:
        marks = [False] * len(x)
        for i in range(len(x) - length + 1):
            if count[tuple(x[i : i + length])] > 1:
                marks[i : i + length] = [True] * length
        yield marks


def words_expected(corpus, length):
    texts = [split_words(t) for _, t, _, _ in corpus]
    for (i, _, _, _), words, marks in zip(corpus, texts, covered(texts, length)):
        kept = " ".join(w for w, m in zip(words, marks) if not m)
        yield i, len(words), sum(marks), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("hot", [20_000, 2])
def test_words_agree_with_counting_every_window(docs, corpus, hot):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs, hot=hot).collect())
    assert got == Counter(words_expected(corpus, 35))


def test_rows_keep_their_columns_and_lose_the_repeats(docs, corpus):
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    texts = [split_words(t) for _, t, _, _ in corpus]
    want = Counter(
        (i, t if not any(m) else " ".join(w for w, x in zip(words, m) if not x), source)
        for (i, t, _, source), words, m in zip(corpus, texts, covered(texts, 35))
    )
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == want


@pytest.mark.parametrize("length,gram,step,hot", [(400, 160, 16, 50_000), (50, 20, 16, 50_000), (40, 16, 7, 2)])
def test_bytes_agree_with_counting_every_string(docs, corpus, length, gram, step, hot):
    rows = [r for r in corpus if r[0] != 304] if length < 400 else corpus
    texts = [(t or "").encode() for _, t, _, _ in rows]
    want = Counter()
    for (i, _, _, _), text, marks in zip(rows, texts, covered(texts, length)):
        edges = np.diff(np.concatenate([[0], np.array(marks, int), [0]]))
        kept = bytes(b for b, m in zip(text, marks) if not m)
        want[i, len(text), sum(marks), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    df = docs if length >= 400 else docs.where("doc_id IS NULL OR doc_id <> 304")
    got = Counter(tuple(r) for r in bwt_dedup.digests(df, length=length, gram=gram, step=step, hot=hot).collect())
    assert got == want


def test_spans_and_bytes_left_fit_together(docs):
    for r in bwt_dedup.remove_repeats(docs, length=60, gram=24).collect():
        assert r.n_bytes == len(r.kept) + sum(s.hi - s.lo for s in r.spans)


def test_expansion_on_the_transform():
    rng = random.Random(4)
    for _ in range(200):
        strings = [[rng.randint(0, 2) for _ in range(rng.randint(0, 40))] for _ in range(rng.randint(1, 5))]
        length = rng.randint(1, 12)
        symbols, marks = [], []
        for k, (s, m) in enumerate(zip(strings, strings)):
            symbols += s + [-1 - k]
        count = Counter(tuple(s[i : i + length]) for s in strings for i in range(len(s) - length + 1))
        at = 0
        for s in strings:
            marks += [at + i for i in range(len(s) - length + 1) if count[tuple(s[i : i + length])] > 1]
            at += len(s) + 1
        assert bwt_dedup.repeated_starts(np.array(symbols), length).tolist() == marks


def test_every_window_is_in_one_run_and_sections_do_not_matter(monkeypatch):
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 5, 3000).astype(np.uint64)
    symbols[500:900] = 3
    offsets = np.array([0, 0, 700, 705, 2000, 3000])
    whole = runs(symbols, offsets, 40, 10)
    windows = sorted(s for f, n in zip(whole[0], whole[1]) for s in range(f, f + n))
    assert windows == [s for a, b in zip(offsets, offsets[1:]) for s in range(a, b - 39)]
    by_window = {s: a for f, n, a in zip(*whole[:3]) for s in range(f, f + n)}
    monkeypatch.setattr("tickloom.llm.anchors.SECTION", 333)
    cut = runs(symbols, offsets, 40, 10)
    assert {s: a for f, n, a in zip(*cut[:3]) for s in range(f, f + n)} == by_window


def test_empty_table(empty):
    assert bwt_dedup.digests(empty).count() == 0
    assert substring_dedup.digests(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
