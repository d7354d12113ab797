from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from math import floor, isfinite
from pathlib import Path

import pytest
from conftest_words import split_words
from pyspark.sql import functions as F

from tickloom.llm import mixing, topk, warc
from tickloom.session import new_folder


def best(rows, k, every):
    """Every row against every other row."""
    vectors = [(i, [floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(vectors):
        if q % every == 0:
            scores = [(sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(vectors) if m != n and len(a) == len(b)]
            found = sorted((-min(max(s, -(2**63)), 2**63 - 1), i) for s, i in scores)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("query_tile,shard,n", [(4, 7, 90), (1024, 8192, 90), (3, 4, 5), (2, 3, 0)])
def test_search_agrees_with_all_products(spark, query_tile, shard, n):
    rng = random.Random(n + shard)
    rows = [(i, [rng.choice([-1.0, -0.51, 0.0, 0.25, 0.99]) for _ in range(6)]) for i in range(n)]
    if n > 50:
        nan = float("nan")
        rows += [(200, None), (201, [None] * 6), (205, [nan] * 6), (210, [float("inf")] * 6), (215, []), (None, rows[0][1]), (220, [1e6] * 6)]
        rows += [rows[3]] * 2 + [rows[5]] * 3 + [(5, [0.99] * 6), (230, [0.5] * 3), (231, [0.25] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS v").repartition(3)
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 64)
    got = topk.top_k(vectors, F.col("id") % 5 == 0, 4, query_tile, shard)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == best(rows, 4, 5)


def test_products_beyond_floating_point_are_exact(spark):
    rows = [(0, [float(2**40), 1.0]), (1, [2.0**10, 3.0]), (2, [2.0**10, 2.0]), (3, [2.0**10, 2.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "i long, v array<double>"), "i", "v", 64)
    assert [r.id for r in topk.top_k(vectors, F.col("id") == 0, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_sums_beyond_a_long_are_held_at_its_ends(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 0.0]), (2, [1e30, 5.0]), (3, [2e9, 0.0]), (4, [3.0e8, 1e30]), (5, [0.5, 0.5])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "i long, v array<double>"), "i", "v", 64)
    held = [(i, [max(-(2**63), min(2**63 - 1, floor(64 * x))) for x in v]) for i, v in rows]
    want = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(held[0][1], v)))), i) for i, v in held[1:])
    got = topk.top_k(vectors, F.col("id") == 0, 5).orderBy("rank").collect()
    assert [(-r.score, r.id) for r in got] == want


@pytest.fixture
def pages(spark):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(i, f"http://x/{i}", f"<html>{i}</html>" * (i % 90)) for i in range(60)]
    rows += [(100 + k, "http://copy", big) for k in range(9)] + [(103, "http://copy", big)] + [(150 + k, None, "short") for k in range(3)]
    rows += [(200, None, None), (201, "http://a b\r\nEvil: 1", ""), (None, "u", big), (None, None, None), (300, "long", "é\n" * 700_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS id", "2 AS bytes").repartition(4)


def test_archives_come_back_as_pages(pages):
    rows, df = pages
    last = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and i is not None:
            last[raw] = max(last.get(raw, i), i)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        target = last.get(raw) if len(raw) >= 1000 else None
        target = None if target == i else target
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if target is None else "revisit", target, True] += 1
    got = warc.round_trip(df)
    assert Counter(tuple(r[c] for c in ("id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")) for r in got.collect()) == want


def test_records_are_plain_warc_and_chunks_carry_their_digest(pages, spark):
    written, df = pages
    folder = new_folder(spark, "warc-test")
    rows = df.selectExpr("page_id AS id", "url", "html", "CAST(NULL AS long) AS refers_to")
    archives = warc.write_archives(rows, folder)
    raw = b"".join(gzip.decompress(Path(r.file.removeprefix("file:")).read_bytes()) for r in archives.collect())
    assert raw.count(b"WARC-Type: response\r\n") == len(written)
    assert b"WARC-Target-URI: http://a%20b%0D%0AEvil:%201\r\n" in raw
    html = "é\n" * 700_000
    told = base64.b32encode(hashlib.sha1(html.encode()).digest())
    assert b"WARC-Payload-Digest: sha1:" + told in raw
    parts = sorted((r.chunk, r) for r in warc.read_chunks(archives, chunk_bytes=100_000).where("id = 300").collect())
    assert b"".join(bytes(r.data) for _, r in parts).decode() == html
    running, size = hashlib.sha1(), 0
    for number, r in parts:
        running.update(r.data)
        size += len(r.data)
        assert (r.digest, r.bytes, r.last) == (running.hexdigest(), size, number == len(parts) - 1)
        assert len(r.data) <= 100_000


def test_damaged_archives_are_refused(spark):
    with pytest.raises(ValueError):
        list(warc._records(_Bytes(gzip.compress(b"HTTP/1.1 200\r\n\r\n")), 10, True))
    with pytest.raises((ValueError, zlib.error)):
        list(warc._records(_Bytes(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 90\r\n\r\nHTTP/1.1 200 OK\r\n\r\nab")), 10, True))


class _Bytes:
    def __init__(self, raw):
        self.raw = raw

    def read(self, n):
        out, self.raw = self.raw[:n], self.raw[n:]
        return out


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, held = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        level = (budget - sum(held.values())) / max(1, sum(weight[s] for s in free))
        above = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not above:
            return held | {s: level * weight[s] for s in free}
        held |= {s: 2.0 * sizes[s] for s in above}


def test_mix_meets_its_targets(docs, corpus):
    sizes = defaultdict(int)
    for _, t, _, s in corpus:
        sizes[s] += len(split_words(t))
    want = targets(sizes)
    got = mixing.mix(docs).collect()
    assert len(got) == len(corpus)
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        s = None if r.no_source else r.source
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - want[s]) <= 2 * most[s] for s in sizes)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_buckets_change_nothing(docs, monkeypatch):
    once = Counter(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    assert Counter(map(tuple, mixing.mix(docs).collect())) == once


def test_mixture_has_the_documents_as_often_as_the_mix(docs, corpus):
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    # By id, source and text where the id is unique; rows that repeat an id share its copies.
    want = defaultdict(int)
    for r in mixing.mix(docs).collect():
        want[r.id, None if r.no_source else r.source] += r.times
    have = defaultdict(int)
    for (i, _, s), n in got.items():
        have[i, s] += n
    assert {k: v for k, v in want.items() if v} == dict(have)


def test_sources_in_code_point_order_over_many_ranges(spark):
    names = ["b", "a", "Z", "é", "aa", "", "\U0001f600", "￿", None]
    rows = [(k, "w " * 10, s) for k, s in enumerate(names)]
    got = {None if r.no_source else r.source: r.target for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == pytest.approx(targets({s: 10 for s in names}))


def test_nothing_to_mix(empty, spark):
    assert mixing.mix(empty).count() == 0 and mixing.mixture(empty).count() == 0
    blank = spark.createDataFrame([(1, "", "s"), (2, None, "s")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_equal_finish_times_of_many_sources_stand_or_fall_together(spark, monkeypatch):
    """Sources of one document each: those of one weight all end at the same times."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rows = [(k, "w " * 10, f"s{k:03d}") for k in range(120)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_weight = defaultdict(set)
    for r in got:
        by_weight[(3, 1, 2)[r.id % 3]].add((r.taken, round(r.target, 6)))
    want = targets({f"s{k:03d}": 10 for k in range(120)})
    ends = sorted((10 * again / want[s], 10) for s in want for again in (1, 2))
    budget, total, last = 1.5 * 1200, 0, -1.0
    for end in sorted({e for e, _ in ends}):
        total += sum(n for e, n in ends if e == end)
        if total > budget:
            break
        last = end
    assert {w: {t for t, _ in found} for w, found in by_weight.items()} == {
        w: {10 * sum(10 * again / want[f"s{k:03d}"] <= last for again in (1, 2))} for k, w in enumerate((3, 1, 2))
    }
