"""Operator 4: SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import contract_batches, rows_of, text_bytes
from tickloom.llm.components import components, contract, cut

SEED = 42
TILE = 256
#: Distinct fingerprints of one bucket up to which it is compared in tiles.
HOT = 20_000
#: Shingles whose bits are counted together; bounds the memory of a very long text.
BLOCK = 8_192
#: 64-bit words of a wide fingerprint.
WIDE = 4
#: Differing bits of 256 up to which documents count as near copies. At a similarity of 0.8 (equal
#: share of all different shingles) 15 bits of 100 differ on average, 39 of 256, give or take 6.
WIDE_RADIUS = 48
#: Share of pairs at a similarity of 0.8 that may share no bucket, and documents of a bucket, about.
MISSED, BUCKET_ROWS = 0.02, 512


def fingerprint(text: bytes, size: int = 3) -> int:
    """The 64-bit fingerprint of one text (UTF-8).

    A-Z become lower case, words are runs of bytes other than ASCII white space, shingles are
    `size` words joined by a space, repeats included. A text with fewer words is one shingle, one
    without words gives 0. A bit is set if it is set in over half of the shingles' XXH64.
    """
    hashes = _shingle_hashes(text, size)
    set_bits = _bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _shingle_hashes(text: bytes, size: int) -> np.ndarray:
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :].tolist())), np.uint64, len(starts)
    )


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return counts


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = 3) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed long."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, size) for t in text_bytes(batch.column(1))], np.uint64)
            yield rows_of(schema, batch.column(0), found.view(np.int64))

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(each, "id long, fp long")


def _planes(fps: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint under keys of which two fingerprints at most `radius` bits apart share one.

    Up to 2 bits: the bits are cut into radius + 1 parts, and one part must be equal. Beyond: they
    are cut into a third as many parts, of which one differs in 2 bits at most; such parts are both
    one bit or none away from some value, so a part's keys are all values up to one bit from it.
    """
    flips = radius > 2
    parts = (radius + 3) // 3 if flips else radius + 1
    edges = [64 * i // parts for i in range(parts + 1)]
    keys = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned(F.shiftleft("fp", 64 - hi), 64 - hi + lo)
        masks = [0, *(1 << k for k in range(hi - lo))] if flips else [0]
        keys += [F.struct(F.lit(i).alias("plane"), value.bitwiseXOR(F.lit(m).cast("long")).alias("key")) for m in masks]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.plane", "k.key", "fp")


def _tile_links(rows: Iterator[pa.RecordBatch], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within each bucket of rows sorted by bucket and population count.

    A tile of rows is compared with every later tile of its buckets by exclusive-or and bit count;
    a pair of tiles whose population counts differ by more than the radius is skipped.
    """
    held = [np.zeros(0, np.int64)] * 3  # plane, key, fp of buckets that are not finished

    def compare(plane, key, fp):
        bucket = np.concatenate([[0], np.cumsum((plane[1:] != plane[:-1]) | (key[1:] != key[:-1]))]) if len(fp) else fp
        bits = fp.view(np.uint64)
        ones = np.bitwise_count(bits).astype(np.int16)
        for i in range(0, len(fp), TILE):
            top = min(i + TILE, len(fp))
            end = int(np.searchsorted(bucket, bucket[top - 1], side="right"))
            for j in range(i, end, 4 * TILE):
                stop = min(j + 4 * TILE, end)
                if bucket[i] == bucket[stop - 1] and ones[j] - ones[top - 1] > radius:
                    break  # one bucket only, sorted by population count: no later tile can match
                apart = np.bitwise_count(bits[i:top, None] ^ bits[None, j:stop])
                x, y = np.nonzero((apart <= radius) & (bucket[i:top, None] == bucket[None, j:stop]))
                later = x + i < y + j
                if later.any():
                    yield contract(fp[i + x[later]], fp[j + y[later]])

    for batch in rows:
        new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        held = [np.concatenate([h, n]) for h, n in zip(held, new)]
        if len(held[2]) < 50_000:
            continue
        open_ = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
        done = ~open_
        if done.any():
            yield from compare(*[h[done] for h in held])
            held = [h[open_] for h in held]
    yield from compare(*held)


def links(fps: DataFrame, radius: int = 2, hot: int = HOT) -> DataFrame:
    """(a, b) pairs of distinct fingerprints, at most `radius` bits apart, that tie together all
    that are so linked.

    Fingerprints are dealt out by parts of their bits, so that tiles meet only where a link is
    possible, and each task returns a spanning set of its links. A bucket of more than `hot`
    distinct fingerprints, which more tasks could not shorten, goes another exact way: up to 3 bits
    a linear one, see `_midpoint_links`, beyond that its tile pairs are dealt out, see `_pair_links`.
    """
    planes = _planes(fps, radius)
    sizes = planes.groupBy("plane", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    planes = planes.join(sizes, ["plane", "key"], "left")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in contract_batches(_tile_links(batches, radius), contract):
            yield rows_of(schema, a, b)

    tiled = (
        planes.where("n IS NULL")
        .select("plane", "key", "fp")
        .repartition("plane", "key")
        .sortWithinPartitions("plane", "key", F.bit_count("fp"), "fp")
        .mapInArrow(tiles, "a long, b long")
    )
    crowded = planes.where("n IS NOT NULL")
    if radius <= 3:
        return tiled.union(_midpoint_links(crowded.select("fp").distinct(), radius))
    return tiled.union(_pair_links(crowded, radius, hot))


def _pair_links(crowded: DataFrame, radius: int, hot: int) -> DataFrame:
    """Links within crowded buckets, tile pair by tile pair over many tasks.

    A bucket's tiles are its population counts, each cut by hash into tiles of about hot / 8
    fingerprints; only pairs whose counts differ by the radius at most are made.
    """
    share = F.ceil(F.col("n") / F.lit(max(1, hot // 8))).cast("int")
    tiles = crowded.select(
        "plane", "key", "fp", F.bit_count("fp").alias("ones"), F.pmod(F.hash("fp"), share).alias("cut"), share.alias("cuts")
    )
    others = F.sequence(-F.lit(radius), F.lit(radius))
    spread = tiles.withColumn("apart", F.explode(others)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    own = F.struct(F.col("ones").cast("int").alias("o"), F.col("cut").alias("c"))
    far = F.struct((F.col("ones") + F.col("apart")).cast("int").alias("o"), F.col("other").alias("c"))
    paired = spread.select("plane", "key", "fp", F.least(own, far).alias("x"), F.greatest(own, far).alias("y"), (own <= far).alias("first"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared():
            held: list[np.ndarray] = []
            for batch in batches:
                new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
                held = [np.concatenate(x) for x in zip(held, new)] if held else new
                last = held[0] == held[0][-1]
                yield from pairs(*[h[~last] for h in held])
                held = [h[last] for h in held]
            if held:
                yield from pairs(*held)

        def pairs(pair, fp, first):
            edges = np.flatnonzero(np.diff(pair)) + 1
            for fps, side in zip(np.split(fp, edges), np.split(first, edges)):
                if not len(fps):
                    continue
                a, b = fps[side], fps[~side]
                b = b if len(b) else a
                for at in range(0, len(a), TILE):
                    apart = np.bitwise_count(a[at : at + TILE, None].view(np.uint64) ^ b[None, :].view(np.uint64))
                    x, y = np.nonzero((apart <= radius) & (a[at : at + TILE, None] != b[None, :]))
                    if len(x):
                        yield contract(a[at + x], b[y])

        for a, b in contract_batches(compared(), contract):
            yield rows_of(schema, a, b)

    named = paired.select(F.xxhash64("plane", "key", "x", "y").alias("pair"), "fp", "first")
    return named.repartition("pair").sortWithinPartitions("pair").mapInArrow(each, "a long, b long")


def _midpoint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links among the fingerprints of crowded buckets.

    Two fingerprints are at most 2 * h bits apart exactly if some value lies at most h bits from
    both. Every fingerprint is put under all values up to h = ceil(radius / 2) bits away, and each
    such value ties its fingerprints to the smallest of them; an aggregate finds it, so the size of
    a group does not matter. For an odd radius the values on one side reach one bit less far.
    """
    near = _around(fps, (radius + 1) // 2)
    own = near if radius % 2 == 0 else _around(fps, radius // 2)
    if radius % 2 == 0:
        least = near.groupBy("v").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
        return near.join(least.select("v", "low"), "v").where("fp > low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    # v within h-1 of an "own" fingerprint and within h of a "near" one: all own ones are tied to one
    # another only through v, so both kinds are tied to the smallest own one.
    least = own.groupBy("v").agg(F.min("fp").alias("low"))
    return near.join(least, "v").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def _around(fps: DataFrame, reach: int) -> DataFrame:
    """(v, fp) for every value v at most `reach` bits from fp."""
    out = fps.select(F.col("fp").alias("v"), "fp", F.lit(-1).alias("bit"))
    level = out
    one = F.lit(1).cast("long")
    for _ in range(reach):
        level = level.select(
            "v", "fp", F.explode(F.sequence(F.col("bit") + 1, F.when(F.col("bit") < 63, F.lit(63)))).alias("bit")
        ).select(F.col("v").bitwiseXOR(F.call_function("shiftleft", one, F.col("bit"))).alias("v"), "fp", "bit")
        out = out.union(level)
    return out.select("v", "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2, hot: int = HOT
) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id its links reach.

    Equal fingerprints are one node, however many rows have them. A null id takes part in linking,
    but is no component's name; a component whose ids are all null has a null name. Null and empty
    texts have fingerprint 0 and are linked like any other.
    """
    marked = cut(fingerprints(docs, id_col, text_col, size))
    nodes = cut(marked.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(nodes.select("fp"), radius, hot))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("fp", "component")
    return marked.join(named, "fp").select("id", "fp", "component")


def _scrambled(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of 64-bit values, another one for each k."""
    z = values + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def wide_fingerprint(text: bytes, size: int = 5, hashes: np.ndarray | None = None) -> np.ndarray:
    """The 256-bit fingerprint of one text as four words, over its different shingles.

    A bit that exactly half of the shingles have takes its value from a fixed pattern, so that short
    texts are as far apart as others. A text without words gives zeros. hashes: those of its different
    shingles, where they are at hand.
    """
    hashes = np.unique(_shingle_hashes(text, size)) if hashes is None else hashes
    out = np.zeros(WIDE, np.uint64)
    for k in range(WIDE if len(hashes) else 0):
        twice = 2 * _bit_counts(_scrambled(hashes, k))
        pattern = np.unpackbits(_scrambled(np.zeros(1, np.uint64), k).view(np.uint8), bitorder="little") > 0
        set_bits = (twice > len(hashes)) | ((twice == len(hashes)) & pattern)
        out[k] = np.packbits(set_bits, bitorder="little").view("<u8")[0]
    return out


_WORDS = [f"w{k}" for k in range(WIDE)]


def _names(words: np.ndarray) -> np.ndarray:
    """One 64-bit name for each fingerprint (row of words)."""
    out = np.zeros(len(words), np.uint64)
    for k in range(WIDE):
        out = _scrambled(out ^ words[:, k], k)
    return out.view(np.int64)


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    columns = [batch.column(first + k).to_numpy(zero_copy_only=False) for k in range(WIDE)]
    return np.stack(columns, axis=1).astype(np.int64).view(np.uint64)


def wide_fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = 5) -> DataFrame:
    """(id, node, w0 to w3) for every row: its wide fingerprint, and the fingerprint's name."""
    schema = pa.schema([("id", pa.int64()), ("node", pa.int64()), *[(w, pa.int64()) for w in _WORDS]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words = np.stack([wide_fingerprint(t, size) for t in text_bytes(batch.column(1))])
                yield rows_of(schema, batch.column(0), _names(words), *words.view(np.int64).T.copy())

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(each, "id long, node long, " + ", ".join(f"{w} long" for w in _WORDS))


def bucket_keys(nodes: int) -> list[np.ndarray]:
    """The bits that make up each bucket key: so many bits that a bucket holds about BUCKET_ROWS of
    so many fingerprints, and so many keys that two documents with a similarity of 0.8 have one of
    them equal but for a share of MISSED, whatever their number."""
    bits = max(12, int(np.ceil(np.log2(max(1, nodes) / BUCKET_ROWS))))
    alike = (1 - np.arccos(0.8 * 2 / 1.8) / np.pi) ** bits
    keys = int(np.ceil(np.log(MISSED) / np.log(1 - alike)))
    return [np.random.default_rng(k).permutation(64 * WIDE)[:bits] for k in range(keys)]


def _bucketed(nodes: DataFrame, keys: list[np.ndarray]) -> DataFrame:
    """(key, w0 to w3): every fingerprint under each of its keys."""
    schema = pa.schema([("key", pa.int64()), *[(w, pa.int64()) for w in _WORDS]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _matrix(batch, 0)
            octets = words.astype("<u8").view(np.uint8).reshape(-1, 8 * WIDE)
            bits = np.unpackbits(octets, axis=1, bitorder="little")
            for k, places in enumerate(keys):
                key = bits[:, places] @ (1 << np.arange(len(places), dtype=np.int64)) + (k << 40)
                yield rows_of(schema, key, *[batch.column(i) for i in range(WIDE)])

    return nodes.select(*_WORDS).mapInArrow(each, "key long, " + ", ".join(f"{w} long" for w in _WORDS))


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which rows of a and b differ in `radius` bits at most."""
    apart = np.zeros((len(a), len(b)), np.uint16)
    for k in range(WIDE):
        apart += np.bitwise_count(a[:, None, k] ^ b[None, :, k])
    return apart <= radius


def _groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups of rows that are sorted by their first column, at least so many rows
    at a time but for the last."""
    held: list[np.ndarray] = []
    for batch in batches:
        new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        held = [np.concatenate(x) for x in zip(held, new)] if held else new
        if len(held[0]) >= least and held[0][0] != held[0][-1]:
            done = int(np.searchsorted(held[0], held[0][-1]))
            yield [h[:done] for h in held]
            held = [h[done:] for h in held]
    if held and len(held[0]):
        yield held


def _words_of(columns: list[np.ndarray]) -> np.ndarray:
    return np.stack(columns[:WIDE], axis=1).view(np.uint64)


def _wide_tiles(key: np.ndarray, words: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within each bucket; rows are sorted by key and population count. A tile of rows meets
    every later tile of its buckets; tiles of one bucket whose population counts differ by more than
    the radius do not meet."""
    names = _names(words)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    for i in range(0, len(key), TILE):
        top = min(i + TILE, len(key))
        end = int(np.searchsorted(key, key[top - 1], side="right"))
        for j in range(i, end, 4 * TILE):
            stop = min(j + 4 * TILE, end)
            if key[i] == key[stop - 1] and ones[j] - ones[top - 1] > radius:
                break
            x, y = np.nonzero(_near(words[i:top], words[j:stop], radius) & (key[i:top, None] == key[None, j:stop]))
            later = x + i < y + j
            if later.any():
                yield contract(names[i + x[later]], names[j + y[later]])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def wide_links(nodes: DataFrame, keys: list[np.ndarray], radius: int = WIDE_RADIUS, hot: int = HOT) -> DataFrame:
    """(a, b): names that tie together all fingerprints under one of the keys that are at most
    `radius` bits apart, directly or through others."""
    return links_in_buckets(_bucketed(nodes, keys), radius, hot)


def links_in_buckets(placed: DataFrame, radius: int, hot: int = HOT) -> DataFrame:
    """(a, b): names that tie together all fingerprints of a bucket, rows (key, w0 to w3), that are
    at most `radius` bits apart, directly or through others.

    Each task compares the tiles of its buckets and returns a spanning set of the links it finds. The
    tile pairs of a bucket of more than `hot` fingerprints are dealt out over tasks.
    """
    large = cut(placed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot))
    split = not large.isEmpty()
    few = placed.join(large, "key", "left_anti") if split else placed

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (link for g in _groups(batches, 20_000) for link in _wide_tiles(g[0], _words_of(g[1:]), radius))
        for a, b in contract_batches(found, contract):
            yield rows_of(_LINKS, a, b)

    ones = sum((F.bit_count(w) for w in _WORDS[1:]), F.bit_count(_WORDS[0]))
    tiled = (
        few.repartition("key").withColumn("ones", ones).sortWithinPartitions("key", "ones").select("key", *_WORDS)
        .mapInArrow(tiles, "a long, b long")
    )
    return tiled.union(_wide_pairs(placed.join(large, "key"), radius, hot)) if split else tiled


def _wide_pairs(crowded: DataFrame, radius: int, hot: int) -> DataFrame:
    """Links within crowded buckets: each is cut by hash into tiles of about hot / 8 fingerprints,
    and every pair of its tiles is compared in one place."""
    share = F.ceil(F.col("n") / F.lit(max(1, hot // 8))).cast("int")
    spread = crowded.withColumn("own", F.pmod(F.hash(*_WORDS), share)).withColumn("other", F.explode(F.sequence(F.lit(0), share - 1)))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    paired = spread.select(pair.alias("pair"), *_WORDS, (F.col("own") <= F.col("other")).alias("first"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for columns in _groups(batches, 1):
            words, first = _words_of(columns[1:]), columns[-1].astype(bool)
            for at in np.split(np.arange(len(first)), np.flatnonzero(np.diff(columns[0])) + 1):
                a, b = words[at[first[at]]], words[at[~first[at]]]
                b = b if len(b) else a
                for k in range(0, len(a), TILE):
                    x, y = np.nonzero(_near(a[k : k + TILE], b, radius))
                    if len(x):
                        yield contract(_names(a[k + x]), _names(b[y]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in contract_batches(compared(batches), contract):
            yield rows_of(_LINKS, a, b)

    return paired.repartition("pair").sortWithinPartitions("pair").mapInArrow(each, "a long, b long")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, radius: int = WIDE_RADIUS, hot: int = HOT
) -> DataFrame:
    """(id, node, component): the smallest id that each row reaches through texts with a similarity
    of about 0.8 or more, by wide fingerprints of `size`-word shingles.

    Texts with equal fingerprints are one node, however many rows have them, and texts without words
    are alike. A null id takes part, but names no component; one whose ids are all null has a null
    name. Rows that repeat an id have one component each, by their texts.
    """
    marked = cut(wide_fingerprints(docs, id_col, text_col, size))
    nodes = cut(marked.groupBy("node", *_WORDS).agg(F.min("id").alias("least")))
    found = components(wide_links(nodes, bucket_keys(nodes.count()), radius, hot))
    rooted = nodes.join(found.withColumn("_n", F.col("node")).drop("node"), F.col("node") == F.col("_n"), "left")
    rooted = rooted.select("node", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("node", "component")
    return marked.select("id", "node").join(named, "node").select("id", "node", "component")
