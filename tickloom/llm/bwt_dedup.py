"""Operator 10: byte-exact removal of repeated strings by interval expansion on a Burrows-Wheeler
transform."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.anchors_join import (
    Winnow,
    candidates,
    crowded,
    distinct_runs,
    keyed,
    occurrences,
    repeated_ranges,
    spans,
    stored,
    with_texts,
)
from tickloom.llm.arrays import gram_hashes, rows_of, text_bytes

LENGTH = 400
GRAM = 160
#: Windows that are looked at together; all but this less one of their symbols are common to them.
STEP = 16
#: Symbols of a block that one transform is built over.
BLOCK = 1_000_000
#: Pieces with the same core up to which they go into blocks.
HOT = 50_000


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of an integer text by prefix doubling; negative symbols end strings
    and are all different."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        sorted_key = key[order]
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """Places where a string of `length` symbols begins that also begins elsewhere.

    symbols: strings one after the other, each ended by a negative symbol of its own. Breadth-first
    on the transform: the suffixes with a common prefix of l symbols are an interval, bounded where
    the common prefix of neighbours is shorter. Extending all intervals backward by each symbol
    gives those of l + 1: two suffixes that stand next to each other among those behind one symbol
    part at l + 1 exactly if a bound of length l lies between them. So common prefixes come out by
    increasing value, and the search ends at `length`, where what has no bound yet repeats.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros(0, np.int64)
    order = suffix_order(symbols)
    before = symbols[order - 1]  # the transform: the symbol before each suffix
    before = np.where((order == 0) | (before < 0), -1, before)
    came_from = np.argsort(before, kind="stable")  # place by place: the suffix that is extended to it
    bound = np.zeros(n, bool)
    heads = symbols[order]
    bound[0] = True
    bound[1:] = (heads[1:] != heads[:-1]) | (heads[1:] < 0)
    open_ = np.flatnonzero(~bound)
    for _ in range(1, length):
        if not len(open_):
            break
        bounds = np.cumsum(bound)
        parted = bounds[came_from[open_]] > bounds[came_from[open_ - 1]]
        bound[open_[parted]] = True
        open_ = open_[~parted]
    return np.unique(np.concatenate([order[open_], order[open_ - 1]]))


def block_marks(cores: np.ndarray, lefts: list[bytes], rights: list[bytes], step: int) -> list[np.ndarray]:
    """For each piece the places in its left part, its end included, whose window repeats in the block.

    A piece is its bytes before the core, the core, and its bytes after it. Equal cores are one
    symbol, so windows become strings of `step` symbols around it.
    """
    sizes = np.array([len(a) + len(b) + 2 for a, b in zip(lefts, rights)])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = b"".join([a + b"\0" + b + b"\0" for a, b in zip(lefts, rights)])
    symbols = np.frombuffer(raw, np.uint8).astype(np.int64)
    at_core = starts + np.array([len(a) for a in lefts])
    symbols[at_core] = 256 + np.unique(cores, return_inverse=True)[1]
    symbols[ends - 1] = -1 - np.arange(len(ends))
    found = repeated_starts(symbols, step)
    piece = np.searchsorted(ends, found, side="right")
    out = np.split(found - starts[piece], np.searchsorted(piece, np.arange(1, len(ends))))
    return out


def _pieces(texts: DataFrame, length: int, gram: int, step: int) -> DataFrame:
    """(k1, k2, lhs, rhs, anchor, seg, at): the runs cut into pieces of up to `step` windows.

    The cut is made at fixed distances from the anchor, so equal windows are at the same place of
    pieces with the same core; k1 and k2 are a 128-bit hash of the core. `at` is the place of the
    first window in the run.
    """
    schema = pa.schema(
        [("k1", pa.int64()), ("k2", pa.int64()), ("lhs", pa.binary()), ("rhs", pa.binary()), ("anchor", pa.int64()), ("seg", pa.int64()), ("at", pa.int32())]
    )
    core = length - step + 1

    def cut_run(text: bytes, start: int, n: int, anchor: int, seg: int):
        raw = text[start : start + n + length - 1]
        hashes = gram_hashes(np.frombuffer(raw, np.uint8).astype(np.uint64), gram).view(np.int64)
        places = np.flatnonzero(hashes == anchor)
        s = np.arange(n)
        place = places[np.searchsorted(places, s)]
        core_at = place - (place - s) // step * step
        edges = np.concatenate([[0], np.flatnonzero(core_at[1:] != core_at[:-1]) + 1, [n]]).tolist()
        for a, b in zip(edges, edges[1:]):
            c = int(core_at[a])
            k = xxhash.xxh3_128_digest(raw[c : c + core])
            yield (
                int.from_bytes(k[:8], "big", signed=True), int.from_bytes(k[8:], "big", signed=True),
                raw[a:c], raw[c + core : b - 1 + length], anchor, seg, a,
            )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, runs_ in zip(text_bytes(batch.column(0)), batch.column(1)):
                for run in runs_.as_py():
                    rows.extend(cut_run(text, run["start"], run["n"], run["anchor"], run["seg"]))
                    if len(rows) > 20_000:
                        yield rows_of(schema, *zip(*rows))
                        rows = []
            if rows:
                yield rows_of(schema, *zip(*rows))

    kinds = "k1 long, k2 long, lhs binary, rhs binary, anchor long, seg long, at int"
    return texts.mapInArrow(each, kinds)


_MARKS = "anchor long, seg long, lo int, hi int"
_MARK_SCHEMA = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _runs_of(places: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(places):
        edges = np.flatnonzero(np.diff(places) != 1) + 1
        for part in np.split(places, edges):
            yield int(part[0]), int(part[-1]) + 1


def _block_marks(pieces: DataFrame, step: int, block: int) -> DataFrame:
    """Marks of pieces whose cores are not crowded: whole groups of a core together in blocks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def marks(rows: dict):
            cores = np.stack([rows["k1"], rows["k2"]], axis=1)
            ids = np.concatenate([[0], np.cumsum((cores[1:] != cores[:-1]).any(axis=1))]) if len(cores) else rows["k1"]
            out = []
            for k, places in enumerate(block_marks(ids, rows["lhs"], rows["rhs"], step)):
                for lo, hi in _runs_of(places):
                    out.append((rows["anchor"][k], rows["seg"][k], rows["at"][k] + lo, rows["at"][k] + hi))
            if out:
                yield rows_of(_MARK_SCHEMA, *zip(*out))

        def joined() -> dict:
            return {
                n: np.concatenate([h[n] for h in held]) if n not in ("lhs", "rhs") else [x for h in held for x in h[n]]
                for n in held[0]
            }

        names = ["k1", "k2", "lhs", "rhs", "anchor", "seg", "at"]
        size = 0
        for batch in batches:
            held.append(
                {n: batch.column(i).to_pylist() if n in ("lhs", "rhs") else batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
            )
            size += batch.num_rows * (step + 2) * 2
            if size > block:
                rows = joined()
                last = len(rows["k1"]) - 1
                open_ = (rows["k1"] == rows["k1"][last]) & (rows["k2"] == rows["k2"][last])
                cut = int(np.argmax(open_))
                if cut:
                    yield from marks({n: v[:cut] for n, v in rows.items()})
                held = [{n: v[cut:] for n, v in rows.items()}]
                size = (last + 1 - cut) * (step + 2) * 2
        if held:
            yield from marks(joined())

    dealt = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return dealt.select("k1", "k2", "lhs", "rhs", "anchor", "seg", "at").mapInArrow(each, _MARKS)


def _crowded_marks(pieces: DataFrame, step: int) -> DataFrame:
    """Marks of pieces with crowded cores: their windows, written out as the bytes beside the core,
    are counted by an aggregate, which no group is too large for."""
    windows = pieces.select(
        "k1", "k2", "lhs", "rhs", "anchor", "seg", "at", F.explode(F.sequence(F.lit(0), F.octet_length("lhs"))).alias("i")
    )
    before = F.octet_length("lhs") - F.col("i")
    windows = windows.where(F.octet_length("rhs") >= step - 1 - before).select(
        "k1", "k2", "anchor", "seg", (F.col("at") + F.col("i")).alias("lo"),
        F.expr("substring(lhs, i + 1)").alias("w1"), F.expr(f"substring(rhs, 1, {step - 1} - (octet_length(lhs) - i))").alias("w2"),
    )
    key = ["k1", "k2", "w1", "w2"]
    often = windows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    return windows.join(often, key).select("anchor", "seg", "lo", (F.col("lo") + 1).alias("hi"))


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data.astype(np.uint64), offsets


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(id, tk, ranges) for rows of `keyed`: where strings of `length` bytes begin that begin elsewhere too.

    Texts are joined on winnowed anchors. A run of windows that is equal wherever its anchor is found
    is decided by that; one each of the others is cut into pieces, and the pieces that share all
    but a few bytes with another go through the transform in blocks.
    """
    found = stored(occurrences(rows, Winnow(length, gram, _bytes)), "anchors")
    cands = stored(candidates(found), "candidates")
    reps = distinct_runs(cands)
    pieces = stored(_pieces(with_texts(reps, rows), length, gram, step), "pieces")
    few, many = crowded(pieces, ["k1", "k2"], hot)
    marks = _block_marks(few, step, block).union(_crowded_marks(many, step))
    return repeated_ranges(cands, reps, marks)


def _removed(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, step: int, hot: int, kinds: str, schema: pa.Schema, make) -> DataFrame:
    rows = keyed(docs, id_col, text_col)
    ranges = repeats(rows, length, gram, step, hot)
    joined = rows.join(ranges, ["id", "tk"], "left").select("doc_id", "text", "ranges")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, ranges_ in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                cut = spans([(r["lo"], r["hi"]) for r in ranges_ or []], length)
                out.append((doc_id, len(text), *make(text, cut)))
            if out:
                yield rows_of(schema, *zip(*out))

    return joined.mapInArrow(each, kinds)


def _kept(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in cut:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, step: int = STEP, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed runs of bytes, and the bytes left.

    A byte goes if a string of `length` bytes over it begins anywhere else, in the same text or in
    another; all copies go. Texts are taken as UTF-8, and what is left may begin or end inside a
    character. A null text is empty. A null id stays null. Rows that repeat an id and a text are
    copies of each other. Texts shorter than `length` stay whole.
    """
    span = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])
    kinds = "doc_id long, n_bytes long, spans array<struct<lo: long, hi: long>>, kept binary"

    def make(text: bytes, cut: list[tuple[int, int]]):
        return [{"lo": a, "hi": b} for a, b in cut], _kept(text, cut)

    return _removed(docs, id_col, text_col, length, gram, step, hot, kinds, schema, make)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, step: int = STEP, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, as `remove_repeats` cuts it."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def make(text: bytes, cut: list[tuple[int, int]]):
        return sum(b - a for a, b in cut), len(cut), hashlib.sha256(_kept(text, cut)).hexdigest()

    return _removed(docs, id_col, text_col, length, gram, step, hot, kinds, schema, make)
