"""Operator 3: removal of repeated word sequences by seed and extend."""

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

LENGTH = 35
GRAM = 12
#: Seeds with the same anchor up to which they are extended together.
HOT = 20_000
#: Seeds that are extended together, about.
BLOCK = 20_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw, edges = data.tobytes(), offsets.tolist()
    found = [raw[a:b].split() for a, b in zip(edges, edges[1:])]
    return word_hashes([w for words in found for w in words]), np.cumsum([0, *map(len, found)])


def _classes(seed: np.ndarray, steps: np.ndarray, present: np.ndarray) -> list[np.ndarray]:
    """Classes of the seeds after each step of extension: seeds stay in one class while they had
    equal words so far. A seed alone in its class, or at the end of its words, has none (-1)."""
    out = [seed]
    for k in range(steps.shape[1]):
        now = np.full(len(seed), -1, np.int64)
        on = np.flatnonzero((out[-1] >= 0) & present[:, k])
        if len(on):
            word = np.unique(steps[on, k], return_inverse=True)[1]
            _, at, count = np.unique(out[-1][on] * (word.max() + 1) + word, return_inverse=True, return_counts=True)
            now[on] = np.where(count[at] > 1, at, -1)
        out.append(now)
    return out


def extend(anchors: np.ndarray, words: list[np.ndarray], lead: np.ndarray, windows: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which windows of each seed repeat among the seeds: a matrix (seed, window from its first).

    Each seed is a stretch of words with the anchor's gram `lead` words from its start, holding
    `windows` windows around it. All seeds are extended word by word, to the left and to the
    right, as far as another has the same words. A window repeats if two seeds go on together to
    its left end and to its right end.
    """
    reach = length - gram
    n = len(anchors)
    left, right = np.zeros((n, reach), np.uint64), np.zeros((n, reach), np.uint64)
    has_left, has_right = np.zeros((n, reach), bool), np.zeros((n, reach), bool)
    for k, w in enumerate(words):
        a = int(lead[k])
        left[k, :a], has_left[k, :a] = w[:a][::-1], True
        b = min(reach, len(w) - a - gram)
        right[k, :b], has_right[k, :b] = w[a + gram : a + gram + b], True
    seed = np.unique(anchors, return_inverse=True)[1].astype(np.int64)
    to_left, to_right = _classes(seed, left, has_left), _classes(seed, right, has_right)
    marks = np.zeros((n, reach + 1), bool)
    for i in range(reach + 1):
        a, b = to_left[i], to_right[reach - i]
        on = np.flatnonzero((a >= 0) & (b >= 0) & (lead >= i) & (lead - i < windows))
        if len(on):
            _, at, count = np.unique(a[on] * (b.max() + 1) + b[on], return_inverse=True, return_counts=True)
            again = on[count[at] > 1]
            marks[again, lead[again] - i] = True
    return marks


def _seeds(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, lead, windows, words, seg, at): the runs cut where the place of the anchor's gram
    changes, with the hashes of their words; `at` is the first window's place in the run."""
    schema = pa.schema(
        [("anchor", pa.int64()), ("lead", pa.int32()), ("windows", pa.int32()), ("words", pa.binary()), ("seg", pa.int64()), ("at", pa.int32())]
    )

    def cut_run(hashes: np.ndarray, grams: np.ndarray, run: dict):
        start, n = run["start"], run["n"]
        places = np.flatnonzero(grams[start : start + n + length - gram] == run["anchor"])
        s = np.arange(n)
        place = places[np.searchsorted(places, s)]
        edges = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [n]]).tolist()
        for a, b in zip(edges, edges[1:]):
            words = hashes[start + a : start + b - 1 + length].tobytes()
            yield run["anchor"], int(place[a]) - a, b - a, words, run["seg"], a

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, runs_ in zip(text_bytes(batch.column(0)), batch.column(1)):
                hashes = word_hashes(text.split())
                grams = gram_hashes(hashes, gram).view(np.int64)
                for run in runs_.as_py():
                    rows.extend(cut_run(hashes, grams, run))
                    if len(rows) > 10_000:
                        yield rows_of(schema, *zip(*rows))
                        rows = []
            if rows:
                yield rows_of(schema, *zip(*rows))

    return texts.mapInArrow(each, "anchor long, lead int, windows int, words binary, seg long, at int")


_MARKS = "anchor long, seg long, lo int, hi int"
_MARK_SCHEMA = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def _extended(seeds: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """Marks of seeds whose anchors are not crowded: all seeds of an anchor are extended together."""
    names = ["anchor", "lead", "windows", "words", "seg", "at"]

    def marks(rows: dict):
        words = [np.frombuffer(w, np.uint64) for w in rows["words"]]
        found = extend(rows["anchor"], words, rows["lead"].astype(np.int64), rows["windows"], length, gram)
        seed, window = np.nonzero(found)
        if not len(seed):
            return
        first = np.ones(len(seed), bool)
        first[1:] = (seed[1:] != seed[:-1]) | (window[1:] != window[:-1] + 1)
        heads = np.flatnonzero(first)
        lo = rows["at"][seed[heads]] + window[heads]
        hi = lo + np.diff(np.append(heads, len(seed)))
        yield rows_of(_MARK_SCHEMA, rows["anchor"][seed[heads]], rows["seg"][seed[heads]], lo, hi)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            new = {
                n: batch.column(i).to_pylist() if n == "words" else batch.column(i).to_numpy(zero_copy_only=False)
                for i, n in enumerate(names)
            }
            held = new if held is None else {n: held[n] + new[n] if n == "words" else np.concatenate([held[n], new[n]]) for n in names}
            if len(held["anchor"]) > block:
                cut = int(np.argmax(held["anchor"] == held["anchor"][-1]))
                if cut:
                    yield from marks({n: v[:cut] for n, v in held.items()})
                    held = {n: v[cut:] for n, v in held.items()}
        if held is not None and len(held["anchor"]):
            yield from marks(held)

    return seeds.repartition("anchor").sortWithinPartitions("anchor").select(*names).mapInArrow(each, _MARKS)


def _crowded_marks(seeds: DataFrame, length: int) -> DataFrame:
    """Marks of seeds of crowded anchors: their windows, extended in full, are counted by an
    aggregate, which no group is too large for."""
    windows = seeds.select("anchor", "seg", "at", "words", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("i"))
    windows = windows.select("anchor", "seg", (F.col("at") + F.col("i")).alias("lo"), F.expr(f"substring(words, 8 * i + 1, {8 * length})").alias("w"))
    often = windows.groupBy("anchor", "w").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "w")
    return windows.join(often, ["anchor", "w"]).select("anchor", "seg", "lo", (F.col("lo") + 1).alias("hi"))


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(id, tk, ranges) for rows of `keyed`: where sequences of `length` words begin that begin
    elsewhere too. Words are compared by 64-bit hashes, anchors by the hash of their words."""
    found = stored(occurrences(rows, Winnow(length, gram, _words)), "anchors")
    cands = stored(candidates(found), "candidates")
    reps = distinct_runs(cands)
    seeds = stored(_seeds(with_texts(reps, rows), length, gram), "seeds")
    few, many = crowded(seeds, ["anchor"], hot)
    marks = _extended(few, length, gram, block).union(_crowded_marks(many, length))
    return repeated_ranges(cands, reps, marks)


def _kept_words(text: bytes, ranges: list | None, length: int) -> tuple[list[bytes], int, list[tuple[int, int]]]:
    words = text.split()
    cut = spans([(r["lo"], r["hi"]) for r in ranges or []], length)
    at, kept = 0, []
    for a, b in cut:
        kept += words[at:a]
        at = b
    return kept + words[at:], len(words), cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The rows of docs with the repeated words taken out of the text.

    A word goes if a window of `length` words over it begins anywhere else, in the same text or in
    another; all copies go. Words are runs of anything but ASCII white space. A text that loses
    nothing stays as it is, line ends included; in others the words left are joined by one space.
    A null text stays null. Rows that repeat an id and a text are copies of each other; a null id
    stays null; further columns stay as they are.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    slim = packed.select("_i", "_t")
    ranges = repeats(keyed(slim, "_i", "_t"), length, gram, hot)
    text = F.coalesce(F.col("_t").cast("string"), F.lit(""))
    named = packed.select(
        "row", text.alias("text"), F.coalesce(F.col("_i").cast("long"), F.xxhash64(text)).alias("id"), F.hash(text).alias("tk")
    )
    joined = named.join(ranges, ["id", "tk"], "left")
    whole = joined.where("ranges IS NULL").select("row.*")
    schema = pa.schema([("text", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                b" ".join(_kept_words(t, r, length)[0]).decode()
                for t, r in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, schema[0].type), batch.column(2)], names=["text", "row"])

    kind = joined.select("text", "row").schema
    cut = joined.where("ranges IS NOT NULL").select("text", "ranges", "row").mapInArrow(each, kind)
    return whole.unionByName(cut.withColumn("row", F.col("row").withField(text_col, F.col("text"))).select("row.*"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256) of every row; the words kept are joined by
    one space. A null text has no words."""
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(repeats(rows, length, gram, hot), ["id", "tk"], "left").select("doc_id", "text", "ranges")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, ranges in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                kept, n, cut = _kept_words(text, ranges, length)
                out.append((doc_id, n, n - len(kept), len(cut), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield rows_of(schema, *zip(*out))

    return joined.mapInArrow(each, "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string")
