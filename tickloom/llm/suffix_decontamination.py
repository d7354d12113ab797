"""Operator 12: benchmark passages in documents, found in suffix arrays of the documents.

Every block of documents gets a suffix array of its words, and the windows in which the suffixes of
the items begin are looked up in it by binary search. What is found is extended as far as both go on
alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import rows_of, text_bytes, text_parts
from tickloom.llm.terms import TILE_BYTES, split_words, tiles

WINDOW = 10


@dataclass
class Tests:
    """A tile of items: their words numbered from 1, and the different windows their suffixes begin with.

    keys are the windows as rows of integers that hold several words each, smallest and greatest
    continuation; lengths in words; places: (window, item, offset) of every suffix with a window.
    """

    vocabulary: dict[bytes, int]
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray  # what windows begin with: two words, or one
    places: np.ndarray
    texts: list[np.ndarray]
    names: list[str]
    owners: tuple[np.ndarray, np.ndarray]  # first place of each window, and the items by window


def _packing(vocabulary: int, window: int) -> tuple[int, int, int]:
    """Bits of a word, words in an integer, integers of a window."""
    bits = max(1, (vocabulary + 1).bit_length())
    each = max(1, 62 // bits)
    return bits, each, -(-window // each)


def packed(symbols: np.ndarray, at: np.ndarray, vocabulary: int, window: int) -> np.ndarray:
    """The words from each place on as integers in the order of the words; `symbols` goes on for a
    few places after the last."""
    bits, each, number = _packing(vocabulary, window)
    out = np.zeros((number, len(at)), np.int64)
    for n in range(number):
        for j in range(each):
            k = n * each + j
            out[n] <<= bits
            if k < window:
                out[n] |= symbols[at + k]
    return out


def prepare(rows: list[tuple[str, bytes]], window: int = WINDOW) -> Tests | None:
    """The tests of items (name, text); None if no item has a word."""
    split = [(name, split_words(text)) for name, text in rows]
    split = [(name, words) for name, words in split if words]
    if not split:
        return None
    names = sorted({name for name, _ in split})
    number = {name: n for n, name in enumerate(names)}
    vocabulary = {w: n + 1 for n, w in enumerate(sorted({w for _, words in split for w in words}))}
    texts = [np.array([vocabulary[w] for w in words], np.int64) for _, words in split]
    suffixes = []
    for n, (name, words) in enumerate(split):
        size = min(window, len(words))
        suffixes += [(n, k, size, number[name]) for k in range(len(words) - size + 1)]
    text, offset, size, item = np.array(suffixes).T
    base = np.cumsum([0] + [len(t) for t in texts])[:-1]
    joined = np.concatenate([*texts, np.zeros(window, np.int64)])
    at = base[text] + offset
    # Words after a short window count as nothing, and as anything, for its two bounds.
    bits, each, _ = _packing(len(vocabulary), window)
    shown = np.zeros((len(at), window), np.int64)
    most = np.full((len(at), window), (1 << bits) - 1, np.int64)
    for k in range(window):
        on = k < size
        shown[on, k] = most[on, k] = joined[at[on] + k]
    flat = lambda m: packed(np.append(m.ravel(), np.zeros(window, np.int64)), np.arange(len(at)) * window, len(vocabulary), window)
    keys = np.vstack([flat(shown), flat(most)]).T
    different, which = np.unique(keys, axis=0, return_inverse=True)
    which = which.ravel()
    half = keys.shape[1] // 2
    lengths = np.zeros(len(different), np.int64)
    lengths[which] = size
    first_two = joined[at] * (len(vocabulary) + 1) + np.where(size > 1, joined[at + 1], 0)
    owners = np.unique(np.stack([which, item], axis=1), axis=0)
    return Tests(
        vocabulary, different[:, :half].T.copy(), different[:, half:].T.copy(), lengths, np.unique(first_two),
        np.stack([which, item, offset, text], axis=1), texts, names,
        (np.searchsorted(owners[:, 0], np.arange(len(different) + 1)), owners[:, 1]),
    )


def suffix_array(symbols: np.ndarray, tests: Tests, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the suffixes in the order of their first `window` words.

    symbols: numbers of words, 0 for words that no item has and at the end of texts. Suffixes that
    begin as no item's suffix does, in one or two words, cannot match and are left out.
    """
    n = len(tests.vocabulary) + 1
    padded = np.append(symbols, np.zeros(window + 1, np.int64))
    at = np.flatnonzero(symbols)
    pairs = padded[at] * n + padded[at + 1]
    known = lambda x: tests.starts[np.minimum(np.searchsorted(tests.starts, x), len(tests.starts) - 1)] == x
    at = at[known(pairs) | known(padded[at] * n)]
    keys = packed(padded, at, n - 1, window)
    order = np.lexsort(keys[::-1])
    return at[order], keys[:, order]


def _bound(keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all wanted columns among sorted columns at once: the first key that is not
    smaller, or with `after` the first that is greater."""
    low = np.zeros(wanted.shape[1], np.int64)
    high = np.full(wanted.shape[1], keys.shape[1], np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        smaller = np.zeros(len(open_), bool)
        same = np.ones(len(open_), bool)
        for k in range(len(keys)):
            a, b = keys[k, middle], wanted[k, open_]
            smaller |= same & (a < b)
            same &= a == b
        right = smaller | same if after else smaller
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]


def occurrences(symbols: np.ndarray, tests: Tests, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, windows): where each window of the tests occurs in the symbols."""
    places, keys = suffix_array(symbols, tests, window)
    low, high = _bound(keys, tests.low, False), _bound(keys, tests.high, True)
    number = high - low
    windows = np.repeat(np.arange(len(low)), number)
    inside = np.arange(len(windows)) - np.repeat(np.cumsum(number) - number, number)
    return places[low[windows] + inside], windows


def longest(symbols: np.ndarray, places: np.ndarray, windows: np.ndarray, tests: Tests) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, item, text of the item, offset, length): the longest verbatim matches; each cannot be
    extended to either side. Windows are taken a few at a time, as their suffixes multiply them."""
    order = np.argsort(tests.places[:, 0], kind="stable")
    by_window = tests.places[order]
    first = np.searchsorted(by_window[:, 0], np.arange(len(tests.lengths) + 1))
    step = 1 << 16
    padded = np.append(symbols, 0)
    for at in range(0, len(windows), step):
        place, window = places[at : at + step], windows[at : at + step]
        number = first[window + 1] - first[window]
        which = np.repeat(np.arange(len(window)), number)
        k = first[window[which]] + np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        item, offset, text = by_window[k, 1], by_window[k, 2], by_window[k, 3]
        place, length = place[which], tests.lengths[window[which]]
        size = np.array([len(t) for t in tests.texts])
        base = np.cumsum(size) - size
        joined = np.append(np.concatenate(tests.texts), 0)
        # A match that could begin a word earlier is part of a longer one.
        earlier = (offset > 0) & (place > 0)
        earlier[earlier] = joined[base[text[earlier]] + offset[earlier] - 1] == symbols[place[earlier] - 1]
        keep = np.flatnonzero(~earlier)
        place, item, offset, text, length = place[keep], item[keep], offset[keep], text[keep], length[keep].copy()
        going = np.arange(len(place))
        while len(going):
            there = offset[going] + length[going]
            inside = (there < size[text[going]]) & (place[going] + length[going] < len(symbols))
            going = going[inside]
            same = joined[base[text[going]] + offset[going] + length[going]] == padded[place[going] + length[going]]
            going = going[same]
            length[going] += 1
        yield place, item, text, offset, length


def _symbols(data: np.ndarray, offsets: np.ndarray, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of consecutive texts, a 0 behind each text, and where texts begin."""
    raw, edges = data.tobytes(), offsets.tolist()
    get = vocabulary.get
    numbers: list[int] = []
    begins = [0]
    for a, b in zip(edges, edges[1:]):
        numbers += [get(w, 0) for w in split_words(raw[a:b])]
        numbers.append(0)
        begins.append(len(numbers))
    return np.array(numbers, np.int64), np.array(begins)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


_SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def _tests(items: DataFrame, item_col: str, text_col: str, window: int, tile_bytes: int) -> Iterator[Tests]:
    for rows in tiles(items, item_col, text_col, tile_bytes):
        tests = prepare([("" if r["item"] is None else str(r["item"]), r["text"].encode()) for r in rows], window)
        if tests is not None:
            yield tests


def hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(row, n_words, spans, items) of every row of docs: words that lie in a window of an item, as
    disjoint ranges, and the items with such windows, sorted as strings.

    A window is `window` consecutive words of an item, or the whole item if it has fewer; an item
    without words has none. Rows of items that share an id are one item; a null id is the empty
    string. Null texts have no words. `row` holds all columns of docs, and repeated rows are rows
    each. No row moves: tiles of items go to the documents one after the other, and what they find
    is put together on the way.
    """
    spark = docs.sparkSession
    found = docs.select(
        F.struct(F.lit(1).alias(text_col), *[F.col(c) for c in docs.columns if c != text_col]).alias("rest"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<lo: long, hi: long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    kinds = found.schema
    searched = False
    for tests in _tests(items, item_col, item_text_col, window, tile_bytes):
        found = found.mapInArrow(_add_hits(spark.sparkContext.broadcast(tests), window), kinds)
        searched = True
    if not searched:
        found = found.mapInArrow(_count_words, kinds)
    columns = [F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return found.select(F.struct(*columns).alias("row"), "n_words", "spans", "items")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(split_words(t)) for t in text_bytes(batch.column(1))]
        yield batch.set_column(2, "n_words", pa.array(n, pa.int64()))


def _add_hits(shared, window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        first, owned = tests.owners
        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                symbols, begins = _symbols(data, offsets, tests.vocabulary)
                n = len(begins) - 1
                piece = batch.slice(at, n)
                spans, names = piece.column(3).to_pylist(), piece.column(4).to_pylist()
                places, windows = occurrences(symbols, tests, window)
                text = np.searchsorted(begins, places, side="right") - 1
                order = np.lexsort((places, text))
                text, places, windows = text[order], places[order], windows[order]
                edges = np.searchsorted(text, np.arange(n + 1))
                for k in np.unique(text).tolist():
                    mine = slice(edges[k], edges[k + 1])
                    lo = places[mine] - begins[k]
                    # Ranges in order are joined where one before reaches them.
                    reach = np.maximum.accumulate(lo + tests.lengths[windows[mine]])
                    heads = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
                    ends = reach[np.append(heads[1:], len(lo)) - 1]
                    new = list(zip(lo[heads].tolist(), ends.tolist()))
                    spans[k] = [{"lo": a, "hi": b} for a, b in _merged([(s["lo"], s["hi"]) for s in spans[k]] + new)]
                    used = np.unique(windows[mine]).tolist()
                    ids = np.unique(np.concatenate([owned[first[w] : first[w + 1]] for w in used]))
                    names[k] = sorted({*names[k], *(tests.names[i] for i in ids.tolist())})
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1), pa.array(np.diff(begins) - 1, pa.int64()), pa.array(spans, _SPANS),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    names=["rest", "text", "n_words", "spans", "items"],
                )

    return each


def matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(doc_id, item, doc_word, item_word, length): the longest verbatim matches between documents
    and items, of a window or more; none can be extended to either side. Words count from 0.

    Rows of documents and of items that repeat match each on its own, equal rows of items once.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "doc_id long, item string, doc_word long, item_word long, length long"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("length", pa.int64())]
    )
    out = spark.createDataFrame([], kinds)
    for tests in _tests(items, item_col, item_text_col, window, tile_bytes):

        def each(batches: Iterator[pa.RecordBatch], shared=spark.sparkContext.broadcast(tests)) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in batches:
                for at, data, offsets in text_parts(batch.column(1)):
                    symbols, begins = _symbols(data, offsets, tests.vocabulary)
                    ids = batch.column(0).slice(at, len(begins) - 1)
                    for place, item, _, offset, length in longest(symbols, *occurrences(symbols, tests, window), tests):
                        text = np.searchsorted(begins, place, side="right") - 1
                        named = pa.array([tests.names[i] for i in item.tolist()], pa.string())
                        yield rows_of(schema, ids.take(pa.array(text)), named, place - begins[text], offset, length)

        out = out.union(slim.mapInArrow(each, kinds))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, **columns) -> DataFrame:
    """The rows of docs without a window of any item, all columns as they are."""
    return hits(docs, items, window, **columns).where(F.size("spans") == 0).select("row.*")


def digests(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row, as `hits` finds them."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return hits(slim, items, window, text_col="text", **columns).select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
