"""Operator 11: ranked lexical search by presence masks.

For every item the documents of a block are grouped by the set of the item's terms they hold, a bit
field. A mask's greatest possible score is the sum of its terms' greatest contributions in the
block, so masks are looked at from the greatest down, and the search of a block ends when its k-th
score is above all that is left.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import rows_of, text_bytes
from tickloom.llm.terms import TILE_BYTES, split_words, tiles

TOP = 10
#: Documents and occurrences of item terms up to which documents are looked at together.
BLOCK_DOCS = 16_384
BLOCK_WORDS = 4_000_000
_MASK_BITS = 63
_DOCS, _WORDS = -1, -2


@dataclass
class Block:
    """Documents with the terms they hold: postings (doc, tf) lie by term, documents ascending."""

    ids: np.ndarray
    known: np.ndarray  # whether the document has an id
    lengths: np.ndarray
    first: np.ndarray  # of each term's postings; one more at the end
    docs: np.ndarray
    tfs: np.ndarray


def blocks(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int], most_docs: int, most_words: int) -> Iterator[Block]:
    """Documents with at least one word, packed into blocks."""
    ids: list = []
    lengths: list[int] = []
    found: list[np.ndarray] = []
    held = 0

    def block() -> Block:
        n_terms = len(vocabulary)
        docs = np.repeat(np.arange(len(found)), [len(x) for x in found])
        pairs = np.concatenate(found).astype(np.int64) * len(found) + docs
        pairs, tfs = np.unique(pairs, return_counts=True)
        terms, docs = np.divmod(pairs, len(found))
        first = np.searchsorted(terms, np.arange(n_terms + 1))
        known = np.array([i is not None for i in ids])
        numbers = np.array([0 if i is None else i for i in ids], np.int64)
        return Block(numbers, known, np.array(lengths, np.int64), first, docs, tfs.astype(np.int64))

    get = vocabulary.get
    for batch in batches:
        for doc_id, text in zip(batch.column(0), text_bytes(batch.column(1))):
            words = split_words(text)
            if not words:
                continue
            ids.append(doc_id.as_py())
            lengths.append(len(words))
            hits = [k for k in map(get, words) if k is not None]
            found.append(np.array(hits, np.int32))
            held += len(hits)
            if len(ids) >= most_docs or held >= most_words:
                yield block()
                ids, lengths, found, held = [], [], [], 0
    if ids:
        yield block()


def _statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> dict[int, int]:
    """Documents that hold each term, documents with a word (-1) and words of all documents (-2)."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held = np.zeros(len(known), np.int64)
        n_docs = n_words = 0
        for batch in batches:
            for text in text_bytes(batch.column(1)):
                words = split_words(text)
                if words:
                    n_docs += 1
                    n_words += len(words)
                    present = known.keys() & words
                    held[[known[w] for w in present]] += 1
        at = np.flatnonzero(held)
        yield rows_of(schema, np.append(at, [_DOCS, _WORDS]), np.append(held[at], [n_docs, n_words]))

    # One row a term of the tile, whatever the number of documents.
    counted = docs.mapInArrow(each, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in counted.collect()}


def weight(n_docs: int, held: int) -> int:
    """Weight of a term that `held` of `n_docs` documents hold, in thousandths."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))


def contributions(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What a term of weight 1 adds to a document's score, in millionths; 64-bit integers."""
    m = 25 + (75 * lengths * n_docs) // n_words
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


def best_of_block(block: Block, worth: np.ndarray, terms: np.ndarray, factors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k best documents of a block for an item, ties by id, nulls last.

    terms: the item's different terms; factors: weight of each, times its repeats in the item.
    """
    width = -(-len(terms) // _MASK_BITS) or 1
    masks = np.zeros((width, len(block.ids)), np.int64)
    most = np.zeros(len(terms), np.int64)
    for j, t in enumerate(terms):
        a, b = block.first[t], block.first[t + 1]
        if a < b and factors[j]:
            masks[j // _MASK_BITS, block.docs[a:b]] |= np.int64(1) << np.int64(j % _MASK_BITS)
            most[j] = factors[j] * worth[a:b].max()
    touched = np.flatnonzero(masks.any(axis=0))
    if not len(touched):
        return touched, touched
    order = np.lexsort(masks[:, touched])
    touched = touched[order]
    sorted_masks = masks[:, touched]
    heads = np.flatnonzero(np.append(True, (sorted_masks[:, 1:] != sorted_masks[:, :-1]).any(axis=0)))
    bits = [(sorted_masks[j // _MASK_BITS, heads] >> np.int64(j % _MASK_BITS)) & 1 for j in range(len(terms))]
    reach = sum(m * b for m, b in zip(most, bits))
    ends = np.append(heads[1:], len(touched))
    ranked = np.argsort(-reach, kind="stable")
    best = scores = np.zeros(0, np.int64)
    at, step = 0, 64
    while at < len(ranked) and (len(best) < k or reach[ranked[at]] >= scores[k - 1]):
        now = ranked[at : at + step]
        docs = np.concatenate([touched[heads[g] : ends[g]] for g in now])
        gained = np.zeros(len(docs), np.int64)
        held = masks[:, docs]
        for j, t in enumerate(terms):
            on = np.flatnonzero((held[j // _MASK_BITS] >> np.int64(j % _MASK_BITS)) & 1)
            if len(on):
                a, b = block.first[t], block.first[t + 1]
                gained[on] += factors[j] * worth[a + np.searchsorted(block.docs[a:b], docs[on])]
        best, scores = np.concatenate([best, docs]), np.concatenate([scores, gained])
        first = np.lexsort((block.ids[best], ~block.known[best], -scores))[:k]
        best, scores = best[first], scores[first]
        at += step
        step *= 2
    above = scores > 0
    return best[above], scores[above]


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", tile_bytes: int = TILE_BYTES, block_docs: int = BLOCK_DOCS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of all for every item, scores above 0.

    Words are digits, ASCII letters (lower-cased) and everything beyond ASCII. Statistics are taken
    over all documents with a word; a null or empty text has none and is no document. Each item
    row is ranked on its own, also where rows repeat; an item without words has no rows. Rows that
    repeat a doc_id are documents each; equal scores come by ascending doc_id, null ids last. Two
    passes over the texts for each tile of items: one counts, one ranks blocks of documents, of
    which only the k best of an item go on.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "tile_item long, id long, score long"
    schema = pa.schema([("tile_item", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for rows in tiles(items, item_col, item_text_col, tile_bytes):
        counted = [Counter(split_words(row["text"].encode())) for row in rows]
        vocabulary = {w: n for n, w in enumerate(sorted({w for c in counted for w in c}))}
        if not vocabulary:
            continue
        stats = _statistics(slim, vocabulary)
        n_docs, n_words = stats[_DOCS] or 0, stats[_WORDS] or 0
        if not n_words:
            continue
        weights = np.array([weight(n_docs, stats.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        asked = []
        for c in counted:
            terms = np.array([vocabulary[w] for w in c], np.int64)
            asked.append((terms, weights[terms] * np.array(list(c.values()), np.int64)))
        shared = spark.sparkContext.broadcast((vocabulary, asked))

        def each(batches: Iterator[pa.RecordBatch], shared=shared, n_docs=n_docs, n_words=n_words) -> Iterator[pa.RecordBatch]:
            known, asked = shared.value
            for block in blocks(batches, known, block_docs, block_words):
                worth = contributions(block.tfs, block.lengths[block.docs], n_docs, n_words)
                for n, (terms, factors) in enumerate(asked):
                    best, scores = best_of_block(block, worth, terms, factors, k)
                    if len(best):
                        yield rows_of(schema, np.full(len(best), n), pa.array(block.ids[best], mask=~block.known[best]), scores)

        order = Window.partitionBy("tile_item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        lists = slim.mapInArrow(each, kinds).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame([(n, r["item"], r["copies"]) for n, r in enumerate(rows)], "tile_item long, item long, copies long")
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        found = lists.join(named, "tile_item").withColumn("copy", copies)
        out = out.unionByName(found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"))
    return out
