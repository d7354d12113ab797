"""Operator 7: language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.arrays import gram_hashes, rows_of, text_parts
from tickloom.llm.components import cut
from tickloom.llm.compression import held_out, sampled_text

#: Bounds of the sample the model is fitted on: rows in all, rows of each language, characters of each
#: row, in pieces. Where there are many languages each gets fewer rows.
SAMPLE_ROWS = 200_000
DOCS_PER_LANGUAGE = 800
SAMPLE_CHARS = 1_500

BUCKETS = 1 << 15
WIDTH = 16
SIZES = (1, 2, 3, 4)
UNDECIDED = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    """Per bucket one value for each language: embedding times output layer, put together."""

    languages: tuple[str, ...]
    table: np.ndarray  # (buckets, languages)
    bias: np.ndarray
    heat: float = 1.0
    reject_below: float = 0.0


def _lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII letters; all runs of other ASCII characters count as one space each."""
    out = data.copy()
    upper = (data >= 65) & (data <= 90)
    out[upper] += 32
    other = (out < 97) | ((out > 122) & (out < 128))
    out[other] = 32
    return out


def buckets_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword size (bucket of every byte n-gram, number of n-grams of each text), n-grams
    that cross texts left out."""
    symbols = _lower(data).astype(np.uint64) + np.uint64(1)
    lengths = np.diff(offsets)
    for size in SIZES:
        hashes = gram_hashes(symbols, size)
        found = (hashes >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
        counts = np.maximum(lengths - size + 1, 0)
        if len(lengths) > 1 and len(found):
            keep = np.ones(len(found), bool)
            for back in range(1, size):
                ends = offsets[1:-1] - back
                ends = ends[(ends >= 0) & (ends < len(found))]
                keep[ends] = False
            short = np.flatnonzero((lengths > 0) & (lengths < size))
            for k in short:
                keep[offsets[k] : offsets[k + 1]] = False
            found = found[keep]
        yield found[: counts.sum()], counts


def _sums(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the table's rows over all subwords of each text, and their number."""
    total = np.zeros((len(offsets) - 1, table.shape[1]))
    number = np.zeros(len(offsets) - 1)
    for found, counts in buckets_of(data, offsets):
        full = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts)])[full]
        for k in range(table.shape[1]):
            if len(full):
                total[full, k] += np.add.reduceat(table[:, k][found], starts)
        number += counts
    return total, number


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def training_sample(
    docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, chars: int = SAMPLE_CHARS, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(id, lang, text) of a bounded sample outside the held-out part: up to `per_language` documents
    of every language, those whose hashed id is smallest, and `rows` in all.

    Every language is learned; with many of them each gets its share of `rows`. More languages than
    `rows` are refused. Of an id that repeats in a language the text that sorts first is taken.
    """
    open_ = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sizes = cut(open_.groupBy("lang").agg(F.approx_count_distinct("id").alias("n")))
    languages = sizes.count()
    if languages > rows:
        raise ValueError(f"{languages} languages, more than the {rows} rows of the sample")
    most = min(per_language, rows // max(1, languages))
    # Hashes are uniform: the smallest lie below a bound that a language's size gives, with room for
    # the estimate's error, so few rows are ranked however large the language is.
    mark = F.xxhash64(F.lit("lang:"), F.col("id"))
    share = (F.lit(2.0 * most + 100) / F.col("n")) * 2.0**64 - 2.0**63
    near = open_.select("id", "lang").join(F.broadcast(sizes), "lang").where(mark.cast("double") <= share)
    order = Window.partitionBy("lang").orderBy(mark, "id")
    picked = near.select("id", "lang").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
    # Both broadcasts are bounded by `rows`.
    found = open_.join(F.broadcast(picked.select("id", "lang")), ["id", "lang"])
    texts = found.select("id", "lang", sampled_text(F.col("text"), F.col("id"), chars).alias("text"))
    return texts.groupBy("id", "lang").agg(F.min("text").alias("text"))


def fit(sample: DataFrame, rounds: int = 4, rate: float = 0.5, seed: int = 7) -> LanguageModel | None:
    """Stochastic gradient descent over the sample's rows, one document at a time.

    A fifth of the sample is kept back to calibrate: the temperature that fits its outcomes best,
    and the score below which one in a hundred of its right answers lies. None without any row.
    """
    rows = sorted((r["id"], r["lang"], r["text"]) for r in sample.collect())
    rows = [r for r in rows if _LETTER.search(r[2])]
    languages = tuple(sorted({r[1] for r in rows}))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    place = {name: k for k, name in enumerate(languages)}
    data = []
    for _, lang, text in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        found = np.concatenate([f for f, _ in buckets_of(raw, np.array([0, len(raw)]))])
        at, times = np.unique(found, return_counts=True)
        data.append((at, times / len(found), place[lang]))
    kept = [k for k in range(len(data)) if k % 5 == 4]
    used = [k for k in range(len(data)) if k % 5 != 4]
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    out = np.zeros((WIDTH, len(languages)))
    bias = np.zeros(len(languages))
    steps, done = rounds * len(used), 0
    for _ in range(rounds):
        for k in rng.permutation(used):
            at, share, target = data[k]
            pace = rate * (1 - done / steps)
            done += 1
            mean = share @ embed[at]
            wrong = _softmax(mean @ out + bias)
            wrong[target] -= 1
            back = out @ wrong
            out -= pace * np.outer(mean, wrong)
            bias -= 0.1 * pace * wrong
            # The mean spreads a step over all subwords; the scale gives each a step of its own.
            embed[at] -= (pace * 50) * share[:, None] * back
    table = embed @ out
    scores = np.array([data[k][1] @ table[data[k][0]] + bias for k in kept]).reshape(len(kept), len(languages))
    target = np.array([data[k][2] for k in kept], int)
    heat, reject = 1.0, 0.0
    if len(kept):
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(_softmax(scores * h)[np.arange(len(kept)), target] + 1e-12).mean() for h in grid]
        heat = float(grid[int(np.argmin(loss))])
        sure = _softmax(scores * heat).max(axis=1)
        right = (scores.argmax(axis=1) == target)
        if right.any():
            reject = float(np.quantile(sure[right], 0.01))
    return LanguageModel(languages, table.astype(np.float64), bias, heat, reject)


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every whole text, map-only.

    lang_pred is the likeliest learned language and score its calibrated probability. `und` with
    score 0 where the text is null or has no letter, or nothing was learned. rejected marks scores
    below the calibrated level; it takes no prediction back. The model is a table of fixed width
    that travels with the task.
    """
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            ids = batch.column(0)
            for first, data, offsets in text_parts(texts):
                rows = len(offsets) - 1
                names: list[str] = [UNDECIDED] * rows
                sure = np.zeros(rows)
                if model is not None:
                    total, number = _sums(model.table, data, offsets)
                    p = _softmax((total / np.maximum(number, 1)[:, None] + model.bias) * model.heat)
                    for k in range(rows):
                        if _LETTER.search(texts[first + k].as_py() or ""):
                            best = int(p[k].argmax())
                            names[k], sure[k] = model.languages[best], p[k, best]
                low = sure < model.reject_below if model is not None else np.ones(rows, bool)
                yield rows_of(schema, ids[first : first + rows], names, sure, low)

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(each, "id long, lang_pred string, score double, rejected boolean")
