"""Operator 5: text quality from compression with dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.arrays import rows_of, text_bytes

#: Bounds of the sample the dictionaries and the calibration are fitted on: rows of each class, and
#: characters of each of them, in pieces. They bound what reaches the driver (32 million characters).
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 8_000
PIECES = 4
DICTIONARY_BYTES = 112 << 10
CHUNK_BYTES = 4 << 10
LEVEL = 3
#: Texts and chunks below this size say nothing by how far they shrink.
SHORT_BYTES = 200


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the calibration of their difference; a constant score without them."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    constant: float = 0.5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled_text(text: Column, key: Column, chars: int, pieces: int = PIECES) -> Column:
    """The whole text up to `chars` characters; of a longer one pieces from places all over it that
    a hash of the key picks, together about as long."""
    size = max(1, (chars - pieces + 1) // pieces)
    spare = F.greatest(F.length(text) - size, F.lit(0)) + 1
    places = [F.pmod(F.xxhash64(key, F.lit(k)), spare).cast("int") + 1 for k in range(pieces)]
    taken = F.concat_ws("\n", *[F.substring(text, p, F.lit(size)) for p in places])
    return F.when(F.length(text) <= chars, text).otherwise(taken)


def training_sample(
    docs: DataFrame, labels: DataFrame, docs_per_class: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS
) -> DataFrame:
    """(id, label, text): up to `docs_per_class` rows of each class outside the held-out part.

    Ids are picked first, by hash; only their texts are then fetched, and of an id that repeats the
    text that sorts first. Only labels 0 and 1 count.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")).distinct()
    mark = F.md5(F.concat(F.lit("quality:"), F.col("id").cast("string")))
    picked = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(mark, "id").limit(docs_per_class)
        picked = part if picked is None else picked.union(part)
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole.alias("text"))
    # At most 2 * docs_per_class ids, so their broadcast has a fixed bound; one row is left of each.
    found = texts.join(F.broadcast(picked), "id").select("id", "label", sampled_text(F.col("text"), F.col("id"), chars).alias("text"))
    return found.groupBy("id", "label").agg(F.min("text").alias("text"))


def _dictionary(samples: list[bytes]) -> bytes:
    pieces = [s[i : i + CHUNK_BYTES] for s in samples for i in range(0, len(s), CHUNK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: all of it is the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


class _Scorer:
    def __init__(self, model: CompressionModel) -> None:
        self.model = model
        self.sides = []
        if model.good or model.bad:
            for held in (model.good, model.bad):
                data = zstandard.ZstdCompressionDict(held)
                data.precompute_compress(level=LEVEL)
                self.sides.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, ...]:
        """1, the normalised difference of compressed sizes, that difference discounted for short
        texts, and how far the text shrinks on the good side: over all and in its most repetitive
        chunk.

        The text is compressed in chunks, each on its own, so that a long text is judged by the
        dictionaries. A chunk's frame costs are the same on both sides.
        """
        sizes = [0, 0]
        least = 0.0
        for at in range(0, len(text), CHUNK_BYTES):
            piece = text[at : at + CHUNK_BYTES]
            good, bad = (len(side.compress(piece)) for side in self.sides)
            sizes[0] += good
            sizes[1] += bad
            if len(piece) >= SHORT_BYTES:
                least = max(least, float(np.log(len(piece) / good)))
        if not sizes[0]:
            return (1.0,) + (0.0,) * 6
        apart = (sizes[1] - sizes[0]) / max(sizes)
        shrunk = float(np.log(len(text) / sizes[0])) if len(text) >= SHORT_BYTES else 0.0
        return 1.0, apart, apart * min(1.0, len(text) / (2 * SHORT_BYTES)), shrunk, shrunk**2, least, least**2

    def score(self, text: bytes) -> float:
        if not self.sides:
            return self.model.constant
        total = sum(w * x for w, x in zip(self.model.weights, self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def _calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, ...]:
    """Logistic regression by Newton's method, rows weighted to the classes' shares."""
    share = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - 0.01 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(sample: DataFrame, prior: float | None = None) -> CompressionModel:
    """Dictionaries and calibration from rows (id, label, text) of a bounded sample.

    Two thirds of the sample make the dictionaries, the rest calibrates, so that the calibration
    sees texts the dictionaries have not. prior: share of label 1 where it is known. With rows of
    one class or none, every text scores that class's smoothed share.
    """
    rows = sorted((r["id"], r["label"], r["text"]) for r in sample.collect())
    n = [sum(r[1] == k for r in rows) for k in (0, 1)]
    constant = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(n) < 3:
        return CompressionModel(b"", b"", (), constant)
    split: dict[tuple[int, bool], list[bytes]] = {}
    for k in (0, 1):
        for at, row in enumerate(r for r in rows if r[1] == k):
            split.setdefault((k, at % 3 == 2), []).append(row[2].encode())
    model = CompressionModel(_dictionary(split[1, False]), _dictionary(split[0, False]), ())
    scorer = _Scorer(model)
    found = [(scorer.features(t), k) for k in (0, 1) for t in split[k, True]]
    x, y = np.array([f for f, _ in found]), np.array([k for _, k in found])
    weights = _calibrate(x, y, constant if prior is None else prior)
    return CompressionModel(model.good, model.bad, weights, constant)


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every whole text, map-only.

    Null and empty texts score as a text without evidence. The model has a fixed size (two
    dictionaries) and travels with the task.
    """
    slim = docs.select(F.col(id_col), F.col(text_col))
    return scored_rows(slim, model, text_col).select(F.col("row").getField(id_col).cast("long").alias("id"), "score")


def scored_rows(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """(row, score): every row of docs as it is, as one struct, with the score of its text."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    text = F.col("row").getField(text_col).cast("string").alias("text")
    rows = packed.select(text, "row")
    kinds = T.StructType([T.StructField("score", T.DoubleType()), rows.schema["row"]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            found = pa.array([scorer.score(t) for t in text_bytes(batch.column(0))], pa.float64())
            yield pa.RecordBatch.from_arrays([found, batch.column(1)], names=["score", "row"])

    return rows.mapInArrow(each, kinds).select("row", "score")


#: Score from which a text counts as good.
GOOD = 0.7


def learn(docs: DataFrame, labels: DataFrame) -> CompressionModel:
    """A model fitted on the labels' bounded sample, calibrated to the share of label 1 among all
    labels outside the held-out part."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    prior = usable.agg(F.avg("quality")).first()[0]
    return fit(training_sample(docs, labels), prior)
