"""Operator 6: exact top-k search by tiled matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import rows_of
from tickloom.llm.components import cut

QUERY_TILE = 8192
SHARD = 8192
FAN_IN = 8
_TILE = "tile long, ids binary, rows binary, vectors binary, width int"


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component as long; repeated rows are rows each.

    Left out: null ids and vectors, vectors without components, or with a null or non-finite one.
    Values beyond a long are held at its ends.
    """
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    low, high = F.lit(-(2.0**63)), F.lit(2.0**63)
    usable = (
        F.col(id_col).isNotNull()
        & F.col(vec_col).isNotNull()
        & (F.size(vec_col) > 0)
        & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    )

    def whole(x: Column) -> Column:
        # try_cast and the two ends keep this independent of how the session treats overflow.
        value = F.lit(float(scale)) * x
        floor = F.floor(F.when((value > low) & (value < high), value).otherwise(F.lit(0.0))).cast("long")
        return F.when(value >= high, F.lit(2**63 - 1)).when(value <= low, F.lit(-(2**63))).otherwise(floor)

    return rows.where(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(vec, whole).alias("v"))


def _tiles(vectors: DataFrame, size: int) -> DataFrame:
    """Rows packed into tiles of up to `size` vectors of one width."""
    schema = pa.schema([("tile", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list, list]] = {}

        def tile(width: int) -> pa.RecordBatch:
            ids, rows, vecs = waiting.pop(width)
            return rows_of(
                schema, [0], [np.array(ids, np.int64).tobytes()], [np.array(rows, np.int64).tobytes()],
                [np.concatenate(vecs).astype(np.int64).tobytes()], [width],
            )

        for batch in batches:
            values = batch.column(1)
            for k, (i, row) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                vec = values[k].values.to_numpy(zero_copy_only=False)
                ids, rows, vecs = waiting.setdefault(len(vec), ([], [], []))
                ids.append(i)
                rows.append(row)
                vecs.append(vec)
                if len(ids) >= size:
                    yield tile(len(vec))
        for width in list(waiting):
            yield tile(width)

    packed = vectors.mapInArrow(pack, _TILE)
    return packed.withColumn("tile", F.monotonically_increasing_id())


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores of one query, ties to smaller ids."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)  # all ties at the edge stay until ids decide
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near].astype(object) if scores[near].min(initial=0) == -(2**63) else -scores[near]))][:k]


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every sum is below 2^53. Sums beyond a long are
    held at its ends, so none wraps around."""
    reach = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * q.shape[1]
    if reach < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if reach < 2.0**62:
        return q @ c.T
    # As Python integers, of any size.
    return np.clip(q.astype(object) @ c.T.astype(object), -(2**63), 2**63 - 1).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, query_tile: int = QUERY_TILE, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, id, score): the k best of all other rows for every query row.

    vectors: (id, v) from `integer_vectors`; is_query says which of them are queries. Tiles of
    queries meet shards of candidates in blocks by an equi-join of their numbers; each block is one
    matrix product and a partial selection. Lists are merged in a tree, FAN_IN shards at a step, so
    no task sees more than FAN_IN * k rows of a query at once. Vectors of other widths than the
    query's are no candidates. Fewer than k candidates give all of them. Rows that repeat an id are
    candidates and queries each, of one another too.
    """
    vectors = cut(vectors.select("id", "v", F.monotonically_increasing_id().alias("row")))
    spark = vectors.sparkSession
    rows = vectors.count()
    parts = max(1, -(-rows // shard))
    shards = cut(_tiles(vectors.repartition(parts, "row").select("id", "v", "row"), shard))
    asked = vectors.where(is_query)
    tiles = cut(_tiles(asked.repartition(max(1, -(-asked.count() // query_tile)), "row").select("id", "v", "row"), query_tile))
    shards, tiles = _numbered(shards), _numbered(tiles)
    n_shards, n_tiles = shards.count(), tiles.count()
    if not n_tiles or not n_shards:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    blocks_q = tiles.select(
        F.col("tile").alias("t"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("vectors").alias("q"), F.col("width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("s"),
    )
    blocks_c = shards.select(
        F.col("tile").alias("s"), F.col("ids").alias("c_ids"), F.col("rows").alias("c_rows"), F.col("vectors").alias("c"), F.col("width").alias("c_width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long"))).alias("t"),
    )
    blocks = blocks_q.join(blocks_c.hint("shuffle_hash"), ["t", "s"]).where("width = c_width")
    kinds = "query long, query_id long, part long, id long, score long"
    schema = pa.schema([(c.split()[0], pa.int64()) for c in kinds.split(", ")])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                s, *held, width = (batch.column(n)[row].as_py() for n in range(8))
                q_ids, q_rows, q, c_ids, c_rows, c = (np.frombuffer(x, np.int64) for x in held)
                c, q = c.reshape(-1, width), q.reshape(-1, width)
                for at in range(0, len(q), 128):
                    scores = _product(q[at : at + 128], c)
                    found = []
                    for n, one in enumerate(scores):
                        best = _best(one, c_ids, k + 1)
                        best = best[c_rows[best] != q_rows[at + n]][:k]
                        found.append((np.full(len(best), q_rows[at + n]), np.full(len(best), q_ids[at + n]), c_ids[best], one[best]))
                    rows, ids, cands, got = (np.concatenate(x) for x in zip(*found))
                    yield rows_of(schema, rows, ids, np.full(len(ids), s), cands, got)

    names = ("s", "q_ids", "q_rows", "q", "c_ids", "c_rows", "c", "width")
    lists = blocks.select(*names).mapInArrow(multiply, kinds)
    entry = F.struct(F.bitwise_not("score").alias("low"), F.col("id"), F.col("score"))
    lists = lists.groupBy("query", "query_id", "part").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))
    left = n_shards
    while True:
        lists = lists.groupBy("query", "query_id", (F.col("part") / FAN_IN).cast("long").alias("part")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        )
        left = -(-left // FAN_IN)
        if left <= 1:
            break
    out = lists.select("query_id", F.posexplode("best").alias("at", "e"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias("id"), F.col("e.score").alias("score"))


def _numbered(tiles: DataFrame) -> DataFrame:
    """Tiles numbered from 0: only their marks, one for thousands of vectors, are ordered."""
    from pyspark.sql import Window

    marks = tiles.select("tile", F.spark_partition_id().alias("p"))
    counts = marks.groupBy("p").agg(F.count("*").alias("n"))
    before = counts.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    placed = marks.withColumn("k", F.row_number().over(Window.partitionBy("p").orderBy("tile"))).join(before, "p")
    return tiles.join(placed.select("tile", (F.col("before") + F.col("k") - 1).alias("number")), "tile").select(
        F.col("number").alias("tile"), "ids", "rows", "vectors", "width"
    )
