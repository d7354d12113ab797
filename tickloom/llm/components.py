"""Connected components of a graph held in DataFrames, by alternating star operations."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tickloom.llm.arrays import contract_batches, rows_of
from tickloom.session import shared_dir

#: Links of which one task keeps no more than tie the same nodes together.
TASK_LINKS = 500_000


def cut(df: DataFrame) -> DataFrame:
    """The rows, with their lineage ended in the shared folder, so lost executors lose nothing."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of one block as one link from each node to the smallest node it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b). Large star: each node ties its larger neighbours to the smallest of all its
    neighbours and itself. Small star: each node ties itself and its smaller neighbours to the
    smallest of those."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("m"))
    tied = both.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def _fewer(links: DataFrame, most: int) -> DataFrame:
    """Links (a > b) that tie the same nodes together: of about every `most` of them, in one task, those
    from each node to the smallest it reaches, again while that leaves less than half of the links."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def pairs():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)

        for a, b in contract_batches(pairs(), contract, most):
            yield rows_of(schema, a, b)

    before = links.count()
    while True:
        tasks = max(1, ceil(before / most))
        links = cut(links.coalesce(tasks).mapInArrow(each, links.schema))
        left = links.count()
        if tasks == 1 or 2 * left >= before:
            return links
        before = left


def components(links: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root): every node of a link with the smallest node it can reach.

    Links are rows of two comparable values; order, repeats, loops and nulls do not matter. Where the
    values are whole numbers, tasks of about `task_links` links first leave out those they do not need,
    so that the rounds follow the nodes of a group and not how often it was found. Each half of a
    round writes its links to the shared folder. A few times the logarithm of the longest chain is
    enough rounds, and all steps are joins and aggregates that combine before the shuffle, so
    no more of the graph is held in one task than that, and nothing in the driver.
    """
    x, y = F.col(a), F.col(b)
    links = cut(
        links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    )
    if isinstance(links.schema["a"].dataType, IntegralType):
        links = _fewer(links, task_links)

    def summary() -> tuple:
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last = summary()
    while True:
        # The small stars read the large ones twice, so those are written first.
        links = cut(_stars(cut(_stars(links, True)), False))
        now = summary()
        if now == last:
            break
        last = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
