"""Joining documents on winnowed anchors: what repeats in one piece, and what is left to look at."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.anchors import content_hashes, runs
from tickloom.llm.arrays import rows_of, text_parts
from tickloom.session import new_folder

#: symbols of consecutive texts and their offsets, from bytes and offsets
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Winnow:
    """Windows of `window` symbols, put under the least hash of their grams of `gram` symbols."""

    window: int
    gram: int
    symbols: Symbols


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so they are made once and survive lost executors."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, id, tk, text): id and tk name a row; rows that share them are equal in id and text.

    A null id is replaced by a hash of the text, so that rows without one are told apart.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.xxhash64(text)).alias("id"), F.hash(text).alias("tk"), text.alias("text")
    )


def occurrences(rows: DataFrame, how: Winnow) -> DataFrame:
    """(id, tk, start, n, anchor, seg, several): the runs of windows of every text; seg is a hash of all the
    symbols of a run's windows. Equal windows are under equal anchors in whatever text."""
    schema = pa.schema(
        [("id", pa.int64()), ("tk", pa.int32()), ("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("seg", pa.int64()), ("several", pa.bool_())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for row, data, offsets in text_parts(batch.column(2)):
                symbols, ends = how.symbols(data, offsets)
                first, number, anchor, several = runs(symbols, ends, how.window, how.gram)
                seg = content_hashes(symbols, first, number, how.window)
                at = np.searchsorted(ends, first, side="right") - 1
                yield rows_of(
                    schema, ids[row + at], tks[row + at], first - ends[at], number, anchor.view(np.int64), seg.view(np.int64), several
                )

    kinds = "id long, tk int, start int, n int, anchor long, seg long, several boolean"
    return rows.select("id", "tk", "text").mapInArrow(each, kinds)


def candidates(found: DataFrame) -> DataFrame:
    """Runs that may have a repeated window: their anchor is found in several runs or several times
    in one; with `whole`: the runs of the anchor are several and all equal, so all their windows
    repeat. Anchors are counted by an aggregate that combines before its shuffle."""
    anchors = found.groupBy("anchor").agg(
        F.count("*").alias("runs"), F.min("seg").alias("low"), F.max("seg").alias("high"), F.max("several").alias("self")
    )
    whole = (F.col("low") == F.col("high")) & (F.col("runs") > 1)
    anchors = anchors.where("runs > 1 OR self").select("anchor", whole.alias("whole"))
    return found.drop("several").join(anchors, "anchor")


def distinct_runs(cands: DataFrame) -> DataFrame:
    """(anchor, seg, n, copies, id, tk, start): one of the equal runs of every anchor with several
    different ones."""
    one = F.min(F.struct("id", "tk", "start", "n")).alias("one")
    reps = cands.where("NOT whole").groupBy("anchor", "seg").agg(F.count("*").alias("copies"), one)
    return reps.select("anchor", "seg", "copies", "one.id", "one.tk", "one.start", "one.n")


def with_texts(reps: DataFrame, rows: DataFrame) -> DataFrame:
    """(text, runs) of the texts that hold one of the given runs; runs in order."""
    wanted = reps.groupBy("id", "tk").agg(F.sort_array(F.collect_list(F.struct("start", "n", "anchor", "seg"))).alias("runs"))
    # Rows equal in id and text are one text here.
    texts = rows.select("id", "tk", "text").join(wanted, ["id", "tk"])
    return texts.select("text", "runs")


def repeated_ranges(cands: DataFrame, reps: DataFrame, marks: DataFrame) -> DataFrame:
    """(id, tk, ranges): first and last + 1 of consecutive windows that repeat, for every text with any.

    marks: (anchor, seg, lo, hi), windows of a run, counted in the run, found to repeat.
    """
    pair = F.struct(F.col("lo"), F.col("hi"))
    by_run = marks.groupBy("anchor", "seg").agg(_joined(F.sort_array(F.collect_set(pair))).alias("parts"))
    copied = reps.where("copies > 1").select("anchor", "seg", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).alias("parts"))
    single = by_run.join(reps.where("copies = 1").select("anchor", "seg"), ["anchor", "seg"]).select("anchor", "seg", "parts")
    parts = copied.union(single)
    some = cands.where("NOT whole").join(parts, ["anchor", "seg"]).select("id", "tk", "start", F.explode("parts").alias("p"))
    some = some.select("id", "tk", (F.col("start") + F.col("p.lo")).alias("lo"), (F.col("start") + F.col("p.hi")).alias("hi"))
    all_ = cands.where("whole").select("id", "tk", F.col("start").alias("lo"), (F.col("start") + F.col("n")).alias("hi"))
    return all_.union(some).groupBy("id", "tk").agg(F.sort_array(F.collect_set(pair)).alias("ranges"))


def _joined(pairs: Column) -> Column:
    """Sorted ranges with those that touch put together."""
    last = lambda done: F.get(done, F.size(done) - 1)

    def add(done: Column, x: Column) -> Column:
        longer = F.struct(last(done)["lo"].alias("lo"), F.greatest(last(done)["hi"], x["hi"]).alias("hi"))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when(F.coalesce(last(done)["hi"] >= x["lo"], F.lit(False)), grown).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(pairs, F.array().cast("array<struct<lo: int, hi: int>>"), add)


def spans(ranges: list, window: int) -> list[tuple[int, int]]:
    """Maximal runs of symbols covered by windows that begin in the ranges (sorted pairs)."""
    out: list[list[int]] = []
    for lo, hi in ranges:
        end = hi - 1 + window
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [(a, b) for a, b in out]


def crowded(rows: DataFrame, key: list[str], hot: int) -> tuple[DataFrame, DataFrame]:
    """Rows of groups of up to `hot` rows, and rows of larger ones; rows alone in their group are in
    neither. Groups are counted by an aggregate, so no task holds one."""
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    sized = rows.join(sizes, key)
    return sized.where(F.col("_n") <= hot).drop("_n"), sized.where(F.col("_n") > hot).drop("_n")
