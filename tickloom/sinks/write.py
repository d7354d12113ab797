"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.hashing import row_hash
from tickloom.sources.lines import FILE, PLACE


#: Copies of one row that a task writes out.
_COPIES = 100_000


def write_features(
    features: DataFrame,
    path: str,
    keys: Sequence[str],
    seed: int,
    columns: Sequence[str] = ("cat", "start", "target"),
    fmt: str = "json",
    mode: str = "overwrite",
    all_splits: bool = False,
) -> None:
    """SNK1, SNK2, SRT3: rows in random order, one folder per split.

    Rows are dealt to tasks by a seeded hash and sorted by it inside each task, after the split.
    That is a full random mix with one shuffle, and no sampling pass over the plan before it as a
    global sort needs. Overwriting replaces only the splits that are written, so a second run does
    not double rows; with `all_splits` it replaces the whole folder, so an earlier split that now
    has no rows goes too.
    """
    hashed = features.select(
        "split", row_hash(seed, *[F.col(k) for k in keys]).alias("_h"), *columns
    )
    mixed = deal_out(hashed, "_h").sortWithinPartitions("split", "_h").drop("_h")
    _write_by(mixed, "split", path, fmt, mode, all_splits)


def deal_out(df: DataFrame, key: str) -> DataFrame:
    """Rows to tasks by key; where Spark adapts plans it joins small pieces and cuts big ones."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", key)
    return df.repartition(key)


def write_split(
    lines: DataFrame,
    path: str,
    column: str = "split",
    text: str = "line",
    mode: str = "overwrite",
    seed: int = 42,
    all_splits: bool = False,
) -> None:
    """SNK3: manifest lines in random order, one folder per side of the split.

    The order is that of a seeded hash of the line, so one annotator's records do not stay together.
    """
    hashed = lines.select(column, text, row_hash(seed, F.col(text)).alias("_h"))
    mixed = deal_out(hashed, "_h").sortWithinPartitions(column, "_h").drop("_h")
    _write_by(mixed, column, path, "text", mode, all_splits)


def write_shuffled(
    df: DataFrame, path: str, seed: int, parts: int, keys: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """SRT3: whole rows as `parts` files that are, in the order of their names, one random permutation.

    Each file holds one range of a seeded hash of the keys and the whole row, sorted by it. The hash
    is uniform, so the ranges are fixed beforehand and no pass samples the rows. A row that occurs
    more than once is numbered, and its copies go to places of their own.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    named = df.select(F.struct(*columns).alias("_row"), row_hash(seed, *[F.col(k) for k in keys], content).alias("_c"))
    # Copies are folded into one row with their number before anything is dealt out.
    folded = named.groupBy("_c").agg(F.first("_row").alias("_row"), F.count(F.lit(1)).alias("_n"))
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _COPIES)))
    several = folded.where("_n > 1").select("_c", "_row", "_n", pieces.alias("_p")).repartition("_c", "_p")
    low = F.col("_p") * _COPIES
    copies = F.explode(F.sequence(low, F.least(low + _COPIES, F.col("_n")) - 1))
    again = several.select("_row", "_c", copies.alias("_i")).select("_row", row_hash(seed, F.col("_c"), F.col("_i")).alias("_h"))
    dealt = folded.where("_n = 1").select("_row", F.col("_c").alias("_h")).unionByName(again)
    place = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * parts / 2**32).cast("int")
    ordered = dealt.repartitionById(parts, place).sortWithinPartitions("_h")
    ordered.select("_row.*").write.mode(mode).format(fmt).save(path)


def write_predictions(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK4: predictions as JSON lines.

    Scoring does not move rows, and neither does this: each part file holds, line by line, the
    answers to one piece of the input. Rows carry their request id for whoever joins them later.
    """
    scored.write.mode(mode).json(path)


def write_aligned(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK4: answers as JSON lines, in the order of the lines they answer.

    `scored` has the place of its input line (`sources.lines.PLACE`) beside the answer. For every
    input file there is a folder with a file for each piece it was read in, pieces by name in the
    order of the input, so line k of them together answers line k of the input; `aligned_lines`
    reads them so. A row without an answer is an empty object. Rows do not move: those of a piece
    have to be in one task, as the scan puts them.
    """
    answers = [F.col(c) for c in scored.columns if c not in PLACE]
    lines = scored.select(*PLACE, F.to_json(F.struct(*answers)).alias("value"))
    ordered = lines.sortWithinPartitions(*PLACE).drop("turn")
    ordered.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*FILE, "piece").text(path)


def _write_by(df: DataFrame, column: str, path: str, fmt: str, mode: str, all_splits: bool) -> None:
    writer = df.write.mode(mode).partitionBy(column).format(fmt)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static" if all_splits else "dynamic")
    if fmt == "json":
        writer = writer.option("timestampFormat", fixed.START_PATTERN)
    writer.save(path)
