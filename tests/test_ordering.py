"""Random order, exact splits and unions, against plain Python."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickloom.operators import ordering
from tickloom.operators.ordering import (
    exact_split,
    split_counts,
    union_sets,
)
from tickloom.sinks import write


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def numbers(spark, n):
    return spark.range(n).withColumn("name", F.concat(F.lit("n"), "id"))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 99, 1000])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.8, 1.0])
def test_split_is_exact_and_follows_the_hash(spark, n, fraction):
    got = {r["id"]: r["split"] for r in exact_split(numbers(spark, n), ["id"], fraction, 42).collect()}
    order = sorted(range(n), key=lambda i: md5(f"42:{i}"))
    cut = round(n * fraction)
    assert got == {k: ("train" if p < cut else "validation") for p, k in enumerate(order)}


def test_split_does_not_depend_on_partitions(spark):
    df = numbers(spark, 500)
    a = exact_split(df, ["id"], 0.8, 1).collect()
    b = exact_split(df.repartition(3, "name"), ["id"], 0.8, 1).collect()
    assert sorted(a) == sorted(b)


def test_split_by_another_seed_differs(spark):
    df = numbers(spark, 100)
    assert sorted(exact_split(df, ["id"], 0.5, 1).collect()) != sorted(
        exact_split(df, ["id"], 0.5, 2).collect()
    )


@pytest.mark.parametrize("fraction", [0.1, 0.3, 0.5, 0.8, 0.99])
def test_copies_of_one_key_are_shared_exactly(spark, fraction):
    """Two thirds of the rows share a key; half of those are equal in everything."""
    df = spark.range(900).select(
        F.when(F.col("id") < 600, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id")).alias("content"),
    )
    split = exact_split(df, ["key"], fraction, 3)
    rows = split.collect()
    assert Counter((r["key"], r["content"]) for r in rows) == Counter(
        (r["key"], r["content"]) for r in df.collect()
    )
    counts = {r["split"]: r["n"] for r in split_counts(split).collect()}
    assert counts["train"] == round(900 * fraction) and sum(counts.values()) == 900


def test_equal_rows_are_written_out_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_COPIES_PER_TASK", 7)
    df = spark.range(100).select(F.lit("x").alias("k"), F.lit(None).cast("string").alias("empty"))
    rows = exact_split(df, ["k"], 0.8, 1).collect()
    assert Counter(r["split"] for r in rows) == {"train": 80, "validation": 20}
    assert {(r["k"], r["empty"]) for r in rows} == {("x", None)}


def test_rows_with_nested_columns_can_be_split(spark):
    df = spark.range(30).select(
        F.lit(1).alias("k"), F.struct(F.array("id").alias("a b")).alias("s.t"), F.lit(2).alias("x-y")
    )
    split = exact_split(df, ["k"], 0.8, 1)
    assert split.columns == ["k", "s.t", "x-y", "split"]
    assert Counter(r["split"] for r in split.collect()) == {"train": 24, "validation": 6}


def test_plan_of_a_split_moves_no_rows(spark):
    df = exact_split(numbers(spark, 1000), ["id"], 0.8, 42)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_union_matches_names_and_skips_missing_sets(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 4 AS y, 3 AS x")
    assert [tuple(r) for r in union_sets(None, a, None, b, a).collect()] == [(1, 2), (3, 4), (1, 2)]
    with pytest.raises(ValueError):
        union_sets(None)


@pytest.mark.parametrize("parts", [1, 7])
def test_files_in_name_order_are_one_permutation(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(write, "_COPIES", 40)
    rows = [(i, f"v{i}", None) for i in range(400)] + [(7, "same", 1.5)] * 300 + [(8, "a", None), (8, "b", None)]
    df = spark.createDataFrame(rows, "id int, v string, x double")
    orders = []
    for n in (5, 2):  # however the rows lie, the files are the same
        out = tmp_path / str(n)
        write.write_shuffled(df.repartition(n), str(out), 3, parts, ["id"])
        names = sorted(f for f in os.listdir(out) if f.startswith("part-"))
        assert len(names) == parts
        orders.append([tuple(r.values()) for name in names for r in pq.read_table(out / name).to_pylist()])
    assert orders[0] == orders[1] and Counter(orders[0]) == Counter(rows) and orders[0] != rows
    # Copies of one row are all over the table.
    copies = [k for k, r in enumerate(orders[0]) if r[1] == "same"]
    assert min(copies) < 40 and max(copies) > len(rows) - 40
    write.write_shuffled(df.limit(0), str(tmp_path / "none"), 3, parts)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "none")).count() == 0
