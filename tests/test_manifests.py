"""Manifests: paths, unknown keys, boxes, files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions.paths import extension, file_name, image_tail
from tickloom.operators.manifests import (
    annotated,
    attach_files,
    attributes,
    explode_boxes,
    int_boxes,
    missing_files,
    relocate,
    rewrite_lines,
)
from tickloom.plans.manifest import manifest_counts, manifest_path, split_manifest
from tickloom.sinks.write import write_split
from tickloom.sources.files import (
    first_usable_file,
    list_files,
    pretty_json,
    preview,
    read_images,
    read_lines,
    read_manifest,
    register_view,
    small_enough,
    usable_files,
)

LABEL = "all-labels"


def box(*sizes):
    return dict(zip(("left", "top", "width", "height"), sizes))


@pytest.fixture
def manifest_dir(tmp_path):
    records = [
        {"source-ref": "s3://old/images/a.jpg", LABEL: {"annotations": [box(1.9, 2, 3, 4)]}, "n": 1},
        {"source-ref": "s3://old/images/b.jpg", LABEL: {"other": True}},
        {"source-ref": "s3://old/images/c.jpg", LABEL: {"annotations": []}},
        {"source-ref": "s3://old/images/d.jpg", LABEL: {"annotations": [box(5, 6, 7, 8), box(1, 1, 1, 1)]}},
    ]
    folder = tmp_path / "manifest"
    folder.mkdir()
    lines = [json.dumps(r) for r in records] + ["{ not json"]
    (folder / "output.manifest").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize(
    "path, tail, name",
    [
        ("s3://b/images/x/y.jpg", "x/y.jpg", "y.jpg"),
        ("a/images/b/images/c.png", "c.png", "c.png"),
        ("no/folder.jpg", "no/folder.jpg", "folder.jpg"),
        ("", "", ""),
    ],
)
def test_path_parts(spark, path, tail, name):
    df = spark.createDataFrame([(path,)], "p string")
    row = df.select(image_tail(F.col("p")), file_name(F.col("p")), relocate(F.col("p"), "root")).first()
    assert list(row) == [tail, name, f"root/images/{tail}"]


@pytest.mark.parametrize("name, ext", [("part-0.json", "json"), ("a.json.gz", "gz"), ("json", "json")])
def test_extension(spark, name, ext):
    assert spark.createDataFrame([(name,)], "n string").select(extension(F.col("n"))).first()[0] == ext


def test_unreadable_line_is_kept_as_text(spark, manifest_dir):
    rows = read_manifest(spark, manifest_dir, LABEL).collect()
    assert len(rows) == 5
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ["{ not json"]


def test_records_without_annotations_do_not_shift_others(spark, manifest_dir):
    manifest = read_manifest(spark, manifest_dir, LABEL).where("`source-ref` IS NOT NULL")
    kept = annotated(manifest, LABEL).select("source-ref").collect()
    assert [r[0][-5:] for r in kept] == ["a.jpg", "c.jpg", "d.jpg"]
    rows = explode_boxes(
        manifest.select(F.col("source-ref").alias("ref"), LABEL), F.col(f"`{LABEL}`.annotations"), "ref"
    ).collect()
    got = [(r["ref"][-5], r["box_index"], r["left"], r["height"]) for r in rows]
    assert got == [
        ("a", 0, 1, 4), ("b", None, None, None), ("c", None, None, None), ("d", 0, 5, 8), ("d", 1, 1, 1),
    ]
    lists = manifest.select(int_boxes(F.col(f"`{LABEL}`.annotations")).alias("b")).collect()
    assert [r["b"] and [tuple(x) for x in r["b"]] for r in lists][:2] == [[(1, 2, 3, 4)], None]


def test_named_attributes_only(spark, manifest_dir):
    assert attributes(read_manifest(spark, manifest_dir, LABEL), ["source-ref", LABEL]).columns == [
        "source-ref",
        LABEL,
    ]


def test_unknown_keys_pass_through(spark):
    record = {
        "source-ref": "x/images/é.jpg", "n": 1, "f": 2.5, "t": "a\"b", "z": None,
        "deep": {"list": [1, {"k": [True, None]}]}, LABEL: {"annotations": [box(1, 2, 3, 4)]},
    }
    df = spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "line string")
    row = rewrite_lines(df, "s3://new").first()
    assert row["source_ref"] == "s3://new/images/é.jpg"
    assert json.loads(row["line"]) == {**record, "source-ref": "s3://new/images/é.jpg"}


@pytest.mark.parametrize("line", ["{ not json", "[1]", '"text"', ""])
def test_lines_that_are_no_records_stay(spark, line):
    row = rewrite_lines(spark.createDataFrame([(line,)], "line string"), "r").first()
    assert row["line"] == line and row["source_ref"] is None


def test_split_manifest_end_to_end(spark, tmp_path):
    lines = spark.range(50).select(
        F.to_json(F.struct(F.concat(F.lit("q/images/"), "id").alias("source-ref"), "id")).alias("line")
    )
    split = split_manifest(lines, "root")
    counts = manifest_counts(split).first()
    assert tuple(counts) == (50, 40, 10)
    for _ in range(2):
        write_split(split, str(tmp_path))
    for side, n in (("train", 40), ("validation", 10)):
        stored = read_lines(spark, f"{tmp_path}/split={side}").collect()
        refs = {json.loads(r["line"])["source-ref"] for r in stored}
        assert len(stored) == len(refs) == n and all(r.startswith("root/images/") for r in refs)


def test_manifest_path():
    assert manifest_path("s3://b", "birds", "train") == (
        "s3://b/ground_truth_output/birds/manifests/output/train.manifest"
    )


def test_files_of_records(spark):
    records = spark.createDataFrame([("a",), ("b",), ("a",)], "path string")
    files = spark.createDataFrame([("a", 5), ("z", 6)], "path string, length long")
    got = sorted((r["path"], r["length"] or 0) for r in attach_files(records, files, "path").collect())
    assert got == [("a", 5), ("a", 5), ("b", 0)]
    assert [r["path"] for r in missing_files(records, files, "path").collect()] == ["b"]


def test_images_by_size(spark, tmp_path):
    for name, size in (("a.jpg", 10), ("b.jpg", 11), ("c.txt", 1)):
        (tmp_path / name).write_bytes(b"x" * size)
    images = read_images(spark, str(tmp_path), "*.jpg")
    kept = small_enough(images, 10).collect()
    assert [(r["path"][-5:], r["length"], bytes(r["content"])) for r in kept] == [("a.jpg", 10, b"x" * 10)]


def test_file_choice(spark, tmp_path):
    for name, size in (("a.json", 100), ("b.json", 101), ("c.json", 500), ("d.txt", 500)):
        (tmp_path / name).write_text("x" * size)
    files = list_files(spark, str(tmp_path))
    assert sorted(r["name"] for r in usable_files(files).collect()) == ["b.json", "c.json"]
    assert [r["name"] for r in first_usable_file(files).collect()] == ["b.json"]
    assert first_usable_file(files, 1000).count() == 0


def test_preview_view_and_pretty_text(spark):
    df = spark.range(10).select((F.lit(9) - F.col("id")).alias("v"))
    assert [r["v"] for r in preview(df, 3, "v").collect()] == [0, 1, 2]
    assert preview(df, 3).count() == 3
    register_view(df, "numbers")
    assert spark.sql("SELECT max(v) FROM numbers").first()[0] == 9
    text = pretty_json(preview(df, 1, "v")).first()["json"]
    assert json.loads(text) == {"v": 0} and "\n" in text
