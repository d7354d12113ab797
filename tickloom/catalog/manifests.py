"""Label manifests, over documents, labels, pages and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.standins import table, tidy
from tickloom.functions import fixed
from tickloom.operators.manifests import (
    annotated,
    attach_files,
    attributes,
    explode_boxes,
    missing_files,
    relocate,
    rewrite_lines,
)
from tickloom.operators.ordering import exact_split, split_counts
from tickloom.plans.manifest import manifest_counts, split_manifest
from tickloom.session import new_folder
from tickloom.sinks.write import write_split
from tickloom.sources.files import read_lines, read_manifest

ROOT = "store/lab"
LABEL = "all-labels"
SEED = 42
# Boxes and detections of the given vectors are of so many classes.
CLASS_COUNT = 3


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as manifest records; those with a label carry one box made from it."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    box = F.struct(
        F.col("quality").cast("double").alias("left"),
        F.col("toxic").cast("double").alias("top"),
        (F.col("quality") + 1.5).alias("width"),
        (F.col("toxic") + 2.5).alias("height"),
    )
    annotations = F.when(F.col("quality").isNotNull(), F.array(box))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.concat(F.lit("raw/images/"), "source", F.lit("/images/"), "doc_id").alias("source-ref"),
        F.struct(annotations.alias("annotations")).alias(LABEL),
        "lang",
        "n_chars",
        "text",
    )


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(spark, sf_dir).select(F.to_json(F.struct("*")).alias("line"))


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page lines moved to a new root, their other keys read back from the new lines."""
    pages = table(spark, sf_dir, "pages")
    lines = pages.select(
        F.to_json(F.struct(F.col("url").alias("source-ref"), "page_id", "html")).alias("line")
    )
    moved = F.from_json("line", "`source-ref` string, page_id long, html string")
    return (
        rewrite_lines(lines, ROOT)
        .select("source_ref", moved.alias("m"))
        .select(
            "source_ref",
            F.col("m.source-ref").alias("line_ref"),
            F.col("m.page_id").alias("page_id"),
            F.md5("m.html").alias("html_md5"),
        )
    )


def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest lines written, read back, moved, with all other keys intact."""
    folder = new_folder(spark, "manifest")
    manifest_lines(spark, sf_dir).write.text(folder)
    kept = "doc_id long, lang string, n_chars long, text string"
    boxes = f"`{LABEL}` struct<annotations:array<struct<width:double>>>"
    return (
        rewrite_lines(read_lines(spark, folder), ROOT)
        .select("source_ref", F.from_json("line", f"{kept}, {boxes}").alias("m"))
        .select(
            "source_ref",
            "m.doc_id",
            "m.lang",
            "m.n_chars",
            F.md5("m.text").alias("text_md5"),
            F.get(F.col(f"m.{LABEL}.annotations"), F.lit(0))["width"].alias("width"),
        )
    )


def written_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with numbers and spaces that a JSON reader would write otherwise: all but the path stays."""
    docs = table(spark, sf_dir, "documents")
    digits = F.concat(F.lit("1" * 48), F.col("doc_id").cast("string"))
    text = F.substr(F.to_json(F.array("text")), F.lit(2))
    line = F.concat(
        F.lit('{"weight" : 1.0, "id":'), digits, F.lit(', "source-ref"\t: "raw\\/images/'), F.col("doc_id").cast("string"),
        F.lit('", "id": 1e400, "inner":{"source-ref":"raw/images/0"}, "text":['), text, F.lit("}"),
    )
    moved = rewrite_lines(docs.select("doc_id", line.alias("line")), ROOT)
    return moved.select("doc_id", "source_ref", F.expr("substr(line, 1, 230)").alias("head"), F.md5("line").alias("line_md5"))


def manifest_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "manifest")
    manifest_lines(spark, sf_dir).write.text(folder)
    picked = attributes(read_manifest(spark, folder, LABEL), ["source-ref", LABEL])
    return tidy(
        picked.select(
            F.col("source-ref").alias("source_ref"),
            F.size(F.col(f"`{LABEL}`.annotations")).alias("n_boxes"),
            F.get(F.col(f"`{LABEL}`.annotations"), F.lit(0))["height"].alias("height"),
        ).withColumn("n_boxes", F.greatest("n_boxes", F.lit(0)))
    )


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return exact_split(docs, ["doc_id"], fixed.TRAIN_FRACTION, SEED)


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both manifests written and read back."""
    folder = new_folder(spark, "split")
    write_split(split_manifest(manifest_lines(spark, sf_dir), ROOT, seed=SEED), folder)
    stored = spark.read.schema("value string, split string").text(folder)
    return stored.select(
        "split",
        F.get_json_object("value", "$.source-ref").alias("source_ref"),
        F.md5(F.get_json_object("value", "$.text")).alias("text_md5"),
    )


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_counts(split_documents(spark, sf_dir))


def side_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(split_documents(spark, sf_dir))


def annotated_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = annotated(document_manifest(spark, sf_dir), LABEL)
    return kept.select("doc_id", F.col("source-ref").alias("source_ref"))


def box_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as records with boxes: four numbers in a row make a box."""
    vectors = table(spark, sf_dir, "embeddings")
    starts = F.sequence(F.lit(0), F.floor(F.size("embedding") / 4) - 1)

    def number(g, k):
        return F.get("embedding", (g * 4 + k).cast("int")).cast("double") * 300

    boxes = F.transform(
        starts,
        lambda g: F.struct(
            F.abs(number(g, 0)).alias("left"),
            F.abs(number(g, 1)).alias("top"),
            F.abs(number(g, 2)).alias("width"),
            F.abs(number(g, 3)).alias("height"),
            (F.floor(F.abs(number(g, 0)) / 10) % CLASS_COUNT).alias("class_id"),
        ),
    )
    return vectors.select(F.col("vec_id").alias("image_id"), boxes.alias("annotations"))


def bbox_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(explode_boxes(box_manifest(spark, sf_dir), F.col("annotations"), "image_id"))


def label_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of records that may have none: those keep one empty row."""
    return tidy(
        explode_boxes(
            document_manifest(spark, sf_dir), F.col(f"`{LABEL}`.annotations"), "doc_id"
        )
    )


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, pages as their files: found ones with length, and missing ones."""
    records = document_manifest(spark, sf_dir).select(
        "doc_id", F.concat(F.lit(f"{ROOT}/images/"), "doc_id").alias("path")
    )
    files = table(spark, sf_dir, "pages").select(
        relocate(F.concat(F.lit("raw/images/"), "page_id"), ROOT).alias("path"),
        F.octet_length("html").cast("long").alias("length"),
    )
    found = attach_files(records, files, "path").where(F.col("length").isNotNull())
    lost = missing_files(records, files, "path").withColumn("length", F.lit(None).cast("long"))
    return found.unionByName(lost)


QUERIES = {
    "manifest_rewrite": page_paths,
    "manifest_lines": document_paths,
    "manifest_text": written_paths,
    "manifest_attrs": manifest_attrs,
    "manifest_split": split_documents,
    "manifest_split_written": split_lines,
    "manifest_counts": counts,
    "manifest_side_counts": side_counts,
    "annotated_only": annotated_only,
    "bbox_explode": bbox_explode,
    "label_boxes": label_boxes,
    "manifest_files": manifest_files,
}

BOXES = f"""
boxes AS (
    SELECT vec_id AS image_id, g AS box_index,
        CAST(trunc(abs(CAST(embedding[4 * g + 1] AS DOUBLE) * 300)) AS BIGINT) AS "left",
        CAST(trunc(abs(CAST(embedding[4 * g + 2] AS DOUBLE) * 300)) AS BIGINT) AS top,
        CAST(trunc(abs(CAST(embedding[4 * g + 3] AS DOUBLE) * 300)) AS BIGINT) AS width,
        CAST(trunc(abs(CAST(embedding[4 * g + 4] AS DOUBLE) * 300)) AS BIGINT) AS height,
        CAST(floor(abs(CAST(embedding[4 * g + 1] AS DOUBLE) * 300) / 10) AS BIGINT) % {CLASS_COUNT} AS class_id
    FROM (SELECT *, unnest(range(0, len(embedding) // 4)) AS g FROM embeddings))"""


def _ranked(key: str) -> str:
    return f"""
    SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{SEED}:' || {key}), {key})
        <= round(0.8 * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split"""


_REF = f"'{ROOT}/images/' || doc_id"

ORACLES = {
    "manifest_rewrite": f"""
        SELECT '{ROOT}/images/' || url AS source_ref, '{ROOT}/images/' || url AS line_ref,
            page_id, md5(html) AS html_md5
        FROM pages""",
    "manifest_lines": f"""
        SELECT '{ROOT}/images/' || d.doc_id AS source_ref, d.doc_id, lang, n_chars,
            md5(text) AS text_md5, quality + 1.5::DOUBLE AS width
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "manifest_text": f"""
        WITH l AS (
            SELECT doc_id, '{{"weight" : 1.0, "id":{"1" * 48}' || doc_id || ', "source-ref"' || chr(9) || ': "{ROOT}/images/' || doc_id
                || '", "id": 1e400, "inner":{{"source-ref":"raw/images/0"}}, "text":[' || CAST(to_json(text) AS VARCHAR) || ']}}' AS line
            FROM documents)
        SELECT doc_id, '{ROOT}/images/' || doc_id AS source_ref, substr(line, 1, 230) AS head, md5(line) AS line_md5 FROM l""",
    "manifest_attrs": """
        SELECT 'raw/images/' || source || '/images/' || d.doc_id AS source_ref,
            CASE WHEN l.doc_id IS NULL THEN 0::BIGINT ELSE 1::BIGINT END AS n_boxes,
            toxic + 2.5::DOUBLE AS height
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "manifest_split": f"SELECT doc_id, lang, split FROM ({_ranked('doc_id')} FROM documents)",
    "manifest_split_written": f"""
        SELECT split, ref AS source_ref, md5(text) AS text_md5
        FROM ({_ranked('ref')} FROM (SELECT *, {_REF} AS ref FROM documents))""",
    "manifest_counts": f"""
        SELECT count(*) AS n_all, count(*) FILTER (split = 'train') AS n_train,
            count(*) FILTER (split = 'validation') AS n_validation
        FROM ({_ranked('doc_id')} FROM documents)""",
    "manifest_side_counts": f"""
        SELECT split, count(*) AS n FROM ({_ranked('doc_id')} FROM documents) GROUP BY 1""",
    "annotated_only": """
        SELECT d.doc_id, 'raw/images/' || source || '/images/' || d.doc_id AS source_ref
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "bbox_explode": f"WITH {BOXES.strip()} SELECT * EXCLUDE (class_id) FROM boxes",
    "label_boxes": """
        SELECT d.doc_id, CASE WHEN quality IS NOT NULL THEN 0::BIGINT END AS box_index,
            CAST(quality AS BIGINT) AS "left", CAST(toxic AS BIGINT) AS top,
            CAST(quality + 1 AS BIGINT) AS width, CAST(toxic + 2 AS BIGINT) AS height
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "manifest_files": f"""
        SELECT '{ROOT}/images/' || doc_id AS path, doc_id,
            CAST(octet_length(encode(html)) AS BIGINT) AS length
        FROM documents LEFT JOIN pages ON page_id = doc_id""",
}
