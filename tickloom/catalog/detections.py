"""Detections and truth boxes, over embeddings and region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.manifests import BOXES, CLASS_COUNT, box_manifest
from tickloom.catalog.standins import table, tidy
from tickloom.operators.detections import detection_boxes, with_labels
from tickloom.operators.manifests import BOX_FIELDS, explode_boxes
from tickloom.operators.matching import average_precision, match_by_class, match_detections, precision_recall
from tickloom.plans.overlay import overlay_detections, overlay_labelled

THRESHOLD = 0.33
SIZE = 300
# Overlap that counts for matches by class, and the score of detections that are of no box's class.
CLASS_THRESHOLD = 0.2
STRANGE = 1.2


def scored_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as scored images: six numbers in a row make a detection."""
    vectors = table(spark, sf_dir, "embeddings")
    starts = F.sequence(F.lit(0), F.floor(F.size("embedding") / 6) - 1)

    def number(g, k):
        return F.abs(F.get("embedding", (g * 6 + k).cast("int")).cast("double"))

    found = F.transform(
        starts,
        lambda g: F.struct(
            F.floor(number(g, 0) * 30).cast("int").alias("class_id"),
            (number(g, 1) * 4).alias("score"),
            F.least(number(g, 2), number(g, 4)).alias("x0"),
            F.least(number(g, 3), number(g, 5)).alias("y0"),
            F.greatest(number(g, 2), number(g, 4)).alias("x1"),
            F.greatest(number(g, 3), number(g, 5)).alias("y1"),
        ),
    )
    return vectors.select(
        F.col("vec_id").alias("image_id"),
        F.lit(SIZE).alias("width"),
        F.lit(SIZE).alias("height"),
        found.alias("detections"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection_boxes(scored_images(spark, sf_dir), THRESHOLD, "image_id")


def pixel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(boxes(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("class_id"), F.col("r_name").alias("class")
    )
    named = with_labels(boxes(spark, sf_dir), classes)
    return tidy(named.select("image_id", "det_index", "class_id", "class_name", "label"))


def labelled_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_labels(boxes(spark, sf_dir))
    return tidy(named.select("image_id", "det_index", "class_id", "class_name", "label"))


def _overlay(limit: int | None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        truth = box_manifest(spark, sf_dir)
        found = scored_images(spark, sf_dir)
        side_by_side = overlay_detections(truth, found, THRESHOLD, limit=limit)
        kept = side_by_side.select("image_id", "boxes", F.posexplode_outer("detections").alias("i", "d"))
        return tidy(
            kept.select(
                "image_id",
                F.size("boxes").alias("n_boxes"),
                F.aggregate("boxes", F.lit(0), lambda a, b: a + b["width"]).alias("truth_width"),
                F.col("i").alias("kept_index"),
                F.col("d.score").alias("score"),
            )
        )

    return query


def overlay_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every image with the number of its boxes and its detections as they are drawn."""
    shown = overlay_labelled(box_manifest(spark, sf_dir), scored_images(spark, sf_dir), THRESHOLD, ("bird", "cat"))
    rows = shown.select("image_id", F.size("boxes").alias("n_boxes"), F.explode_outer("found").alias("f"))
    return tidy(rows.select("image_id", "n_boxes", "f.*"))


def _truths_and_detections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    truths = explode_boxes(
        box_manifest(spark, sf_dir), F.col("annotations"), "image_id", fields=(*BOX_FIELDS, "class_id")
    ).withColumnRenamed("box_index", "truth_index")
    found = boxes(spark, sf_dir).select(
        "image_id",
        "det_index",
        (F.col("class_id") % CLASS_COUNT).alias("class_id"),
        "score",
        F.col("xmin").alias("left"),
        F.col("ymin").alias("top"),
        "width",
        "height",
    )
    return truths, found


def _match(threshold: float):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(match_detections(*_truths_and_detections(spark, sf_dir), threshold))

    return query


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    truths, found = _truths_and_detections(spark, sf_dir)
    return tidy(precision_recall(truths, found, match_detections(truths, found)))


def by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(match_by_class(*_truths_and_detections(spark, sf_dir), CLASS_THRESHOLD))


def class_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes 0 to 2 of the boxes, and class 3 of detections whose images have no such box."""
    truths, found = _truths_and_detections(spark, sf_dir)
    strange = F.when(F.col("score") > STRANGE, CLASS_COUNT).otherwise(F.col("class_id"))
    # Scores in steps, so that many are equal.
    found = found.withColumn("class_id", strange).withColumn("score", F.round("score", 1))
    measured = average_precision(truths, found, match_by_class(truths, found, CLASS_THRESHOLD))
    rounded = [F.round(c, 6).alias(c) for c in ("average_precision", "mean_average_precision")]
    return tidy(measured.select("class_id", "n_truths", "n_detections", "n_matches", *rounded))


QUERIES = {
    "detection_boxes": pixel_boxes,
    "detection_labels": labelled,
    "detection_labels_by_list": labelled_by_list,
    "overlay_join": _overlay(None),
    "overlay_first_images": _overlay(10),
    "overlay_labels": overlay_labels,
    "iou_match": _match(0.5),
    "iou_match_loose": _match(0.3),
    "precision_recall": quality,
    "iou_match_by_class": by_class,
    "average_precision": class_precision,
}


def _n(k: int) -> str:
    return f"abs(CAST(embedding[6 * g + {k}] AS DOUBLE))"


DETS = f"""
raw AS (
    SELECT vec_id AS image_id, g AS det_index, CAST(floor({_n(1)} * 30) AS BIGINT) AS class_id,
        {_n(2)} * 4 AS score, least({_n(3)}, {_n(5)}) AS x0, least({_n(4)}, {_n(6)}) AS y0,
        greatest({_n(3)}, {_n(5)}) AS x1, greatest({_n(4)}, {_n(6)}) AS y1
    FROM (SELECT *, unnest(range(0, len(embedding) // 6)) AS g FROM embeddings)),
corners AS (
    SELECT image_id, det_index, class_id, score,
        CAST(trunc(x0 * {SIZE}) AS BIGINT) AS xmin, CAST(trunc(y0 * {SIZE}) AS BIGINT) AS ymin,
        CAST(trunc(x1 * {SIZE}) AS BIGINT) AS xmax, CAST(trunc(y1 * {SIZE}) AS BIGINT) AS ymax
    FROM raw WHERE score >= {THRESHOLD}),
dets AS (SELECT *, xmax - xmin AS width, ymax - ymin AS height FROM corners)"""


def _matches(threshold: float) -> str:
    return f"""
    WITH {BOXES.strip()}, {DETS.strip()},
    sides AS (
        SELECT d.image_id, d.det_index, d.score, t.box_index AS truth_index,
            greatest(least(d.xmin + d.width, t."left" + t.width) - greatest(d.xmin, t."left"), 0) AS w,
            greatest(least(d.ymin + d.height, t.top + t.height) - greatest(d.ymin, t.top), 0) AS h,
            d.width * d.height + t.width * t.height AS areas
        FROM dets d JOIN boxes t ON t.image_id = d.image_id
        WHERE d.width > 0 AND d.height > 0 AND t.width > 0 AND t.height > 0),
    shares AS (
        SELECT *, CAST(w * h AS DOUBLE) / CAST(areas - w * h AS DOUBLE) AS iou FROM sides),
    chosen AS (
        SELECT *, row_number() OVER (
            PARTITION BY image_id, det_index ORDER BY iou DESC, truth_index) AS r
        FROM shares WHERE iou >= {threshold}),
    won AS (
        SELECT *, row_number() OVER (
            PARTITION BY image_id, truth_index ORDER BY score DESC, det_index) AS place
        FROM chosen WHERE r = 1),
    matches AS (SELECT image_id, truth_index, det_index, score, iou FROM won WHERE place = 1)
    """


def _by_class(dets: str) -> str:
    """Detections of an image and class served one after the other, each with the best box still free."""
    return f"""
    WITH RECURSIVE {BOXES.strip()}, {DETS.strip()},
    used AS ({dets}),
    sides AS (
        SELECT d.image_id, d.class_id, d.det_index, t.box_index,
            greatest(least(d.xmin + d.width, t."left" + t.width) - greatest(d.xmin, t."left"), 0) AS w,
            greatest(least(d.ymin + d.height, t.top + t.height) - greatest(d.ymin, t.top), 0) AS h,
            d.width * d.height + t.width * t.height AS areas
        FROM used d JOIN boxes t ON t.image_id = d.image_id AND t.class_id = d.class_id
        WHERE d.width > 0 AND d.height > 0 AND t.width > 0 AND t.height > 0),
    shares AS (
        SELECT *, CAST(w * h AS DOUBLE) / CAST(areas - w * h AS DOUBLE) AS iou FROM sides),
    wishes AS (
        SELECT image_id, class_id, det_index,
            list({{'box': box_index, 'iou': iou}} ORDER BY iou DESC, box_index) AS wanted
        FROM shares WHERE iou >= {CLASS_THRESHOLD} GROUP BY 1, 2, 3),
    turns AS (
        SELECT u.image_id, u.class_id, u.det_index, u.score, coalesce(w.wanted, []) AS wanted,
            row_number() OVER (PARTITION BY u.image_id, u.class_id ORDER BY u.score DESC, u.det_index) AS k
        FROM used u LEFT JOIN wishes w USING (image_id, class_id, det_index)),
    served AS (
        SELECT image_id, class_id, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken,
            CAST(NULL AS BIGINT) AS det_index, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS STRUCT(box BIGINT, iou DOUBLE)) AS got
        FROM (SELECT DISTINCT image_id, class_id FROM turns)
        UNION ALL
        SELECT image_id, class_id, k, CASE WHEN got IS NULL THEN taken ELSE list_append(taken, got.box) END, det_index, score, got
        FROM (
            SELECT t.image_id, t.class_id, t.k, s.taken, t.det_index, t.score,
                list_filter(t.wanted, lambda x: NOT list_contains(s.taken, x.box))[1] AS got
            FROM served s JOIN turns t ON t.image_id = s.image_id AND t.class_id = s.class_id AND t.k = s.k + 1)),
    matches AS (
        SELECT image_id, class_id, got.box AS truth_index, det_index, score, got.iou AS iou FROM served WHERE got IS NOT NULL)
    """


_ROUGH = f"""
    SELECT image_id, det_index, CASE WHEN score > {STRANGE} THEN {CLASS_COUNT} ELSE class_id % {CLASS_COUNT} END AS class_id,
        round(score, 1) AS score, xmin, ymin, width, height
    FROM dets"""


def _overlay_sql(images: str) -> str:
    return f"""
        WITH {BOXES.strip()}, {DETS.strip()},
        per_image AS (
            SELECT image_id, count(*) AS n_boxes, CAST(sum(width) AS BIGINT) AS truth_width
            FROM boxes GROUP BY 1 {images})
        SELECT p.image_id, n_boxes, truth_width,
            CASE WHEN d.det_index IS NOT NULL THEN
                row_number() OVER (PARTITION BY p.image_id ORDER BY det_index) - 1 END AS kept_index,
            score
        FROM per_image p LEFT JOIN dets d ON d.image_id = p.image_id"""


ORACLES = {
    "detection_boxes": f"WITH {DETS.strip()} SELECT * FROM dets",
    "detection_labels": f"""
        WITH {DETS.strip()}
        SELECT image_id, det_index, class_id, coalesce(r_name, CAST(class_id AS VARCHAR)) AS class_name,
            printf('%s %.3f', coalesce(r_name, CAST(class_id AS VARCHAR)), score) AS label
        FROM dets LEFT JOIN region ON r_regionkey = class_id""",
    "detection_labels_by_list": f"""
        WITH {DETS.strip()}, named AS (
            SELECT *, CASE class_id WHEN 0 THEN 'bird' ELSE CAST(class_id AS VARCHAR) END AS class_name
            FROM dets)
        SELECT image_id, det_index, class_id, class_name,
            printf('%s %.3f', class_name, score) AS label
        FROM named""",
    "overlay_join": _overlay_sql(""),
    "overlay_first_images": _overlay_sql("ORDER BY image_id LIMIT 10"),
    "overlay_labels": f"""
        WITH {BOXES.strip()}, {DETS.strip()},
        per_image AS (SELECT image_id, count(*) AS n_boxes FROM boxes GROUP BY 1),
        named AS (
            SELECT *, CASE class_id WHEN 0 THEN 'bird' WHEN 1 THEN 'cat' ELSE CAST(class_id AS VARCHAR) END AS class_name FROM dets)
        SELECT p.image_id, n_boxes, det_index, class_id, class_name, score,
            CASE WHEN det_index IS NOT NULL THEN printf('%s %.3f', class_name, score) END AS label,
            xmin, ymin, xmax, ymax, width, height
        FROM per_image p LEFT JOIN named USING (image_id)""",
    "iou_match": f"{_matches(0.5)} SELECT * FROM matches",
    "iou_match_loose": f"{_matches(0.3)} SELECT * FROM matches",
    "precision_recall": f"""
        {_matches(0.5)}
        SELECT (SELECT count(*) FROM boxes) AS n_truths, (SELECT count(*) FROM dets) AS n_detections,
            (SELECT count(*) FROM matches) AS n_matches,
            (SELECT count(*) FROM matches) / (SELECT count(*) FROM dets)::DOUBLE AS precision,
            (SELECT count(*) FROM matches) / (SELECT count(*) FROM boxes)::DOUBLE AS recall""",
    "iou_match_by_class": f"""
        {_by_class(f"SELECT * REPLACE (class_id % {CLASS_COUNT} AS class_id) FROM dets")}
        SELECT * FROM matches""",
    "average_precision": f"""
        {_by_class(_ROUGH)},
        steps AS (
            SELECT u.class_id, u.score, count(*) AS n, count(m.det_index) AS n_right
            FROM used u LEFT JOIN matches m USING (image_id, class_id, det_index) GROUP BY 1, 2),
        curve AS (
            SELECT *, CAST(sum(n_right) OVER up_to AS DOUBLE) / CAST(sum(n) OVER up_to AS DOUBLE) AS precision FROM steps
            WINDOW up_to AS (PARTITION BY class_id ORDER BY score DESC)),
        envelope AS (
            SELECT *, max(precision) OVER (PARTITION BY class_id ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best
            FROM curve),
        areas AS (
            SELECT class_id, CAST(sum(n) AS BIGINT) AS n_detections, CAST(sum(n_right) AS BIGINT) AS n_matches, sum(n_right * best) AS area
            FROM envelope GROUP BY 1),
        truths AS (SELECT class_id, count(*) AS n_truths FROM boxes GROUP BY 1),
        classes AS (
            SELECT class_id, coalesce(n_truths, 0) AS n_truths, coalesce(n_detections, 0) AS n_detections,
                coalesce(n_matches, 0) AS n_matches, coalesce(area, 0) / n_truths AS ap
            FROM truths FULL JOIN areas USING (class_id))
        SELECT class_id, n_truths, n_detections, n_matches, round(ap, 6) AS average_precision,
            round(avg(ap) OVER (), 6) AS mean_average_precision
        FROM classes""",
}
