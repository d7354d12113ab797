"""Detections: threshold, pixels, labels, matching."""

from __future__ import annotations

import random

import pytest

from tickloom.operators.detections import detection_boxes, with_labels
from tickloom.operators.matching import match_detections, precision_recall
from tickloom.plans.overlay import overlay_detections, overlay_labelled

DETECTION = "struct<class_id:int,score:double,x0:double,y0:double,x1:double,y1:double>"
BOX = "left int, top int, width int, height int"


def scored(spark, detections, width=200, height=100):
    return spark.createDataFrame(
        [(1, width, height, detections)],
        f"image_id int, width int, height int, detections array<{DETECTION}>",
    )


def test_score_at_the_threshold_is_kept(spark):
    df = scored(spark, [(0, s, 0.0, 0.0, 1.0, 1.0) for s in (0.32, 0.33, 0.34)])
    rows = detection_boxes(df, 0.33, "image_id").collect()
    assert [(r["det_index"], r["score"]) for r in rows] == [(1, 0.33), (2, 0.34)]


def test_corners_are_cut_to_pixels(spark):
    df = scored(spark, [(0, 0.9, 0.1049, 0.199, 0.9999, -0.019)])
    r = detection_boxes(df, 0.5, "image_id").first()
    assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) == (20, 19, 199, -1)
    assert (r["width"], r["height"]) == (179, -20)


def test_labels_fall_back_to_the_id(spark):
    boxes = detection_boxes(scored(spark, [(c, 0.98765, 0.0, 0.0, 1.0, 1.0) for c in (0, 1, 7)]), 0.5, "image_id")
    got = sorted(r["label"] for r in with_labels(boxes, ["bird", "cat"]).collect())
    assert got == ["7 0.988", "bird 0.988", "cat 0.988"]
    frame = spark.createDataFrame([(7, "fish")], "class_id int, class string")
    assert sorted(r["class_name"] for r in with_labels(boxes, frame).collect()) == ["0", "1", "fish"]


def test_each_image_gets_its_own_detections(spark):
    boxes = [(1.0, 1.0, 1.0, 1.0)]
    manifest = spark.createDataFrame(
        [("a", boxes), ("b", None), ("c", boxes)],
        "image_id string, annotations array<struct<left:double,top:double,width:double,height:double>>",
    )
    found = spark.createDataFrame(
        [("a", 9, 9, [(0, 0.9, 0.0, 0.0, 1.0, 1.0), (0, 0.1, 0.0, 0.0, 1.0, 1.0)]), ("b", 9, 9, [])],
        f"image_id string, width int, height int, detections array<{DETECTION}>",
    )
    rows = {r["image_id"]: r for r in overlay_detections(manifest, found, 0.33).collect()}
    assert [d["score"] for d in rows["a"]["detections"]] == [0.9]
    assert rows["b"]["boxes"] is None and rows["b"]["detections"] == []
    assert rows["c"]["detections"] is None and len(rows["c"]["boxes"]) == 1
    first = overlay_detections(manifest, found, 0.33, limit=2).collect()
    assert sorted(r["image_id"] for r in first) == ["a", "b"]


def iou(a, b):
    w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    inter = float(max(w, 0)) * max(h, 0)
    return inter / (float(a[2]) * a[3] + float(b[2]) * b[3] - inter)


def all_pairs(truths, detections, threshold):
    claims = {}
    for image, d, score, *box in detections:
        options = [
            (iou(box, t[2:]), -t[1])
            for t in truths
            if t[0] == image and min(box[2:] + t[4:]) > 0
        ]
        best = max(options, default=(0, 0))
        if options and best[0] >= threshold:
            claims.setdefault((image, -best[1]), []).append((score, -d, best[0]))
    return sorted(
        (image, t, -max(c)[1], max(c)[0], max(c)[2]) for (image, t), c in claims.items()
    )


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.75, 0.9, 1.0])
@pytest.mark.parametrize("spread, size", [(30, 12), (400, 90), (60, 3), (2000, 700)])
def test_matches_are_those_of_all_pairs(spark, threshold, spread, size):
    rng = random.Random(f"{threshold}{spread}{size}")

    def box():
        return [rng.randrange(-5, spread), rng.randrange(spread), rng.randrange(-1, size), rng.randrange(size)]

    truths, detections = [], []
    for image in range(3):
        for t in range(12):
            truths.append([image, t, *box()])
        for d in range(25):
            near = list(rng.choice(truths)[2:]) if rng.random() < 0.7 else box()
            moved = [v + rng.choice([-size // 8, -1, 0, 0, 1, size // 9]) for v in near]
            detections.append([image, d, rng.randrange(5) / 5, *moved])
        truths.append([image, 12, *truths[-1][2:]])
        detections.append([image, 25, 0.9, *detections[-1][3:]])
    t = spark.createDataFrame(truths, f"image_id int, truth_index int, {BOX}")
    d = spark.createDataFrame(detections, f"image_id int, det_index int, score double, {BOX}")
    columns = ["image_id", "truth_index", "det_index", "score", "iou"]
    got = sorted(tuple(r) for r in match_detections(t, d, threshold).select(columns).collect())
    expected = all_pairs(truths, detections, threshold)
    assert got == expected


def test_precision_and_recall(spark):
    t = spark.createDataFrame([(1, 0, 0, 0, 10, 10), (1, 1, 50, 50, 10, 10)], f"image_id int, truth_index int, {BOX}")
    d = spark.createDataFrame(
        [(1, 0, 0.9, 0, 0, 10, 9), (1, 1, 0.8, 0, 0, 10, 10), (1, 2, 0.7, 90, 90, 5, 5), (2, 0, 0.9, 0, 0, 10, 10)],
        f"image_id int, det_index int, score double, {BOX}",
    )
    row = precision_recall(t, d, match_detections(t, d)).first()
    assert tuple(row) == (2, 4, 1, 0.25, 0.5)
    none = precision_recall(t.limit(0), d.limit(0), match_detections(t.limit(0), d.limit(0))).first()
    assert tuple(none) == (0, 0, 0, None, None)


def test_labelled_overlay_shows_pixels_names_and_labels(spark):
    manifest = spark.createDataFrame(
        [("a", [(1.9, 2.0, 3.0, 4.0)]), ("b", None)], "image_id string, annotations array<struct<left:double,top:double,width:double,height:double>>"
    )
    found = spark.createDataFrame(
        [("a", 200, 100, [(7, 0.2, 0.0, 0.0, 1.0, 1.0), (0, 0.9, 0.1, 0.2, 0.5, 0.6), (5, 0.5, 0.0, 0.0, 1.0, 1.0), (-1, 0.6, 0.0, 0.0, 0.0, 0.0)])],
        f"image_id string, width int, height int, detections array<{DETECTION}>",
    )
    rows = {r["image_id"]: r for r in overlay_labelled(manifest, found, 0.33, ("bird",)).collect()}
    assert [(d.det_index, d.class_name, d.label) for d in rows["a"]["found"]] == [(1, "bird", "bird 0.900"), (2, "5", "5 0.500"), (3, "-1", "-1 0.600")]
    first = rows["a"]["found"][0]
    assert (first.xmin, first.ymin, first.xmax, first.ymax, first.width, first.height) == (20, 20, 100, 60, 80, 40)
    assert [tuple(b) for b in rows["a"]["boxes"]] == [(1, 2, 3, 4)]
    assert rows["b"]["found"] is None and rows["b"]["boxes"] is None
    assert [r["image_id"] for r in overlay_labelled(manifest, found, 0.33, limit=1).collect()] == ["a"]
