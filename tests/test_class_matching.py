"""Matches dealt out by class, and average precision, against serving one detection after the other."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tickloom.operators import matching
from tickloom.operators.matching import average_precision, match_by_class

BOX = "left int, top int, width int, height int"


def share(a, b):
    w = max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]))
    h = max(0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
    return w * h / (a[2] * a[3] + b[2] * b[3] - w * h)


def served(truths, detections, threshold):
    out = set()
    taken = set()
    for image, d, c, score, *box in sorted(detections, key=lambda d: (-(d[3] or 0), d[1])):
        if score is None or c is None or min(box[2], box[3]) <= 0:
            continue
        free = [
            (-share(box, t[3:]), t[1]) for t in truths
            if t[0] == image and t[2] == c and min(t[5], t[6]) > 0 and (image, c, t[1]) not in taken and share(box, t[3:]) >= threshold
        ]
        if free:
            overlap, t = min(free)
            taken.add((image, c, t))
            out.add((image, c, t, d, score, -overlap))
    return out


def crowd(seed, images, n):
    """Boxes that overlap a lot, some of them equal, with scores in steps."""
    rng = random.Random(seed)
    box = lambda: (rng.randint(0, 12), rng.randint(0, 12), rng.randint(0, 14), rng.randint(1, 14))
    some = [box() for _ in range(8)]
    truths = [(i, k, rng.choice([0, 1, 2, None]), *rng.choice([box(), rng.choice(some)])) for i in range(images) for k in range(n)]
    found = [
        (i, k, rng.choice([0, 1, 3, None]), rng.choice([0.9, 0.7, 0.5, 0.3, None]), *rng.choice([box(), rng.choice(some)]))
        for i in range(images) for k in range(2 * n)
    ]
    return truths, found


def frames(spark, truths, found):
    return (
        spark.createDataFrame(truths, f"image_id int, truth_index int, class_id int, {BOX}").repartition(3),
        spark.createDataFrame(found, f"image_id int, det_index int, class_id int, score double, {BOX}").repartition(3),
    )


@pytest.mark.parametrize("threshold,images,n", [(0.5, 4, 12), (0.2, 1, 40), (0.05, 2, 20), (1.0, 3, 10)])
def test_crowded_images_agree_with_serving_by_score(spark, threshold, images, n):
    truths, found = crowd(n, images, n)
    got = match_by_class(*frames(spark, truths, found), threshold)
    assert {tuple(r) for r in got.collect()} == served(truths, found, threshold)


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_few_and_crowded_boxes_give_the_same_pairs(spark, few):
    truths, found = crowd(6, 3, 8)
    truths += [(7, k, 0, 3, 3, 9 + k, 9) for k in range(2)]  # an image with few truths, two without detections or truths
    found += [(7, k, 0, 0.5, 3, 3, 9, 9 + k) for k in range(40)] + [(8, 0, 0, 0.5, 1, 1, 4, 4)]
    t, d = (df.where("width > 0") for df in frames(spark, truths + [(9, 0, 0, 1, 1, 4, 4)], found))
    columns = ["image_id", "class_id", "t.truth_index", "d.det_index"]
    got = matching._reached(t, d, 0.2, ["image_id", "class_id"], columns, few).collect()

    want = [
        (x[0], x[2], x[1], y[1]) for x in truths for y in found
        if x[0] == y[0] and x[2] == y[2] is not None and x[5] > 0 and y[6] > 0 and share(x[3:], y[4:]) >= 0.2
    ]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_images_of_few_boxes_are_not_spread_over_cells(spark, monkeypatch):
    """Each truth box was entered into some 50 cells, whatever its image held."""
    monkeypatch.setattr(matching, "_around_cells", lambda *_: pytest.fail("boxes of a small image went into cells"))
    truths, found = crowd(4, 5, 6)
    got = match_by_class(*frames(spark, truths, found), 0.2)
    assert {tuple(r) for r in got.collect()} == served(truths, found, 0.2)


def test_a_detection_that_loses_its_box_takes_the_next(spark):
    truths = [(1, 0, 0, 0, 0, 10, 10), (1, 1, 0, 2, 0, 10, 10), (1, 2, 1, 0, 0, 10, 10)]
    found = [(1, 0, 0, 0.9, 0, 0, 10, 10), (1, 1, 0, 0.8, 0, 0, 10, 10), (1, 2, 3, 1.0, 0, 0, 10, 10)]
    got = match_by_class(*frames(spark, truths, found), 0.5).orderBy("det_index").collect()
    assert [(r.det_index, r.truth_index) for r in got] == [(0, 0), (1, 1)]


def test_many_copies_of_a_box_are_served_without_all_pairs(spark):
    truths = [(1, k, 0, 5, 5, 10, 10) for k in range(300)]
    found = [(1, k, 0, 0.5, 5, 5, 10, 10) for k in range(500)]
    got = match_by_class(*frames(spark, truths, found), 0.5).collect()
    assert sorted((r.det_index, r.truth_index) for r in got) == [(k, k) for k in range(300)]


def test_average_precision_agrees_with_the_curve(spark):
    truths, found = crowd(5, 6, 15)
    truths += [(20, 0, 7, 0, 0, 5, 5)]  # a class nobody finds; 3 is one that is not there
    t, d = frames(spark, truths, found)
    matches = match_by_class(t, d, 0.2)
    got = {r.class_id: r for r in average_precision(t, d, matches).collect()}
    right = {(m[0], m[1], m[3]) for m in served(truths, found, 0.2)}
    want = {}
    for c in ({x[2] for x in truths} | {x[2] for x in found if x[3] is not None}) - {None}:
        n_truths = sum(x[2] == c for x in truths)
        steps = defaultdict(lambda: [0, 0])
        for image, k, cls, score, *_ in found:
            if cls == c and score is not None:
                steps[score][0] += 1
                steps[score][1] += (image, c, k) in right
        points, n, hits = [], 0, 0
        for score in sorted(steps, reverse=True):
            n, hits = n + steps[score][0], hits + steps[score][1]
            points.append((steps[score][1], hits / n))
        area = sum(k * max(p for _, p in points[i:]) for i, (k, _) in enumerate(points))
        want[c] = (n_truths, n, hits, area / n_truths if n_truths else None)
    assert {c: (r.n_truths, r.n_detections, r.n_matches) for c, r in got.items()} == {c: w[:3] for c, w in want.items()}
    for c, w in want.items():
        assert got[c].average_precision == (w[3] if w[3] is None else pytest.approx(w[3]))
    mean = [w[3] for w in want.values() if w[3] is not None]
    assert {round(r.mean_average_precision, 9) for r in got.values()} == {round(sum(mean) / len(mean), 9)}
    assert got[7].average_precision == 0 and got[3].average_precision is None


def test_empty_frames_match_nothing(spark):
    truths, found = frames(spark, *crowd(1, 1, 2))
    assert match_by_class(truths.limit(0), found).collect() == []
    assert match_by_class(truths, found.limit(0)).collect() == []
    none = match_by_class(truths.limit(0), found.limit(0))
    assert average_precision(truths.limit(0), found.limit(0), none).collect() == []
