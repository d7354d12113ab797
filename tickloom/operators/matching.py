"""REA3: detections matched with truth boxes by intersection over union, and how good they are.

`match_detections` asks each detection for its best box only; `match_by_class` deals the boxes of a
class out one to one. In the first each detection goes to the truth box it overlaps most, if the overlap reaches the threshold; of the
detections that go to one truth box, the one with the highest score is right and the others are not.

Two boxes of a crowded image are compared only where they can reach the threshold. Reaching it needs
widths within a factor of 1/threshold, and centres no farther apart than (1 - threshold) times the
larger width; the same holds for heights. So boxes are put into cells by size class and centre, a
truth box is entered into the few cells around it, and the join runs on image and cell. That finds
exactly the pairs a comparison of all boxes of an image would find.

Cells cost a truth box some ten to a hundred rows, so only crowded images go that way. Where an image
has few truths or few detections, all its boxes are compared: the pairs are at most FEW times its boxes
then, and no truth box is entered anywhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.boxes import bit_length, iou
from tickloom.operators.running import in_ranges, later_max, running_sums
from tickloom.sinks.stage import staged

_BOX = ("left", "top", "width", "height")
#: Truths or detections of an image, whichever are fewer, up to which all its boxes are compared.
FEW = 32


def match_detections(
    truths: DataFrame, detections: DataFrame, threshold: float = fixed.IOU_THRESHOLD
) -> DataFrame:
    """Right detections: image_id, truth_index, det_index, score, iou.

    `truths` has image_id, truth_index and a box; `detections` has image_id, det_index, score and a
    box. Boxes are left, top, width, height in whole pixels; empty boxes match nothing. The
    threshold lies above 0 and is 1 at most.
    """
    _check(threshold)
    # Of equal boxes only one can matter: the first truth, and the best detection.
    lowest = F.min("truth_index").alias("truth_index")
    one_truth = _solid(truths).groupBy("image_id", *_BOX).agg(lowest)
    best = F.max(F.struct("score", (-F.col("det_index")).alias("_d")))
    one_det = (
        _solid(detections)
        .groupBy("image_id", *_BOX)
        .agg(best.alias("_best"))
        .select(
            "image_id",
            *_BOX,
            F.col("_best.score").alias("score"),
            (-F.col("_best._d")).alias("det_index"),
        )
    )
    columns = ["image_id", "d.det_index", "d.score", "t.truth_index", "iou"]
    reached = _reached(one_truth, one_det, threshold, ["image_id"], columns)
    chosen = (
        reached.groupBy("image_id", "det_index")
        .agg(F.max(F.struct("iou", (-F.col("truth_index")).alias("_t"), "score")).alias("_c"))
        .select(
            "image_id",
            "det_index",
            (-F.col("_c._t")).alias("truth_index"),
            F.col("_c.score").alias("score"),
            F.col("_c.iou").alias("iou"),
        )
    )
    return (
        chosen.groupBy("image_id", "truth_index")
        .agg(F.max(F.struct("score", (-F.col("det_index")).alias("_d"), "iou")).alias("_c"))
        .select(
            "image_id",
            "truth_index",
            (-F.col("_c._d")).alias("det_index"),
            F.col("_c.score").alias("score"),
            F.col("_c.iou").alias("iou"),
        )
    )


_CLASS = ["image_id", "class_id"]


def match_by_class(
    truths: DataFrame, detections: DataFrame, threshold: float = fixed.IOU_THRESHOLD
) -> DataFrame:
    """One-to-one matches: image_id, class_id, truth_index, det_index, score, iou.

    Frames as for `match_detections`, both with a class_id; only boxes of one class match. A
    detection that loses a box to one of a higher score goes on to its next best box that is free,
    so the result is that of serving an image's detections by score (ties by det_index), each with
    the free box it overlaps most (ties by truth_index) among those it overlaps enough. Rows with a
    null class or score match nothing.

    Found in rounds: every detection asks for the best box left to it, every box holds on to the
    best that ever asked, and what cannot hold it any more is struck out, until nobody is refused.
    Equal truth boxes are one box with as many places, so copies do not multiply the pairs.
    """
    _check(threshold)
    places = _solid(truths).groupBy(*_CLASS, *_BOX).agg(
        F.count(F.lit(1)).alias("places"), F.min("truth_index").alias("box")
    )
    usable = _solid(detections).where(F.col("score").isNotNull())
    columns = [*_CLASS, "t.box", "t.places", "d.det_index", "d.score", "iou"]
    left = staged(_reached(places, usable, threshold, _CLASS, columns), "pairs")
    most = left.agg(F.max("places")).first()[0] or 0
    by_score = Window.partitionBy(*_CLASS, "box").orderBy(F.desc("score"), "det_index")
    rank = F.struct("score", -F.col("det_index"))
    n_left = left.count()
    while True:
        best = left.groupBy(*_CLASS, "det_index").agg(
            F.max(F.struct("iou", (-F.col("box")).alias("_b"), "places", "score")).alias("_c")
        )
        asked = best.select(
            *_CLASS, "det_index", (-F.col("_c._b")).alias("box"), "_c.places", "_c.score", "_c.iou"
        )
        # Spark keeps `most` rows of a box in each task before it moves any.
        held = asked.withColumn("place", F.row_number().over(by_score)).where(
            (F.col("place") <= most) & (F.col("place") <= F.col("places"))
        )
        full = held.where(F.col("place") == F.col("places")).select(*_CLASS, "box", rank.alias("_last"))
        able = left.join(full, [*_CLASS, "box"], "left").where(
            F.col("_last").isNull() | (rank >= F.col("_last"))
        )
        able = staged(able.drop("_last"), "pairs")
        n_able = able.count()
        if n_able == n_left:
            break
        left, n_left = able, n_able
    by_index = Window.partitionBy(*_CLASS, *_BOX).orderBy("truth_index")
    named = _solid(truths).select(
        *_CLASS,
        "truth_index",
        F.row_number().over(by_index).alias("place"),
        F.min("truth_index").over(Window.partitionBy(*_CLASS, *_BOX)).alias("box"),
    )
    return held.join(named, [*_CLASS, "box", "place"]).select(
        *_CLASS, "truth_index", "det_index", "score", "iou"
    )


def average_precision(truths: DataFrame, detections: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per class: n_truths, n_detections, n_matches, average_precision, mean_average_precision.

    `matches` as from `match_by_class`. Detections are taken by falling score, those of one score
    together; precision at a recall is the greatest reached at that recall or beyond, and its mean
    over the recalls, a class's truths giving the steps, is the average precision. A class without
    detections has 0; one without truths has NULL and does not count in the mean. Boxes without a
    class are of none and are left out.
    """
    truths, detections = (df.where(F.col("width").isNotNull() & F.col("class_id").isNotNull()) for df in (truths, detections))
    found = detections.where(F.col("score").isNotNull())
    right = matches.select(*_CLASS, "det_index", F.lit(1).alias("_right"))
    scored = found.join(right, [*_CLASS, "det_index"], "left").groupBy("class_id", "score").agg(
        F.count(F.lit(1)).alias("n"), F.count("_right").alias("n_right")
    )
    order = [F.desc("score")]
    ranged = in_ranges(scored, ["class_id"], order)
    counted = running_sums(ranged, ["class_id"], order, {"_n": "n", "_right": "n_right"})
    curve = counted.withColumn("precision", F.col("_right") / F.col("_n"))
    reached = later_max(curve, ["class_id"], order, "precision", "envelope")
    by_class = reached.groupBy("class_id").agg(
        F.sum("n").alias("n_detections"),
        F.sum("n_right").alias("n_matches"),
        F.sum(F.col("n_right") * F.col("envelope")).alias("_area"),
    )
    there = truths.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_truths"))
    zero = F.lit(0).cast("long")
    classes = there.join(by_class, "class_id", "full").select(
        "class_id",
        *[F.coalesce(n, zero).alias(n) for n in ("n_truths", "n_detections", "n_matches")],
        F.try_divide(F.coalesce("_area", F.lit(0.0)), F.coalesce("n_truths", zero)).alias("average_precision"),
    )
    classes = staged(classes, "classes")
    return classes.withColumn("mean_average_precision", classes.agg(F.avg("average_precision")).scalar())


def precision_recall(truths: DataFrame, detections: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: counts, precision and recall; NULL where there is nothing to divide by.

    A row without a box, kept for an image that has none, is no truth and no detection.
    """
    parts = [
        df.agg(F.count(F.col("width") if "width" in df.columns else F.lit(1)).alias("n")).select(
            F.lit(name).alias("kind"), "n"
        )
        for name, df in (("truth", truths), ("det", detections), ("match", matches))
    ]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")))

    return counts.agg(
        of("truth").alias("n_truths"), of("det").alias("n_detections"), of("match").alias("n_matches")
    ).select(
        "*",
        F.try_divide("n_matches", "n_detections").alias("precision"),
        F.try_divide("n_matches", "n_truths").alias("recall"),
    )


def _check(threshold: float) -> None:
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold {threshold} is not above 0 and up to 1")


def _reached(
    truths: DataFrame, detections: DataFrame, threshold: float, keys: Sequence[str], columns: Sequence[str], few: int = FEW
) -> DataFrame:
    """`columns` of pairs `d`, `t` with equal keys whose overlap `iou` reaches the threshold."""

    def overlapping(d: DataFrame, t: DataFrame, on: list[str]) -> DataFrame:
        overlap = iou({f: F.col(f"d.{f}") for f in _BOX}, {f: F.col(f"t.{f}") for f in _BOX})
        pairs = d.alias("d").join(t.alias("t"), on).withColumn("iou", overlap)
        return pairs.where(F.col("iou") >= threshold).select(*columns)

    by = list(keys)
    n_truths, n_dets = (df.groupBy(*by).agg(F.count(F.lit(1)).alias(n)) for df, n in ((truths, "_t"), (detections, "_d")))
    crowded = staged(n_truths.join(n_dets, by).where(F.least("_t", "_d") > few).select(*by), "crowded")
    if crowded.isEmpty():
        return overlapping(detections, truths, by)
    calm = overlapping(detections.join(crowded, by, "left_anti"), truths, by)
    d, t = (df.join(crowded, by, "left_semi") for df in (detections, truths))
    cells = [*by, "_lx", "_cx", "_ly", "_cy"]
    return calm.unionByName(overlapping(_in_cells(d), _around_cells(t, threshold), cells))


def _solid(boxes: DataFrame) -> DataFrame:
    return boxes.where((F.col("width") > 0) & (F.col("height") > 0))


def _class(size: Column) -> Column:
    """Size class: sizes 1 to 3, 4 to 15, 16 to 63 and so on."""
    return F.floor(bit_length(size) / 2).cast("int")


def _widest(level: Column) -> Column:
    """No box of the class is wider than this."""
    return F.pow(F.lit(4.0), level + 1)


def _cell(twice_centre: Column, level: Column) -> Column:
    """Cell along one axis; cells of a size class are twice as wide as its widest box."""
    return F.floor(twice_centre / (4 * _widest(level)))


def _in_cells(boxes: DataFrame) -> DataFrame:
    """Each box in the one cell of its own size class and centre."""
    return (
        boxes.withColumn("_lx", _class(F.col("width")))
        .withColumn("_ly", _class(F.col("height")))
        .withColumn("_cx", _cell(F.col("left") * 2 + F.col("width"), F.col("_lx")))
        .withColumn("_cy", _cell(F.col("top") * 2 + F.col("height"), F.col("_ly")))
    )


def _around_cells(boxes: DataFrame, threshold: float) -> DataFrame:
    """Each box in every cell that can hold a partner."""
    both = boxes
    for axis, start, size in (("x", "left", "width"), ("y", "top", "height")):
        level, cell = f"_l{axis}", f"_c{axis}"
        least = F.greatest(F.floor(F.col(size) * threshold), F.lit(1))
        most = F.ceil(F.col(size) / threshold)
        both = both.withColumn(
            level, F.explode(F.sequence(_class(least), _class(most)))
        )
        # Partners are as wide as their class and the threshold allow. The reach is doubled as the
        # centres are; one more pixel covers rounding.
        widest = F.greatest(F.col(size), F.least(_widest(F.col(level)), most))
        reach = F.ceil(widest * (2 * (1 - threshold))) + 2
        middle = F.col(start) * 2 + F.col(size)
        both = both.withColumn(
            cell,
            F.explode(
                F.sequence(_cell(middle - reach, F.col(level)), _cell(middle + reach, F.col(level)))
            ),
        )
    return both
