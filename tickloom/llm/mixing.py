"""Operator 9: mixing sources to target weights by weighted fair queueing. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import cut
from tickloom.llm.words import word_count

#: Documents of one source, about, whose running sum is taken in one window.
BUCKET_ROWS = 20_000
#: Finish times of one range of the global order, about.
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class MixConfig:
    """weights: dealt to the sources in code-point order, again and again, null last.
    share: words of the mix, as a share of all words. repeats: how often a document may come."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2
    seed: str = "mix"


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in code-point order, null last, from 0: sorted by range, with only
    the row counts of the ranges put in order in one place."""
    placed = cut(sources.repartitionByRange("no_source", "source").withColumn("p", F.spark_partition_id()))
    counts = placed.groupBy("p").agg(F.count("*").alias("n"))
    before = counts.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    in_range = Window.partitionBy("p").orderBy("no_source", "source")
    return placed.withColumn("k", F.row_number().over(in_range)).join(before, "p").withColumn(
        "place", F.col("before") + F.col("k") - 1
    )


def _level(sources: DataFrame, budget: float, repeats: int) -> float:
    """Words per unit of weight, such that targets of level * weight, each held at `repeats` times
    its source's size, add up to the budget. Only two sums come to the driver in each round."""
    level, held = 0.0, -1
    while True:
        most = F.col("source_size") * repeats
        above = F.lit(level) * F.col("weight") > most
        row = sources.agg(
            F.sum(F.when(above, most).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.count_if(above)
        ).first()
        if row[2] == held or not row[1]:
            return level
        held = row[2]
        level = (budget - float(row[0])) / float(row[1])


def _keys(config: MixConfig, id_col: str, text_col: str, source_col: str) -> dict:
    """Columns that name a document in the mix."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return {
        "id": F.col(id_col).cast("long"),
        "source": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
        "no_source": F.col(source_col).isNull(),
        "mark": F.md5(F.concat(F.lit(config.seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.md5(text))).cast("binary")),
    }


def mix(docs: DataFrame, config: MixConfig = MixConfig(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, no_source, source, mark, size, source_size, target, taken, times): one row per document.

    Documents of a source come in the order of a hash of their id (of id and text where ids are
    null), once, then again up to `repeats` times. A copy's virtual finish time is the words of its
    source up to its end, divided by the source's target. Copies are taken by finish time until the
    next would go beyond the budget; equal finish times stand or fall together. So a source gets its
    target but for a document or so, and a document comes `times` times. A null text has size 0 and
    comes with its neighbours; null sources are one source. Rows with equal ids are put in order by
    size, and rows equal in both are alike.
    """
    keys = _keys(config, id_col, text_col, source_col)
    sized = cut(
        docs.select(*[c.alias(n) for n, c in keys.items()], word_count(F.col(text_col).cast("string")).alias("size"))
    )
    sources = sized.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = _ranked(sources)
    weights = F.array(*[F.lit(int(w)) for w in config.weights])
    ranked = cut(ranked.withColumn("weight", F.get(weights, (F.col("place") % len(config.weights)).cast("int"))))
    all_docs, words = ranked.agg(F.sum("docs"), F.sum("source_size")).first()
    budget = min(config.share, float(config.repeats)) * float(words or 0)
    level = _level(ranked, budget, config.repeats)
    most = (F.col("source_size") * config.repeats).cast("double")
    targets = ranked.withColumn(
        "target", F.when(F.lit(level) * F.col("weight") > most, most).otherwise(F.lit(level) * F.col("weight"))
    ).select("no_source", "source", "source_size", "target")

    # Running sums in two steps: over buckets of the order, then inside each. A source of any size
    # is spread over its buckets, whose number follows the number of documents.
    bits = max(0, ((all_docs or 0) // BUCKET_ROWS)).bit_length()
    first = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    sized = sized.withColumn("bucket", F.shiftright(first, 32 - bits))
    key = ["no_source", "source", "bucket"]
    sums = sized.groupBy(*key).agg(F.sum("size").alias("bucket_size"))
    up_to = Window.partitionBy("no_source", "source").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("bucket_size").over(up_to) - F.col("bucket_size")).join(
        targets, ["no_source", "source"]
    )
    inside = Window.partitionBy(*key).orderBy("mark", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("inside", F.sum("size").over(inside)).join(sums, key)
    end = F.col("before") + F.col("inside")
    finish = [
        ((end + F.col("source_size") * again).cast("double") / F.col("target")) for again in range(config.repeats)
    ]
    names = ["id", "no_source", "source", "mark", "size", "source_size", "target"]
    placed = cut(placed.select(*names, F.array(*[F.when(F.col("target") > 0, f) for f in finish]).alias("finish")))
    last = _last_finish(placed, budget, (all_docs or 0) * config.repeats)
    times = F.size(F.filter("finish", lambda f: f <= F.lit(last)))
    return placed.select(*names, (F.col("size") * times).alias("taken"), times.alias("times"))


def _last_finish(placed: DataFrame, budget: float, copies: int) -> float:
    """Where the mix is cut: the last finish time that stays within the budget.

    Copies are summed up by finish time and sorted by range, in ranges whose number follows the number
    of copies. Each running sum is that of its range and the sums of the ranges before, of which alone
    an order is made in one place.
    """
    ends = placed.select("size", F.explode("finish").alias("f")).where("f is not null").groupBy("f").agg(F.sum("size").alias("n"))
    ranges = cut(ends.repartitionByRange(copies // RANGE_ROWS + 1, "f").withColumn("p", F.spark_partition_id()))
    sums = ranges.groupBy("p").agg(F.sum("n").alias("n"))
    before = sums.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("p").orderBy("f"))
    ordered = ranges.withColumn("inside", inside).join(before, "p").withColumn("up_to", F.col("before") + F.col("inside"))
    total, last = ordered.agg(F.max("up_to"), F.max(F.when(F.col("up_to") <= F.lit(budget), F.col("f")))).first()
    if total is None or total <= budget:
        return float("inf")
    return float(last) if last is not None else -1.0


def mixture(docs: DataFrame, config: MixConfig = MixConfig(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the columns of docs.

    Rows that repeat an id in a source share the copies taken of that id evenly.
    """
    key = ["no_source", "source", "id", "mark"]
    mixed = mix(docs, config, id_col, text_col, source_col)
    taken = mixed.groupBy(*key).agg(F.sum("times").alias("times"), F.count("*").alias("rows")).where("times > 0")
    taken = taken.select(*[F.col(k).alias(f"m_{k}") for k in key], "times", "rows")
    keys = _keys(config, id_col, text_col, source_col)
    rows = docs.select(*[c.alias(f"k_{n}") for n, c in keys.items()], F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    same = (
        (F.col("k_no_source") == F.col("m_no_source")) & (F.col("k_source") == F.col("m_source"))
        & F.col("k_id").eqNullSafe(F.col("m_id")) & (F.col("k_mark") == F.col("m_mark"))
    )
    joined = rows.join(taken, same)
    alone = joined.where("rows = 1").select("row", F.col("times").cast("int").alias("n"))
    order = Window.partitionBy("k_no_source", "k_source", "k_id", "k_mark").orderBy(F.col("row").getField(text_col))
    place = F.row_number().over(order)
    more = F.when(place <= F.col("times") % F.col("rows"), 1).otherwise(0)
    several = joined.where("rows > 1").select("row", (F.floor(F.col("times") / F.col("rows")) + more).cast("int").alias("n"))
    out = alone.union(several).where("n > 0").select(F.explode(F.array_repeat("row", F.col("n"))).alias("row"))
    return out.select("row.*")
