"""Operator 13: the trie of conversation prefixes and its totals, rolled up by bands of depth.

A node is the sequence of the first turns of some conversations. It is named by a 128-bit hash, the
exclusive-or of hashes of (place, turn), which runs along a conversation and needs no text. Totals
of subtrees come in two sweeps over bands of HEIGHT levels: inside its band a node adds to its
ancestors there; the roots of bands then are a trie of their own, HEIGHT times less deep, that is
rolled up the same way; and what is below a band's floor comes back down with the completed totals
of the roots under it. So a node is spread to HEIGHT rows at most, and the rounds are the logarithm
of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.anchors_join import stored
from tickloom.llm.arrays import rows_of

#: Levels of a band.
HEIGHT = 16
#: Turns of a conversation that are worked on in one window; longer ones are cut into such stretches.
STRETCH = 4096
#: Ids of one end list that are put together at once.
IDS = 65_536

_KEY = ["k1", "k2"]


def hashed_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, turn, t1, t2, bytes) of every turn: a 128-bit hash of role and text, and the text's bytes.
    A null role or text is empty. Rows without a conversation are left out."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    return turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), role, text).alias("t2"), F.octet_length(text).cast("long").alias("bytes"),
    )


def placed(turns: DataFrame) -> DataFrame:
    """(c, p, t1, t2, bytes): place of each turn in its conversation, from 1, null turns first.

    Turns of one number come in the order of their hashes t1, t2. Conversations are numbered by
    stretches of turn numbers, so a long one is spread over tasks; only the turns of one conversation
    that share a number, or have none, are always together.
    """
    part = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(2**62)))
    turns = turns.withColumn("part", part)
    sizes = turns.groupBy("c", "part").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("c").orderBy("part")
    before = sizes.withColumn("before", F.sum("n").over(up_to) - F.col("n")).where("before > 0").select("c", "part", "before")
    inside = Window.partitionBy("c", "part").orderBy(F.asc_nulls_first("turn"), "t1", "t2")
    numbered = turns.withColumn("i", F.row_number().over(inside)).join(before, ["c", "part"], "left")
    return numbered.select("c", (F.col("i") + F.coalesce("before", F.lit(0))).cast("long").alias("p"), "t1", "t2", "bytes")


def branched(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations rebuilt as branches of one in `family`.

    turns: (c, p, t1, t2, bytes). Conversation c begins with the first h turns of c - c % family, all
    if it has fewer, none if there is no such conversation, and goes on with its own turns after its
    first h, where h is crc32 of the decimal c, modulo most + 1. Gives (c, p, t1, t2, bytes) with new
    places, and (c, depth) with the number of turns of each, 0 included.
    """
    own = turns.groupBy("c").agg(F.max("p").alias("n"))
    first = turns.where((F.col("c") % family == 0) & (F.col("p") <= most)).groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("p", "t1", "t2", "bytes"))).alias("first")
    )
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % (most + 1)).cast("int")
    convs = own.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % family).join(first, "base", "left")
    taken = F.slice(F.coalesce("first", F.array().cast("array<struct<p: long, t1: long, t2: long, bytes: long>>")), 1, F.col("h"))
    convs = stored(convs.select("c", "n", "h", taken.alias("taken")), "branches")
    sizes = convs.select("c", "h", F.size("taken").alias("k"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"))
    rest = turns.join(sizes, "c").where(F.col("p") > F.col("h"))
    rows = convs.select("c", F.inline("taken")).unionByName(
        rest.select("c", (F.col("p") - F.col("h") + F.col("k")).alias("p"), "t1", "t2", "bytes")
    )
    return rows, sizes.select("c", (F.col("k") + F.col("rest")).alias("depth"))


def _stretch(unit: int) -> Column:
    """Stretches a place is needed in: its own, and the next one if it is near its end."""
    at = F.floor((F.col("p") - 1) / (STRETCH * unit))
    near = F.col("p") > (at + 1) * STRETCH * unit - HEIGHT * unit
    return F.when(near, F.array(at, at + 1)).otherwise(F.array(at))


def _keyed(turns: DataFrame) -> DataFrame:
    """(c, p, bytes, k1, k2): the key of the node each turn leads to."""
    part = F.floor((F.col("p") - 1) / STRETCH)
    z = turns.select(
        "c", "p", "bytes", part.alias("part"), F.xxhash64("p", "t1", "t2").alias("z1"), F.xxhash64(F.lit(1), "p", "t1", "t2").alias("z2")
    )
    # Only conversations of several stretches carry something from one to the next.
    sums = z.groupBy("c", "part").agg(F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("c", "part", F.bit_xor("x1").over(earlier).alias("x1"), F.bit_xor("x2").over(earlier).alias("x2")).where("part > 0")
    up_to = Window.partitionBy("c", "part").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    runs = z.select("c", "p", "bytes", "part", F.bit_xor("z1").over(up_to).alias("r1"), F.bit_xor("z2").over(up_to).alias("r2"))
    joined = runs.join(carried, ["c", "part"], "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "c", "p", "bytes", F.col("r1").bitwiseXOR(F.coalesce("x1", zero)).alias("k1"), F.col("r2").bitwiseXOR(F.coalesce("x2", zero)).alias("k2")
    )


def _lines(turns: DataFrame, unit: int) -> DataFrame:
    """(c, p, bytes, k1, k2, line): line holds the keys of the last HEIGHT nodes at depths that `unit`
    divides, down to this one; the root, whose key is zero, is not in it."""
    own = F.floor((F.col("p") - 1) / (STRETCH * unit))
    rows = turns.where(F.col("p") % unit == 0).select("*", F.explode(_stretch(unit)).alias("part"))
    last = Window.partitionBy("c", "part").orderBy("p").rowsBetween(-(HEIGHT - 1), 0)
    lined = rows.withColumn("line", F.collect_list(F.struct(*_KEY)).over(last))
    return lined.where(F.col("part") == own).drop("part")


def _ancestors(unit: int, with_self: bool) -> Column:
    """From a node's line, as (k1, k2): the nodes of its band it is in the subtree of, itself with
    them; or, for the root of a band, those of the band above, but for that band's root."""
    level = F.floor(F.col("depth") / unit)
    if not with_self:
        return F.slice("line", 1, HEIGHT - 1)
    inside = (level % HEIGHT + 1).cast("int")
    root = F.array(F.struct(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2")))
    line = F.slice("line", F.greatest(F.size("line") - inside + 1, F.lit(1)), inside)
    return F.when(level < HEIGHT, F.concat(root, line)).otherwise(line)


def _sums(rows: DataFrame, to: Column, names: list[str]) -> DataFrame:
    spread = rows.select(F.explode(to).alias("to"), *names)
    return spread.groupBy("to.k1", "to.k2").agg(*[F.sum(n).alias(n) for n in names])


def rolled_up(nodes: DataFrame, turns: DataFrame, deepest: int, names: list[str]) -> DataFrame:
    """(k1, k2, *names): sums of the named columns over the subtree of every node, root included.

    nodes: (k1, k2, depth, *names), the root with key and depth 0; turns: (c, p, bytes, k1, k2) of
    all conversations, which say what nodes lie on a path.
    """
    empty = F.array().cast("array<struct<k1: long, k2: long>>")
    levels, unit, values = [], 1, nodes.select(*_KEY, "depth", *names)
    while True:
        paths = _lines(turns, unit).groupBy(*_KEY).agg(F.first("line").alias("line"))
        here = values.join(paths, _KEY, "left").withColumn("line", F.coalesce("line", empty))
        here = stored(here.select(*_KEY, "depth", "line", *names), "band")
        partial = stored(_sums(here, _ancestors(unit, True), names), "partial")
        levels.append((unit, here, partial))
        unit *= HEIGHT
        if deepest < unit:
            break
        depths = here.where(F.col("depth") % unit == 0).select(*_KEY, "depth")
        values = depths.join(partial, _KEY)
    # At the top there is one band, whose sums are complete.
    unit, _, total = levels.pop()
    while levels:
        unit, here, partial = levels.pop()
        roots = here.where((F.col("depth") % (unit * HEIGHT) == 0) & (F.col("depth") > 0)).select(*_KEY, "line")
        down = _sums(roots.join(total, _KEY), _ancestors(unit, False), names)
        inner = here.where(F.col("depth") % (unit * HEIGHT) != 0).select(*_KEY).join(partial, _KEY)
        inner = inner.unionByName(down).groupBy(*_KEY).agg(*[F.sum(n).alias(n) for n in names])
        total = stored(inner.unionByName(total.select(*_KEY, *names)), "total")
    return total


def _end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): digest of the ids that end at a node, ascending, comma-joined. Lists of
    any length pass in pieces through a running digest, none is held as a whole."""
    pieces = ends.groupBy(*_KEY, F.floor(F.col("c") / IDS).alias("piece")).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("c")).cast("array<string>")).alias("ids")
    )
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in range(3))):
                if (k1, k2) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (k1, k2), hashlib.sha256(ids.encode())
            if done:
                yield rows_of(schema, *zip(*done))
        if now is not None:
            yield rows_of(schema, *zip((*now, digest.hexdigest())))

    dealt = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").select(*_KEY, "ids")
    return dealt.mapInArrow(each, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of
    every node.

    turns: (c, p, t1, t2, bytes) with places p from 1 to the conversation's number of turns; convs:
    (c, depth), every conversation once with that number, also those without turns. A node is named
    by its smallest conversation and its depth. The root has all conversations and saves nothing;
    without conversations there is no node. saved_tokens are the bytes of a node's last text for
    every conversation but one, summed over its subtree, itself with it. A node that holds most of
    the conversations is counted by aggregates that combine before their shuffle.
    """
    turns = stored(_keyed(turns), "turns")
    convs = stored(convs.select("c", F.col("depth").cast("long").alias("depth")), "convs")
    zero = F.lit(0).cast("long")
    before = _lines(turns, 1).select(
        *_KEY, "c", "p", "bytes", F.coalesce(F.get("line", F.size("line") - 2), F.struct(zero.alias("k1"), zero.alias("k2"))).alias("parent")
    )
    # Every path to a node comes from the same parent and ends with the same text.
    nodes = before.groupBy(*_KEY).agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p").alias("depth"), F.min("bytes").alias("bytes"),
        F.min("parent.k1").alias("p1"), F.min("parent.k2").alias("p2"),
    )
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("depth"), zero.alias("bytes"),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    counted = stored(
        counted.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn(
            "saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")
        ),
        "counted",
    )
    deepest = counted.agg(F.max("depth")).first()[0] or 0
    totals = rolled_up(counted, turns, deepest, ["n_leaves", "saved_tokens"])
    last = turns.join(convs.select("c", F.col("depth").alias("p")), ["c", "p"]).select(*_KEY, "c")
    ends = last.unionByName(convs.where("depth = 0").select(zero.alias("k1"), zero.alias("k2"), "c"))
    none = hashlib.sha256(b"").hexdigest()
    parents = counted.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = counted.drop("n_leaves", "saved_tokens").join(totals, _KEY).join(_end_digests(ends), _KEY, "left")
    return found.join(parents, ["p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """The trie of conversations rebuilt as branches, from rows (conv_id, turn, role, text)."""
    turns = stored(placed(hashed_turns(conversations)), "placed")
    return trie(*branched(turns, family, most))
