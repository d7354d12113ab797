"""Lower-cased words of a text and the stated query sets (benchmark items), dealt out in tiles."""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.anchors_join import stored

_WORD = (string.digits + string.ascii_lowercase).encode() + bytes(range(0x80, 0x100))
#: Bytes of words: digits, letters with A-Z lower-cased, and all beyond ASCII; others part words.
WORD_BYTES = bytes(c if c in _WORD else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Bytes of item texts that are held in the driver and in each task at once.
TILE_BYTES = 4 << 20


def split_words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text in order."""
    return text.translate(WORD_BYTES).split()


def tiles(items: DataFrame, id_col: str, text_col: str, most: int = TILE_BYTES) -> Iterator[list]:
    """The items as rows (item, text, copies) in tiles of about `most` bytes of text.

    Rows equal in id and text are one row with their number. Their sizes are summed up first, and
    the number of tiles is raised until none is above the bound, so what is gathered at once does
    not grow with the number of items; a longer item comes in a tile of its own. Null texts and
    texts without words have no words and are left out by who reads the tiles.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = items.select(F.col(id_col).cast("long").alias("item"), text.alias("text"))
    rows = rows.groupBy("item", "text").agg(F.count("*").alias("copies"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    size = F.octet_length("text") + 64
    total = rows.agg(F.sum(size)).first()[0] or 0
    number = max(1, -(-total // most))
    while True:
        tile = F.pmod(F.xxhash64("row"), F.lit(number))
        sizes = rows.groupBy(tile.alias("tile")).agg(F.sum(size).alias("size"), F.count("*").alias("n"))
        if number == 1 or not sizes.where((F.col("size") > 2 * most) & (F.col("n") > 1)).limit(1).collect():
            break
        number *= 2
    for k in range(number):
        found = rows.where(tile == k).select("item", "text", "copies").collect()
        if found:
            yield found
