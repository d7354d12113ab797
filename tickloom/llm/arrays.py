"""Small helpers between Arrow batches and numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null gives none."""
    for piece in column.cast(pa.large_binary()):
        value = piece.as_py()
        yield b"" if value is None else value


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its texts in them, without a copy per text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held, offsets


def text_parts(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of consecutive rows with about `most` bytes; a longer
    text comes alone."""
    held, offsets = text_buffer(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, held[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def rows_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch with the given columns, cast to the schema."""
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that near values are spread out."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def gram_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the `size` symbols (uint64) from each position on, by joining halves.

    Windows are put together from windows of half their length, so the work is a few passes per
    doubling and does not depend on `size` otherwise.
    """
    n = len(symbols) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, total_size, power, power_size = None, 0, symbols, 1
    left = size
    while left:
        if left & 1:
            if total is None:
                total = power
            else:
                m = len(power) - total_size
                total = _join(total[:m], power[total_size : total_size + m], power_size)
            total_size += power_size
        left >>= 1
        if left:
            m = len(power) - power_size
            power = _join(power[:m], power[power_size:], power_size)
            power_size *= 2
    return mix64(total[:n])


def _join(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    factor = np.uint64((0x9E3779B97F4A7C15 * (2 * size + 1)) & 0xFFFFFFFFFFFFFFFF | 1)
    joined = first * factor
    joined ^= joined >> np.uint64(29)
    joined += second
    joined *= np.uint64(0xBF58476D1CE4E5B9)
    joined ^= joined >> np.uint64(32)
    return joined


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:n], values[rest : rest + n])


def contract_batches(pairs, contract, most: int = 500_000):
    """Links gathered until there are `most` of them, then contracted; what is left comes last."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for a, b in pairs:
        kept.append((a, b))
        held += len(a)
        if held > most:
            kept = [contract(np.concatenate([x for x, _ in kept]), np.concatenate([y for _, y in kept]))]
            held = len(kept[0][0])
            if held > most // 2:
                yield kept.pop()
                held = 0
    if kept:
        yield contract(np.concatenate([x for x, _ in kept]), np.concatenate([y for _, y in kept]))
