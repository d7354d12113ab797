"""Winnowed anchors: every window of a text is put under the least hash of its grams, so equal
windows meet under one anchor wherever they are, and neighbouring windows mostly share theirs."""

from __future__ import annotations

import numpy as np
import xxhash

from tickloom.llm.arrays import gram_hashes, sliding_min

#: Symbols looked at together; places inside a section fit into PLACE_BITS.
SECTION = 8 << 20
PLACE_BITS = 24
#: A run of windows under one anchor is cut after so many, so that its text stays small.
LONGEST_RUN = 4096


def runs(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, several) of each run in consecutive texts.

    A window begins at each symbol that has `window` - 1 others of its text behind it. Each window
    is in one run: neighbours with the same anchor, the least hash of the window's grams, and of
    equal ones the first. several: the anchor's gram comes more than once, so windows of the run
    itself may be equal.
    """
    parts = []
    for at in range(0, max(1, len(symbols)), SECTION):
        piece = symbols[at : at + SECTION + window - 1]
        ends = np.unique(np.clip(offsets - at, 0, len(piece)))
        first, *rest = _section(piece, ends, window, gram)
        parts.append((first + at, *rest))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _section(symbols: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    none = np.zeros(0, np.int64)
    if len(symbols) < window:
        return none, none, none.view(np.uint64), none.astype(bool)
    hashes = gram_hashes(symbols, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    ordered = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding_min(ordered, window - gram + 1) & low).astype(np.int64)
    starts = len(place)
    # Windows that would cross the end of their text are none.
    step = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(step, np.maximum(ends[1:] - window + 1, ends[:-1]), 1)
    np.add.at(step, ends[1:], -1)
    valid = np.cumsum(step)[:starts] == 0
    changes = np.ones(starts, bool)
    changes[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(changes)
    number = np.diff(np.append(first, starts))
    anchor = hashes[place[first]]
    # Neighbouring runs of equal anchors at several places are one.
    fresh = np.ones(len(first), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (valid[first[1:]] != valid[first[:-1]])
    heads = np.flatnonzero(fresh)
    several = np.diff(np.append(heads, len(first))) > 1
    number = np.add.reduceat(number, heads) if len(heads) else number
    first, anchor = first[heads], anchor[heads]
    kept = valid[first]
    first, number, anchor, several = first[kept], number[kept], anchor[kept], several[kept]
    if len(number) and number.max() > LONGEST_RUN:
        pieces = -(-number // LONGEST_RUN)
        which = np.repeat(np.arange(len(number)), pieces)
        k = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        number = np.minimum(LONGEST_RUN, number[which] - k * LONGEST_RUN)
        first, anchor, several = first[which] + k * LONGEST_RUN, anchor[which], several[which]
    return first, number, anchor, several


def content_hashes(symbols: np.ndarray, first: np.ndarray, number: np.ndarray, window: int) -> np.ndarray:
    """64-bit hash of all symbols of each run's windows."""
    raw = memoryview(np.ascontiguousarray(symbols)).cast("B")
    width = symbols.itemsize
    digest = xxhash.xxh3_64_intdigest
    pairs = zip((first * width).tolist(), ((first + number + window - 1) * width).tolist())
    return np.fromiter((digest(raw[a:b]) for a, b in pairs), np.uint64, len(first))
