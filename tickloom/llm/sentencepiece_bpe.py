"""Operator 2: SentencePiece encoding and decoding of merge-type models by backtracking."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import rows_of

SPACE = "▁"  # how the models write a space
#: Units kept by a worker with their ids; a full store starts anew, which changes no result.
KEPT_UNITS = 250_000


class PieceCodec:
    """Exact encoder and decoder for a model file of merge type with byte fallback.

    A token sequence is what merging gives exactly if every two adjacent tokens are what merging
    gives for their joint text. The encoder takes the longest piece at each place, found by one
    Aho-Corasick pass, falls back to its next shorter prefix while it does not fit to the token
    before, and steps back where nothing fits; a bit field remembers places known to fail, so each
    is tried once. Spaces begin units: no piece has a space after another character (checked on
    loading), so units are encoded on their own and remembered.
    """

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.normalize("  é  ") != SPACE + " " + SPACE + "é" + SPACE * 2:
            raise ValueError("the model rewrites texts; only identity models are supported")
        self.end = model.eos_id()
        count = model.get_piece_size()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.pieces: list[str] = [""] * count
        self.raw: list[bytes] = [b""] * count
        self.byte_ids = [0] * 256
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif model.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.pieces[i] = piece
                self.raw[i] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has a space after another character")
        self.is_byte = set(self.byte_ids)
        # No piece has these characters, so nothing merges over them and they are units themselves.
        apart = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        alone = f"|[{apart}]" if apart else ""
        self.unit_pattern = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+{alone}")
        self.shorter = [-1] * count
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
        self.length = [len(p) for p in self.pieces]
        self.names = [str(i) for i in range(count)]
        self.quads = [int(i).to_bytes(4, "little") for i in range(count)]
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matcher.add_word(piece, (len(piece) - 1, i))
        self.matcher.make_automaton()
        self._fits: dict[int, bool] = {}
        self._units: dict[str, tuple[str, int, bytes]] = {}
        self._quads: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: the best score first, the leftmost among equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                joined = parts[left] + parts[right]
                if joined in self.score:
                    heapq.heappush(heap, (-self.score[joined], left, parts[left], parts[right]))

        for k in range(len(parts) - 1):
            offer(k)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if parts[left] != a or right >= len(parts) or parts[right] != b:
                continue
            parts[left], parts[right] = a + b, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in parts if p is not None]

    def fits(self, first: int, second: int) -> bool:
        """Whether merging the joint text of two tokens gives these two."""
        key = first << 20 | second
        known = self._fits.get(key)
        if known is None:
            a, b = self.pieces[first], self.pieces[second]
            known = self._fits[key] = self.merged(a + b) == [a, b]
        return known

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a text without a space behind another character."""
        if unit in self.ids:  # a whole piece need not be what merging gives, so it is checked
            if self.merged(unit) == [unit]:
                return [self.ids[unit]]
        longest = [-1] * len(unit)
        for end, (reach, i) in self.matcher.iter(unit):
            longest[end - reach] = i  # ends grow, so the last one is the longest
        if -1 not in longest:
            return self._backtrack(unit, longest, 0, len(unit))
        out: list[int] = []
        start = 0
        for stop in [*(k for k, i in enumerate(longest) if i < 0), len(unit)]:
            # Characters that begin no piece are no piece either: nothing merges over them.
            out += self._backtrack(unit, longest, start, stop)
            if stop < len(unit):
                out += [self.byte_ids[b] for b in unit[stop].encode()]
            start = stop + 1
        return out

    def _backtrack(self, unit: str, longest: list[int], start: int, stop: int) -> list[int]:
        failed = 0  # bit k: no fitting rest from place start + k, whatever came before
        tokens: list[int] = []
        at, before = start, -1
        token = longest[at] if at < stop else -1
        fits, known, shorter, length = self.fits, self._fits, self.shorter, self.length
        while at < stop:
            while token >= 0:
                end = at + length[token]
                if end <= stop and not (failed and failed >> (end - start) & 1):
                    if before < 0:
                        break
                    fit = known.get(before << 20 | token)
                    if fits(before, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at, before = end, token
                if at < stop:
                    token = longest[at]
            else:
                failed |= 1 << (at - start)
                if not tokens:
                    raise AssertionError(f"no encoding of {unit!r}")
                last = tokens.pop()
                at -= length[last]
                before = tokens[-1] if tokens else -1
                token = shorter[last]
        return tokens

    def units(self, text: str) -> list[str]:
        """The text with its first space, spaces marked, cut where nothing merges over."""
        return self.unit_pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """All ids of a text, the end id last."""
        return [i for unit in self.units(text) for i in self.encode_unit(unit)] + [self.end]

    def encode_array(self, text: str) -> np.ndarray:
        """All ids of a text, the end id last, from remembered units."""
        parts, known = [], self._quads
        for unit in self.units(text):
            part = known.get(unit)
            if part is None:
                if len(known) >= KEPT_UNITS:
                    known.clear()
                part = b"".join([self.quads[i] for i in self.encode_unit(unit)])
                if len(unit) <= 64:
                    known[unit] = part
            parts.append(part)
        return np.frombuffer(b"".join([*parts, self.quads[self.end]]), "<i4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, byte tokens put together, the first space removed.

        Bytes that are no UTF-8 become one replacement character each.
        """
        out: list[str] = []
        held = bytearray()

        def release() -> None:
            at = 0
            while at < len(held):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(held[at : at + width]).decode())
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            held.clear()

        first = True
        for i in ids:
            if i in self.is_byte:
                held += self.raw[i]
                first = False
                continue
            release()
            text = self.raw[i].decode()
            if first and text:
                text = text.removeprefix(" ") if self.pieces[i] else text
                first = False
            out.append(text)
        release()
        return "".join(out)

    def unit(self, unit: str) -> tuple[str, int, bytes]:
        """(ids as "12 34 ", number of ids, decoded bytes) of a unit, which is then remembered."""
        if len(self._units) >= KEPT_UNITS:
            self._units.clear()
        if len(self._fits) >= 4 * KEPT_UNITS:
            self._fits.clear()
        ids = self.encode_unit(unit)
        names, raw = self.names, self.raw
        made = (" ".join([names[i] for i in ids]) + " ", len(ids), b"".join([raw[i] for i in ids]))
        if len(unit) <= 64:
            self._units[unit] = made
        return made

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
        known, unit = self._units.get, self.unit
        found = [known(u) or unit(u) for u in self.units(text)]
        told, counts, raw = zip(*found) if found else ((), (), ())
        ids = hashlib.sha256("".join(told).encode())
        ids.update(self.names[self.end].encode())
        # Encoded units are whole characters, so their bytes are the decoded text but for the first space.
        decoded = b"".join(raw)
        return sum(counts) + 1, ids.hexdigest(), hashlib.sha256(decoded[1:]).hexdigest()


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The codec of a model file, loaded once in each worker."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text, end id last; a null text gives the end id alone."""
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(model_file)
        for batch in batches:
            yield rows_of(schema, batch.column(0), [made.encode_array(t.as_py() or "") for t in batch.column(1)])

    return _picked(docs, id_col, text_col).mapInArrow(each, "id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(id, text): the text of rows (id, ids); null ids give an empty text."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(model_file)
        for batch in batches:
            yield rows_of(schema, batch.column(0), [made.decode(i or []) for i in batch.column(1).to_pylist()])

    return encoded.select("id", "ids").mapInArrow(each, "id long, text string")


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, in one pass without a shuffle.

    The digests are those of `encode` and of `decode` on its ids. A null text counts as empty: one
    id, the end. Every row is treated on its own, so nulls in the id and repeated rows are kept.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(model_file)
        for batch in batches:
            found = [made.digest(t.as_py() or "") for t in batch.column(1)]
            yield rows_of(schema, batch.column(0), *([f[k] for f in found] for k in range(3)))

    kinds = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _picked(docs, id_col, text_col).mapInArrow(each, kinds)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
