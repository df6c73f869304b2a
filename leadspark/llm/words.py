"""Words of whole texts as numpy arrays, for tasks that run on Arrow batches.

A text's words are its longest runs of bytes other than space and 0x09-0x0D. Every word gets a 64-bit hash; a
run of n words gets the hash of its word hashes. No text is cut: a run never reaches into the next text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_BYTE_BASE = _U(0xD6E8FEB86659FD93)
_BYTE_INVERSE = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
#: Texts are worked on in pieces of about so many bytes, to bound the arrays.
PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: All of ASCII but letters and digits, for words free of punctuation.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each value over all bits; one-to-one."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _MUL)
_FOLDED = np.arange(256)
_FOLDED[65:91] += 32
_BYTE_CODE_FOLDED = _BYTE_CODE[_FOLDED]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > PIECE_BYTES:
        return _make_powers(n)
    if 0 not in _powers:
        _powers[0] = _make_powers(PIECE_BYTES)
    up, down = _powers[0]
    return up[:n], down[:n]


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BYTE_BASE, _BYTE_INVERSE):
        steps = np.full(n, base, _U)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@dataclass
class Words:
    """The words of some texts, in order. ``row`` is the text's number, ``at`` and ``end`` are byte offsets in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    at: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)``; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type) and not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(table, column: str = "text") -> Iterator:
    """Consecutive rows of a batch or table, about ``PIECE_BYTES`` of text at a time, one row at least."""
    if isinstance(table, pa.Table):
        table = table.combine_chunks()
    lengths = pa.compute.fill_null(pa.compute.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE_BYTES, "right")))
        yield table.slice(at, to - at)
        at = to


def words_of(texts: pa.Array, fold: bool = False, gaps: np.ndarray = SPACE) -> Words:
    """``fold`` hashes A-Z as a-z; all other bytes count as they are. ``gaps`` says which bytes part words."""
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, none, np.zeros(0, _U))
    gap = gaps[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], gap[:-1])) | edge[:-1]
    after = np.concatenate((gap[1:], [True])) | edge[1:]
    at = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    up, down = _power_tables(n)
    code = (_BYTE_CODE_FOLDED if fold else _BYTE_CODE)[data]
    code *= up
    total = np.zeros(n + 1, _U)
    np.cumsum(code, out=total[1:])
    hashed = mix((total[end] - total[at]) * down[at] + (end - at).astype(_U) * _MUL)
    row = np.searchsorted(offsets, at, "right") - 1
    return Words(data, offsets, row, at, end, hashed)


def _joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    n = len(b) - shift
    if n <= 0:
        return np.zeros(0, _U)
    return mix(a[:n] * _U(0xBF58476D1CE4E5B9) + (b[shift:] ^ _MUL) * _U(0x94D049BB133111EB))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n values from each place on, as far as n are left; ``whole`` says which stay within a text."""
    out, done, power, size = None, 0, hashes, 1
    while size <= n:
        if n & size:
            out, done = (power, size) if out is None else (_joined(out, power, done), done + size)
        if 2 * size <= n:
            power = _joined(power, power, size)
        size *= 2
    return out


def whole(row: np.ndarray, n: int) -> np.ndarray:
    """Which runs of n words lie in one text."""
    return row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, bool)


def covered(places: np.ndarray, n: int, size: int) -> np.ndarray:
    """Of ``size`` words, those within n words from one of the places on."""
    change = np.zeros(size + n + 1, np.int32)
    np.add.at(change, places, 1)
    np.add.at(change, places + n, -1)
    return np.cumsum(change)[:size] > 0


def parities(values: np.ndarray, begins: np.ndarray, n: int) -> list[np.ndarray]:
    """``n`` words (a power of two) of 64 parities for each set, of its values by hash; a set's values begin at each of ``begins``.

    Two sets' words differ in no more bits than the sets in values.
    """
    place = mix(values) >> _U(65 - (64 * n).bit_length())
    bit, word = _U(1) << (place & _U(63)), place >> _U(6)
    return [np.bitwise_xor.reduceat(np.where(word == w, bit, _U(0)), begins).view(np.int64) if len(begins) else np.zeros(0, np.int64) for w in range(n)]
