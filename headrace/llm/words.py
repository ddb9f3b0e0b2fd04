"""Words of whole Arrow text columns as numpy arrays, without a Python loop over words.

The texts of a slice lie one behind the other in one byte buffer. A word is a run of word
bytes inside one text. Its 64-bit value is folded from its (lower-cased) bytes, eight at a
time; two different words share a value with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# An odd multiplier and the mixing constants of splitmix64.
BASE = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB

SLICE_BYTES = 1 << 20


def _fold(is_word) -> np.ndarray:
    """For each byte, 0 outside words, else the byte with A-Z lower-cased."""
    table = np.zeros(256, np.uint8)
    for byte in range(256):
        lower = byte + 32 if 0x41 <= byte <= 0x5A else byte
        if is_word(lower):
            table[byte] = lower or 0xFF  # 0xFF never occurs in UTF-8, so it can stand for NUL
    return table


# Words between white space; words of letters, digits and everything beyond ASCII.
SPACED = _fold(lambda b: b not in (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))
ALNUM = _fold(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)

_INVERSE = pow(BASE, -1, 1 << 64)


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base², … modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit values over all bits."""
    z = values + np.uint64(BASE)
    z ^= z >> np.uint64(30)
    z *= np.uint64(MIX_1)
    z ^= z >> np.uint64(27)
    z *= np.uint64(MIX_2)
    z ^= z >> np.uint64(31)
    return z


def runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value of each run ``values[start:end]``, the same wherever the run lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(BASE, len(values)), out=sums[1:], dtype=np.uint64)
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(values) + 1)[starts])


def _values(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The value of each byte run, taken eight bytes at a time."""
    padded = np.concatenate([folded, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(folded) + 1, "<u8", padded.data, strides=(1,))
    size = end - start
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    value = mix((eights[start] & keep[np.minimum(size, 8)]) + size.astype(np.uint64))
    rest, done = np.flatnonzero(size > 8), 8
    while len(rest):
        left = size[rest] - done
        chunk = eights[start[rest] + done] & keep[np.minimum(left, 8)]
        value[rest] = mix(value[rest] ^ chunk)
        rest, done = rest[left > 8], done + 8
    return value


@dataclass
class Words:
    """Words of consecutive texts. ``first[i]:first[i+1]`` are the words of text ``i``."""

    raw: np.ndarray  # bytes of all texts
    at: np.ndarray  # where each text begins in them, and the end
    start: np.ndarray  # of each word, in bytes
    end: np.ndarray
    first: np.ndarray
    value: np.ndarray  # 64-bit value of each word


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def buffers_of_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and the offsets of its values."""
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(column: pa.Array, fold: np.ndarray) -> Words:
    raw, at = buffers(column)
    folded = fold[raw]
    inside = folded != 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    start, end = edge[0::2], edge[1::2]
    # A word that runs on from one text into the next is cut where the next begins.
    cut = np.unique(at[1:-1])
    cut = cut[(cut > 0) & (cut < len(raw))]
    cut = cut[inside[cut] & inside[cut - 1]]
    if len(cut):
        start = np.sort(np.concatenate([start, cut]))
        end = np.sort(np.concatenate([end, cut]))
    return Words(raw, at, start, end, np.searchsorted(start, at), _values(folded, start, end))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text; no row is cut."""
    at = buffers(batch.column(batch.schema.get_field_index(text)))[1]
    part = at[:-1] // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def char_offsets(raw: np.ndarray) -> np.ndarray:
    """For each byte position, the code points before it."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out
