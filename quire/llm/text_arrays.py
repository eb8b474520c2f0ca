"""Words of an Arrow string column as flat arrays, without Python strings.

Works on the UTF-8 bytes: the word separators are ASCII, so byte runs and
character runs agree.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit values, the same everywhere."""
    base = (np.uint64(seed) << np.uint64(40)) + np.arange(1, n + 1, dtype=np.uint64)
    return mix64(base * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BYTE = randoms(256, 1)


#: Bytes of text for which a worker builds its arrays at a time; some 40 to 90 times as
#: much memory, in each of an executor's workers.
FEW_BYTES = 128 << 10


class Words(NamedTuple):
    data: np.ndarray      # bytes of all texts
    offsets: np.ndarray   # where each text starts; one more than texts
    start: np.ndarray     # of each word
    length: np.ndarray
    doc: np.ndarray       # text of each word
    hash: np.ndarray      # 64 bits of each word


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; null counts as empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[
        column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(column, lower: bool = True) -> Words:
    data, offsets = raw(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SEP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    start = np.flatnonzero(first)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, none, np.zeros(0, np.uint64))
    run = np.flatnonzero(inside)
    at = np.searchsorted(run, start)        # of each word among the word bytes
    length = np.diff(np.append(at, len(run)))
    place = np.arange(len(run)) - np.repeat(at, length)
    power = randoms(int(length.max()), 2)
    h = mix64(np.add.reduceat(_BYTE[data[run]] * power[place], at) + length.astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, start, length, doc, h)


def slices(batch, text: str, most_bytes: int = 512 << 10):
    """The batch in runs of rows of about ``most_bytes`` of text; a longer
    text is a run of its own, whole."""
    _, offsets = raw(batch.column(batch.schema.get_field_index(text)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, "right")) - 1)
        j = min(j, n)
        yield batch.slice(i, j - i)
        i = j
