"""Word and shingle hashing over Arrow text columns.

A word is a maximal run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are
lower-cased: digits, ASCII letters and every character beyond ASCII. In UTF-8
that is a property of single bytes, so whole column slices are cut into words
and hashed with numpy, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64

ROWS_A_BATCH = 1000


def bounded_batches(spark) -> None:
    """Hand texts to Python workers in batches of ``ROWS_A_BATCH``, unless the session asks for fewer.

    The default of 10,000 rows is made for narrow rows; with whole texts a batch
    would be most of a worker's memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_A_BATCH:
        spark.conf.set(key, str(ROWS_A_BATCH))
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, 64-bit value of the lower-cased byte) for all 256 bytes."""
    codes = np.arange(256)
    digit = (codes >= 0x30) & (codes <= 0x39)
    upper = (codes >= 0x41) & (codes <= 0x5A)
    lower = (codes >= 0x61) & (codes <= 0x7A)
    word = digit | upper | lower | (codes >= 0x80)
    value = mix(np.where(upper, codes + 32, codes).astype(_U) + _U(1))
    return word, value


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    with np.errstate(over="ignore"):
        h = h + _U(0x9E3779B97F4A7C15)
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


_WORD, _VALUE = _byte_tables()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.r_[_U(1), np.full(size - 1, b, _U)]) for b in (_U(_BASE), _U(_BASE_INV))]
    return _POWERS[0], _POWERS[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, max_bytes: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` text bytes, or one row that is longer."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit word hashes in order, number of words before each row and in all).

    ``data`` holds the rows' bytes, ``offsets`` the rows' places in it; words
    never join across rows.
    """
    return placed_words(data, offsets)[:2]


def placed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`words`, and the first byte and the byte after the last of each word."""
    n = len(data)
    rows = len(offsets) - 1
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), np.zeros(rows + 1, np.int64), none, none
    inside = _WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    starts[first] = inside[first]
    ends[last] = inside[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    hashes = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U))
    return hashes, np.searchsorted(s, offsets).astype(np.int64), s, e


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, by the run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for k in range(size):
        out = out * _U(_BASE) + hashes[k:k + n]
    return mix(out + _U(size))


def word_shingles(hashes: np.ndarray, before: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row: runs of ``size`` words.

    A row of fewer words, but not none, has one shingle of all its words; a row
    without words has none.
    """
    every = runs(hashes, size)
    for a, b in zip(before[:-1], before[1:], strict=True):
        if b - a >= size:
            yield np.unique(every[a:b - size + 1])
        elif b > a:
            yield runs(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, _U)


def row_words(text: str | None) -> np.ndarray:
    """Word hashes of one text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    return words(raw, np.array([0, len(raw)], np.int64))[0]


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the rows' lengths."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
