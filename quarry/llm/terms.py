"""Exact terms of Arrow text columns.

A term is a maximal run of bytes of a class, after A-Z are lower-cased. Other bytes
become spaces, and Arrow cuts and numbers the terms; they are compared as
strings, never by a hash alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm.textops import text_buffers


def byte_table(digits: bool) -> np.ndarray:
    """Lower-cased byte for each byte of a term (letters, bytes beyond ASCII, and digits if wanted), else a space."""
    codes = np.arange(256)
    out = np.full(256, 0x20)
    upper = (codes >= 0x41) & (codes <= 0x5A)
    own = upper | ((codes >= 0x61) & (codes <= 0x7A)) | (codes >= 0x80)
    if digits:
        own |= (codes >= 0x30) & (codes <= 0x39)
    out[own] = np.where(upper, codes + 32, codes)[own]
    return out.astype(np.uint8)


def numbered_terms(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each term, its number, distinct terms by number) in order; null texts have none."""
    data, offsets = text_buffers(column)
    large = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(table[data].tobytes()))
    cut = pc.ascii_split_whitespace(large)
    ends = cut.offsets.to_numpy().astype(np.int64)
    coded = cut.values.dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)[ends[0]:ends[-1]]
    rows = np.repeat(np.arange(len(column)), np.diff(ends))
    terms = coded.dictionary
    blank = pc.equal(terms, "").to_numpy(zero_copy_only=False)
    if blank.any():  # ends of a text that are no term
        keep = ~blank[numbers]
        rows, numbers = rows[keep], numbers[keep]
    return rows, numbers, terms


def counted(rows: np.ndarray, numbers: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, occurrences) of each distinct pair, by row; ``width`` is beyond all numbers."""
    keys, n = np.unique(rows * max(1, width) + numbers, return_counts=True)
    return keys // max(1, width), keys % max(1, width), n
