"""Words of Arrow text columns, split on bytes without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LETTER, SPACE, BREAK = 0, 1, 2
SLICE_BYTES = 8 << 20  # texts handled at a time, in bytes; a longer text is a slice of its own


class Tokens(NamedTuple):
    words: pa.Array  # every word, in order
    codes: np.ndarray  # int64 number of every word in ``distinct``
    distinct: pa.Array
    doc: np.ndarray  # row of every word
    joined: np.ndarray  # whether a word and the next one stand in the same piece of the same row


def kinds(space: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: part of a word, a space between words, or the end of a piece."""
    table = np.full(256, LETTER, np.uint8)
    table[list(space)] = SPACE
    table[list(breaks)] = BREAK
    return table


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive parts of a text column with at most ``most`` bytes, one row at least."""
    offsets = _offsets(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, column.slice(at, end - at)
        at = end


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)


def tokenise(column: pa.Array, table: np.ndarray, fold: np.ndarray | None = None) -> Tokens:
    """Words are stretches of bytes of kind LETTER within a row; null and empty rows have none.

    Separators are single bytes below 128, so words of UTF-8 text are UTF-8 again. ``fold`` maps bytes of words.
    """
    offsets = _offsets(column)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]: offsets[-1]] if body is not None else np.empty(0, np.uint8)
    starts = offsets[:-1] - offsets[0]
    kind = table[data]
    letter = kind == LETTER
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inside = starts[starts < len(data)]
    begins[inside] = letter[inside]
    first = np.flatnonzero(begins)
    before = np.cumsum(letter) - letter  # bytes of words before each byte
    text = data[letter]
    ends = np.append(before[first], len(text)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(ends), pa.py_buffer(text if fold is None else fold[text]))
    doc = np.searchsorted(starts, first, side="right") - 1
    piece = np.cumsum(kind == BREAK)[first]
    joined = np.zeros(len(first), bool)
    joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Tokens(words, codes, coded.dictionary, doc, joined)
