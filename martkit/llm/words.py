"""Words of whole Arrow columns as numbers, cut byte by byte in NumPy. All separators are ASCII, so UTF-8 stays whole."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """All words of a column, one text after the other, A-Z in lower case."""

    distinct: pa.Array
    codes: np.ndarray  # of each word, its place in distinct
    texts: np.ndarray  # of each word, the row of its text
    pieces: np.ndarray  # of each word, a number that changes at every stop and every text


def split_words(texts: pa.Array, spaces: bytes, stops: bytes = b"") -> Words:
    """Words are what stands between bytes of spaces and stops. texts has no nulls."""
    texts = texts.cast(pa.string())
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    whole = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(whole, np.uint8)[bounds[0] : bounds[-1]] if whole is not None and whole.size else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    kinds = np.zeros(256, np.uint8)
    kinds[list(spaces)] = 1
    kinds[list(stops)] = 2
    kind = kinds[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opening = bounds[:-1][bounds[:-1] < len(data)]
    first[opening] = inside[opening]
    starts = np.flatnonzero(first)
    rank = np.cumsum(inside, dtype=np.int32)
    total = int(rank[-1]) if len(rank) else 0
    offsets = np.append(rank[starts] - 1, total).astype(np.int32)
    letters = _LOWER[data[inside]]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    rows = np.searchsorted(bounds[1:], starts, "right")
    pieces = rows + np.cumsum(kind == 2, dtype=np.int64)[starts] if stops else rows
    return Words(words.dictionary, words.indices.to_numpy().astype(np.int64), rows, pieces)
