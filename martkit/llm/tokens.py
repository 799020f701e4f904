"""Token ids of whole texts from ids of their space-separated pieces, looked up for whole Arrow columns at once.

Both byte-level vocabularies split a text at least wherever a space that follows a non-space character comes
before another one, and merges never cross such a place. So a text is cut there, each distinct piece is
encoded once per worker, and the ids of all texts are gathered from one flat array. Texts in which a space
touches other white space are cut by a pattern that keeps runs of white space with what follows them.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Every character with the Unicode property White_Space.
SPACES = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
TOUCHING = f"[{SPACES}] | [{SPACES}]"


@contextmanager
def _no_collection() -> Iterator[None]:
    """Without searches for cycles, of which lists of ids have none: they'd look at all lists that are held, again and again."""
    running = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if running:
            gc.enable()


def gather(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces ``flat[offset : offset + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(offsets - (ends - lengths), lengths)
    places += np.arange(total)
    return flat[places]


class Pieces:
    """Variable-length rows in one flat array that grows."""

    def __init__(self, dtype):
        self.flat, self.used = np.empty(1 << 16, dtype), 0
        self.offsets, self.lengths, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def append(self, row: Sequence[int] | np.ndarray) -> int:
        n = len(row)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        if self.count == len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.empty_like(self.offsets)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.flat[self.used : self.used + n] = row
        self.offsets[self.count], self.lengths[self.count] = self.used, n
        self.used += n
        self.count += 1
        return self.count - 1

    def extend(self, rows: Sequence[Sequence[int]]) -> range:
        """Append many rows at once; their numbers."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        total, first = int(lengths.sum()), self.count
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(rows) > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.empty_like(self.offsets)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(rows), self.flat.dtype, total)
        self.offsets[first : first + len(rows)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(rows)] = lengths
        self.used += total
        self.count += len(rows)
        return range(first, self.count)

    def rows(self, which: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.offsets[which], self.lengths[which])


class TextEncoder:
    """``encode_units`` maps distinct units to their ids; the results of ``most`` units are held at most."""

    def __init__(self, encode_units: Callable[[list[str]], list[Sequence[int]]], most: int = 1_000_000):
        self.encode_units, self.most = encode_units, most
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered."""
        self.slots: dict[str, int] = {}
        self.pieces = Pieces(np.uint32)

    def _lookup(self, units: list[str]) -> np.ndarray:
        found = list(map(self.slots.get, units))
        if None in found:
            missing = list(dict.fromkeys([u for u, slot in zip(units, found, strict=True) if slot is None]))
            with _no_collection():
                self.slots.update(zip(missing, self.pieces.extend(self.encode_units(missing)), strict=True))
            found = list(map(self.slots.__getitem__, units))
        return np.array(found, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column without nulls, and the number of ids of each text."""
        if len(self.slots) > self.most or self.pieces.used > 16 * self.most:
            self.forget()
        uneven = pc.match_substring_regex(texts, TOUCHING).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(pc.if_else(pa.array(~uneven), texts, ""), " ")
        ends = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        spaced = self._lookup([" " + w for w in words.dictionary.to_pylist()])
        slots = spaced[words.indices.to_numpy()] if len(spaced) else np.empty(0, np.int64)
        slots[ends[:-1] - ends[0]] = self._lookup(pc.list_element(parts, 0).to_pylist())
        counts = np.diff(ends)
        if uneven.any():
            rows = np.split(slots, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(uneven):
                rows[i] = self._lookup(UNIT.findall(texts[i].as_py()))
            slots, counts = np.concatenate(rows), np.array([len(r) for r in rows])
        lengths = np.concatenate([[0], np.cumsum(self.pieces.lengths[slots])])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return self.pieces.rows(slots), np.diff(lengths[bounds])
