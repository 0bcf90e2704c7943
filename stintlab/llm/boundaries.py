"""A compressed set of the places where a text may be cut, with selection by rank.

Places are code-point offsets. As in Roaring bitmaps, those that share all but their low 16 bits
form a container, which is kept in the smallest of three forms: a sorted array of low parts, a
bitmap of 65,536 bits, or runs (first, last) of consecutive places. The number of places before
each container is kept beside them. The place of rank k is found by searching those numbers for
its container and selecting inside that one: by index in an array, by the places before
each run, or by the set bits before each word of a bitmap.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ARRAY, BITMAP, RUNS = "array", "bitmap", "runs"
SPAN = 1 << 16
_BITMAP_BYTES = SPAN // 8


@dataclass
class Container:
    """The places ``high * 65536 + low`` of one ``high``, by their low parts."""

    high: int
    kind: str
    data: np.ndarray
    size: int

    @classmethod
    def of(cls, high: int, low: np.ndarray) -> Container:
        """The smallest form of the sorted, distinct ``low`` parts."""
        size = len(low)
        firsts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        bytes_of = {ARRAY: 2 * size, BITMAP: _BITMAP_BYTES, RUNS: 4 * len(firsts)}
        kind = min(bytes_of, key=bytes_of.__getitem__)
        if kind == ARRAY:
            data = low.astype(np.uint16)
        elif kind == BITMAP:
            bits = np.zeros(SPAN, np.uint8)
            bits[low] = 1
            data = np.packbits(bits, bitorder="little").view(np.uint64)
        else:
            lasts = np.append(firsts[1:], size) - 1
            data = np.stack([low[firsts], low[lasts]], axis=1).astype(np.uint16)
        return cls(high, kind, data, size)

    def select(self, rank: int) -> int:
        """The place of which ``rank`` others of the container come first."""
        base = self.high * SPAN
        if self.kind == ARRAY:
            return base + int(self.data[rank])
        if self.kind == RUNS:
            runs = self.data.astype(np.int64)
            upto = np.cumsum(runs[:, 1] - runs[:, 0] + 1)
            run = int(np.searchsorted(upto, rank, side="right"))
            return base + int(runs[run, 1] - (upto[run] - 1 - rank))
        upto = np.cumsum(np.bitwise_count(self.data).astype(np.int64))
        word = int(np.searchsorted(upto, rank, side="right"))
        before = int(upto[word - 1]) if word else 0
        bits = np.unpackbits(self.data[word : word + 1].view(np.uint8), bitorder="little")
        return base + 64 * word + int(np.flatnonzero(bits)[rank - before])


class Boundaries:
    """The places where a text may be cut: its start and the end of every unit.

    A unit is a line with its line end; what follows the last line end is one too. A text of n
    units has n + 1 places, and an empty text has its start alone.
    """

    def __init__(self, containers: list[Container]):
        self.containers = containers
        self.upto = np.cumsum([c.size for c in containers])

    @classmethod
    def of(cls, text: str) -> Boundaries:
        """Reads the text one container's span at a time, so a long text takes no more memory."""
        found = []
        for high in range(len(text) // SPAN + 1):
            start = high * SPAN
            # A place lies behind the line end that makes it.
            part = text[max(0, start - 1) : start + SPAN - 1].encode("utf-32-le")
            low = np.flatnonzero(np.frombuffer(part, "<u4") == 10) + (1 if high == 0 else 0)
            if high == 0:
                low = np.append(0, low)
            if high == len(text) // SPAN and not text.endswith("\n") and text:
                low = np.append(low, len(text) - start)
            if len(low):
                found.append(Container.of(high, low))
        return cls(found)

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, rank: int) -> int:
        """The place of which ``rank`` others come first."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        which = int(np.searchsorted(self.upto, rank, side="right"))
        before = int(self.upto[which - 1]) if which else 0
        return self.containers[which].select(rank - before)
