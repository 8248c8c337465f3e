"""A wavelet matrix over token ids: one bit-plane per bit, most significant first, with rank directories.

Plane k holds bit k of the ids in the order that the planes before it produce: all ids with a 0 there first, then
those with a 1, both in their previous order. Everything - the id at a place, the count of an id before a place, the
place of its n-th occurrence - then takes one rank or select per plane.
"""

from __future__ import annotations

import numpy as np

#: Bits between two entries of a rank directory.
STEP = 512


class WaveletMatrix:
    def __init__(self, size: int, planes: list[bytes], zeros: list[int], ranks: list[bytes] | None = None):
        """``planes``: packed bits (first bit lowest); ``zeros``: zeros in each plane; ``ranks``: ones before each STEP bits."""
        self.size, self.planes, self.zeros = size, planes, zeros
        self.ranks = ranks if ranks is not None else [directory(p) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids)
        planes, zeros = [], []
        for k in range(bits - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << k)) != 0
            planes.append(np.packbits(ones, bitorder="little").tobytes())
            low = np.flatnonzero(~ones)
            zeros.append(len(low))
            ids = np.concatenate([ids.take(low), ids.take(np.flatnonzero(ones))])
        return cls(len(ids), planes, zeros)

    def _bits(self, plane: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self.planes[plane], dtype=np.uint8), count=self.size, bitorder="little").view(bool)

    def all(self) -> np.ndarray:
        """All ids in order, plane by plane from the last one."""
        wide = len(self.planes) > 16
        ids = np.zeros(self.size, dtype=np.uint32 if wide else np.uint16)
        for k in range(len(self.planes) - 1, -1, -1):
            ones, up = self._bits(k), np.empty_like(ids)
            up[np.flatnonzero(~ones)] = ids[: self.zeros[k]]
            up[np.flatnonzero(ones)] = ids[self.zeros[k] :] | ids.dtype.type(1 << (len(self.planes) - 1 - k))
            ids = up
        return ids

    def _rank(self, plane: int, at: int) -> int:
        """Ones of a plane before a place."""
        block = at // STEP
        base = int(np.frombuffer(self.ranks[plane], dtype=np.uint32, count=1, offset=4 * block)[0])
        start, rest = block * STEP // 8, at - block * STEP
        word = np.frombuffer(self.planes[plane][start : start + (rest + 7) // 8], dtype=np.uint8)
        return base + int(np.unpackbits(word, count=rest, bitorder="little").sum()) if rest else base

    def access(self, at: int) -> int:
        value = 0
        for k in range(len(self.planes)):
            before = self._rank(k, at)
            one = self._rank(k, at + 1) - before
            value = value << 1 | one
            at = self.zeros[k] + before if one else at - before
        return value

    def _narrow(self, token: int, start: int, end: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self._rank(k, start), self._rank(k, end)
            one = token >> (len(self.planes) - 1 - k) & 1
            start, end = (self.zeros[k] + a, self.zeros[k] + b) if one else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id in [start, end)."""
        if token >> len(self.planes):
            return 0
        a, b = self._narrow(token, start, self.size if end is None else end)
        return b - a

    def select(self, token: int, nth: int) -> int | None:
        """The place of the nth (from 0) occurrence of an id."""
        if nth < 0 or nth >= self.count(token):
            return None
        at = self._narrow(token, 0, self.size)[0] + nth
        for k in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - k) & 1
            at = self._select(k, at - self.zeros[k], True) if one else self._select(k, at, False)
        return at

    def places(self, token: int) -> np.ndarray:
        """All places of an id, ascending: its stretch behind the last plane, carried up plane by plane."""
        if token < 0 or token >> len(self.planes):
            return np.zeros(0, dtype=np.int64)
        at = np.arange(*self._narrow(token, 0, self.size))
        for k in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            one = token >> (len(self.planes) - 1 - k) & 1
            at = np.flatnonzero(self._bits(k) == one)[at - self.zeros[k] if one else at]
        return at

    def _select(self, plane: int, nth: int, one: bool) -> int:
        ones = np.frombuffer(self.ranks[plane], dtype=np.uint32).astype(np.int64)
        before = ones if one else np.arange(len(ones)) * STEP - ones
        block = int(np.searchsorted(before, nth, side="right")) - 1
        start = block * STEP
        word = np.frombuffer(self.planes[plane][start // 8 : (start + STEP) // 8], dtype=np.uint8)
        bits = np.unpackbits(word, count=min(STEP, self.size - start), bitorder="little")
        return start + int(np.flatnonzero(bits == one)[nth - before[block]])


def directory(plane: bytes) -> bytes:
    """Ones before every STEP-th bit."""
    counts = np.bitwise_count(np.frombuffer(plane, dtype=np.uint8)).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    return total[:: STEP // 8].astype(np.uint32).tobytes()
