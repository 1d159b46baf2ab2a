"""A wavelet matrix over token ids: one bit-plane per bit of an id, with a rank directory per plane.

Planes are ordered from the highest bit down.  Below each plane the ids are partitioned stably, zeros
first, so that a position is followed from plane to plane by rank alone.  Access, counting and looking
up occurrences take one step per plane; the whole sequence is decoded from the last plane upwards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits between two entries of a rank directory.
BLOCK = 512
#: Ids moved at once, so that what they need stays in the CPU's cache.
RUN = 1 << 17


def ones_before_blocks(plane: np.ndarray) -> np.ndarray:
    """Ones before every block of a packed plane, and in all of it at the end."""
    counts = np.bitwise_count(plane)
    padded = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint32)
    padded[:len(plane)] = counts
    return np.concatenate([[0], np.cumsum(padded.reshape(-1, BLOCK // 8).sum(axis=1))]).astype("<u4")


@dataclass
class WaveletMatrix:
    """``planes``: packed bits, lowest bit first in a byte; ``ranks``: ones before each block; ``zeros``: zeros of each plane."""

    n: int
    planes: list[np.ndarray]
    ranks: list[np.ndarray]
    zeros: list[int]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        level = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, ranks, zeros = [], [], []
        for k in range(bits - 1, -1, -1):
            bit = (level & level.dtype.type(1 << k)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(packed)
            ranks.append(ones_before_blocks(packed))
            zeros.append(len(level) - int(np.count_nonzero(bit)))
            below, z, o = np.empty_like(level), 0, zeros[-1]
            for at in range(0, len(level), RUN):
                run, here = level[at:at + RUN], bit[at:at + RUN]
                ones, nils = run.take(np.flatnonzero(here)), run.take(np.flatnonzero(~here))
                below[z:z + len(nils)] = nils
                below[o:o + len(ones)] = ones
                z, o = z + len(nils), o + len(ones)
            level = below
        return cls(len(ids), planes, ranks, zeros)

    def decode(self) -> np.ndarray:
        """All ids in order."""
        bits = len(self.planes)
        level = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            level[zeros:] |= level.dtype.type(1 << k)
            above, z, o = np.empty_like(level), 0, zeros
            for at in range(0, self.n, RUN):
                here, run = bit[at:at + RUN], above[at:at + RUN]
                ones, nils = np.flatnonzero(here), np.flatnonzero(~here)
                run[nils] = level[z:z + len(nils)]
                run[ones] = level[o:o + len(ones)]
                z, o = z + len(nils), o + len(ones)
            level = above
        return level.astype(np.uint32)

    def _ones(self, p: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``p``."""
        block = i // BLOCK
        rest = np.unpackbits(self.planes[p][block * BLOCK // 8:-(-i // 8)], bitorder="little")[:i - block * BLOCK]
        return int(self.ranks[p][block]) + int(rest.sum())

    def _place(self, p: int, bit: int, k: int) -> int:
        """Where the ``k``-th (from 0) bit of the given value stands in plane ``p``."""
        before = self.ranks[p].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        found = np.unpackbits(self.planes[p][block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(found == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, zeros in enumerate(self.zeros):
            bit = int(self.planes[p][i // 8]) >> (i % 8) & 1
            ones = self._ones(p, i)
            value, i = value << 1 | bit, zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` among positions lo..hi stand below the last plane."""
        bits = len(self.planes)
        if value >> bits:
            return 0, 0
        for p, zeros in enumerate(self.zeros):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (zeros + a, zeros + b) if value >> (bits - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``value`` occurs among positions lo..hi."""
        lo, hi = self._range(value, lo, self.n if hi is None else hi)
        return hi - lo

    def occurrences(self, value: int, lo: int = 0, hi: int | None = None) -> list[int]:
        """The positions of ``value`` among positions lo..hi, ascending."""
        bits, out = len(self.planes), []
        first, last = self._range(value, lo, self.n if hi is None else hi)
        for at in range(first, last):
            for p in range(bits - 1, -1, -1):
                bit = value >> (bits - 1 - p) & 1
                at = self._place(p, bit, at - self.zeros[p] if bit else at)
            out.append(at)
        return out
