"""Cuckoo filters over 128-bit keys: membership with deletion, vectorised lookups, growth by segments."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200
_MUL = np.uint64(0x9E3779B97F4A7C15)


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first and second 64 bits of 16-byte keys."""
    both = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four slots; a full segment is followed by one twice its size."""

    def __init__(self, buckets: int = 64, segments: list[np.ndarray] | None = None):
        self.segments = segments or [np.zeros((buckets, SLOTS), np.uint16)]

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for ``keys`` keys at four fifths of the slots."""
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / (0.8 * SLOTS))))))

    @staticmethod
    def _prints(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        low, high = halves(keys)
        return (high & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1), low

    @staticmethod
    def _other(bucket, prints, mask):
        """The second bucket of a fingerprint; of the second bucket, the first."""
        with np.errstate(over="ignore"):
            return (bucket ^ ((np.uint64(prints) * _MUL) >> np.uint64(20))) & mask

    def contains(self, keys: list[bytes]) -> np.ndarray:
        """False: never inserted.  True: inserted, or rarely (about one in 8,000) another key's fingerprint."""
        if not keys:
            return np.zeros(0, bool)
        prints, low = self._prints(keys)
        found = np.zeros(len(keys), bool)
        for table in self.segments:
            mask = np.uint64(len(table) - 1)
            first = low & mask
            second = self._other(first, prints.astype(np.uint64), mask)
            found |= (table[first] == prints[:, None]).any(axis=1) | (table[second] == prints[:, None]).any(axis=1)
        return found

    def insert(self, keys: list[bytes]) -> None:
        """Insert keys; a key inserted twice has to be deleted twice."""
        if not keys:
            return
        prints, low = self._prints(keys)
        for p, h in zip(prints, low):
            if not self._place(self.segments[-1], p, h & np.uint64(len(self.segments[-1]) - 1)):
                self.segments.append(np.zeros((2 * len(self.segments[-1]), SLOTS), np.uint16))
                self._place(self.segments[-1], p, h & np.uint64(len(self.segments[-1]) - 1))

    def _place(self, table: np.ndarray, p: np.uint16, bucket: np.uint64) -> bool:
        mask, moves = np.uint64(len(table) - 1), []
        for kick in range(KICKS):
            for b in (bucket, self._other(bucket, np.uint64(p), mask)):
                free = np.flatnonzero(table[b] == 0)
                if len(free):
                    table[b, free[0]] = p
                    return True
            slot = kick % SLOTS
            moves.append((bucket, slot, table[bucket, slot]))
            table[bucket, slot], p = p, table[bucket, slot]
            bucket = self._other(bucket, np.uint64(p), mask)
        for b, slot, old in reversed(moves):  # as it was, so that no fingerprint is lost
            table[b, slot] = old
        return False

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that were inserted."""
        if not keys:
            return
        prints, low = self._prints(keys)
        for p, h in zip(prints, low):
            self._remove(p, h)

    def _remove(self, p: np.uint16, h: np.uint64) -> None:
        for table in reversed(self.segments):
            mask = np.uint64(len(table) - 1)
            first = h & mask
            for b in (first, self._other(first, np.uint64(p), mask)):
                at = np.flatnonzero(table[b] == p)
                if len(at):
                    table[b, at[0]] = 0
                    return

    def dump(self) -> list[bytes]:
        return [t.tobytes() for t in self.segments]

    @classmethod
    def load(cls, segments: list[bytes]) -> CuckooFilter:
        return cls(segments=[np.frombuffer(s, np.uint16).reshape(-1, SLOTS).copy() for s in segments])
