"""Cuckoo filters over 64-bit key hashes, in numpy.

A filter is an array of buckets of four 16-bit fingerprints. A key may lie in
one of two buckets, each found from the other and the fingerprint, so a key can
be moved without knowing it, and taken out again. Keys are placed all at once:
each round fills the free slots of the wanted buckets, what is left over
displaces one fingerprint per bucket.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Share of the slots that a new filter fills at most.
LOAD = 0.8
_ROUNDS = 400


def buckets_for(keys: int) -> int:
    """Buckets, a power of two, that hold so many keys below ``LOAD``."""
    n = 2
    while n * SLOTS * LOAD < keys:
        n *= 2
    return n


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (xor-shift and multiply), so that any bits can be used."""
    x = x.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _prints(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (never 0, which marks a free slot) and first bucket."""
    x = _mix(np.asarray(hashes))
    prints = (x >> np.uint64(48)).astype(np.uint16)
    return np.where(prints == 0, 1, prints).astype(np.uint16), (x & np.uint64(n - 1)).astype(np.int64)


def _other(bucket: np.ndarray, prints: np.ndarray, n: int) -> np.ndarray:
    return bucket ^ (_mix(prints.astype(np.int64)) & np.uint64(n - 1)).astype(np.int64)


class Full(ValueError):
    """The keys do not fit; the filter has to be made anew with more buckets."""


class CuckooFilter:
    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.n = len(cells)

    @staticmethod
    def of(hashes: np.ndarray) -> "CuckooFilter":
        """A filter of these (distinct) keys."""
        n = buckets_for(len(hashes))
        while True:
            made = CuckooFilter(np.zeros((n, SLOTS), np.uint16))
            try:
                made.add(hashes)
                return made
            except Full:
                n *= 2

    @staticmethod
    def from_bytes(data: bytes) -> "CuckooFilter":
        return CuckooFilter(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def add(self, hashes: np.ndarray) -> None:
        """Place keys; raises ``Full`` when some find no place."""
        prints, bucket = _prints(hashes, self.n)
        for turn in range(_ROUNDS):
            if not len(prints):
                return
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            place = np.arange(len(bucket)) - np.searchsorted(bucket, bucket, side="left")
            free = self.cells[bucket] == 0
            fits = place < free.sum(axis=1)
            # The k-th of a bucket's newcomers takes its k-th free slot.
            slot = np.argmax((np.cumsum(free, axis=1) == place[:, None] + 1) & free, axis=1)
            self.cells[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket, place = prints[~fits], bucket[~fits], place[~fits]
            if turn % 2 == 0:                # the other bucket may have room
                bucket = _other(bucket, prints, self.n)
                continue
            first = np.concatenate(([True], bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, bool)
            at = (turn // 2 + prints[first].astype(np.int64)) % SLOTS
            rows = bucket[first]
            pushed = self.cells[rows, at]
            self.cells[rows, at] = prints[first]
            prints[first] = pushed
            bucket[first] = _other(rows, pushed, self.n)
            empty = prints == 0              # a slot that was free after all
            prints, bucket = prints[~empty], bucket[~empty]
        if len(prints):
            raise Full(f"{len(prints)} keys found no place in {self.n} buckets")

    def remove(self, hashes: np.ndarray) -> None:
        """Take out keys that were added."""
        prints, first = _prints(hashes, self.n)
        second = _other(first, prints, self.n)
        for p, a, b in zip(prints, first, second):
            for bucket in (a, b):
                hit = np.flatnonzero(self.cells[bucket] == p)
                if len(hit):
                    self.cells[bucket, hit[0]] = 0
                    break
            else:
                raise KeyError("a key to be removed is not in the filter")

    def might_hold(self, hashes: np.ndarray) -> np.ndarray:
        """True for every key that was added, and for few others."""
        prints, first = _prints(hashes, self.n)
        second = _other(first, prints, self.n)
        return ((self.cells[first] == prints[:, None]) | (self.cells[second] == prints[:, None])).any(axis=1)
