"""Minimal perfect hashing by hash and displace: n keys to the numbers 0 to n-1, 16 bits a key and no key stored.

Keys fall into groups of four on average. The largest groups come first; each tries displacements until its keys land
on free places. Groups of one key take the places left over, named directly.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

GROUP = 4
HEAD = struct.Struct("<QQQ")


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits of each key."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(start: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    """Where a key lands: hashed anew for every displacement, so that even a few keys can try without end."""
    return (mixed(start ^ (displacement.astype(np.uint64) << np.uint64(20)), 11) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    seed: int
    size: int
    displacements: np.ndarray  # per group; negative: the place itself, less one

    @classmethod
    def build(cls, keys: np.ndarray, seed: int = 1) -> PerfectHash:
        """keys: distinct unsigned 64-bit integers."""
        while True:
            if (found := cls._attempt(keys, seed)) is not None:
                return found
            seed += 1

    @classmethod
    def _attempt(cls, keys: np.ndarray, seed: int) -> PerfectHash | None:
        size = len(keys)
        groups = size // GROUP + 1
        group, start = _hashes(keys, seed, groups)
        order = np.argsort(group, kind="stable")
        counts = np.bincount(group, minlength=groups)
        ends = np.cumsum(counts)
        free = np.ones(size, bool)
        displacements = np.zeros(groups, np.int64)
        by_size = np.argsort(-counts, kind="stable")
        tries = np.arange(64)
        for g in by_size[: np.count_nonzero(counts >= 2)]:
            members = order[ends[g] - counts[g] : ends[g]]
            for base in range(0, 1 << 20, 64):
                found = places(start[members][None, :], (base + tries)[:, None], size)
                fits = free[found].all(axis=1)
                row = next((r for r in np.flatnonzero(fits) if len(set(found[r].tolist())) == len(members)), None)
                if row is not None:
                    displacements[g] = base + row
                    free[found[row]] = False
                    break
            else:
                return None
        alone = by_size[np.count_nonzero(counts >= 2) : np.count_nonzero(counts >= 1)]
        displacements[alone] = -np.flatnonzero(free) - 1
        return cls(seed, size, displacements)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; a key that was not built in gets some place."""
        group, start = _hashes(keys, self.seed, len(self.displacements))
        shift = self.displacements[group]
        return np.where(shift < 0, -shift - 1, places(start, np.maximum(shift, 0), self.size))

    def dump(self) -> bytes:
        return HEAD.pack(self.seed, self.size, len(self.displacements)) + self.displacements.astype("<i8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and where its bytes end."""
        seed, size, groups = HEAD.unpack_from(data)
        return cls(seed, size, np.frombuffer(data, "<i8", groups, HEAD.size)), HEAD.size + 8 * groups


def _hashes(keys: np.ndarray, seed: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    return (mixed(keys, 2 * seed) % np.uint64(groups)).astype(np.int64), mixed(keys, 2 * seed + 1)
