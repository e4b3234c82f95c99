"""Addresses of a complete tree's nodes in van Emde Boas order (Prokop 1999; Bender, Demaine and Farach-Colton 2000).

A tree of L levels is split at half its height: the upper half's tree comes first, then the trees that hang below it, each
stored the same way. Nodes near each other in the tree lie near each other in memory, whatever a block of memory holds.
"""

from __future__ import annotations

import numpy as np


def size(levels: int, fan: int) -> int:
    return (fan**levels - 1) // (fan - 1)


def addresses(levels: int, depth: int, index: np.ndarray, fan: int) -> np.ndarray:
    """Where the nodes of a depth (0: the root) lie, by their numbers from the left: arithmetic alone, no pointers."""
    found, index = np.zeros(len(index), np.int64), index.astype(np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        below = levels - upper
        width = fan ** (depth - upper)
        found += size(upper, fan) + index // width * size(below, fan)
        levels, depth, index = below, depth - upper, index % width
    return found
