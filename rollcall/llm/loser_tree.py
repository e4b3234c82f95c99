"""Merging k sorted sources with a tree of losers: one comparison per level for each row that leaves."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any


def merge(sources: list[Iterable[Any]], key: Callable[[Any], Any]) -> Iterator[Any]:
    """The rows of all sources in order; equal keys in the order of the sources. Each source must be in order.

    Inner node n (1 to k-1) holds the source that lost there; node 0 holds the winner. Leaf s sits below node (s+k)//2.
    """
    k = len(sources)
    if k == 0:
        return
    streams = [iter(s) for s in sources]
    heads: list[Any] = [None] * k
    ranks: list[Any] = [None] * k  # (key, source) of the head; None when the source has ended

    def advance(s: int) -> None:
        try:
            heads[s] = next(streams[s])
            ranks[s] = (key(heads[s]), s)
        except StopIteration:
            heads[s] = ranks[s] = None

    def beats(a: int, b: int) -> bool:
        return ranks[a] is not None and (ranks[b] is None or ranks[a] < ranks[b])

    for s in range(k):
        advance(s)
    winners = [0] * k + list(range(k))
    losers = [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while ranks[best] is not None:
        yield heads[best]
        advance(best)
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2
