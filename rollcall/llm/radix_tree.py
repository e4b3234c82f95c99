"""An adaptive radix tree over byte strings (Leis, Kemper and Neumann, ICDE 2013).

A node keeps the bytes that all keys below it share (path compression) and its children in one of four layouts, which
grow as children come: up to 4 or 16 sorted bytes beside as many children, 48 children behind an index of 256 bytes, or
256 places. A key may be the beginning of another: the value then hangs at an inner node.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

SMALL, SORTED, INDEXED = 4, 16, 48


def common(a: bytes, b: bytes) -> int:
    """The number of leading bytes that two strings share."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    differ = int.from_bytes(a[:size]) ^ int.from_bytes(b[:size])
    return size - (differ.bit_length() + 7) // 8


class Sorted:
    """Up to 4 or 16 children beside their sorted bytes."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int, keys: bytearray, nodes: list[Node]):
        self.room, self.bytes, self.nodes = room, keys, nodes

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node: Node) -> Sorted | Indexed:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.bytes) == self.room:
            grown = Sorted(SORTED, self.bytes, self.nodes) if self.room == SMALL else Indexed(self.bytes, self.nodes)
            return grown.put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def each(self) -> Iterator[Node]:
        return iter(self.nodes)


class Indexed:
    """Up to 48 children behind an index by byte, which holds places less one."""

    __slots__ = ("index", "nodes")

    def __init__(self, keys: bytearray, nodes: list[Node]):
        self.index, self.nodes = bytearray(256), list(nodes)
        for place, byte in enumerate(keys, 1):
            self.index[byte] = place

    def get(self, byte: int) -> Node | None:
        place = self.index[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        if place := self.index[byte]:
            self.nodes[place - 1] = node
        elif len(self.nodes) == INDEXED:
            return Direct(self).put(byte, node)
        else:
            self.nodes.append(node)
            self.index[byte] = len(self.nodes)
        return self

    def each(self) -> Iterator[Node]:
        return (self.nodes[place - 1] for place in self.index if place)


class Direct:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self, before: Indexed):
        self.nodes = [before.get(byte) for byte in range(256)]

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def each(self) -> Iterator[Node]:
        return (node for node in self.nodes if node is not None)


class Node:
    """`path`: the shared bytes after the one that leads here; `value`: that of the key that ends here; `sample`: the
    value of some key that passes through."""

    __slots__ = ("path", "kids", "value", "sample")

    def __init__(self, path: bytes, value, sample):
        self.path, self.value, self.sample, self.kids = path, value, sample, None

    def child(self, byte: int) -> Node | None:
        return self.kids.get(byte) if self.kids else None

    def put(self, byte: int, node: Node) -> None:
        self.kids = (self.kids or Sorted(SMALL, bytearray(), [])).put(byte, node)

    def children(self) -> Iterator[Node]:
        return self.kids.each() if self.kids else iter(())


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not there yet, with a value other than None."""
        if self.root is None:
            self.root = Node(key, value, value)
            return
        node, at, above, byte = self.root, 0, None, 0
        while True:
            path = node.path
            shared = len(path) if key.startswith(path, at) else common(path, key[at : at + len(path)])
            if shared < len(path):  # the path parts here
                inner = Node(path[:shared], None, value)
                inner.put(path[shared], node)
                node.path = path[shared + 1 :]
                if above is None:
                    self.root = inner
                else:
                    above.put(byte, inner)
                node, path = inner, inner.path
            at += len(path)
            if at == len(key):
                node.value = value
                return
            above, byte = node, key[at]
            at += 1
            if (node := above.child(byte)) is None:
                above.put(byte, Node(key[at:], value, value))
                return
