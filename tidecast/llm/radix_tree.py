"""An adaptive radix tree over byte strings, whose keys may be prefixes of each other.

A node branches on one byte.  Its children lie in one of four layouts, which grows with their number: 4 or 16 sorted bytes beside as many
children, an index of 256 places into 48 children, and 256 children directly.  Bytes on which nothing branches are kept in the node below them as one piece
(path compression), so a tree has at most twice as many nodes as keys, however long these are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

SMALL, MEDIUM, LARGE = 4, 16, 48


class Sorted:
    """Up to 4 or 16 children beside their bytes, in order."""

    __slots__ = ("room", "bytes", "children")

    def __init__(self, room: int = SMALL) -> None:
        self.room, self.bytes, self.children = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.children[at]

    def put(self, byte: int, child: Node) -> Sorted | Indexed:
        """The layout that holds the child now: this one, or a larger one if it was full."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.children[at] = child
            return self
        if len(self.bytes) < self.room:
            self.bytes.insert(at, byte)
            self.children.insert(at, child)
            return self
        larger = Sorted(MEDIUM) if self.room == SMALL else Indexed()
        for old, node in self.items():
            larger.put(old, node)
        return larger.put(byte, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.children)


class Indexed:
    """Up to 48 children in the order of their coming, found by an index of one place per byte."""

    __slots__ = ("index", "children")

    def __init__(self) -> None:
        self.index, self.children = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child: Node) -> Indexed | Direct:
        at = self.index[byte]
        if at:
            self.children[at - 1] = child
            return self
        if len(self.children) < LARGE:
            self.children.append(child)
            self.index[byte] = len(self.children)
            return self
        larger = Direct()
        for old, node in self.items():
            larger.put(old, node)
        return larger.put(byte, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.children[at - 1]) for byte, at in enumerate(self.index) if at)


class Direct:
    """A place for each of the 256 bytes."""

    __slots__ = ("children",)

    def __init__(self) -> None:
        self.children = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> Direct:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.children) if node is not None)


class Node:
    """``piece``: the bytes between the parent's end and this node's.  ``value``: of the key that ends here, if one does."""

    __slots__ = ("piece", "value", "below", "sums")

    def __init__(self, piece: bytes, value: Any = None) -> None:
        self.piece, self.value, self.below, self.sums = piece, value, None, None

    def put(self, child: Node) -> None:
        self.below = (Sorted() if self.below is None else self.below).put(child.piece[0], child)

    def children(self) -> list[Node]:
        return [] if self.below is None else [node for _, node in self.below.items()]


def common(a: bytes, b: bytes) -> int:
    """The length of the prefix that two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def slot(self, key: bytes) -> Node:
        """The node at which the key ends, made if there is none."""
        node, at = self.root, 0
        while at < len(key):
            child = None if node.below is None else node.below.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.put(child)
                return child
            shared = common(child.piece, key[at:at + len(child.piece)])
            if shared < len(child.piece):
                upper = Node(child.piece[:shared])
                child.piece = child.piece[shared:]
                upper.put(child)
                node.put(upper)
                child = upper
            node, at = child, at + shared
        return node
