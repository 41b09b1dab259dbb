"""Self-join of sets by a prefix tree, for the sets of one block.

Elements are ranked by frequency, so sets that resemble each other share long paths.
Elements of a single set can match nothing: they count for its size, but not for what
overlap it can still reach, and are not stored. A probe walks the tree once and carries the overlap of the shared path; a subtree is left
when even its remaining lengths cannot reach the required overlap, or when all its sets
are known to be in the probe's component.
"""

from __future__ import annotations

import numpy as np


class Node:
    __slots__ = ("run", "children", "most", "ends", "roots")

    def __init__(self, run: np.ndarray) -> None:
        self.run = run
        self.children: dict[int, Node] = {}
        self.most = 0  # elements stored on the longest path through here
        self.ends: list[int] = []
        self.roots: set[int] = set()


class Forest:
    """Union-find whose roots are smallest members."""

    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def ranked(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The elements that each set shares with others, as ascending ranks; the most frequent one has rank 0."""
    flat = np.concatenate(sets)
    values, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts[which] > 1
    owner, place = owner[shared], rank[which][shared]
    order = np.lexsort((place, owner))
    return np.split(place[order], np.searchsorted(owner[order], np.arange(1, len(sets))))


def needed(a: int, b: int, share: int) -> int:
    """Least overlap with which ``100 * overlap >= share * union`` for sizes ``a`` and ``b``."""
    return -(-share * (a + b) // (100 + share))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def insert(root: Node, item: np.ndarray, number: int) -> None:
    """Add the shared elements of set ``number``."""
    node, at = root, 0
    while True:
        node.most = max(node.most, len(item))
        node.roots.add(number)
        if at == len(item):
            node.ends.append(number)
            return
        child = node.children.get(first := int(item[at]))
        if child is None:
            child = node.children[first] = Node(item[at:])
        same = common(child.run, item[at:])
        if same < len(child.run):
            top = Node(child.run[:same])
            top.most, top.roots = child.most, set(child.roots)
            child.run = child.run[same:]
            top.children[int(child.run[0])] = child
            node.children[first] = child = top
        node, at = child, at + same


def _settled(node: Node, forest: Forest, own: int) -> bool:
    """Whether all sets below are in component ``own``."""
    if len(node.roots) > 1 or own not in node.roots:
        node.roots = {forest.find(x) for x in node.roots}
    return node.roots == {own}


def links(sets: list[np.ndarray], share: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs of set numbers that link, enough to connect every component of the block.

    ``known`` gives labels: sets of equal label are connected already. Empty sets link with nothing.
    """
    forest = Forest(len(sets))
    seen: dict[int, int] = {}
    for i, label in enumerate(known or []):
        forest.union(i, seen.setdefault(label, i))
    filled = [i for i, s in enumerate(sets) if len(s)]
    if len(filled) < 2:
        return []
    items = dict(zip(filled, ranked([sets[i] for i in filled]), strict=True))
    trees: dict[int, Node] = {}  # one for each full size, so that the required overlap is exact
    found: list[tuple[int, int]] = []
    for number in sorted(filled, key=lambda i: (len(sets[i]), i)):
        item = items[number]
        size, stored = len(sets[number]), len(item)
        stack = [(tree, needed(size, n, share), 0, 0, 0) for n, tree in trees.items() if 100 * n >= share * size]
        while stack:
            node, need, at, matched, depth = stack.pop()
            if not node.roots or _settled(node, forest, forest.find(number)):
                continue
            run = node.run
            if len(run):
                if len(run) == 1:
                    place = int(np.searchsorted(item[at:], run[0])) + at
                    hit = place < stored and item[place] == run[0]
                    matched, at = matched + hit, place + hit
                else:
                    place = np.searchsorted(item[at:], run) + at
                    inside = place < stored
                    matched += int((item[place[inside]] == run[inside]).sum())
                    at = int(np.searchsorted(item[at:], run[-1], "right")) + at
                depth += len(run)
            if matched + min(stored - at, node.most - depth) < need:
                continue
            if matched >= need:
                found.extend((number, other) for other in node.ends if forest.union(number, other))
            straight = node.children.get(int(item[at])) if at < stored else None
            stack.extend((c, need, at, matched, depth) for c in node.children.values() if c is not straight)
            if straight is not None:
                stack.append((straight, need, at, matched, depth))
        insert(trees.setdefault(size, Node(np.zeros(0, np.int64))), item, number)
    return found
