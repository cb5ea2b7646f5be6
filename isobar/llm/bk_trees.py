"""BK-trees over fingerprints, one for each shard, in numpy arrays that travel as bytes.

The root of a tree is the first member of its shard; the children of a node are keyed by their integer Hamming distance to
it, one child a distance, and hold all members at that distance. A search at distance d from a node follows only the edges
d - radius to d + radius. All trees of a forest are built, and all queries searched, level by level at once.
"""

from __future__ import annotations

import numpy as np

#: Pairs of query and node that are looked at together; more are taken one part after the other.
FRONTIER = 1 << 17


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the rows of two arrays of uint64."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


class Forest:
    """Trees of shards: nodes with their fingerprints, edges (parent, distance) in order with the child each, and roots by key."""

    def __init__(self, keys: np.ndarray, roots: np.ndarray, prints: np.ndarray, edges: np.ndarray, children: np.ndarray) -> None:
        self.keys, self.roots, self.prints, self.edges, self.children = keys, roots, prints, edges, children
        self.span = 64 * prints.shape[1] + 1
        self.followed = self.skipped = 0  # edges that searches took, and those that they left out

    @classmethod
    def build(cls, key: np.ndarray, prints: np.ndarray) -> Forest:
        """The trees of members with a key and a fingerprint (a uint64, or a row of them), sorted by key."""
        prints = prints[:, None] if prints.ndim == 1 else prints
        span, n = 64 * prints.shape[1] + 1, len(key)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        roots = np.flatnonzero(new)
        at = np.repeat(roots, np.diff(np.append(roots, n)))
        todo, edges, children = np.flatnonzero(~new), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(todo):
            edge = at[todo] * span + distances(prints[todo], prints[at[todo]])
            order = np.argsort(edge, kind="stable")
            todo, edge = todo[order], edge[order]
            first = np.ones(len(todo), bool)
            first[1:] = edge[1:] != edge[:-1]
            child = todo[first]
            edges.append(edge[first])
            children.append(child)
            at[todo] = np.repeat(child, np.diff(np.append(np.flatnonzero(first), len(todo))))
            todo = np.sort(todo[~first])
        edge, child = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edge)
        return cls(key[roots], roots, prints, edge[order], child[order])

    def search(self, key: np.ndarray, prints: np.ndarray, radius: int):
        """Pairs (query, node) within the radius, in parts: of each query the nodes of the tree with its key."""
        prints = prints[:, None] if prints.ndim == 1 else prints
        tree = np.searchsorted(self.keys, key)
        own = np.flatnonzero(tree < len(self.keys))
        own = own[self.keys[tree[own]] == key[own]]
        stack = [(own, self.roots[tree[own]])]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                stack += [(query[FRONTIER:], node[FRONTIER:]), (query[:FRONTIER], node[:FRONTIER])]
                continue
            d = distances(prints[query], self.prints[node])
            hit = d <= radius
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * self.span + np.maximum(d - radius, 0))
            high = np.searchsorted(self.edges, node * self.span + np.minimum(d + radius, self.span - 1), side="right")
            n = high - low
            self.followed += int(n.sum())
            self.skipped += int((np.searchsorted(self.edges, (node + 1) * self.span) - np.searchsorted(self.edges, node * self.span)).sum() - n.sum())
            if n.any():
                edge = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                stack.append((np.repeat(query, n), self.children[edge]))

    def to_bytes(self) -> list[bytes]:
        return [x.tobytes() for x in (self.keys, self.roots, self.prints, self.edges, self.children)]

    @classmethod
    def joined(cls, parts: list[list[bytes]], width: int = 1) -> Forest:
        """One forest of the trees of several (to_bytes); a key's tree is in one of them."""
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        nodes, span = 0, 64 * width + 1
        for part in parts:
            keys, roots, prints, edges, children = (np.frombuffer(x, t) for x, t in zip(part, (np.int64, np.int64, np.uint64, np.int64, np.int64), strict=True))
            for of, x in zip(out, (keys, roots + nodes, prints.reshape(-1, width), edges + nodes * span, children + nodes), strict=True):
                of.append(x)
            nodes += len(prints) // width
        if not parts:
            return cls.build(np.zeros(0, np.int64), np.zeros((0, width), np.uint64))
        keys, roots, prints, edges, children = (np.concatenate(x) for x in out)
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], roots[order], prints, edges, children)

    def linked(self, key: np.ndarray, prints: np.ndarray, radius: int, name: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a search finds, as links: of the names of the queries and of the nodes, as spanning gives them."""
        a, b, held = [name[:0]], [name[:0]], 0
        for query, node in self.search(key, prints, radius):
            a.append(name[query])
            b.append(names[node])
            held += len(query)
            if held > 1 << 20:
                one, two = spanning(np.concatenate(a), np.concatenate(b))
                a, b, held = [one], [two], 0
        return spanning(np.concatenate(a), np.concatenate(b))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between numbers, each number that isn't the least of its component, and that least number."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[moved], nodes[root[moved]]
