"""Cover trees over whole-number vectors, for exact searches by inner product.

Each vector gets one more component that makes all norms equal to the largest one, ``M``.
For a query ``a`` (with a zero there), ``2 a.x = |a|^2 + M^2 - |a - x|^2``, so nearness of the
augmented vectors and inner product are the same order. Every node has a member as its
center and the largest distance from there to a member as its covering radius; its children
are centered on members that lie at least the children's radius apart, farthest first. Known
distances to the centers therefore bound the inner products of all members of a node.

Members of one label form subtrees of their own, unless they are few. ``search`` is for one
query; ``search_all`` takes a block of them through a tree by matrix products, and what the
block has found in one tree already bounds its search in the next. Nothing here knows Spark;
tasks build a tree over a bounded number of rows and search it.
"""

from __future__ import annotations

import heapq
import io
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

import numpy as np

#: Most members of a leaf (equal vectors are never split), and most children of a node. A node has
#: no more children than make leaves of about half that size.
LEAF, FANOUT = 128, 16
#: Leaves that a block scores together if this share of (query, leaf) is wanted, and scores that
#: wait until windows are brought up to date.
TOGETHER, DENSE, WAITING = 16, 0.25, 1 << 16
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


@dataclass
class Tree:
    vectors: np.ndarray  # members, those of a leaf one after the other
    ids: np.ndarray
    labels: np.ndarray
    center: np.ndarray  # of each node: member at the center
    radius: np.ndarray
    child: np.ndarray  # first child, and end of the children
    child_end: np.ndarray
    row: np.ndarray  # first member of a leaf, and end of its members
    row_end: np.ndarray
    pure: np.ndarray  # all members have the label of the center
    roots: np.ndarray
    most: np.ndarray  # square of the largest norm
    cast: np.ndarray | None = field(default=None, init=False, repr=False)  # members as last scored

    def to_bytes(self) -> bytes:
        """Compressed. Components must fit 32 bits; their bytes lie apart, signs in the lowest bit, as few of the higher ones count."""
        out, kept = io.BytesIO(), {f.name: getattr(self, f.name) for f in fields(self) if f.init}
        signless = (self.vectors.astype(np.int64) << 1 ^ self.vectors.astype(np.int64) >> 63).astype("<u4")
        kept["vectors"] = np.moveaxis(signless[..., None].view(np.uint8), -1, 0)
        np.savez(out, **kept)
        return zlib.compress(out.getvalue(), 1)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        with np.load(io.BytesIO(zlib.decompress(raw))) as arrays:
            kept = {f.name: arrays[f.name] for f in fields(cls) if f.init}
        signless = np.ascontiguousarray(np.moveaxis(kept["vectors"], 0, -1)).view("<u4")[..., 0].astype(np.int64)
        vectors = signless >> 1 ^ -(signless & 1)
        small = np.abs(vectors).max(initial=0) <= np.iinfo(np.int16).max
        return cls(**kept | {"vectors": vectors.astype(np.int16 if small else np.int32)})

    def members(self, kind: np.dtype) -> np.ndarray:
        if self.cast is None or self.cast.dtype != kind:
            self.cast = self.vectors.astype(kind)
        return self.cast


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - center) ** 2).sum(axis=1))


def _split(points: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Centers, each the point farthest from those before it, and the nearest one of every point."""
    centers, nearest, distance = [0], np.zeros(len(points), np.int64), _distances(points, points[0])
    while len(centers) < min(FANOUT, -(-2 * len(points) // LEAF)):
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        own = _distances(points, points[far])
        closer = own < distance
        nearest[closer] = len(centers)
        distance = np.minimum(distance, own)
        centers.append(far)
    return centers, nearest


def build(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
    """Tree over at least one row."""
    exact = vectors.astype(np.float64)
    square = (exact**2).sum(axis=1)
    most = square.max()
    points = np.hstack([exact, np.sqrt(most - square)[:, None]])

    kinds, inverse, counts = np.unique(labels, return_inverse=True, return_counts=True)
    of_kind = np.split(np.argsort(inverse, kind="stable"), np.cumsum(counts)[:-1])
    large = [rows for rows in of_kind if len(rows) >= LEAF]
    few = [rows for rows in of_kind if len(rows) < LEAF]
    todo = [(rows, True) for rows in large] + ([(np.concatenate(few), len(few) == 1)] if few else [])
    roots, order, nodes, placed, i = len(todo), [], [], 0, 0
    while i < len(todo):  # children are appended, so that those of a node follow each other
        rows, pure = todo[i]
        i += 1
        own = points[rows]
        radius = _distances(own, own[0]).max() * (1 + 1e-9)
        if len(rows) <= LEAF or radius == 0:
            nodes.append((rows[0], radius, 0, 0, placed, placed + len(rows), pure))
            order.append(rows)
            placed += len(rows)
            continue
        centers, nearest = _split(own)
        nodes.append((rows[0], radius, len(todo), len(todo) + len(centers), 0, 0, pure))
        for k, center in enumerate(centers):
            members = rows[nearest == k]
            todo.append((np.concatenate([rows[[center]], members[members != rows[center]]]), pure))
    final = np.concatenate(order)
    place = np.empty(len(final), np.int64)
    place[final] = np.arange(len(final))
    center, radius, child, child_end, row, row_end, pure = (np.array(c) for c in zip(*nodes))
    return Tree(vectors[final], ids[final], labels[final], place[center], radius, child, child_end, row, row_end, pure, np.arange(roots), np.array(most))


class Best:
    """The first rows of a window of scores: highest score first, ties by smaller id."""

    def __init__(self, low: float, high: float, size: int):
        self.low, self.high, self.size = low, high, size
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """Score under which nothing is wanted any more."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.size else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores >= self.least) & (scores <= self.high)
        if some.any():
            scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
            order = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[order], ids[order]


def search(tree: Tree, query: np.ndarray, label: int, same: bool, own: int | None, windows: Sequence[Best]) -> None:
    """Fills the windows from the members with the label (``same``) or with another one, except
    the member with the id ``own``.

    Nodes are opened in the order of the highest inner product that their covering radius
    allows. A node is skipped if that range lies outside all windows, or under what full
    windows hold. Members of open leaves are scored in whole numbers.
    """
    exact = query.astype(np.float64)
    size = (exact @ exact) ** 0.5
    middle = tree.vectors[tree.center].astype(np.float64) @ exact
    away = np.sqrt(np.maximum(size**2 + tree.most - 2 * middle, 0))
    slack = 1e-9 * (size**2 + tree.most) + 1e-6
    ball = (size**2 + tree.most - np.maximum(away - tree.radius, 0) ** 2) / 2
    high = np.minimum(ball, middle + size * tree.radius) + slack
    low = np.maximum((size**2 + tree.most - (away + tree.radius) ** 2) / 2, middle - size * tree.radius) - slack
    fits = ~tree.pure | ((tree.labels[tree.center] == label) == same)

    def wanted(node: int) -> bool:
        return bool(fits[node]) and any(high[node] >= w.least and low[node] <= w.high for w in windows)

    heap = [(-high[n], n) for n in tree.roots.tolist() if wanted(n)]
    heapq.heapify(heap)
    while heap:
        _, node = heapq.heappop(heap)
        if not wanted(node):
            continue
        if tree.child_end[node]:
            for child in range(tree.child[node], tree.child_end[node]):
                if wanted(child):
                    heapq.heappush(heap, (-high[child], child))
            continue
        rows = slice(tree.row[node], tree.row_end[node])
        scores, ids = tree.vectors[rows] @ query, tree.ids[rows]
        some = (tree.labels[rows] == label) == same
        if own is not None:
            some &= ids != own
        for window in windows:
            window.offer(scores[some], ids[some])


def _order(window: np.ndarray, score: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Rows by window, the highest score first, ties by smaller id."""
    if not len(window):
        return np.zeros(0, np.int64)
    top, span = int(score.max()), int(score.max()) - int(score.min()) + 1
    if (int(window.max()) + 1) * span > MOST:
        return np.lexsort((other, -score, window))
    key = window * span + (top - score)  # one key is sorted much faster; the few ties are put right
    order = np.argsort(key)
    key = key[order]
    tie = key[1:] == key[:-1]
    some = np.flatnonzero(np.append(tie, False) | np.append(False, tie))
    order[some] = order[some][np.lexsort((other[order[some]], key[some]))]
    return order


class Block:
    """Queries that are searched together, their windows of scores and the first rows of each:
    highest score first, ties by smaller id. A window is empty if ``low`` is above ``high``."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
        self.vectors, self.ids, self.labels, self.size = vectors, ids, labels, size
        self.as_kind = {np.dtype(np.int64): vectors, np.dtype(np.float64): vectors.astype(np.float64)}
        self.norms = np.sqrt((self.as_kind[np.dtype(np.float64)] ** 2).sum(axis=1))
        void = low > high
        self.least, self.high = np.where(void, MOST, low), np.where(void, LEAST, high)  # of each query's windows
        # First rows: window (query by query), score, id. Rows that wait: query, score, id.
        self.held = [np.zeros(0, np.int64) for _ in range(3)]
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0
        self._bound()

    def _bound(self) -> None:
        self.floor, self.ceiling = self.least.min(axis=1), self.high.max(axis=1)

    def kind(self, tree: Tree) -> np.dtype:
        """Smallest type in which products with the members are exact: no partial sum of one is
        larger than the product of the norms."""
        largest = float(self.norms.max(initial=0)) * float(tree.most) ** 0.5 * (1 + 1e-9)
        return np.dtype(np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64)

    def score(self, tree: Tree, rows: np.ndarray, queries: np.ndarray, same: bool) -> None:
        kind = self.kind(tree)
        if kind not in self.as_kind:
            self.as_kind[kind] = self.vectors.astype(kind)
        common = min(self.vectors.shape[1], tree.vectors.shape[1])  # the shorter vector goes on with zeros
        scores = self.as_kind[kind][queries, :common] @ tree.members(kind)[rows, :common].T
        at = np.flatnonzero(scores >= self.floor[queries, None].astype(kind))
        who, row, found = queries[at // len(rows)], rows[at % len(rows)], scores.ravel()[at].astype(np.int64)
        some = (found <= self.ceiling[who]) & ((tree.labels[row] == self.labels[who]) == same) & (tree.ids[row] != self.ids[who])
        if some.any():
            self.waiting.append((who[some], found[some], tree.ids[row[some]]))
            self.n_waiting += int(some.sum())
            if self.n_waiting >= WAITING:
                self.settle()

    def settle(self) -> None:
        """Puts what waits into the windows."""
        if not self.waiting:
            return
        who, score, other = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        windows = self.least.shape[1]
        parts = [self.held]
        for w in range(windows):
            some = (score >= self.least[who, w]) & (score <= self.high[who, w])
            parts.append([who[some] * windows + w, score[some], other[some]])
        window, score, other = (np.concatenate(c) for c in zip(*parts))
        order = _order(window, score, other)
        window, score, other = window[order], score[order], other[order]
        begin = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(begin, np.diff(begin, append=len(window)))
        first = rank < self.size
        self.held = [window[first], score[first], other[first]]
        full = rank == self.size - 1
        least = self.least.reshape(-1)
        least[window[full]] = score[full]
        self._bound()


def _bounds(tree: Tree, nodes: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Highest and lowest score of every query with a member of each node."""
    size, most, radius = block.norms[:, None], float(tree.most), tree.radius[nodes]
    common = min(block.vectors.shape[1], tree.vectors.shape[1])
    middle = block.as_kind[np.dtype(np.float64)][:, :common] @ tree.vectors[tree.center[nodes], :common].astype(np.float64).T
    both = size**2 + most
    away = np.sqrt(np.maximum(both - 2 * middle, 0))
    slack = 1e-7 * both + 1e-6
    high = np.minimum((both - np.maximum(away - radius, 0) ** 2) / 2, middle + size * radius) + slack
    low = np.maximum((both - (away + radius) ** 2) / 2, middle - size * radius) - slack
    return high, low


def search_all(tree: Tree, block: Block, same: bool) -> None:
    """As ``search``, for all queries of the block and their own windows and ids.

    Level by level, a node is opened for the queries that its covering radius does not rule out;
    the leaves are then scored in the order of the highest inner product they allow, as far as
    the windows still want them.
    """

    def wanted(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return (high >= block.floor[:, None]) & (low <= block.ceiling[:, None])

    nodes, above = tree.roots, np.ones((len(block.ids), len(tree.roots)), bool)
    leaves = []
    while len(nodes):
        high, low = _bounds(tree, nodes, block)
        fits = ~tree.pure[nodes] | ((tree.labels[tree.center[nodes]] == block.labels[:, None]) == same)
        want = above & fits & wanted(high, low)
        leaf = tree.child_end[nodes] == 0
        some = np.flatnonzero(leaf & want.any(axis=0))
        leaves.append((nodes[some], want[:, some], high[:, some], low[:, some]))
        some = np.flatnonzero(~leaf & want.any(axis=0))
        begin, count = tree.child[nodes[some]], tree.child_end[nodes[some]] - tree.child[nodes[some]]
        above = np.repeat(want[:, some], count, axis=1)
        nodes = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    nodes, want, high, low = (np.concatenate(c, axis=-1) for c in zip(*leaves))
    order = np.argsort(-np.where(want, high, -np.inf).max(axis=0, initial=-np.inf), kind="stable")
    for begin in range(0, len(order), TOGETHER):
        now = order[begin : begin + TOGETHER]
        still = want[:, now] & wanted(high[:, now], low[:, now])
        now, still = now[still.any(axis=0)], still[:, still.any(axis=0)]
        if not len(now):
            continue
        members = [np.arange(tree.row[n], tree.row_end[n]) for n in nodes[now]]
        if still.mean() >= DENSE:
            block.score(tree, np.concatenate(members), np.flatnonzero(still.any(axis=1)), same)
        else:
            for rows, queries in zip(members, still.T):
                block.score(tree, rows, np.flatnonzero(queries), same)
