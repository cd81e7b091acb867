"""Hierarchical navigable small-world graphs as flat neighbour arrays, in numpy.

Nodes are inserted layer by layer from the top and, inside a layer, batch by batch, each batch
no larger than what the layer holds already; the whole batch is searched for at once. Equal
vectors are one node with a list of ids, so copies neither crowd a graph nor get lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Params:
    links: int = 16  # of a node in an upper layer; twice as many in the lowest
    build: int = 64  # nodes kept while searching for a new node's neighbours
    search: int = 192  # nodes kept while searching for a query's
    batch: int = 512
    seen_bytes: int = 32 << 20  # of the marks that tell which nodes a batch has measured
    seed: int = 5

    def together(self, nodes: int) -> int:
        """Searches that go on at once in a graph of so many nodes."""
        return max(1, min(self.batch, self.seen_bytes // (nodes // 8 + 1)))


@dataclass
class Graph:
    """``layers[l]``: neighbours (-1: none) of every node; nodes not in the layer have none.

    Node ``k`` stands for the ids ``ids[bounds[k] : bounds[k + 1]]``, smallest first.
    """

    vectors: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray
    entry: int
    layers: list[np.ndarray]


_BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """The vectors times a power of two by which no square is too large, and that power.

    In single precision where they come so and no component is so small beside the largest that
    its square would vanish; else in double precision.
    """
    size = np.abs(vectors)
    most = float(size.max(initial=0))
    least = float(size.min(initial=most, where=size > 0))
    kind = np.float32 if vectors.dtype == np.float32 and least > 1e-12 * most else np.float64
    power = -int(np.frexp(most)[1])
    return np.ldexp(vectors.astype(np.float64), power).astype(kind), power


def distances(vectors: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own row of ``nodes`` (infinite where -1)."""
    out = np.full(nodes.shape, np.inf, vectors.dtype)
    row, place = np.nonzero(nodes >= 0)
    gaps = vectors[nodes[row, place]] - queries[row]
    out[row, place] = np.einsum("nd,nd->n", gaps, gaps)
    return out


def beam(vectors: np.ndarray, near: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int):
    """Best-first search of one layer for many queries: nodes and squared distances, nearest first.

    Each step expands every unfinished query's nearest node that was not expanded yet; a query
    is finished when all of its ``width`` best are.
    """
    n = len(queries)
    nodes = np.full((n, width), -1, np.int64)
    nodes[:, : start.shape[1]] = start[:, :width]
    dist = distances(vectors, queries, nodes)
    done = nodes < 0
    seen = np.zeros((n, len(vectors) // 8 + 1), np.uint8)  # one bit for each node
    row = np.arange(n)[:, None]

    def mark(rows: np.ndarray, found: np.ndarray) -> None:
        np.bitwise_or.at(seen, (rows, found >> 3), _BIT[found & 7])

    mark(row.repeat(start.shape[1], 1)[start >= 0], start[start >= 0])
    active = np.arange(n)
    while len(active):
        open_dist = np.where(done[active], np.inf, dist[active])
        pick = open_dist.argmin(axis=1)
        going = np.isfinite(open_dist[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        done[active, pick] = True
        fresh = near[nodes[active, pick]]
        known = (seen[active[:, None], fresh >> 3] & _BIT[fresh & 7] > 0) | (fresh < 0)
        fresh = np.where(known, -1, fresh)
        at, place = np.nonzero(fresh >= 0)
        mark(active[at], fresh[at, place])
        both = np.concatenate([nodes[active], fresh], axis=1)
        far = np.concatenate([dist[active], distances(vectors, queries[active], fresh)], axis=1)
        ready = np.concatenate([done[active], fresh < 0], axis=1)
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        nodes[active] = np.take_along_axis(both, order, 1)
        dist[active] = np.take_along_axis(far, order, 1)
        done[active] = np.take_along_axis(ready, order, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)


def spread_out(vectors: np.ndarray, nodes: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the base than to any chosen before.

    Places left are filled with the nearest of the others.
    """
    points = vectors[nodes]
    square = np.einsum("bcd,bcd->bc", points, points)
    apart = square[:, :, None] + square[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    chosen, held = np.zeros(nodes.shape, bool), np.zeros(len(nodes), np.int64)
    for k in range(nodes.shape[1]):
        clear = ~(chosen & (apart[:, k, :] < dist[:, k, None])).any(axis=1)
        chosen[:, k] = clear & (nodes[:, k] >= 0) & (held < most)
        held += chosen[:, k]
        if held.min() == most:
            break
    order = np.argsort(np.where(nodes < 0, 2, ~chosen), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(nodes, order, 1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def _connect(vectors: np.ndarray, near: np.ndarray, new: np.ndarray, nodes: np.ndarray, dist: np.ndarray) -> None:
    """Links ``new`` to the best of ``nodes`` and back; a full node keeps the best of all."""
    most = near.shape[1]
    near[new] = spread_out(vectors, nodes, dist, most)
    to = near[new]
    at, place = np.nonzero(to >= 0)
    target, source = to[at, place], new[at]
    order = np.lexsort((((vectors[source] - vectors[target]) ** 2).sum(axis=1), target))
    target, source = target[order], source[order]
    bases, first, counts = np.unique(target, return_index=True, return_counts=True)
    for lo in range(0, len(bases), 512):
        base = bases[lo : lo + 512]
        came = np.full((len(base), min(int(counts[lo : lo + 512].max()), most)), -1, np.int64)
        for k in range(came.shape[1]):  # the nearest of those that came
            has = counts[lo : lo + 512] > k
            came[has, k] = source[first[lo : lo + 512][has] + k]
        came[(came[:, :, None] == near[base][:, None, :]).any(axis=2)] = -1
        every = np.concatenate([near[base], came], axis=1)
        far = distances(vectors, vectors[base], every)
        sort = np.argsort(far, axis=1, kind="stable")
        near[base] = spread_out(vectors, np.take_along_axis(every, sort, 1), np.take_along_axis(far, sort, 1), most)


def build(ids: np.ndarray, vectors: np.ndarray, p: Params = Params()) -> Graph:
    """The graph of all rows; equal rows become one node."""
    unique, node = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, node.ravel()))
    bounds = np.append(0, np.cumsum(np.bincount(node.ravel(), minlength=len(unique))))
    rng = np.random.default_rng(p.seed)
    levels = np.minimum((-np.log(1 - rng.random(len(unique))) / np.log(p.links)).astype(int), 12)
    top = int(levels.max())
    turn = rng.permutation(len(unique))
    turn = turn[np.argsort(-levels[turn], kind="stable")]
    entry = int(turn[0])
    layers = [np.full((len(unique), p.links * (1 if level else 2)), -1, np.int64) for level in range(top + 1)]
    work, _ = scaled(unique)
    batch = p.together(len(unique))
    graph = Graph(unique, ids[order], bounds, entry, layers)
    for level in range(top, -1, -1):
        near, members, held = layers[level], turn[levels[turn] >= level], 1
        while held < len(members):
            new = members[held : held + min(batch, held)]
            start = descend(work, layers, entry, work[new], level)
            nodes, dist = beam(work, near, work[new], start, p.build)
            # of its own batch, each also sees the nearest
            points = work[new]
            square = (points**2).sum(axis=1)
            among = square[:, None] + square[None, :] - 2 * points @ points.T
            np.fill_diagonal(among, np.inf)
            k = min(p.links, len(new) - 1)
            if k > 0:
                peers = np.argpartition(among, k - 1, axis=1)[:, :k]
                nodes = np.concatenate([nodes, new[peers]], axis=1)
                dist = np.concatenate([dist, np.take_along_axis(among, peers, 1)], axis=1)
                sort = np.argsort(dist, axis=1, kind="stable")
                nodes, dist = np.take_along_axis(nodes, sort, 1), np.take_along_axis(dist, sort, 1)
            _connect(work, near, new, nodes, dist)
            held += len(new)
    return graph


def descend(vectors: np.ndarray, layers: list[np.ndarray], entry: int, queries: np.ndarray, level: int) -> np.ndarray:
    """A node near each query from which to search ``level``, found in the layers above it."""
    start = np.full((len(queries), 1), entry, np.int64)
    for above in range(len(layers) - 1, level, -1):
        start = beam(vectors, layers[above], queries, start, 4)[0][:, :1]
    return start


def exact(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances in double precision, the squares added in order of the components; no square overflows or vanishes."""
    most = max(float(np.abs(points).max(initial=0)), float(np.abs(queries).max(initial=0)))
    power = 0 if 1e-100 < most < 1e100 else -int(np.frexp(most)[1])
    points, queries = (np.ldexp(x.astype(np.float64), power) for x in (points, queries))
    total = np.zeros(len(points))
    for k in range(points.shape[1]):
        total += (queries[:, k] - points[:, k]) ** 2
    return np.ldexp(np.sqrt(total), -power)


def nearest(graph: Graph, query_ids: np.ndarray, queries: np.ndarray, k: int, p: Params = Params()):
    """(query id, id, distance) of the ``k`` nearest found for each query, its own id left out."""
    work, power = scaled(graph.vectors)
    out, batch = [], p.together(len(work))
    for lo in range(0, len(queries), batch):
        some = np.ldexp(queries[lo : lo + batch].astype(np.float64), power).astype(work.dtype)
        start = descend(work, graph.layers, graph.entry, some, 0)
        nodes, _ = beam(work, graph.layers[0], some, start, max(p.search, k + 1))
        row, place = np.nonzero(nodes >= 0)
        node = nodes[row, place]
        far = exact(queries[lo : lo + batch][row], graph.vectors[node])
        counts = np.minimum(graph.bounds[node + 1] - graph.bounds[node], k + 1)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found = graph.ids[np.repeat(graph.bounds[node], counts) + offset]
        row, far = np.repeat(row, counts), np.repeat(far, counts)
        own = query_ids[lo : lo + batch][row]
        other = found != own
        row, far, found, own = row[other], far[other], found[other], own[other]
        order = np.lexsort((found, far, row))
        row, far, found, own = row[order], far[order], found[order], own[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        out.append((own[rank < k], found[rank < k], far[rank < k]))
    return [np.concatenate(parts) for parts in zip(*out, strict=True)]
