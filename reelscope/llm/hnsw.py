"""Hierarchical navigable small-world graph of one shard, in numpy.

The graph is flat arrays: nodes in order of falling level, so that layer
``l`` is the first ``sizes[l]`` nodes, and per layer an array of neighbours
with -1 for none. Layers are built from the top (each is the entry to the one
below), nodes in batches: a batch searches the layer as it is, its members
also see each other. Searches keep the ``ef`` nearest nodes per query and
expand several of them at once, for all queries of a batch together.
"""

from __future__ import annotations

import numpy as np

DEGREE = 16
EF_BUILD = 64
EF_SEARCH = 200
BATCH = 256
AT_ONCE = 4


def levels(ids: np.ndarray) -> np.ndarray:
    """Level per id, geometric with ratio 1/DEGREE, from a hash of the id."""
    h = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) + 0.5
    return np.floor(-np.log(u / 2.0 ** 53) / np.log(DEGREE)).astype(int)


def _apart(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of queries (B, d) to nodes (B, m), from differences:
    nothing cancels, however far from the origin the vectors are."""
    apart = x[ids]
    apart -= q[:, None, :]
    return np.einsum("bmd,bmd->bm", apart, apart)


def beam(x, graph, q, entry, ef):
    """``(ids, distances)`` of the ``ef`` nearest found, sorted; -1 for none."""
    b, n = len(q), len(graph)
    ef = min(ef, n)
    ids = np.full((b, ef), -1, np.int32)
    dist = np.full((b, ef), np.inf, np.float32)
    done = np.ones((b, ef), bool)
    ids[:, 0], dist[:, 0], done[:, 0] = entry, _apart(x, entry[:, None], q)[:, 0], False
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # where -1 points
    seen[np.arange(b), entry] = True
    live = np.arange(b)
    while len(live):
        todo = ~done[live]
        nth = np.cumsum(todo, 1)
        todo &= nth <= AT_ONCE
        row, col = np.nonzero(todo)
        slot = nth[row, col] - 1
        near = np.full((len(live), AT_ONCE, graph.shape[1]), -1, np.int32)
        near[row, slot] = graph[ids[live[row], col]]
        done[live[row], col] = True
        near = near.reshape(len(live), -1)
        near.sort(axis=1)
        new = ~seen[live[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        seen[:, n] = True
        d = np.where(new, _apart(x, near, q[live]), np.inf).astype(np.float32)
        all_d = np.concatenate([dist[live], d], 1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
        dist[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], 1), best, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~new], 1), best, 1)
        done[live] |= ~np.isfinite(dist[live])
        live = live[~done[live].all(1)]
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def _choose(x, ids, dist, most):
    """Up to ``most`` of the candidates (rows sorted by distance, -1 last):
    first those nearer to the node than to any chosen one, then the nearest."""
    v = x[ids]
    v -= v[:, :1].copy()  # around the nearest, so that little cancels
    norms = (v * v).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    keep = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        near = (keep & (between[:, c, :] < dist[:, c, None])).any(1)
        keep[:, c] = (ids[:, c] >= 0) & ~near & (keep.sum(1) < most)
    rank = np.where(ids < 0, 2, np.where(keep, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out.astype(np.int32)


def _sorted(ids, dist):
    order = np.argsort(np.where(ids < 0, np.inf, dist), axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def _link_back(x, graph, sources, targets):
    """Adds each source to its targets' neighbours, choosing anew where full."""
    most = graph.shape[1]
    src = np.repeat(sources, targets.shape[1])
    dst = targets.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    by_count = np.argsort(count, kind="stable")
    for at in range(0, len(nodes), BATCH):
        part = by_count[at:at + BATCH]
        widest = int(count[part].max())
        added = np.full((len(part), widest), -1, np.int32)
        row = np.repeat(np.arange(len(part)), count[part])
        col = np.arange(len(row)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        added[row, col] = src[np.repeat(first[part], count[part]) + col]
        own = nodes[part]
        ids = np.concatenate([graph[own], added], 1)
        dist = np.where(ids < 0, np.inf, _apart(x, ids, x[own]))
        ids, dist = _sorted(ids, dist)
        ids, dist = ids[:, :3 * most], dist[:, :3 * most]
        full = (ids >= 0).sum(1) > most
        new = np.full((len(part), most), -1, np.int32)
        width = min(most, ids.shape[1])
        new[:, :width] = ids[:, :width]
        if full.any():
            new[full] = _choose(x, ids[full], dist[full], most)
        graph[own] = new


def build(x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Neighbour arrays per layer, lowest first, over float32 vectors in
    order of falling level; layer ``l`` holds the first ``sizes[l]``."""
    layers: list[np.ndarray] = []  # top first
    for layer in range(len(sizes) - 1, -1, -1):
        n = sizes[layer]
        graph = np.full((n, DEGREE * (2 if layer == 0 else 1)), -1, np.int32)
        at = 0
        while at < n:
            step = min(n - at, BATCH, max(at, 32))
            own = np.arange(at, at + step)
            q = x[own]
            if at:
                entry = descend(x, layers, q)
                entry[entry >= at] = 0  # a node of the layer above that is yet to come
                ids, dist = beam(x, graph[:at], q, entry, EF_BUILD)
            else:
                ids, dist = np.zeros((step, 0), np.int32), np.zeros((step, 0), np.float32)
            mates = _apart(x, np.broadcast_to(own, (step, step)), q)
            np.fill_diagonal(mates, np.inf)
            some = min(step - 1, EF_BUILD // 2)
            pick = np.argsort(mates, axis=1, kind="stable")[:, :some]
            ids = np.concatenate([ids, own[pick].astype(np.int32)], 1)
            dist = np.concatenate([dist, np.take_along_axis(mates, pick, 1)], 1)
            ids, dist = _sorted(ids, dist)
            if ids.shape[1]:
                chosen = _choose(x, ids[:, :EF_BUILD], dist[:, :EF_BUILD], DEGREE)
                graph[own, :DEGREE] = chosen
                _link_back(x, graph, own, chosen)
            at += step
        layers.append(graph)
    return layers[::-1]


def descend(x, layers_top_first, q):
    """The node from which each query enters the next layer."""
    entry = np.zeros(len(q), np.int64)
    for graph in layers_top_first:
        ids, _ = beam(x, graph, q, entry, 4)
        entry = ids[:, 0].astype(np.int64)
    return entry


def search(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
    """Ids of the nearest nodes found per query, sorted by distance, -1 for none."""
    out = []
    for i in range(0, len(q), BATCH):
        part = q[i:i + BATCH]
        entry = descend(x, layers[:0:-1], part)
        ids, _ = beam(x, layers[0], part, entry, ef)
        out.append(np.pad(ids, ((0, 0), (0, ef - ids.shape[1])), constant_values=-1))
    return np.concatenate(out) if out else np.zeros((0, ef), np.int32)
