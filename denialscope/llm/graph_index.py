"""Robust-pruned directed graph over the vectors of one shard, in NumPy.

Vectors are unit rows, so the larger the inner product, the nearer. A search
keeps the ``beam`` nearest nodes it has met, for every query of a batch at
once: each step expands the nearest unexpanded nodes of all queries that still
have one, looks up their neighbours, and merges the new ones in; queries whose
whole beam is expanded leave the batch. Nodes are inserted in batches: a greedy
search in the graph so far proposes neighbours, and pruning keeps the nearest
one, drops every other that is ``slack`` times nearer to it than to the node,
keeps the nearest of the rest, and so on, which leaves few edges in many
directions. Kept edges go both ways, and a node with too many is pruned by the
same rule. A second pass proposes again for every node in the whole graph.
"""

from __future__ import annotations

import numpy as np

DEGREE = 32
SLACK = 1.2
BUILD_BEAM = 48
ENTRIES = 8
POOL = 96            # candidates that one pruning looks at, the nearest ones
EXPAND = 2           # nodes a query expands in a step
BATCH = 512
CELLS = 1 << 24      # numbers in a work array


def top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest of each row, the largest first; ties in the
    order of the columns."""
    return np.argsort(-sims, axis=1, kind="stable")[:, :k]


def search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int, keep_path: bool = False):
    """Ids (-1: none) and similarities of the nodes found nearest to each row
    of ``q``, best first; with ``keep_path`` also the nodes expanded."""
    m, n = len(q), len(x)
    ids = np.full((m, beam), -1, np.int32)
    sims = np.full((m, beam), -np.inf, np.float32)
    first = entries[:beam]
    start = q @ x[first].T
    order = top(start, beam)
    ids[:, :len(first)] = first[order]
    sims[:, :len(first)] = np.take_along_axis(start, order, 1)
    path = []
    todo = np.arange(m)
    # column n stands for "no neighbour" and counts as seen
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True
    seen[:, first] = True
    done = ids < 0
    a_ids, a_sims, a_done, a_q, a_seen = ids.copy(), sims.copy(), done, q, seen
    while len(todo):
        rank = np.where(a_done, beam, np.arange(beam))
        pick = np.sort(np.partition(rank, EXPAND - 1, axis=1)[:, :EXPAND], axis=1) if beam > EXPAND else np.sort(rank, axis=1)
        live = pick[:, 0] < beam
        if not live.all():
            out = ~live
            ids[todo[out]], sims[todo[out]] = a_ids[out], a_sims[out]
            todo, pick = todo[live], pick[live]
            a_ids, a_sims, a_done, a_q, a_seen = a_ids[live], a_sims[live], a_done[live], a_q[live], a_seen[live]
            if not len(todo):
                break
        rows = np.arange(len(todo))[:, None]
        real = pick < beam
        at = np.minimum(pick, beam - 1)
        nodes = np.where(real, a_ids[rows, at], -1)
        a_done[np.nonzero(real)[0], pick[real]] = True
        if keep_path:
            path.append((todo, nodes))
        found = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(todo), -1)
        col = np.where(found < 0, n, found)
        fresh = ~a_seen[rows, col]
        a_seen[rows, col] = True
        if nodes.shape[1] > 1:  # a neighbour of several expanded nodes counts once
            order = np.argsort(col, axis=1, kind="stable")
            ordered = np.take_along_axis(col, order, 1)
            again = np.zeros_like(fresh)
            np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            fresh &= ~again
        got = np.full(col.shape, -np.inf, np.float32)
        r, c = np.nonzero(fresh)
        got[r, c] = np.einsum("ij,ij->i", x[col[r, c]], a_q[r])
        all_sims = np.concatenate([a_sims, got], axis=1)
        order = top(all_sims, beam)
        a_sims = np.take_along_axis(all_sims, order, 1)
        a_ids = np.take_along_axis(np.concatenate([a_ids, np.where(fresh, col, -1)], axis=1).astype(np.int32), order, 1)
        a_done = np.take_along_axis(np.concatenate([a_done, ~fresh], axis=1), order, 1) | (a_ids < 0)
    if not keep_path:
        return ids, sims
    steps = np.full((m, EXPAND * len(path)), -1, np.int32)
    for k, (who, nodes) in enumerate(path):
        steps[who, EXPAND * k:EXPAND * k + nodes.shape[1]] = nodes
    return ids, sims, steps


def prune(x: np.ndarray, nodes: np.ndarray, pool: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node out of its ``pool``
    (-1: none); the node itself and repeated ids are passed over."""
    out = np.full((len(nodes), degree), -1, np.int32)
    step = max(1, CELLS // (pool.shape[1] * x.shape[1]))
    for a in range(0, len(nodes), step):
        who, c = nodes[a:a + step], pool[a:a + step]
        sims = np.matmul(x[c], x[who][:, :, None])[:, :, 0]
        sims[(c < 0) | (c == who[:, None])] = -np.inf
        order = top(sims, POOL)
        c, sims = np.take_along_axis(c, order, 1), np.take_along_axis(sims, order, 1)
        xc = x[c]
        away = 2 - 2 * sims
        between = 2 - 2 * np.matmul(xc, xc.transpose(0, 2, 1))
        alive = np.isfinite(sims)
        rows = np.arange(len(who))
        for k in range(degree):
            best = alive.argmax(axis=1)
            some = alive[rows, best]
            if not some.any():
                break
            out[a + rows[some], k] = c[rows[some], best[some]]
            alive &= ~((slack * slack * between[rows, best] <= away) & some[:, None])
            alive[rows, best] = False
            # the same id again is at no distance, whatever rounding says
            alive &= ~((c == c[rows, best][:, None]) & some[:, None])
    return out


def link_back(x: np.ndarray, graph: np.ndarray, nodes: np.ndarray, slack: float) -> None:
    """Add the reverse of the edges of ``nodes``; prune where they don't fit."""
    degree = graph.shape[1]
    to, src = graph[nodes].ravel(), np.repeat(nodes, degree)
    src, to = src[to >= 0], to[to >= 0]
    known = (graph[to] == src[:, None]).any(axis=1)
    src, to = src[~known], to[~known]
    order = np.argsort(to, kind="stable")
    src, to = src[order], to[order]
    who, start, count = np.unique(to, return_index=True, return_counts=True)
    have = (graph[who] >= 0).sum(axis=1)
    slot = np.arange(len(to)) - np.repeat(start, count)
    fits = have + count <= degree
    easy = np.repeat(fits, count)
    graph[to[easy], (np.repeat(have, count) + slot)[easy]] = src[easy]
    hard = np.flatnonzero(~fits)
    hard = hard[np.argsort(count[hard], kind="stable")]
    for part in np.array_split(hard, max(1, -(-len(hard) // BATCH))):
        if len(part):
            wide = np.full((len(part), count[part].max()), -1, np.int32)
            for k, g in enumerate(part):
                wide[k, :count[g]] = src[start[g]:start[g] + count[g]]
            graph[who[part]] = prune(x, who[part], np.concatenate([graph[who[part]], wide], axis=1), degree, slack)


def reached(graph: np.ndarray, entries: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(graph), bool)
    front = np.unique(entries)
    while len(front):
        seen[front] = True
        nxt = np.unique(graph[front])
        nxt = nxt[nxt >= 0]
        front = nxt[~seen[nxt]]
    return seen


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, slack: float = SLACK, seed: int = 42):
    """Graph (rows of neighbours, -1: none) and entry nodes of unit rows ``x``."""
    n = len(x)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n).astype(np.int32)
    graph = np.full((n, degree), -1, np.int32)
    entries = order[:ENTRIES]
    done = min(n, max(ENTRIES, degree * 2))
    head = order[:done]
    graph[head] = prune(x, head, np.tile(head, (done, 1)), degree, slack)
    link_back(x, graph, head, slack)

    def propose(nodes):
        # the work array of seen nodes is len(nodes) x n
        for a in range(0, len(nodes), step := max(1, min(BATCH, CELLS // (n + 1)))):
            part = nodes[a:a + step]
            ids, _, steps = search(x, graph, entries, x[part], beam, keep_path=True)
            yield part, np.concatenate([ids, steps, graph[part]], axis=1)

    while done < n:
        size = min(n - done, max(1, min(BATCH, done // 2)))
        for part, pool in propose(order[done:done + size]):
            graph[part] = prune(x, part, pool, degree, slack)
            link_back(x, graph, part, slack)
        done += size
    if n > 1:
        mean = x.mean(axis=0)
        entries = np.unique(np.append(entries, (x @ mean).argmax())).astype(np.int32)
    for part, pool in propose(order):
        graph[part] = prune(x, part, pool, degree, slack)
        link_back(x, graph, part, slack)
    # a node that no path leads to gets one from the nearest that has
    while not (seen := reached(graph, entries)).all():
        lost = np.flatnonzero(~seen)[:BATCH]
        ids, _ = search(x, graph, entries, x[lost], beam)
        parents, which = np.unique(ids[:, 0], return_index=True)
        free = (graph[parents] < 0).any(axis=1)
        if not free.all():
            graph = np.concatenate([graph, np.full((n, 1), -1, np.int32)], axis=1)
        graph[parents, (graph[parents] < 0).argmax(axis=1)] = lost[which]
    return graph, entries
