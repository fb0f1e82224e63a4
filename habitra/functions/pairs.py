"""Sums of distances between places, in numpy."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Chebyshev nodes in each direction: far sums are then as exact as plain ones (about 1e-14 of a sum; 16 nodes give 3e-14, 12 give 1e-12).
NODES = 20
#: Cells of the finest level, and levels, at most: a cell holds 2 * NODES^2 numbers.
MOST_CELLS, DEEPEST = 1 << 13, 20
#: Numbers in a tile of pairs.
TILE, WIDTH = 1 << 15, 1 << 12
#: Seconds for a pair and for a cell of the finest level, about; they only choose that level.
PAIR_S, CELL_S = 2e-9, 3e-4


def pair_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, first: int = 0) -> np.ndarray:
    """For each place the sum of its distances to the others, each times the other's ``w``; if ``first``, only between the first so many and the rest."""
    if not first:
        return sums_to(x, y, x, y, w)
    a, b = slice(0, first), slice(first, None)
    return np.concatenate([sums_to(x[a], y[a], x[b], y[b], w[b]), sums_to(x[b], y[b], x[a], y[a], w[a])])


def sums_to(tx: np.ndarray, ty: np.ndarray, sx: np.ndarray, sy: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For each place ``tx, ty`` the sum of its distances to all ``sx, sy``, each times its ``w``: a fast multipole method.

    Places lie in cells of a quadtree.  Those of cells that touch meet one by
    one; between others distances are smooth, so that a cell's places are
    gathered in its nodes, nodes meet nodes, and places read their sums off
    their cell's nodes.  All pairs are summed, and the work grows with the
    places, not with the pairs, but for those crowded in a cell.
    """
    depth, x0, y0, side = finest(np.concatenate([tx, sx]), np.concatenate([ty, sy]), len(tx) * len(sx))
    if not depth:
        return plain_sums(tx, ty, sx, sy, w)
    m = 1 << depth

    def arranged(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        i, j = (cells(v, v0, side / m, m) for v, v0 in ((x, x0), (y, y0)))
        order = np.argsort(i * m + j, kind="stable")
        i, j, x, y = i[order], j[order], x[order], y[order]
        return order, i * m + j, x, y, basis(2 * ((x - x0) / (side / m) - i) - 1), basis(2 * ((y - y0) / (side / m) - j) - 1)

    order, at, tx, ty, along, up = arranged(tx, ty)
    asked = tree(np.unique(at), depth)
    sorder, sat, sx, sy, salong, sup = arranged(sx, sy)
    w = w[sorder]
    held = tree(np.unique(sat), depth)

    # gather, from the finest level upwards
    ends = np.searchsorted(sat, np.append(held[depth][0], m * m))
    gathered = {depth: np.array([(salong[a:z] * w[a:z, None]).T @ sup[a:z] for a, z in zip(ends, ends[1:])])}
    for level in range(depth - 1, 1, -1):
        gathered[level] = np.zeros((len(held[level][0]), NODES, NODES))
        each_child(held[level + 1][0], level + 1, lambda k, a, b, to=held[level + 1][1], out=gathered[level], below=gathered[level + 1]: out.__setitem__(to[k], out[to[k]] + a.T @ below[k] @ b))

    # meet, and hand down
    local = None
    for level in range(2, depth + 1):
        here, (keys, parent) = np.zeros((len(asked[level][0]), NODES, NODES)), asked[level]
        if local is not None:
            each_child(keys, level, lambda k, a, b, to=parent, out=here, above=local: out.__setitem__(k, a @ above[to[k]] @ b.T))
        local = meet(here, keys, held[level][0], gathered[level], level, side / (1 << level))

    ends = np.searchsorted(at, np.append(asked[depth][0], m * m))
    out = np.empty(len(tx))
    for c, (key, a, z) in enumerate(zip(asked[depth][0].tolist(), ends, ends[1:])):
        i, j = divmod(key, m)
        sums = ((along[a:z] @ local[c]) * up[a:z]).sum(1)
        for row in range(max(i - 1, 0), min(i + 2, m)):  # touching cells of a row are neighbours in the order
            lo, hi = np.searchsorted(sat, (row * m + max(j - 1, 0), row * m + min(j + 1, m - 1) + 1))
            if lo < hi:
                sums += plain_sums(tx[a:z], ty[a:z], sx[lo:hi], sy[lo:hi], w[lo:hi])
        out[order[a:z]] = sums
    return out


def plain_sums(tx: np.ndarray, ty: np.ndarray, sx: np.ndarray, sy: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The same by all pairs, in tiles."""
    out = np.zeros(len(tx))
    height = max(TILE // min(max(len(sx), 1), WIDTH), 1)
    for a in range(0, len(tx), height):
        for c in range(0, len(sx), WIDTH):
            dx = tx[a : a + height, None] - sx[None, c : c + WIDTH]
            dy = ty[a : a + height, None] - sy[None, c : c + WIDTH]
            np.square(dx, out=dx)
            np.square(dy, out=dy)
            np.add(dx, dy, out=dx)
            np.sqrt(dx, out=dx)
            out[a : a + height] += dx @ w[c : c + WIDTH]
    return out


def cells(v: np.ndarray, v0: float, side: float, m: int) -> np.ndarray:
    return np.minimum((v - v0) / side, m - 1).astype(np.int64)


def finest(x: np.ndarray, y: np.ndarray, pairs: int) -> tuple[int, float, float, float]:
    """The level that costs least (0: all pairs do), and the square of all cells."""
    x0, y0 = x.min(initial=np.inf), y.min(initial=np.inf)
    side = max(x.max(initial=-np.inf) - x0, y.max(initial=-np.inf) - y0)
    best, least = 0, pairs * PAIR_S
    if np.isfinite(side) and side > 0:  # a NaN spoils the minimum too
        for depth in range(2, DEEPEST + 1):
            m = 1 << depth
            count = np.unique(cells(x, x0, side / m, m) * m + cells(y, y0, side / m, m), return_counts=True)[1].astype(float)
            if len(count) > MOST_CELLS:
                break
            cost = 9 * PAIR_S * pairs * (count @ count) / len(x) ** 2 + CELL_S * len(count)
            if cost < least:
                best, least = depth, cost
    return best, x0, y0, side


def tree(keys: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray | None]]:
    """By level the keys of cells with places, and where each one's parent stands."""
    out = {}
    for level in range(depth, 1, -1):
        i, j = np.divmod(keys, 1 << level)
        above, parent = np.unique((i // 2 << level - 1) + j // 2, return_inverse=True)
        out[level] = keys, parent
        keys = above
    return out


def basis(u: np.ndarray) -> np.ndarray:
    """Values at ``u`` (-1 to 1) of the polynomials that are 1 at one node and 0 at the others."""
    scale = np.where(np.arange(NODES), 2 / NODES, 1 / NODES)
    return np.polynomial.chebyshev.chebvander(u, NODES - 1) * scale @ np.polynomial.chebyshev.chebvander(nodes(), NODES - 1).T


def nodes() -> np.ndarray:
    return np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)


@lru_cache
def halves() -> tuple[np.ndarray, np.ndarray]:
    """A parent's polynomials at the nodes of its lower and its upper child."""
    return basis((nodes() - 1) / 2), basis((nodes() + 1) / 2)


@lru_cache(maxsize=None)
def between(i: int, j: int) -> np.ndarray:
    """Distances from the nodes of the cell so many cells on to those of a cell, in sides; 40 of 1.3 MB."""
    c = nodes() / 2
    dx, dy = (i + c)[:, None] - c, (j + c)[:, None] - c
    return np.sqrt(dx[:, None, :, None] ** 2 + dy[None, :, None, :] ** 2).reshape(NODES**2, NODES**2)


def each_child(keys: np.ndarray, level: int, do: Callable) -> None:
    """``do(which, a, b)`` for the children in each quarter of their parents."""
    i, j = np.divmod(keys, 1 << level)
    for a in (0, 1):
        for b in (0, 1):
            which = np.flatnonzero((i % 2 == a) & (j % 2 == b))
            do(which, halves()[a], halves()[b])


def meet(here: np.ndarray, keys: np.ndarray, held: np.ndarray, gathered: np.ndarray, level: int, side: float) -> np.ndarray:
    """Adds what comes from cells that don't touch, of parents that do."""
    m, (i, j) = 1 << level, np.divmod(keys, 1 << level)
    for di in range(-3, 4):
        for dj in range(-3, 4):
            if max(abs(di), abs(dj)) > 1:
                p, q = i + di, j + dj
                near = (p >= 0) & (p < m) & (q >= 0) & (q < m) & (abs(p // 2 - i // 2) < 2) & (abs(q // 2 - j // 2) < 2)
                where = np.minimum(np.searchsorted(held, p * m + q), len(held) - 1)
                t = np.flatnonzero(near & (held[where] == p * m + q))
                if len(t):
                    here[t] += side * (gathered[where[t]].reshape(len(t), -1) @ between(di, dj)).reshape(len(t), NODES, NODES)
    return here
