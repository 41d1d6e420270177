"""Numpy helpers for one bounded block or pair of blocks inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CACHE_CELLS = 65_536
SPARSE_SHARE = 8  # candidate bridges per point up to which a sorted pass is faster


def columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def coordinates(table: pa.Table, name: str = "features") -> np.ndarray:
    """The array column as an (n, d) matrix."""
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def edge_table(u, v, w, names: tuple[str, str, str] = ("u", "v", "w")) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, (u, v, w), kinds)})


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; squares are added in dimension order, as a row loop would."""
    out = np.zeros((len(x), len(y)))
    by_dim = np.ascontiguousarray(y.T)
    step = max(1, CACHE_CELLS // max(1, len(y)))
    scratch = np.empty((min(step, len(x)), len(y)))
    for lo in range(0, len(x), step):
        part = x[lo : lo + step]
        total = out[lo : lo + step]
        work = scratch[: len(part)]
        for k in range(by_dim.shape[0]):
            np.subtract(part[:, k, None], by_dim[k], out=work)
            np.multiply(work, work, out=work)
            total += work
        np.sqrt(total, out=total)
    return out


SCREEN_DIMS = 8  # from so many dimensions on a matrix product is faster than sums by dimension


def paired_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of row k of both, added like those of ``distances``."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        d = x[:, k] - y[:, k]
        total += d * d
    return np.sqrt(total)


def rough_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Squared distances by one matrix product, and how far one can be from the square of ``distances``.

    None where sums by dimension are as fast, or where the squares leave the range of doubles.
    """
    if x.shape[1] < SCREEN_DIMS:
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        xx, yy = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        # Of a product of d terms the rounding is below d * eps * (xx + yy) / 2; norms and sums add as much again.
        largest = float(xx.max() + yy.max())
        slack = 8 * (x.shape[1] + 8) * np.finfo(float).eps * largest + 1e-300
        if not np.isfinite(4 * largest):
            return None
        out = x @ y.T
        out *= -2.0
        out += xx[:, None]
        out += yy[None, :]
    return out, slack


def nearest_rows(x: np.ndarray, y: np.ndarray, same: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """Position and distance of the nearest row of y for each row of x, then of x for each of y.

    Ties go to the first row. With ``same`` x is y, no row is its own neighbour, and only
    the first answer is given. Candidates come out of rough squares, distances do not.
    """
    rough = rough_squares(x, y)
    if rough is None:
        dist = distances(x, y)
        if same:
            np.fill_diagonal(dist, np.inf)
        ways = (dist,) if same else (dist, dist.T)
        return [((at := d.argmin(axis=1)), d[np.arange(len(at)), at]) for d in ways]
    squares, slack = rough
    if same:
        np.fill_diagonal(squares, np.inf)
    out = []
    for table, a, b in ((squares, x, y),) if same else ((squares, x, y), (squares.T, y, x)):
        i, j = np.nonzero(table <= table.min(axis=1)[:, None] + 2 * slack)
        if same:
            i, j = i[i != j], j[i != j]
        w = paired_distances(a[i], b[j])
        order = np.lexsort((j, w, i))
        first = order[np.searchsorted(i[order], np.arange(len(a)))] if len(i) else order
        if len(first) < len(a):  # a single row has no other
            out.append((np.zeros(len(a), dtype=np.int64), np.full(len(a), np.inf)))
        else:
            out.append((j[first], w[first]))
    return out


def _lightest(best: np.ndarray, source: np.ndarray, ids: np.ndarray) -> int:
    """Position of the lightest waiting edge; ties go to the smaller end pair."""
    y = int(best.argmin())
    tied = np.flatnonzero(best == best[y])
    if tied.size > 1:
        lo = np.minimum(ids[tied], source[tied])
        hi = np.maximum(ids[tied], source[tied])
        y = int(tied[np.lexsort((hi, lo))[0]])
    return y


def block_tree(dist: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum spanning tree of one block as (parent id, weight) per point.

    The first point is the root: parent -1. Two edges that share an end compare
    by their other ends, so ``ids[x] < source`` settles a tie of equal weights.
    """
    n = len(ids)
    parent = np.full(n, -1, dtype=np.int64)
    weight = np.zeros(n)
    best = np.full(n, np.inf)
    source = np.full(n, -1, dtype=np.int64)
    waiting = np.ones(n, dtype=bool)
    x = 0
    for _ in range(n - 1):
        waiting[x] = False
        best[x] = np.inf
        row = dist[x]
        nearer = waiting & ((row < best) | ((row == best) & (ids[x] < source)))
        best[nearer] = row[nearer]
        source[nearer] = ids[x]
        x = _lightest(best, source, ids)
        parent[x], weight[x] = source[x], best[x]
    return parent, weight


def bottlenecks(ids: np.ndarray, parent: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The longest edge between each point and the busiest one of its block's tree."""
    order = np.argsort(ids)
    kids = np.flatnonzero(parent != -1)
    ups = order[np.searchsorted(ids[order], parent[kids])]
    near: list[list[tuple[int, float]]] = [[] for _ in range(len(ids))]
    for p, q, w in zip(kids.tolist(), ups.tolist(), weight[kids].tolist()):
        near[p].append((q, w))
        near[q].append((p, w))
    longest = np.full(len(ids), -1.0)
    first = max(range(len(ids)), key=lambda p: len(near[p]))
    longest[first] = 0.0
    stack = [(first, 0.0)]
    while stack:
        p, so_far = stack.pop()
        for q, w in near[p]:
            if longest[q] < 0:
                longest[q] = w if w > so_far else so_far
                stack.append((q, longest[q]))
    return longest


Side = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def bridges(left: Side, right: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges between two blocks that are in the spanning tree of their union.

    A side is ``coordinates, ids, parents, weights, bottlenecks``. Inside each block only
    its tree edges can be in that tree. With one edge between the blocks at hand, two points
    are joined through it and the busiest points of both blocks: an edge longer than all of
    that way is not in the tree, so only the others are candidates.
    """
    (x, *tree_a), (y, *tree_b) = left, right
    (ids_a, up_a, w_a, far_a), (ids_b, up_b, w_b, far_b) = tree_a, tree_b
    ids, parents, weights = (ids_a, ids_b), (up_a, up_b), (w_a, w_b)
    rough = rough_squares(x, y)
    table, slack = rough if rough is not None else (distances(x, y), 0.0)

    def length(p: int, q: int) -> float:
        return float(paired_distances(x[p : p + 1], y[q : q + 1])[0])

    # The lightest edge, or the lightest one between points that hang closely on their blocks.
    close = np.flatnonzero(far_a <= np.median(far_a)), np.flatnonzero(far_b <= np.median(far_b))
    ways = [divmod(int(table.argmin()), len(y))]
    p, q = divmod(int(table[np.ix_(*close)].argmin()), len(close[1]))
    ways.append((int(close[0][p]), int(close[1][q])))
    through = min(max(length(p, q), far_a[p], far_b[q]) for p, q in ways)
    limit_a, limit_b = np.maximum(far_a, through), np.maximum(far_b, through)
    if rough is not None:
        limit_a, limit_b = (limit_a**2 * (1 + 1e-12) + slack, limit_b**2 * (1 + 1e-12) + slack)
    i, j = np.nonzero((table <= limit_a[:, None]) | (table <= limit_b[None, :]))
    if i.size <= SPARSE_SHARE * sum(table.shape):
        w = table[i, j] if rough is None else paired_distances(x[i], y[j])
        return _sparse_bridges(w, ids, parents, weights, i, j)
    return _dense_bridges(table if rough is None else distances(x, y), ids, parents, weights)


def lightest_forest(u: np.ndarray, v: np.ndarray, w: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions, among ``wanted``, of the edges in the spanning forest of all edges given."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)].tolist(), ends[len(u) :].tolist()
    top = list(range(len(names)))

    def root(p: int) -> int:
        while top[p] != p:
            top[p] = top[top[p]]
            p = top[p]
        return p

    taken = []
    for k in np.lexsort((v, u, w)).tolist():
        p, q = root(a[k]), root(b[k])
        if p != q:
            top[max(p, q)] = min(p, q)
            taken.append(k)
    taken = np.array(taken, dtype=np.int64)
    return taken[wanted[taken]]


def _sparse_bridges(found, ids, parents, weights, i, j):
    """Few candidates: take them and the tree edges in order of weight."""
    names = np.concatenate(ids)
    kids = np.flatnonzero(np.concatenate(parents) != -1)
    x, y = names[kids], np.concatenate(parents)[kids]
    x, y = np.concatenate([x, ids[0][i]]), np.concatenate([y, ids[1][j]])
    w = np.concatenate([np.concatenate(weights)[kids], found])
    lo, hi = np.minimum(x, y), np.maximum(x, y)
    taken = lightest_forest(lo, hi, w, np.arange(len(w)) >= len(kids))
    return lo[taken], hi[taken], w[taken]


def _dense_bridges(dist, ids, parents, weights):
    """Many candidates: grow one tree over the distance table and both block trees."""
    a, b = dist.shape
    names = np.concatenate(ids)
    position = {int(p): i for i, p in enumerate(names)}
    near: list[list[tuple[int, float]]] = [[] for _ in range(a + b)]
    for i, (p, w) in enumerate(zip(np.concatenate(parents), np.concatenate(weights))):
        if p != -1:
            j = position[int(p)]
            near[i].append((j, w))
            near[j].append((i, w))
    across = np.ascontiguousarray(dist.T)
    best = np.full(a + b, np.inf)
    source = np.full(a + b, -1, dtype=np.int64)
    waiting = np.ones(a + b, dtype=bool)
    left = np.arange(a + b) < a
    lo, hi, w = [], [], []
    x = 0
    for _ in range(a + b - 1):
        waiting[x] = False
        best[x] = np.inf
        me = names[x]
        side, row = (slice(a, a + b), dist[x]) if x < a else (slice(0, a), across[x - a])
        so_far, via = best[side], source[side]
        nearer = waiting[side] & ((row < so_far) | ((row == so_far) & (me < via)))
        so_far[nearer] = row[nearer]
        via[nearer] = me
        for y, length in near[x]:
            if waiting[y] and (length < best[y] or (length == best[y] and me < source[y])):
                best[y], source[y] = length, me
        x = _lightest(best, source, names)
        if left[x] != left[position[int(source[x])]]:
            lo.append(min(names[x], source[x]))
            hi.append(max(names[x], source[x]))
            w.append(best[x])
    return np.array(lo, dtype=np.int64), np.array(hi, dtype=np.int64), np.array(w, dtype=float)
