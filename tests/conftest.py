import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from coppice.session import local_session  # noqa: E402

# Ten points with many equal distances, traced by hand.
HAND_TRACE = [(0, 0), (1, 0), (0, 1), (3, 0), (4, 1), (3, 3), (0, 4), (1, 4), (5, 4), (5, 0)]


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make_points(spark):
    def make(rows, ids=None):
        rows = [[float(x) for x in row] for row in rows]
        ids = range(len(rows)) if ids is None else [int(i) for i in ids]
        table = spark.createDataFrame(list(zip(ids, rows)), "id long, features array<double>")
        return table.coalesce(2)

    return make


def pair_list(rows, ids):
    """All (w, u, v), squares added in dimension order."""
    out = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            total = 0.0
            for a, b in zip(rows[i], rows[j]):
                total += (float(a) - float(b)) * (float(a) - float(b))
            u, v = sorted((int(ids[i]), int(ids[j])))
            out.append((float(np.sqrt(total)), u, v))
    return sorted(out)


def kruskal(rows, ids):
    """Tree edges and dendrogram rows by taking the edges in order."""
    number = {int(p): k for k, p in enumerate(sorted(ids))}
    slot = {int(p): int(p) for p in ids}
    name = {int(p): number[int(p)] for p in ids}
    size = {int(p): 1 for p in ids}
    edges, merges = [], []
    for w, u, v in pair_list(rows, ids):
        a, b = slot[u], slot[v]
        if a == b:
            continue
        lo, hi = min(a, b), max(a, b)
        edges.append((u, v, w))
        merges.append((len(merges), lo, hi, name[a], name[b], w, size[a] + size[b]))
        name[lo], size[lo] = len(ids) + len(merges) - 1, size[a] + size[b]
        slot = {p: lo if s == hi else s for p, s in slot.items()}
    return sorted(edges), merges


def greedy(rows, ids, linkage):
    """The nearest pair of clusters first, ties to the smaller slots."""
    ids = [int(p) for p in ids]
    order = sorted(ids)
    name = {p: k for k, p in enumerate(order)}
    size = dict.fromkeys(ids, 1)
    dist = {(u, v): w for w, u, v in pair_list(rows, ids)}
    merges = []
    while dist:
        (a, b), w = min(dist.items(), key=lambda kv: (round(kv[1], 9), kv[0]))
        merges.append((len(merges), a, b, name[a], name[b], w, size[a] + size[b]))
        del dist[a, b]
        for c in [p for p in size if p not in (a, b)]:
            ac, bc = dist[min(a, c), max(a, c)], dist.pop((min(b, c), max(b, c)))
            if linkage == "complete":
                d = max(ac, bc)
            else:
                d = (size[a] * ac + size[b] * bc) / (size[a] + size[b])
            dist[min(a, c), max(a, c)] = d
        size[a] += size.pop(b)
        name[a] = len(ids) + len(merges) - 1
    return merges


def rows_of(df, order="step"):
    return [tuple(r) for r in df.orderBy(order).collect()]


def same_merges(found, wanted):
    """Equal rows, heights up to rounding."""
    assert [r[:5] + r[6:] for r in found] == [r[:5] + r[6:] for r in wanted]
    np.testing.assert_allclose([r[5] for r in found], [r[5] for r in wanted], rtol=1e-12)
