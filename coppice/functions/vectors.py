"""Distances, linkage updates and the edge order as Spark columns."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

Linkage = Literal["single", "complete", "average"]
LINKAGES = ("single", "complete", "average")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def euclidean_squared(x: Column | str, y: Column | str) -> Column:
    """Sum of squared differences, added in dimension order."""
    squares = F.zip_with(_col(x), _col(y), lambda p, q: (p - q) * (p - q))
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)


def euclidean(x: Column | str, y: Column | str) -> Column:
    return F.sqrt(euclidean_squared(x, y))


def lance_williams(
    d_ac: Column | str,
    d_bc: Column | str,
    size_a: Column | str,
    size_b: Column | str,
    linkage: Linkage,
) -> Column:
    """Distance from the union of clusters a and b to a third cluster c."""
    check_linkage(linkage)
    d_ac, d_bc = _col(d_ac), _col(d_bc)
    if linkage == "single":
        return F.least(d_ac, d_bc)
    if linkage == "complete":
        return F.greatest(d_ac, d_bc)
    size_a, size_b = _col(size_a), _col(size_b)
    return (size_a * d_ac + size_b * d_bc) / (size_a + size_b)


def check_linkage(linkage: str) -> str:
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}, got {linkage!r}")
    return linkage


def edge_key(w: Column | str, u: Column | str, v: Column | str) -> Column:
    """A struct whose natural order is (weight, smaller end, larger end)."""
    u, v = _col(u), _col(v)
    return F.struct(
        _col(w).alias("w"), F.least(u, v).alias("u"), F.greatest(u, v).alias("v")
    )
