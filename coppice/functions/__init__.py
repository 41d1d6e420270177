"""Column functions and the small array helpers that run inside tasks."""

from coppice.functions.classify import (
    command_line,
    dataset_source,
    implementation_type,
    is_mst,
    missing_as_empty,
    parse_runtime,
    ratio,
    short_error,
    stamp,
)
from coppice.functions.vectors import edge_key, euclidean, euclidean_squared, lance_williams

__all__ = [
    "command_line",
    "dataset_source",
    "edge_key",
    "euclidean",
    "euclidean_squared",
    "implementation_type",
    "is_mst",
    "lance_williams",
    "missing_as_empty",
    "parse_runtime",
    "ratio",
    "short_error",
    "stamp",
]
