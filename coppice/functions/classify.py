"""Column functions over benchmark run logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The known dataset names, their sources, and the runtime pattern.
STRUCTURED_SETS = ["donut3", "complex9", "diamond9"]
STRUCTURED_SOURCE = "milaan9 structured dataset"
DIGITS_SET = "optdigits"
DIGITS_SOURCE = "UCI Optical Recognition of Handwritten Digits"
RANDOM_PREFIX = "random_n"
RANDOM_SOURCE = "synthetic random 2D dataset"
UNKNOWN_SOURCE = "unknown"
RUNTIME_PATTERN = r"runtime_ms:\s*([0-9.eE+-]+)"
ERROR_LENGTH = 300
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dataset_source(dataset: Column | str) -> Column:
    name = _col(dataset)
    return (
        F.when(name.isin(STRUCTURED_SETS), STRUCTURED_SOURCE)
        .when(name == DIGITS_SET, DIGITS_SOURCE)
        .when(name.startswith(RANDOM_PREFIX), RANDOM_SOURCE)
        .otherwise(UNKNOWN_SOURCE)
    )


def implementation_type(executable: Column | str) -> Column:
    return F.when(F.lower(_col(executable)).contains("cuda"), "cuda").otherwise("cpu")


def is_mst(executable: Column | str) -> Column:
    return F.lower(_col(executable)).contains("mst")


def parse_runtime(text: Column | str) -> Column:
    """First ``runtime_ms: <number>`` of the text as double, else null."""
    found = F.regexp_extract(_col(text), RUNTIME_PATTERN, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def ratio(base: Column | str, value: Column | str) -> Column:
    """``base / value`` where the base is present and non-zero, else null."""
    base, value = _col(base), _col(value)
    return F.when((base != 0) & (value != 0), base / value)


def short_error(text: Column | str) -> Column:
    return F.substring(_col(text), 1, ERROR_LENGTH)


def command_line(*words: Column | str) -> Column:
    return F.concat_ws(" ", *[_col(w) for w in words])


def stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIMESTAMP_FORMAT)


def missing_as_empty(value: Column | str) -> Column:
    """Null becomes the empty string; for use when writing only."""
    return F.coalesce(_col(value).cast("string"), F.lit(""))
