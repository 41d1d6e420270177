"""Small helpers that the operators of this package share."""

from __future__ import annotations

import hashlib
import sys
import types
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of one Arrow batch; with the default of 10,000 rows a batch of documents takes some 100 MB in a worker.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Lets the session send at most ``BATCH_ROWS`` rows to a Python worker at a time."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting, "10000")) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def text_or_empty(column: str) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def per_worker(name: str, make: Callable):
    """``make()`` once per Python worker; workers are reused from task to task."""
    kept = sys.modules.setdefault("coppice_per_worker", types.ModuleType("coppice_per_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def slices(texts: list[str], most_chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most_chars`` in all; a longer text stands alone."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > most_chars:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def word_table() -> bytes:
    """Lower-cases A-Z and turns every byte that is no word byte into a space.

    Word bytes are digits, letters and all bytes of non-ASCII characters, so that
    ``bytes.translate(...).split()`` gives the words of a UTF-8 text.
    """
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b if b in keep else 32 for b in UPPER_TO_LOWER)


WORD_TABLE = word_table()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()


class Cover:
    """Intervals that were added, asked whether one of them contains another; logarithmic in their number.

    Held are those that no other contains: their starts and ends both ascend.
    """

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def contains(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start) - 1
        return k >= 0 and self.ends[k] >= end

    def add(self, start: int, end: int) -> None:
        if self.contains(start, end):
            return
        first = bisect_left(self.starts, start)
        last = bisect_right(self.ends, end, lo=first)
        self.starts[first:last] = [start]
        self.ends[first:last] = [end]
