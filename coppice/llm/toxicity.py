"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of 3 to 6 characters of its
lower-cased form, framed by spaces. From labelled texts each feature gets the
ratio r = log((p + 1) / (N1 + 2)) - log((n + 1) / (N0 + 2)) of its smoothed shares
of toxic and other texts. The features whose ratio stands out most stay; logistic
regression learns their weights with every feature scaled by r.

Edge cases: a null text counts as an empty one; an empty text scores by the
intercept. Rows without a label, and labels without a document, take no part in the
fit; a repeated row counts as often as it stands there. Without labels, or with one
class only, the model is the smoothed share of that class. Ties among features go to
the smaller number. Columns of other names are not read; an empty table of documents gives
no rows, and a fit without documents is one without labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import slices, text_or_empty
from coppice.store import Store

SIZES = (3, 4, 5, 6)
BITS = 20
#: The fit sees at most so many labelled rows, those with the smallest crc32 of the id.
SAMPLE_ROWS = 16_000
#: So many features stay; with 16,000 rows at most 16 million numbers reach the driver.
FEATURES = 1_024
RIDGE = 1.0
#: Characters that are hashed at a time, some 100 bytes each.
SLICE = 1 << 18
STEPS = 400


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # ascending hashes
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability of the toxic label for each text."""
        dense = np.zeros(1 << BITS)
        dense[self.features] = self.weights
        total = np.full(len(texts), self.intercept)
        for start, end in slices(texts, SLICE):
            doc, feature = distinct_grams(texts[start:end], dense != 0)
            total[start:end] += np.bincount(doc, dense[feature], minlength=end - start)
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def distinct_grams(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed n-gram), each pair once, for n-grams that are ``wanted``.

    The texts lie in one array; the spaces between them are as wide as the longest
    n-gram, so that no n-gram depends on a neighbour.
    """
    gap = " " * SIZES[-1]
    lowered = [" " + text.lower() for text in texts]
    lengths = np.array([len(text) for text in lowered], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + len(gap))[:-1]])
    joined = gap.join(lowered) + gap
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = []
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(1, SIZES[-1] + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n not in SIZES:
            continue
        mark = np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
        hashed = ((rolled ^ mark) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        at = np.arange(len(hashed)) if wanted is None else np.flatnonzero(wanted[hashed])
        doc = np.searchsorted(starts, at, "right") - 1
        inside = at - starts[doc] < lengths[doc]
        found.append((doc[inside] << BITS) | hashed[at[inside]].astype(np.int64))
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    store: Store | None = None,
) -> Model:
    """The model for ``docs`` and the ``labels`` of some of them.

    The sample is bounded, so it is broadcast to the documents and its texts are
    written once; counts are summed per task before they are shuffled.
    """
    store = store or Store(docs.sparkSession, "toxicity")
    known = labels.select(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y")
    ).dropna()
    sample = known.orderBy(F.crc32(F.col("id").cast("string").cast("binary")), "id", "y").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = store.keep(rows.join(F.broadcast(sample), "id").select("y", "text"), "sample")
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("ones")).first()
    n1, n0 = size["ones"], size["n"] - size["ones"]
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if n1 == 0 or n0 == 0:
        return Model(np.zeros(0, np.int64), np.zeros(0), prior)

    counts = texts.mapInArrow(_count_grams, "feature int, ones long, others long")
    counts = counts.groupBy("feature").agg(F.sum("ones").alias("p"), F.sum("others").alias("n"))
    ratio = F.log((F.col("p") + 1) / (n1 + 2)) - F.log((F.col("n") + 1) / (n0 + 2))
    spread = F.sqrt(1 / (F.col("p") + 1) + 1 / (F.col("n") + 1))
    best = (
        counts.where(F.col("p") + F.col("n") > 1)
        .select("feature", ratio.alias("r"), F.abs(ratio / spread).alias("weight"))
        .where("weight > 0")
        .orderBy(F.desc("weight"), "feature")
        .limit(features)
        .collect()
    )
    chosen = sorted((row["feature"], row["r"]) for row in best)
    hashes = np.array([c[0] for c in chosen], dtype=np.int64)
    ratios = np.array([c[1] for c in chosen])
    if not len(hashes):
        return Model(hashes, ratios, prior)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[hashes] = True
        for y, part in _sliced(batches):
            doc, feature = distinct_grams(part, wanted)
            place = np.searchsorted(hashes, feature).astype(np.int32)
            bounds = np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(place))
            yield pa.RecordBatch.from_arrays([pa.array(y), lists], ["y", "places"])

    picked = texts.mapInArrow(pick, "y int, places array<int>").toArrow()
    y = picked["y"].to_numpy()
    lists = picked["places"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    weights, intercept = _regress(
        np.repeat(np.arange(len(y)), lengths), lists.flatten().to_numpy(), y, ratios, prior
    )
    return Model(hashes, weights, intercept)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[str]]]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        y = batch["y"].to_numpy(zero_copy_only=False).astype(np.int32)
        for start, end in slices(texts, SLICE):
            yield y[start:end], texts[start:end]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of the task hold each n-gram."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    for y, texts in _sliced(batches):
        doc, feature = distinct_grams(texts)
        for label in (0, 1):
            counts[label] += np.bincount(feature[y[doc] == label], minlength=1 << BITS)
    seen = np.flatnonzero(counts.sum(0))
    columns = [seen.astype(np.int32), counts[1, seen], counts[0, seen]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "ones", "others"])


def _regress(row, place, y, ratios, intercept) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by full-batch gradient steps of adapted length."""
    value = np.zeros(len(ratios) + 1)
    value[-1] = intercept
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        margin = np.bincount(row, (value[:-1] * ratios)[place], minlength=len(y)) + value[-1]
        error = 1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y
        slope = np.append(
            np.bincount(place, error[row], minlength=len(ratios)) * ratios + RIDGE * value[:-1], error.sum()
        )
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        value -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return value[:-1] * ratios, float(value[-1])


def score_column(model: Model, text_col: str = "text"):
    """The score of a text column; other columns of the frame stay in the JVM."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()))

    return scores(text_or_empty(text_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` for every row; predicted is 1 from a score of 0.5 on."""
    scored = docs.select(id_col, score_column(model, text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with the same columns."""
    return docs.where(score_column(model, text_col) < 0.5)
