"""Exact top-k search by MaxScore over the coordinates of integer vectors.

A coordinate is a term: its posting list in a shard holds the shard's values in the
order of ids, with their least and greatest value. A query coordinate q bounds what a
term can add to a score: q times the greatest value, or the least one where q is
negative. With the terms in falling order of the range of their contributions, those
whose ranges together can't lift a vector past the k-th best score so far are
non-essential. Essential postings are traversed for all vectors of the shard; the
others are probed, term by term, only for vectors that are still competitive. The
best k of each shard are merged.

The queries are a stated set; they go to all shards, the shards to one task each. A task
reads the vectors of a shard and then its queries as a stream of rows: it holds one shard,
one batch of queries and the answers to one block of them, and nothing passes through the
driver.

Edge cases: vectors that are null or hold null or non-finite components take no part;
vectors of another length than a query's are no candidates of it; rows that repeat id
and vector count once, and one id with several vectors is one query, the best over
them. Rows with the query's id are no candidates. Equal
scores go to the smaller id. Fewer than k candidates are all returned. Columns of
other names are not read; without vectors or queries there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 256
#: Vectors in a shard, on average, and queries answered in one batch; a shard of 64 coordinates takes 4 MB.
SHARD_ROWS = 8_192
BLOCK_ROWS = 512
#: Terms probed before the candidates are looked through again.
STRIDE = 4


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, x``: every component as floor(scale * component); unusable vectors are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull()).where(usable & (F.size("x") > 0))
    return rows.select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("x"))


class Postings:
    """The postings of one shard: a column of values for each term, rows in the order of ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.values = np.ascontiguousarray(rows[order].T)  # term by term
        self.least, self.greatest = self.values.min(1), self.values.max(1)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k rows but the query's own, best first."""
        low = np.minimum(query * self.least, query * self.greatest)
        spread = np.maximum(query * self.least, query * self.greatest) - low
        terms = np.argsort(-spread, kind="stable")
        # left[j]: the most that the terms from the j-th on can add to their least.
        left = np.append(np.cumsum(spread[terms][::-1])[::-1], 0)
        base = int(low.sum())
        alive = np.flatnonzero(self.ids != query_id)
        theta = self._first_bound(query, alive, k)
        essential = int(np.searchsorted(-left, -(theta - base), "right"))  # left[j] < theta - base from here on
        essential = min(max(essential, 1), len(terms))
        first = terms[:essential]
        scores = (query[first] @ self.values[first])[alive] - int(low[first].sum()) + base
        for at in range(essential, len(terms), STRIDE):
            competitive = scores + left[at] >= theta
            if not competitive.all():
                alive, scores = alive[competitive], scores[competitive]
            if len(scores) > k:
                theta = max(theta, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            part = terms[at : at + STRIDE]
            scores = scores + query[part] @ self.values[np.ix_(part, alive)] - int(low[part].sum())
        best = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive[best]], scores[best]

    def _first_bound(self, query: np.ndarray, alive: np.ndarray, k: int) -> int:
        """The k-th best of a few rows in full: those with the greatest values of the strongest terms."""
        if len(alive) <= k:
            return np.iinfo(np.int64).min // 2
        strong = np.argsort(-np.abs(query), kind="stable")[:STRIDE]
        hint = (query[strong] @ self.values[strong])[alive]
        some = alive[np.argpartition(hint, len(hint) - k)[len(hint) - k :]]
        return int((query @ self.values[:, some]).min())


def top_k(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, id, score``: the k best inner products of each query over all vectors.

    Both frames have ``id long, x array<long>``; a row with the query's id is left out.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    vectors, queries = vectors.dropDuplicates(["id", "x"]), queries.dropDuplicates(["id", "x"])
    number = F.pmod(F.xxhash64("id", "x"), F.lit(shards)).cast("int")
    held = vectors.select(number.alias("shard"), F.size("x").alias("dim"), F.lit(False).alias("asked"), "id", "x")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = queries.select(every, F.size("x").alias("dim"), F.lit(True).alias("asked"), "id", "x")
    # A shard's vectors come first, then the queries row by row: no batch holds more than its rows.
    rows = held.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions("shard", "dim", "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, parts, postings = None, [], [], None
        for batch in batches:
            shard, dim, asks, id_ = (batch[c].to_numpy(zero_copy_only=False) for c in ("shard", "dim", "asked", "id"))
            flat = batch["x"].flatten().to_numpy()
            ends = np.cumsum(dim, dtype=np.int64)
            turns = (shard[1:] != shard[:-1]) | (dim[1:] != dim[:-1]) | (asks[1:] != asks[:-1])
            cuts = np.r_[0, np.flatnonzero(turns) + 1, len(dim)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if (shard[lo], dim[lo]) != name:
                    name, ids, parts, postings = (shard[lo], dim[lo]), [], [], None
                some = flat[ends[lo] - dim[lo] : ends[hi - 1]].reshape(hi - lo, -1)
                if not asks[lo]:
                    # Copies, so that no batch is kept alive.
                    ids, parts = [*ids, id_[lo:hi].copy()], [*parts, some.copy()]
                    continue
                if not ids:
                    continue
                if postings is None:
                    postings = Postings(np.concatenate(ids), np.concatenate(parts))
                    parts = []
                for at in range(0, hi - lo, block_rows):
                    block = slice(at, at + block_rows)
                    found = [(q, *postings.search(q, query, k)) for q, query in zip(id_[lo:hi][block], some[block])]
                    columns = [
                        np.concatenate([np.full(len(ids_), q) for q, ids_, _ in found]),
                        np.concatenate([ids_ for _, ids_, _ in found]),
                        np.concatenate([scores for _, _, scores in found]),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["query_id", "id", "score"])

    found = rows.mapInArrow(search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
