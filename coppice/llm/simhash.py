"""SimHash near-duplicates by BK-trees over shards of fingerprints.

A fingerprint has 64 bits; two texts link if theirs differ in at most ``radius`` bits.
Equal fingerprints collapse first. The bits are cut into ``BLOCKS`` blocks; two
fingerprints within the radius agree on at least ``BLOCKS - radius`` of them, so every
choice of that many blocks makes one set of shards, and each link lies inside a shard
of at least one choice. A shard becomes a BK-tree: a child hangs under its parent by
the integer Hamming distance between them, and a search follows only edges within the
radius of the distance at hand. A shard fixes 32 of the 64 bits; one with more than
``SHARD_ROWS`` members is cut the same way over its free bits, which then fixes 46 to
49, so that at most 262,144 different fingerprints can share a shard, however large the
corpus. Trees travel to the tasks by the shuffle, not by broadcast, because the trees
of a corpus have no size bound.

Within a shard only links that join two groups are given out, so their number is
below the shard's members; components over them are those over all links.

Edge cases: null and empty texts have no words and the fingerprint zero, linked like
any other; rows without an id get a fingerprint but take no part in the components;
repeated ids and rows are in the component of their texts; an empty table gives an
empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import UPPER_TO_LOWER, text_or_empty
from coppice.operators.components import connected_components
from coppice.store import Store

SHINGLE = 3
RADIUS = 3
BLOCKS = 6
SEED = 42
SHARD_ROWS = 4_096
#: Fingerprints with more than this share of all rows join by broadcast: below 1,000 of them.
HOT_SHARE = 1_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority bits of the XXH64 of all word shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate([[0], ends[:-1]])
    count = max(1, len(words) - shingle + 1)
    ends = (ends - 1)[-count:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[:count].tolist(), ends)]
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 14):  # bounds the unpacked bits of a long text
        block = np.array(hashes[at : at + (1 << 14)], dtype="<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count, bitorder="little").tobytes(), "little")


def fingerprint_column(text_col: str = "text", shingle: int = SHINGLE):
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(text, shingle) for text in texts.to_pylist()], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    return fingerprints(text_or_empty(text_col))


def hex_column(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


class BKTree:
    """Fingerprints of one shard; ``add`` gives the links that join two groups."""

    def __init__(self, radius: int):
        self.radius = radius
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []  # union-find parents
        self.whole: list[bool] = []  # the subtree is one group for certain

    def find(self, i: int) -> int:
        group = self.group
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def add(self, value: int) -> list[int]:
        """Inserts a fingerprint; returns a member of each other group within the radius."""
        new = len(self.value)
        self.value.append(value)
        self.children.append({})
        self.group.append(new)
        self.whole.append(True)
        if not new:
            return []
        links = self._search(value, new)
        path, at = [], 0
        while True:
            path.append(at)
            distance = (value ^ self.value[at]).bit_count()
            below = self.children[at].get(distance)
            if below is None:
                self.children[at][distance] = new
                break
            at = below
        mine = self.find(new)
        for at in path:
            self.whole[at] = self.whole[at] and self.find(at) == mine
        return links

    def _search(self, value: int, new: int) -> list[int]:
        links, radius = [], self.radius
        nodes = [0]
        while nodes:
            at = nodes.pop()
            if self.whole[at] and links and self.find(at) == self.find(new):
                continue  # everything below is linked already
            distance = (value ^ self.value[at]).bit_count()
            if distance <= radius:
                theirs, mine = self.find(at), self.find(new)
                if theirs != mine:
                    self.group[mine] = theirs
                    links.append(at)
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    nodes.append(child)
        return links


def block_masks(bits: list[int], radius: int, blocks: int = BLOCKS) -> list[int]:
    """Masks of the bits that a shard fixes: every choice of blocks - radius blocks."""
    if not 0 <= radius < blocks:
        raise ValueError(f"the radius must be from 0 to {blocks - 1}")
    cut = [sum(1 << b for b in part) for part in np.array_split(np.array(bits, object), blocks)]
    return [sum(chosen) for chosen in itertools.combinations(cut, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(masks: list[int]):
    return F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])


def _sharded(rows: DataFrame, masks, number) -> DataFrame:
    """``shard, key, fp, rep`` once for each mask, ordered by shard and key; ``number`` names a mask by its place."""
    keyed = rows.select("*", F.posexplode(masks).alias("place", "mask"))
    keyed = keyed.select(number.cast("long").alias("shard"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "rep")
    return keyed.repartition("shard", "key").sortWithinPartitions("shard", "key", "fp")


def _search_shards(radius: int, most: int | None):
    """Per task: the links of each shard, or its rows again if it has more than ``most``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        shard = over = None
        out: list[tuple[int, int, int]] = []

        def close():
            if len(held) > 1:
                tree = BKTree(radius)
                for fp, rep in held:
                    out.extend((-1, held[other][1], rep) for other in tree.add(fp & (2**64 - 1)))
            held.clear()

        def written():
            columns = [pa.array([row[k] for row in out], pa.int64()) for k in range(3)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["shard", "a", "b"])

        for batch in batches:
            names, keys, fps, reps = (batch.column(k).to_numpy() for k in range(4))
            same = (names[1:] == names[:-1]) & (keys[1:] == keys[:-1])
            bounds = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(keys)]]) if len(keys) else [0]
            for start, end in zip(bounds[:-1], bounds[1:]):
                here = (names[start], keys[start])
                if here != shard:
                    close()
                    shard, over = here, False
                if end - start == 1 and end < len(keys) and not held and not over:
                    continue  # alone in its shard
                rows = list(zip(fps[start:end].tolist(), reps[start:end].tolist()))
                if most is not None and (over or len(held) + len(rows) > most):
                    rows, over = held + rows, True
                    out.extend((int(here[0]), fp, rep) for fp, rep in rows)
                    held.clear()
                else:
                    held.extend(rows)
            if len(out) > 50_000:
                yield written()
        close()
        yield written()

    return search


def near_links(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, store: Store | None = None) -> DataFrame:
    """``a, b``: links that connect all of ``(fp, rep)`` within the radius; each ``fp`` is there once."""
    store = store or Store(prints.sparkSession, "simhash")
    first = block_masks(list(range(64)), radius)
    rows = "shard long, a long, b long"
    found = _sharded(prints, _masks(first), F.col("place")).mapInArrow(_search_shards(radius, shard_rows), rows)
    found = store.keep(found, "links")
    links = found.where("shard < 0").select("a", "b")
    dense = found.where("shard >= 0").select("shard", F.col("a").alias("fp"), F.col("b").alias("rep"))
    if dense.isEmpty():
        return links
    finer = []
    for mask in first:
        free = [b for b in range(64) if not mask >> b & 1]
        finer.append(_masks([mask | more for more in block_masks(free, radius)]))
    finer = F.element_at(F.array(*finer), F.col("shard").cast("int") + 1)
    number = F.col("shard") * len(first) + F.col("place")
    more = _sharded(dense, finer, number).mapInArrow(_search_shards(radius, None), rows)
    return links.union(store.keep(more, "finer").select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
    store: Store | None = None,
) -> DataFrame:
    """``id_col, fp, component_id`` for every row; the component is the smallest id reachable."""
    spark = docs.sparkSession
    store = store or Store(spark, "simhash")
    prints = docs.select(F.col(id_col).cast("long").alias("id"), fingerprint_column(text_col, shingle).alias("fp"))
    prints = store.keep(prints, "prints")
    groups = prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    groups = store.keep(groups, "groups")
    links = near_links(groups.select("fp", "rep"), radius, shard_rows, store)
    comps = connected_components(links, store=store, u="a", v="b")
    comps = comps.select(F.col("id").alias("rep"), "comp")
    named = groups.join(comps, "rep", "left").select("fp", "n", F.coalesce("comp", "rep").alias("component_id"))
    named = store.keep(named, "named")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(named.where(F.col("n") > total / HOT_SHARE).select("fp", "component_id"))
    rest = named.where(F.col("n") <= total / HOT_SHARE).select("fp", "component_id")
    plain = prints.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp", "left")
    joined = prints.join(hot, "fp").unionByName(plain)
    return joined.select(F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
    store: Store | None = None,
) -> DataFrame:
    """One row of ``docs`` for each group of linked fingerprints: the one with the smallest id.

    Rows are decided on one by one: an id may stand for several texts, and each text keeps
    a copy. Of rows of one group with the smallest id the one with the smallest hash of
    all columns stays; of equal rows one. Rows without an id stay.
    """
    store = store or Store(docs.sparkSession, "simhash")
    # Nulls add nothing to the hash, so which columns are null goes in as well.
    row, key = F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)), ["_keep_id", "_keep_row"]
    keyed = docs.withColumns(dict(zip(key, (F.col(id_col), row))))
    prints = keyed.where(F.col(key[0]).isNotNull()).select(*key, fingerprint_column(text_col, shingle).alias("fp"))
    prints = store.keep(prints, "prints")
    prints = prints.groupBy("fp", *key).agg(F.count(F.lit(1)).alias("n"))
    groups = store.keep(prints.groupBy("fp").agg(F.min(F.struct(*key, "n")).alias("first")), "groups")
    # Here a fingerprint is a node by itself, so texts are not linked by a common id.
    links = near_links(groups.select("fp", F.col("fp").alias("rep")), radius, shard_rows, store)
    comps = connected_components(links, store=store, u="a", v="b").select(F.col("id").alias("fp"), "comp")
    named = groups.join(comps, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    stays = store.keep(named.groupBy("comp").agg(F.min("first").alias("first")).select("first.*"), "stays")
    single = keyed.join(stays.where("n = 1"), key, "left_semi")
    repeated = keyed.join(stays.where("n > 1"), key, "left_semi").dropDuplicates(key)
    return single.unionByName(repeated).select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
