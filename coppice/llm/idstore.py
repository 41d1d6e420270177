"""Token ids in binary shards with a minimal perfect hash index.

Documents are dealt by key range into shards, so that shards and the documents in them
follow ascending keys. A shard is a file of raw little-endian ids, 16 bits wide where
the vocabulary allows it and 32 otherwise, and an index file: the documents in order
(key, offset, length) and a minimal perfect hash over the keys. The hash puts the n
keys of a shard into n slots without a gap; a slot holds the key's fingerprint and the
document's number, so that one seek reads the ids of a key and a key that is not there
is refused (with fingerprints of 32 bits, all but about one in four billion; the key
that is stored beside settles the rest).

A task writes under names of its own and reports them in the manifest, which Spark
commits: files of lost or repeated attempts are in no manifest.

Edge cases: a null or empty text gives the end id alone. A null key comes first and is
read in order but has no slot. A repeated key keeps all its rows, ordered by their
texts' hash and text; its slot names the first. An empty table has an empty manifest.
"""

from __future__ import annotations

import gc
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm.common import per_worker, text_or_empty
from coppice.operators.rank import running_total
from coppice.store import Store

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
DOCS_PER_SHARD = 4_096
#: Documents of one task, where the session's partitions don't make it fewer; a shard's number is its task's with the place behind.
DOCS_PER_TASK = 1 << 16
SHARD_BITS = 32
#: Shards read by one task, where the session's partitions don't make it fewer.
SHARDS_PER_TASK = 64
#: Units that a worker keeps in one generation, some 220 bytes each; two generations of two workers take about half a GB.
KEPT_UNITS = 600_000
#: Bytes of text encoded at a time.
SLICE = 1 << 22
#: Mean keys of a bucket of the hash; larger ones make the table of seeds smaller and slower to find.
BUCKET = 4
MASK = 2**64 - 1
MANIFEST = "shard long, ids_file string, index_file string, n_docs long, n_ids long, width int, first_key long, last_key long"
INDEX = np.dtype([("key", "<i8"), ("has_key", "u1"), ("offset", "<u8"), ("length", "<u4")])
SLOT = np.dtype([("fingerprint", "<u4"), ("number", "<u4")])


# --- encoding ------------------------------------------------------------------


class Encoder:
    """The library's ids of whole texts, by units that its pre-tokenizer never joins.

    The pattern of the pre-tokenizer starts a new token at every space that has a
    character other than white space on both sides, so the ids of a text are those of
    its units one after the other. Units repeat; each worker keeps those it has seen.
    Texts with other white space beside a space or with an added token of the library
    are encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = f"<u{self.width}"
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        # By what stands before a unit: nothing at the start of a text or line, else a space.
        self.known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.older: dict[str, dict[str, bytes]] = {"": {}, " ": {}}

    def _library(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, self.code).tobytes() for c in coded]

    def _together(self, pieces: list[str], size: int = 2_000) -> list[bytes]:
        """Ids of pieces by few calls: they become the lines of one text, whose ends have an id of their own."""
        if self.line_end is None:
            return self._library(pieces)
        groups = [pieces[k : k + size] for k in range(0, len(pieces), size)]
        out = []
        for group, raw in zip(groups, self._library(["\n".join(group) for group in groups])):
            ends = np.flatnonzero(np.frombuffer(raw, self.code) == self.line_end) * self.width
            if len(ends) != len(group) - 1:  # a piece has line ends itself
                out += self._library(group)
                continue
            ends = ends.tolist()
            starts = [0, *(end + self.width for end in ends)]
            out += [raw[start:end] for start, end in zip(starts, [*ends, len(raw)])]
        return out

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Raw ids of each text, slice by slice."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.cumsum(sizes) // SLICE  # a longer text ends a slice
        ends = [*(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)] if len(texts) else []
        for start, end in zip([0, *ends], ends):
            gc.disable()  # only strings and bytes are made here, none of them in cycles
            try:
                coded = self._encode_slice(texts[start:end])
            finally:
                gc.enable()
            yield from coded

    def _encode_slice(self, texts: pa.Array) -> list[bytes]:
        for before, known in self.known.items():
            if len(known) > KEPT_UNITS:
                # Units in use move over from the older generation; rare ones are forgotten.
                self.older[before], self.known[before] = known, {}
        alone = np.zeros(len(texts), bool)
        for mark in self.added:
            alone |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        units = lists.flatten().dictionary_encode()
        named = units.dictionary.to_pylist()
        place = units.indices.to_numpy(zero_copy_only=False).copy()
        firsts = [named[k] for k in place[starts[:-1]].tolist()]
        self._learn("", set(firsts))
        self._learn(" ", set(named))
        # The ids of the slice: one entry for each different unit, and one for the start of each text.
        place[starts[:-1]] = len(named) + np.arange(len(firsts))
        coded = [*map(self.known[" "].get, named), *map(self.known[""].get, firsts)]
        entries = pa.array(coded, pa.binary())
        unknown = entries.is_null().to_numpy(zero_copy_only=False)[place]
        alone |= np.logical_or.reduceat(unknown, starts[:-1])
        joined = entries.fill_null(b"").take(pa.array(place))
        raw = joined.buffers()[2]
        raw = raw.to_pybytes() if raw else b""
        ends = np.append(0, np.cumsum(pc.binary_length(joined).to_numpy()))[starts].tolist()
        out = [raw[a:b] for a, b in zip(ends, ends[1:])]
        for k in np.flatnonzero(alone).tolist():
            out[k] = self._library([texts[k].as_py()])[0]
        return out

    def _learn(self, before: str, units: set[str]) -> None:
        """Ids of units that can stand alone; a unit of several pieces is put together from theirs."""
        missing = self._missing(before, units)
        whole = {unit for unit in missing if unit.isalpha()}
        firsts, rest, cut, signed = set(), set(), [], []
        for unit in missing.difference(whole):
            word = unit.rstrip(SIGNS)
            if word.isalpha():  # the most frequent case of those that are cut
                signed.append((unit, word, unit[len(word) :]))
            elif unit and not unit[0].isspace() and not unit[-1].isspace():
                pieces = _pieces(unit)
                cut.append((unit, pieces))
                firsts.add(pieces[0])
                rest.update(pieces[1:])
        firsts.update([word for _, word, _ in signed])
        rest.update([signs for _, _, signs in signed])
        whole |= self._missing(before, firsts)
        self._add(before, whole)
        self._add("", self._missing("", rest))
        known, others = self.known[before], self.known[""].__getitem__
        known.update([(unit, known[word] + others(signs)) for unit, word, signs in signed])
        known.update([(unit, b"".join([known[pieces[0]], *map(others, pieces[1:])])) for unit, pieces in cut])

    def _add(self, before: str, pieces: set[str]) -> None:
        new = list(pieces)
        self.known[before].update(zip(new, self._together([before + piece for piece in new] if before else new)))

    def _missing(self, before: str, units: set[str]) -> set[str]:
        """The units that are not known, after those of the older generation have moved over."""
        known, older = self.known[before], self.older[before]
        missing = units.difference(known)
        if older:
            moved = [unit for unit in missing if unit in older]
            known.update(zip(moved, map(older.__getitem__, moved)))
            missing.difference_update(moved)
        return missing


#: ASCII characters that are no letter, digit, apostrophe or white space.
SIGNS = ".,!?;:%$#&*\"()[]{}|/+-<>=~^_@`\\"


def _pieces(unit: str) -> list[str]:
    """The unit, cut at further places where the pre-tokenizer starts anew.

    These are a line end with other characters on both sides, and the change from
    letters to the signs at the end of a line.
    """
    lines = unit.split("\n")
    if len(lines) > 1 and any(not line or line[0].isspace() or line[-1].isspace() for line in lines):
        return [unit]
    out = []
    for line in lines:
        word = line.rstrip(SIGNS)
        cut = len(word) if len(word) < len(line) and word.isalpha() else len(line)
        out += [line[:cut], line[cut:], "\n"] if cut < len(line) else [line, "\n"]
    return out[:-1]


def _encoder(tokenizer_file: str | None) -> Encoder:
    if tokenizer_file is None:
        import public_tokenizers

        tokenizer_file = public_tokenizers.path(TOKENIZER)
    return per_worker(f"encoder of {tokenizer_file}", lambda: Encoder(tokenizer_file))


# --- the hash ------------------------------------------------------------------


def mixed(keys: np.ndarray, seeds) -> np.ndarray:
    """64-bit hashes of 64-bit keys under seeds, modulo 2^64 throughout."""
    x = keys ^ (np.asarray(seeds, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unsigned(keys) -> np.ndarray:
    return np.atleast_1d(np.asarray(keys, np.int64)).view(np.uint64)


class PerfectHash:
    """A minimal perfect hash of distinct keys: a seed for every bucket, found for the largest first.

    A bucket of one key stores its slot itself, as -1 - slot.
    """

    def __init__(self, seeds: np.ndarray, size: int):
        self.seeds, self.size = seeds, size

    @classmethod
    def of(cls, keys) -> PerfectHash:
        keys = _unsigned(keys)
        size = len(keys)
        seeds = np.zeros(max(1, -(-size // BUCKET)), np.int64)
        home = (mixed(keys, 0) % np.uint64(len(seeds))).astype(np.int64)
        members = keys[np.argsort(home, kind="stable")]
        counts = np.bincount(home, minlength=len(seeds))
        ends = np.cumsum(counts)
        taken = np.zeros(size, bool)
        order = np.argsort(-counts, kind="stable")
        for b in order[counts[order] > 1].tolist():
            seeds[b], slots = cls._seed(members[ends[b] - counts[b] : ends[b]], taken)
            taken[slots] = True
        single = order[counts[order] == 1]
        seeds[single] = -1 - np.flatnonzero(~taken)[: len(single)]
        return cls(seeds, size)

    @staticmethod
    def _seed(keys: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        """The first seed that puts the keys of a bucket into different free slots."""
        first, tried = 1, 16
        while True:
            tries = np.arange(first, first + tried, dtype=np.uint64)[:, None]
            slots = (mixed(keys[None, :], tries) % np.uint64(len(taken))).astype(np.int64)
            for k in np.flatnonzero(~taken[slots].any(axis=1)).tolist():
                if len(set(slots[k].tolist())) == len(keys):
                    return first + k, slots[k]
            first, tried = first + tried, min(2 * tried, 1 << 12)

    def slots_of(self, keys) -> np.ndarray:
        """The slot of every key; any slot for keys that are not in the hash."""
        keys = _unsigned(keys)
        seeds = self.seeds[(mixed(keys, 0) % np.uint64(len(self.seeds))).astype(np.int64)]
        hashed = mixed(keys, np.maximum(seeds, 0).astype(np.uint64)) % np.uint64(max(1, self.size))
        return np.where(seeds < 0, -1 - seeds, hashed.astype(np.int64))

    def slot(self, key: int) -> int:
        return int(self.slots_of(key)[0])


def fingerprints(keys) -> np.ndarray:
    return (mixed(_unsigned(keys), np.uint64(MASK)) >> np.uint64(32)).astype(np.uint32)


# --- files ---------------------------------------------------------------------


def _file_system(path: str):
    """The file system of a shared folder, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _write(path: str, parts: Iterator[bytes]) -> None:
    system, name = _file_system(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    with system.open_output_stream(name) as out:
        for part in parts:
            out.write(part)


def _read(path: str) -> bytes:
    system, name = _file_system(path)
    with system.open_input_stream(name) as source:
        return source.read()


def _index_bytes(rows: np.ndarray) -> bytes:
    """The documents in order, then seeds and slots of the hash over their keys."""
    numbers = np.flatnonzero(rows["has_key"])
    keys, first = np.unique(rows["key"][numbers], return_index=True)
    numbers = numbers[first]
    hashed = PerfectHash.of(keys)
    slots = np.zeros(len(keys), SLOT)
    slots[hashed.slots_of(keys)] = np.rec.fromarrays([fingerprints(keys), numbers.astype(np.uint32)], dtype=SLOT)
    head = np.array([len(rows), len(hashed.seeds), len(slots)], "<u8")
    return head.tobytes() + rows.tobytes() + hashed.seeds.astype("<i8").tobytes() + slots.tobytes()


def _index_of(raw: bytes) -> tuple[np.ndarray, PerfectHash, np.ndarray]:
    n_rows, n_seeds, n_slots = (int(x) for x in np.frombuffer(raw, "<u8", 3))
    rows = np.frombuffer(raw, INDEX, n_rows, 24)
    at = 24 + rows.nbytes
    seeds = np.frombuffer(raw, "<i8", n_seeds, at)
    return rows, PerfectHash(seeds, n_slots), np.frombuffer(raw, SLOT, n_slots, at + seeds.nbytes)


def write_ids(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_file: str | None = None,
    end_id: int = END_ID,
    docs_per_shard: int = DOCS_PER_SHARD,
) -> DataFrame:
    """Writes shards under ``folder`` and returns the manifest; write it to run the job once.

    Keys are integers. The texts are shuffled once, by key range; the hash of the text
    is part of the range key, so that one key with many rows is split as well. A task
    writes its documents as one shard after the other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("key"), text_or_empty(text_col).alias("text"))
    count = docs.count()
    shards = max(1, -(-count // docs_per_shard))
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // DOCS_PER_TASK)))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(tasks, "key", "h").sortWithinPartitions("key", "h", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << SHARD_BITS
        encoder = _encoder(tokenizer_file)
        end = end_id.to_bytes(encoder.width, "little")
        encoded = ((keys, raw + end) for batch in batches for keys, raw in zip(batch["key"].to_pylist(), encoder.encode(batch["text"])))
        for shard, head in enumerate(encoded, first):
            keys, lengths = [], []

            def parts() -> Iterator[bytes]:
                for key, raw in chain([head], islice(encoded, docs_per_shard - 1)):
                    keys.append(key)
                    lengths.append(len(raw) // encoder.width)
                    yield raw

            name = f"{folder}/shard-{shard:016d}-{uuid.uuid4().hex}"
            _write(f"{name}.ids", parts())
            index = np.zeros(len(keys), INDEX)
            index["has_key"] = [key is not None for key in keys]
            index["key"] = [key or 0 for key in keys]
            index["length"] = lengths
            index["offset"] = np.cumsum(lengths) - lengths
            _write(f"{name}.index", iter([_index_bytes(index)]))
            real = [key for key in keys if key is not None]
            row = [shard, f"{name}.ids", f"{name}.index", len(keys), sum(lengths), encoder.width, *((real[0], real[-1]) if real else (None, None))]
            yield pa.RecordBatch.from_pylist([dict(zip(_names(), row))], schema=_arrow_manifest())

    return rows.select("key", "text").mapInArrow(write, MANIFEST)


def _names() -> list[str]:
    return [field.split()[0] for field in MANIFEST.split(", ")]


def _arrow_manifest() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in MANIFEST.split(", "))])


def read_documents(manifest: DataFrame, id_col: str = "doc_id", store: Store | None = None) -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, read from the files.

    A document with a key is fetched through the hash: its key's slot must hold the key's
    fingerprint and names the place of the ids. Rows without a key, and rows of a key
    after its first, have no slot and are read in order. ``start`` counts the ids of all
    documents before it, by a running total over one row for each shard.
    """
    spark = manifest.sparkSession
    placed = running_total(manifest, ["shard"], "n_ids", store or Store(spark, "idstore"))
    # The manifest is small, the files it names are not, so the number of tasks does not follow its bytes.
    shards = manifest.count()
    tasks = max(1, -(-shards // SHARDS_PER_TASK), min(-(-shards // 2), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = placed.select("shard", "ids_file", "index_file", "width", F.col("before").alias("base")).repartition(tasks, "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = np.frombuffer(_read(shard["ids_file"]), f"<u{shard['width']}")
                index, hashed, slots = _index_of(_read(shard["index_file"]))
                numbers = _fetched(index, hashed, slots, shard["index_file"])
                offsets, lengths = index["offset"][numbers].astype(np.int64), index["length"][numbers].astype(np.int64)
                sums = [zlib.crc32(ids[a : a + n].astype("<u4")) for a, n in zip(offsets.tolist(), lengths.tolist())]
                keys = pa.array(index["key"].astype(np.int64), mask=index["has_key"] == 0)
                columns = [keys, pa.array(offsets + shard["base"]), pa.array(lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def _fetched(index: np.ndarray, hashed: PerfectHash, slots: np.ndarray, name: str) -> np.ndarray:
    """Which entry of the index holds each document: what the hash says for the first row of a key, itself for other rows."""
    numbers = np.arange(len(index))
    keyed = np.flatnonzero(index["has_key"])
    if not len(keyed):
        return numbers
    keys = index["key"][keyed]
    found = slots[hashed.slots_of(keys)]
    if (found["fingerprint"] != fingerprints(keys)).any() or (index["key"][found["number"]] != keys).any():
        raise ValueError(f"the hash of {name} does not find its own keys")
    first = np.concatenate([[True], keys[1:] != keys[:-1]])  # rows are in the order of keys
    numbers[keyed[first]] = found["number"][first]
    return numbers


class Shard:
    """Keyed access to one shard."""

    def __init__(self, ids_file: str, index_file: str, width: int):
        self.system, self.name = _file_system(ids_file)
        self.width = width
        self.index, self.hash, self.slots = _index_of(_read(index_file))

    def get(self, key: int) -> np.ndarray | None:
        """The ids of a key with its end id, None if the key is not there."""
        if not self.hash.size:
            return None
        slot = self.slots[self.hash.slot(key)]
        if slot["fingerprint"] != fingerprints(key)[0]:
            return None
        row = self.index[slot["number"]]
        if row["key"] != key:
            return None
        with self.system.open_input_file(self.name) as source:
            raw = source.read_at(int(row["length"]) * self.width, int(row["offset"]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


def lookup(keys: DataFrame, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, ids`` for every key that is stored; each shard is opened once.

    The first and last keys of the shards (16 bytes a shard) tell where a key belongs, then keys
    and shards meet by an equi-join on the shard's number.
    """
    bounds = manifest.where("first_key is not null").select("shard", "first_key", "last_key").orderBy("shard").toPandas()
    firsts, lasts = (bounds[c].to_numpy(np.int64) for c in ("first_key", "last_key"))
    numbers = np.append(bounds["shard"].to_numpy(np.int64), -1)

    @F.arrow_udf("long")
    def shard_of(values: pa.Array) -> pa.Array:
        values = values.to_numpy(zero_copy_only=False)
        place = np.searchsorted(lasts, values)
        inside = np.append(firsts, np.iinfo(np.int64).max)[place] <= values
        return pa.array(np.where(inside, numbers[place], -1).astype(np.int64))

    wanted = keys.select(F.col(id_col).cast("long").alias("key")).dropna().distinct()
    wanted = wanted.withColumn("shard", shard_of("key"))
    files = manifest.select("shard", "ids_file", "index_file", "width")
    joined = wanted.join(files, "shard").repartition("shard").sortWithinPartitions("shard", "key")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            found, ids = [], []
            for row in batch.to_pylist():
                if row["ids_file"] != name:
                    name, opened = row["ids_file"], Shard(row["ids_file"], row["index_file"], row["width"])
                got = opened.get(row["key"])
                if got is not None:
                    found.append(row["key"])
                    ids.append(got.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return joined.mapInArrow(fetch, f"`{id_col}` long, ids array<int>")


def write_and_read(docs: DataFrame, store, **options) -> DataFrame:
    """Writes all documents into a folder of ``store`` and reads them back."""
    manifest = store.keep(write_ids(docs, store.path("ids"), **options), "manifest")
    return read_documents(manifest, store=store)


def open_shard(spark: SparkSession, manifest: DataFrame, key: int) -> Shard | None:
    """The shard whose range holds ``key``."""
    near = manifest.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("shard").first()
    return Shard(near["ids_file"], near["index_file"], near["width"]) if near else None
