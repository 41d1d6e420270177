"""Suffix-array style deduplication by run-length indexes: long repeated strings.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is marked.

*Anchors.* Each string of ``length`` bytes (a window) is named by the least hash of the
k-byte grams in it, so equal windows have equal names wherever they stand. Consecutive
windows of one name make a segment. Only names that occur twice can hold a repeat; the
segments under them are cut out, equal ones once with their number.

*Index.* The segments under the same names meet in one task, are concatenated and
their Burrows-Wheeler transform is run-compressed. The longest match of a position
with its neighbour in suffix order is sampled at the ends of runs only: inside a run it is
one less than at the position before (the transform's letter is the same there, so the
neighbours of the positions before are neighbours too). Streaming the samples in text
order gives the matching statistics of all positions, against the neighbour above and
below; a window repeats if one of the two reaches ``length`` or its segment has copies.

*Hot names.* A name with many different segments (near copies with scattered edits) is
named again by longer grams, which only segments equal over most of a window share. A
second name that still has many variants (the edges of a passage in many surroundings)
has its windows counted one by one: equal windows are summed up before and after a
shuffle by their digests, and those found twice go back to their segments by a join. So
no task gets all variants of a name.

*Passages.* On demand the words are counted that stand in a run of so many words that another
document holds too, whatever its bytes; nothing is removed for them. Windows of words are named as
windows of bytes are. Equal segments of two documents are shared as a whole; where a name has
several, equal windows are found by their digests.

What is shuffled: hashes of anchors (one in about 150 bytes), the texts twice, and the
segments under repeated names; for passages hashes of anchors (one in about 20 words), the texts
once more, and digests of the windows under names with several segments.

Edge cases: null and empty texts have no bytes; texts shorter than ``length`` keep all;
rows are told apart by id and text, so rows that repeat both are copies of each other
and lose everything from ``length`` bytes on, as do equal texts under other ids; null
ids are allowed. For passages such rows are one document. Columns of other names are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import per_worker, slices, text_or_empty
from coppice.store import Store

LENGTH = 400
#: Grams of the first and second naming, as shares of the length.
GRAM, LONG_GRAM = 0.25, 0.8
#: A name with more different segments than this is named again, a second name has its windows counted.
HOT_SEGMENTS = 64
#: The segments of a name meet its flag in so many lanes.
FLAG_LANES = 64
#: Windows of a text that are named at a time, and bytes of one index.
STRETCH = 1 << 18
INDEX_BYTES = 1 << 20
END = 0xFF  # no byte of UTF-8
#: Words of a shared passage: over 50.
PASSAGE_WORDS = 51
#: Windows of words that are named at a time, and bytes of the texts that are cut into words together.
WORD_STRETCH = 1 << 16
GROUP_BYTES = 1 << 19

FACTOR = np.uint64(0x9E3779B97F4A7C15)


# --- anchors -------------------------------------------------------------------


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64."""
    inverse = pow(int(FACTOR), -1, 1 << 64)
    return tuple(
        np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count, base, np.uint64)]), dtype=np.uint64)
        for base in (FACTOR, np.uint64(inverse))
    )


def segments(raw: bytes, length: int, gram: int) -> Iterator[tuple[int, int, int, int]]:
    """(name, first window, windows, grams of that name) of the segments of a text, in order.

    A segment whose name is the hash of several of its grams may repeat itself.
    """
    size = len(raw) - length + 1
    up, down = per_worker("powers", lambda: _powers(STRETCH + (1 << 12)))
    if length >= 1 << 12:
        up, down = _powers(STRETCH + length)
    for at in range(0, max(size, 0), STRETCH):
        windows = min(STRETCH, size - at)
        part = np.frombuffer(raw, np.uint8, windows + length - 1, at)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        grams = len(part) - gram + 1
        hashed = (sums[gram:] - sums[:grams]) * down[:grams]
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
        names = _sliding_least(hashed, length - gram + 1)
        turns = np.flatnonzero(names[1:] != names[:-1]) + 1
        starts = np.concatenate([[0], turns])
        counts = np.diff(np.append(starts, len(names)))
        width = length - gram
        for name, start, count in zip(names[starts], starts.tolist(), counts.tolist()):
            named = np.count_nonzero(hashed[start : start + count + width] == name)
            yield int(name.view(np.int64)), start + at, count, named


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by running minima of blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, 1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


# --- the run-length index --------------------------------------------------------


def suffix_order(keys: np.ndarray) -> np.ndarray:
    """Suffixes in order; ``keys[i]`` are the eight bytes from i on.

    Ranks of three prefixes in a row make the rank of one of three times the length
    (of two, where three don't fit into 64 bits), until all differ.
    """
    n = len(keys)
    order = np.argsort(keys)
    place = np.arange(n)
    ranked = keys[order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))
    open_ = place[~(head & np.append(head[1:], True))]
    reach = 8
    bits = int(n).bit_length()
    joined = 3 if 3 * bits <= 63 else 2
    while len(open_):
        here = order[open_]
        name = rank[here]
        for k in range(1, joined):
            name = (name << bits) | (rank[np.minimum(here + k * reach, n)] + 1)
        by = np.argsort(name)
        name, here = name[by], here[by]
        order[open_] = here
        head = np.concatenate([[True], name[1:] != name[:-1]])
        rank[here] = open_[np.maximum.accumulate(np.where(head, np.arange(len(here)), 0))]
        open_ = open_[~(head & np.append(head[1:], True))]
        reach *= joined
    return order


def _common_prefix(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes a and b, pair by pair."""
    n = len(keys)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = np.maximum(x, y) < n
        differ = keys[np.minimum(x, n - 1)] ^ keys[np.minimum(y, n - 1)]
        more = inside & (differ == 0)
        last = live[inside & ~more]
        gap = differ[inside & ~more]
        for shift in range(56, 0, -8):
            out[last] += (gap >> np.uint64(shift)) == 0
        live = live[more]
        out[live] += 8
    # Reading past the end gives zero bytes, which no text holds there on both sides.
    return np.minimum(out, n - np.maximum(a, b))


class RunLengthIndex:
    """The run-compressed transform of a text with match lengths sampled at run ends."""

    def __init__(self, text: np.ndarray):
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text)]
        keys = np.ascontiguousarray(windows).view(">u8").ravel().astype(np.uint64)
        order = suffix_order(keys)
        letters = np.where(order > 0, text[order - 1], 256)
        turn = letters[1:] != letters[:-1]
        heads, tails = np.concatenate([[True], turn]), np.concatenate([turn, [True]])
        self.size = len(text)
        self.letters = letters[heads].astype(np.int16)  # one for each run
        self.lengths = np.diff(np.append(np.flatnonzero(heads), len(text)))
        self.above = self._sampled(keys, order, np.flatnonzero(heads), -1)
        self.below = self._sampled(keys, order, np.flatnonzero(tails), 1)

    def _sampled(self, keys, order, rows, side) -> tuple[np.ndarray, np.ndarray]:
        """(text position, match length with the neighbour) at the given rows, by position."""
        other = rows + side
        real = (other >= 0) & (other < self.size)
        match = np.zeros(len(rows), np.int64)
        match[real] = _common_prefix(keys, order[rows[real]], order[other[real]])
        by = np.argsort(order[rows])
        return order[rows][by], match[by]

    def matching_statistics(self) -> np.ndarray:
        """For every position the longest match with a string that starts elsewhere."""
        place = np.arange(self.size)
        best = np.zeros(self.size, np.int64)
        for position, match in (self.above, self.below):
            starts = np.zeros(self.size, np.int64)
            starts[position] = 1
            last = np.cumsum(starts) - 1
            best = np.maximum(best, match[last] - (place - position[last]))
        return best


def repeated_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, which windows of ``length`` bytes also start elsewhere in the pieces."""
    text = np.frombuffer(b"".join(piece + bytes([END]) for piece in pieces), np.uint8)
    matched = RunLengthIndex(text).matching_statistics()
    sizes = np.array([len(piece) for piece in pieces])
    ends = np.cumsum(sizes + 1) - 1
    out = []
    for start, end in zip((ends - sizes).tolist(), ends.tolist()):
        left = end - np.arange(start, end - length + 1)
        out.append(np.minimum(matched[start : end - length + 1], left) >= length)
    return out


def _ranges(flags: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


# --- jobs ------------------------------------------------------------------------

RECORD = "h long, s long, a long, b long, start int, windows int, n long, named int"
PIECE = "h long, s long, n long, hot boolean, piece binary"
MARKS = "h long, s long, ranges array<array<int>>"
WINDOW = "v long, w long, h long, s long, start int, n long"


def _records(length: int, gram: int):
    """Segments of each row's ``piece`` under its key (a, b): name, digest, place and the row's number of copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = [field.split()[0] for field in RECORD.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.int32()]
        for batch in batches:
            keys = [batch[c].to_pylist() for c in ("a", "b", "n")]
            out: list[list[int]] = [[] for _ in names]
            for k, piece in enumerate(batch["piece"]):
                raw = piece.as_buffer().to_pybytes()
                for name, start, windows, named in segments(raw, length, gram):
                    digest = xxhash.xxh64_intdigest(raw[start : start + windows + length - 1])
                    row = (name, digest - (digest >> 63 << 64), keys[0][k], keys[1][k], start, windows, keys[2][k], named)
                    for column, value in zip(out, row):
                        column.append(value)
                if len(out[0]) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    return run


def _cut(length: int):
    """The bytes of the listed segments of each row's piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for piece, wanted in zip(batch["piece"], batch["wanted"].to_pylist()):
                raw = piece.as_buffer().to_pybytes()
                for w in wanted:
                    cut = raw[w["start"] : w["start"] + w["windows"] + length - 1]
                    for column, value in zip(columns, (w["h"], w["s"], w["n"], w["hot"], cut)):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["h", "s", "n", "hot", "piece"])

    return run


def _index(length: int, most: int = INDEX_BYTES):
    """Repeated windows of the segments under each name; names come in order, several to an index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None

        def marks() -> pa.RecordBatch:
            single = [row for row in rows if row[2] == 1]
            flags = dict(zip(map(id, rows), repeated_windows([row[3] for row in rows], length))) if single else {}
            kept = []
            for row in rows:
                windows = len(row[3]) - length + 1
                ranges = [[0, windows]] if row[2] > 1 else _ranges(flags[id(row)])
                if ranges:
                    kept.append((row[0], row[1], ranges))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([pa.array([row[k] for row in kept], t) for k, t in enumerate(kinds)], ["h", "s", "ranges"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("h", "s", "n", "piece"))):
                if row[:2] == last:
                    continue  # the same segment cut from a row that repeats
                if size > most and row[0] != last[0]:
                    yield marks()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3]) + 1
                last = row[:2]
        if rows:
            yield marks()

    return run


def _window_digests(raw: bytes, length: int) -> list[bytes]:
    import xxhash

    return [xxhash.xxh3_128_digest(raw[k : k + length]) for k in range(len(raw) - length + 1)]


def _windows(length: int, slice_rows: int = 50_000):
    """The different windows of each segment: digest in two halves, the first place and the number of copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in WINDOW.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(row[0] for row in rows), "<i8").reshape(-1, 2)
            columns = [halves[:, 0].copy(), halves[:, 1].copy(), *([row[k] for row in rows] for k in range(1, 5))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        rows: list[tuple] = []
        for batch in batches:
            for h, s, n, piece in zip(*(batch[c] for c in ("h", "s", "n", "piece"))):
                h, s, n = h.as_py(), s.as_py(), n.as_py()
                places: dict[bytes, list[int]] = {}
                for start, digest in enumerate(_window_digests(piece.as_buffer().to_pybytes(), length)):
                    places.setdefault(digest, [start, 0])[1] += 1
                for digest, (start, count) in places.items():
                    rows.append((digest, h, s, start, n * count))
                    if len(rows) >= slice_rows:
                        yield made(rows)
                        rows = []
        yield made(rows)

    return run


def _own_repeats(length: int):
    """Windows of each segment that stand twice in it, or all if it has copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], []]
            for h, s, n, piece in zip(*(batch[c] for c in ("h", "s", "n", "piece"))):
                digests = _window_digests(piece.as_buffer().to_pybytes(), length)
                counts = Counter(digests)
                ranges = [[0, len(digests)]] if n.as_py() > 1 else _ranges(np.array([counts[d] > 1 for d in digests]))
                if ranges:
                    for column, value in zip(columns, (h.as_py(), s.as_py(), ranges)):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["h", "s", "ranges"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of consecutive windows from the lists of their places."""
    for batch in batches:
        ranges = []
        for starts in batch["starts"].to_pylist():
            starts = sorted(starts)
            firsts = [k for k in range(len(starts)) if not k or starts[k] > starts[k - 1] + 1]
            ranges.append([[starts[k], starts[e - 1] + 1] for k, e in zip(firsts, [*firsts[1:], len(starts)])])
        yield pa.RecordBatch.from_arrays([batch["h"], batch["s"], pa.array(ranges, pa.list_(pa.list_(pa.int32())))], ["h", "s", "ranges"])


def _counted(pieces: DataFrame, length: int, store: Store) -> DataFrame:
    """The marks of segments whose names have too many for one index, by the sums of equal windows."""
    windows = store.keep(pieces.mapInArrow(_windows(length), WINDOW), "windows")
    twice = windows.groupBy("v", "w").agg(F.sum("n").alias("places")).where("places > 1").select("v", "w")
    shared = windows.where("n = 1").join(twice, ["v", "w"], "left_semi")
    shared = shared.groupBy("h", "s").agg(F.collect_list("start").alias("starts")).mapInArrow(_runs, MARKS)
    return shared.union(pieces.mapInArrow(_own_repeats(length), MARKS))


def _flagged(classes: DataFrame, hot_segments: int) -> DataFrame:
    """The segments with ``hot`` for those under names with more than ``hot_segments``."""
    hot = classes.groupBy("h").count().where(F.col("count") > hot_segments)
    hot = hot.select("h", F.explode(F.sequence(F.lit(0), F.lit(FLAG_LANES - 1))).alias("lane"), F.lit(True).alias("hot"))
    dealt = classes.withColumn("lane", F.pmod("s", F.lit(FLAG_LANES)).cast("int"))
    return dealt.join(hot, ["h", "lane"], "left").drop("lane").withColumn("hot", F.coalesce("hot", F.lit(False)))


def _repeated(records: DataFrame, store: Store, label: str) -> tuple[DataFrame, DataFrame]:
    """The records whose name occurs twice, also in one record, and their different segments with the number of copies."""
    names = records.groupBy("h").agg(F.sum(F.col("n") * F.col("named")).alias("places")).where("places > 1").select("h")
    live = store.keep(records.join(names, "h", "left_semi"), f"{label}-records")
    place = F.struct("a", "b", "start", "windows")
    return live, live.groupBy("h", "s").agg(F.sum("n").alias("n"), F.min(place).alias("at"))


def _pieces(classes: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """Each segment's bytes, cut from the row it stands in."""
    wanted = F.collect_list(F.struct("h", "s", "n", "hot", F.col("at.start").alias("start"), F.col("at.windows").alias("windows")))
    lists = classes.groupBy(F.col("at.a").alias("a"), F.col("at.b").alias("b")).agg(wanted.alias("wanted"))
    return rows.join(lists, ["a", "b"]).select("piece", "wanted").mapInArrow(_cut(length), PIECE)


def _marked(pieces: DataFrame, length: int) -> DataFrame:
    dealt = pieces.select("h", "s", "n", "piece").repartition("h").sortWithinPartitions("h", "s")
    return dealt.mapInArrow(_index(length), MARKS)


def _moved(live: DataFrame, marks: DataFrame) -> DataFrame:
    """``a, b, ranges``: ranges of repeated windows of each row."""
    placed = live.join(marks, ["h", "s"]).select("a", "b", "start", F.explode("ranges").alias("r"))
    span = F.array((F.col("start") + F.col("r")[0]).cast("int"), (F.col("start") + F.col("r")[1]).cast("int"))
    return placed.groupBy("a", "b").agg(F.collect_set(span).alias("ranges"))


def repeated_ranges(rows: DataFrame, length: int = LENGTH, hot_segments: int = HOT_SEGMENTS, store: Store | None = None) -> DataFrame:
    """``a, b, ranges``: for the rows ``a, b, piece`` the ranges of windows that start elsewhere too."""
    store = store or Store(rows.sparkSession, "repeats")
    gram, long_gram = (max(1, int(length * share)) for share in (GRAM, LONG_GRAM))
    one = rows.withColumn("n", F.lit(1).cast("long"))
    records = store.keep(one.mapInArrow(_records(length, gram), RECORD), "anchors")
    live, classes = _repeated(records, store, "first")
    classes = store.keep(classes, "segments")
    pieces = store.keep(_pieces(_flagged(classes, hot_segments), rows, length), "pieces")
    marks = _marked(pieces.where("not hot"), length)

    # The segments of hot names are the rows of a second naming by longer grams.
    again = pieces.where("hot").select(F.col("h").alias("a"), F.col("s").alias("b"), "n", "piece").dropDuplicates(["a", "b"])
    if not again.isEmpty():
        again = store.keep(again, "hot")
        finer = store.keep(again.mapInArrow(_records(length, long_gram), RECORD), "finer")
        finer_live, finer_classes = _repeated(finer, store, "second")
        finer_classes = store.keep(finer_classes, "finer-segments")
        finer_pieces = store.keep(_pieces(_flagged(finer_classes, hot_segments), again, length), "finer-pieces")
        finer_marks = _marked(finer_pieces.where("not hot"), length).union(_counted(finer_pieces.where("hot"), length, store))
        finer_marks = store.keep(finer_marks, "finer-marks")
        moved = _moved(finer_live, finer_marks)
        marks = marks.union(moved.select(F.col("a").alias("h"), F.col("b").alias("s"), "ranges"))
    return _moved(live, store.keep(marks, "marks"))


# --- passages of words ------------------------------------------------------------

WORD_SEGMENT = "h long, s long, a long, b long, start int, windows int"
WORD_WINDOW = "h long, s long, lo long, hi long, v long, start int"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start (runs of bytes that are no white space), and their hashes."""
    word = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], word.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    hashed = np.empty(len(starts), np.uint64)
    up, down = per_worker("powers", lambda: _powers(STRETCH + (1 << 12)))
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + STRETCH, "right")))
        size = ends[last - 1] - low
        if size >= len(up):  # one word
            up, down = _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((raw[low : low + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        here = starts[first:last] - low
        hashed[first:last] = _mixed((sums[ends[first:last] - low] - sums[here]) * down[here])
        first = last
    return starts, hashed


def _word_groups(pieces: list[bytes], words: int, gram: int, stretch: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, Iterator]]:
    """For texts cut together: the number of the first, each word's text, each text's first word, and stretches of windows.

    A stretch is (first window, hashes of grams and of windows, sums of the words, inverse powers).
    """
    up, down = per_worker("word_powers", lambda: _powers(WORD_STRETCH + (1 << 12)))
    if stretch + words > len(up):
        up, down = _powers(stretch + words)
    for low, high in slices(pieces, GROUP_BYTES):
        raw = np.frombuffer(b" ".join(pieces[low:high]), np.uint8)
        starts, hashed = _word_hashes(raw)
        offsets = np.concatenate([[0], np.cumsum([len(piece) + 1 for piece in pieces[low : high - 1]], dtype=np.int64)])
        owner = np.searchsorted(offsets, starts, "right") - 1
        base = np.searchsorted(owner, np.arange(high - low))

        def stretches():
            size = len(hashed) - words + 1
            for at in range(0, max(size, 0), stretch):
                part = hashed[at : at + stretch + words - 1]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(part * up[: len(part)], out=sums[1:])
                grams, windows = (_mixed((sums[k:] - sums[:-k]) * down[: len(part) - k + 1]) for k in (gram, words))
                yield at, grams, windows, sums, down

        yield low, owner, base, stretches()


def _word_segments(words: int, gram: int, stretch: int):
    """Segments of consecutive windows of words with one name: name, digest, key of the row and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in WORD_SEGMENT.split(", ")]
        for batch in batches:
            a, b = (batch[c].to_numpy(zero_copy_only=False) for c in ("a", "b"))
            for low, owner, base, stretches in _word_groups(batch["piece"].to_pylist(), words, gram, stretch):
                for at, grams, windows, sums, down in stretches:
                    name = _sliding_least(grams, words - gram + 1)
                    first, last = (owner[at + k : at + k + len(name)] for k in (0, words - 1))
                    turns = np.flatnonzero((name[1:] != name[:-1]) | (first[1:] != first[:-1]) | (last[1:] != last[:-1])) + 1
                    starts = np.concatenate([[0], turns])
                    counts = np.diff(np.append(starts, len(name)))
                    inside = first[starts] == last[starts]
                    starts, counts = starts[inside], counts[inside]
                    digest = _mixed((sums[starts + counts + words - 1] - sums[starts]) * down[starts] + counts.astype(np.uint64))
                    row = low + first[starts]
                    place = (starts + at - base[first[starts]]).astype(np.int32)
                    columns = (name[starts].view(np.int64), digest.view(np.int64), a[row], b[row], place, counts.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _word_windows(words: int, gram: int, stretch: int):
    """The windows of the listed segments of each row's piece: digest and place in the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in WORD_WINDOW.split(", ")]
        for batch in batches:
            lists = batch["wanted"]
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            fields = dict(zip(("h", "s", "lo", "hi", "start", "windows"), (f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten())))
            for low, _, base, stretches in _word_groups(batch["piece"].to_pylist(), words, gram, stretch):
                here = slice(*np.searchsorted(row, [low, low + len(base)]))
                count = fields["windows"][here]
                if not len(count):
                    continue
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                digests = np.concatenate([windows for _, _, windows, _, _ in stretches])
                v = digests[np.repeat(base[row[here] - low] + fields["start"][here], count) + step].view(np.int64)
                columns = (*(np.repeat(fields[c][here], count) for c in ("h", "s", "lo", "hi")), v, step.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _covered(words: int):
    """The words of each row in its ranges of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for ranges in batch["ranges"].to_pylist():
                count = at = 0
                for start, end in sorted(ranges):
                    end += words - 1
                    count += max(0, end - max(at, start))
                    at = max(at, end)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(counts, pa.int64())], ["a", "b", "n_passage_words"])

    return run


def shared_passages(rows: DataFrame, words: int = PASSAGE_WORDS, store: Store | None = None, stretch: int = WORD_STRETCH) -> DataFrame:
    """``a, b, n_passage_words``: words of the rows ``a, b, piece`` in runs of ``words`` words that a row of another ``a`` holds too."""
    store = store or Store(rows.sparkSession, "passages")
    gram = max(1, int(words * GRAM))
    records = store.keep(rows.mapInArrow(_word_segments(words, gram, stretch), WORD_SEGMENT), "word-anchors")
    lo, hi = F.min("a").alias("lo"), F.max("a").alias("hi")
    names = records.groupBy("h").agg(lo, hi).where("lo <> hi").select("h")
    live = store.keep(records.join(names, "h", "left_semi"), "word-records")
    classes = live.groupBy("h", "s").agg(lo, hi, F.min(F.struct("a", "b", "start", "windows")).alias("at"))
    classes = store.keep(classes, "word-segments")

    several = classes.groupBy("h").count().where("count > 1").select("h")
    place = [F.col(f"at.{c}").alias(c) for c in ("start", "windows")]
    lists = classes.join(several, "h", "left_semi").groupBy(F.col("at.a").alias("a"), F.col("at.b").alias("b"))
    lists = lists.agg(F.collect_list(F.struct("h", "s", "lo", "hi", *place)).alias("wanted"))
    windows = rows.join(lists, ["a", "b"]).select("piece", "wanted").mapInArrow(_word_windows(words, gram, stretch), WORD_WINDOW)
    windows = store.keep(windows, "word-windows")
    twice = windows.groupBy("h", "v").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("h", "v")
    parts = windows.where("lo = hi").join(twice, ["h", "v"], "left_semi")
    parts = parts.groupBy("h", "s").agg(F.collect_set("start").alias("starts")).mapInArrow(_runs, MARKS)
    whole = classes.where("lo <> hi").select("h", "s", F.array(F.array(F.lit(0), F.col("at.windows"))).alias("ranges"))
    marks = store.keep(whole.union(parts), "word-marks")
    return _moved(live, marks).mapInArrow(_covered(words), "a long, b long, n_passage_words long")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    store: Store | None = None,
    passage_words: int | None = None,
    **options,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept, kept_sha256`` for every row.

    ``kept`` are the remaining bytes; cuts are made between bytes, so they need not be
    whole characters. With ``passage_words`` there is also ``n_passage_words``, the words in
    runs of so many words that another document holds too, removed or not.
    """
    store = store or Store(docs.sparkSession, "repeats")
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.lit(1), F.col(id_col), text).alias("a"),
        F.xxhash64(F.lit(2), F.col(id_col), text).alias("b"),
        F.encode(text, "UTF-8").alias("piece"),
    )
    ranges = repeated_ranges(rows.select("a", "b", "piece"), length, store=store, **options)
    more = []
    if passage_words:
        passages = shared_passages(rows.select("a", "b", "piece"), passage_words, store)
        ranges = ranges.join(passages, ["a", "b"], "full_outer")
        more = [F.coalesce("n_passage_words", F.lit(0).cast("long")).alias("n_passage_words")]
    joined = rows.join(ranges, ["a", "b"], "left").select("id", "piece", "ranges", *more)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for piece, ranges in zip(batch["piece"].to_pylist(), batch["ranges"].to_pylist()):
                kept, at, spans = [], 0, 0
                for start, end in sorted(ranges or []):
                    end += length - 1
                    spans += start > at or not spans
                    kept.append(piece[at:start])
                    at = max(at, end)
                kept = b"".join([*kept, piece[at:]])
                row = (len(piece), len(piece) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest())
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", *batch.schema.names[3:]]
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, t) for c, t in zip(columns, kinds)), *batch.columns[3:]], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    out = joined.mapInArrow(cut, schema + ", n_passage_words long" * bool(more))
    return out.withColumnRenamed("id", id_col)
