"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and texts are lower-cased (A-Z) and cut into words. The automaton holds every
run of words of every item; a text's words are fed to it one by one and it tracks the
length of the longest match that ends at each word. Where that length reaches the
window (13 words), the last 13 words stand in an item; an item shorter than a window
counts when it is matched whole. Hit words become spans, which can be cut out, and
texts over the limits are marked.

Items are read in the order of their ids and packed into automata of at most
``SHARD_WORDS`` words; each is one broadcast variable, so no broadcast grows with the
benchmark, and a task goes through them one after the other.

Edge cases: null and empty texts or items have no words and hit nothing; items
of one id count as one, a null id is the empty name; a benchmark without rows
leaves every text clean; repeated documents are judged alike, row by row. Columns
of other names are not read, and an empty table of documents gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import WORD_TABLE, text_or_empty, words_of

WINDOW = 13
#: A text is contaminated if a word is hit and hits * COVERAGE >= words.
COVERAGE = 20
#: Words of items in one automaton: at most twice as many states, some 100 MB.
SHARD_WORDS = 200_000


class Automaton:
    """All runs of words of the items added; ``window`` is the least length of a match."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}
        for _, words in items:
            for word in words:
                self.number.setdefault(word, len(self.number))
        self.width = max(1, len(self.number))
        self.next: dict[int, int] = {}  # state * width + word -> state
        self.length, self.link = [0], [-1]
        self.edges: list[list[int]] = [[]]
        coded = [(item, [self.number[word] for word in words]) for item, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        del self.edges
        self.least = min([window, *(len(words) for _, words in coded)]) if coded else window
        self._name_windows(coded)

    def _extend(self, last: int, word: int) -> int:
        """Adds one word after state ``last``; returns the state of the longer run."""
        go, length, link, width = self.next, self.length, self.link, self.width
        at = go.get(last * width + word)
        if at is not None:
            return at if length[at] == length[last] + 1 else self._clone(last, word, at)
        new = self._state(length[last] + 1)
        while last >= 0 and last * width + word not in go:
            self._connect(last, word, new)
            last = link[last]
        if last < 0:
            link[new] = 0
            return new
        at = go[last * width + word]
        link[new] = at if length[at] == length[last] + 1 else self._clone(last, word, at)
        return new

    def _clone(self, last: int, word: int, at: int) -> int:
        """Splits the shorter runs off state ``at``."""
        go, width = self.next, self.width
        copy = self._state(self.length[last] + 1)
        self.link[copy] = self.link[at]
        for other in self.edges[at]:
            self._connect(copy, other, go[at * width + other])
        self.link[at] = copy
        while last >= 0 and go.get(last * width + word) == at:
            go[last * width + word] = copy
            last = self.link[last]
        return copy

    def _state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(-1)
        self.edges.append([])
        return len(self.length) - 1

    def _connect(self, state: int, word: int, to: int) -> None:
        self.next[state * self.width + word] = to
        self.edges[state].append(word)

    def _name_windows(self, coded: list[tuple[str, list[int]]]) -> None:
        """Which items hold the window that ends in a state, and whole short items."""
        self.window_items: dict[int, set[str]] = {}
        short: dict[int, tuple[int, set[str]]] = {}
        for item, words in coded:
            state = 0
            for k, word in enumerate(words):
                state = self.next[state * self.width + word]
                if k + 1 >= self.window:
                    self.window_items.setdefault(self._holder(state, self.window), set()).add(item)
            if len(words) < self.window:
                holder = self._holder(state, len(words))
                short.setdefault(holder, (len(words), set()))[1].add(item)
        # The short items that end wherever a state is reached: its own and its suffixes'.
        self.short: list[tuple] = [()] * len(self.length)
        if short:
            for state in sorted(range(len(self.length)), key=self.length.__getitem__):
                above = self.short[self.link[state]] if state else ()
                self.short[state] = (short[state], *above) if state in short else above

    def _holder(self, state: int, length: int) -> int:
        """The state of the suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, end exclusive and merged, and the items that hit."""
        ids = np.fromiter(map(self.number.get, words, [-1] * len(words)), np.int64, len(words))
        known = np.concatenate([[False], ids >= 0, [False]])
        turns = np.flatnonzero(known[1:] != known[:-1])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for start, end in zip(turns[::2], turns[1::2]):
            if end - start >= self.least:
                self._scan_run(ids[start:end].tolist(), int(start), spans, items)
        return _merged(spans), items

    def _scan_run(self, ids: list[int], start: int, spans: list, items: set) -> None:
        go, width, link, lengths, window = self.next, self.width, self.link, self.length, self.window
        state = matched = 0
        for at, word in enumerate(ids, start + 1):
            to = go.get(state * width + word)
            while to is None and state:
                state = link[state]
                matched = lengths[state]
                to = go.get(state * width + word)
            if to is None:
                continue
            state = to
            matched += 1
            if matched >= window:
                spans.append((at - window, at))
                items |= self.window_items[self._holder(state, window)]
            for size, names in self.short[state]:
                if size <= matched:
                    spans.append((at - size, at))
                    items |= names


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _packed(benchmark: DataFrame, id_col: str, text_col: str, shard_words: int) -> Iterator[list]:
    """Items in the order of their ids, in lists of at most so many words."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = benchmark.select(name.alias("i"), text_or_empty(text_col).alias("t")).distinct().orderBy("i", "t")
    items, size = [], 0
    for row in rows.toLocalIterator():
        words = words_of(row["t"])
        if items and size + len(words) > shard_words:
            yield items
            items, size = [], 0
        items.append((row["i"], words))
        size += len(words)
    if items:
        yield items


def hits_column(
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
):
    """A column ``struct<n_words, n_hit, spans, items>`` of a text column.

    ``spans`` are pairs of word numbers from 0, end exclusive; ``items`` are sorted as strings.
    """
    context = benchmark.sparkSession.sparkContext
    shards = [
        context.broadcast(cloudpickle.dumps(Automaton(items, window)))
        for items in _packed(benchmark, item_id_col, item_text_col, shard_words)
    ]

    held: dict[int, Automaton] = {}

    def automaton(number: int) -> Automaton:
        """One at a time in a task, so that many shards take no more memory than one."""
        if number not in held:
            held.clear()
            held[number] = cloudpickle.loads(shards[number].value)
        return held[number]

    @F.arrow_udf("struct<n_words: bigint, n_hit: bigint, spans: array<array<int>>, items: array<string>>")
    def hits(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        spans = [[] for _ in texts]
        items = [set() for _ in texts]
        n_words = [0] * len(texts)
        for shard in range(max(1, len(shards))):
            for k, text in enumerate(texts):
                words = words_of(text)
                n_words[k] = len(words)
                if shards:
                    found, names = automaton(shard).scan(words)
                    spans[k] = _merged(spans[k] + found) if spans[k] else found
                    items[k] |= names
        columns = [
            pa.array(n_words, pa.int64()),
            pa.array([sum(e - s for s, e in found) for found in spans], pa.int64()),
            pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            pa.array([sorted(names) for names in items], pa.list_(pa.string())),
        ]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_hit", "spans", "items"])

    return hits(text_or_empty(text_col))


def contaminated(n_hit, n_words, coverage: int = COVERAGE):
    return (n_hit > 0) & (n_hit * coverage >= n_words)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col, n_words, n_hit, spans, items, contaminated`` for every row."""
    hits = docs.select(id_col, hits_column(benchmark, text_col, **options).alias("hits"))
    hits = hits.select(id_col, "hits.*")
    return hits.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    hits = hits_column(benchmark, text_col, **options)
    return docs.where(~contaminated(hits["n_hit"], hits["n_words"]))


def cut_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 0, coverage: int = COVERAGE, **options) -> DataFrame:
    """``id_col, text, n_cut``: texts without the hit spans of more than ``longest`` words.

    All spans go where hits cover a ``coverage``-th of the words or more. A span reaches
    from its first word's first character to its last word's last one.
    """

    @F.arrow_udf("struct<text: string, n_cut: bigint>")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out, gone = [], []
        for text, hit in zip(texts.to_pylist(), hits.to_pylist()):
            over = hit["n_hit"] and hit["n_hit"] * coverage >= hit["n_words"]
            spans = [s for s in hit["spans"] if over or s[1] - s[0] > longest]
            raw = text.encode()
            places = _word_places(raw) if spans else []
            for start, end in reversed(spans):
                raw = raw[: places[start][0]] + raw[places[end - 1][1] :]
            out.append(raw.decode())
            gone.append(sum(e - s for s, e in spans))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(gone, pa.int64())], ["text", "n_cut"])

    rows = docs.select(id_col, text_or_empty(text_col).alias("t"))
    rows = rows.select(id_col, "t", hits_column(benchmark, "t", **options).alias("hits"))
    return rows.select(id_col, cut("t", "hits").alias("cut")).select(id_col, "cut.*")


def _word_places(raw: bytes) -> list[tuple[int, int]]:
    flags = np.frombuffer(b" " + raw.translate(WORD_TABLE) + b" ", np.uint8) != 32
    turns = np.flatnonzero(flags[1:] != flags[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def items_digest(items: str):
    """Lowercase hex SHA-256 of the sorted item ids joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)
