"""SentencePiece encoding and decoding for merge-type vocabularies.

The text gets its leading mark, spaces become marks, and the text falls apart where
two neighbouring characters stand side by side in no piece: no merge can cross such a
place. Each part is encoded by an agenda of adjacent symbol pairs ordered by score,
ties from the left; what no piece covers falls back to byte pieces. Parts and the units
between spaces repeat, so each worker keeps the ones in use, and every unit with a new
part is checked against the library, one call per Arrow batch.

Edge cases: a null or empty text has no ids and decodes to an empty text; a mark that
stands in the text itself is a space, as in the library. Ties, repeated rows and very
long texts need nothing special: a row depends on its text alone. A unit that differs from
the library ends the job with an error that names it. An empty table gives no rows, and
columns of other names are not read.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import per_worker, sha256_text, slices, text_or_empty

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Units and parts that a worker keeps in one generation, some 250 bytes each.
KEPT_UNITS, KEPT_PARTS = 200_000, 200_000
#: Characters whose units are learnt at a time.
SLICE = 1 << 22
#: Characters up to which a part's agenda is a list.
SHORT = 48
NEVER = float("inf")


class Pieces:
    """The vocabulary: scores of pieces, byte pieces, and neighbours within pieces."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.library.get_piece_size()
        self.names = [self.library.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))
        ]
        self.cost = {self.names[i]: -self.library.get_score(i) for i in plain}
        self.number = {self.names[i]: i for i in plain}
        byte_ids = [i for i in range(size) if self.library.is_byte(i)]
        self.byte_number = {int(self.names[i][3:-1], 16): i for i in byte_ids}
        self.raw = [name.encode() for name in self.names]
        for value, i in self.byte_number.items():
            self.raw[i] = bytes([value])
        self.unknown = self.library.unk_id()
        self.joined = {name[k : k + 2] for name in self.cost for k in range(len(name) - 1)}

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part after all merges: the best-scoring adjacent pair first, ties from the left."""
        symbols = self._merge_short(part) if len(part) <= SHORT else self._merge_long(part)
        ids, number = [], self.number
        for symbol in symbols:
            known = number.get(symbol)
            if known is not None:
                ids.append(known)
            elif self.byte_number:
                ids += [self.byte_number[b] for b in symbol.encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.unknown)
        return ids

    def _merge_short(self, part: str) -> list[str]:
        """The agenda as a list: the cost of each adjacent pair in the order of the text."""
        symbols, cost = list(part), self.cost.get
        agenda = [cost(pair, NEVER) for pair in map(add, part, part[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], NEVER)
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        """The agenda as a heap, for parts in which a list would be walked too often."""
        cost, symbols, end = self.cost, list(part), len(part)
        agenda = [(cost[pair], i, pair) for i, pair in enumerate(map(add, part, part[1:])) if pair in cost]
        heapify(agenda)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while agenda:
            _, i, pair = heappop(agenda)
            j = after[i]
            if not symbols[i] or j == end or symbols[i] + symbols[j] != pair:
                continue  # one of the two was merged meanwhile
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                if pair + symbols[k] in cost:
                    heappush(agenda, (cost[pair + symbols[k]], i, pair + symbols[k]))
            h = before[i]
            if h >= 0 and symbols[h] + pair in cost:
                heappush(agenda, (cost[symbols[h] + pair], h, symbols[h] + pair))
        return [symbol for symbol in symbols if symbol]

    def parts(self, unit: str) -> list[str]:
        """The unit cut where no piece holds both neighbours."""
        cuts = [k for k, pair in enumerate(map(add, unit, unit[1:]), 1) if pair not in self.joined]
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, the leading mark's space still there."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode("utf-8", "replace").replace(MARK, " ")


class Kept:
    """A bounded memory of two generations: when the younger one is full it becomes the
    older one, from which entries in use move over again, so that rare ones are forgotten."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def missing(self, names: set[str]) -> set[str]:
        """Those that neither generation has; the older one's entries move over."""
        lacking = names.difference(self.young)
        moved = [name for name in lacking if name in self.old]
        self.young.update(zip(moved, map(self.old.__getitem__, moved)))
        lacking.difference_update(moved)
        return lacking

    def settle(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}

    def __contains__(self, name: str) -> bool:
        return name in self.young or name in self.old


class Units:
    """Ids and decoded texts by units, the stretches between spaces.

    Kept are the ids of units and of their parts as text, and the decoded texts of the
    units that decode to something else than themselves.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.ids, self.parts = Kept(KEPT_UNITS), Kept(KEPT_PARTS)
        self.odd: dict[str, str] = {}
        self.odd_parts: dict[str, str] = {}

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by commas, decoded text)."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str], check: bool = True) -> Iterator[tuple[str, str]]:
        """The same for every text; new units are learnt slice by slice."""
        for start, end in slices(texts, SLICE):
            yield from self._encode_slice([text.replace(MARK, " ") for text in texts[start:end]], check)

    def _encode_slice(self, texts: list[str], check: bool) -> list[tuple[str, str]]:
        split = [text.split(" ") for text in texts]
        split = [_with_runs(units) if "" in units else units for units in split]
        gc.disable()  # nothing that is made here is in a cycle
        try:
            self._learn(self.ids.missing(set().union(*split)), check)
            found, odd = self.ids.young.__getitem__, self.odd
            out = []
            for text, units in zip(texts, split):
                decoded = text if odd.keys().isdisjoint(units) else " ".join([odd.get(unit, unit) for unit in units])
                out.append((",".join(map(found, units)), decoded) if text else ("", ""))
        finally:
            gc.enable()
        self.ids.settle()
        self.parts.settle()
        self.odd = {unit: decoded for unit, decoded in odd.items() if unit in self.ids}
        self.odd_parts = {part: decoded for part, decoded in self.odd_parts.items() if part in self.parts}
        return out

    def _learn(self, units: set[str], check: bool) -> None:
        """Ids of units that are not known yet; those with a new part are compared with the library, in one call."""
        listed = list(units)
        cut = [self.pieces.parts(MARK + unit) for unit in listed]
        new = self.parts.missing(set().union(*cut))
        for part in new:
            ids = self.pieces.encode_part(part)
            decoded = self.pieces.decode(ids)
            self.parts.young[part] = ",".join(map(str, ids))
            if decoded != part.replace(MARK, " "):
                self.odd_parts[part] = decoded
        found = self.parts.young.__getitem__
        self.ids.young.update(zip(listed, [",".join(map(found, parts)) for parts in cut]))
        for unit, parts in zip(listed, cut):
            if MARK in unit or self.odd_parts and not self.odd_parts.keys().isdisjoint(parts):
                self.odd[unit] = "".join([self.odd_parts.get(part, part) for part in parts]).replace(MARK, " ")[1:]
        if check:
            # The library takes no lone mark as its input.
            self._check([unit for unit, parts in zip(listed, cut) if unit and not new.isdisjoint(parts)])

    def _check(self, units: list[str]) -> None:
        known = self.ids.young
        for unit, ids in zip(units, self.pieces.library.encode(units, num_threads=1) if units else []):
            if known[unit] != ",".join(map(str, ids)):
                raise ValueError(f"unit {unit!r} differs from the library: {known[unit]} and {ids}")


def _with_runs(words: list[str]) -> list[str]:
    """Units in which a run of spaces stays with the word that follows it."""
    units, run = [], ""
    for word in words[:-1]:
        if word:
            units.append(run + word)
            run = ""
        else:
            run += MARK
    return units + [run + words[-1]]


def _units(model_file: str | None) -> Units:
    if model_file is None:
        import public_tokenizers

        model_file = public_tokenizers.path(MODEL)
    return per_worker(f"pieces of {model_file}", lambda: Units(Pieces(model_file)))


def encode_column(text_col: str = "text", model_file: str | None = None, check: bool = True):
    """A column ``struct<n_tokens, ids_sha256, decoded_sha256, ids>`` of a text column."""
    return _encoder(model_file, check, True)(text_or_empty(text_col))


def digest_column(text_col: str = "text", model_file: str | None = None, check: bool = True):
    """As ``encode_column`` but without the ids."""
    return _encoder(model_file, check, False)(text_or_empty(text_col))


def _encoder(model_file: str | None, check: bool, with_ids: bool):
    fields = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string" + ", ids: array<int>" * with_ids

    @F.arrow_udf(f"struct<{fields}>")
    def encode(texts: pa.Array) -> pa.Array:
        units = _units(model_file)
        counts, digests, decoded_digests, raw = [], [], [], []
        for ids, decoded in units.encode_all(texts.to_pylist(), check):
            counts.append(ids.count(",") + 1 if ids else 0)
            digests.append(sha256_text(ids))
            decoded_digests.append(sha256_text(decoded))
            if with_ids:
                raw.append(np.fromstring(ids, dtype=np.int32, sep=",") if ids else np.zeros(0, np.int32))
        arrays = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded_digests, pa.string())]
        if with_ids:
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.concatenate(raw) if raw else np.zeros(0, np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())))
        return pa.StructArray.from_arrays(arrays, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(arrays)])

    return encode


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256, ids`` for every row."""
    coded = docs.select(id_col, encode_column(text_col, model_file).alias("coded"))
    return coded.select(id_col, "coded.*")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` for every row."""
    coded = docs.select(id_col, digest_column(text_col, model_file).alias("coded"))
    return coded.select(id_col, "coded.*")


def decode_column(ids_col: str = "ids", model_file: str | None = None):
    """The decoded text of a column of ids; null ids decode to an empty text."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        pieces = _units(model_file).pieces
        return pa.array([pieces.decode(i).removeprefix(" ") if i else "" for i in ids.to_pylist()], pa.string())

    return decode(F.col(ids_col))
