"""Conversations as token ids with a loss mask, put together at the level of tokens.

A turn is ``### role: text</turn>`` and a line end. The three control strings have
reserved ids beyond the vocabulary; role and text are encoded by themselves, so no merge
of the tokenizer crosses a border and no text can make a reserved id. Inside roles and
texts a backslash goes before every backslash and before the first character of whatever
a reader of the rendered text could take for a control string, so that both the ids and
the rendered text give the turns back.

Turns are encoded where they lie, in parallel, and only then brought together by
conversation. A task walks its sorted turns and gives out pieces of whole turns of
about ``PIECE_IDS`` ids, so a conversation of any length takes the memory of one piece.
Starts of turns are prefix sums of their lengths. The mask is the prefix sum of marks:
+1 where a trained text starts, -1 behind its end.

Reading back needs only the pieces: reserved ids split them into turns, the mask picks
the trained ids, and digests run on from piece to piece.

Edge cases: a null role or text is an empty one; turns are ordered by number (null
first), then by role and ids; a null conversation id is a conversation of its own;
repeated rows are turns of their own; a text of any length is one turn; columns of other
names are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.common import per_worker, slices, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
HEAD, SEPARATOR, END = CONTROL = ("### ", ": ", "</turn>\n")
TRAINED_ROLE = "assistant"
PIECE_IDS = 1 << 16
#: Characters of texts that are encoded at a time.
SLICE = 1 << 20

TURNS = "conv_id long, turn long, role string, ids array<int>, start int, stop int"
PIECES = "conv_id long, piece long, first long, ids array<int>, loss array<byte>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

# A backslash, a sign that starts three signs, the end mark.
_IN_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
# In a role also the colon, which would end it.
_IN_ROLE = re.compile(r"\\|#(?=##)|<(?=/turn>)|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _IN_TEXT.sub(r"\\\g<0>", text)


def escape_role(role: str) -> str:
    return _IN_ROLE.sub(r"\\\g<0>", role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> str:
    """The text that the ids of ``turns`` (role, text) stand for."""
    return "".join(f"{HEAD}{escape_role(r)}{SEPARATOR}{escape(t)}{END}" for r, t in turns)


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(rendered)]


class Codec:
    """A byte-level tokenizer with reserved ids for the control strings behind its vocabulary."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.head, self.separator, self.end = range(size, size + len(CONTROL))
        byte_of = _bytes_of_characters()
        self.raw = [b""] * size
        for token, number in vocabulary.items():
            self.raw[number] = bytes(byte_of[c] for c in token if c in byte_of)
        self.raw += [text.encode() for text in CONTROL]
        self.roles: dict[str, list[int]] = {}

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def role_ids(self, role: str) -> list[int]:
        known = self.roles.get(role)
        if known is None:
            if len(self.roles) > 1_000:
                self.roles.clear()
            known = self.roles[role] = self.ids([escape_role(role)])[0]
        return known

    def turn(self, role: str, ids: list[int]) -> tuple[list[int], int, int]:
        """Ids of a turn, and where the ids of its text start and stop."""
        before = [self.head, *self.role_ids(role), self.separator]
        return [*before, *ids, self.end], len(before), len(before) + len(ids)

    def text(self, ids) -> str:
        return b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")


def _bytes_of_characters() -> dict[str, int]:
    """What the characters of byte-level tokens stand for: printable bytes themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _codec(tokenizer_file: str) -> Codec:
    return per_worker(f"chat:{tokenizer_file}", lambda: Codec(tokenizer_file))


def _tokenizer_file(tokenizer_file: str | None) -> str:
    if tokenizer_file:
        return tokenizer_file
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<byte>": pa.list_(pa.int8())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def encode_turns(conversations: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """Each turn with its ids and where in them its text starts and stops."""
    file = _tokenizer_file(tokenizer_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = _codec(file), _arrow(TURNS)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, SLICE):
                roles = batch.column("role")[a:b]
                coded = codec.ids([escape(text) for text in texts[a:b]])
                turns = [codec.turn(role, ids) for role, ids in zip(roles.to_pylist(), coded)]
                columns = [batch.column("conv_id")[a:b], batch.column("turn")[a:b], roles]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, t) for c, t in zip(zip(*turns), schema.types[3:]))], schema=schema)

    kept = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    rows = conversations.select(*kept, *(text_or_empty(c).alias(c) for c in ("role", "text")))
    return rows.mapInArrow(encode, TURNS)


def assemble(turns: DataFrame, piece_ids: int = PIECE_IDS, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Pieces of whole turns: ``(conv_id, piece, first, ids, loss)``; ``first`` is the place of the first id in the conversation."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(PIECES)
        now, piece, first, held, marks, size = None, 0, 0, [], [], 0

        def finished():
            ids = np.concatenate(held)
            change = np.zeros(size + 1, np.int64)
            np.add.at(change, np.array([m for m, _ in marks], np.int64), np.array([s for _, s in marks], np.int64))
            loss = np.cumsum(change[:-1]).astype(np.int8)
            rows = [[now[0]], [piece], [first], [ids], [loss]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types)], schema=schema)

        for batch in batches:
            lists = batch.column("ids")
            # Starts of the turns are prefix sums of their lengths; Arrow keeps them as offsets.
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            keys = [batch.column(c).to_pylist() for c in ("conv_id", "role", "start", "stop")]
            for k, (conv, role, start, stop) in enumerate(zip(*keys)):
                if now != (conv,) or size >= piece_ids:
                    if held:
                        yield finished()
                    piece, first = (piece + 1, first + size) if now == (conv,) else (0, 0)
                    now, held, marks, size = (conv,), [], [], 0
                if role == trained_role:
                    marks += [(size + start, 1), (size + stop, -1)]
                held.append(values[offsets[k] : offsets[k + 1]])
                size += int(offsets[k + 1] - offsets[k])
        if held:
            yield finished()

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "ids"]
    return turns.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(walk, PIECES)


def read_back(pieces: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """Per conversation what its pieces hold: number and digest of turns, length and digest of the text under the mask, rendered length."""
    file = _tokenizer_file(tokenizer_file)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = _codec(file), _arrow(DIGESTS)
        now = found = None
        rows: list[tuple] = []

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            rows.clear()
            return made

        for batch in batches:
            for conv, ids, loss in zip(*(batch.column(c) for c in ("conv_id", "ids", "loss"))):
                if now != (conv.as_py(),):
                    if found:
                        rows.append((now[0], *found.row()))
                    now, found = (conv.as_py(),), _Digest(codec)
                found.add(ids.values.to_numpy(), loss.values.to_numpy())
            if rows:
                yield flush()
        if found:
            rows.append((now[0], *found.row()))
            yield flush()

    order = [F.col("conv_id").asc_nulls_first(), "piece"]
    return pieces.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(read, DIGESTS)


class _Digest:
    """Counts and digests of one conversation, piece by piece."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
        for role, text in turns_of(self.codec, ids):
            self.turns += 1
            self.chars += sum(map(len, CONTROL)) + len(role) + len(text)
            self.all.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
        trained = unescape(self.codec.text(ids[loss == 1].tolist()))
        self.loss_chars += len(trained)
        self.loss.update(trained.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def turns_of(codec: Codec, ids: np.ndarray) -> list[tuple[str, str]]:
    """Escaped roles and texts of whole turns, split at the reserved ids."""
    heads, separators, ends = (np.flatnonzero(ids == mark).tolist() for mark in (codec.head, codec.separator, codec.end))
    all_ids = ids.tolist()
    return [(codec.text(all_ids[h + 1 : s]), codec.text(all_ids[s + 1 : e])) for h, s, e in zip(heads, separators, ends)]
