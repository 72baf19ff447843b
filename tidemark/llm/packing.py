"""Packing into training sequences: vector bin packing by the dot-product heuristic.

An example is a vector of tokens, one segment, and loss-bearing tokens, which are its last ones (the answer); a sequence
has a limit on each. One sequence is open at a time, and the next example is the one, of those that fit, whose vector has
the greatest dot product with what is left in the sequence, each demand weighted by its mean over the pool. Tasks keep a
pool of some thousand examples, fill sequences while the pool is large and refill it, so memory is bounded and a poor fit
can only come at the end of a task. Nothing is shuffled: rows are packed where they are read, and a hot source or a group
of copies costs what any other rows cost.

Where cuts are allowed, what is left in a sequence is filled with the head of an example. A sequence that still ends early
(no example left, or another limit met) is cut back to a power of two, a length that needs no padding, and the rest goes
back to the pool; so nothing is padded. Where cuts are not allowed, an example above a limit has a sequence to itself.

Token ids come from the public tokenizer, whose merges never reach across a blank that follows a character other than
white space. Texts are split there, each distinct slice is encoded once per task and kept in a bounded cache, and ids are
joined from it; a text of any length is cut so, but a slice is encoded whole, however long.

A NULL text counts as empty, and an empty text has the end id alone. A NULL id stays NULL. Rows are packed one by one, so
repeated rows, ties and extra columns make no difference; an empty table gives an empty result. Sequence numbers tell
sequences apart and have gaps.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POOL = 1024  # examples to choose from
CHARACTERS = 1 << 20  # of texts that are encoded together
CACHE = 400_000  # slices of a generation
LONGEST = 64  # characters of a slice that is kept
END = bytes(4)  # the id 0


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


class Packer:
    """Packs examples of one task. ``add`` and ``finish`` give sequences: lists of ``(example, start, length)``."""

    def __init__(self, limits: Limits, cut: bool) -> None:
        self.limits, self.cut = limits, cut
        self.size = 0
        self.what: list[tuple[object, int]] = [(None, 0)] * (2 * POOL)  # the example, and where its rest starts
        self.tokens, self.loss = np.zeros(2 * POOL), np.zeros(2 * POOL)  # each has one segment

    def add(self, example: object, tokens: int, loss: int) -> Iterator[list[tuple[object, int, int]]]:
        self._put(example, 0, tokens, min(loss, tokens))
        if self.size >= POOL:
            while self.size > POOL // 2:
                yield self._sequence()

    def finish(self) -> Iterator[list[tuple[object, int, int]]]:
        while self.size:
            yield self._sequence()

    def _put(self, example: object, start: int, tokens: int, loss: int) -> None:
        if self.size == len(self.what):
            self.what += [(None, 0)] * self.size
            self.tokens, self.loss = (np.concatenate([x, np.zeros_like(x)]) for x in (self.tokens, self.loss))
        self.what[self.size] = (example, start)
        self.tokens[self.size], self.loss[self.size] = tokens, loss
        self.size += 1

    def _take(self, k: int) -> tuple[object, int, int, int]:
        (example, start), tokens, loss = self.what[k], int(self.tokens[k]), int(self.loss[k])
        self.size -= 1
        for x in (self.what, self.tokens, self.loss):
            x[k] = x[self.size]
        self.what[self.size] = (None, 0)
        return example, start, tokens, loss

    def _sequence(self) -> list[tuple[object, int, int]]:
        limits = self.limits
        room, segments, loss_room = limits.tokens, limits.segments, limits.loss
        # Weights: mean demands over the pool. Demands and room count as shares of the limits.
        by_tokens = self.tokens[:self.size].mean() / limits.tokens**3
        by_loss = self.loss[:self.size].mean() / limits.loss**3
        by_segments = 1 / limits.segments**3
        taken: list[tuple[object, int, int, int]] = []
        while self.size and room > 0 and segments > 0:
            need, bears = self.tokens[:self.size], self.loss[:self.size]
            product = need * (by_tokens * room) + bears * (by_loss * loss_room) + by_segments * segments
            product[(need > room) | (bears > loss_room)] = -1.0
            k = int(product.argmax())
            if product[k] >= 0:
                example, start, tokens, loss = self._take(k)
            elif self.cut:
                # The head that fits: all of the room, or as much as has no more loss-bearing tokens than are left.
                heads = np.minimum(need - 1, np.minimum(room, need - bears + loss_room))
                k = int(heads.argmax())
                head = int(heads[k])
                if head <= 0:
                    break
                example, start, tokens, loss = self._take(k)
                kept = max(0, head - (tokens - loss))
                self._put(example, start + head, tokens - head, loss - kept)
                tokens, loss = head, kept
            elif taken:
                break
            else:  # above a limit by itself
                example, start, tokens, loss = self._take(0)
            taken.append((example, start, tokens, loss))
            room, segments, loss_room = room - tokens, segments - 1, loss_room - loss
        if self.cut and room > 0:
            over = limits.tokens - room
            over -= 1 << (over.bit_length() - 1)
            while over:
                example, start, tokens, loss = taken.pop()
                back = min(over, tokens)
                over -= back
                self._put(example, start + tokens - back, back, min(loss, back))
                if back < tokens:
                    taken.append((example, start, tokens - back, max(0, loss - back)))
        return [(example, start, tokens) for example, start, tokens, _ in taken]


# --- token ids

@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out; a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others in order
    from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_CHARACTERS = _byte_characters()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers. Slices that follow a blank are kept in two generations: when
    the younger one is full it becomes the older, and what is met again moves back."""

    AFTER_WHITE = re.compile(r"\s ")
    SAFE_BLANK = re.compile(r"(?<=\S) ")
    #: Words and marks, of one line or two: letters, marks and a line feed are tokens apart.
    SIMPLE = re.compile(r"([^\W\d_]+)([^\w\s']*)(?:\n([^\W\d_]+)([^\w\s']*))?")

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        if self.tokenizer.normalizer is not None or not repr(self.tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False"):
            raise ValueError(f"{path} is no byte-level tokenizer whose pre-tokens can be cut at blanks")
        self.model = self.tokenizer.model
        self.young = Slices(self)
        self.old: dict[str, bytes] = {}

    def slices(self, text: str) -> list[str]:
        """The text up to the first blank that follows other than white space, then what follows each of these blanks."""
        return self.SAFE_BLANK.split(text) if self.AFTER_WHITE.search(text) else text.split(" ")

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, key: str, text: str) -> bytes:
        """Ids of one pre-token, by the tokenizer's merges alone."""
        ids = dict.get(self.young, key) or self.old.get(key)
        if ids is None:
            tokens = self.model.tokenize(text.encode().decode("latin1").translate(BYTE_CHARACTERS))
            ids = array("I", [t.id for t in tokens]).tobytes()
        self.young[key] = ids
        return ids

    def learn(self, s: str) -> bytes:
        """Ids of a slice that follows a blank. Keys that begin with a line feed are parts that follow none."""
        if (ids := self.old.get(s)) is not None:
            return ids
        if s.isalpha():
            return self.part(s, " " + s)
        if (m := self.SIMPLE.fullmatch(s)) and m[1].isalpha() and (m[3] is None or m[3].isalpha()):
            ids = self.part(m[1], " " + m[1])
            for part in (m[2],) if m[3] is None else (m[2], "\n", m[3], m[4]):
                ids += self.part("\n" + part, part) if part else b""
            return ids
        return self.encode(" " + s)

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if len(self.young) > CACHE:
                self.young, self.old = Slices(self), self.young
            own = self.slices(text)
            head, own[0] = own[0], None  # in its place the younger generation has no ids
            first = (self.part("\n" + head, head) if head.isalpha() else self.encode(head)) if head else b""
            yield first + b"".join(map(self.young.__getitem__, own))


class Slices(dict):
    """Ids of slices, which the encoder finds when they are first asked for."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__({None: b""})
        self.encoder = encoder

    def __missing__(self, s: str) -> bytes:
        ids = self.encoder.learn(s)
        if len(s) <= LONGEST:
            self[s] = ids
        return ids


_encoders: dict[str, Encoder] = {}  # of this worker, with their caches


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
PIECE_TYPES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_texts(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of texts in sequences: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit integers),
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset``. All but a text's first token bear loss."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encoder = Packer(limits, True), _encoder(tokenizer)
        number = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        held = 0

        def place(sequences: Iterable[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal number, rows, held
            for sequence in sequences:
                offset = 0
                for (doc, base, ids, tokens), start, length in sequence:
                    rows.append((doc, base + start, length, ids[4 * start:4 * (start + length)], tokens, number, offset))
                    offset += length
                held += offset
                number += 1
                if held > 1 << 20:
                    yield made()

        def made() -> pa.RecordBatch:
            nonlocal rows, held
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECE_TYPES.types)], schema=PIECE_TYPES)
            rows, held = [], 0
            return out

        for doc_ids, texts in _groups(batches):
            for doc, ids in zip(doc_ids, encoder.batch(texts)):
                ids += END
                tokens = len(ids) // 4
                tail = tokens % limits.tokens if limits.loss >= limits.tokens else tokens
                if full := tokens - tail:  # full sequences leave at once, so that the pool holds tails alone
                    yield from place([[((doc, 0, ids, tokens), at, limits.tokens)] for at in range(0, full, limits.tokens)])
                if tail:
                    yield from place(packer.add((doc, full, ids[4 * full:], tokens), tail, tail - (full == 0)))
        yield from place(packer.finish())
        if rows:
            yield made()

    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(pack, PIECES)


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows, so many at a time that their texts are of bounded size, or one."""
    ids, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(1)
        for k in range(batch.num_rows):
            text = column[k].as_py()
            if texts and size + len(text) > CHARACTERS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(batch.column(0)[k].as_py())
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` joined, and the ``lengths`` of its segments in order. At most ``Limits.segments`` rows meet."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"), F.col("parts.length").alias("lengths"))


def pack_examples(examples: DataFrame, limits: Limits = Limits(), tokens_col: str = "tokens", loss_col: str = "loss") -> DataFrame:
    """Whole examples in sequences, for instruction data: ``examples`` with ``sequence_id`` and ``offset``. An example has
    ``tokens`` of which the last ``loss`` bear loss; NULL counts as 0. An example above a limit has a sequence to itself."""
    schema = examples.select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema
    width = len(examples.columns)
    tokens_at, loss_at = examples.columns.index(tokens_col), examples.columns.index(loss_col)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, False)
        number = TaskContext.get().partitionId() << 36

        def made(packed: Iterable[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for sequence in packed:
                rows = [pa.RecordBatch.from_arrays(row.columns, names=[str(k) for k in range(width)]) for row, _, _ in sequence]
                whole = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                offsets = np.cumsum([0, *[length for _, _, length in sequence[:-1]]])
                yield pa.RecordBatch.from_arrays(
                    [*whole.columns, pa.array([number] * len(rows), pa.int64()), pa.array(offsets, pa.int64())], names=schema.names)
                number += 1

        for batch in batches:
            sizes = zip(batch.column(tokens_at).to_pylist(), batch.column(loss_at).to_pylist())
            for k, (tokens, loss) in enumerate(sizes):
                yield from made(packer.add(batch.slice(k, 1), tokens or 0, loss or 0))
        yield from made(packer.finish())

    return examples.mapInArrow(pack, schema)


def judge(docs: DataFrame, tokenizer: str, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    pieces = pack_texts(docs, tokenizer, limits)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
