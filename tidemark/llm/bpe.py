"""Byte-level BPE encoding and decoding with a vectorised pre-tokeniser.

Text is turned into code points, code points into classes, and classes into the transition functions of a small
automaton. Functions compose associatively, so the state ahead of every code point comes from a two-level scan over
arrays: compose within blocks, compose the blocks, apply. The automaton's flags are the pre-token boundaries; the
slices between them are merged by rank, with a bounded cache of merged slices. No regular expression finds pre-tokens.

A NULL text counts as empty; an empty text has no ids. Rows are handled one by one, so repeated rows, ties and extra
columns make no difference; an empty table gives an empty result. Long texts are scanned in pieces, cut at the first place
behind PIECE code points where a boundary is certain, such as a blank between two words.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back

# Classes of code points. A separator stands between texts that are scanned together.
SEP, BLANK, SPACE, LETTER, NUMBER, OTHER, QUOTE, ONE, TWO = range(9)
# Letter classes: ONE may follow an apostrophe alone (s, t, m, d); TWO starts a pair (re, ve, ll); LETTER is the rest.

# White space beside U+0020, fixed values of the Unicode property White_Space.
WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States: what the scan has just read.
START, IN_L, IN_N, IN_O, AFTER_BLANK, AFTER_SPACE, OPEN_QUOTE, HALF, CLOSED = range(9)
STATES = 9
BLOCK = 64
PIECE = 1 << 18  # code points scanned at a time
CACHE = 200_000  # slices of a generation kept merged
NONE = 1 << 40  # ahead of no rank
MADE = 1 << 20  # bytes of ids and offsets, or of decoded text, in a batch made here


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
    out[WHITE] = SPACE
    out[0x20] = BLANK
    out[0x27] = QUOTE
    out[[ord(c) for c in "stmd"]] = ONE
    return out


def _step(state: int, cls: int, last: bool) -> tuple[int, int]:
    """Next state, and whether a pre-token starts here. ``last``: white space ahead of anything but white space."""
    if cls == SEP:
        return START, 1
    if cls in (BLANK, SPACE):
        joins = state in (AFTER_BLANK, AFTER_SPACE) and not last
        return (AFTER_BLANK if cls == BLANK else AFTER_SPACE), int(not joins)
    own = {NUMBER: IN_N, OTHER: IN_O, QUOTE: IN_O}.get(cls, IN_L)
    if state == AFTER_BLANK or state == own:
        return own, 0
    if cls == QUOTE and state != OPEN_QUOTE:
        return OPEN_QUOTE, 1
    if state == OPEN_QUOTE:
        if cls == ONE:
            return CLOSED, 0
        if cls == TWO:
            return HALF, 0
        if own == IN_O:
            return IN_O, 0
    if state == HALF:
        return CLOSED, 0
    return own, 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Transition function and flag of each symbol; a symbol is a class, plus 9 if it is the last of its white space."""
    move, flag = np.zeros((18, STATES), np.uint8), np.zeros((18, STATES), np.uint8)
    for symbol in range(18):
        for state in range(STATES):
            move[symbol, state], flag[symbol, state] = _step(state, symbol % 9, symbol >= 9)
    return move, flag


MOVE, FLAG = _tables()


def boundaries(points: np.ndarray, more: bool = False) -> np.ndarray:
    """Flags of the code points at which a pre-token starts. Code points above Unicode separate texts.

    ``more``: other text follows that starts with something else than white space.
    """
    cls = np.full(len(points), SEP, np.uint8)
    inside = points < 0x110000
    cls[inside] = classes()[points[inside]]
    after = np.empty_like(points)
    after[:-1], after[-1:] = points[1:], 0
    pair = ((points == 0x72) | (points == 0x76)) & (after == 0x65) | (points == 0x6C) & (after == 0x6C)
    cls[pair] = TWO
    white = (cls == BLANK) | (cls == SPACE)
    solid = np.empty(len(cls), bool)
    solid[:-1], solid[-1:] = ~white[1:] & (cls[1:] != SEP), more
    return scan(cls + 9 * (white & solid).astype(np.uint8))


def scan(symbols: np.ndarray) -> np.ndarray:
    """Run the automaton from START over all symbols by composing transition functions."""
    n = len(symbols)
    blocks = -(-n // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint8)  # filled up with separators
    grid.reshape(-1)[:n] = symbols
    flat = MOVE.reshape(-1)
    # Functions of whole blocks, by composing their columns.
    whole = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (blocks, STATES))
    for j in range(BLOCK):
        whole = flat[grid[:, j, None].astype(np.intp) * STATES + whole]
    # Doubling: after the last round, row i holds the composition of blocks 0 to i.
    reach = 1
    while reach < blocks:
        ahead = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)
        whole = np.concatenate([whole[:reach], ahead])
        reach *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = whole[:-1, START]
    flags, marks = np.zeros((blocks, BLOCK), np.uint8), FLAG.reshape(-1)
    for j in range(BLOCK):
        at = grid[:, j].astype(np.intp) * STATES + state
        flags[:, j] = marks[at]
        state = flat[at]
    return flags.reshape(-1)[:n].astype(bool)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """Merges slices by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.cache = ranks, {}
        self.old: dict[bytes, bytes] = {}  # the generation before; what is met again moves back
        one = [bytes([b]) for b in range(256)]
        self.first = [[ranks.get(a + b, NONE) for b in one] for a in one]  # ranks of two bytes

    def ids(self, piece: bytes) -> bytes:
        """Ids of a slice, packed as little-endian 32-bit integers."""
        packed = self.old.get(piece)
        if packed is None:
            rank = self.ranks.get(piece)
            found = [rank] if rank is not None else self._long(piece) if len(piece) > 100 else self._short(piece)
            packed = struct.pack(f"<{len(found)}I", *found)
        if len(self.cache) >= CACHE:
            self.old = dict(self.cache)
            self.cache.clear()
        if len(piece) <= 100:
            self.cache[piece] = packed
        return packed

    def _short(self, piece: bytes) -> list[int]:
        get, none, first = self.ranks.get, NONE, self.first
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [first[a][b] for a, b in zip(piece, piece[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list, for slices where scanning all pairs would be quadratic."""
        n, get = len(piece), self.ranks.get
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] >= 0 and (r := get(parts[k] + parts[right[k]])) is not None:
                    heapq.heappush(heap, (r, k, len(parts[k]) + len(parts[right[k]])))
        return [self.ranks[p] for p in parts if p is not None]


@lru_cache(2)
def _merger(path: str) -> Merger:
    return Merger(load_ranks(path))


@lru_cache(2)
def _vocabulary(path: str) -> list[bytes]:
    ranks = _merger(path).ranks
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _widths(points: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def slice_offsets(texts: list[str], more: bool = False) -> list[np.ndarray]:
    """Byte offsets at which the pre-tokens of each text start, closed by its length in bytes."""
    points = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    points[(starts - 1)[1:]] = 0xFFFFFFFF
    flags = boundaries(points, more) if len(points) else np.zeros(0, bool)
    widths = _widths(points)
    widths[(starts - 1)[1:]] = 0
    where = np.concatenate([[0], np.cumsum(widths)])
    out = []
    for start, size in zip(starts.tolist(), sizes.tolist()):
        at = start + np.flatnonzero(flags[start : start + size])
        if size and (not len(at) or at[0] != start):
            at = np.concatenate([[start], at])
        out.append(where[np.append(at, start + size)] - where[start])
    return out


#: Places where a pre-token always starts: a letter behind a line feed, a blank behind a letter or digit and ahead of a letter.
SURE = re.compile(r"\n(?=[A-Za-z])|[0-9A-Za-z](?= [A-Za-z])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[A-Za-z0-9](?=[!-&(-/:-@])")


def _cuts(text: str) -> list[str]:
    """Parts of a long text, cut at places where a pre-token always starts: the first one behind each PIECE code points.
    A stretch without any such place, one pre-token or a run of marks or of letters beyond ASCII, is one part."""
    parts, done = [], 0
    while len(text) - done > PIECE and (m := SURE.search(text, done + PIECE)):
        parts.append(text[done : m.end()])
        done = m.end()
    return [*parts, text[done:]]


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts to be scanned together."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > PIECE:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


def encode_texts(texts: Iterable[str], path: str) -> Iterator[tuple[bytes, bytes]]:
    """Packed ids and packed slice offsets of each text."""
    merger = _merger(path)
    get, merge = merger.cache.get, merger.ids
    for group in _groups(texts):
        if len(group) == 1 and len(group[0]) > PIECE:
            parts = _cuts(group[0])
            found, base = [], 0
            for k, part in enumerate(parts):
                found.append(slice_offsets([part], k < len(parts) - 1)[0][:-1] + base)
                base += len(part.encode())
            marks = [np.append(np.concatenate(found), base)]
        else:
            marks = slice_offsets(group)
        for text, at in zip(group, marks):
            data, spots = text.encode(), at.tolist()
            pieces = [data[a:b] for a, b in zip(spots, spots[1:])]
            packed = b"".join([get(p) or merge(p) for p in pieces])
            yield packed, at.astype("<u4" if len(data) < 1 << 32 else "<u8").tobytes()


def _encoded(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, ids, offsets; in batches of about MADE bytes"""
    for batch in batches:
        ids = batch.column(0)
        done, rows, size = 0, [], 0
        for row in encode_texts((v.as_py() for v in batch.column(1)), path):  # a group of texts at a time
            rows.append(row)
            size += len(row[0]) + len(row[1])
            if size > MADE:
                yield _batch(ids.slice(done, len(rows)), rows)
                done, rows, size = done + len(rows), [], 0
        if rows:
            yield _batch(ids.slice(done, len(rows)), rows)


def _decoded(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, ids -> doc_id, ids, decoded; in batches of about MADE bytes"""
    token = _vocabulary(path).__getitem__
    for batch in batches:
        done, out, size = 0, [], 0
        for k, v in enumerate(batch.column(1), 1):
            out.append(b"".join(map(token, np.frombuffer(v.as_buffer(), "<u4").tolist())))
            size += len(out[-1])
            if size > MADE or k == batch.num_rows:
                part = batch.slice(done, len(out))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])
                done, out, size = k, [], 0


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``ids`` (packed little-endian 32-bit), ``offsets`` (packed byte offsets of the
    pre-token slices, closed by the text's length). ``path`` is a rank file that every executor can open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(path, batches)
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return _given(docs, id_col, text_col).mapInArrow(work, f"doc_id {kind}, ids binary, offsets binary")


def _batch(ids: pa.Array, rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [ids, *(pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "offsets"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (bytes) of rows that :func:`encode` made."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(path, batches)
        give_back()

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(work, f"doc_id {kind}, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What :func:`decode` gives for the rows of :func:`encode`, without a second worker that ids are sent to: Spark would
    gather those of up to 10,000 texts in a batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(path, _encoded(path, batches))
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return _given(docs, id_col, text_col).mapInArrow(work, f"doc_id {kind}, ids binary, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode, decode, and reduce both to digests."""
    return round_trip(docs, path).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
