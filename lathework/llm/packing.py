"""Packing token sequences with non-negative least squares.

Documents are tokenised and packed where they are read, without a shuffle, in blocks of about `block` tokens. In a
block, whole windows of long documents become sequences of their own. For the rests, all combinations of two or three
lengths that fill a window exactly, and those of four that hold two of the most frequent short ones, are the columns of
a non-negative least-squares problem whose right side is the histogram of rests. The solution spreads over very many
columns, so it is rounded by its running total; that says how often each combination is used, as far as there are rests
for it. What this leaves is solved again, a few times. What then remains is packed greedily, largest fitting piece
first, and a piece is cut only if none fits. The end of a block is cut into sequences whose lengths are powers of two,
which need no padding.

Defined results: a null or empty text is the end id alone. Every row is packed, also rows that share an id. Sequence
ids hold the number of the partition, so they are unique and the same when a lost task is run again. Columns beside id
and text are not looked at. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lathework.llm.common import given_back, small_batches

Piece = tuple[int, int, int]  # document, start, length
RUN = 2048


@functools.cache
def encoders(json_path: str, ranks_path: str, pattern: str):
    """The tokenizer itself, and a faster encoder with the same vocabulary."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    exact = Tokenizer.from_file(json_path)
    return exact, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def long_run(text: str) -> bool:
    """Whether any block of RUN characters is all white space, all letters, all digits or none of these; a run of twice
    that length holds such a block."""
    blocks = (text[i : i + RUN] for i in range(0, len(text) - RUN + 1, RUN))
    return any(b.isspace() or b.isalpha() or b.isdigit() or not re.search(r"[\w\s]", b) for b in blocks)


class Encoder:
    """Ids of byte-level BPE. Texts with a special token's string, or beyond the basic plane, where Unicode versions of
    the two libraries may differ, or with very long runs of one kind of character, which the faster one's pattern can't
    take, go to the tokenizer itself."""

    def __init__(self, json_path: str, ranks_path: str):
        self.paths = json_path, ranks_path
        self.specials: tuple[str, ...] | None = None

    def ids(self, text: str) -> np.ndarray:
        import public_tokenizers

        exact, fast = encoders(*self.paths, public_tokenizers.PATTERN)
        if self.specials is None:
            self.specials = tuple(x.content for x in exact.get_added_tokens_decoder().values())
        if any(s in text for s in self.specials) or (not text.isascii() and max(text) > "\uffff") or long_run(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)


def combinations(histogram: np.ndarray, window: int, often: int = 8) -> np.ndarray:
    """Sorted combinations of present lengths that sum to the window, filled up with zeros in front: all of two and of
    three, and those of four that hold two of the `often` most frequent lengths below a quarter of the window."""
    present = np.flatnonzero(histogram)
    there = np.zeros(window + 1, bool)
    there[present] = True
    a = present[(2 * present <= window)]
    pairs = a[there[window - a]]
    zero = np.zeros_like(pairs)
    out = [np.stack([zero, zero, pairs, window - pairs], 1)]
    x, y = np.meshgrid(present, present, indexing="ij")
    z = window - x - y
    ok = (x <= y) & (y <= z)
    x, y, z = x[ok], y[ok], z[ok]
    ok = there[z]
    out.append(np.stack([np.zeros_like(x[ok]), x[ok], y[ok], z[ok]], 1))
    short = present[4 * present <= window]
    short = np.sort(short[np.argsort(-histogram[short], kind="stable")[:often]])
    for i, a in enumerate(short.tolist()):
        for b in short[i:].tolist():
            c = present[2 * present <= window - a - b]
            c = c[there[window - a - b - c]]
            four = np.stack([np.full_like(c, a), np.full_like(c, b), c, window - a - b - c], 1)
            out.append(np.sort(four, axis=1))
    return np.unique(np.concatenate(out), axis=0)


def nonnegative_least_squares(columns: np.ndarray, target: np.ndarray, rounds: int = 60, enough: float = 1e-2) -> np.ndarray:
    """min |A x - target| with x >= 0, A[l, c] being how often length l is in combination c; multiplicative updates
    until a round of ten changes the error by less than `enough` of it."""
    before = np.inf
    spread = lambda y: y[columns].sum(1)
    mass = np.where(np.arange(len(target)) > 0, target, 0).astype(float)
    goal = spread(mass)
    x = np.full(len(columns), mass.sum() / max(1, 3 * len(columns)))
    for i in range(rounds):
        y = np.bincount(columns.ravel(), weights=np.repeat(x, columns.shape[1]), minlength=len(target))
        y[0] = 0
        if i % 10 == 9:
            error = float(((y - mass) ** 2).sum())
            if error >= (1 - enough) * before:
                break
            before = error
        x *= goal / np.maximum(spread(y), 1e-9)
    return x


def plan(rests: np.ndarray, window: int, solves: int = 4) -> list[list[int]]:
    """Groups of rests (indices) that fill windows exactly; each rest is in one group at most."""
    waiting: dict[int, list[int]] = {}
    for i in np.argsort(rests, kind="stable")[::-1].tolist():
        waiting.setdefault(int(rests[i]), []).append(i)
    groups: list[list[int]] = []
    for _ in range(solves):
        histogram = np.zeros(window + 1, np.int64)
        for n, own in waiting.items():
            histogram[n] = len(own)
        columns = combinations(histogram, window)
        if not len(columns):
            break
        total = np.floor(np.cumsum(nonnegative_least_squares(columns, histogram)) + 0.5).astype(np.int64)
        times, before = np.diff(total, prepend=0), len(groups)
        for c in np.flatnonzero(times).tolist():
            lengths = [int(v) for v in columns[c] if v]
            for _ in range(int(times[c])):
                if any(len(waiting[v]) < lengths.count(v) for v in lengths):
                    break
                groups.append([waiting[v].pop() for v in lengths])
        if len(groups) - before < 0.02 * len(groups):
            break
    return groups


def greedy(pieces: list[Piece], window: int) -> Iterator[list[Piece]]:
    """Sequences of all pieces: the largest that fits goes in, else the smallest is cut. All are full but the last
    ones, whose sizes are powers of two."""
    left = sum(n for _, _, n in pieces)
    waiting = sorted((n, d, s) for d, s, n in pieces)
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        row: list[Piece] = []
        while room:
            at = bisect_right(waiting, (room, float("inf"), 0))
            if at:
                n, d, s = waiting.pop(at - 1)
                row.append((d, s, n))
                room -= n
            else:
                n, d, s = waiting.pop(0)
                row.append((d, s, room))
                rest = (n - room, d, s + room)
                waiting.insert(bisect_right(waiting, rest), rest)
                room = 0
        yield row


def packed(sizes: np.ndarray, window: int) -> Iterator[list[Piece]]:
    """Sequences for documents of these sizes."""
    for d in np.flatnonzero(sizes >= window).tolist():
        for s in range(0, int(sizes[d]) // window * window, window):
            yield [(d, s, window)]
    owners = np.flatnonzero(sizes % window)
    rests = sizes[owners] % window
    piece = lambda i: (int(owners[i]), int(sizes[owners[i]] - rests[i]), int(rests[i]))
    used = np.zeros(len(rests), bool)
    for group in plan(rests, window):
        used[group] = True
        yield [piece(i) for i in group]
    yield from greedy([piece(i) for i in np.flatnonzero(~used).tolist()], window)


COLUMNS = {"start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType(), "doc_tokens": T.LongType(), "sequence_id": T.LongType(), "offset": T.LongType()}


def pack(docs: DataFrame, json_path: str, ranks_path: str, id: str = "doc_id", text: str = "text", window: int = 1024, end_id: int = 0, block: int = 1 << 22, with_ids: bool = False) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids (unsigned
    little-endian 32-bit) if asked for."""
    encoder = Encoder(json_path, ranks_path)
    small_batches(docs.sparkSession)
    docs = docs.select(id, text)
    types = {**COLUMNS, **({"ids": T.BinaryType()} if with_ids else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        keys, tokens, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            sizes = np.array([len(t) for t in tokens], np.int64)
            who, rows = [], []
            for pieces in packed(sizes, window):
                offset = 0
                for d, s, n in pieces:
                    data = tokens[d][s : s + n].tobytes()
                    who.append(keys[d])
                    rows.append((s, n, zlib.crc32(data), int(sizes[d]), sequence, offset, data)[: 6 + with_ids])
                    offset += n
                sequence += 1
            for i in range(0, len(rows), 20_000):
                part = list(zip(*rows[i : i + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(who[i : i + 20_000], key_type), *(pa.array(c, pa.binary() if with_ids and k == 6 else pa.int64()) for k, c in enumerate(part))], [id, *types])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, x in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encoder.ids(x.as_py() or ""), np.uint32(end_id)).astype("<u4")
                keys.append(key.as_py())
                tokens.append(ids)
                held += len(ids)
                if held >= block:
                    yield from flush()
                    keys, tokens, held = [], [], 0
        if tokens:
            yield from flush()

    return docs.mapInArrow(given_back(run), T.StructType([docs.schema[id], *(T.StructField(k, t) for k, t in types.items())]))
