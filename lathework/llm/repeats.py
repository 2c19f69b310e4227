"""Repeated substrings: an enhanced suffix array, its interval tree, and removal of what an earlier document holds.

Within a set of strings, suffixes are sorted, neighbours' common prefixes form the LCP array, and a stack scan over it
yields the LCP intervals, that is the nodes of the common-prefix interval tree: all suffixes that share a prefix which
cannot be extended to the right. Extending such a group to the left as far as its members agree, and splitting it where
they do not (the left-extension test), gives maximal repeat groups with all their occurrences.

To do this for a corpus, every run of `least` bytes is represented by its minimizer, the k-byte string in it of the
smallest hash: equal runs have equal minimizers. A chunk of documents sends each distinct pair of a minimizer and a
hash of its surroundings (all runs it can represent) once, with the earliest document that has it, however often it
occurs. Where the same surroundings are in an earlier document, all those runs are repeats; where a minimizer has
several surroundings, and only there, the earliest holder of each sends them once, and they go into the suffix array of
their minimizer. Minimizers with very many surroundings are split into bands by a longer core that all runs of a band
contain. Answers go back to the chunk, which knows all occurrences.

Buckets of minimizers grow in number with the input, so what a task holds of it does not depend on the input's size.

Defined results: a null text is empty and stays so. Rows that share an id are the same document, so they do not remove
each other's text. Ids are whole numbers; null ids come before all others. Texts below `least` bytes are never touched.
Equal surroundings are told by 96 hash bits and those of the bucket; different ones are compared byte by byte. Columns
beside id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm.common import given_back, null_first, partitions, small_batches, written

TABLE = np.random.default_rng(50).integers(0, 2**64, 256, np.uint64, endpoint=False)
BASE = 0x100000001B3
PLACE = np.uint64((1 << 24) - 1)
SEGMENT = 1 << 18
ROW = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary())])
ROW_SQL = "kind int, chunk long, bucket long, data binary"


# Interval tree of one set of strings


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


def lcp_intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, depth) of the LCP intervals at least that deep; lcp[i] is of entries i and i + 1. Inner ones first."""
    stack: list[tuple[int, int]] = []  # (first, depth)
    for i, depth in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][1] > depth:
            first, was = stack.pop()
            if was >= least:
                yield first, i, was
        if depth and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))


def two_sided_repeats(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[list[int], int, int]]:
    """Maximal repeat groups through one point: (members, bytes to the left, bytes to the right).

    lefts: what precedes the point, reversed; rights: what follows. Intervals of the sorted rights are right-maximal;
    intervals of their members' sorted lefts are left-diverse.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    for first, last, depth in lcp_intervals(lcp, max(1, least - max(map(len, lefts)))):
        need = least - depth
        members = sorted(order[first : last + 1], key=lefts.__getitem__)
        back = [common_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)]
        if need <= 0 and min(back) == 0:
            yield members, 0, depth
        for a, z, reach in lcp_intervals(back, max(1, need)):
            yield members[a : z + 1], reach, depth


def maximal_repeats(texts: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(text, start), ...]): all maximal repeat groups of a small set of texts, by its whole suffix array."""
    suffixes = [(t, s) for t, x in enumerate(texts) for s in range(len(x))]
    suffixes.sort(key=lambda at: texts[at[0]][at[1] :])
    lcp = [common_prefix(texts[a][i:], texts[b][j:]) for (a, i), (b, j) in zip(suffixes, suffixes[1:], strict=False)]
    for first, last, depth in lcp_intervals(lcp, least):
        members = suffixes[first : last + 1]
        before = {texts[t][s - 1] if s else -1 - t for t, s in members}
        if len(before) > 1 or min(before) < 0:
            yield depth, sorted(members)


# Minimizers


def rolled(x: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Polynomial hashes of all runs of the given sizes."""
    power, size = {1: x}, 1
    while 2 * size <= max(sizes):
        half = power[size]
        power[2 * size] = half[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + half[size:] if len(half) > size else half[:0]
        size *= 2
    out = {}
    for want in sizes:
        have, total = 0, None
        for p in sorted(power, reverse=True):
            if have + p <= want:
                n = max(0, len(x) - have - p + 1)
                total = power[p][:n] if total is None else total[:n] * np.uint64(pow(BASE, p, 1 << 64)) + power[p][have : have + n]
                have += p
        out[want] = total
    return out


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def slid(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Anchors:
    """The minimizers of a chunk: document, position, hash, hash of the surroundings; by position."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, least: int, k: int, buckets: int):
        self.reach = least - k
        ends = np.cumsum(sizes)
        starts = ends - sizes
        docs, places, hashes, around = [], [], [], []
        a = 0
        while a < len(sizes):  # blocks of documents, and overlapping segments of very long ones
            z = max(a + 1, int(np.searchsorted(ends, starts[a] + SEGMENT, side="right")))
            for low in range(int(starts[a]), max(int(starts[a]) + 1, int(ends[z - 1]) - 2 * least), SEGMENT):
                high = min(int(ends[z - 1]), low + SEGMENT + 2 * least + self.reach)
                self._block(data, starts, ends, a, z, max(int(starts[a]), low - self.reach), high, least, k, docs, places, hashes, around)
            a = z
        doc, place, h, c = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((docs, np.int64), (places, np.int64), (hashes, np.uint64), (around, np.uint64)))
        if len(place):
            _, keep = np.unique(place, return_index=True)
            doc, place, h, c = doc[keep], place[keep], h[keep], c[keep]
        self.owner = (h >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)
        self.doc, self.place, self.hash, self.around = doc, place, h, c
        self.left = np.minimum(self.reach, self.place - starts[self.doc])
        self.right = np.minimum(least, ends[self.doc] - self.place)

    def _block(self, data, starts, ends, a, z, low, high, least, k, docs, places, hashes, around) -> None:
        part = data[low:high]
        if len(part) < least:
            return
        rolls = rolled(TABLE[part], [k, self.reach, least])
        h = stirred(rolls[k])
        minima = slid((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), self.reach + 1)
        doc_of = np.searchsorted(ends[a:z], np.arange(len(minima)) + low, side="right") + a if z - a > 1 else np.full(len(minima), a)
        inside = np.arange(len(minima)) + low + least <= ends[doc_of]
        at = np.unique(minima[inside] & PLACE).astype(np.int64)
        doc = np.searchsorted(ends[a:z], at + low, side="right") + a
        whole = (at + low - starts[doc] >= self.reach) & (at + low + least <= ends[doc]) & (at >= self.reach) & (at + least <= len(part))
        c = np.zeros(len(at), np.uint64)
        w = at[whole]
        c[whole] = stirred(rolls[self.reach][w - self.reach] * np.uint64(BASE) + stirred(rolls[least][w]))
        for i in np.flatnonzero(~whole).tolist():
            p, d = int(at[i]) + low, doc[i]
            l, r = min(self.reach, p - int(starts[d])), min(least, int(ends[d]) - p)
            full = l == self.reach and r == least
            if full:  # only cut by the segment: the same hash as elsewhere
                x = rolled(TABLE[data[p - l : p + r]], [self.reach, least])
                c[i] = stirred(x[self.reach][:1] * np.uint64(BASE) + stirred(x[least][l : l + 1]))[0]
            else:
                c[i] = xxhash.xxh3_64_intdigest(data[p - l : p + r].tobytes(), l * 64 + r)
        docs.append(doc)
        places.append(at + low)
        hashes.append(stirred(h[at] * np.uint64(0x9E3779B97F4A7C15)))  # minimizers have small hashes: mixed again for even buckets
        around.append(c)


class Items:
    """The distinct (minimizer, surroundings) of a chunk, sorted by bucket and the smallest rank that has them."""

    def __init__(self, x: Anchors, ranks: np.ndarray):
        rank = ranks[x.doc]
        order = np.lexsort((x.place, rank, x.around, x.hash))
        h, c = x.hash[order], x.around[order]
        new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])) if len(order) else np.zeros(0, bool)
        first = order[new]
        by_bucket = np.lexsort((rank[first], x.owner[first]))
        place = np.empty_like(by_bucket)
        place[by_bucket] = np.arange(len(by_bucket))
        self.first = first[by_bucket]
        self.rank = rank[self.first]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = place[np.cumsum(new) - 1]
        self.later = rank > self.rank[self.of] if len(order) else np.zeros(0, bool)
        self.anchors = x
        cuts = np.flatnonzero(np.diff(x.owner[self.first], prepend=-1, append=-1)) if len(first) else []
        self.parts = [(int(x.owner[self.first[a]]), slice(a, z)) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]

    def runs(self, wanted: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the items in the mask: (item, document, first, last) of their occurrences of the smallest rank, those at
        most `least` bytes apart together, as the runs around them overlap."""
        x = self.anchors
        at = np.flatnonzero(wanted[self.of] & ~self.later) if len(self.of) else np.zeros(0, np.int64)
        at = at[np.lexsort((x.place[at], self.of[at]))]
        item, doc, place = self.of[at], x.doc[at], x.place[at]
        new = np.append(True, (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > least)) if len(at) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        last = np.append(starts[1:], len(at)) - 1 if len(at) else starts
        return item[starts], doc[starts], place[starts], place[last]


# Chunks and buckets


def squeezed(**arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def restored(data: bytes) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def sent_rows(*rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROW, strict=True)], schema=ROW)


def by_first(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != now:
                if rows:
                    yield now, rows
                now, rows = row[0], []
            rows.append(row)
    if rows:
        yield now, rows


def chunked(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    source = docs.select(null_first(F.col(id).cast("long")).alias("rank"), F.col(id).alias("id"), F.col(text).alias("text"))
    key = source.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ranks, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def flush() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            row = [pa.array([number], pa.int64()), pa.array([data], pa.binary()), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([ranks], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*row, pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, key_type))], ["chunk", "data", "sizes", "ranks", "ids"])

        for batch in batches:
            key_type = batch.schema.field(1).type
            for rank, i, x in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()), strict=True):
                ranks.append(rank.as_py())
                ids.append(i.as_py())
                texts.append(x.as_py() or b"")
                held += len(texts[-1])
                if held >= size:
                    yield flush()
                    number, ranks, ids, texts, held = number + 1, [], [], [], 0
        if texts:
            yield flush()

    fields = [("chunk", T.LongType()), ("data", T.BinaryType()), ("sizes", T.ArrayType(T.LongType())), ("ranks", T.ArrayType(T.LongType())), ("ids", T.ArrayType(key))]
    return source.mapInArrow(given_back(run), T.StructType([T.StructField(*f) for f in fields]))


def opened(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)


def verdicts(parts: list[dict], crowd: int) -> list[np.ndarray]:
    """For every item 1: an earlier document has the same minimizer and surroundings; 2 or 3: the minimizer has other
    surroundings too, few or many; 0: neither."""
    h = np.concatenate([p["h"] for p in parts])
    c = np.concatenate([p["c"] for p in parts])
    rank = np.concatenate([p["ranks"][p["doc"]] for p in parts])
    order = np.lexsort((rank, c, h))
    h, c, rank = h[order], c[order], rank[order]
    new_h = np.append(True, h[1:] != h[:-1])
    new_c = new_h | np.append(True, c[1:] != c[:-1])
    group = np.cumsum(new_h) - 1
    kinds = np.bincount(group[new_c])[group]
    earliest = rank[np.maximum.accumulate(np.where(new_c, np.arange(len(h)), 0))]
    out = np.empty(len(h), np.uint8)
    out[order] = np.where(rank > earliest, 1, np.where(kinds > crowd, 3, np.where(kinds > 1, 2, 0)))
    return np.split(out, np.cumsum([len(p["h"]) for p in parts])[:-1])


def bands(reach: int, least: int, width: int = 6) -> list[tuple[int, int]]:
    """Ranges of how far left of the minimizer a run starts."""
    return [(t, min(reach, t + width - 1)) for t in range(0, reach + 1, width)]


def located(parts: list[dict], least: int) -> list[list[tuple[int, int, int]]]:
    """For each part the (entry, left, right) that a member of a smaller rank has too."""
    key = np.concatenate([p["key"] for p in parts])
    of = np.repeat(np.arange(len(parts)), [len(p["key"]) for p in parts])
    entry = np.concatenate([np.arange(len(p["key"])) for p in parts])
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order], prepend=key[order[0]] + np.uint64(1), append=key[order[-1]] + np.uint64(1)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    bounds = [np.cumsum(p["left"].astype(np.int64) + p["right"]) for p in parts]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        if z - a < 2:
            continue
        members, lefts, rights, ranks = [], [], [], []
        for i in order[a:z].tolist():
            p, j = parts[of[i]], int(entry[i])
            stop, l = int(bounds[of[i]][j]), int(p["left"][j])
            start = stop - l - int(p["right"][j])
            members.append((int(of[i]), j))
            lefts.append(p["bytes"][start : start + l][::-1])
            rights.append(p["bytes"][start + l : stop])
            ranks.append(int(p["rank"][j]))
        farthest = [-1] * len(members)  # groups come with r falling, so one that reaches no farther left adds nothing
        for group, l, r in two_sided_repeats(lefts, rights, least):
            lowest = min(ranks[i] for i in group)
            for i in group:
                if ranks[i] > lowest and l > farthest[i]:
                    farthest[i] = l
                    part, j = members[i]
                    found[part].append((j, l, r))
    return found


def spans_of(part: dict, found: list[tuple[int, int, int]]) -> dict[str, np.ndarray]:
    """(document, start, stop) of all occurrences of the entries found."""
    j, l, r = np.array(found, np.int64).T
    n = part["n_runs"].astype(np.int64)
    at = np.repeat((np.cumsum(n) - n)[j] - (np.cumsum(n[j]) - n[j]), n[j]) + np.arange(n[j].sum())
    return {"doc": part["doc"][at].astype(np.int64), "start": part["first"][at] - np.repeat(l, n[j]), "stop": part["last"][at] + np.repeat(r, n[j])}


def covered(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of (start, stop) rows as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, z in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def drop_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 50, k: int = 20, chunk_bytes: int = 1 << 20, bucket_bytes: int = 32 << 20, crowd: int = 2000, with_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept, spans]) for each row of docs: removed is every byte inside
    a run of `least` bytes that also starts in a document of a smaller id. kept and spans are the bytes that stay and
    the (start, stop) of what went. A bucket gets the minimizers of about bucket_bytes of text."""
    spark = docs.sparkSession
    width = partitions(spark)
    small_batches(spark)
    chunks = written(chunked(docs, id, text, chunk_bytes), "repeat-chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = 1 << max(4, (max(2 * width, total // bucket_bytes) - 1).bit_length())
    tasks = min(buckets, max(width, buckets // 4))
    files = max(1, tasks // 16)  # answers are small beside what they are made from

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, sizes, ranks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = Anchors(opened(data), np.array(sizes, np.int64), least, k, buckets)
                items = Items(x, np.array(ranks, np.int64))
                h = ((x.hash[items.first] << np.uint64(buckets.bit_length() - 1)) >> np.uint64(32)).astype(np.uint32)
                rows = []
                for bucket, own in items.parts:
                    here, doc = np.unique(items.rank[own], return_inverse=True)
                    rows.append((0, chunk, bucket, squeezed(h=h[own], c=x.around[items.first[own]], doc=np.diff(doc, prepend=0).astype(np.int16 if len(here) < 1 << 15 else np.int64), ranks=np.diff(here, prepend=0))))
                if rows:
                    yield sent_rows(*rows)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_first(batches):
            parts = [restored(r[2]) for r in rows]
            for p in parts:
                p["doc"], p["ranks"] = np.cumsum(p["doc"].astype(np.int64)), np.cumsum(p["ranks"])
            rows = [(1, r[1], bucket, squeezed(v=v)) for r, v in zip(rows, verdicts(parts, crowd), strict=True) if v.any()]
            if rows:
                yield sent_rows(*rows)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in by_first(batches):
            data, sizes = opened(rows[0][3]), np.array(rows[0][4], np.int64)
            x = Anchors(data, sizes, least, k, buckets)
            items = Items(x, np.array(rows[0][5], np.int64))
            flags = np.zeros(len(items.first), np.uint8)
            parts = dict(items.parts)
            for r in rows[1:]:
                flags[parts[r[2]]] = restored(r[3])["v"]
            same = np.flatnonzero((items.later | (flags[items.of] == 1)) & (x.left + x.right >= least))
            if len(same):
                gone = np.stack([x.doc[same], x.place[same] - x.left[same], x.place[same] + x.right[same]], 1)
                new = np.append(True, (gone[1:, 0] != gone[:-1, 0]) | (gone[1:, 1] > np.maximum.accumulate(gone[:, 2])[:-1]))
                starts = np.flatnonzero(new)
                yield sent_rows((2, chunk, -1, squeezed(doc=gone[starts, 0], start=gone[starts, 1], stop=np.maximum.reduceat(gone[:, 2], starts))))
            left, right = x.left[items.first], x.right[items.first]
            few = np.flatnonzero(flags == 2)
            key, at, lefts, rights = [x.hash[items.first[few]]], [few], [left[few]], [right[few]]
            for t, u in bands(x.reach, least):  # a crowd's runs that start t to u bytes before the minimizer
                many = np.flatnonzero((flags == 3) & (left >= t) & (right >= least - u))
                core = [xxhash.xxh3_64_intdigest(data[p - t : p + least - u].tobytes(), t) for p in x.place[items.first[many]].tolist()]
                key.append(np.array(core, np.uint64))
                at.append(many)
                lefts.append(np.minimum(left[many], u))
                rights.append(np.minimum(right[many], least - t))
            key, at, left, right = map(np.concatenate, (key, at, lefts, rights))
            if not len(key):
                continue
            run_item, run_doc, run_first, run_last = items.runs(flags >= 2, least)
            low, high = np.searchsorted(run_item, at, side="left"), np.searchsorted(run_item, at, side="right")
            owner = (stirred(key) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1))
            rows = []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                own = order[a:z]
                place = x.place[items.first[at[own]]]
                body = b"".join(data[p - l : p + r].tobytes() for p, l, r in zip(place.tolist(), left[own].tolist(), right[own].tolist(), strict=True))
                n = high[own] - low[own]
                run = np.repeat(low[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                rows.append((3, chunk, int(owner[own[0]]), squeezed(key=key[own], rank=items.rank[at[own]], left=left[own].astype(np.uint16), right=right[own].astype(np.uint16), bytes=body, n_runs=n.astype(np.uint32), doc=run_doc[run].astype(np.uint32), first=run_first[run], last=run_last[run])))
            for i in range(0, len(rows), 64):
                yield sent_rows(*rows[i : i + 64])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_first(batches):
            if bucket < 0:
                yield from (sent_rows((2, r[2], -1, r[3])) for r in rows)
                continue
            parts = [restored(r[3]) for r in rows]
            for r, part, found in zip(rows, parts, located(parts, least), strict=True):
                if found:
                    yield sent_rows((2, r[2], bucket, squeezed(**spans_of(part, found))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_first(batches):
            data, sizes, ids = opened(rows[0][3]), np.array(rows[0][4], np.int64), rows[0][6]
            starts = np.cumsum(sizes) - sizes
            got = [restored(r[3]) for r in rows[1:]]
            spans = np.stack([np.concatenate([g[f] for g in got]) for f in ("doc", "start", "stop")], 1) if got else np.zeros((0, 3), np.int64)
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            docs_of = spans[:, 0].tolist()
            out = []
            for d, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                i = bisect_left(docs_of, d)
                j = bisect_left(docs_of, d + 1, i)
                gone = covered(spans[i:j, 1:]) if j > i else []
                kept, at = [], a
                for s, e in gone:
                    kept.append(data[at:s].tobytes())
                    at = e
                whole = b"".join([*kept, data[at : a + n].tobytes()])
                out.append((n, n - len(whole), len(gone), hashlib.sha256(whole).hexdigest(), *((whole, [s - a for s, _ in gone], [e - a for _, e in gone]) if with_text else ())))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), *(pa.array(c, t) for c, t in zip(columns, arrow_types, strict=True))], names)

    requests = chunks.select("chunk", "data", "sizes", "ranks").mapInArrow(given_back(asked), ROW_SQL)
    dealt = requests.select("bucket", "chunk", "data").repartition(tasks, "bucket").sortWithinPartitions("bucket", "chunk")
    replies = written(dealt.mapInArrow(given_back(judged), ROW_SQL).repartition(files), "repeat-verdicts")
    texts = chunks.select("chunk", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("bucket"), "data", "sizes", "ranks", "ids")
    nothing = [F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("sizes", "ranks", "ids")]
    both = texts.unionByName(replies.select("chunk", "kind", "bucket", "data", *nothing)).repartition(width, "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    around = both.mapInArrow(given_back(settled), ROW_SQL)
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("chunk"), F.lit(buckets))).otherwise(F.col("bucket")).alias("bucket")
    grouped = around.select(spread, "kind", "chunk", "data").repartition(tasks, "bucket").sortWithinPartitions("bucket", "chunk")
    spans = written(grouped.mapInArrow(given_back(searched), ROW_SQL).repartition(files), "repeat-spans")
    final = texts.unionByName(spans.select("chunk", "kind", "bucket", "data", *nothing)).repartition(width, "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    key = docs.schema[id].dataType
    key_type = pa.int64() if isinstance(key, T.LongType) else pa.int32()
    fields = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    fields += [("kept", T.BinaryType()), ("starts", T.ArrayType(T.LongType())), ("stops", T.ArrayType(T.LongType()))] if with_text else []
    arrow_types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())][: len(fields)]
    names = [id, *(n for n, _ in fields)]
    return final.mapInArrow(given_back(cut), T.StructType([T.StructField(id, key), *(T.StructField(n, t) for n, t in fields)]))
