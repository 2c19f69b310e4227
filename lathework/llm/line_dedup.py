"""Line deduplication with two Bloom filters.

Pass 1 sends only line hashes (8 bytes each, distinct within a task) to reducers that own a hash range. Each
reducer runs them through a once-seen and a twice-seen Bloom filter and returns the filter of hashes met more
than once, folded to its share of a fixed byte budget. The set of filters is therefore of bounded size whatever the
input and can be broadcast; when the budget is tight the filters only let more lines through to the exact stage.
Pass 2 shuffles the lines that pass the filter and counts documents per line exactly. Pass 3 removes lines; only
documents with a suspected line are shuffled.

Defined results: null or empty text is one empty line. Rows that share an id are one document when documents are
counted, and all of them keep or lose lines alike. Null ids are one document that sorts before all others. Input
columns named n_lines or n_dropped are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm.common import fresh, given_back, null_first, partitions, small_batches, written

FLUSH = 1 << 20
PROBES = 4


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def keys_of(text: bytes | None, least: int) -> set[bytes]:
    return {k for line in set((text or b"").split(b"\n")) if long_enough(k := line_key(line), least)}


def positions(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit positions of each hash in a filter of a power of two bits; folding the filter keeps them valid."""
    step = (hashes >> np.uint64(23)) | np.uint64(1)
    for i in range(PROBES):
        yield ((hashes + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


class Bloom:
    """A filter of a power of two bits: one byte a bit while it is built, packed once it is only asked."""

    def __init__(self, bits: int, data: bytes | None = None):
        self.bits, self.packed = bits, data is not None
        self.set = np.zeros(bits, bool) if data is None else np.frombuffer(data, np.uint8)

    @classmethod
    def sized(cls, items: int, most_bits: int = 1 << 33) -> Bloom:
        return cls(max(64, min(most_bits, 1 << (max(1, 10 * items) - 1).bit_length())))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in positions(hashes, self.bits):
            found &= (self.set[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) if self.packed else self.set[at]
        return found

    def add(self, hashes: np.ndarray) -> None:
        for at in positions(hashes, self.bits):
            self.set[at] = True

    def data(self) -> bytes:
        return np.packbits(self.set, bitorder="little").tobytes()


def twice_seen(blobs: list[np.ndarray], repeated: list[np.ndarray]) -> np.ndarray:
    """Hashes that a once-seen and a twice-seen filter hold to be in several blobs; repeated ones are known to be."""
    once = Bloom.sized(sum(map(len, blobs)))
    twice = Bloom.sized(sum(map(len, blobs)))
    out = [*repeated]
    for blob in blobs:
        seen = once.has(blob)
        fresh = blob[seen & ~twice.has(blob)]
        twice.add(fresh)
        once.add(blob[~seen])
        out.append(fresh)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


class HashFilters:
    """Twice-seen filters by hash range."""

    def __init__(self, buckets: int, filters: Iterable[tuple[int, int, bytes]]):
        self.shift = np.uint64(64 - (buckets.bit_length() - 1))
        self.parts = {b: (bits, data) for b, bits, data in filters}

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash whether it may occur more than once; never false for one that does."""
        found = np.zeros(len(hashes), bool)
        owner = (hashes >> self.shift).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if (part := self.parts.get(int(owner[order[a]]))) is not None:
                if not isinstance(part, Bloom):
                    part = self.parts[int(owner[order[a]])] = Bloom(*part)
                found[order[a:z]] = part.has(hashes[order[a:z]])
        return found

    def suspects(self, texts: list[set[bytes]]) -> list[list[bytes]]:
        """Of each document's keys those that may occur in other documents."""
        flat = [k for keys in texts for k in keys]
        hit = self.may_repeat(np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))).tolist()
        out, at = [], 0
        for keys in texts:
            out.append([k for k, ok in zip(flat[at : at + len(keys)], hit[at : at + len(keys)], strict=True) if ok])
            at += len(keys)
        return out


def hash_filters(source: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], filter_bytes: int) -> HashFilters:
    """Filters of the hashes that more than one of the arrays from hashes_of holds (each holds distinct ones). What
    reaches the driver is at most filter_bytes."""
    width = partitions(source.sparkSession)
    buckets = 1 << max(6, (4 * width - 1).bit_length())
    shift, share = np.uint64(64 - (buckets.bit_length() - 1)), max(64, filter_bytes * 8 // buckets)
    share = 1 << (share.bit_length() - 1)

    def emit(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, n = np.unique(np.concatenate(parts), return_counts=True)
        owner = (hashes >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        rows = [(int(owner[a]), hashes[a:z].tobytes(), hashes[a:z][n[a:z] > 1].tobytes()) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "seen", "again"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for own in hashes_of(batch):
                if len(own):
                    parts.append(own)
                    held += len(own)
                if held > FLUSH:
                    yield from emit(parts)
                    parts, held = [], 0
        if parts:
            yield from emit(parts)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(bucket: int, blobs: list[np.ndarray], again: list[np.ndarray]) -> pa.RecordBatch:
            found = twice_seen(blobs, again)
            bloom = Bloom.sized(len(found), share)
            bloom.add(found)
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([bloom.bits], pa.int64()), pa.array([bloom.data()], pa.binary())], ["bucket", "bits", "data"])

        bucket, blobs, again = None, [], []
        for batch in batches:
            for b, seen, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if b != bucket:
                    if blobs:
                        yield close(bucket, blobs, again)
                    bucket, blobs, again = b, [], []
                blobs.append(np.frombuffer(seen, np.uint64))
                again.append(np.frombuffer(more, np.uint64))
        if blobs:
            yield close(bucket, blobs, again)

    sent = source.mapInArrow(given_back(hashed), "bucket long, seen binary, again binary")
    rows = sent.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(given_back(reduced), "bucket long, bits long, data binary").collect()
    return HashFilters(buckets, [(r.bucket, r.bits, bytes(r.data)) for r in rows])


def line_filters(docs: DataFrame, text: str, least: int, filter_bytes: int) -> HashFilters:
    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for x in batch.column(0).cast(pa.binary()):
            keys = keys_of(x.as_py(), least)
            yield np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    return hash_filters(docs.select(text), hashes_of, filter_bytes)


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 20, min_docs: int = 3, filter_bytes: int = 64 << 20) -> DataFrame:
    """docs with repeated lines removed from text, plus n_lines (before) and n_dropped.

    A line whose key has at least `least` code points and is found in at least `min_docs` documents stays only in
    the document of the largest id that holds it.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    own_id, own_lost = fresh(docs, "own_id"), fresh(docs, "own_lost")
    small_batches(spark)
    filters = spark.sparkContext.broadcast(line_filters(docs, text, least, filter_bytes))
    names = docs.columns
    at_text = names.index(text)

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = filters.value.suspects([keys_of(x, least) for x in batch.column(1).cast(pa.binary()).to_pylist()])
            ids = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)), pa.array([k.decode("utf-8", "replace") for x in found for k in x], pa.string())], ["id", "key"])

    pairs = docs.select(null_first(F.col(id).cast("long")).alias("id"), text).mapInArrow(given_back(suspected), "id long, key string")
    pairs = written(pairs.groupBy("id", "key").agg(F.lit(1).alias("one")).select("id", "key"), "line-suspects")
    confirmed = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    confirmed = written(confirmed.select("key", "keeper"), "repeated-lines", pairs.count())  # so that the next join shuffles both sides and AQE can split a hot key
    losses = pairs.join(confirmed, "key").where("id <> keeper").groupBy("id").agg(F.collect_list("key").alias(own_lost)).withColumnRenamed("id", own_id)

    def split(want: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at_text).cast(pa.binary()).to_pylist()
                found = filters.value.suspects([keys_of(x, least) for x in texts])
                kept = pa.array([bool(f) == want for f in found], pa.bool_())
                lines = pa.array([(x or b"").count(b"\n") + 1 for x in texts], pa.int64())
                filled = pa.array([x or b"" for x in texts], pa.binary()).cast(pa.string())
                columns = [filled if i == at_text else batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, lines, pa.array(np.zeros(len(texts), np.int64))], [*names, "n_lines", "n_dropped"]).filter(kept)

        return run

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost_at = batch.schema.get_field_index(own_lost)
            out, n = [], []
            for x, lost in zip(batch.column(at_text).cast(pa.binary()).to_pylist(), batch.column(lost_at).to_pylist(), strict=True):
                if not lost:
                    out.append(x)
                    n.append(0)
                    continue
                gone = {k.encode() for k in lost}
                lines = x.split(b"\n")
                stay = [line for line in lines if line_key(line) not in gone]
                out.append(b"\n".join(stay))
                n.append(len(lines) - len(stay))
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            columns |= {text: pa.array(out, pa.binary()).cast(pa.string()), "n_dropped": pa.array(n, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in [*names, "n_lines", "n_dropped"]], [*names, "n_lines", "n_dropped"])

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in docs.schema] + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    clean = docs.mapInArrow(given_back(split(False)), schema)
    mixed = docs.mapInArrow(given_back(split(True)), schema).withColumn(own_id, null_first(F.col(id).cast("long"))).join(losses, own_id, "left").drop(own_id)
    return clean.unionByName(mixed.mapInArrow(given_back(removed), schema))
