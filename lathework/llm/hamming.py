"""Exact top-k search in Hamming space with incremental multi-index hashing.

Codes are cut into 16-bit segments, each with an index of its own. For a query the segment radii grow one after the
other: once the first s + 1 of m segments have been searched up to radius r and the others up to r - 1, every code
within m * r + s bits has been seen and verified, so the search ends as soon as the k-th distance is within that bound.
The segment values at a distance are looked up one by one where they are few, else picked from the values that occur.

Rows and queries meet in the cells of a grid: shards of about `shard_rows` rows, whose index is built once for a cell,
and blocks of at most `query_rows` queries, which stream through it. There are no more blocks than that needs or than
keep all partitions busy. A task holds one shard, and nothing is broadcast. A shard's equal codes are compared once.

Defined results: a query finds itself. Ties go to the smaller id; equal rows are separate results. Rows without an id or
vector are neither found nor queries. A vector shorter than the longest counts as not positive in what it lacks. With
fewer than k rows all are returned. Columns beside id and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathework.llm.common import partitions, written

SEGMENT = 16


@cache
def ring(radius: int) -> np.ndarray:
    """All 16-bit values with `radius` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), radius)], np.int64)


class MultiIndex:
    """codes: distinct, as rows of 16-bit segments; copies: how many rows have each."""

    def __init__(self, codes: np.ndarray, copies: np.ndarray, k: int):
        self.codes, self.copies, self.k = codes, np.minimum(copies, k), k
        self.orders = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[o, s], np.arange((1 << SEGMENT) + 1)) for s, o in enumerate(self.orders)]
        self.values = [np.unique(codes[:, s]) for s in range(codes.shape[1])]
        self.verified = 0

    def at_distance(self, s: int, value: int, radius: int, far: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Codes whose segment s is exactly that far from the value."""
        if len(ring(radius)) <= len(self.values[s]) // 8:
            values = ring(radius) ^ value
        else:
            if s not in far:
                d = np.bitwise_count(self.values[s] ^ np.uint16(value))
                far[s] = np.split(self.values[s][np.argsort(d, kind="stable")], np.cumsum(np.bincount(d, minlength=SEGMENT + 1))[:-1])
            values = far[s][radius].astype(np.int64)
        a, z = self.starts[s][values], self.starts[s][values + 1]
        n = z - a
        return self.orders[s][np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def nearest(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code numbers and distances, among them all codes up to the k-th row's distance."""
        m = self.codes.shape[1]
        seen, rows = np.zeros(len(self.codes), bool), np.zeros(m * SEGMENT + 1, np.int64)
        found, distance, far = [], [], {}
        for radius in range(SEGMENT + 1):
            for s in range(m):
                new = self.at_distance(s, int(query[s]), radius, far)
                new = new[~seen[new]]
                if len(new):
                    seen[new] = True
                    d = np.bitwise_count(self.codes[new] ^ query).sum(1, dtype=np.int64)
                    rows += np.bincount(d, weights=self.copies[new], minlength=len(rows)).astype(np.int64)
                    found.append(new)
                    distance.append(d)
                if rows[: m * radius + s + 1].sum() >= self.k:
                    self.verified += sum(map(len, found))
                    return np.concatenate(found), np.concatenate(distance)
        self.verified += len(self.codes)
        return np.concatenate(found), np.concatenate(distance)


class Shard:
    """Rows (ids and codes) of a shard, the equal ones together, with their index."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, k: int):
        order = np.lexsort((ids, *codes.T))
        self.ids, codes, self.k = ids[order], codes[order], k
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (codes[1:] != codes[:-1]).any(1)
        self.first = np.flatnonzero(fresh)
        self.index = MultiIndex(codes[self.first], np.diff(np.append(self.first, len(ids))), k)

    def results(self, query_ids: np.ndarray, query_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, distance) of the k nearest rows for every query."""
        copies, out = self.index.copies, []
        for q, code in zip(query_ids, query_codes, strict=True):
            at, distance = self.index.nearest(code)
            near = np.argsort(distance, kind="stable")
            last = int(np.searchsorted(np.cumsum(copies[at[near]]), self.k))
            near = near[distance[near] <= distance[near[min(last, len(near) - 1)]]]
            n = copies[at[near]]
            i = self.ids[np.repeat(self.first[at[near]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            d = np.repeat(distance[near], n)
            best = np.lexsort((i, d))[: self.k]
            out.append((np.full(len(best), q), i[best], d[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top_k(rows: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = 10, shard_rows: int = 1_000_000, query_rows: int = 65_536) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest rows by sign bits of every row that is a query."""
    spark = rows.sparkSession
    rows = rows.where(F.col(id).isNotNull() & F.col(vector).isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim"), F.count_if(is_query).alias("q")).first()
    shards = max(1, -(-size.n // shard_rows))
    groups = max(1, -(-size.q // query_rows), min(-(-size.q // 512), -(-partitions(spark) // shards)))
    width = max(1, -(-(size.dim or 1) // SEGMENT))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            bits = np.zeros((len(batch), width * SEGMENT), bool)
            sizes = np.asarray(vectors.value_lengths())
            where = np.arange(len(batch)).repeat(sizes)
            at = np.arange(len(where)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bits[where, at] = np.nan_to_num(vectors.flatten().to_numpy(zero_copy_only=False)) > 0
            data = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in data], pa.binary())], ["id", "q", "code"])

    codes = rows.select(F.col(id).cast("long").alias("id"), is_query.alias("q"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(coded, "id long, q boolean, code binary")
    codes = written(codes, "codes")
    part = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    stored = codes.select("id", "code", F.lit(False).alias("q"), part(shards, 1).alias("s"), each(groups).alias("g"))
    asked = codes.where("q").select("id", "code", F.lit(True).alias("q"), each(shards).alias("s"), part(groups, 2).alias("g"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, codes, shard = None, [], [], None
        for batch in batches:
            cells, asks = np.asarray(batch.column(3)) * groups + np.asarray(batch.column(4)), np.asarray(batch.column(2))
            key = 2 * cells + asks
            cuts = np.flatnonzero(np.diff(key, prepend=-1, append=-1)) if len(key) else []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, z - a)
                own, data = np.asarray(part.column(0)), np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, width)
                if cells[a] != now:
                    now, ids, codes, shard = cells[a], [], [], None
                if not asks[a]:
                    ids.append(own)
                    codes.append(data)
                elif ids or shard:
                    shard = shard or Shard(np.concatenate(ids), np.concatenate(codes), k)
                    ids, codes = [], []
                    for at in range(0, len(own), 1024):
                        q, i, d = shard.results(own[at : at + 1024], data[at : at + 1024])
                        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.int64())], ["query_id", "neighbor_id", "distance"])

    dealt = stored.unionByName(asked).repartition(min(shards * groups, 8 * partitions(spark)), "s", "g").sortWithinPartitions("s", "g", "q")
    found = dealt.mapInArrow(searched, "query_id long, neighbor_id long, distance long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
