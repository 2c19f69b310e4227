"""SimHash fingerprints and their links, found with vantage-point trees.

Fingerprints within `radius` bits differ by at most one bit in one of (radius + 1) / 2 parts, so there is a tree for
every part; each is responsible for the pairs that are that close in its part. A node holds a vantage point, a mask
(the part, or all bits) and a distance mu. Fingerprints at most mu away go inside, those beyond mu outside; by the
triangle bound, a partner of an inside fingerprint lies at most mu + r away (r: the radius under that mask), so
fingerprints up to mu + r also go inside as queries. No pair is missed. The tops of the trees are built from a bounded
sample of distinct fingerprints and broadcast; every leaf is a shard, in which the trees grow on until few
fingerprints are left to compare. Shards return links to a representative of each group, never all pairs.

Defined results: null, empty and wordless texts have fingerprint zero and are linked like others. Equal fingerprints
are compared once and joined back; rows that share an id have their own fingerprints. Rows without an id get the
component of their fingerprint. Columns beside id and text are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm.common import fresh, given_back, null_first, partitions, small_batches, written
from lathework.llm.components import components
from lathework.llm.line_dedup import hash_filters

FULL = np.uint64(2**64 - 1)
FEW = 192
BUCKETS = 2**20
FLUSH_KEYS = 1 << 17


def masks(radius: int) -> list[np.uint64]:
    """Parts of a fingerprint: two within the radius differ by at most one bit in at least one part."""
    parts = (radius + 2) // 2
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [np.uint64((1 << z) - (1 << a)) for a, z in zip(cuts, cuts[1:], strict=False)]


def shingles(text: bytes | None, words: int) -> list[bytes]:
    """Space-joined runs of words, repeats included; of a shorter text all words together."""
    w = (text or b"").lower().split()
    if not w:
        return []
    return [b" ".join(w)] if len(w) <= words else [b" ".join(x) for x in zip(*(w[i:] for i in range(words)), strict=False)]


def simhash(features: list[bytes], seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the features' XXH64."""
    if not features:
        return 0
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(x, seed) for x in features), np.uint64, len(features))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id: str, text: str, words: int, seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """(id, fp0, fp1, ...): a signed 64-bit fingerprint for each seed."""
    names = [f"fp{i}" for i in range(len(seeds))]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = (shingles(x.as_py(), words) for x in batch.column(1).cast(pa.binary()))
            found = np.array([[simhash(f, s) for s in seeds] for f in features], np.uint64).reshape(-1, len(seeds)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(len(seeds)))], ["id", *names])

    source = docs.select(F.col(id).alias("id"), text)
    return source.mapInArrow(given_back(run), T.StructType([source.schema["id"], *(T.StructField(n, T.LongType()) for n in names)]))


class Node:
    def __init__(self, mask: np.uint64, vantage: np.uint64, mu: int, reach: int):
        self.mask, self.vantage, self.mu, self.reach = mask, vantage, mu, reach
        self.inside: Node | int = 0
        self.outside: Node | int = 0

    def sides(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.bitwise_count((fps ^ self.vantage) & self.mask)
        return d <= self.mu + self.reach, d > self.mu


def best_node(fps: np.ndarray, part: np.uint64, radius: int, rng: np.random.Generator, tries: int = 6) -> Node | None:
    """The split that leaves the fewest comparisons, or None if none leaves clearly fewer."""
    probe = fps if len(fps) <= 2048 else fps[rng.choice(len(fps), 2048, replace=False)]
    best, least = None, 0.85
    for vantage in probe[rng.choice(len(probe), min(tries, len(probe)), replace=False)]:
        for mask, reach in ((part, 1), (FULL, radius)):
            d = np.bitwise_count((probe ^ vantage) & mask)
            upto = np.cumsum(np.bincount(d, minlength=65 + reach)) / len(probe)
            for mu in range(64):
                inside, outside = upto[mu + reach], 1 - upto[mu]
                if outside and inside < 1 and (cost := inside**2 + outside**2) < least:
                    best, least = Node(mask, vantage, mu, reach), cost
    return best


def top_tree(sample: np.ndarray, part: np.uint64, radius: int, total: int, leaf: int) -> tuple[Node | int, int]:
    """A tree whose leaves hold about `leaf` of `total` fingerprints, and the number of its leaves."""
    rng, leaves = np.random.default_rng(7), 0

    def grow(own: np.ndarray, depth: int) -> Node | int:
        nonlocal leaves
        node = best_node(own, part, radius, rng) if len(own) * total > leaf * len(sample) and len(own) >= 16 and depth < 40 else None
        if node is None:
            leaves += 1
            return leaves - 1
        inside, outside = node.sides(own)
        node.inside, node.outside = grow(own[inside], depth + 1), grow(own[outside], depth + 1)
        return node

    return grow(sample, 0), leaves


def route(tree: Node | int, fps: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves and the fingerprints (their places in fps) that belong there."""
    if not len(at):
        return
    if isinstance(tree, int):
        yield tree, at
        return
    inside, outside = tree.sides(fps[at])
    yield from route(tree.inside, fps, at[inside])
    yield from route(tree.outside, fps, at[outside])


def links(fps: np.ndarray, part: np.uint64, radius: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from fingerprints to representatives that connect all pairs within the radius that this tree is for."""
    if len(fps) < 2:
        return
    if len(fps) <= FEW:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        if near.sum() == len(fps):
            return
        label = np.arange(len(fps))
        while True:
            new = np.where(near, label[None, :], len(fps)).min(1)
            if (new == label).all():
                break
            label = new
        moved = label != np.arange(len(fps))
        yield fps[moved], fps[label[moved]]
        return
    node = best_node(fps, part, radius, rng)
    if node is not None:
        inside, outside = node.sides(fps)
        if max(inside.sum(), outside.sum()) < 0.97 * len(fps):
            yield from links(fps[inside], part, radius, rng)
            yield from links(fps[outside], part, radius, rng)
            return
    rest, queue = fps, []  # a tight group: walk it, each fingerprint once
    while len(rest) or queue:
        if queue:
            at, root = queue.pop()
        else:
            at = root = rest[0]
            rest = rest[1:]
        near = np.bitwise_count(rest ^ at) <= radius
        if near.any():
            found = rest[near]
            rest = rest[~near]
            yield found, np.full(len(found), root)
            queue += [(x, root) for x in found]


Search = Callable[[np.ndarray, np.uint64, int, np.random.Generator], Iterator[tuple[np.ndarray, np.ndarray]]]


def distinct_links(rows: np.ndarray, part: np.uint64, radius: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for u, v in links(np.unique(rows[:, 0]), part, radius, rng):
        yield u, v


def search_shards(rows: DataFrame, columns: list[str], radius: int, search: Search, leaf: int = 4096, sample: int = 8192) -> DataFrame:
    """(u, v): what `search` finds in the shards of the trees over the first of the (long) columns."""
    spark = rows.sparkSession
    rows = rows.select(*columns)
    total = rows.count()
    taken = np.array([r[0] for r in rows.select(columns[0]).orderBy(F.xxhash64(columns[0]), columns[0]).limit(sample).collect()], np.int64).view(np.uint64)
    parts = masks(radius)
    grown = [top_tree(taken, part, radius, total, leaf) if total else (0, 1) for part in parts]
    trees = spark.sparkContext.broadcast([t for t, _ in grown])
    first = np.cumsum([0, *(n for _, n in grown)]).tolist()

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.stack([np.asarray(c).astype(np.int64).view(np.uint64) for c in batch.columns], 1)
            for t, tree in enumerate(trees.value):
                for shard, at in route(tree, own[:, 0], np.arange(len(own))):
                    yield pa.RecordBatch.from_arrays([pa.array([first[t] + shard], pa.int64()), pa.array([t], pa.int64()), pa.array([own[at].tobytes()], pa.binary())], ["shard", "tree", "data"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(tree: int, blobs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(blobs)
            rows = rows[np.lexsort(rows.T)]  # the same links whatever order the shuffle brings them in
            found = list(search(rows, parts[tree], radius, np.random.default_rng(7)))
            if found:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        shard, tree, blobs = None, 0, []
        for batch in batches:
            for s, t, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if s != shard:
                    if blobs:
                        yield from close(tree, blobs)
                    shard, tree, blobs = s, t, []
                blobs.append(np.frombuffer(data, np.uint64).reshape(-1, len(columns)))
        if blobs:
            yield from close(tree, blobs)

    dealt = rows.mapInArrow(given_back(sent), "shard long, tree long, data binary").repartition(partitions(spark), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(given_back(searched), "u long, v long")


def close_pairs(distinct: DataFrame, column: str, radius: int = 3) -> DataFrame:
    """(u, v): links between distinct fingerprints within the radius, enough to connect every group."""
    return search_shards(distinct, [column], radius, distinct_links)


def component_of_fingerprint(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) for every distinct fp of prints (id, fp)."""
    rows = prints.count()
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes", rows)
    labels = components(close_pairs(classes, "fp", radius)).withColumnRenamed("node", "fp")
    linked = written(labels.join(classes, "fp"), "linked-classes", rows)
    least = written(linked.groupBy("label").agg(F.min("least").alias("component_id")), "components", rows)
    joined = linked.join(least, "label").select("fp", "component_id")
    return written(classes.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "fingerprint-components", rows)


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(id, fp, component_id): a row for each row of docs; component_id is the smallest id that links reach."""
    prints = written(fingerprints(docs, id, text, words).withColumnRenamed("fp0", "fp"), "fingerprints")
    return prints.join(component_of_fingerprint(prints, radius), "fp").select(F.col("id").alias(id), "fp", "component_id")


# Near duplicates by similarity of texts


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def majority(h: np.ndarray, weight: np.ndarray | None = None) -> int:
    """64 bits, each 1 if it is set in over half (of the weight) of the hashes."""
    if not len(h):
        return 0
    ones, total = np.zeros(64), len(h) if weight is None else weight.sum()
    for i in range(0, len(h), 65536):
        bits = np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64) if weight is None else weight[i : i + 65536] @ bits
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def words_of(text: bytes | None) -> tuple[list[bytes], bytes]:
    """The words and the key that texts of the same words share."""
    w = (text or b"").lower().split()
    return w, xxhash.xxh3_128_digest(b" ".join(w))


def gram_hashes(w: list[bytes], words: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted: of a shorter text, of all words together."""
    digest = {x: xxhash.xxh64_intdigest(x) for x in set(w)}
    of_word = np.fromiter(map(digest.__getitem__, w), np.uint64, len(w))
    k = min(len(w), words)
    h = np.zeros(len(w) - k + 1 if k else 0, np.uint64)
    for i in range(k):
        h = mixed(h + of_word[i : i + len(h)])
    return np.unique(h)


def sketch(text: bytes | None, words: int) -> tuple[int, int, int, bytes]:
    """Fingerprint of the words (weights: roots of counts), two halves of one of the shingles, key of the words."""
    w, key = words_of(text)
    counts = Counter(w)
    h = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
    by_words = majority(h, np.sqrt(np.fromiter(counts.values(), float, len(counts))))
    grams = gram_hashes(w, words)
    return by_words, majority(grams), majority(mixed(grams)), key


def similar_links(rows: np.ndarray, part: np.uint64, radius: int, rng: np.random.Generator, gram_radius: int = 34, most: int = 6, whole: int = 32768) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates (nodes) among rows of (word fingerprint, two halves of the shingle fingerprint, node): all pairs
    within both radii, found through the tree. Where a set that is not split further has over `most` of them a row, or
    over `whole` rows, its rows are linked to few near ones, which joins large groups of copies with few candidates.
    `unlinked_pairs` finds what is missing then."""
    if len(rows) < 2:
        return

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shingle distances, or 999 where either distance is too large."""
        d = np.bitwise_count(a[:, None, 1] ^ b[None, :, 1]).astype(np.int16) + np.bitwise_count(a[:, None, 2] ^ b[None, :, 2])
        return np.where((d > gram_radius) | (np.bitwise_count(a[:, None, 0] ^ b[None, :, 0]) > radius), np.int16(999), d)

    def nearest(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        top = np.argsort(d, axis=1, kind="stable")[:, :3]
        i, j = np.nonzero(np.take_along_axis(d, top, 1) < 999)
        yield a[i, 3], b[top[i, j], 3]

    if len(rows) > FEW:
        node = best_node(rows[:, 0], part, radius, rng)
        if node is not None:
            inside, outside = node.sides(rows[:, 0])
            if max(inside.sum(), outside.sum()) < 0.97 * len(rows):
                for side in (inside, outside):
                    yield from similar_links(rows[side], part, radius, rng, gram_radius, most, whole)
                return
    if len(rows) <= whole:
        found, total, step = [], 0, max(16, (1 << 20) // len(rows))
        for at in range(0, len(rows), step):
            d = near(rows[at : at + step], rows[: at + step])
            i, j = np.nonzero(d < 999)
            i, j = i[j < i + at], j[j < i + at]
            found.append((i + at, j))
            total += len(i)
            if total > most * len(rows):
                break
        else:
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(i):
                yield rows[i, 3], rows[j, 3]
            return
    left = np.arange(len(rows))
    while len(left):  # pivots, and of the rows far from all of them again
        pivots, rest = left[:FEW], left[FEW:]
        d = near(rows[pivots], rows[pivots])
        d[np.triu_indices(len(pivots))] = 999
        yield from nearest(rows[pivots], rows[pivots], d)
        far = []
        for at in range(0, len(rest), 4096):
            block = rest[at : at + 4096]
            d = near(rows[block], rows[pivots])
            yield from nearest(rows[block], rows[pivots], d)
            far.append(block[~(d < 999).any(1)])
        left = np.concatenate(far) if far else rest


def needed(size: int, share: float) -> int:
    return int(np.ceil(share * size - 1e-6))


def gram_sets(source: DataFrame, wanted: DataFrame, words: int, filter_bytes: int = 64 << 20) -> DataFrame:
    """(node, grams) for wanted (node, key). A filter of the wanted keys spares a shuffle of the texts."""
    of_key = lambda keys: np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
    twice = lambda batch: (of_key(batch.column(0).to_pylist()) for _ in range(2))
    filters = source.sparkSession.sparkContext.broadcast(hash_filters(wanted.select("key").distinct(), twice, filter_bytes))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            keys = [words_of(x.as_py())[1] for x in texts]
            keep = filters.value.may_repeat(of_key(keys)).tolist()
            at = {k: i for i, (k, fine) in enumerate(zip(keys, keep, strict=True)) if fine and k not in seen}
            if len(seen) < FLUSH_KEYS:
                seen.update(at)
            grams = [gram_hashes(words_of(texts[i].as_py())[0], words).tobytes() for i in at.values()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(grams, pa.binary())], ["key", "grams"])

    return source.select("text").mapInArrow(given_back(hashed), "key binary, grams binary").join(wanted, "key").dropDuplicates(["node"]).select("node", "grams")


def shingle_counts(source: DataFrame, words: int, slices: int = 64) -> np.ndarray:
    """How many texts of source have a shingle of each bucket."""
    share = BUCKETS // slices

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for x in batch.column(0).cast(pa.binary()):
                np.add.at(seen, (gram_hashes(words_of(x.as_py())[0], words) % np.uint64(BUCKETS)).astype(np.int64), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int64()), pa.array([seen[i * share : (i + 1) * share].tobytes() for i in range(slices)], pa.binary())], ["slice", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(data, np.int64)
        found = [np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int64()), pa.array(found, pa.binary())], ["slice", "counts"])

    sent = source.select("text").mapInArrow(given_back(counted), "slice long, counts binary").repartition(min(slices, partitions(source.sparkSession)), "slice")
    out = np.zeros(BUCKETS, np.uint32)
    for r in sent.mapInArrow(given_back(added), "slice long, counts binary").collect():
        out[r.slice * share : (r.slice + 1) * share] = np.frombuffer(r.counts, np.uint32)
    return out


def unlinked_pairs(source: DataFrame, labelled: DataFrame, words: int, similarity: float, rows: int, part: int = 2048, filter_bytes: int = 64 << 20) -> DataFrame:
    """(u, v): all pairs of labelled (key, node, label) that differ in label and may have the similarity, whatever their
    fingerprints. Shingles are ordered by their counts (in buckets), rarest first. Two sets that are similar share one of
    the first shingles, and at the first of these enough shingles follow in both. Only first shingles that filters hold
    to be in several texts are joined; those of many sets in parts."""
    spark = source.sparkSession
    common = spark.sparkContext.broadcast(shingle_counts(source, words))

    def first_grams(w: list[bytes]) -> tuple[np.ndarray, int]:
        grams = gram_hashes(w, words)
        n = common.value[grams % np.uint64(BUCKETS)]
        return grams[np.lexsort((grams, n))[: len(grams) - needed(len(grams), similarity) + 1]], len(grams)

    def of_texts(batch: pa.RecordBatch, seen: set[bytes]) -> Iterator[tuple[bytes, np.ndarray, int]]:
        for x in batch.column(0).cast(pa.binary()):
            w, key = words_of(x.as_py())
            if w and key not in seen:
                if len(seen) < FLUSH_KEYS:
                    seen.add(key)
                yield key, *first_grams(w)

    texts = source.select("text")
    filters = spark.sparkContext.broadcast(hash_filters(texts, lambda batch: (mixed(grams) for _, grams, _ in of_texts(batch, set())), filter_bytes))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            found = list(of_texts(batch, seen))
            ends = np.cumsum([0, *(len(grams) for _, grams, _ in found)])
            keep = filters.value.may_repeat(mixed(np.concatenate([grams for _, grams, _ in found]))) if found else []
            out = []
            for (key, grams, size), a, z in zip(found, ends, ends[1:], strict=False):
                at = np.flatnonzero(keep[a:z])
                if len(at):
                    out.append((key, size, grams[at].tobytes(), at.astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int32(), pa.binary(), pa.binary()))], ["key", "size", "grams", "at"])

    held = texts.mapInArrow(given_back(firsts), "key binary, size int, grams binary, at binary").dropDuplicates(["key"])
    held = written(held.join(labelled, "key").select("node", "label", "size", "grams", "at"), "first-shingles")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label, size = (np.asarray(batch.column(i)) for i in range(3))
            grams, at = (batch.column(i).to_pylist() for i in (3, 4))
            of = np.repeat(np.arange(len(node)), [len(x) // 8 for x in grams])
            place = np.frombuffer(b"".join(at), np.int32)
            early = np.array([s - needed(s, 2 * similarity / (1 + similarity)) + 1 for s in size.tolist()], np.int64)
            columns = [node[of], label[of], np.frombuffer(b"".join(grams), np.int64), place, size[of], place < early[of]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["node", "label", "gram", "at", "size", "early"])

    first = held.mapInArrow(given_back(opened), "node long, label long, gram long, at int, size int, early boolean")
    shared = first.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    shared = written(shared.select("gram", F.ceil(F.col("n") / part).alias("parts")), "shared-shingles")
    first = written(first.join(shared, "gram"), "joined-shingles")
    a = first.where("early").withColumn("part", F.pmod("node", "parts")).alias("a")
    b = first.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("b")
    shorter = "a.label <> b.label AND (a.size < b.size OR a.size = b.size AND a.node < b.node)"
    enough = f"least(a.size - a.at, b.size - b.at) >= {similarity / (1 + similarity)!r} * (a.size + b.size) - 1e-6"
    found = a.join(b, F.expr(f"a.gram = b.gram AND a.part = b.part AND {shorter} AND {enough}"))
    return written(found.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct(), "unlinked-candidates", rows)


def near_duplicate_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, radius: int = 9) -> DataFrame:
    """(id, text_hash, group): group is the smallest id reached by links of at least this Jaccard similarity of
    distinct word shingles, all of them. Equal word sequences are one class. Candidates are classes whose word
    fingerprints are within the radius (found through the trees) and whose shingle fingerprints are near; then all
    classes that are not linked yet and share enough shingles. Every one is verified."""
    source = docs.select(null_first(F.col(id).cast("long")).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    small_batches(docs.sparkSession)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(x.as_py(), words) for x in batch.column(2).cast(pa.binary())]
            fps = np.array([f[:3] for f in found], np.uint64).reshape(-1, 3).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(fps[:, i]) for i in range(3)), pa.array([f[3] for f in found], pa.binary())], ["id", "text_hash", "fp", "gram0", "gram1", "key"])

    rows = written(source.mapInArrow(given_back(sketched), "id long, text_hash long, fp long, gram0 long, gram1 long, key binary"), "sketches")
    n = rows.count()
    own = F.min(F.struct("id", "fp", "gram0", "gram1")).alias("m")  # a class shares its fingerprints
    classes = rows.groupBy("key").agg(own).select("key", F.col("m.id").alias("rep"), "m.fp", "m.gram0", "m.gram1")
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes", n)  # numbers that stay, as they are written
    found = search_shards(classes, ["fp", "gram0", "gram1", "node"], radius, similar_links)
    pairs = written(found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "candidates", 4 * n)

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                fine.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
            yield batch.select(["u", "v"]).filter(pa.array(fine, pa.bool_()))

    def similar(pairs: DataFrame, rows: int) -> DataFrame:
        wanted = pairs.select(F.col("u").alias("node")).distinct().union(pairs.select("v").distinct()).distinct().join(classes.select("node", "key"), "node")
        sets = written(gram_sets(source, wanted, words), "shingle-sets", 20 * rows)
        joined = pairs.join(sets.select(F.col("node").alias("u"), F.col("grams").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("grams").alias("b")), "v")
        return written(joined.select("u", "v", "a", "b").mapInArrow(given_back(verified), "u long, v long"), "similar-pairs", 20 * rows)  # sets are long

    n_pairs = pairs.count()
    edges = similar(pairs, n_pairs)
    labels = components(edges, n_pairs)
    more = unlinked_pairs(source, classes.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), words, similarity, 4 * n)
    if n_more := more.count():
        labels = components(edges.unionByName(similar(more, n_more)), n_pairs + n_more)
    linked = written(labels.join(classes.select("node", "rep"), "node"), "linked-classes", n)
    least = written(linked.groupBy("label").agg(F.min("rep").alias("group")), "groups", n)
    of_node = linked.join(least, "label").select("node", "group")
    of_class = written(classes.select("key", "rep", "node").join(of_node, "node", "left").select("key", F.coalesce("group", "rep").alias("group")), "class-groups", n)
    return rows.select("id", "text_hash", "key").join(of_class, "key").select("id", "text_hash", "group")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one document of each group: that of the smallest id; of rows that share it the one of the smallest
    text hash, and of rows that share this too any one."""
    n = docs.count()
    rows = near_duplicate_groups(docs, id, text, **options).groupBy("id", "text_hash", "group").agg(F.count(F.lit(1)).alias("copies"))
    rows = written(rows, "group-rows", n)
    kept = rows.where("id = group").groupBy("group").agg(F.min_by("text_hash", "text_hash").alias("text_hash"), F.min_by("copies", "text_hash").alias("copies"))
    kept = written(kept.select(F.col("group").alias("id"), "text_hash", "copies"), "kept-of-groups", n)
    name = fresh(docs, "own_key")
    key = F.struct(null_first(F.col(id).cast("long")).alias("id"), F.xxhash64(text).alias("text_hash"))
    again = written(kept.where("copies > 1").select(F.struct("id", "text_hash").alias(name)), "copied-rows", n)
    gone = rows.join(kept.where("copies = 1"), ["id", "text_hash"], "left_anti").select(F.struct("id", "text_hash").alias(name))
    out = docs.join(written(gone, "near-duplicates", n), key == F.col(name), "left_anti")
    if again.isEmpty():
        return out
    return out.unionByName(docs.join(again, key == F.col(name)).dropDuplicates([name]).select(*(F.col(f"`{c}`") for c in docs.columns)))
