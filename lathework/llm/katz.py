"""Language-model scores from a Katz back-off bigram model with Good-Turing discounts.

Documents become chunks of about `chunk` tokens, in which words are numbers. Counts live in tables partitioned by hash:
chunks send each word (or word pair) once with its count, a bucket adds the counts up and answers every chunk. So what
is shuffled are packed arrays, pre-aggregated for each chunk, and no text.

P(w | h) = d(c) c(h,w) / c(h) for a pair that was seen, else a(h) P(w); P(w) = d(c) c(w) / N for a known word, and the
rest of the mass for an unknown one. a(h) = (1 - seen mass) / (1 - P of seen words) makes each distribution sum to 1;
a distribution whose discounts leave nothing counts one more token. d(c) is Katz's form of Good-Turing for counts up
to 5, with (c - 1/2) / c where counts of counts do not allow it.

A pair goes to a bucket by its history. The pairs of a history with more than a quarter of a bucket's share of tokens
are split over several buckets in proportion; there are at most 4 histories of this kind for every bucket, and the
sums over their followers (at most 8 rows for every bucket) are added up at the driver. Discounts are known only once
all buckets have counted, so a bucket answers with sums of logarithms, numbers of pairs by count, and for pairs that
back off the counts their weight depends on.

Defined results: a null or empty text is the end token alone. Every row is scored by itself, also rows that share an
id. Rows with a null id are not for training. Words are told apart by 64-bit hashes. Columns beside id and text are not
looked at. Without training rows every token is the unknown one and has probability 1.
"""

from __future__ import annotations

import itertools
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm.common import partitions, small_batches, written

END = b"\n"
DISCOUNTED = 5
LATER = ("back_doc", "back_times", "back_which", "followers", "often", "known", "ch", "hot_doc", "hot_times", "hot_h", "hot_seen")
BITS = 20
BIG = (1 << BITS) - 1  # a word is its count, up to this, and its place among its bucket's words of that count
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(**arrays) -> bytes:
    """Arrays compressed byte by byte of all their values, which suits whole numbers of few distinct high bytes."""
    split = {k: (v.dtype, np.ascontiguousarray(v.view(np.uint8).reshape(-1, v.itemsize).T)) if isinstance(v, np.ndarray) and v.ndim == 1 and v.itemsize > 1 and v.dtype.kind in "iu" else (None, v) for k, v in arrays.items()}
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(split, protocol=5))


def unpacked(data: bytes) -> dict:
    split = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return {k: v if kind is None else np.ascontiguousarray(v.T).view(kind).ravel() for k, (kind, v) in split.items()}


def small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as they need."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def planes(x: np.ndarray) -> np.ndarray:
    """Sorted 64-bit values as differences, byte by byte of all, which compresses well."""
    return np.ascontiguousarray(np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def from_planes(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.T).view(np.uint64).ravel(), dtype=np.uint64)


def discounts(count_of_counts: np.ndarray) -> np.ndarray:
    """d(0..5, more): factors for counts, from how many items have counts 1..6. d(0) is not used."""
    n = np.concatenate([[0], count_of_counts]).astype(float)
    k, out = DISCOUNTED, np.ones(DISCOUNTED + 2)
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Unigrams:
    """The lowest level: N tokens, V distinct, and the probability of a count."""

    def __init__(self, tokens: int, distinct: int, count_of_counts: np.ndarray):
        self.tokens, self.distinct = tokens, distinct
        self.d = discounts(count_of_counts)
        r = np.arange(1, DISCOUNTED + 1)
        self.rest = float((count_of_counts[:DISCOUNTED] * r * (1 - self.d[1:-1])).sum()) if tokens else 1.0
        self.total = float(max(tokens, 1))
        if not self.rest:
            self.rest, self.total = 1.0, self.total + 1

    def probability(self, counts: np.ndarray) -> np.ndarray:
        known = self.d[np.minimum(counts, DISCOUNTED + 1)] * counts / self.total
        return np.where(counts > 0, known, self.rest / self.total)


def chunked(docs: DataFrame, train: Column, id: str, text: str, chunk: int) -> DataFrame:
    """Chunks of documents: hashes of distinct words (sorted), training counts, tokens as word numbers."""
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), train.alias("train"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
            order = np.argsort(hashes, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            words = place[np.concatenate(tokens)]
            sizes, learnt = np.array([len(t) for t in tokens], np.uint32), np.array(trains, bool)
            counts = np.bincount(words[np.repeat(learnt, sizes)], minlength=len(order))
            row = [pa.array([next(numbers)], pa.int64()), pa.array([packed(hashes=planes(hashes[order]), counts=small(counts))], pa.binary()), pa.array([packed(words=small(words), sizes=sizes, train=learnt, ids=ids)], pa.binary()), pa.array([int(learnt.sum())], pa.int64())]
            return pa.RecordBatch.from_arrays(row, ["chunk", "words", "tokens", "n_train"])

        vocabulary, tokens, ids, trains, held = defaultdict(itertools.count().__next__), [], [], [], 0
        for batch in batches:
            for key, x, t in zip(batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                words = (x.as_py() or b"").lower().split()
                words.append(END)
                tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
                ids.append(key.as_py())
                trains.append(bool(t.as_py()))
                held += len(words)
                if held >= chunk:
                    yield flush()
                    vocabulary, tokens, ids, trains, held = defaultdict(itertools.count().__next__), [], [], [], 0
        if tokens:
            yield flush()

    return source.mapInArrow(run, "chunk long, words binary, tokens binary, n_train long")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of successive equal first columns."""
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


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


ANSWER = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary())])
ANSWER_SQL = "kind int, chunk long, bucket long, data binary"


def unigram_table(chunks: DataFrame, buckets: int) -> DataFrame:
    """Kind 0: a chunk's words with their numbers and counts; kind 1: a bucket's sums; kind 2: the counts themselves."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = unpacked(data)
                hashes = from_planes(x["hashes"])
                owner = (hashes >> shift).astype(np.int64)
                cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
                yield rows_of([(int(owner[a]), chunk, packed(h=planes(hashes[a:z]), n=x["counts"][a:z])) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())]))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches):
            parts = [unpacked(r[2]) for r in rows]
            own_hashes = [from_planes(p["h"]) for p in parts]
            hashes, inverse = np.unique(np.concatenate(own_hashes), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate([p["n"] for p in parts]).astype(float)).astype(np.int64)
            level = np.minimum(counts, BIG)
            order = np.argsort(level, kind="stable")
            first = np.searchsorted(level[order], level[order], side="left")
            number = np.empty(len(counts), np.int64)
            number[order] = (np.arange(len(counts)) - first) * buckets + bucket
            out, at = [], 0
            for row, h in zip(rows, own_hashes, strict=True):
                own = inverse[at : at + len(h)]
                at += len(own)
                out.append((0, row[1], bucket, packed(number=small(number[own]), level=small(level[own]), big=counts[own][level[own] == BIG])))
            out.append((1, -1, bucket, packed(total=counts.sum(), distinct=(counts > 0).sum(), of=np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2])))
            out.append((2, -1, bucket, packed(hashes=planes(hashes), counts=small(counts))))
            yield rows_of(out, ANSWER)

    dealt = chunks.select("chunk", "words").mapInArrow(sent, "bucket long, chunk long, data binary").repartition(max(1, min(buckets, partitions(chunks.sparkSession) // 4)), "bucket")  # little work: few files
    return dealt.sortWithinPartitions("bucket", "chunk").mapInArrow(added, ANSWER_SQL)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * MIX
    return (x ^ (x >> np.uint64(29))) * MIX >> np.uint64(20)


class Pairs:
    """What a chunk asks the pair buckets, and what it knows by itself."""

    def __init__(self, tokens: dict[str, np.ndarray], number: np.ndarray, count: np.ndarray, model: Unigrams, n_train: int, buckets: int):
        words, sizes = tokens["words"].astype(np.int64), tokens["sizes"].astype(np.int64)
        starts, width, docs = np.cumsum(sizes) - sizes, len(number) + 1, len(sizes)
        doc = np.repeat(np.arange(docs), sizes)
        self.known = np.add.reduceat((count[words] > 0).astype(np.int64), starts)
        self.base = np.add.reduceat(np.log10(count[words] + 1.0), starts) - sizes * np.log10(model.tokens + model.distinct + 1.0)
        before = np.roll(words, 1)
        before[starts] = width - 1
        number, count = np.append((number + 1) << BITS | np.minimum(count, BIG), 0), np.append(count, n_train)  # 0: the start of a document
        posts, times = np.unique((before * width + words) * docs + doc, return_counts=True)
        pair, at = np.unique(posts // docs, return_index=True)
        size = np.diff(np.append(at, len(posts)))
        learnt = np.add.reduceat(times * tokens["train"][posts % docs], at)
        h, w = number[pair // width], number[pair % width]
        share = max(1.0, model.tokens / (4 * buckets))
        splits = np.maximum(1, np.ceil(count[pair // width] / share)).astype(np.int64)
        split = (mixed(w) % splits.astype(np.uint64)).astype(np.int64)
        owner = ((mixed(h) + mixed(split + 1) * (split > 0)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((w, h, owner))
        self.owner, self.fields = owner, {"h": h, "w": w, "ch": count[pair // width], "cw": count[pair % width], "n": learnt, "hot": splits > 1}
        self.at, self.size, self.doc, self.times = at, size, posts % docs, times

    def requests(self) -> Iterator[tuple[int, bytes]]:
        owner = self.owner[self.order]
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            own = self.order[a:z]
            size = self.size[own]
            posts = np.repeat(self.at[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            fields = {k: small(self.fields[k][own]) for k in ("ch", "n", "hot")}
            h, w = self.fields["h"][own], self.fields["w"][own]
            new, level, place = np.diff(h, prepend=-1) != 0, w & BIG, w >> BITS
            place = place - np.where(new, 0, np.append(0, place[:-1]))  # within a history the places grow
            step = np.diff((h >> BITS)[new], prepend=0)  # a history's level is its count, which is sent anyway
            fields |= {"w": small(place), "level": small(level), "big": self.fields["cw"][own][level == BIG]}
            yield int(owner[a]), packed(h=small(step), new=np.packbits(new), size=small(size), doc=small(self.doc[posts]), times=small(self.times[posts]), **fields)


class PairBucket:
    """Adds up the pairs of a bucket and answers the chunks."""

    def __init__(self, parts: list[dict[str, np.ndarray]], model: Unigrams):
        self.parts, self.model = parts, model
        self.ch, learnt, hot = (np.concatenate([p[k] for p in parts]) for k in ("ch", "n", "hot"))
        h, w = map(np.concatenate, zip(*map(self.keys, parts), strict=True))
        self.cw = (w & BIG).astype(np.uint32) if not sum(len(p["big"]) for p in parts) else w & BIG
        self.cw[self.cw == BIG] = np.concatenate([p["big"] for p in parts])
        order = np.lexsort((w, h)).astype(np.uint32 if len(h) < 1 << 32 else np.int64)
        h = h[order]
        new_h = np.append(True, h[1:] != h[:-1])
        self.number = h[new_h]
        del h
        w = w[order]
        first = np.flatnonzero(new_h | np.append(True, w[1:] != w[:-1]))
        del w
        total = np.add.reduceat(learnt[order].astype(np.int64), first)
        self.of = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
        self.count = np.empty(len(order), small(total).dtype)
        self.count[order] = np.repeat(small(total), np.diff(np.append(first, len(order))))
        group = (np.cumsum(new_h) - 1).astype(np.uint32 if len(order) < 1 << 32 else np.int64)
        self.group = np.empty_like(group)
        self.group[order] = group
        own, n = group[first], int(group[-1]) + 1
        p = np.where(total > 0, model.probability(self.cw[order[first]].astype(np.int64)), 0.0)
        self.followers = np.stack([np.bincount(own[total == r], minlength=n) for r in range(1, DISCOUNTED + 1)], 1).astype(np.uint32)
        self.often = np.bincount(own, weights=np.where(total > DISCOUNTED, total, 0), minlength=n).astype(np.int64)
        self.known = np.bincount(own, weights=p, minlength=n)
        heads = order[np.flatnonzero(new_h)]
        self.seen, self.hot = self.ch[heads].astype(np.int64), hot[heads].astype(bool)

    @staticmethod
    def keys(part: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Histories and words of a part's pairs."""
        place = np.cumsum(part["w"].astype(np.int64))
        first = np.flatnonzero(np.unpackbits(part["new"], count=len(place)))
        size = np.diff(np.append(first, len(place)))
        start = np.where(part["ch"][first] == 0, 0, np.minimum(part["ch"][first].astype(np.int64), BIG))
        history = np.cumsum(part["h"].astype(np.int64)) << BITS | start
        begin = history >> BITS == 0
        history[begin] = 0
        return np.repeat(history, size), (place - np.repeat(np.append(0, place)[first], size)) << BITS | part["level"].astype(np.int64)

    def hot_sums(self) -> dict[str, np.ndarray]:
        m = self.hot
        return {"h": self.number[m], "followers": self.followers[m].astype(np.int64), "often": self.often[m], "known": self.known[m], "seen": self.seen[m]}

    def answers(self) -> Iterator[bytes]:
        at = 0
        for part in self.parts:
            own = slice(at, at + len(part["w"]))
            at += len(part["w"])
            c, ch, g = self.count[own].astype(np.int64), self.ch[own].astype(np.int64), self.group[own]
            hot, none = self.hot[g], self.followers[g].sum(1) == 0
            seen = c > 0
            value = np.where(seen, np.log10(np.maximum(c, 1)) - np.log10(np.maximum(ch, 1)), np.log10(self.model.probability(self.cw[own].astype(np.int64))))
            value += np.where(seen & ~hot & none, np.log10(np.maximum(ch, 1) / (ch + 1.0)), 0.0)
            entry = np.repeat(np.arange(len(c)), part["size"].astype(np.int64))
            docs, doc = np.unique(part["doc"].astype(np.int64), return_inverse=True)
            times = part["times"].astype(float)
            add = lambda m, v=1.0: np.bincount(doc[m], weights=(v * times)[m], minlength=len(docs))
            sums = np.bincount(doc, weights=value[entry] * times, minlength=len(docs))
            classes = np.stack([add(c[entry] == r) for r in range(1, DISCOUNTED + 1)], 1)
            back = (~seen & (ch > 0) & ~hot)[entry]
            histories, which = np.unique(g[entry[back]], return_inverse=True)
            open_hot = (hot & ((~seen & (ch > 0)) | (seen & none)))[entry]
            yield packed(docs=small(docs), sums=sums, classes=small(classes.ravel()), back_doc=small(docs[doc[back]]), back_times=small(times[back]), back_which=small(which), followers=small(self.followers[histories].ravel()), often=small(self.often[histories]), known=self.known[histories], ch=small(self.seen[histories]), hot_doc=small(docs[doc[open_hot]]), hot_times=small(times[open_hot]), hot_h=small(self.number[g[entry[open_hot]]]), hot_seen=seen[entry[open_hot]])


class BackOff:
    """Pair discounts and the weights that histories give to lower levels."""

    def __init__(self, d: np.ndarray, hot: dict[str, np.ndarray]):
        self.d = d
        self.hot = {int(h): i for i, h in enumerate(hot["h"])}
        self.hot_weight, self.hot_scale = self.weights(hot["followers"], hot["often"], hot["known"], hot["seen"])

    def weights(self, followers: np.ndarray, often: np.ndarray, known: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the back-off weights, and log10 of the factor of what was seen."""
        r = np.arange(1, DISCOUNTED + 1)
        none = followers.sum(1) == 0
        total = np.maximum(seen, 1) + none
        mass = (followers * r * self.d[1:-1]).sum(1) + often
        return np.log10(np.maximum(1 - mass / total, 1e-300) / np.maximum(1 - known, 1e-300)), np.log10(np.maximum(seen, 1) / total)


def collected_hot(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    h = np.concatenate([p["h"] for p in parts] or [np.zeros(0, np.int64)])
    every, inverse = np.unique(h, return_inverse=True)
    followers, often, known, seen = np.zeros((len(every), DISCOUNTED), np.int64), np.zeros(len(every), np.int64), np.zeros(len(every)), np.zeros(len(every), np.int64)
    if len(h):
        np.add.at(followers, inverse, np.concatenate([p["followers"] for p in parts]))
        np.add.at(often, inverse, np.concatenate([p["often"] for p in parts]))
        np.add.at(known, inverse, np.concatenate([p["known"] for p in parts]))
        seen[inverse] = np.concatenate([p["seen"] for p in parts])
    return {"h": every, "followers": followers, "often": often, "known": known, "seen": seen}


def score_katz(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text", chunk: int = 1 << 20) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of docs."""
    spark = docs.sparkSession
    width = partitions(spark)
    small_batches(spark)
    buckets = 1 << max(4, (width - 1).bit_length())
    chunks = written(chunked(docs, F.coalesce(train & F.col(id).isNotNull(), F.lit(False)), id, text, chunk), "katz-chunks")
    words = written(unigram_table(chunks, buckets), "katz-unigrams")
    sums = [unpacked(bytes(r.data)) for r in words.where("kind = 1").select("data").collect()]
    of = sum((s["of"] for s in sums), np.zeros(DISCOUNTED + 1, np.int64))
    model = Unigrams(int(sum(s["total"] for s in sums)), int(sum(s["distinct"] for s in sums)), of)
    n_train = chunks.agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n")).first().n
    model_sent = spark.sparkContext.broadcast(model)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk_number, rows in grouped(batches):
            tokens = unpacked(rows[0][2])
            got = [unpacked(r[2]) for r in rows[1:]]
            number, count = (np.concatenate([g[k].astype(np.int64) for g in got]) for k in ("number", "level"))
            count[count == BIG] = np.concatenate([g["big"] for g in got])
            pairs = Pairs(tokens, number, count, model_sent.value, n_train, buckets)
            yield rows_of([(3, chunk_number, chunk_number % buckets, packed(ids=tokens["ids"], sizes=tokens["sizes"], train=tokens["train"], n_known=pairs.known, base=pairs.base))], ANSWER)
            for bucket, data in pairs.requests():
                yield rows_of([(4, chunk_number, bucket, data)], ANSWER)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches):
            yield from (rows_of([(3, r[2], bucket, r[3])], ANSWER) for r in rows if r[1] == 3)
            asks = [r for r in rows if r[1] == 4]
            if asks:
                table = PairBucket([unpacked(r[3]) for r in asks], model_sent.value)
                yield rows_of([(5, -1, bucket, packed(of=table.of, **table.hot_sums()))], ANSWER)
                for r, data in zip(asks, table.answers(), strict=True):
                    yield rows_of([(4, r[2], bucket, data)], ANSWER)

    known = words.where("kind = 0").select("chunk", "bucket", "data")
    both = chunks.select("chunk", F.lit(-1).cast("long").alias("bucket"), F.col("tokens").alias("data")).unionByName(known)
    requests = both.repartition(width, "chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(asked, ANSWER_SQL)
    dealt = requests.select("bucket", "kind", "chunk", "data").repartition(min(buckets, 2 * width), "bucket").sortWithinPartitions("bucket", "kind", "chunk")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What all buckets say about a chunk, in one row."""
        for chunk_number, rows in grouped(batches):
            if chunk_number < 0:
                yield from (rows_of([(5, -1, r[2], r[3])], ANSWER) for r in rows)
                continue
            meta = unpacked(rows[0][3])
            sums, classes = np.zeros(len(meta["sizes"])), np.zeros((len(meta["sizes"]), DISCOUNTED), np.int64)
            later: dict[str, list[np.ndarray]] = defaultdict(list)
            histories = 0
            for r in rows[1:]:
                x = unpacked(r[3])
                sums[x["docs"]] += x["sums"]
                classes[x["docs"]] += x["classes"].reshape(-1, DISCOUNTED)
                x["back_which"] = x["back_which"].astype(np.int64) + histories
                histories += len(x["ch"])
                for name in LATER:
                    later[name].append(x[name])
            yield rows_of([(3, chunk_number, -1, packed(**meta, sums=sums, classes=small(classes.ravel()), **{n: np.concatenate(v) for n, v in later.items()}))], ANSWER)

    answers = dealt.mapInArrow(answered, ANSWER_SQL).select("chunk", "kind", "bucket", "data").repartition(width, "chunk").sortWithinPartitions("chunk", "kind")
    answers = written(answers.mapInArrow(summed, ANSWER_SQL), "katz-sums")
    sums = [unpacked(bytes(r.data)) for r in answers.where("kind = 5").select("data").collect()]
    back_off = spark.sparkContext.broadcast(BackOff(discounts(sum((s["of"] for s in sums), np.zeros(DISCOUNTED + 1, np.int64))), collected_hot(sums)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = back_off.value
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = unpacked(data)
                score = x["sums"] + x["classes"].reshape(-1, DISCOUNTED) @ np.log10(b.d[1:-1])
                if len(x["back_doc"]):
                    weight, _ = b.weights(x["followers"].reshape(-1, DISCOUNTED).astype(np.int64), x["often"].astype(np.int64), x["known"], x["ch"].astype(np.int64))
                    np.add.at(score, x["back_doc"], weight[x["back_which"]] * x["back_times"])
                if len(x["hot_doc"]):
                    at = np.array([b.hot[int(h)] for h in x["hot_h"]])
                    np.add.at(score, x["hot_doc"], np.where(x["hot_seen"], b.hot_scale[at], b.hot_weight[at]) * x["hot_times"])
                columns = [pa.array(x["ids"], key_type), pa.array(x["train"]), pa.array(x["sizes"].astype(np.int64)), pa.array(x["n_known"]), pa.array(np.full(len(score), model_sent.value.tokens)), pa.array(x["base"]), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names)

    key = docs.schema[id].dataType
    key_type = pa.int64() if isinstance(key, T.LongType) else pa.int32() if isinstance(key, T.IntegerType) else pa.string()
    names = [id, "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [key, T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    return answers.where("kind = 3").select("data").mapInArrow(scored, T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)]))
