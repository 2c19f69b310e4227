"""Document quality from a linear-chain conditional random field over lines.

Every line is a node labelled good or bad. Its potential is linear in features of the line and of its two
neighbours; a transition matrix links successive labels. Forward-backward marginals, averaged with line lengths as
weights, give a document's share of good text, which a logistic curve fitted to the labels turns into a score.

The model is fitted on at most `sample` labelled documents of either class, chosen by hash, and of each at most
`segments` evenly spaced chains of `chain` lines, which are chains of their own with their true neighbours; everything
is scored whole. Lines get their document's label first; lines of bad documents that the fitted model holds to be good
are then relabelled and the model is fitted again.

Features are computed for blocks of lines at a time, and of a line only its three products with the weights are kept.
Long chains are cut into lanes whose transfer matrices are multiplied, so a long text takes few steps.

Defined results: null and empty texts are one empty line. Rows sharing an id are scored each by its own text. Several
labels for one id count as the smallest, and of several texts for a labelled id the smallest is learnt from. With
labels of one class or none, every score is the share of label 1 (0.5 without labels). Input columns named score or
predicted are replaced; other columns are kept, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.llm.common import given_back, small_batches

FEATURES = 16
SEEN = 14
BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15


def of_bytes(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


UPPERS, DIGITS, PIPES, BREAKS = (of_bytes(x) for x in (bytes(range(65, 91)), b"0123456789", b"|", b" \t\n\r\x0b\x0c"))
LETTERS = of_bytes(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
MARKS = of_bytes(b"!#$%&*@^~<>=+_{}[]\\/")


def fields(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


COUNTED = fields(LETTERS, UPPERS), fields(MARKS, DIGITS), fields(PIPES, np.zeros(256, bool))
HALF = np.uint64(2**32 - 1)


@functools.lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64))) for x in (BASE, pow(BASE, -1, 1 << 64)))


class Places:
    """Hashes of the runs of a block of bytes, the same wherever a run stands."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(max(2 * BLOCK, 1 << len(data).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        h = (self.sums[stops] - self.sums[starts]) * self.down[starts]
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def block_features(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines data[starts:stops], but whether they were seen before, and the lines' hashes."""
    n, lines = stops - starts, len(starts)
    closed = np.append(data, np.uint8(10))
    sums = [np.add.reduceat(table[closed], starts) for table in COUNTED]
    (letters, upper), (marks, digits), (pipes, _) = (((x & HALF).astype(float), (x >> np.uint64(32)).astype(float)) for x in sums)
    gap = BREAKS[closed]
    first = np.flatnonzero(~gap[:-1] & np.append(True, gap[:-2])) if len(data) else np.zeros(0, np.int64)
    last = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    line = np.searchsorted(starts, first, side="right") - 1
    places = Places(data)
    word = places.hashes(first, last)
    k = np.maximum(np.bincount(line, minlength=lines), 1)
    adjacent = np.bincount(line[1:][(word[1:] == word[:-1]) & (line[1:] == line[:-1])], minlength=lines) / k
    keys = np.sort(line.astype(np.uint64) << np.uint64(44) | word >> np.uint64(20))
    distinct = np.bincount((keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]] >> np.uint64(44)).astype(np.int64), minlength=lines) / k
    some = np.maximum(n, 1)
    upper, marks, pipes = upper / np.maximum(1, letters), marks / some, pipes / k
    x = np.stack([n == 0, np.minimum(n, 2000) / 2000, letters / some, upper, upper > 0.5, marks, marks > 0.03, marks > 0.12, digits / some, adjacent, adjacent > 0.15, distinct, pipes, pipes > 0.3, np.zeros(lines), np.minimum(n / k, 30) / 30], 1)
    return x, places.hashes(starts, stops)


def projected(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the lines of all texts, one after the other: features @ weights, line weights; and the lines of each text."""
    sizes = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    stops = np.append(np.flatnonzero(data == 10), len(data))
    starts = np.append(0, stops[:-1] + 1)
    out, hashes, a = np.empty((len(starts), weights.shape[1])), np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        z = max(a + 1, int(np.searchsorted(stops, starts[a] + BLOCK, side="right")))
        x, hashes[a:z] = block_features(data[starts[a] : stops[z - 1]], starts[a:z] - starts[a], stops[a:z] - starts[a])
        out[a:z] = x @ weights
        a = z
    full = np.flatnonzero(stops > starts)
    owner = np.repeat(np.arange(len(texts)), sizes)[full]
    order = np.lexsort((hashes[full], owner))  # stable: equal lines stay in their order
    again = np.append(False, (hashes[full][order][1:] == hashes[full][order][:-1]) & (owner[order][1:] == owner[order][:-1])) if len(full) else np.zeros(0, bool)
    out[full[order][again]] += weights[SEEN]
    return out, stops - starts + 1.0, sizes


def edges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the first and of the last line of each chain."""
    ends = np.cumsum(sizes)
    first, last = np.zeros(int(ends[-1]), bool), np.zeros(int(ends[-1]), bool)
    first[ends - sizes], last[ends - 1] = True, True
    return first, last


def with_neighbours(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after, with a constant and flags for the ends."""
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.hstack([x, before, after, first[:, None], last[:, None], np.ones((len(x), 1))]).astype(np.float32)


class LineCrf:
    """Two labels (0 bad, 1 good); weights hold the potential of good against bad, links the transitions."""

    def __init__(self, weights: np.ndarray, links: np.ndarray):
        self.weights, self.links = weights, links

    @staticmethod
    def nodes(potential: np.ndarray) -> np.ndarray:
        node = np.ones((len(potential), 2))
        node[:, 1] = np.exp(np.clip(potential, -30, 30))
        return node / node.sum(1, keepdims=True)

    def marginals(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and summed pair marginals; x: lines of all chains, one after the other."""
        node = self.nodes(x @ self.weights)
        order = np.argsort(-sizes, kind="stable")
        starts, held = (np.cumsum(sizes) - sizes)[order], sizes[order]
        forward, backward, link = np.empty_like(node), np.ones_like(node), np.exp(self.links)
        live = [int(n) for n in np.searchsorted(-held, -np.arange(1, (held[0] if len(held) else 0) + 1), side="right")]
        for t, n in enumerate(live):
            at = starts[:n] + t
            a = node[at] if t == 0 else (forward[at - 1] @ link) * node[at]
            forward[at] = a / a.sum(1, keepdims=True)
        pairs = np.zeros((2, 2))
        for t in range(len(live) - 1, 0, -1):
            at = starts[: live[t]] + t
            b = (node[at] * backward[at]) @ link.T
            both = forward[at - 1][:, :, None] * link * (node[at] * backward[at])[:, None, :]
            pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
            backward[at - 1] = b / b.sum(1, keepdims=True)
        good = forward * backward
        return good[:, 1] / good.sum(1), pairs

    def good(self, potential: np.ndarray, sizes: np.ndarray, lane: int = 64) -> np.ndarray:
        """P(good) of every line by forward-backward over lanes of that many lines, which run side by side; the
        product of a lane's transfer matrices carries messages across it."""
        node, link = self.nodes(potential), np.exp(self.links)
        n_lanes = -(-sizes // lane)
        chain = np.repeat(np.arange(len(sizes)), n_lanes)
        number = np.arange(len(chain)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        starts = (np.cumsum(sizes) - sizes)[chain] + number * lane
        length = np.minimum(lane, sizes[chain] - number * lane)
        head = number == 0
        order = np.argsort(-length, kind="stable")
        live = [order[: int(n)] for n in np.searchsorted(-length[order], -np.arange(1, (length.max() if len(length) else 0) + 1), side="right")]
        message, after = np.ones((len(chain), 2)), np.ones((len(chain), 2))
        if (n_lanes > 1).any():
            across = np.tile(np.eye(2), (len(chain), 1, 1))
            for t, own in enumerate(live):
                step = across[own] if t == 0 else across[own] @ link
                if t == 0:
                    step[~head[own]] = link
                step = step * node[starts[own] + t][:, None, :]
                across[own] = step / step.sum((1, 2), keepdims=True)
            for i in range(1, int(n_lanes.max())):
                at = (np.cumsum(n_lanes) - n_lanes)[n_lanes > i] + i
                m = (message[at - 1][:, None, :] @ across[at - 1])[:, 0]
                message[at] = m / m.sum(1, keepdims=True)
            for i in range(int(n_lanes.max()) - 1, 0, -1):
                at = (np.cumsum(n_lanes) - n_lanes)[n_lanes > i] + i
                b = (across[at] @ after[at][:, :, None])[:, :, 0]
                after[at - 1] = b / b.sum(1, keepdims=True)
        forward, backward = np.empty_like(node), np.empty_like(node)
        for t, own in enumerate(live):
            at = starts[own] + t
            come = message[own] @ link if t == 0 else forward[at - 1] @ link
            if t == 0:
                come[head[own]] = 1
            a = come * node[at]
            forward[at] = a / a.sum(1, keepdims=True)
        backward[starts + length - 1] = after
        for t in range(len(live) - 1, 0, -1):
            at = starts[live[t]] + t
            b = (node[at] * backward[at]) @ link.T
            backward[at - 1] = b / b.sum(1, keepdims=True)
        both = forward * backward
        return both[:, 1] / both.sum(1)

    @classmethod
    def fitted(cls, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, node_weight: np.ndarray, rounds: int = 120, decay: float = 1e-3) -> LineCrf:
        """Maximum likelihood by Adam; y: 0 or 1 for each line."""
        crf = cls(np.zeros(x.shape[1]), np.zeros((2, 2)))
        inner = np.ones(len(x), bool)
        inner[np.cumsum(sizes) - sizes] = False
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
        scale, m, v = max(1.0, float(node_weight.sum())), 0.0, 0.0
        for i in range(1, rounds + 1):
            p, pairs = crf.marginals(x, sizes)
            g = np.concatenate([(node_weight * (y - p)).astype(np.float32) @ x / scale - decay * crf.weights, ((seen - pairs) / max(1, len(x)) - decay * crf.links).ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = 0.15 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
            crf.weights = crf.weights + step[:-4]
            crf.links = crf.links + step[-4:].reshape(2, 2)
        return crf


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Chain:
    """Successive lines of a labelled document: features and weights, with the neighbours of the chain's ends."""

    def __init__(self, document: int, label: int, x: np.ndarray, weights: np.ndarray, before: bool, after: bool):
        self.document, self.label, self.x, self.weights, self.before, self.after = document, label, x, weights, before, after

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Features with neighbours, and weights, of the chain's own lines."""
        first, last = np.zeros(len(self.x), bool), np.zeros(len(self.x), bool)
        first[0], last[-1] = not self.before, not self.after
        own = slice(int(self.before), len(self.x) - int(self.after))
        return with_neighbours(self.x, first, last)[own], self.weights[own]


def chains_of(text: bytes, chain: int, segments: int) -> list[tuple[np.ndarray, np.ndarray, bool, bool]]:
    """(features, weights, whether the first line and the last are neighbours only) of a text's chains for training."""
    x, w, _ = projected([text], np.eye(FEATURES))
    if len(w) <= chain * segments:
        return [(x, w, False, False)]
    out = []
    for s in np.linspace(0, len(w) - chain, segments).astype(int).tolist():
        a, z = max(0, s - 1), min(len(w), s + chain + 1)
        out.append((x[a:z], w[a:z], a < s, z > s + chain))
    return out


class QualityModel:
    def __init__(self, crf: LineCrf | None, curve: np.ndarray, share: float):
        self.crf, self.curve, self.share = crf, curve, share

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.crf is None or not texts:
            return np.full(len(texts), self.share)
        w = self.crf.weights
        three, w_lines, sizes = projected([t or b"" for t in texts], w[: 3 * FEATURES].reshape(3, FEATURES).T)
        first, last = edges(sizes)
        potential = three[:, 0] + w[-1] + w[-3] * first + w[-2] * last
        potential[1:] += np.where(first[1:], 0, three[:-1, 1])
        potential[:-1] += np.where(last[:-1], 0, three[1:, 2])
        p = self.crf.good(potential, sizes)
        starts = np.cumsum(sizes) - sizes
        shares = np.add.reduceat(p * w_lines, starts) / np.add.reduceat(w_lines, starts)
        return 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * logit(shares))))

    @classmethod
    def fitted(cls, chains: list[Chain], counts: tuple[int, int]) -> QualityModel:
        """counts: labelled documents of either class."""
        share = counts[1] / sum(counts) if sum(counts) else 0.5
        if len({c.label for c in chains}) < 2:
            return cls(None, np.zeros(2), share)
        xs, ws = zip(*(c.nodes() for c in chains), strict=True)
        x, sizes = np.concatenate(xs), np.array([len(w) for w in ws])
        plain = np.concatenate(ws)
        weight = plain / plain.mean()
        _, document = np.unique(np.repeat([c.document for c in chains], sizes), return_inverse=True)
        owner = np.repeat([c.label for c in chains], sizes)
        crf = LineCrf.fitted(x, sizes, owner, weight)
        p, _ = crf.marginals(x, sizes)
        # a line of a bad document that looks good is good, as long as the document keeps a bad line
        worst = np.ones(document.max() + 1)
        np.minimum.at(worst, document, p)
        relabelled = np.where((owner == 0) & (p > 0.6) & (worst[document] < 0.4), 1, owner)
        model = cls(LineCrf.fitted(x, sizes, relabelled, weight), np.array([0.0, 1.0]), share)
        p, _ = model.crf.marginals(x, sizes)
        shares = np.bincount(document, weights=p * plain) / np.bincount(document, weights=plain)
        labels = np.zeros(len(shares), np.int64)
        labels[document] = owner
        of = np.array([counts[q] / max(1, int((labels == q).sum())) for q in labels])
        model.curve = logistic(logit(shares), labels, of / of.mean())
        return model


def logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weighted logistic regression of y on z by Newton's method; intercept and slope."""
    x, b = np.stack([np.ones_like(z), z], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * b), -2, 2)
    return b


def fit_quality(docs: DataFrame, labels: DataFrame, id: str, text: str, sample: int, chain: int, segments: int) -> QualityModel:
    """labels: one row for each id with quality 0 or 1."""
    counted = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    counts = (counted.get(0, 0), counted.get(1, 0))
    chosen = [r for q in (0, 1) for r in labels.where(F.col("quality") == q).orderBy(F.xxhash64("key"), "key").limit(sample).collect()]
    if not chosen:
        return QualityModel(None, np.zeros(2), 0.5)
    wanted = docs.sparkSession.createDataFrame([(r.key, int(r.quality)) for r in chosen], "key string, quality int")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                for i, (x, w, before, after) in enumerate(chains_of(t or b"", chain, segments)):
                    rows.append({"key": key, "chain": i, "q": q, "x": x.astype(np.float32).tobytes(), "w": w.tobytes(), "before": before, "after": after})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), ("chain", pa.int32()), ("q", pa.int32()), ("x", pa.binary()), ("w", pa.binary()), ("before", pa.bool_()), ("after", pa.bool_())]))

    keyed = docs.select(F.col(id).cast("string").alias("key"), F.col(text).alias("text"))
    keyed = keyed.join(F.broadcast(wanted), "key").groupBy("key", "quality").agg(F.min("text").alias("text"))
    rows = keyed.mapInArrow(given_back(features), "key string, chain int, q int, x binary, w binary, before boolean, after boolean").collect()
    rows.sort(key=lambda r: (r.key, r.chain))
    number = {k: i for i, k in enumerate(sorted({r.key for r in rows}))}
    return QualityModel.fitted([Chain(number[r.key], r.q, np.frombuffer(r.x, np.float32).reshape(-1, FEATURES), np.frombuffer(r.w, np.float64), r.before, r.after) for r in rows], counts)


def training_rows(column: str, folds: int, held: int):
    """Whether a row is for training: crc32 of the id as text, modulo folds, is not the held-out fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds != held, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3, folds: int = 5, held: int = 0, sample: int = 2000, chain: int = 64, segments: int = 4) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= threshold)."""
    docs = docs.drop("score", "predicted")
    small_batches(docs.sparkSession)
    usable = labels.where(training_rows(id, folds, held) & F.col(label).isin(0, 1))
    usable = usable.groupBy(F.col(id).cast("string").alias("key")).agg(F.min(label).cast("int").alias("quality"))
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, usable, id, text, sample, chain, segments))
    at = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            p = np.concatenate([model.value.scores(texts[i : i + 256]) for i in range(0, len(texts), 256)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(given_back(scored), T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
