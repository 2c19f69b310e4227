"""URL filter: host and path rules first, then a ratio of two character language models.

The models are smoothed variable-order Markov chains (Witten-Bell interpolation over contexts of up to `order`
characters) of the distinct URLs that the rules accept and of those that they reject. Four fifths of either kind, by
hash, are counted, all of them; the rest calibrates the threshold, again all of it. Where one of these parts of a kind
is empty, all its URLs stand for it. A URL without a rule is allowed if its log-likelihood difference divided by its
length reaches the threshold, which has the least sum of both error rates over all cuts between neighbouring scores.
Counts, probabilities and the threshold are DataFrame operations; what is broadcast is a number for each distinct gram
and context (by XXH64), 16 bytes each.

Defined results: a null URL or one without :// has an empty host and path. Of fitting rules the longest decides. Where
the rules accept or reject no URL at all, there is no ratio and URLs without a rule are allowed. Input columns named
host, path, rule, verdict or score are replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.llm.common import ascii_lower, partitions, written

START = "\x02"
ALPHABET = 257
Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def deciding_rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


class CharModel:
    """Variable-order Markov model of characters with Witten-Bell smoothing."""

    def __init__(self, texts: Sequence[str], order: int):
        self.order = order
        counts: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for text in texts:
            padded = START * order + text + START
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    counts[padded[i - k : i]][padded[i]] += 1
        self.counts = {c: dict(x) for c, x in counts.items()}
        self.totals = {c: sum(x.values()) for c, x in self.counts.items()}
        self.known: dict[str, float] = {}

    def probability(self, context: str, char: str) -> float:
        p = 1 / ALPHABET
        for k in range(self.order + 1):
            seen = self.counts.get(context[len(context) - k :])
            if seen is None:
                break
            total = self.totals[context[len(context) - k :]]
            p = (seen.get(char, 0) + len(seen) * p) / (total + len(seen))
        return p

    def log_likelihood(self, text: str) -> float:
        padded, total = START * self.order + text + START, 0.0
        for i in range(self.order, len(padded)):
            gram = padded[i - self.order : i + 1]
            if (x := self.known.get(gram)) is None:
                x = math.log(self.probability(gram[:-1], gram[-1]))
                if len(self.known) < 200_000:
                    self.known[gram] = x
            total += x
        return total


class RatioModel:
    """The models and the threshold by lists in memory; every fifth URL calibrates."""

    def __init__(self, accepted: Sequence[str], rejected: Sequence[str], order: int):
        part = lambda x, held: [t for i, t in enumerate(x) if (i % 5 == 0) == held]
        self.accepted, self.rejected = (CharModel(part(x, False) or x, order) for x in (accepted, rejected))
        yes, no = (sorted(self.ratio(t) for t in part(x, True)) for x in (accepted, rejected))
        cuts = sorted({*yes, *no})
        middles = [(a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False)] or [0.0]

        def error(cut: float) -> float:
            return bisect_left(yes, cut) / max(1, len(yes)) + (len(no) - bisect_left(no, cut)) / max(1, len(no))

        self.threshold = min(middles, key=lambda c: (error(c), abs(c)))

    def ratio(self, text: str) -> float:
        """Length-normalised log-likelihood difference; higher: likelier accepted."""
        return (self.accepted.log_likelihood(text) - self.rejected.log_likelihood(text)) / (len(text) + 1)


def gram_counts(texts: DataFrame, order: int, most: int = 1 << 18) -> DataFrame:
    """(gram, a, b): how often each run of order + 1 characters is in the accepted and in the rejected of (t, accepted)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen: dict[bool, Counter[str]]) -> Iterator[pa.RecordBatch]:
            for kind, c in seen.items():
                n, zero = pa.array(c.values(), pa.int64()), pa.array(np.zeros(len(c), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), *((n, zero) if kind else (zero, n))], ["gram", "a", "b"])

        seen: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                padded = START * order + text + START
                seen[kind].update(padded[i : i + order + 1] for i in range(len(text) + 1))
                if sum(map(len, seen.values())) > most:
                    yield from out(seen)
                    seen = {True: Counter(), False: Counter()}
        yield from out(seen)

    return texts.select("t", "accepted").mapInArrow(counted, "gram string, a long, b long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def gram_ratios(texts: DataFrame, order: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """For each length of contexts (gram, value) and (context, value): the log of the quotient of both models'
    probabilities, and what an unseen character after the context adds to that of the next shorter gram."""
    counts = written(gram_counts(texts, order), "url-grams")
    n = counts.count()
    shorter = counts.sparkSession.createDataFrame([("", 1 / ALPHABET, 1 / ALPHABET)], "low string, la double, lb double")
    for k in range(order + 1):
        grams = counts.groupBy(F.substring("gram", order - k + 1, k + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        grams = grams.withColumns({"context": F.substring("gram", 1, k), "low": F.substring("gram", 2, k) if k else F.lit("")})
        contexts = grams.groupBy("context").agg(F.sum("a").alias("ta"), F.count_if(F.col("a") > 0).alias("ka"), F.sum("b").alias("tb"), F.count_if(F.col("b") > 0).alias("kb"))
        joined = grams.join(contexts, "context").join(shorter, "low")
        p = lambda x: F.when(F.col(f"t{x}") > 0, (F.col(x) + F.col(f"k{x}") * F.col(f"l{x}")) / (F.col(f"t{x}") + F.col(f"k{x}"))).otherwise(F.col(f"l{x}"))
        left = lambda x: F.when(F.col(f"t{x}") > 0, F.log(F.col(f"k{x}") / (F.col(f"t{x}") + F.col(f"k{x}")))).otherwise(0.0)
        level = written(joined.select("gram", p("a").alias("pa"), p("b").alias("pb")), "url-probabilities", n)
        yield level.select("gram", (F.log("pa") - F.log("pb")).alias("value")), contexts.select("context", (left("a") - left("b")).alias("value"))
        shorter = level.select(F.col("gram").alias("low"), F.col("pa").alias("la"), F.col("pb").alias("lb"))


class GramRatios:
    """The log-likelihood difference of two models from the values of seen grams and contexts."""

    def __init__(self, order: int, levels: Sequence[tuple[DataFrame, DataFrame]]):
        self.order = order
        self.tables = []
        for frames in zip(*levels, strict=True):
            found = [f.select(F.xxhash64(f.columns[0]).alias("key"), "value").toArrow() for f in frames]
            keys, values = (np.concatenate([t[c].to_numpy() for t in found]) for c in ("key", "value"))
            at = np.argsort(keys)
            self.tables.append((keys[at], values[at]))
        self.known: dict[str, float] = {}

    def value(self, table: int, text: str) -> float | None:
        keys, values = self.tables[table]
        key = np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64)
        at = np.searchsorted(keys, key)
        return float(values[at]) if at < len(keys) and keys[at] == key else None

    def of_gram(self, gram: str) -> float:
        out = 0.0
        while gram:
            if (x := self.value(0, gram)) is not None:
                return out + x
            out += self.value(1, gram[:-1]) or 0.0
            gram = gram[1:]
        return out

    def ratio(self, text: str) -> float:
        """Length-normalised log-likelihood difference; higher: likelier accepted."""
        padded, total = START * self.order + text + START, 0.0
        for i in range(len(text) + 1):
            gram = padded[i : i + self.order + 1]
            if (x := self.known.get(gram)) is None:
                x = self.of_gram(gram)
                if len(self.known) < 200_000:
                    self.known[gram] = x
            total += x
        return total / (len(text) + 1)


def best_cut(scores: DataFrame) -> float:
    """Of the middles between neighbouring scores of (score, accepted) that with the least sum of error rates, nearest to
    zero; 0 if there is one score only."""
    n = scores.agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no")).first()
    rows = scores.groupBy("score").agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no"))
    ranged = rows.repartitionByRange(partitions(scores.sparkSession), "score").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "url-scores")
    parts = sorted(ranged.groupBy("part").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.min("score").alias("first")).collect(), key=lambda r: r["first"])
    before, yes, no = [], 0, 0
    for r, after in zip(parts, [*(p["first"] for p in parts[1:]), None], strict=True):
        before.append((r["part"], yes, no, after))
        yes, no = yes + r["yes"], no + r["no"]
    before = scores.sparkSession.createDataFrame(before, "part int, yes_before long, no_before long, after double")
    own = Window.partitionBy("part").orderBy("score")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    cut = ranged.join(F.broadcast(before), "part").select("score", (F.sum("yes").over(upto) + F.col("yes_before")).alias("yes"), (F.sum("no").over(upto) + F.col("no_before")).alias("no"), F.coalesce(F.lead("score").over(own), "after").alias("next")).where("next IS NOT NULL")
    middle = (F.col("score") + F.col("next")) / 2
    cut = cut.withColumn("cut", F.when(middle > F.col("score"), middle).otherwise(F.col("next")))
    error = F.col("yes") / F.lit(max(1, n["yes"])) + (F.lit(n["no"]) - F.col("no")) / F.lit(max(1, n["no"]))
    best = cut.agg(F.min(F.struct(error.alias("error"), F.abs("cut").alias("size"), "cut")).alias("best")).first()["best"]
    return best["cut"] if best else 0.0


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", order: int = 4) -> DataFrame:
    """pages with host, path, rule, verdict (allow or block) and score (null where a rule decides)."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    pages = pages.drop("host", "path", "rule", "verdict", "score").withColumns({"host": host, "path": path})
    rule, verdict = deciding_rule(rules)
    ruled = pages.withColumns({"rule": rule, "verdict": verdict})
    text = F.concat("host", "path")
    examples = ruled.where("verdict IS NOT NULL").select(text.alias("t"), (F.col("verdict") == "allow").alias("accepted")).distinct()
    examples = written(examples.withColumn("held", F.pmod(F.xxhash64("t"), F.lit(5)) == 0), "url-examples")
    n = {(r["accepted"], r["held"]): r["count"] for r in examples.groupBy("accepted", "held").count().collect()}
    if len({accepted for accepted, _ in n}) < 2:
        return ruled.withColumns({"verdict": F.coalesce("verdict", F.lit("allow")), "score": F.lit(None).cast("double")})

    def part(held: bool) -> DataFrame:
        whole = [accepted for accepted in (True, False) if (accepted, held) not in n]
        return examples.where((F.col("held") == held) | F.col("accepted").isin(whole))

    model = spark.sparkContext.broadcast(GramRatios(order, list(gram_ratios(part(False), order))))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ratio = model.value.ratio
        for x in texts:
            yield x.map(lambda t: None if t is None else ratio(t)).astype("float64")

    threshold = best_cut(written(part(True).select(score("t").alias("score"), "accepted"), "url-calibration"))
    scored = ruled.withColumn("score", score(F.when(F.col("verdict").isNull(), text)))
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))))
