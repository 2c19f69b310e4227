"""Katz back-off of any order in DataFrame operations: a table of counts for each order, evaluated recursively.

Order n has the table of (history of n - 1 words, word) with counts of the training texts, their discounted
probabilities, and a table of histories with their back-off weights. A token takes the probability of the highest order
that knows it, times the weights of the known histories above; histories that were never seen weigh 1. Weights are what
is left of the discounts over what the lower order leaves to words that were not seen, so each distribution sums to 1.
Discounts are Good-Turing's for counts up to 5, for each order by itself.

Tables are built from distinct n-grams (counts are added up before they are shuffled) and written, so that AQE can split
the rows of a frequent history. `katz.score_katz` is the packed form for order 2, with less to shuffle.

Defined results: as `katz.score_katz`, but words are compared as such, not by hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.llm.common import ascii_lower, written
from lathework.llm.katz import DISCOUNTED, Unigrams, discounts

END = "\n"
LEAST = 1e-300


def last_words(history: Column, n: int) -> Column:
    return F.substring_index(history, " ", -n)


def count_of_counts(table: DataFrame) -> np.ndarray:
    found = {r.c: r["n"] for r in table.where(F.col("c") <= DISCOUNTED + 1).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    return np.array([found.get(r, 0) for r in range(1, DISCOUNTED + 2)])


def discounted(d: np.ndarray) -> Column:
    return F.element_at(F.array(*(F.lit(float(x)) for x in d)), (F.least(F.col("c"), F.lit(DISCOUNTED + 1)) + 1).cast("int")) * F.col("c")


def tokens_of(docs: DataFrame, train: Column, id: str, text: str, order: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, id, train, n_tokens) and their distinct (row, train, h, w, times); the first history is one empty word."""
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\n\x0B\f\r]+"), "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.coalesce(train & F.col(id).isNotNull(), F.lit(False)).alias("train"), F.concat(F.array(F.lit("")), words, F.array(F.lit(END))).alias("words"))
    rows = written(rows.withColumn("n_tokens", (F.size("words") - 1).cast("long")), "katz-rows")
    history = lambda i: F.array_join(F.slice("words", F.greatest(i - (order - 2), F.lit(1)), F.least(F.lit(order - 1), i)), " ")
    grams = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.struct(history(i).alias("h"), F.get("words", i).alias("w")))
    tokens = rows.select("row", "train", F.explode(grams).alias("g")).groupBy("row", "train", "g.h", "g.w").agg(F.count(F.lit(1)).alias("times"))
    return rows.drop("words"), written(tokens, "katz-tokens")


class Level:
    """Order n: (h, w, p) for n-grams that were seen, (h, weight) for their histories, the latter as log10."""

    def __init__(self, counts: DataFrame, n: int, lower: Level | None, unigrams: DataFrame):
        grams = counts.where(F.size(F.split("h", " ")) >= n - 1).groupBy(last_words(F.col("h"), n - 1).alias("h"), "w").agg(F.sum("c").alias("c"))
        grams = written(grams, f"katz-counts-{n}")
        d = discounts(count_of_counts(grams))
        sums = grams.groupBy("h").agg(F.sum("c").alias("total"), F.min("c").alias("least"))
        sums = sums.select("h", (F.col("total") + F.when(F.col("least") > DISCOUNTED, 1).otherwise(0)).alias("total"))
        known = grams.join(sums, "h").select("h", "w", (discounted(d) / F.col("total")).alias("p"))
        self.grams = written(known, f"katz-probabilities-{n}")
        if lower is None:
            below = self.grams.join(unigrams.select("w", F.col("p").alias("q")), "w")
        else:
            short = lower.grams.select(F.col("h").alias("short"), "w", F.col("p").alias("q"))
            below = self.grams.withColumn("short", last_words(F.col("h"), n - 2)).join(short, ["short", "w"])
        left = below.groupBy("h").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        weight = F.log10(F.greatest(1 - F.col("p"), F.lit(LEAST)) / F.greatest(1 - F.col("q"), F.lit(LEAST)))
        self.histories = written(left.select("h", weight.alias("weight")), f"katz-weights-{n}")


def score_orders(docs: DataFrame, train: Column, order: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of docs."""
    if order < 2:
        raise ValueError("order must be at least 2")
    rows, tokens = tokens_of(docs, train, id, text, order)
    counts = written(tokens.where("train").groupBy("h", "w").agg(F.sum("times").alias("c")), "katz-counts")
    words = written(counts.groupBy("w").agg(F.sum("c").alias("c")), "katz-words")
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    model = Unigrams(size.n, size.v, count_of_counts(words))
    words = words.withColumn("p", discounted(model.d) / model.total)
    levels: list[Level] = []
    for n in range(2, order + 1):
        levels.append(Level(counts, n, levels[-1] if levels else None, words))
    state = tokens.select("h", "w").distinct().withColumns({"weight": F.lit(0.0), "found": F.lit(None).cast("double")})
    for n in range(order, 1, -1):
        level = levels[n - 2]
        short = F.when(F.size(F.split("h", " ")) >= n - 1, last_words(F.col("h"), n - 1))
        state = state.withColumn("short", short)
        state = state.join(level.grams.select(F.col("h").alias("short"), "w", "p"), ["short", "w"], "left").join(level.histories.select(F.col("h").alias("short"), F.col("weight").alias("more")), "short", "left")
        state = state.select("h", "w", F.coalesce("found", F.col("weight") + F.log10("p")).alias("found"), (F.col("weight") + F.coalesce("more", F.lit(0.0))).alias("weight"))
    unknown = float(model.rest / model.total)
    state = state.join(words.select("w", "c", "p"), "w", "left")
    lowest = F.col("weight") + F.log10(F.coalesce("p", F.lit(unknown)))
    scored = state.select("h", "w", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("found", lowest).alias("log_p"))
    each = tokens.join(scored, ["h", "w"]).groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).cast("long").alias("n_known"),
        F.sum(F.col("times") * (F.log10(F.col("c") + 1) - F.lit(float(np.log10(model.tokens + model.distinct + 1.0))))).alias("base_score"),
        F.sum(F.col("times") * F.col("log_p")).alias("score"),
    )
    return rows.join(each, "row").select(F.col("id").alias(id), "train", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
