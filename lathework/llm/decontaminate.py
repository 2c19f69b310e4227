"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is `width` consecutive words of an item (all words of a shorter item). A document can hold a window only if
it holds the window's rarest word, so each window's prefix is that one word, rarity being counted over all documents.
Distinct (item, offset) prefixes are joined with document words; the item's words around the offset bound where a
window may lie, and comparing them with the document's words decides exactly. Prefixes go out in broadcast blocks of
at most `block` rows, each of at most 2 * width words, so a larger benchmark means more blocks and no larger broadcast.

Defined results: null or wordless texts have no words and are never hit. Rows that share an id and a text are judged
alike, rows that share only the id are judged each by its own text. Items without an id mark words as hit but are not
listed. Columns beside id and text are not looked at, whatever their names. Empty tables give no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.llm.common import ascii_lower, fresh, written

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = "."


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def run_length(words: Column, at: Column, step: int, other: Column, most: int) -> Column:
    """How many words next to position `at` (from 0) equal `other` (nearest first); a chain of CASE branches, which
    unlike array functions with lambdas keeps the join that tests it inside generated code."""
    out = F.lit(most)
    for i in range(most, 0, -1):
        same = F.coalesce(F.get(words, at + step * i) == F.get(other, F.lit(i - 1)), F.lit(False))
        out = F.when(~same, F.lit(i - 1)).otherwise(out)
    return out


def blocks(df: DataFrame, rows: int, *key: str) -> list[DataFrame]:
    """df dealt into parts of about `rows` rows by a hash of its key."""
    n = -(-max(1, df.count()) // rows)
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(*key), F.lit(n)) == i) for i in range(n)]


def prefixes(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, width: int, block: int) -> DataFrame:
    """One row for each distinct prefix position: word, words to its left (nearest first) and right, window size."""
    of = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("w")).distinct().where(F.size("w") > 0)
    of = of.withColumn("size", F.least(F.size("w"), F.lit(width)))
    token = of.select("item_id", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("start"))
    token = token.select("item_id", "w", "size", "start", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at"))
    token = token.withColumn("word", F.element_at("w", F.col("at")))
    bound = 200 * items.count()  # words are few beside documents; only the number of files depends on it
    vocabulary = written(token.select("word").distinct(), "prefix-words", bound)
    said = docs.select(F.explode_outer(words_of(F.col(text))).alias("word"))  # outer: else Spark splits the texts again to test for words
    counts = [said.join(F.broadcast(b), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")) for b in blocks(vocabulary, block, "word")]
    counted = written(reduce(DataFrame.unionByName, counts), "prefix-counts", bound)  # so that AQE can split a hot word in the join
    token = token.join(counted, "word", "left")
    rarest = token.groupBy("item_id", "w", "size", "start").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("p"))
    out = rarest.select("item_id", "w", "size", F.col("p.at").alias("at"), F.col("p.word").alias("word")).distinct()
    reach = F.least(F.col("at") - 1, F.lit(width - 1))
    left = F.when(reach > 0, F.reverse(F.slice("w", F.greatest(F.col("at") - reach, F.lit(1)), reach))).otherwise(F.array().cast("array<string>"))
    return out.select("item_id", "size", "word", left.alias("left"), F.slice("w", F.col("at") + 1, width - 1).alias("right"))


def matches(docs: DataFrame, prefix: DataFrame, text: str, width: int, block: int) -> DataFrame:
    """Rows (key columns of docs, item_id, first, last) for runs of document words that hold a whole window.

    A mark that is no word closes each text; its row, with first = -1 and last = number of words, stands for the text.
    """
    keys = [c for c in docs.columns if c != text]
    said = docs.select(*keys, F.concat(words_of(F.col(text)), F.array(F.lit(END))).alias("words")).select(*keys, "words", F.posexplode_outer("words").alias("p", "word"))
    end = docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("item_id"), F.lit(0).alias("size"), F.lit(END).alias("word"), F.array().cast("array<string>").alias("left"), F.array().cast("array<string>").alias("right"))
    found = []
    for i, part in enumerate(blocks(prefix, block, "word")):
        part = (part if i else part.unionByName(end)).withColumnRenamed("word", "word_")
        left = run_length(F.col("words"), F.col("p"), -1, F.col("left"), width - 1)
        right = run_length(F.col("words"), F.col("p"), 1, F.col("right"), width - 1)
        hit = said.join(F.broadcast(part), (F.col("word") == F.col("word_")) & ((F.col("size") == 0) | (left + right + 1 >= F.col("size"))))
        of_text = F.col("size") == 0
        found.append(hit.select(*keys, "item_id", F.when(of_text, -1).otherwise(F.col("p") - left).alias("first"), F.when(of_text, F.col("p")).otherwise(F.col("p") + right).alias("last")))
    return reduce(DataFrame.unionByName, found)


def overlap(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 13, block: int = 20_000) -> DataFrame:
    """One row for each row of docs: id, text_hash, n_chars, n_words, n_hit (words inside windows of items), item_ids
    (sorted ids of items with windows here)."""
    prefix = written(prefixes(docs, items, text, item_id, item_text, width, block), "prefixes", 200 * items.count())
    spans = matches(docs.select(F.col(id).alias("id"), *text_key(text), text), prefix, text, width, block)
    of_text = F.col("first") < 0
    by_doc = spans.groupBy("id", "text_hash", "n_chars").agg(
        F.count_if(of_text).alias("copies"),
        F.max(F.when(of_text, F.col("last"))).cast("long").alias("n_words"),
        F.collect_set(F.when(~of_text, F.struct("first", "last"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    merged = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["last"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"] - 1, a["end"]))).alias("n")),
    )["n"]
    by_doc = by_doc.withColumn("n_hit", merged.cast("long"))
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return by_doc.select("id", "text_hash", "n_chars", "n_words", "n_hit", "item_ids", each.alias("copy")).drop("copy")


def text_key(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("text_hash"), F.coalesce(F.length(text), F.lit(-1)).alias("n_chars")]


def drop_contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without those that are contaminated, with their columns."""
    name = fresh(docs, "own_key")
    bad = overlap(docs, items, id, text, **options).where(contaminated())
    bad = written(bad.select(F.struct("id", "text_hash", "n_chars").alias(name)).distinct(), "contaminated", docs.count())
    key = F.struct(F.col(id).alias("id"), *text_key(text))
    return docs.join(bad, key.eqNullSafe(F.col(name)), "left_anti")


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
