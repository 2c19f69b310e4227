"""Joins with completeness, set comparison and argmax semantics, digests over sets, dedup by latest."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def complete_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that raises if a left key has no partner."""
    missing = left.select(*on).join(right.select(*on), on, "left_anti").distinct()
    if gone := missing.limit(5).collect():
        raise ValueError(f"no partner for {[tuple(r) for r in gone]}")
    return left.join(right, on)


def two_way_difference(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Keys in one table only, with side."""
    left = a.select(*on).distinct().join(b.select(*on).distinct(), on, "left_anti").withColumn("side", F.lit("only_left"))
    right = b.select(*on).distinct().join(a.select(*on).distinct(), on, "left_anti").withColumn("side", F.lit("only_right"))
    return left.unionByName(right)


def same_sets(a: DataFrame, b: DataFrame, on: list[str]) -> bool:
    return two_way_difference(a, b, on).isEmpty()


def best_matches(paths: DataFrame, known: DataFrame) -> DataFrame:
    """(sid, repo, matched): repositories that hold the most of a session's paths, all of them if tied."""
    hits = paths.select("sid", "path").distinct().join(known, "path").groupBy("sid", "repo").agg(F.count(F.lit(1)).alias("matched"))
    w = Window.partitionBy("sid").orderBy(F.desc("matched"))
    return hits.withColumn("__r", F.rank().over(w)).where("__r = 1").drop("__r")


def claim_accuracy(claims: DataFrame, best: DataFrame, least_judged: int = 50, least: float = 0.95) -> DataFrame:
    """Claims (sid, repo) judged where there is a best match: right if among the best. Too few judged fails."""
    judged = claims.join(best.select("sid").distinct(), "sid", "left_semi")
    right = judged.join(best.select("sid", "repo"), ["sid", "repo"], "left_semi")
    out = judged.agg(F.count(F.lit(1)).alias("judged")).crossJoin(right.agg(F.count(F.lit(1)).alias("right")))
    accuracy = F.try_divide(F.col("right").cast("double"), F.col("judged").cast("double"))
    return out.withColumn("accuracy", accuracy).withColumn("ok", F.coalesce((F.col("judged") >= least_judged) & (accuracy >= least), F.lit(False)))


def latest(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """The last row of every key; ties go to one of them by all other columns."""
    rest = [c for c in df.columns if c not in (*by, order)]
    return df.groupBy(*by).agg(F.max(F.struct(order, *rest)).alias("r")).select(*by, "r.*")


def set_digest(df: DataFrame, line: Column, end: str = "\n", joiner: str = "\n") -> DataFrame:
    """sha256 of the sorted lines, and their number. The digest needs them in order, so one task reads them; it sorts with
    spilling and hashes batch by batch, and holds neither a list nor the whole string."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, n = hashlib.sha256(), 0
        for batch in batches:
            for x in batch.column(0).cast(pa.binary()):
                digest.update((joiner.encode() if n else b"") + x.as_py())
                n += 1
        digest.update(b"" if end == joiner else end.encode())
        yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()]), pa.array([n], pa.int64())], ["digest", "n"])

    lines = df.select(line.alias("line")).where("line is not null").repartition(1).sortWithinPartitions("line")
    nothing = hashlib.sha256(b"" if end == joiner else end.encode()).hexdigest()
    return lines.mapInArrow(hashed, "digest string, n long").agg(F.coalesce(F.max_by("digest", "n"), F.lit(nothing)).alias("digest"), F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("n"))


def at_ranks(df: DataFrame, column: str, ranks: dict[str, Callable[[Column], Column]], cells: int = 1024) -> DataFrame:
    """One row with the values at the given places (from 0; functions of the count) of the sorted non-null values. A
    histogram of `cells` equal ranges finds the range of each place, and only values of these ranges are sorted."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    whole = values.agg(F.sum("k").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    cell = F.coalesce(F.least(F.floor(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")) * cells), F.lit(cells - 1)), F.lit(0)).cast("int")
    values = values.crossJoin(F.broadcast(whole)).withColumn("cell", cell)
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = values.groupBy("cell").agg(F.sum("k").alias("k"), F.max("n").alias("n")).withColumn("stop", F.sum("k").over(upto))  # at most `cells` rows
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()))
    places = held.withColumn("w", F.explode(wanted)).select("cell", F.col("w.name").alias("name"), (F.col("w.rank") - (F.col("stop") - F.col("k"))).alias("rank"), "k").where("rank >= 0 and rank < k")
    inside = Window.partitionBy("cell").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = values.join(F.broadcast(places.select("cell").distinct()), "cell").withColumn("stop", F.sum("k").over(inside))
    found = near.drop("n").alias("a").join(F.broadcast(places.select("cell", "name", "rank")).alias("b"), "cell").where("stop > rank")
    least = found.groupBy("name").agg(F.min("v").alias("v"))
    return least.agg(*(F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in ranks))


def batch_fingerprint(sessions: DataFrame) -> DataFrame:
    """sha256 over sorted sid:steps lines; other fields do not matter."""
    return set_digest(sessions, F.concat(F.col("sid").cast("string"), F.lit(":"), F.col("steps").cast("string")))


def release_digest(files: DataFrame) -> DataFrame:
    """sha256 over sorted path NUL sha LF records."""
    return set_digest(files, F.concat("path", F.lit("\0"), "sha", F.lit("\n")), end="", joiner="")


def mismatches(expected: DataFrame, actual: DataFrame, on: str, value: str) -> DataFrame:
    """(key, state): files of a manifest that are missing or differ."""
    joined = expected.join(actual.select(on, F.col(value).alias("__actual")), on, "left")
    return joined.select(on, F.when(F.col("__actual").isNull(), "missing").when(F.col("__actual") != F.col(value), "differs").alias("state")).where("state is not null")


def missing_files(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required (task, path) that are absent or empty."""
    return required.join(present.where("size > 0"), ["task", "path"], "left_anti")


def numbered(df: DataFrame, order: str, rows: int = 100_000) -> DataFrame:
    """df with __n, the place of each row by a distinct numeric key, from 0. Ranges of about `rows` rows are numbered by
    themselves, so no task sorts the whole table; only their sizes reach the driver."""
    buckets = max(1, df.count() // rows)
    cuts = sorted(set(df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.2 / buckets))) if buckets > 1 else []
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(order))) if cuts else F.lit(0)
    dealt = df.withColumn("__b", bucket)
    sizes, start, offsets = {r["__b"]: r["count"] for r in dealt.groupBy("__b").count().collect()}, 0, []
    for b in sorted(sizes):
        offsets += [F.lit(b), F.lit(start)]
        start += sizes[b]
    if not offsets:
        return df.withColumn("__n", F.lit(0).cast("long"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy(order)) - 1
    return dealt.withColumn("__n", place + F.try_element_at(F.create_map(*offsets), F.col("__b"))).drop("__b")


def even_stride(df: DataFrame, order: str, k: int) -> DataFrame:
    """Every floor(n/k)-th row by a distinct numeric key, the first k of them."""
    step = max(1, df.count() // k)
    return numbered(df, order).where(F.col("__n") % step == 0).orderBy(order).limit(k).drop("__n")


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows by hash of key and seed; the same rows for any partitioning."""
    return df.orderBy(F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def most_common(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Counts, largest first, ties by key."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(key))
    return out.limit(k) if k else out


def sync_verdict(catalog: DataFrame, markers: DataFrame) -> DataFrame:
    """catalog (sid, fingerprint, in_progress) with what an incremental pull does: pull or skip, and why."""
    m = markers.select("sid", F.col("fingerprint").alias("__was"), F.lit(True).alias("__marked"))
    why = (
        F.when(F.col("__marked").isNull(), "no_marker").when(F.col("in_progress"), "in_progress").when(F.col("__was").isNull(), "broken_marker")
        .when(F.col("__was") == F.col("fingerprint"), "equal").otherwise("changed")
    )
    out = catalog.join(m, "sid", "left").withColumn("why", why)
    return out.withColumn("action", F.when(F.col("why") == "equal", "skip").otherwise("pull")).drop("__was", "__marked")
