"""Readers and writers of session files, trial rows, manifests and test reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict: blank lines are skipped, any malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Physical line numbers of each file from 0; lines: value, path, in file order within a partition (wholetext split)."""
    return lines.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of text files. A line's number needs its whole file in one row."""
    return with_line_numbers(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path")))


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Malformed and blank lines are dropped; line_no counts physical lines, parsed_no those that were kept."""
    rows = read_lines(spark, path).where(F.trim("line") != "")
    held = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = rows.withColumn("r", F.from_json("line", held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})).where("r is not null and r._bad is null")
    w = Window.partitionBy("path").orderBy("line_no")
    return parsed.select("path", "line_no", (F.row_number().over(w) - 1).alias("parsed_no"), *(F.col(f"r.{n}").alias(n) for n in schema.names))


def last_by_position(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with one key the last in file order."""
    w = Window.partitionBy(key).orderBy(F.desc("path"), F.desc("line_no"))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def read_trajectory(spark: SparkSession, path: str, step: T.StructType) -> DataFrame:
    """(path, steps): one JSON array for each file; an empty array where it can't be read."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return files.select("path", F.coalesce(F.from_json("value", T.ArrayType(step)), F.array().cast(T.ArrayType(step))).alias("steps"))


def session_files(spark: SparkSession, path: str) -> DataFrame:
    """(sid, path, modified, length) of files in session folders; names that start with _ or . are no sessions."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("modificationTime").alias("modified"), "length")
    sid = F.element_at(F.split("path", "/"), -2)
    return files.withColumn("sid", sid).where(~F.col("sid").rlike("^[_.]")).select("sid", "path", "modified", "length")


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial rows of documents of the form {"rows": [...]}."""
    row = T.StructType.fromDDL("task string, reward double, f2p double, p2p double, error_code int, exception string, cost_usd double, model string, subtype string, errors array<string>")
    doc = spark.read.schema(T.StructType([T.StructField("rows", T.ArrayType(row))])).option("multiLine", True).json(path)
    return doc.select(F.explode("rows").alias("r"), F.col("_metadata.file_path").alias("path")).select("path", "r.*")


def with_rewards(trials: DataFrame) -> DataFrame:
    """Without rows whose reward is null: they did not fail, they were not judged."""
    return trials.where(F.col("reward").isNotNull())


SUITE = "struct<_name:string,_file:string,_tests:bigint,_failures:bigint>"


def green_suites(xml: Column) -> Column:
    """Sorted files of top-level suites of a junit report that ran tests without failures."""
    doc = F.from_xml(xml, f"struct<testsuite:array<{SUITE}>>", {"attributePrefix": "_"})
    good = F.filter(F.coalesce(doc["testsuite"], F.array().cast(f"array<{SUITE}>")), lambda s: (s["_tests"] > 0) & (s["_failures"] == 0))
    return F.array_sort(F.transform(good, lambda s: F.coalesce(s["_file"], s["_name"])))


def tool_uses(messages: DataFrame, blocks: str = "content") -> DataFrame:
    """(…, name, input) of tool_use blocks."""
    rest = [c for c in messages.columns if c != blocks]
    return messages.select(*rest, F.explode(blocks).alias("b")).where("b.type = 'tool_use'").select(*rest, "b.name", "b.input")


def action_timeline(sessions: DataFrame, steps: str = "steps") -> DataFrame:
    """(sid, idx, …) of the actions among a session's steps, idx being the step's place among all steps."""
    return sessions.select("sid", F.posexplode(steps).alias("idx", "s")).where("s.message_type = 'action'").select("sid", "idx", "s.*")


def write_jsonl(df: DataFrame, path: str) -> int:
    """Writes JSON lines and returns how many, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.json(path)
    return int(seen.get["n"])


def write_manifest(df: DataFrame, path: str, columns: list[str]) -> None:
    """A tab-separated table with header and the same rows as JSON lines."""
    df.select(*columns).write.option("sep", "\t").option("header", True).csv(f"{path}/tsv")
    df.select(*columns).write.json(f"{path}/jsonl")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def jobs_in_manifest(manifest: DataFrame, job: str = "job", sha: str = "sha256") -> DataFrame:
    """Job-shaped names (date, two underscores, time) with a checksum."""
    return manifest.where((F.coalesce(sha, F.lit("")) != "") & F.col(job).rlike(r"^20[0-9]{2}-[0-9]{2}-[0-9]{2}__")).select(F.col(job).alias("job")).distinct()


def topmost(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths without an ancestor among the paths."""
    parts = F.split(path, "/")
    ancestors = paths.select(F.col(path).alias("__p"), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("__a")).where("__a <> __p")
    inner = ancestors.join(paths.select(F.col(path).alias("__a")), "__a", "left_semi").select(F.col("__p").alias(path)).distinct()
    return paths.join(inner, path, "left_anti")
