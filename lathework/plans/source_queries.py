"""Sources over whole tables: what a query reads, it has written as files before. Files are dealt by key, so none grows
with the table but those of the strict reader, which Spark splits."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.plans.registry import adapted, cte, own_folder, query, table
from lathework.sources import readers

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType())])
BUCKET = "CAST(floor(doc_id / 100) AS BIGINT)"
LINES = f"l AS (SELECT doc_id, lang, {BUCKET} AS bucket, row_number() OVER (PARTITION BY {BUCKET} ORDER BY doc_id) - 1 AS line_no, doc_id % 5 <> 0 AND doc_id % 7 <> 0 AS good FROM documents), p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS parsed_no FROM l WHERE good)"


def line_files(spark, sf) -> str:
    """Files of 100 documents, a line each, some of them broken or blank."""
    k = F.col("doc_id")
    line = F.when(k % 5 == 0, F.concat(F.lit("not json { "), k.cast("string"))).when(k % 7 == 0, F.lit("  ")).otherwise(F.to_json(F.struct("doc_id", "lang")))
    docs = table(spark, sf, "documents").select("doc_id", line.alias("value"), F.expr(BUCKET).alias("bucket"))
    folder = own_folder(spark, "lines")
    docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id").select("bucket", "value").write.partitionBy("bucket").text(folder)
    return folder


def tolerant(spark, sf):
    return readers.read_jsonl_tolerant(spark, line_files(spark, sf), DOC)


@query("io01_strict_lines", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folder = own_folder(spark, "orders")
    rows.write.json(folder)
    return readers.read_jsonl(spark, folder, rows.schema)


@query("io03_written_lines", "SELECT count(*) AS returned, count(*) AS read FROM orders")
def _(spark, sf):
    folder = own_folder(spark, "counted")
    n = readers.write_jsonl(table(spark, sf, "orders").select("o_orderkey"), folder)
    return spark.read.schema("o_orderkey long").json(folder).agg(F.lit(n).cast("long").alias("returned"), F.count(F.lit(1)).alias("read"))


@query("io04_tolerant_lines", f"WITH {LINES} SELECT doc_id, lang, CAST(line_no AS INTEGER) AS line_no, CAST(parsed_no AS INTEGER) AS parsed_no FROM p")
def _(spark, sf):
    return tolerant(spark, sf).select("doc_id", "lang", "line_no", "parsed_no")


@query("io05_last_of_a_key", f"WITH {LINES} SELECT lang, arg_max(doc_id, (concat(bucket, '/'), line_no)) AS doc_id FROM p GROUP BY lang")
def _(spark, sf):
    return readers.last_by_position(tolerant(spark, sf), "lang").select("lang", "doc_id")


def trajectories(spark, sf) -> str:
    """One file for each conversation; every sixth is cut off."""
    step = F.struct("turn", F.when(F.col("role") == "user", "observation").otherwise("action").alias("message_type"), F.col("role").alias("tool_name"))
    steps = F.transform(F.array_sort(F.collect_list(step)), lambda s: F.struct(s["message_type"].alias("message_type"), s["tool_name"].alias("tool_name")))
    files = table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(steps).alias("value"))
    folder = own_folder(spark, "trajectories")
    files = files.withColumn("value", F.when(F.col("conv_id") % 6 == 0, F.substring("value", 1, 9)).otherwise(F.col("value")))
    files.withColumn("session", F.col("conv_id")).select("session", "value").repartition("session").write.partitionBy("session").text(folder)
    return folder


STEP = T.StructType([T.StructField("message_type", T.StringType()), T.StructField("tool_name", T.StringType())])
SID = "CAST(regexp_extract(path, 'session=([0-9]+)', 1) AS BIGINT) AS sid"


@query("io08_trajectories", "SELECT conv_id AS sid, CASE WHEN conv_id % 6 = 0 THEN 0 ELSE count(*) END::INTEGER AS n_steps FROM conversations GROUP BY conv_id")
def _(spark, sf):
    return readers.read_trajectory(spark, f"{trajectories(spark, sf)}/*/*.txt", STEP).selectExpr(SID, "size(steps) AS n_steps")


@query("ne02_action_timeline", "SELECT conv_id AS sid, CAST(i AS INTEGER) AS idx, role AS tool_name FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, CASE WHEN role = 'user' THEN 1 ELSE 0 END, role) - 1 AS i FROM conversations) WHERE conv_id % 6 <> 0 AND role <> 'user'")
def _(spark, sf):
    sessions = readers.read_trajectory(spark, f"{trajectories(spark, sf)}/*/*.txt", STEP).selectExpr(SID, "steps")
    return readers.action_timeline(sessions).select("sid", "idx", "tool_name")


@query("io09_session_folders", "SELECT DISTINCT concat('session=', conv_id) AS sid FROM conversations")
def _(spark, sf):
    return readers.session_files(spark, trajectories(spark, sf)).where("path like '%.txt'").select("sid").distinct()


@query("io16_trial_documents", f"WITH {cte('trials')} SELECT task, reward, model FROM trials")
def _(spark, sf):
    row = F.struct("task", "reward", "model")
    docs = adapted(spark, sf, "trials").withColumn("part", F.expr("CAST(floor(trial_id / 1000) AS BIGINT)")).groupBy("part").agg(F.to_json(F.struct(F.collect_list(row).alias("rows"))).alias("value"))
    folder = own_folder(spark, "documents-of-trials")
    docs.repartition("part").write.partitionBy("part").text(folder)
    return readers.read_trials(spark, folder).select("task", "reward", "model")


@query("io22_tool_uses", "SELECT event_id, event_type AS name, concat('v', user_id) AS input FROM events WHERE event_id % 3 <> 0")
def _(spark, sf):
    use = F.struct(F.when(F.col("event_id") % 3 == 0, "text").otherwise("tool_use").alias("type"), F.col("event_type").alias("name"), F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("input"))
    other = F.struct(F.lit("text").alias("type"), F.lit("x").alias("name"), F.lit("y").alias("input"))
    return readers.tool_uses(table(spark, sf, "events").select("event_id", F.array(other, use).alias("content"))).select("event_id", "name", "input")
