import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.sources import readers
from lathework.sources.catalog import SessionCatalog

LINES = '{"sid": "a", "n": 1}\n\nnot json\n{"sid": "b", "n": 2}\n{"sid": "a", "n": 3}\n'


@pytest.fixture
def schema():
    return T.StructType([T.StructField("sid", T.StringType()), T.StructField("n", T.LongType())])


def test_strict_and_tolerant_reads(spark, tmp_path, schema):
    (tmp_path / "x.jsonl").write_text(LINES)
    rows = readers.read_jsonl_tolerant(spark, str(tmp_path), schema)
    assert [(r.line_no, r.parsed_no, r.sid, r.n) for r in rows.orderBy("line_no").collect()] == [(0, 0, "a", 1), (3, 1, "b", 2), (4, 2, "a", 3)]
    assert {(r.sid, r.n) for r in readers.last_by_position(rows, "sid").collect()} == {("a", 3), ("b", 2)}
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.read_jsonl(spark, str(tmp_path), schema).collect()


def test_trajectories(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "_x").mkdir()
    (tmp_path / "s1" / "session.traj").write_text('[{"message_type": "action", "tool_name": "Edit"}, {"message_type": "observation"}, {"message_type": "action", "tool_name": "Bash"}]')
    (tmp_path / "s1" / "broken").write_text("[")
    (tmp_path / "_x" / "session.traj").write_text("[]")
    assert {r.sid for r in readers.session_files(spark, str(tmp_path)).collect()} == {"s1"}
    step = T.StructType([T.StructField("message_type", T.StringType()), T.StructField("tool_name", T.StringType())])
    docs = readers.read_trajectory(spark, str(tmp_path / "s1"), step).withColumn("sid", F.lit("s1"))
    assert [(r.idx, r.tool_name) for r in readers.action_timeline(docs).orderBy("idx").collect()] == [(0, "Edit"), (2, "Bash")]


def test_trial_documents_and_writers(spark, tmp_path):
    (tmp_path / "trials.json").write_text(json.dumps({"rows": [{"task": "a", "reward": 1.0}, {"task": "b", "reward": None}]}, indent=1))
    rows = readers.read_trials(spark, str(tmp_path / "trials.json"))
    assert rows.count() == 2 and readers.with_rewards(rows).count() == 1
    assert readers.write_jsonl(rows.select("task"), str(tmp_path / "out")) == 2
    readers.write_manifest(rows, str(tmp_path / "m"), ["task", "reward"])
    assert readers.read_manifest(spark, str(tmp_path / "m" / "tsv")).columns == ["task", "reward"]


def test_tool_uses(spark):
    rows = spark.createDataFrame([(1, [("tool_use", "bash", "ls"), ("text", None, None)])], "id int, content array<struct<type:string,name:string,input:string>>")
    assert [tuple(r) for r in readers.tool_uses(rows).collect()] == [(1, "bash", "ls")]


def test_catalog_pages(spark):
    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            page = int(self.path.split("page=")[1].split("&")[0])
            items = [{"sid": f"s{page}{i}", "fingerprint": "f"} for i in range(2)] if page < 3 else []
            body = json.dumps({"total": 99, "items": items}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(SessionCatalog)
    load = lambda **o: spark.read.format("session_catalog").options(url=f"http://127.0.0.1:{server.server_port}/", pagesize="2", **o).load()
    assert sorted(r.sid for r in load().collect()) == ["s10", "s11", "s20", "s21"]
    assert load(limit="3").count() == 3
    server.shutdown()
