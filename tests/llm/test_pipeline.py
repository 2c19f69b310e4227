"""The pipeline's stages on the test tables, each against a brute-force version of its rule."""

import os
import re
import zlib
from collections import defaultdict

import pytest
import tiktoken  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from lathework.llm.simhash import gram_hashes
from tests.llm.test_edges import brute_lines, brute_overlap, brute_repeats, collected

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def test_columns_stay(stages):
    want = dict(stages["documents"].dtypes)
    assert all(dict(stages[n].dtypes) == want for n, _ in corpus_pipeline.STAGES[:-1])


def test_quality_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").join(stages["documents"], "doc_id")
    kept = {r.doc_id for r in stages["quality"].select("doc_id").collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [r.doc_id in kept for r in held if r.quality == 1]
    assert sum(good) / len(good) > 0.95


def test_lines(stages):
    rows = [tuple(r) for r in stages["quality"].select("doc_id", "text").collect()]
    want = sorted(((i, t) for i, t, *_ in brute_lines(rows)), key=repr)
    assert collected(stages["line_dedup"].select("doc_id", "text")) == want
    assert stages["line_dedup"].where("n_chars <> length(text)").count() == 0


def test_near_duplicates(stages):
    rows = {r.doc_id: set(gram_hashes(r.text.encode(), 5).tolist()) for r in stages["line_dedup"].collect()}
    label = {i: i for i in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(rows)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(rows[a] & rows[b])
            if both >= 0.8 * (len(rows[a]) + len(rows[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    want = {i for i in ids if root(i) == i}
    got = {r.doc_id for r in stages["near_dedup"].collect()}
    assert want <= got and len(got - want) <= 0.02 * len(ids)


def test_contamination(spark, stages):
    rows = [tuple(r) for r in stages["near_dedup"].select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    want = {i for i, n, hit, _ in brute_overlap(rows, items) if not (hit and 20 * hit >= n)}
    assert {r.doc_id for r in stages["decontamination"].collect()} == want and len(want) < len(rows)


def test_every_token_is_packed_once(stages):
    last = stages["packing"]
    per_doc = defaultdict(list)
    for r in last.collect():
        per_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert set(per_doc) == {r.doc_id for r in stages["decontamination"].collect()}
    for own in per_doc.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False)) and sum(own[-1][:2]) == own[-1][2]
    sizes = [r.n for r in last.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes)


def test_repeats_on_the_test_tables(spark):
    from lathework.llm.repeats import drop_repeats

    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 120")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert collected(drop_repeats(docs)) == brute_repeats(rows)
    assert re.fullmatch("[0-9a-f]{64}", drop_repeats(docs).first().kept_sha256)


def test_run_gives_the_last_stage_and_deletes_the_others(spark, stages):
    from lathework.llm.common import shared_folder

    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, DATA)
    assert collected(got.select("doc_id", "start", "length", "ids_crc32").where("start = 0").select("doc_id").distinct()) == collected(stages["packing"].select("doc_id").distinct())
    made = set(os.listdir(folder)) - before
    assert len(made) == 1 and os.listdir(f"{folder}/{made.pop()}") == ["packing"]
