"""The corpus pipeline: raw documents to packed training sequences.

Every stage is written as Parquet and read again, and works on all that the stage before kept; what it was made from is
deleted once it is written. The stages:

1. quality: documents that the classifier rejects go;
2. line dedup: repeated lines stay in one document only;
3. near-duplicates: one document of each group stays. Groups are linked by a Jaccard similarity of 0.8 or more of
   five-word shingles; word fingerprints within 9 bits, found through vantage-point trees, and shingle fingerprints
   propose the pairs;
4. decontamination: documents with benchmark passages go;
5. packing: pieces of sequences of 1024 tokens.

All but the last return the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.common import delete, scratch, shared_folder, table
from lathework.llm.decontaminate import drop_contaminated
from lathework.llm.line_dedup import drop_repeated_lines
from lathework.llm.packing import pack
from lathework.llm.quality import score_quality
from lathework.llm.simhash import drop_near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return score_quality(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    done = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done:
            delete(spark, f"{folder}/{done}")
        done = name
    return docs
