"""Shared helpers: table reads, shared-folder tables and Arrow batch access."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where none is set and Spark runs on this machine alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = local_folder()
    return folder.rstrip("/")


@functools.cache
def local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="lathework-")


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `written` makes inside are deleted at the end. For results that are stored by then, as tables are read
    lazily."""
    before, MADE[:] = list(MADE), []
    try:
        yield
    finally:
        for path in MADE:
            delete(spark, path)
        MADE[:] = before


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


MADE: list[str] = []


def written(df: DataFrame, what: str, rows: int | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors. With a bound of its rows it gets
    one file for every 50,000 of them at most, so that small tables are not hundreds of files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df = df if rows is None else df.coalesce(max(1, -(-rows // 50_000)))
    MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, LOWER)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts are long, so batches for Python are bounded at 8 MB instead of Spark's default of 64 MB, which a task holds
    several times over. A setting of the user's own stays."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "8m")


Batches = Iterator[pa.RecordBatch]


def given_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run for mapInArrow, at whose end what it freed goes back to the system. Workers outlive their tasks, and what they
    keep for later counts beside all that the executor holds then."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not glibc
                ctypes.CDLL(None).malloc_trim(0)

    return task


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def null_first(column: Column) -> Column:
    return F.coalesce(column, F.lit(-(2**63)))
