"""What the operators share: scratch tables, input columns and memory of Python workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. A local master without one gets a
    temporary folder; on a cluster without one this raises ValueError."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        option = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = option.get() if option.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="colophon-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: lineage ends here, and a lost
    executor costs no more than the task it ran."""
    path = f"{scratch_root(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _malloc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # not the GNU library
        return None


def give_back() -> None:
    """Freed memory that Arrow and the C library hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _malloc_trim():
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, a function for mapInArrow, giving back what it has freed after each batch and at its end. A worker
    stays for later tasks and stages, and an executor has as many as its tasks once had steps at a time; else each keeps the most it ever took."""

    @wraps(run)
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b
                del b
                give_back()

        try:
            yield from run(each())
        finally:
            give_back()

    return trimmed


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of the rows that have an id; a null text is empty. All other columns
    are dropped, whatever they are called."""
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
