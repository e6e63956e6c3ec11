"""Staging in the cluster's shared folder, and column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL: list[str] = []
#: The folder of each staged frame, and those of each block of `passing` that is open.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in a local session without that setting."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="loadkit-"))
    return f"file://{_LOCAL[0]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage, so what follows does not run the steps before it
    again, and a lost executor costs only tasks that read the written files.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for own in _OPEN.get()[-1:]:
        own.append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[staged] = path
    return staged


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is staged in this block is deleted at its end, but for the frames given to the function it yields.

    Those are left to the block around, if there is one. A frame that leaves the block may read
    no other table that was staged in it.
    """
    own: list[str] = []

    def keep(staged: DataFrame) -> DataFrame:
        own.remove(path := _FOLDERS[staged])
        for around in outer[-1:]:
            around.append(path)
        return staged

    outer = _OPEN.get()
    token = _OPEN.set((*outer, own))
    try:
        yield keep
    finally:
        _OPEN.reset(token)
        for path in own:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def columns(docs: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns, under the operator's own names: `columns(df, doc="doc_id")`.

    Other columns of the input can have any names without clashing.
    """
    return docs.select(*[F.col(f"`{name}`").alias(own) for own, name in wanted.items()])


def schema(*parts: str | T.StructField) -> T.StructType:
    """A schema of DDL texts and of fields taken from another frame, whose names can be any."""
    return T.StructType([f for p in parts for f in (T.StructType.fromDDL(p).fields if isinstance(p, str) else [p])])


_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and what it keeps counts against the executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
                schema: str | T.StructType, most: int = 1 << 20, rows: int = 1 << 20) -> DataFrame:
    """`work` on slices of each Arrow batch that hold about a MB of text and no more than `rows` rows, so that arrays in a task stay small.

    What a slice took is given back before the next, and the last batch at the end, as the worker outlives the task.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, most, rows):
                out = work(part)
                yield from ([out] if isinstance(out, pa.RecordBatch) else out)
                del out
                give_back()
        batch = part = None
        give_back()
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = 2 << 20, most_rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of about `most` bytes and at most `most_rows` rows, a longer row alone."""
    rows, size = batch.num_rows, batch.nbytes
    if rows <= 1 or size <= most and rows <= most_rows:
        if rows:
            yield batch
        return
    half = rows // 2
    yield from slices(batch.slice(0, half), most, most_rows)
    yield from slices(batch.slice(half), most, most_rows)
