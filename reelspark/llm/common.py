"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.operators.lineage import checkpoint  # noqa: F401

_LOADED: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def settled(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """df's columns in keep and the given ones, each worked out once for a row.

    Neighbouring projections are merged by the optimizer, which would work an array
    out anew for each element of a lambda that looks it up; a generator of one row
    stands between them.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def released(run):
    """run, an Arrow function; after a task, its worker hands freed memory back to the system.

    Workers live on for later tasks, and their allocators would keep what large arrays
    have left.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return wrapped


def once(key: str, make):
    """make(), at most once in each Python worker for each key."""
    if key not in _LOADED:
        _LOADED[key] = make()
    return _LOADED[key]


def shipped(spark: SparkSession, path: str):
    """The bytes of a file that the driver sees, as a broadcast, and their digest.

    Vocabulary files have a few MB whatever the corpus, so the broadcast is bounded.
    """
    with open(path, "rb") as f:
        content = f.read()
    return spark.sparkContext.broadcast(content), hashlib.sha256(content).hexdigest()


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, in runs of about most_bytes of text in the given column (one row at least)."""
    for batch in batches:
        texts = batch.column(column)
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
            if size and size + (n or 0) > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += (n or 0) + 8
        if start < batch.num_rows:
            yield batch.slice(start)
