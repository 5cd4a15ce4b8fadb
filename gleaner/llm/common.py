"""What the operators of this subpackage share: table access, word splitting and kept tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..kept import drop_kept, drop_path, fresh_path, keep, shared_dir  # noqa: F401

#: Words are maximal runs of characters other than these (bytes.split() splits at the same set).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over Arrow data in a worker that hands memory back to the system once the task is over.

    Workers are reused by later stages, so what one task's allocators retain would add up on an executor.
    """

    def held(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return held


def column_function(each: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind, steady: bool = True):
    """A function of one column over Arrow data. Only that column goes to Python workers, not the rows around it.

    ``steady``: Spark may evaluate it where and as often as it likes; else once for a row.
    """
    lean = frugal(each)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from lean(batches)

    function = F.arrow_udf(run, kind)
    return function if steady else function.asNondeterministic()


def small_batches(spark: SparkSession, rows: int = 500, size: str = "8m") -> None:
    """Let at most ``rows`` rows or about ``size`` bytes go to a Python worker at once, for work on whole texts.

    Settings of the session, since they are read when a plan runs, so they stay for later ones; smaller ones aren't raised.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary").alias(col)


def fold_of(col: str, folds: int) -> Column:
    """crc32 of an id's decimal text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % folds


def starts_of_characters(raw):
    """numpy mask of the bytes that begin a code point."""
    return (raw & 0xC0) != 0x80
