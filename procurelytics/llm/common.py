"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from procurelytics.session import bounded_batches as bounded_batches

#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The whole text; NULL reads as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def give_back() -> None:
    """What a Python worker has freed goes back to the system: workers stay for the next stages, and
    several of them share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def giving_back(run):
    """``run`` over Arrow batches, with ``give_back`` at its end."""
    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped
