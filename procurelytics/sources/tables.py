"""Table scans: by name or by folder, with a declared empty frame for what is missing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because the table or folder does not exist.  All else (no access, a
    damaged file, an unknown column) is an error that must not pass for an empty table."""
    return error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")


def read_parquet(spark: SparkSession, folder: str, name: str, schema=None) -> DataFrame:
    """A parquet table of a folder; with a declared schema no job looks at the files first."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, name: str, schema: T.StructType | None = None, folder: str | None = None) -> DataFrame:
    """A catalog table, or a parquet table of a layer folder.  A missing one gives
    an empty frame with ``schema``, so later steps need no special case; without a
    schema the error is passed on."""
    try:
        return read_parquet(spark, folder, name) if folder else spark.table(name)
    except AnalysisException as error:
        if schema is None or not is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def scan_sql(spark: SparkSession, df: DataFrame, limit: int | None = None, order: str | None = None) -> DataFrame:
    """``SELECT *`` over a frame, with an optional order and row limit."""
    text = "SELECT * FROM {source}"
    if order:
        text += f" ORDER BY {order}"
    if limit is None:
        return spark.sql(text, source=df)
    return spark.sql(text + " LIMIT :row_limit", args={"row_limit": int(limit)}, source=df)


def literal_rows(spark: SparkSession, rows, columns) -> DataFrame:
    """A short constant table, built from literals inside the JVM.  Spark knows that it is
    small, so a join to it needs no hint."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
