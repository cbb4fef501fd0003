"""Streams whose state outlives a batch: first occurrence per key, and monthly totals.

Both write only the keys that a batch touched, as one folder per batch; a batch that is replayed after a failure
replaces its own folder.  State lies in the checkpoint folder, so a later run goes on where the last one
stopped.  State grows with the keys: for many of them name the RocksDB provider in
``spark.sql.streaming.stateStore.providerClass``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from procurelytics.sources.tables import is_missing

#: Names the folder of each batch.
BATCH = "written_in_batch"


def first_occurrences(rows: DataFrame, keys, order, out: str, checkpoint: str) -> StreamingQuery:
    """The first row per key in ``order`` of all that ever landed; process what is there and stop.

    The order is that of the rows, not of their arrival: a late row that comes before the kept one takes
    its place, so late and repeated files give what one batch over all rows gives.  NULL keys are one
    key; rows that are equal in ``order`` are taken to be equal.  Read the result by ``current``."""
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
    return _changes(first.select(*keys, "first.*").select(*rows.columns), out, checkpoint)


def monthly_totals(rows: DataFrame, date: str, totals: dict, out: str, checkpoint: str, by=(), delay: str | None = None) -> StreamingQuery:
    """Month and ``by`` with the aggregates of ``totals`` (name -> Column) over all that ever landed;
    process what is there and stop.  Rows without date form the month NULL.

    A month's state is one row per group, kept for ever unless ``delay`` is given.  With it, the state of
    a month goes once the newest month seen is more than ``delay`` later; a row that comes after that, or
    has no date, is left out and counted as dropped in the query's progress.  Read the result by ``current``."""
    rows = rows.withColumn("month", F.date_trunc("month", F.col(date)))
    if delay is not None:
        rows = rows.withWatermark("month", delay)
    found = rows.groupBy("month", *by).agg(*[c.alias(name) for name, c in totals.items()])
    return _changes(found, out, checkpoint)


def _changes(found: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    if BATCH in found.columns:
        raise ValueError(f"the column name {BATCH} is taken by the batches' folders")
    out = out.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    return (found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current(spark: SparkSession, out: str, schema: T.StructType, keys) -> DataFrame:
    """The newest state of every key that a stream of this module wrote to ``out`` in the columns of
    ``schema``; no rows where nothing has been written yet.  The batch numbers decide; within a batch each
    key stands once.  ``max_by`` combines on the map side."""
    keys = list(keys)
    try:
        log = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(out)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], schema)
    rest = [c for c in schema.names if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("last")).select(*keys, "last.*").select(*schema.names)
