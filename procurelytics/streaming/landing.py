"""Incremental loads: files that land in a folder are merged into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from procurelytics.operators.ranking import latest_per
from procurelytics.sinks.layers import upsert_table


def merge_landed(spark: SparkSession, landing: str, schema, base: str, keys, *, newest_by: str, checkpoint: str,
                 file_format="parquet") -> StreamingQuery:
    """Process what has landed since the last run and stop.  Inside one batch the newest
    row of a key counts; a batch that is replayed after a failure gives the same table,
    because the merge is by key."""
    landed = spark.readStream.schema(schema).format(file_format).load(landing)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        order = [newest_by, *[c for c in batch.columns if c not in keys and c != newest_by]]
        upsert_table(spark, base, latest_per(batch, list(keys), order), keys)

    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
