"""Writing layers: full overwrite, append with schema merge, keyed upsert."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from procurelytics.session import cut_lineage, delete_folder
from procurelytics.sources.tables import is_missing

LAYERS = ("raw", "bronze", "silver", "gold", "models")


def ensure_layers(spark: SparkSession, layers=LAYERS) -> None:
    """One schema per layer in the session catalog, where missing."""
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def write_layer(df: DataFrame, path: str, partition_by=()) -> DataFrame:
    """Replace a layer table, schema included, in one action; returns a frame that
    reads it back.  Rows of one partition are brought together, a large one is split."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def save_layer_table(df: DataFrame, name: str) -> None:
    """The same into the session catalog, as ``layer.table``."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def append_history(df: DataFrame, path: str) -> DataFrame:
    """Append to a history whose columns may grow from run to run."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", "true").parquet(path)


def with_audit(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_system": F.lit(source),
        "data_quality_flag": F.lit("VALID"),
    })


def upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same keys; all others
    stay or are added.  A column that only one side has is NULL in the rows of the other.  NULL keys match each other.  Two source rows with one key
    are an error, raised inside the job that writes the result.

    Each side is reduced by key on the map side before one shuffle: a target key
    with many rows is kept row by row, only the source's key list is joined."""
    counted = source.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*source.columns)).alias("_row"))
    message = F.concat(F.lit("upsert: several source rows for key "), F.to_json(F.struct(*keys)))
    single = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    fresh = counted.where(single).select("_row.*")
    gone = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return target.join(gone, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


def upsert_table(spark: SparkSession, base: str, source: DataFrame, keys, keep: int = 2) -> DataFrame:
    """Upsert into a versioned folder (one writer at a time).  The new version is
    written beside the old one and the version log gets its line last, so a failed
    job leaves the table as it was.  The newest ``keep`` versions stay; older ones are deleted."""
    base = base.rstrip("/")
    number, current = _newest(spark, base)
    target = source.limit(0) if current is None else spark.read.parquet(current)
    version = f"{base}/v{number + 1:09d}"
    upsert(target, source, keys).write.mode("overwrite").parquet(version)
    spark.createDataFrame([(f"{number + 1:09d} {version}",)], "line string").coalesce(1).write.mode("append").text(
        f"{base}/_log"
    )
    if number + 1 - keep > 0:
        delete_folder(spark, f"{base}/v{number + 1 - keep:09d}")
    return spark.read.parquet(version)


def upsert_partitions(spark: SparkSession, base: str, source: DataFrame, keys, partition_by: str) -> DataFrame:
    """Upsert into a table partitioned by ``partition_by``, one of the keys: only the
    partitions that the source touches are read and rewritten.  The merged partitions are
    stored in the shared folder first and then replace the old ones; a run that fails in
    between can be repeated, because the merge is by key."""
    if partition_by not in keys:
        raise ValueError(f"{partition_by} is not one of the keys {list(keys)}")
    target = _stored(spark, base)
    if target is None:
        target = source.limit(0)
    else:  # a partition value is read back under the type its text suggests
        target = target.withColumn(partition_by, F.col(partition_by).cast(source.schema[partition_by].dataType))
    touched = source.select(F.col(partition_by).alias("_touched")).distinct()
    merged = cut_lineage(upsert(target.join(touched, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_semi"), source, keys))
    # rebalance: one file or so per partition, but a partition with a large share of the rows is split
    merged.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(base)
    return _stored(spark, base)


def _stored(spark: SparkSession, base: str) -> DataFrame | None:
    """A table whose parts may differ in columns; None where there is none yet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(base)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None


def read_upserted(spark: SparkSession, base: str) -> DataFrame:
    """The newest version of a table kept by ``upsert_table``."""
    return spark.read.parquet(_newest(spark, base.rstrip("/"))[1])


def _newest(spark: SparkSession, base: str):
    try:
        line = spark.read.text(f"{base}/_log").agg(F.max("value").alias("line")).first()["line"]
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return 0, None
    number, path = line.split(" ", 1)
    return int(number), path
