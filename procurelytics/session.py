"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # call-site capture per Column call costs more than building the plan itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores="*", shuffle_partitions=8, memory="8g", app="procurelytics") -> SparkSession:
    """A session for tests and the bench.  On a cluster the caller brings their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of one Arrow batch: texts can be long, so a batch holds at most ``rows`` of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


# application id -> folder, only for sessions whose cluster names none
_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names in
    ``spark.checkpoint.dir``.  Where that is unset and all runs in one process, a temporary
    folder is made, one per application and gone with it; on a cluster, where executors would
    write to their own disks, it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    application = spark.sparkContext.applicationId
    if application not in _FALLBACK:
        _FALLBACK[application] = tempfile.mkdtemp(prefix="procurelytics-")
        atexit.register(shutil.rmtree, _FALLBACK[application], ignore_errors=True)
    return _FALLBACK[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# folders of the tables that ``cut_lineage`` stored since the innermost ``cut_result`` began
_ON_THE_WAY: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def cut_lineage(df):
    """Materialise ``df`` reliably (it survives the loss of executors) and return
    a frame that reads the stored rows.  The rows are deleted when the driver's JVM ends, or, inside
    ``cut_result``, as soon as its result is stored."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    _file_system(spark, path, "deleteOnExit")
    if _ON_THE_WAY.get() is not None:
        _ON_THE_WAY.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_result(spark: SparkSession, make):
    """``cut_lineage`` of the frame that ``make()`` returns.  Tables that it stored on the way are deleted then,
    so no other frame may read them."""
    began = _ON_THE_WAY.set([])
    try:
        found, on_the_way = make(), _ON_THE_WAY.get()
    finally:
        _ON_THE_WAY.reset(began)
    stored = cut_lineage(found)
    for path in on_the_way:
        delete_folder(spark, path)
    return stored


def _file_system(spark: SparkSession, path: str, call: str, *args) -> None:
    """One call of the file system that holds ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    getattr(folder.getFileSystem(spark._jsc.hadoopConfiguration()), call)(folder, *args)


def delete_at_end(spark: SparkSession, *paths: str) -> None:
    """Folders that go when the driver's JVM ends; they must be there already."""
    for path in paths:
        _file_system(spark, path, "deleteOnExit")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, wherever its file system lies."""
    _file_system(spark, path, "delete", True)
