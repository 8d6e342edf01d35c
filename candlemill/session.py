"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str, hive: bool = False, **conf: str) -> SparkSession:
    """A UTC, ANSI, adaptive session; keywords use ``__`` for the dots of a key.

    Cluster sizing (shuffle partitions, executor memory, checkpoint folder)
    stays with ``spark-submit``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording the Python line of every column call costs more than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Streams keep their state on disk instead of in the heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All time columns are read and written in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        current = tempfile.mkdtemp(prefix="candlemill-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name for this application under the checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/candlemill-{application}"


def _folder(spark: SparkSession, name: str):
    """A folder of any file system Hadoop knows, and that file system."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, name: str) -> bool:
    path, files = _folder(spark, name)
    return files.exists(path)


def folder_names(spark: SparkSession, name: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    path, files = _folder(spark, name)
    if not files.exists(path):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(path))


def drop_folder(spark: SparkSession, name: str) -> None:
    path, files = _folder(spark, name)
    files.delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to its scratch folder.

    Frames that were pinned cannot be read afterwards.
    """
    path, files = _folder(spark, _scratch_root(spark))
    files.delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the table.

    Every later use sees the same rows, also after an executor is lost. Unlike
    a checkpoint the table is columnar, and Spark knows its size.
    """
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
