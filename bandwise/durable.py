"""Intermediate tables kept in the folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


_local_folder: list[str] = []
_written: list[str] = []


def durable_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only for a local master that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="bandwise-"))
        atexit.register(shutil.rmtree, _local_folder[0], ignore_errors=True)
    return _local_folder[0]


def durable_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, which ``release`` deletes."""
    path = f"{durable_dir(spark).rstrip('/')}/bandwise-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def durable(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, and continue from the written table.

    Cuts the lineage, survives lost executors, and gives the optimiser true sizes.
    """
    spark = df.sparkSession
    path = durable_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark deletes the shuffle files of a query as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable_alone(df: DataFrame, label: str, **options: str) -> DataFrame:
    """As ``durable``, without the shuffle files that writing needed, which else stay until the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return durable(df, label, **options)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``durable`` that nothing reads any more."""
    folders = {file.rsplit("/", 2)[-2] for table in tables for file in table.inputFiles()}
    release([path for path in written_tables() if path.rsplit("/", 1)[-1] in folders])


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a written table whose counted ``rows`` are few; plain shuffle join beyond."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def written_tables() -> list[str]:
    """Paths of the intermediate tables of this process that are not released yet."""
    return list(_written)


def release(paths: list[str] | None = None) -> None:
    """Delete intermediate tables, by default all of this process.

    Call it once the results that read them are computed or stored.
    """
    for path in written_tables() if paths is None else paths:
        spark = SparkSession.active()
        # Through Hadoop's file systems, as Spark wrote it: any scheme, or none.
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        _written.remove(path)
