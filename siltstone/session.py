"""Session-level helpers: shared folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A side of counted rows is broadcast up to this many.
BROADCAST_MAX_ROWS = 100_000

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="siltstone-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/siltstone/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage beyond the files, so it survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that was made below the shared folder."""
    inner = f"{shared_folder(spark)}/siltstone/"
    if not path.startswith(inner) or path == inner:
        raise ValueError(f"{path} isn't below {inner}")
    delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of a file system that Spark reaches; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
