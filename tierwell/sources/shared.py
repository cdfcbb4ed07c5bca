"""The folder all executors can reach, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the session names.  Only a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierwell-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder of any file system Spark reaches; nothing if there is none."""
    system, at = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder has exactly this name, glob characters included."""
    system, at = _folder(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    system, at = _folder(spark, path)
    system.delete(at, True)


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back, for frames with several readers; or
    below a ``folder`` of the caller's, who may then remove all it holds."""
    path = f"{folder}/{label}" if folder else fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
