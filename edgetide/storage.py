"""Intermediate tables in the folder all executors share.

Iterations cut their lineage with ``checkpoint()`` or with a Parquet table in the folder
named by ``spark.checkpoint.dir``, so that a lost executor costs a re-read, not a rerun.
"""

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


# Scratch tables not dropped yet; whoever ends a piece of work calls ``drop_all``.
_left: list[str] = []


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """For a session in this one process and without a setting; gone when the process ends."""
    folder = tempfile.mkdtemp(prefix="edgetide-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which all executors reach.

    Only where it is unset and master and executors are one process (``local``, ``local[n]``) is a
    folder made; any cluster, a local one too, has to name its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = _own_folder()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; ``drop_scratch`` or ``drop_all`` deletes what is there."""
    path = f"{shared_folder(spark)}/edgetide-{label}-{uuid.uuid4().hex}"
    _left.append(path)
    return path


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a scratch table; returns the table read back, and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def checkpoint(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, system = _located(spark, path)
    system.delete(target, True)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` completely."""
    target, system = _located(spark, f"{path}/_SUCCESS")
    return system.exists(target)


def named(spark: SparkSession, folder: str, name: str, mark: str) -> list[str]:
    """The values of the folders ``name=value`` under ``folder`` that hold ``mark``, in order."""
    target, system = _located(spark, f"{folder}/{name}=*/{mark}")
    found = system.globStatus(target) or []
    start = target.depth() - len(mark.split("/")) - 1
    parts = (status.getPath().toUri().getPath().split("/")[1:] for status in found)
    return sorted(part[start].split("=", 1)[1] for part in parts)


def numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers of the completely written tables ``name=number`` under ``folder``."""
    return sorted(int(value) for value in named(spark, folder, name, "_SUCCESS"))


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table written by ``store``."""
    if path.rsplit("/", 1)[-1].startswith("edgetide-"):
        delete(spark, path)
        if path in _left:
            _left.remove(path)


def drop_all(spark: SparkSession) -> None:
    """Delete every scratch table made so far; results that read one must have been used."""
    for path in list(_left):
        drop_scratch(spark, path)
