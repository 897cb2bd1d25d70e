"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset a temporary folder is made and set, but only on one machine:
    executors of a cluster would each write to a disk of their own.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_MADE: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    _MADE.append(f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear(spark: SparkSession) -> None:
    """Delete all that this process wrote to the shared folder. For the caller, once no result is read any more."""
    conf = spark._jsc.hadoopConfiguration()
    while _MADE:
        p = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        p.getFileSystem(conf).delete(p, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: lineage ends, and a lost executor costs no earlier stage."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def state(spark: SparkSession, path: str) -> tuple:
    """What tells one content of a table's path from another: its files' names, sizes and times."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return ()
    files = [fs.getFileStatus(p)] if fs.getFileStatus(p).isFile() else fs.listStatus(p)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
