"""Cutting lineage with a table in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a local master where no shared folder is set; goes with the process.
LOCAL_FOLDER = f"/tmp/checkpoints/run-{os.getpid()}"
atexit.register(shutil.rmtree, LOCAL_FOLDER, ignore_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Without that setting only a local master has one, as its executors are the driver.
    """
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return LOCAL_FOLDER


#: Folders that this process wrote and has not removed.
_written: list[str] = []


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, which remove_stored forgets."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df`, written below the shared folder and reread."""
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_apart(df: DataFrame, purpose: str) -> DataFrame:
    """As `stored`, for rows that joins are to shuffle, whatever their files' size.

    Files of repetitive columns are far smaller than their rows: by their size Spark would send
    such a table whole through the driver, and join it in the few tasks that scan the other.
    """
    return stored(df, purpose).hint("merge")


#: Bucketed tables that this process made and has not dropped.
_named: list[str] = []


def bucketed(df: DataFrame, purpose: str, column: str) -> DataFrame:
    """`df`, written below the shared folder in buckets of `column`, sorted by it, and reread.

    A join on the column leaves the table where it is; there are as many buckets as shuffles
    have partitions, so the other side is dealt to them.
    """
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    name = f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    _named.append(name)
    return spark.table(name)


def remove_stored(spark: SparkSession) -> None:
    """Remove the tables of finished work; what was read from them is no longer usable."""
    while _named:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop()}")
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
