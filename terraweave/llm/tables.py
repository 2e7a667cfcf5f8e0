"""Reading the input tables and cutting lineage in storage all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder (tests and local runs); such a
#: run's tables go with its process.
LOCAL_CHECKPOINTS = f"/tmp/checkpoints/run-{os.getpid()}"
atexit.register(shutil.rmtree, LOCAL_CHECKPOINTS, ignore_errors=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data folder, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Without that setting only a local master has one, as its executors are the driver.
    """
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return LOCAL_CHECKPOINTS


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_table(df: DataFrame) -> None:
    """Remove the folder of a table from `stored` that nothing reads any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    The written table replaces the lineage: executors lost later cost a re-read,
    not a recomputation. Spark's commit protocol makes task retries safe.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many partitions as there are cores, where its scan has fewer.

    One fat file of one row group is one partition; its rows are then dealt out in
    turn. A table of enough files is read where it lies.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Ids that are broadcast at most (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000


def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of `df` whose `column` is not among the distinct `ids` (column); nulls stay.

    The ids are written and counted first, so rows need not move where few go.
    """
    gone = stored(ids, "gone")
    few = gone.count() <= BROADCAST_IDS
    return df.join(F.broadcast(gone) if few else gone, column, "left_anti").select(*df.columns)
