"""Tables that a job writes on its way, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for written tables, in the folder that spark.checkpoint.dir names.

    Where that is unset, local mode takes a temporary folder; a cluster has none that all its machines share, so there it is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-shared-"))
    return f"{sc.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder that shared_dir named, once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder, so that lost executors cost no re-run of what led to them."""
    shared_dir(df.sparkSession, "unused")
    return df.checkpoint()


def dealt(df: DataFrame) -> DataFrame:
    """A scan as its files lie; only a table so small that it has fewer splits than there are cores is dealt to all of them."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The rows of a scan dealt out to all cores, about `rows` to a task: for what grows by far on its way, where few row groups would be few tasks."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(n, -(-df.count() // rows)))
