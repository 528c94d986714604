"""Cutting the lineage of loops, so that plans stay small and a lost executor costs one step."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """`df` computed and written to the session's checkpoint folder (spark.checkpoint.dir).

    Where a local session has none (tests), a temporary folder is set; a cluster session must name a shared one.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="annalist-"))
    return df.checkpoint()


def folder(spark) -> str:
    """A new folder for files of one run, under the session's checkpoint folder; it goes when the driver ends."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="annalist-")
    out = f"{root.rstrip('/')}/files-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{out}/data"


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """`df` dealt out to every core by the columns, for a few rows that much work follows on.

    Spark sizes partitions by bytes, and would leave a small table that grows in an explode or a Python stage in one task.
    A hash of the columns is dealt by, as a partitioning by the columns that is there already would be taken instead.
    """
    return df.repartition(cores(df), F.xxhash64(*columns))


def cores(df: DataFrame) -> int:
    """Partitions that give every core some: the session's, or its cores if those are more."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of input files for one more partition of `parts_of`.
BYTES_A_PART = 4 << 20


def parts_of(*dfs: DataFrame) -> int:
    """Partitions that grow with the files read, so that the memory of one task does not; never fewer than the session's."""
    size = 0
    for df in dfs:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        size += sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return min(max(cores(dfs[0]), size // BYTES_A_PART), 20_000)
