"""Where fitted state and intermediate tables live.

Executors can be lost at any time, so nothing is kept only in executor memory or on executor
disks: a table that several jobs read is written once to the folder the cluster shares
(`spark.checkpoint.dir`) and read back from there.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A frame of at most this many rows may be held by the driver and broadcast.
SMALL_ROWS = 20_000


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only when master is local and none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tabloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Stage tables that this process wrote and has not dropped.
_written: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def drop_tables(spark: SparkSession) -> None:
    """Delete the stage tables written so far. Frames and models that still read them can no longer be used."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and gives real file sizes."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str = "state", limit: int = SMALL_ROWS) -> DataFrame:
    """Evaluate a state frame once.

    Up to `limit` rows it becomes a local relation, whose known size lets Spark choose a broadcast
    join under its own threshold. Beyond that it is written to the shared folder and joined by
    shuffle. Either way the result is complete.
    """
    head = df.limit(limit + 1).toArrow()
    if head.num_rows <= limit:
        return df.sparkSession.createDataFrame(head, schema=df.schema)
    return materialize(df, label)
