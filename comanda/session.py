"""Session settings and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only after its rows were counted, and its size taken, and both found below these bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


def build_session(app_name: str = "comanda", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for; extra settings as keyword arguments."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small intermediate tables keep all cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints.

    Taken from the session; only a local session without one gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="comanda-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for written tables and stream state."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and go on from the written table.

    Cuts the lineage, so what leads up to it runs once and a lost executor costs nothing that was done before.
    Parquet keeps column pruning and gives the planner the true size.
    """
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the written table has at most `max_rows` rows and `max_bytes` bytes, else the table as it is.

    The bytes are the planner's size of the columns read. Counting a written table reads its file footers only.
    Beyond the bounds the join stays a shuffle join, which AQE may still split on skew.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= max_bytes and df.count() <= max_rows else df
