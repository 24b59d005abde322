"""Reading point-of-sale tables and writing result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A table with a declared schema. CSV files have a header line and may start with a byte-order mark."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("encoding", "UTF-8").option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Write a result table, split by store or date columns where given. CSV gets a header line.

    Rows of a store or date are brought together first, large ones in several parts, so that files are few.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write `df` in place of the partitions it has rows for; all others stay. Running it again changes nothing."""
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").format("parquet")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
