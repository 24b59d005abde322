"""Daily sales kept up by increments: late lines re-aggregate their own months only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators.demand import sku_days
from comanda.session import broadcast_if_small, materialise
from comanda.sources.tables import replace_partitions

LINES = "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT, month DATE, increment STRING"
DAYS = "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT, month DATE"


class DailyStore:
    """Sales lines by month and increment, and one row per store, sku and day by month, as written tables.

    An increment has a name. Adding it again replaces what it brought before, so a load that failed half-way is run
    again; a line that comes late only touches its month.
    """

    def __init__(self, spark: SparkSession, lines_path: str, days_path: str) -> None:
        self.spark, self.lines_path, self.days_path = spark, lines_path, days_path

    def lines(self) -> DataFrame:
        return self.spark.read.schema(LINES).parquet(self.lines_path)

    def days(self) -> DataFrame:
        return self.spark.read.schema(DAYS).parquet(self.days_path)

    def add(self, lines: DataFrame, increment: str) -> DataFrame:
        """Add sales lines (store_id, sku_id, date, qty_sold) and bring the days of their months up to date.

        Returns the months that were touched. Lines without a date are left out. An increment that is added again must
        hold lines for the months it had before; a month it no longer has keeps its old lines.
        """
        dated = lines.filter("date is not null").select("store_id", "sku_id", "date", F.col("qty_sold").cast("bigint").alias("qty_sold"))
        dated = dated.withColumns({"month": F.trunc("date", "month"), "increment": F.lit(increment)})
        new = materialise(dated)
        months = materialise(new.select("month").distinct())
        replace_partitions(new, self.lines_path, ["month", "increment"])
        # the join on the partition column prunes the scan to the months that changed
        touched = self.lines().join(broadcast_if_small(months), "month", "left_semi")
        replace_partitions(sku_days(touched).withColumn("month", F.trunc("date", "month")), self.days_path, ["month"])
        return months
