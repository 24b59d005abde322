"""Running totals, ranks and quantiles over whole tables, without putting one group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.session import materialise

# Rows one window task may sort; larger groups are cut into key ranges.
ROWS_PER_TASK = 1_000_000


def _names(by: Sequence[str] | str) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    by: Sequence[str] = (),
    out: str = "running_total",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the running total of `value` in `order` (which must be total) within each group of `by`.

    The table is materialised, so what leads up to it runs once. While the largest group fits one task a plain
    window does it. Beyond that, the rows are range-partitioned by (by, order) into slices of about
    `rows_per_task` rows; each slice is summed, the slice totals are accumulated, and the running total within
    the slice is added to what came before it. A group of any size is spread over as many tasks as it needs.
    """
    by = _names(by)
    df = materialise(df)
    rows = largest = df.count()
    if by and rows > rows_per_task:
        largest = df.groupBy(*by).count().agg(F.max("count")).first()[0]
    to_here = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    if largest <= rows_per_task:
        return df.withColumn(out, F.sum(value).over(to_here))

    slices = -(-rows // rows_per_task)
    sliced = materialise(
        df.repartitionByRange(slices, *[F.col(c) for c in by], *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    before = W.partitionBy(*by).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*by, "_slice")
        .agg(F.sum(value).alias("_slice_total"))
        .withColumn("_before", F.sum("_slice_total").over(before))
        .drop("_slice_total")
    )
    within = W.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        sliced.withColumn("_within", F.sum(value).over(within))
        .join(offsets, [*by, "_slice"])
        .withColumn(out, F.col("_within") + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_slice", "_within", "_before")
    )


def share_of_total(df: DataFrame, shares: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """For each `out: value` add the group total of `value` as `<out>_total`.

    The totals are a small aggregate joined back, not a window, so a group is never gathered in one task.
    """
    by = _names(by)
    totals = [F.sum(value).alias(f"{out}_total") for out, value in shares.items()]
    if not by:
        for out, value in shares.items():
            df = df.withColumn(f"{out}_total", df.agg(F.sum(value)).scalar())
        return df
    return df.join(df.groupBy(*by).agg(*totals), by)


def average_rank_pct(
    df: DataFrame, value: str, out: str, by: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add the share rank of `value` with ties given their average rank (largest value = 1).

    Ranks come from the counts per distinct value, so rows with equal values never gather in one task.
    """
    by = _names(by)
    df = df.filter(F.col(value).isNotNull())
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = running_total(counts, "_ties", [F.col(value)], by, "_upto", rows_per_task)
    totals = ranked.groupBy(*by).agg(F.sum("_ties").alias("_n"))
    ranked = ranked.join(totals, by) if by else ranked.withColumn("_n", totals.scalar())
    pct = (F.col("_upto") * 2 - F.col("_ties") + 1).cast("double") / (F.col("_n") * 2)
    return df.join(ranked.select(*by, value, pct.alias(out)), [*by, value])


def exact_quantile(df: DataFrame, value: str, q: float, rows_per_task: int = ROWS_PER_TASK, by: Sequence[str] = ()) -> DataFrame:
    """Column `quantile`: the linearly interpolated q-quantile of `value`, one row, or one per group of `by`."""
    by = _names(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = running_total(counts, "_ties", [F.col(value)], by, "_upto", rows_per_task=rows_per_task)
    totals = ranked.groupBy(*by).agg(F.sum("_ties").alias("_n"))
    ranked = ranked.join(totals, by) if by else ranked.withColumn("_n", totals.scalar())
    ranked = ranked.withColumn("_place", (F.col("_n") - 1) * F.lit(q))
    low = F.min(F.when(F.col("_upto") > F.floor("_place"), F.col(value)))
    high = F.min(F.when(F.col("_upto") > F.ceil("_place"), F.col(value)))
    part = F.max(F.col("_place") - F.floor("_place"))
    return ranked.groupBy(*by).agg((low + (high - low) * part).alias("quantile"))
