"""Demand from order lines and from daily sales: calendars, statistics, weekday quantiles, short forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import ratio, sample_std, weekday
from comanda.params import CLOSED_WEEKDAY, PEAK_WEEKDAYS

ITEM = ("item_id", "item_name", "type", "pairing_tag")


def daily_demand(items: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Units sold per store, day and item."""
    known = items.filter(F.col("item_id").isNotNull() & F.col("date").isNotNull())
    daily = known.groupBy(*keys, "date", *ITEM).agg(F.sum("units").alias("units"))
    return daily.withColumn("weekday", weekday("date"))


def business_days(daily: DataFrame, keys: Sequence[str] = ("store_id",), closed: int = CLOSED_WEEKDAY) -> DataFrame:
    """Days on which the store sold anything, without the closed weekday."""
    return daily.filter(F.col("weekday") != closed).select(*keys, "date", "weekday").distinct()


def day_counts(daily: DataFrame, keys: Sequence[str] = ("store_id",), closed: int = CLOSED_WEEKDAY) -> DataFrame:
    """Business days and peak days per store."""
    days = business_days(daily, keys, closed)
    return days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("business_days"),
        F.count_if(F.col("weekday").isin(*PEAK_WEEKDAYS)).alias("peak_days"),
    )


def dense_demand(daily: DataFrame, keys: Sequence[str] = ("store_id",), closed: int = CLOSED_WEEKDAY) -> DataFrame:
    """Mean and spread of an item's daily units over all business days of its store, days without sales as zero.

    Zeros add nothing to the sum and the sum of squares, so the item x day grid is never built: the totals of the
    days with sales and the number of business days are enough. The same holds for the mean of the peak days.
    """
    units = F.col("units")
    peak = F.when(F.col("weekday").isin(*PEAK_WEEKDAYS), units).otherwise(0)
    sums = (
        daily.filter(F.col("weekday") != closed)
        .groupBy(*keys, "item_id")
        .agg(F.sum(units).alias("total_units"), F.sum(units * units).alias("_sq"), F.sum(peak).alias("_peak"))
    )
    n = F.col("business_days")
    return sums.join(day_counts(daily, keys, closed), list(keys)).select(
        *keys,
        "item_id",
        "total_units",
        ratio("total_units", n).alias("avg_daily"),
        sample_std(F.col("total_units"), F.col("_sq"), n).alias("std_daily"),
        ratio("_peak", "peak_days").alias("peak_daily"),
        "business_days",
    )


def sku_days(sales: DataFrame) -> DataFrame:
    """Sales lines to one row per store, sku and day."""
    known = sales.filter(F.col("sku_id").isNotNull() & F.col("date").isNotNull())
    return known.groupBy("store_id", "sku_id", "date").agg(F.sum("qty_sold").alias("qty_sold"))


def _recent_mean(days: DataFrame, window_days: int):
    """Mean daily sales of a group over the last weeks before the last day of the whole table."""
    last = days.agg(F.max("date")).scalar()
    recent = F.when(F.col("date") > F.date_sub(last, window_days), F.col("qty_sold"))
    return ratio(F.sum(recent), F.count(recent)).alias("rolling_avg_4wk")


def demand_stats(days: DataFrame, window_days: int | None = None) -> DataFrame:
    """Mean, sample spread, total, number and variation of the daily sales, over the days with sales only.

    With `window_days` also the mean of `recent_average`, in the same pass; pass a written table then.
    """
    qty = F.col("qty_sold")
    sums = days.groupBy("store_id", "sku_id").agg(
        F.sum(qty).alias("total_qty"),
        F.sum(qty * qty).alias("_sq"),
        F.count(qty).alias("n_days"),
        F.max("date").alias("last_date"),
        *([_recent_mean(days, window_days)] if window_days else []),
    )
    out = sums.withColumns(
        {
            "demand_avg": ratio("total_qty", "n_days"),
            "demand_std": sample_std(F.col("total_qty"), F.col("_sq"), F.col("n_days")),
        }
    )
    return out.withColumn("cv", F.try_divide("demand_std", "demand_avg")).drop("_sq")


def recent_average(days: DataFrame, window_days: int = 28) -> DataFrame:
    """Mean daily sales over the last weeks before the last day of the whole table; NULL without sales in them.

    `days` is read twice, once for the last day: pass a materialised table.
    """
    return days.groupBy("store_id", "sku_id").agg(_recent_mean(days, window_days))


def weekday_quantiles(days: DataFrame) -> DataFrame:
    """Median and 90th percentile of daily sales per sku and weekday, and over all days where weekday is NULL.

    A group holds at most the days of the calendar, since `days` has one row per sku and day.
    """
    both = F.percentile("qty_sold", F.array(F.lit(0.5), F.lit(0.9)))

    def quantiles(grouped: DataFrame) -> DataFrame:
        return grouped.select(
            "store_id", "sku_id", "weekday", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p90")
        )

    with_day = days.withColumn("weekday", weekday("date"))
    by_day = with_day.groupBy("store_id", "sku_id", "weekday").agg(both.alias("q"))
    overall = days.groupBy("store_id", "sku_id").agg(both.alias("q"))
    overall = overall.withColumn("weekday", F.lit(None).cast("bigint"))
    return quantiles(by_day).unionByName(quantiles(overall))


# Items a sketch keeps per level; with no more days than this a sketch holds all of them. Its normalised rank error is about
# 1.33% at this size.
SKETCH_ITEMS, SKETCH_ERROR = 200, 0.0133


def month_sketches(days: DataFrame, size: int = SKETCH_ITEMS) -> DataFrame:
    """store_id, sku_id, weekday, month, sketch: quantile sketches of daily sales, mergeable, one per month.

    `days` has one row per sku and day. A month's row depends on that month's days alone, so a new month or a corrected
    one costs its own days only: write the table by month and replace the months that changed.
    """
    keyed = days.select("store_id", "sku_id", weekday("date").alias("weekday"), F.trunc("date", "month").alias("month"), F.col("qty_sold").cast("bigint").alias("qty_sold"))
    return keyed.groupBy("store_id", "sku_id", "weekday", "month").agg(F.kll_sketch_agg_bigint("qty_sold", F.lit(size)).alias("sketch"))


def quantiles_of_sketches(sketches: DataFrame, size: int = SKETCH_ITEMS) -> DataFrame:
    """Median and 90th percentile, as `weekday_quantiles` but values that occurred: no interpolation.

    The rank of a returned value is within `SKETCH_ERROR` of the asked one, and exact for up to `size` days.
    """

    def quantiles(grouped: DataFrame) -> DataFrame:
        q = F.kll_sketch_get_quantile_bigint("_s", F.array(F.lit(0.5).cast("double"), F.lit(0.9).cast("double")))
        n = F.kll_sketch_get_n_bigint("_s").alias("n_days")
        return grouped.select("store_id", "sku_id", "weekday", n, q.alias("_q")).select("store_id", "sku_id", "weekday", "n_days", F.col("_q")[0].alias("p50"), F.col("_q")[1].alias("p90"))

    merged = F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("_s")
    by_day = sketches.groupBy("store_id", "sku_id", "weekday").agg(merged)
    overall = sketches.groupBy("store_id", "sku_id").agg(merged).withColumn("weekday", F.lit(None).cast("bigint"))
    return quantiles(by_day).unionByName(quantiles(overall))


def forecast_horizon(quantiles: DataFrame, horizon: DataFrame) -> DataFrame:
    """Sum of the weekday quantiles over the next days of each sku.

    `horizon` has store, sku, the sku's own last date and the days to cover. How often a weekday falls into those
    days follows from the calendar, so the days need not be listed; days on a weekday without sales take the
    overall quantile.
    """
    offset = F.pmod(F.col("weekday") - weekday("last_date") - 1, F.lit(7))
    times = F.when(offset < F.col("days"), F.floor((F.col("days") - 1 - offset) / 7) + 1).otherwise(0)
    joined = quantiles.join(horizon, ["store_id", "sku_id"]).withColumn("times", times.cast("bigint"))
    by_day = F.col("weekday").isNotNull()
    seen = F.sum(F.when(by_day, F.col("times")).otherwise(0))

    def total(q: str):
        listed = F.sum(F.when(by_day, F.col("times") * F.col(q)).otherwise(0.0))
        overall = F.max(F.when(~by_day, F.col(q)))
        return listed + (F.max("days") - seen) * overall

    return joined.groupBy("store_id", "sku_id").agg(
        F.max("days").alias("days"), total("p50").alias("p50"), total("p90").alias("p90")
    )
