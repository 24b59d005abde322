"""Usage variance, alerts, stock cover and waste from a stock count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import const, half_up, ratio
from comanda.params import VARIANCE_THRESHOLD

# Alert levels and the words for stock cover.
LEVEL_LOW, LEVEL_MEDIUM, LEVEL_HIGH = "低", "中", "高"
COVER_RED, COVER_YELLOW, COVER_GREEN = "🔴 不足 1 日", "🟡 不足 3 日", "🟢 充足"


def usage_variance(inventory: DataFrame) -> DataFrame:
    """Actual against theoretical usage, and the cost of the difference. Usage is the base, not what is left."""
    actual = F.col("opening_stock") + F.col("received_qty") - F.col("closing_stock")
    variance = actual - F.col("qty_sold")
    return inventory.withColumns(
        {
            "actual_usage": actual,
            "theoretical_usage": F.col("qty_sold"),
            "variance_qty": variance,
            "variance_ratio": ratio(variance, "qty_sold"),
            "stock_variance_qty": F.col("theoretical_stock") - F.col("closing_stock"),
            "waste_cost": variance * F.col("unit_cost"),
        }
    )


def variance_alerts(df: DataFrame, threshold: str = VARIANCE_THRESHOLD) -> DataFrame:
    """Alert level and reason. Too much used is a loss; too little is a booking error; both are worth a look."""
    variance, usage = F.col("variance_qty"), F.col("theoretical_usage")
    bound = usage * const(threshold)
    percent = half_up(F.abs("variance_ratio") * 100, 1).cast("string")
    limit = f"{float(threshold):.0%}"
    over, under = variance > bound, variance < -bound
    unknown = F.col("variance_ratio").isNull()
    # Wording of the reasons.
    reason = (
        F.when(unknown, "無銷售紀錄,無法判斷")
        .when(over, F.concat(F.lit("實際用量超出理論用量 "), percent, F.lit(f"%,超過 ±{limit} 門檻")))
        .when(under, F.concat(F.lit("實際用量低於理論用量 "), percent, F.lit("% —— 庫存比帳上多,屬**資料登記問題**而非耗損")))
        .otherwise("差異率在正常範圍內")
    )
    level = F.when(~unknown & (over | under), LEVEL_MEDIUM).otherwise(LEVEL_LOW)
    return df.withColumns({"alert_level": level, "alert_reason": reason})


def legacy_false_alarms(df: DataFrame, threshold: str = VARIANCE_THRESHOLD, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Items the old ratio (against what is left in stock) flags, the right one flags, and only the old one flags."""
    legacy = F.coalesce(F.abs("variance_qty_raw") > F.abs("theoretical_stock") * const(threshold), F.lit(False))
    right = F.col("alert_level") != LEVEL_LOW
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(legacy).alias("n_legacy"),
        F.count_if(right).alias("n_usage_based"),
        F.count_if(legacy & ~right).alias("n_false"),
    )


def stockout_risk(df: DataFrame, days: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """How long the stock lasts at the mean daily sales over the store's days with sales.

    `days` has one row per store, sku and day and is read twice: pass a materialised table. Items without sales
    count as covered, flagged as having too little data.
    """
    store_days = days.select(*keys, "date").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days"))
    sold = days.groupBy(*keys, "sku_id").agg(F.sum("qty_sold").alias("qty"))
    daily = sold.join(store_days, list(keys)).select(*keys, "sku_id", ratio("qty", "n_days").alias("avg_daily"))
    out = df.join(daily, [*keys, "sku_id"], "left")
    out = out.withColumn("days_of_cover", half_up(ratio("closing_stock", "avg_daily"), 2))
    cover = F.col("days_of_cover")
    return out.withColumns(
        {
            "stockout_risk": F.when(cover < 1.0, COVER_RED).when(cover < 3.0, COVER_YELLOW).otherwise(COVER_GREEN),
            "insufficient_data": cover.isNull(),
        }
    )


def waste_summary(df: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Waste cost and rate, alerts, items about to run out, items with more stock than the books say."""
    variance = F.col("variance_qty")
    lost_cost = F.when(variance > 0, F.col("waste_cost")).otherwise(F.lit(0))
    lost_units = F.sum(F.greatest(variance, F.lit(0)))
    return df.groupBy(*keys).agg(
        F.sum(lost_cost).alias("waste_cost"),
        half_up(ratio(lost_units, F.sum("theoretical_usage")), 6).alias("waste_rate"),
        F.count_if(F.col("alert_level") == LEVEL_MEDIUM).alias("n_alerts"),
        F.count_if(F.col("stockout_risk") != COVER_GREEN).alias("n_stockout"),
        F.count_if(variance < 0).alias("n_negative"),
    )


def negative_variance(df: DataFrame) -> DataFrame:
    """The items with more stock than the books say, one row each: a matter for the books, not for the staff."""
    return df.filter(F.col("variance_qty") < 0).select("store_id", "sku_id", "variance_qty", "waste_cost")
