"""Replenishment from sales and stock, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators import demand, replenish
from comanda.params import StockPolicy
from comanda.session import materialise


def stocked_items(days: DataFrame, inventory: DataFrame, supplier: DataFrame, policy: StockPolicy) -> DataFrame:
    """Demand statistics, classes and safety stock per store and sku from the daily sales."""
    stats = demand.demand_stats(days, 28)
    classified = replenish.classify_usage(stats, inventory, policy)
    return replenish.add_safety_stock(classified, supplier, policy)


def automatic_orders(
    sales: DataFrame, inventory: DataFrame, supplier: DataFrame, policy: StockPolicy = StockPolicy()
) -> DataFrame:
    """Orders for all stores and skus. The sales are read once; what follows works on one row per sku and day."""
    days = materialise(demand.sku_days(sales))
    stocked = materialise(stocked_items(days, inventory, supplier, policy))
    horizon = stocked.select("store_id", "sku_id", "last_date", F.col("lead_time_days").alias("days"))
    forecast = demand.forecast_horizon(demand.weekday_quantiles(days), horizon)
    return replenish.build_orders(stocked, forecast, policy)
