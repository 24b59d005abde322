"""Item lines to visits: line profit and the visit rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import half_up, is_weekend, weekday
from comanda.params import BUZZ_HOUR, MenuTypes


def line_profit(items: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    """Profit per line, price x margin, rounded to one decimal. The margin comes from `menu` if the lines lack it."""
    if menu is not None:
        items = items.join(menu.select("item_id", "profit_margin"), "item_id")
    return items.withColumn("profit", F.round(F.col("price") * F.col("profit_margin"), 1))


def visit_rollup(items: DataFrame, heads: DataFrame, types: MenuTypes = MenuTypes()) -> DataFrame:
    """One row per visit from its lines and its head (customer, date, hour, party size, duration, repeat flag).

    Lines are summed before the join, so the head meets one row per visit. Heads without lines are left out.
    """
    drink = F.col("type") == types.drinks
    price, profit = F.col("price"), F.col("price") * F.col("profit_margin")
    zero = F.lit(0).cast("decimal(1,0)")
    sums = (
        items.filter(F.col("visit_id").isNotNull())
        .groupBy("visit_id")
        .agg(
            F.sum("units").alias("n_items"),
            F.sum(F.when(drink, F.col("units")).otherwise(0)).alias("n_drink"),
            F.sum(F.when(drink, price).otherwise(zero)).alias("drink"),
            F.sum(price).alias("total"),
            F.sum(profit).alias("profit"),
        )
    )
    ratio = F.coalesce(F.try_divide(F.col("drink").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    per_head = F.try_divide(F.col("total").cast("double"), F.col("party_size").cast("double"))
    money = "decimal(18,1)"
    return sums.join(heads, "visit_id").select(
        "visit_id",
        "customer_id",
        "date",
        weekday("date").alias("weekday"),
        is_weekend("date").alias("is_weekend"),
        "arrival_hour",
        (F.col("arrival_hour") >= BUZZ_HOUR).cast("bigint").alias("is_buzz_hour"),
        "party_size",
        "duration_min",
        "is_repeat",
        "n_items",
        (F.col("n_items") - F.col("n_drink")).alias("n_food"),
        "n_drink",
        F.round(F.col("total") - F.col("drink"), 1).cast(money).alias("food_revenue"),
        F.round("drink", 1).cast(money).alias("drink_revenue"),
        F.round("total", 1).cast(money).alias("total_revenue"),
        F.round("profit", 1).cast(money).alias("total_profit"),
        half_up(ratio, 4).cast("decimal(9,4)").alias("drink_ratio"),
        half_up(per_head, 1).cast(money).alias("spend_per_head"),
    )
