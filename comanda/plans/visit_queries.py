"""Sheets, visit rollup and key figures over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators import kpi, visits
from comanda.params import ENGLISH_TYPES
from comanda.plans.queries import query
from comanda.sources import binding, sheets

# Stay of the bound visits runs over a whole day.
BOUND_DURATION_BINS = (0, 60, 240, 480, 720, 1440)


@query("norm_sales")
def norm_sales(spark, sf_dir):
    items = binding.order_items(spark, sf_dir)
    raw = items.select(
        F.date_format("date", "yyyy-MM-dd").alias("日期"),
        F.col("item_id").alias("品項"),
        F.col("type").alias("分類"),
        F.col("units").alias("數量"),
        F.round(F.col("price") / F.col("units"), 2).alias("單價(元)"),
        F.col("price").alias("小計(元)"),
        "store_id",
    )
    return sheets.normalise_sales(raw, F.col("store_id"))


@query("norm_inventory")
def norm_inventory(spark, sf_dir):
    back = {name: heading for heading, name in sheets.INVENTORY_HEADINGS.items()}
    raw = binding.inventory(spark, sf_dir).drop("on_order_qty").withColumnsRenamed(back)
    return sheets.normalise_inventory(raw, F.col("store_id")).withColumn(
        "variance_ratio_legacy", F.round(F.col("variance_ratio_legacy"), 9)
    )


@query("cost_lines")
def cost_lines(spark, sf_dir):
    return sheets.cost_lines(binding.cost_sheet(spark, sf_dir), ("period",))


@query("cost_summary_wide")
def cost_summary_wide(spark, sf_dir):
    lines = sheets.cost_lines(binding.cost_sheet(spark, sf_dir), ("period",))
    return sheets.cost_summary(lines, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ("period",))


@query("visit_rollup")
def visit_rollup(spark, sf_dir):
    lines, heads = binding.order_lines(spark, sf_dir), binding.order_heads(spark, sf_dir)
    return visits.visit_rollup(lines, heads, ENGLISH_TYPES)


@query("line_profit")
def line_profit(spark, sf_dir):
    lines = binding.order_lines(spark, sf_dir).drop("profit_margin", "profit")
    return visits.line_profit(lines, binding.menu(spark, sf_dir)).select(
        "visit_id", "item_id", "units", "price", "profit"
    )


def items_with_profit(spark, sf_dir):
    return visits.line_profit(binding.order_lines(spark, sf_dir))


@query("kpi_summary")
def kpi_summary(spark, sf_dir):
    return kpi.kpi_summary(binding.visits(spark, sf_dir))


def by_store(visits: DataFrame) -> DataFrame:
    """The bound visits with a store, by the last digit of the customer."""
    return visits.withColumn("store_id", F.concat(F.lit("ST"), (F.col("customer_id") % 10).cast("string")))


@query("kpi_by_store")
def kpi_by_store(spark, sf_dir):
    return kpi.kpi_summary(by_store(binding.visits(spark, sf_dir)), ["store_id"])


@query("weak_hours_by_store")
def weak_hours_by_store(spark, sf_dir):
    return kpi.weak_hours(by_store(binding.visits(spark, sf_dir)), min_visits=1, keys=["store_id"])


@query("hidden_gems_by_store")
def hidden_gems_by_store(spark, sf_dir):
    return kpi.hidden_gems(items_with_profit(spark, sf_dir), keys=["store_id"])


@query("profit_structure")
def profit_structure(spark, sf_dir):
    return kpi.profit_structure(items_with_profit(spark, sf_dir), ENGLISH_TYPES)


@query("visits_by_hour")
def visits_by_hour(spark, sf_dir):
    return kpi.visits_by_hour(binding.visits(spark, sf_dir))


@query("revenue_by_weekday")
def revenue_by_weekday(spark, sf_dir):
    return kpi.revenue_by_weekday(binding.visits(spark, sf_dir))


@query("drink_ratio_hist")
def drink_ratio_hist(spark, sf_dir):
    return kpi.drink_ratio_histogram(binding.visits(spark, sf_dir))


@query("drink_ratio_kde")
def drink_ratio_kde(spark, sf_dir):
    return kpi.drink_ratio_density(binding.visits(spark, sf_dir))


@query("duration_vs_drinks")
def duration_vs_drinks(spark, sf_dir):
    return kpi.duration_vs_drinks(binding.visits(spark, sf_dir), BOUND_DURATION_BINS)


@query("top_items_profit")
def top_items_profit(spark, sf_dir):
    return kpi.top_items(items_with_profit(spark, sf_dir), 15)


@query("drink_ratio_by_hour")
def drink_ratio_by_hour(spark, sf_dir):
    return kpi.drink_ratio_by_hour(binding.visits(spark, sf_dir))


@query("weak_hours")
def weak_hours(spark, sf_dir):
    return kpi.weak_hours(binding.visits(spark, sf_dir))


@query("zero_drink_visits")
def zero_drink_visits(spark, sf_dir):
    return kpi.zero_drink_visits(binding.visits(spark, sf_dir))


@query("weekend_split")
def weekend_split(spark, sf_dir):
    return kpi.weekend_split(binding.visits(spark, sf_dir))


@query("hidden_gems")
def hidden_gems(spark, sf_dir):
    return kpi.hidden_gems(items_with_profit(spark, sf_dir))


@query("buzz_split")
def buzz_split(spark, sf_dir):
    return kpi.buzz_split(binding.visits(spark, sf_dir))
