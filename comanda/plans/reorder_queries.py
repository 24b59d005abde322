"""Demand and replenishment over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from comanda.functions.exprs import half_up
from comanda.operators import demand, replenish
from comanda.params import ENGLISH_TYPES, SERVICE_LEVEL_Z, SHELF_LIFE_BY_CATEGORY, SUPPLIER_DEFAULTS, StockPolicy, in_english
from comanda.plans import reorder
from comanda.plans.queries import query
from comanda.session import materialise, new_folder
from comanda.sources import binding, incremental

# The bound demand varies more evenly than a kitchen's; this cut uses all three classes.
POLICY = StockPolicy(y_upto="0.6")
FRIDAY = 4


def daily(spark, sf_dir):
    return demand.daily_demand(binding.order_items(spark, sf_dir))


def profile(spark, sf_dir):
    days = materialise(daily(spark, sf_dir))
    return replenish.demand_profile(days, binding.menu(spark, sf_dir), ENGLISH_TYPES)


def advice(spark, sf_dir):
    items = materialise(profile(spark, sf_dir))
    return replenish.reorder_advice(items, binding.on_hand(items), FRIDAY)


@query("daily_demand")
def daily_demand(spark, sf_dir):
    return daily(spark, sf_dir).drop("item_name")


@query("business_days")
def business_days(spark, sf_dir):
    return demand.business_days(daily(spark, sf_dir))


@query("dense_demand_stats")
def dense_demand_stats(spark, sf_dir):
    stats = demand.dense_demand(materialise(daily(spark, sf_dir))).drop("peak_daily")
    return stats.withColumns({c: half_up(c, 6) for c in ("avg_daily", "std_daily")})


@query("peak_demand")
def peak_demand(spark, sf_dir):
    stats = demand.dense_demand(materialise(daily(spark, sf_dir)))
    return stats.select("store_id", "item_id", half_up("peak_daily", 6).alias("peak_daily"))


@query("abc_profit")
def abc_profit(spark, sf_dir):
    return profile(spark, sf_dir).select(
        "store_id", "item_id", "total_units", "unit_profit", "total_profit", "cum_profit_share", "abc"
    )


@query("item_policy")
def item_policy(spark, sf_dir):
    items = replenish.item_policy(binding.menu(spark, sf_dir), ENGLISH_TYPES)
    return items.select("item_id", "type", "pairing_tag", "shelf_life", "lead_time")


@query("demand_profile")
def demand_profile(spark, sf_dir):
    rounded = {c: half_up(c, 6) for c in ("avg_daily", "std_daily", "peak_daily")}
    return profile(spark, sf_dir).drop("item_name").withColumns(rounded)


@query("safety_stock_a")
def safety_stock_a(spark, sf_dir):
    z = replenish.service_z(replenish.lookup("abc", replenish.ProfitPolicy().service_level))
    stock = replenish.safety_stock(F.col("std_daily"), F.col("lead_time"), z)
    return profile(spark, sf_dir).select("store_id", "item_id", z.alias("z"), half_up(stock, 4).alias("safety_stock"))


@query("reorder_advice")
def reorder_advice(spark, sf_dir):
    return advice(spark, sf_dir).drop("item_name")


@query("spoilage_risk")
def spoilage_risk(spark, sf_dir):
    return replenish.spoilage_risk(materialise(advice(spark, sf_dir)))


@query("abc_summary")
def abc_summary(spark, sf_dir):
    return replenish.abc_summary(profile(spark, sf_dir))


@query("advice_summary")
def advice_summary(spark, sf_dir):
    return replenish.advice_summary(advice(spark, sf_dir))


def supplier(spark, sf_dir):
    return replenish.supplier_master(
        binding.sku_inventory(spark, sf_dir), in_english(SUPPLIER_DEFAULTS), in_english(SHELF_LIFE_BY_CATEGORY)
    )


def days(spark, sf_dir):
    return demand.sku_days(binding.sku_sales(spark, sf_dir))


def stocked(spark, sf_dir):
    return reorder.stocked_items(
        materialise(days(spark, sf_dir)), binding.sku_inventory(spark, sf_dir), supplier(spark, sf_dir), POLICY
    )


def orders(spark, sf_dir):
    return reorder.automatic_orders(
        binding.sku_sales(spark, sf_dir), binding.sku_inventory(spark, sf_dir), supplier(spark, sf_dir), POLICY
    )


@query("supplier_master")
def supplier_master(spark, sf_dir):
    return supplier(spark, sf_dir)


@query("demand_stats")
def demand_stats(spark, sf_dir):
    stats = demand.demand_stats(days(spark, sf_dir))
    return stats.withColumns({c: half_up(c, 6) for c in ("demand_avg", "demand_std", "cv")})


@query("rolling_avg_4wk")
def rolling_avg_4wk(spark, sf_dir):
    recent = demand.recent_average(materialise(days(spark, sf_dir)))
    return recent.withColumn("rolling_avg_4wk", half_up("rolling_avg_4wk", 6))


@query("weekday_quantiles")
def weekday_quantiles(spark, sf_dir):
    quantiles = demand.weekday_quantiles(materialise(days(spark, sf_dir)))
    return quantiles.select(
        "store_id",
        "sku_id",
        F.coalesce("weekday", F.lit(-1)).alias("weekday"),
        half_up("p50", 4).alias("p50"),
        half_up("p90", 4).alias("p90"),
    )


@query("forecast_horizon")
def forecast_horizon(spark, sf_dir):
    by_day = materialise(days(spark, sf_dir))
    lead = F.greatest(F.bround("lead_time_days_avg", 0).cast("bigint"), F.lit(1)).alias("days")
    last = by_day.groupBy("store_id", "sku_id").agg(F.max("date").alias("last_date"))
    horizon = last.join(supplier(spark, sf_dir).select("store_id", "sku_id", lead), ["store_id", "sku_id"])
    forecast = demand.forecast_horizon(demand.weekday_quantiles(by_day), horizon)
    return forecast.withColumns({"p50": half_up("p50", 4), "p90": half_up("p90", 4)})


@query("abc_usage")
def abc_usage(spark, sf_dir):
    stats = demand.demand_stats(days(spark, sf_dir))
    classified = replenish.classify_usage(stats, binding.sku_inventory(spark, sf_dir), POLICY)
    return classified.select("store_id", "sku_id", "usage_value", "cum_value_pct", "abc_class")


@query("xyz_class")
def xyz_class(spark, sf_dir):
    classified = replenish.xyz_class(demand.demand_stats(days(spark, sf_dir)), POLICY)
    return classified.select("store_id", "sku_id", half_up("cv", 6).alias("cv"), "xyz_class", "insufficient_data")


@query("abc_xyz_matrix")
def abc_xyz_matrix(spark, sf_dir):
    stats = demand.demand_stats(days(spark, sf_dir))
    return replenish.abc_xyz_matrix(replenish.classify_usage(stats, binding.sku_inventory(spark, sf_dir), POLICY))


@query("service_z")
def service_z(spark, sf_dir):
    key = F.col("p_partkey")
    level = (key % 16 + 85).cast("double") / F.lit(100.0)
    rows = binding.parts(spark, sf_dir).select("p_partkey", level.alias("service_level"))
    return rows.withColumn("z", half_up(replenish.service_z(F.col("service_level")), 6))


# Break points of the stores: those of the policy, and for every second store others.
OTHER_LEVELS = {0.85: 1.04, 0.92: 1.41, 0.96: 1.75, 0.995: 2.58}


@query("service_z_table")
def service_z_table(spark, sf_dir):
    key = F.col("p_partkey")
    level = (key % 16 + 85).cast("double") / F.lit(100.0)
    rows = binding.parts(spark, sf_dir).select("p_partkey", F.concat(F.lit("ST"), (key % 10).cast("string")).alias("store_id"), level.alias("service_level"))
    tables = [(f"ST{s}", float(x), float(z)) for s in range(10) for x, z in (SERVICE_LEVEL_Z if s % 2 == 0 else OTHER_LEVELS).items()]
    points = spark.createDataFrame(tables, "store_id STRING, level DOUBLE, z DOUBLE")
    return replenish.service_z_by(rows, points).withColumn("z", half_up("z", 6))


@query("weekday_quantiles_sketch")
def weekday_quantiles_sketch(spark, sf_dir):
    """Months are sketched one by one and merged; few enough days per weekday are kept whole."""
    sketches = materialise(demand.month_sketches(days(spark, sf_dir)))
    found = demand.quantiles_of_sketches(sketches)
    return found.select("store_id", "sku_id", F.coalesce("weekday", F.lit(-1)).alias("weekday"), "n_days", "p50", "p90")


@query("daily_by_increments")
def daily_by_increments(spark, sf_dir):
    """Days kept up by increments: fulfilled lines first, the others late, the second increment twice."""
    lines = binding.sku_sales_with_status(spark, sf_dir)
    folder = new_folder(spark, "daily")
    store = incremental.DailyStore(spark, f"{folder}/lines", f"{folder}/days")
    store.add(lines.filter("status = 'F'").drop("status"), "first")
    for _ in range(2):
        store.add(lines.filter("status <> 'F'").drop("status"), "second")
    return store.days().select("store_id", "sku_id", "date", "qty_sold")


@query("safety_stock_b")
def safety_stock_b(spark, sf_dir):
    return stocked(spark, sf_dir).select(
        "store_id", "sku_id", "abc_class", "service_level", "z", "safety_stock_qty", "review_cycle_days", "lead_time_days"
    )


@query("ss_orders")
def ss_orders(spark, sf_dir):
    return orders(spark, sf_dir).drop("exception_flag", "exception_reason", "data_gap_flag", "insufficient_data")


@query("order_exceptions")
def order_exceptions(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "store_id", "sku_id", "recommended_order_qty", "exception_flag", "exception_reason", "data_gap_flag"
    )


@query("order_summary")
def order_summary(spark, sf_dir):
    return replenish.order_summary(orders(spark, sf_dir))
