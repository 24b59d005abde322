"""Costs, suppliers and stock counts over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from comanda.functions.exprs import half_up
from comanda.operators import anomaly, cost, demand, forest, stocktake
from comanda.params import ENGLISH_COST_BANDS
from comanda.plans.queries import query
from comanda.session import materialise
from comanda.sources import binding

ITEM = ("store_id", "sku_id")


def variance(spark, sf_dir):
    return stocktake.variance_alerts(stocktake.usage_variance(binding.inventory(spark, sf_dir)))


def with_cover(spark, sf_dir):
    """Stock levels of the bound tables last for years; the remainder by 11 gives days."""
    counted = variance(spark, sf_dir).withColumn("closing_stock", F.col("closing_stock") % 11)
    days = materialise(demand.sku_days(binding.store_sales(spark, sf_dir)))
    return stocktake.stockout_risk(counted, days)


@query("cost_structure")
def cost_structure(spark, sf_dir):
    sheet = materialise(binding.monthly_costs(binding.inventory(spark, sf_dir)))
    revenue = sheet.groupBy("store_id").agg(F.max("revenue").alias("revenue"))
    return cost.cost_structure(sheet, revenue, ENGLISH_COST_BANDS)


@query("cost_recon_items")
def cost_recon_items(spark, sf_dir):
    items = cost.reconcile_items(binding.inventory(spark, sf_dir))
    return items.select(
        *ITEM, "theoretical_cost", "purchase_cost", "stock_change_qty", "stock_change_cost", "waste_qty", "waste_cost"
    )


@query("cost_recon_totals")
def cost_recon_totals(spark, sf_dir):
    return cost.reconcile_totals(cost.reconcile_items(binding.inventory(spark, sf_dir)))


@query("item_margin")
def item_margin(spark, sf_dir):
    return cost.item_margin(binding.inventory(spark, sf_dir)).select(
        *ITEM, "unit_margin", "margin_rate", "revenue", "total_margin", "cost_share", "margin_share", "eats_margin"
    )


@query("supplier_metrics")
def supplier_metrics(spark, sf_dir):
    return cost.supplier_metrics(binding.receipts(spark, sf_dir))


@query("supplier_score")
def supplier_score(spark, sf_dir):
    known = cost.supplier_metrics(binding.receipts(spark, sf_dir)).withColumn(
        "price_competitiveness", F.when(F.col("supplier_id") % 3 != 0, F.col("price_competitiveness"))
    )
    return cost.score_suppliers(binding.supplier_terms(spark, sf_dir), known)


@query("usage_variance")
def usage_variance(spark, sf_dir):
    rows = stocktake.usage_variance(binding.inventory(spark, sf_dir))
    return rows.select(
        *ITEM,
        "actual_usage",
        "theoretical_usage",
        "variance_qty",
        half_up("variance_ratio", 6).alias("variance_ratio"),
        "stock_variance_qty",
        "waste_cost",
    )


@query("variance_alerts")
def variance_alerts(spark, sf_dir):
    return variance(spark, sf_dir).select(*ITEM, "alert_level", "alert_reason")


@query("legacy_false_alarms")
def legacy_false_alarms(spark, sf_dir):
    return stocktake.legacy_false_alarms(variance(spark, sf_dir))


@query("anomaly_features")
def anomaly_features(spark, sf_dir):
    rows = anomaly.anomaly_features(variance(spark, sf_dir))
    return rows.select(*ITEM, *[half_up(c, 6).alias(c) for c in anomaly.FEATURES])


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    found = anomaly.detect_anomalies(variance(spark, sf_dir))
    return found.select(*ITEM, "anomaly_score", "anomaly_flag", "alert_level")


def part_variance(spark, sf_dir):
    return stocktake.variance_alerts(stocktake.usage_variance(binding.part_counts(spark, sf_dir)))


# A forest of three small trees, for the part of the scores that does not grow: tree, node, feature, threshold, path in billionths.
GIVEN_NODES = [
    *[(0, 1, 0, 0.1, 0), (0, 2, 1, 0.05, 0), (0, 3, -1, 0.0, 1_500_000_000), (0, 4, 2, 1.5, 0), (0, 5, -1, 0.0, 2_250_000_000)],
    *[(0, 8, -1, 0.0, 4_125_000_000), (0, 9, -1, 0.0, 3_000_000_000)],
    *[(1, 1, 2, 0.5, 0), (1, 2, -1, 0.0, 2_000_000_000), (1, 3, 0, -0.2, 0), (1, 6, -1, 0.0, 2_000_000_000), (1, 7, -1, 0.0, 3_375_000_000)],
    (2, 1, -1, 0.0, 1_000_000_000),
]


@query("isolation_score")
def isolation_score(spark, sf_dir):
    rows = materialise(anomaly.anomaly_features(part_variance(spark, sf_dir)).select(*ITEM, *anomaly.FEATURES))
    stores = rows.select("store_id").distinct()
    names = [c.split()[0] for c in forest.NODES.split(", ")]
    given = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, node, strict=True)]) for node in GIVEN_NODES])
    summed = forest.path_sums(rows, materialise(stores.select("store_id", F.inline(given))), ["store_id"])
    return summed.select(*ITEM, "path_sum", half_up(-F.pow(F.lit(2.0), -(F.col("path_sum") / 1e9 / 3.0 / 4.0)), 9).alias("score"))


@query("isolation_by_store")
def isolation_by_store(spark, sf_dir):
    found = forest.detect_anomalies_by(part_variance(spark, sf_dir))
    return found.select(*ITEM, "anomaly_score", "anomaly_flag", "alert_level")


@query("stockout_risk")
def stockout_risk(spark, sf_dir):
    rows = with_cover(spark, sf_dir)
    return rows.select(
        *ITEM, "closing_stock", half_up("avg_daily", 6).alias("avg_daily"), "days_of_cover", "stockout_risk", "insufficient_data"
    )


@query("waste_summary")
def waste_summary(spark, sf_dir):
    return stocktake.waste_summary(with_cover(spark, sf_dir))


@query("negative_variance")
def negative_variance(spark, sf_dir):
    return stocktake.negative_variance(variance(spark, sf_dir))
