"""The result tables of each area from the domain tables, and writing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import lookup
from comanda.operators import anomaly, basket, cost, demand, replenish, segment, stocktake
from comanda.params import COST_BANDS, MenuTypes, RuleThresholds, StockPolicy
from comanda.plans.reorder import automatic_orders
from comanda.session import materialise
from comanda.sources.tables import write_table

Reports = dict[str, DataFrame]


def rule_report(
    items: DataFrame, menu: DataFrame, types: MenuTypes = MenuTypes(), thresholds: RuleThresholds = RuleThresholds()
) -> Reports:
    """Rules by expected profit."""
    sets = materialise(basket.basket_sets(items, types))
    rules = basket.association_rules(sets, menu, thresholds)
    return {"association_rules": rules.orderBy(F.desc("expected_profit"), "consequent_id", "antecedent_id")}


def stock_advice_report(
    items: DataFrame, menu: DataFrame, stock: DataFrame, target_weekday: int | None = None, types: MenuTypes = MenuTypes()
) -> Reports:
    """Demand profile and reorder advice per item, the most urgent first."""
    daily = materialise(demand.daily_demand(items))
    profile = materialise(replenish.demand_profile(daily, menu, types))
    advice = replenish.by_urgency(replenish.reorder_advice(profile, stock, target_weekday))
    words = advice.withColumn("status", lookup("status", replenish.STATUS_TEXT))
    return {"demand_profile": profile, "reorder_advice": words}


def order_report(
    sales: DataFrame, inventory: DataFrame, real_terms: DataFrame | None = None, policy: StockPolicy = StockPolicy()
) -> Reports:
    """(s, S) orders per store and sku."""
    supplier = replenish.supplier_master(inventory, real=real_terms)
    return {"reorder_recommendation": automatic_orders(sales, inventory, supplier, policy)}


def cost_report(
    inventory: DataFrame, lines: DataFrame, revenue: DataFrame, metrics: DataFrame | None = None, bands: dict = COST_BANDS
) -> Reports:
    """Cost structure, item margins with their reconciliation, supplier scores."""
    structure = cost.cost_structure(lines, revenue, bands)
    words = structure.withColumn("verdict", lookup("verdict", cost.VERDICT_TEXT))
    items = materialise(cost.reconcile_items(inventory))
    return {
        "cost_structure": words,
        "item_margin": cost.item_margin(items),
        "cost_totals": cost.reconcile_totals(items),
        "supplier_score": cost.score_suppliers(replenish.supplier_master(inventory), metrics),
    }


def stocktake_report(inventory: DataFrame, sales: DataFrame) -> Reports:
    """Variance, alerts, anomalies and stock cover per item."""
    counted = stocktake.variance_alerts(stocktake.usage_variance(inventory))
    flagged = anomaly.detect_anomalies(counted).drop(*anomaly.FEATURES)
    days = materialise(demand.sku_days(sales))
    return {"stocktake_variance": stocktake.stockout_risk(flagged, days)}


def segment_report(visits: DataFrame, ks: Sequence[int] = range(2, 8), n_init: int = 10) -> Reports:
    """Segment of every returning customer, and the segments with name, advice and value."""
    customers = materialise(segment.customer_table(visits))
    points = materialise(segment.standardise(customers))
    found = segment.fit_kmeans(points, ks, n_init)
    k = segment.best_k(segment.compare_k(points, found))
    k = max(x for x in found if x <= k)
    assigned = segment.assign(points, found[k].centres).drop(*[f"z_{c}" for c in segment.FEATURES], "sq_distance")
    profile = segment.segment_value(segment.name_segments(segment.segment_profile(assigned)))
    return {
        "customer_segments": assigned,
        "segment_profile": profile.withColumn("note", lookup("segment", segment.SEGMENT_NOTE)),
    }


def write_reports(reports: Reports, folder: str, fmt: str = "parquet") -> None:
    """One folder per table, split by store where the table has stores."""
    for name, df in reports.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", ["store_id"] if "store_id" in df.columns else [], fmt)
