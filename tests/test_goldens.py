"""Published results, from their own inputs."""

from decimal import Decimal

import goldens as g
import pytest
from pyspark.sql import functions as F

from comanda.operators import basket, cost, replenish, rerank, segment, stocktake
from comanda.sources import schemas


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def profile(spark):
    stats = spark.createDataFrame(
        [("S01", p[0], p[5], p[6], p[7], p[8], 128) for p in g.PROFILE],
        "store_id STRING, item_id STRING, total_units BIGINT, avg_daily DOUBLE, std_daily DOUBLE, peak_daily DOUBLE, business_days BIGINT",
    )
    menu = spark.createDataFrame(
        [(p[0], p[0], p[1], p[2], Decimal(p[3]), Decimal(p[4])) for p in g.PROFILE], schemas.MENU
    )
    return replenish.item_policy(replenish.abc_by_profit(stats, menu))


def test_profit_classes(profile):
    found = rows_by(profile, "item_id")
    for item in g.PROFILE:
        row = found[item[0]]
        assert (float(row["total_profit"]), row["cum_profit_share"], row["abc"]) == item[9:12]


def test_advice(spark, profile):
    stock = spark.createDataFrame(
        [("S01", a[0], a[1]) for a in g.ADVICE], "store_id STRING, item_id STRING, on_hand DOUBLE"
    )
    advice = replenish.reorder_advice(profile, stock, 4)
    found = rows_by(advice, "item_id")
    for a in g.ADVICE:
        r = found[a[0]]
        got = (a[0], r["on_hand"], r["safety_stock"], r["reorder_point"], r["days_of_cover"], r["suggested_qty"], r["status"])
        assert got == a[:7], a[0]
        assert (r["excess_qty"], r["spoilage_cost"]) == a[7:]
    order = [r["item_id"] for r in replenish.by_urgency(advice).collect()]
    assert order == [a[0] for a in g.ADVICE]
    summary = replenish.advice_summary(advice).first()
    assert (summary["n_urgent"], summary["n_low"], summary["n_enough"]) == (6, 6, 16)
    risk = replenish.spoilage_risk(advice).collect()
    assert [(r["item_id"], r["spoilage_cost"], float(r["total_spoilage_cost"])) for r in risk] == [("S07", 256.0, 256.0)]


def test_class_summary(profile):
    found = rows_by(replenish.abc_summary(profile), "abc")
    assert [(k, found[k]["n_items"], found[k]["service_level"]) for k in "ABC"] == [("A", 15, 0.98), ("B", 7, 0.95), ("C", 6, 0.9)]
    assert [round(found[k]["profit_share"], 3) for k in "ABC"] == [0.675, 0.222, 0.102]


@pytest.fixture(scope="module")
def inventory(spark):
    rows = [(*i[:10], Decimal(i[10]), Decimal(i[11]), "S01", 0.0) for i in g.INVENTORY]
    return spark.createDataFrame(rows, schemas.INVENTORY)


@pytest.fixture(scope="module")
def counted(spark, inventory):
    # what was sold in the month, over its 31 days
    days = spark.createDataFrame(
        [("S01", i[0], f"2026-07-{d:02d}", i[5] if d == 1 else 0) for i in g.INVENTORY for d in range(1, 32)],
        "store_id STRING, sku_id STRING, date STRING, qty_sold BIGINT",
    ).withColumn("date", F.to_date("date"))
    return stocktake.stockout_risk(stocktake.variance_alerts(stocktake.usage_variance(inventory)), days)


def test_stocktake(counted):
    found = rows_by(counted, "sku_id")
    for sku, ratio, waste, cover, state in g.STOCKTAKE:
        r = found[sku]
        assert r["variance_ratio"] == pytest.approx(ratio, abs=1e-12)
        assert (float(r["waste_cost"]), r["days_of_cover"], r["stockout_risk"]) == (waste, cover, state)
        assert (r["alert_level"], r["alert_reason"]) == ("低", "差異率在正常範圍內")


def test_stocktake_summary(counted):
    s = stocktake.waste_summary(counted).first()
    assert (float(s["waste_cost"]), s["n_alerts"], s["n_stockout"], s["n_negative"]) == (3195.0, 0, 2, 1)
    assert [r["sku_id"] for r in stocktake.negative_variance(counted).collect()] == ["特調調酒"]
    old = stocktake.legacy_false_alarms(counted).first()
    assert (old["n_items"], old["n_legacy"], old["n_usage_based"], old["n_false"]) == (12, 2, 0, 2)


def test_margins(inventory):
    found = rows_by(cost.item_margin(inventory), "sku_id")
    for sku, rate, total, cost_share, margin_share, flagged in g.MARGIN:
        r = found[sku]
        assert r["margin_rate"] == pytest.approx(rate, abs=1e-6) and float(r["total_margin"]) == total
        assert r["cost_share"] == pytest.approx(cost_share, abs=1e-6)
        assert r["margin_share"] == pytest.approx(margin_share, abs=1e-6)
        assert r["eats_margin"] == flagged


def test_reconciliation(inventory):
    t = cost.reconcile_totals(cost.reconcile_items(inventory)).first()
    names = ("revenue", "theoretical_cost", "purchase_cost", "stock_change_cost", "waste_positive", "waste_net", "residual")
    assert [float(t[n]) for n in names] == [1038140, 357715, 363820, 3130, 3195, 2975, 0]
    assert (t["theoretical_rate"], t["purchase_rate"]) == (0.3446, 0.3505)


def test_cost_structure(spark):
    lines = {"食材成本": 363820, "人事費用": 280000, "房租": 150000, "水電雜支": 45000, "行銷雜支": 20000}
    df = spark.createDataFrame([("S01", k, float(v)) for k, v in lines.items()], "store_id STRING, line STRING, amount DOUBLE")
    revenue = spark.createDataFrame([("S01", 1038140)], "store_id STRING, revenue BIGINT")
    found = rows_by(cost.cost_structure(df, revenue), "line")
    assert found["食材成本"]["verdict"] == cost.HIGH and found["食材成本"]["over_amount"] == 471.0
    assert found["食材成本"]["band"] == "28%~35%" and found["食材成本"]["share"] == pytest.approx(0.350454, abs=1e-6)
    assert {found[k]["verdict"] for k in list(lines)[1:]} == {cost.WITHIN}
    assert found["房租"]["total_over"] == 471.0


def test_suppliers(inventory):
    master = replenish.supplier_master(inventory)
    assert master.filter("needs_data_fill").count() == 12
    found = rows_by(cost.score_suppliers(master), "supplier_id")
    assert found["SUP-酒水"]["score"] == 55.0 and found["SUP-酒水"]["rank"] == 1
    others = [found[f"SUP-{c}"] for c in ("前菜", "主餐", "甜點")]
    assert {r["score"] for r in others} == {51.7} and {r["rank"] for r in others} == {2, 3, 4}
    assert {r["payment_term_score"] for r in others} == {0.67}
    assert not any(r["usable"] for r in found.values())


def test_orders(spark, inventory):
    sold = {i[0]: i[5] for i in g.INVENTORY}
    stats = spark.createDataFrame(
        [(o[0], o[1], "X", o[2], sold[o[0]] / 31, 1.0, 0.3, o[6], o[3], sold[o[0]] / 31) for o in g.ORDERS],
        "sku_id STRING, abc_class STRING, xyz_class STRING, service_level DOUBLE, demand_avg DOUBLE, demand_std DOUBLE, cv DOUBLE, "
        "safety_stock_qty DOUBLE, lead_time_days BIGINT, rolling_avg_4wk DOUBLE",
    ).withColumns({"review_cycle_days": F.lit(1), "insufficient_data": F.lit(False)})
    terms = replenish.supplier_master(inventory).select("sku_id", "moq", "pack_size", "shelf_life_days", "needs_data_fill")
    stocked = stats.join(inventory, "sku_id").join(terms, "sku_id")
    forecast = spark.createDataFrame(
        [("S01", o[0], o[4], o[5]) for o in g.ORDERS], "store_id STRING, sku_id STRING, p50 DOUBLE, p90 DOUBLE"
    )
    orders = replenish.build_orders(stocked, forecast)
    found = rows_by(orders, "sku_id")
    for o in g.ORDERS:
        r = found[o[0]]
        got = (r["reorder_point"], r["target_level_S"], r["order_qty_raw"], r["recommended_order_qty"], r["exception_flag"], r["exception_reason"])
        assert got == o[7:], o[0]
        assert r["data_gap_flag"]
    total = replenish.order_summary(orders).first()
    assert (total["n_items"], total["n_to_order"], total["n_exceptions"], total["n_data_gaps"]) == (12, 6, 1, 12)


def test_segments(spark):
    profile = spark.createDataFrame(
        [(*s[:7], Decimal(s[7])) for s in g.SEGMENTS],
        "cluster INT, n_customers BIGINT, avg_visits DOUBLE, avg_spend DOUBLE, avg_drink_ratio DOUBLE, avg_duration DOUBLE, avg_hour DOUBLE, total_profit DECIMAL(18,2)",
    )
    found = rows_by(segment.segment_value(segment.name_segments(profile)), "cluster")
    assert [(found[s[0]]["segment"], found[s[0]]["value_multiple"]) for s in g.SEGMENTS] == [(s[8], s[9]) for s in g.SEGMENTS]


@pytest.fixture(scope="module")
def fish(spark):
    menu = [(d, n, "酒水", tag, Decimal(1), Decimal("0.5")) for d, n, tag, *_ in g.FISH_RULES]
    menu.append(("M06", "香煎鮭魚佐檸檬", "主食", "Seafood", Decimal(460), Decimal("0.42")))
    rules = [("香煎鮭魚佐檸檬", "M06", n, d, s, c, l, Decimal(u), Decimal(e)) for d, n, _, s, c, l, u, e in g.FISH_RULES]
    return spark.createDataFrame(rules, schemas.RULES), rerank.with_categories(spark.createDataFrame(menu, schemas.MENU))


def test_fish_raw(spark, fish):
    rules, _ = fish
    orders = spark.createDataFrame([("v", "M06")], "pattern STRING, antecedent_id STRING")
    raw = rerank.recommend_without_rules(orders, rules).orderBy("rank")
    assert [(r["consequent_id"], float(r["final_score"])) for r in raw.collect()] == [("W04", 67.2), ("W07", 66.7), ("W03", 65.5)]
    sure = basket.recommend(orders, rules, 3, "confidence").orderBy("rank")
    assert [r["consequent_id"] for r in sure.collect()] == ["W03", "W04", "W07"]


def test_fish_with_rules(spark, fish):
    rules, menu = fish
    marked = rerank.mark_taboo(rerank.with_tags(rules, menu), rerank.taboo_table(spark))
    out = {r["consequent_id"]: r["reason"] for r in rerank.blocked(marked).collect()}
    assert set(out) == {"W02", "W06", "W07", "W11"} and out["W11"] == "威士忌基調與海鮮衝突"
    scored = rerank.score_rules(rules, menu, rerank.taboo_table(spark), rerank.penalty_table(spark))
    red = scored.filter("consequent_id = 'W01'").first()
    assert (float(red["pairing_factor"]), float(red["pairing_score"])) == (0.7, 22.8)
    sets = spark.createDataFrame([(20, 20, ["M06"]), (23, 23, ["M06"]), (24, 24, ["M06"])], "visit_id INT, arrival_hour BIGINT, foods ARRAY<STRING>")
    picked = {}
    for r in rerank.recommend_visits(sets, scored).orderBy("visit_id", "rank").collect():
        picked.setdefault(r["visit_id"], []).append((r["consequent_id"], float(r["final_score"])))
    assert picked[20] == [("W04", 67.2), ("W12", 51.8), ("W10", 26.8)]
    assert picked[23] == [("W12", 62.2), ("W04", 47.0), ("W10", 26.8)]
    assert picked[24] == picked[23]
