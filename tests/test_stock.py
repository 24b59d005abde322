"""Stock counts, anomalies, costs and supplier scores: edges and invariants."""

from datetime import date
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import anomaly, cost, stocktake


def counted(spark, rows):
    """(sku, sold, counted more used than sold)"""
    full = [("S01", s, "c", 1000, 0, sold, 1000 - sold, 1000 - sold - extra, extra, Decimal(2)) for s, sold, extra in rows]
    schema = (
        "store_id STRING, sku_id STRING, category STRING, opening_stock BIGINT, received_qty BIGINT, qty_sold BIGINT, "
        "theoretical_stock BIGINT, closing_stock BIGINT, variance_qty_raw BIGINT, unit_cost DECIMAL(12,2)"
    )
    return stocktake.variance_alerts(stocktake.usage_variance(spark.createDataFrame(full, schema)))


def test_alert_edges(spark):
    df = counted(spark, [("at", 100, 15), ("over", 100, 16), ("under_at", 100, -15), ("under", 100, -16), ("none", 0, 3), ("nothing", 0, 0)])
    got = {r["sku_id"]: (r["alert_level"], r["alert_reason"]) for r in df.collect()}
    assert got["at"][0] == got["under_at"][0] == "低"
    assert got["over"] == ("中", "實際用量超出理論用量 16.0%,超過 ±15% 門檻")
    assert got["under"] == ("中", "實際用量低於理論用量 16.0% —— 庫存比帳上多,屬**資料登記問題**而非耗損")
    assert got["none"] == got["nothing"] == ("低", "無銷售紀錄,無法判斷")


def test_cover_edges(spark):
    df = counted(spark, [("red", 990, 0), ("one", 900, 0), ("three", 700, 0), ("unsold", 0, 0)])
    days = [("S01", k, date(2026, 7, d), n) for k, n in (("red", 99), ("one", 100), ("three", 100)) for d in range(1, 11)]
    sales = spark.createDataFrame(days, "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT")
    got = {r["sku_id"]: r for r in stocktake.stockout_risk(df, sales).collect()}
    assert [got[k]["days_of_cover"] for k in ("red", "one", "three", "unsold")] == [0.1, 1.0, 3.0, None]
    assert [got[k]["stockout_risk"][0] for k in ("red", "one", "three", "unsold")] == ["🔴", "🟡", "🟢", "🟢"]
    assert [got[k]["insufficient_data"] for k in ("three", "unsold")] == [False, True]


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(12)
    n = 500
    ratio = np.r_[rng.normal(0, 0.02, n - 3), [2.0, -1.5, 3.0]]
    pdf = pd.DataFrame({"store_id": "S01", "sku_id": [f"k{i}" for i in range(n)], "category": rng.choice(["a", "b"], n), "theoretical_usage": 1000})
    pdf["variance_qty"] = (ratio * 1000).round().astype(int)
    pdf["variance_ratio"], pdf["alert_level"] = pdf["variance_qty"] / 1000, "低"
    return spark.createDataFrame(pdf)


def test_isolation_forest(many):
    got = anomaly.detect_anomalies(many).toPandas().set_index("sku_id")
    flagged = got[got["anomaly_flag"]]
    assert abs(len(flagged) - 25) <= 1
    assert {"k497", "k498", "k499"} <= set(flagged.index) and set(flagged["alert_level"]) == {"高"}
    assert (got["anomaly_score"].nsmallest(3).index.isin(["k497", "k498", "k499"])).all()
    assert ((got["anomaly_score"] < 0) <= got["anomaly_flag"]).all()
    again = anomaly.detect_anomalies(many.repartition(5)).toPandas().set_index("sku_id")
    assert (again["anomaly_score"] == got["anomaly_score"].reindex(again.index)).all()


def test_too_few_rows_for_a_forest(many):
    got = anomaly.detect_anomalies(many.limit(59)).toPandas()
    assert got["anomaly_score"].isna().all() and not got["anomaly_flag"].any()
    assert anomaly.detect_anomalies(many.limit(60)).filter("anomaly_flag").count() > 0


def test_tree_isolates_every_row():
    sample = pd.DataFrame({"x": [0.0, 1.0, 2.0, 50.0], "tree": 0, "place": range(4)})
    nodes = anomaly.grow_tree(sample, ["x"])
    leaves = nodes[nodes["feature"] < 0]
    assert nodes["node"].to_list() == list(range(len(nodes))) and len(leaves) >= 3
    assert anomaly.expected_path(1) == 0 and anomaly.expected_path(2) == 1 and anomaly.expected_path(256) == pytest.approx(10.24, abs=0.01)


def test_features_of_unsold_items_are_zero(spark):
    got = anomaly.anomaly_features(counted(spark, [("a", 0, 5), ("b", 100, -20)])).orderBy("sku_id").collect()
    assert [tuple(r[c] for c in anomaly.FEATURES) for r in got] == [(0.0, 0.0, 0.0), (-0.2, 0.2, 0.0)]


def test_cost_bands_are_inclusive(spark):
    revenue = spark.createDataFrame([("a", 1000), ("b", 0)], "store_id STRING, revenue BIGINT")
    amounts = [("a", "food", 350.0), ("a", "labour", 250.0), ("a", "rent", 150.01), ("a", "utilities", 29.99), ("b", "food", 5.0)]
    lines = spark.createDataFrame(amounts, "store_id STRING, line STRING, amount DOUBLE")
    bands = {"food": ("0.28", "0.35"), "labour": ("0.25", "0.32"), "rent": ("0.08", "0.15"), "utilities": ("0.03", "0.06"), "marketing": ("0.01", "0.03")}
    got = {(r["store_id"], r["line"]): r for r in cost.cost_structure(lines, revenue, bands).collect()}
    verdicts = {k[1]: r["verdict"] for k, r in got.items() if k[0] == "a"}
    assert verdicts == {"food": cost.WITHIN, "labour": cost.WITHIN, "rent": cost.HIGH, "utilities": cost.BELOW, "marketing": cost.BELOW}
    assert got["a", "rent"]["over_amount"] == 0.01 and float(got["a", "marketing"]["amount"]) == 0
    assert {r["verdict"] for k, r in got.items() if k[0] == "b"} == {cost.BELOW} and got["b", "food"]["share"] == 0.0


def test_supplier_metrics_and_score(spark):
    receipts = spark.createDataFrame(
        [(1, "wine", True, False, 10, Decimal(100)), (1, "wine", False, True, 10, Decimal(100)), (2, "wine", True, False, 5, Decimal(100))],
        "supplier_id BIGINT, category STRING, on_time BOOLEAN, defective BOOLEAN, quantity BIGINT, amount DECIMAL(18,2)",
    )
    metrics = cost.supplier_metrics(receipts)
    got = {r["supplier_id"]: tuple(r)[1:] for r in metrics.collect()}
    assert got == {1: (2, 0.5, 0.5, 1.0), 2: (1, 1.0, 0.0, 0.5)}
    terms = spark.createDataFrame(
        [(1, "k2", "wine", 5.0, 1.2, 90), (1, "k1", "wine", 5.0, 1.2, 45), (2, "k3", "wine", 5.0, 1.2, 30), (3, "k4", "wine", 5.0, 1.2, 30)],
        "supplier_id BIGINT, sku_id STRING, category STRING, lead_time_days_avg DOUBLE, lead_time_days_std DOUBLE, payment_term_days BIGINT",
    )
    for rows_per_task in (1, 100):
        scored = {r["supplier_id"]: r for r in cost.score_suppliers(terms, metrics, rows_per_task).collect()}
        assert [scored[i]["score"] for i in (1, 2, 3)] == [67.5, 84.2, 51.7]
        assert [scored[i]["rank"] for i in (1, 2, 3)] == [2, 1, 3]
    assert scored[1]["payment_term_days"] == 45 and scored[1]["usable"]
    assert scored[3]["missing_metrics"] == "on_time_rate,defect_rate,price_competitiveness" and not scored[3]["usable"]


def test_identity_closes(spark):
    df = counted(spark, [("a", 100, 5), ("b", 50, -7)]).withColumn("price", F.lit(3))
    t = cost.reconcile_totals(cost.reconcile_items(df)).first()
    assert (float(t["waste_positive"]), float(t["waste_net"]), float(t["residual"])) == (10.0, -4.0, 0.0)
