"""All result tables from small domain tables, written and read back."""

from datetime import date, timedelta
from decimal import Decimal

import goldens as g
import numpy as np
import pytest
from pyspark.sql import functions as F

from comanda.operators import visits as visit_operators
from comanda.plans import reports
from comanda.sources import schemas


@pytest.fixture(scope="module")
def menu(spark):
    return spark.createDataFrame([(p[0], p[0], p[1], p[2], Decimal(p[3]), Decimal(p[4])) for p in g.PROFILE], schemas.MENU)


@pytest.fixture(scope="module")
def items(spark, menu):
    rng = np.random.default_rng(20)
    ids = [p[0] for p in g.PROFILE]
    rows = []
    for v in range(300):
        day = date(2026, 2, 1) + timedelta(days=int(v % 40))
        rows += [(f"V{v:03d}", "S01" if v % 3 else "S02", day, str(i)) for i in rng.choice(ids, rng.integers(1, 9))]
    lines = spark.createDataFrame(rows, "visit_id STRING, store_id STRING, date DATE, item_id STRING")
    return lines.join(menu, "item_id").withColumn("units", F.lit(1).cast("bigint"))


@pytest.fixture(scope="module")
def stock(spark):
    rows = [(*i[:10], Decimal(i[10]), Decimal(i[11]), "S01", 0.0) for i in g.INVENTORY]
    return spark.createDataFrame(rows, schemas.INVENTORY)


@pytest.fixture(scope="module")
def sales(spark):
    rng = np.random.default_rng(21)
    rows = [("S01", i[0], date(2026, 7, d), int(rng.poisson(i[5] / 31)) + 1) for i in g.INVENTORY for d in range(1, 32)]
    return spark.createDataFrame(rows, "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT")


def written(spark, result, folder, fmt="parquet"):
    reports.write_reports(result, str(folder), fmt)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in result} if fmt == "parquet" else None


def test_rules(spark, items, menu, tmp_path):
    back = written(spark, reports.rule_report(items, menu), tmp_path)["association_rules"]
    assert back.columns == [c.split(" ")[0] for c in schemas.RULES.split(", ")]
    assert back.count() > 50 and back.filter("support < 0.01 OR confidence < 0.05").count() == 0


def test_advice(spark, items, menu, tmp_path):
    stock = items.select("store_id", "item_id").distinct().withColumn("on_hand", F.lit(5.0))
    back = written(spark, reports.stock_advice_report(items, menu, stock, 4), tmp_path)
    sold = items.filter(F.weekday("date") != 0).select("store_id", "item_id").distinct().count()
    assert back["demand_profile"].count() == back["reorder_advice"].count() == sold
    states = {r["status"] for r in back["reorder_advice"].select("status").distinct().collect()}
    assert states <= {"🔴 立即叫貨", "🟡 低於安全庫存", "🟢 庫存充足"} and len(states) > 1


def test_orders_and_stocktake(spark, stock, sales, tmp_path):
    orders = written(spark, reports.order_report(sales, stock), tmp_path / "a")["reorder_recommendation"]
    assert orders.count() == 12 and orders.filter("data_gap_flag").count() == 12
    capped = orders.filter("sku_id = '主廚牛排'").first()
    assert capped["exception_flag"] and "受保存期 3 天限制" in capped["exception_reason"]
    counted = written(spark, reports.stocktake_report(stock, sales), tmp_path / "b")["stocktake_variance"]
    assert counted.count() == 12 and counted.filter("anomaly_flag OR anomaly_score IS NOT NULL").count() == 0
    assert counted.filter("sku_id = '主廚牛排'").first()["stockout_risk"] == "🔴 不足 1 日"


def test_costs(spark, stock, tmp_path):
    lines = spark.createDataFrame([("S01", "食材成本", 363820.0)], "store_id STRING, line STRING, amount DOUBLE")
    revenue = spark.createDataFrame([("S01", 1038140)], "store_id STRING, revenue BIGINT")
    back = written(spark, reports.cost_report(stock, lines, revenue), tmp_path)
    assert {n: df.count() for n, df in back.items()} == {"cost_structure": 5, "item_margin": 12, "cost_totals": 1, "supplier_score": 4}
    assert back["cost_structure"].filter("line = '食材成本'").first()["verdict"] == "🔴 偏高"


def test_segments(spark, items, tmp_path):
    heads = items.select("visit_id", "date").distinct().select(
        "visit_id",
        (F.substring("visit_id", 2, 3).cast("int") % 90).cast("string").alias("customer_id"),
        "date",
        (F.crc32("visit_id") % 8 + 17).alias("arrival_hour"),
        (F.crc32("visit_id") % 5 + 1).alias("party_size"),
        (F.crc32("visit_id") % 200 + 30).alias("duration_min"),
        F.lit(0).cast("bigint").alias("is_repeat"),
    )
    rollup = visit_operators.visit_rollup(items, heads)
    back = written(spark, reports.segment_report(rollup, range(2, 5), n_init=2), tmp_path)
    profile = back["segment_profile"].collect()
    assert 2 <= len(profile) <= 4 and sum(r["n_customers"] for r in profile) == back["customer_segments"].count() == 90
    assert len({r["segment"] for r in profile} & {"核心常客", "夜間酒客", "餐點取向客"}) == min(len(profile), 3)
    assert all(r["note"] for r in profile)
    reports.write_reports({"segment_profile": back["segment_profile"]}, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "segment_profile")).count() == len(profile)
