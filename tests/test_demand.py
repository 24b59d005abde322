"""Demand, forecasts and orders against pandas."""

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import demand, replenish
from comanda.params import SUPPLIER_DEFAULTS, StockPolicy
from comanda.plans.reorder import automatic_orders
from comanda.sources import schemas

START = date(2026, 2, 1)


@pytest.fixture(scope="module")
def items(spark):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(60):
        day = START + timedelta(days=d)
        for store in ("S01", "S02"):
            if store == "S02" and d % 9 == 0:
                continue  # the store was shut that day
            for i in range(4):
                units = int(rng.integers(0, 4)) if i else int(rng.random() < 0.1)
                rows += [(store, day, f"i{i}", f"I{i}", "main", "Fried", 1)] * units
    df = spark.createDataFrame(rows, "store_id STRING, date DATE, item_id STRING, item_name STRING, type STRING, pairing_tag STRING, units BIGINT")
    return df, pd.DataFrame(rows, columns=df.columns)


def test_dense_demand_equals_the_filled_grid(items):
    df, pdf = items
    got = demand.dense_demand(demand.daily_demand(df)).toPandas().set_index(["store_id", "item_id"])
    for store, lines in pdf.groupby("store_id"):
        days = sorted(d for d in lines["date"].unique() if d.weekday() != 0)
        for item in lines["item_id"].unique():
            x = lines[lines["item_id"] == item].groupby("date")["units"].sum().reindex(days, fill_value=0)
            peak = x[[d.weekday() in (4, 5) for d in days]]
            r = got.loc[(store, item)]
            assert (r["business_days"], r["total_units"]) == (len(days), x.sum())
            assert r[["avg_daily", "std_daily", "peak_daily"]].to_list() == pytest.approx([x.mean(), x.std(), peak.mean()])


@pytest.fixture(scope="module")
def sales(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s, (n, last) in enumerate([(40, 0), (25, 3), (9, 20), (1, 31)]):
        for d in rng.choice(45, n, replace=False):
            rows.append(("S01", f"k{s}", START + timedelta(days=int(d)) - timedelta(days=last), int(rng.integers(1, 30))))
    rows.append(("S01", "k0", rows[0][2], 5))  # a second line on a day
    df = spark.createDataFrame(rows, "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT")
    days = pd.DataFrame(rows, columns=df.columns).groupby(["sku_id", "date"], as_index=False)["qty_sold"].sum()
    return df, days


def test_demand_stats(sales):
    df, days = sales
    by_day = demand.sku_days(df)
    got = demand.demand_stats(by_day).toPandas().set_index("sku_id")
    recent = demand.recent_average(by_day).toPandas().set_index("sku_id")["rolling_avg_4wk"]
    last = days["date"].max()
    for sku, x in days.groupby("sku_id"):
        r, q = got.loc[sku], x["qty_sold"]
        assert (r["total_qty"], r["n_days"], r["last_date"]) == (q.sum(), len(q), x["date"].max())
        assert r["demand_avg"] == pytest.approx(q.mean())
        if len(q) > 1:
            assert (r["demand_std"], r["cv"]) == (pytest.approx(q.std()), pytest.approx(q.std() / q.mean()))
        else:
            assert np.isnan(r["demand_std"]) and np.isnan(r["cv"])
        want = x[x["date"] > last - timedelta(days=28)]["qty_sold"].mean()
        assert recent[sku] == pytest.approx(want, nan_ok=True)


def test_forecast_equals_listing_the_days(spark, sales):
    df, days = sales
    quantiles = demand.weekday_quantiles(demand.sku_days(df))
    days = days.assign(weekday=[d.weekday() for d in days["date"]])
    for n in (1, 2, 5, 7, 16):
        horizon = demand.sku_days(df).groupBy("store_id", "sku_id").agg(F.max("date").alias("last_date"), F.lit(n).alias("days"))
        got = demand.forecast_horizon(quantiles, horizon).toPandas().set_index("sku_id")
        for sku, x in days.groupby("sku_id"):
            for name, q in (("p50", 0.5), ("p90", 0.9)):
                total = 0.0
                for ahead in range(1, n + 1):
                    same = x[x["weekday"] == (x["date"].max() + timedelta(days=ahead)).weekday()]["qty_sold"]
                    total += (same if len(same) else x["qty_sold"]).quantile(q)
                assert got.loc[sku, name] == pytest.approx(total), (sku, n)


def test_abc_cuts_and_ties(spark):
    # shares .70, .20, .05, .05: the second reaches .90 exactly and stays in its class
    rows = [("s", "a", 70), ("s", "b", 20), ("s", "d", 5), ("s", "c", 5), ("t", "x", 1)]
    df = spark.createDataFrame(rows, "store_id STRING, sku_id STRING, v BIGINT").withColumn("v", F.col("v").cast("decimal(20,2)"))
    for rows_per_task in (1, 100):
        got = replenish.classify_by_share(df, "v", (("A", "0.70"), ("B", "0.90")), ["store_id"], "sku_id", "share", "abc", rows_per_task)
        assert {r["sku_id"]: (r["share"], r["abc"]) for r in got.collect()} == {
            "a": (0.7, "A"),
            "b": (0.9, "B"),
            "c": (0.95, "C"),
            "d": (1.0, "C"),
            "x": (1.0, "C"),
        }


def test_xyz_edges(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (1.0,), (1.01,), (None,)], "cv DOUBLE")
    got = [(r["xyz_class"], r["insufficient_data"]) for r in replenish.xyz_class(df).collect()]
    assert got == [("X", False), ("Y", False), ("Y", False), ("Z", False), ("Z", True)]


def test_real_supplier_terms_win(spark):
    inventory = spark.createDataFrame(
        [("S01", "a", "酒水", Decimal(60)), ("S01", "b", "酒水", Decimal(60)), ("S01", "c", "?", Decimal(1))],
        "store_id STRING, sku_id STRING, category STRING, unit_cost DECIMAL(12,2)",
    )
    real = spark.createDataFrame(
        [("S01", "a", "V1", 3.0, 0.1, 6, 6, 60), ("S01", "b", "V2", None, None, 24, None, None)],
        "store_id STRING, sku_id STRING, supplier_id STRING, lead_time_days_avg DOUBLE, lead_time_days_std DOUBLE, moq BIGINT, pack_size BIGINT, payment_term_days BIGINT",
    )
    got = {r["sku_id"]: r for r in replenish.supplier_master(inventory, real=real).collect()}
    assert (got["a"]["supplier_id"], got["a"]["moq"], got["a"]["needs_data_fill"]) == ("V1", 6, False)
    assert (got["b"]["moq"], got["b"]["pack_size"], got["b"]["needs_data_fill"]) == (24, SUPPLIER_DEFAULTS["酒水"].pack_size, True)
    assert (got["c"]["supplier_id"], got["c"]["moq"], got["c"]["shelf_life_days"], got["c"]["pack_size"]) == ("SUP-?", 10, 5, 1)


def order_of(spark, **values):
    row = {
        "store_id": "S01", "sku_id": "k", "category": "c", "abc_class": "A", "xyz_class": "X", "service_level": 0.98, "cv": 0.2,
        "demand_avg": 10.0, "demand_std": 2.0, "safety_stock_qty": 5.0, "lead_time_days": 2, "rolling_avg_4wk": 10.0,
        "review_cycle_days": 1, "insufficient_data": False, "closing_stock": 10, "on_order_qty": 0, "moq": 1, "pack_size": 1,
        "shelf_life_days": 365, "needs_data_fill": False, "unit_cost": Decimal(2), "p50": 20.0, "p90": 25.0,
    } | values
    schema = ", ".join(
        f"{k} {'STRING' if isinstance(v, str) else 'BOOLEAN' if isinstance(v, bool) else 'BIGINT' if isinstance(v, int) else 'DECIMAL(12,2)' if isinstance(v, Decimal) else 'DOUBLE'}"
        for k, v in row.items()
    )
    df = spark.createDataFrame([tuple(row.values())], schema)
    return replenish.build_orders(df.drop("p50", "p90"), df.select("store_id", "sku_id", "p50", "p90")).first()


def test_order_rounds_up_to_packs(spark):
    r = order_of(spark, pack_size=12)
    # target 20 + 5 + 10, less 10 in stock: 25, in packs of 12
    assert (r["order_qty_raw"], r["recommended_order_qty"], r["exception_flag"]) == (25.0, 36, False)


def test_order_raised_to_minimum(spark):
    r = order_of(spark, moq=40)
    assert r["recommended_order_qty"] == 40 and r["exception_reason"] == "未達 MOQ 40,已補足至最小訂購量"


def test_order_above_shelf_life(spark):
    r = order_of(spark, moq=40, shelf_life_days=3)
    assert r["recommended_order_qty"] == 20
    assert r["exception_reason"] == (
        "未達 MOQ 40,已補足至最小訂購量 / 受保存期 3 天限制,由 40 降為 20(超額部分將成廚餘) / "
        "⚠️ MOQ 40 超過保存期內可銷量 30,需與供應商議定拆箱或改期"
    )


def test_order_swing(spark):
    r = order_of(spark, p50=40.0)
    assert r["exception_reason"] == "需求波動 100% 超過 30% 門檻" and r["recommended_order_qty"] == 45
    assert not order_of(spark, p50=26.0)["exception_flag"]  # exactly 30 %


def test_no_order_when_stocked_or_unknown(spark):
    assert order_of(spark, closing_stock=25)["recommended_order_qty"] == 0
    r = order_of(spark, safety_stock_qty=None, demand_std=None, cv=None, insufficient_data=True)
    assert (r["recommended_order_qty"], r["reorder_point"], r["insufficient_data"]) == (0, None, True)
    assert order_of(spark, rolling_avg_4wk=None, closing_stock=99)["exception_reason"] == ""


def test_automatic_orders_end_to_end(spark, sales):
    df, days = sales
    stock = spark.createDataFrame(
        [("S01", f"k{i}", "酒水", Decimal("10.00"), Decimal("20.00"), 3, 0) for i in range(4)],
        "store_id STRING, sku_id STRING, category STRING, unit_cost DECIMAL(18,2), price DECIMAL(18,2), closing_stock BIGINT, on_order_qty BIGINT",
    )
    got = {r["sku_id"]: r for r in automatic_orders(df, stock, replenish.supplier_master(stock), StockPolicy()).collect()}
    assert set(got) == {"k0", "k1", "k2", "k3"}
    for sku in ("k0", "k1", "k2"):
        r = got[sku]
        assert r["recommended_order_qty"] % 12 == 0 and r["recommended_order_qty"] >= r["target_level_S"] - 3 - 0.1
    assert got["k3"]["xyz_class"] == "Z" and got["k3"]["recommended_order_qty"] == 0


def test_advice_without_peak_days_or_stock(spark):
    menu = spark.createDataFrame([("i0", "I", "酒水", "Fried", Decimal(100), Decimal("0.5"))], schemas.MENU)
    stats = spark.createDataFrame(
        [("S01", "i0", 10, 1.0, 0.5, None, 10)],
        "store_id STRING, item_id STRING, total_units BIGINT, avg_daily DOUBLE, std_daily DOUBLE, peak_daily DOUBLE, business_days BIGINT",
    )
    profile = replenish.item_policy(replenish.abc_by_profit(stats, menu))
    stock = spark.createDataFrame([], "store_id STRING, item_id STRING, on_hand DOUBLE")
    friday = replenish.reorder_advice(profile, stock, 4).first()
    assert (friday["status"], friday["days_of_cover"], friday["suggested_qty"]) == ("enough", None, 0)
    tuesday = replenish.reorder_advice(profile, stock, 1).first()
    assert (tuesday["status"], tuesday["on_hand"], tuesday["lead_time"], tuesday["shelf_life"]) == ("urgent", 0.0, 5, 365)
