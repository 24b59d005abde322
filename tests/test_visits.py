"""Visit rollup, key figures and sources against pandas."""

from datetime import date
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import kpi, visits
from comanda.params import ENGLISH_TYPES
from comanda.sources import schemas, sheets, tables


@pytest.fixture(scope="module")
def some_visits(spark):
    rng = np.random.default_rng(6)
    n = 400
    party = rng.integers(1, 7, n)
    n_drink = rng.integers(0, 6, n)
    drink = np.where(n_drink > 0, n_drink * rng.integers(100, 400, n), 0)
    food = rng.integers(0, 3000, n) + (drink == 0)
    pdf = pd.DataFrame(
        {
            "visit_id": [f"V{i}" for i in range(n)],
            "customer_id": rng.integers(0, 150, n).astype(str),
            "date": [date(2026, 2, 1 + int(d)) for d in rng.integers(0, 28, n)],
            "arrival_hour": rng.integers(17, 25, n),
            "party_size": party,
            "duration_min": rng.choice([0, 30, 60, 61, 90, 120, 150, 151, 300, 301], n),
            "is_repeat": rng.integers(0, 2, n),
            "n_drink": n_drink,
            "drink_revenue": drink,
            "total_revenue": food + drink,
        }
    )
    pdf["weekday"] = [d.weekday() for d in pdf["date"]]
    pdf["is_weekend"] = pdf["weekday"].isin([4, 5]).astype(int)
    pdf["is_buzz_hour"] = (pdf["arrival_hour"] >= 21).astype(int)
    pdf["drink_ratio"] = (pdf["drink_revenue"] / pdf["total_revenue"]).round(4)
    pdf["spend_per_head"] = (pdf["total_revenue"] / pdf["party_size"]).round(1)
    pdf["total_profit"] = pdf["total_revenue"] * 0.5
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("drink_revenue", "total_revenue", "total_profit")}
    exact = {"drink_ratio": F.col("drink_ratio").cast("decimal(9,4)"), "spend_per_head": F.col("spend_per_head").cast("decimal(18,1)")}
    return spark.createDataFrame(pdf).withColumns(money | exact), pdf


def test_kpis(some_visits):
    df, v = some_visits
    r, days = kpi.kpi_summary(df).first(), v["date"].nunique()
    assert (r["n_days"], r["n_visits"], float(r["total_revenue"])) == (days, len(v), v["total_revenue"].sum())
    assert r["drink_ratio"] == pytest.approx(v["drink_revenue"].sum() / v["total_revenue"].sum(), abs=1e-4)
    assert r["drinks_per_head"] == pytest.approx((v["n_drink"] / v["party_size"]).mean(), abs=1e-4)
    assert r["zero_drink_share"] == pytest.approx((v["n_drink"] == 0).mean(), abs=1e-4)
    assert r["avg_spend_per_head"] == pytest.approx(v["spend_per_head"].mean(), abs=0.01)
    per_day = kpi.kpi_summary(df, ["is_weekend"]).collect()
    assert sum(x["n_visits"] for x in per_day) == len(v)


def test_mean_of_ratios_is_not_ratio_of_sums(some_visits):
    df, v = some_visits
    got = {r["arrival_hour"]: r["avg_drink_ratio"] for r in kpi.drink_ratio_by_hour(df).collect()}
    assert got == pytest.approx(v.groupby("arrival_hour")["drink_ratio"].mean().to_dict(), abs=1e-4)
    split = {r["is_buzz_hour"]: r for r in kpi.buzz_split(df).collect()}
    late = v[v["is_buzz_hour"] == 1]
    assert split[1]["drink_share"] == pytest.approx(late["drink_revenue"].sum() / late["total_revenue"].sum(), abs=1e-4)
    assert split[1]["avg_drink_ratio"] == pytest.approx(late["drink_ratio"].mean(), abs=1e-4)


def test_duration_bins_are_closed_above(some_visits):
    df, v = some_visits
    got = {r["duration_bin"]: (r["n_visits"], r["drinks_per_head"]) for r in kpi.duration_vs_drinks(df).collect()}
    bins = pd.cut(v["duration_min"], [0, 60, 90, 120, 150, 300])
    want = (v["n_drink"] / v["party_size"]).groupby(bins, observed=True).agg(["size", "mean"])
    assert {k: n for k, (n, _) in got.items()} == {f"({i.left},{i.right}]": n for i, n in want["size"].items()}
    assert [got[f"({i.left},{i.right}]"][1] for i in want.index] == pytest.approx(want["mean"].to_list(), abs=1e-4)


def test_histogram_and_density(some_visits):
    df, v = some_visits
    rows = kpi.drink_ratio_histogram(df).orderBy("bin").collect()
    counts = [r["n_visits"] for r in rows]
    assert len(rows) == 30 and sum(counts) == len(v)
    assert rows[0]["from_ratio"] == v["drink_ratio"].min() and rows[-1]["to_ratio"] == v["drink_ratio"].max()
    edges = np.linspace(v["drink_ratio"].min(), v["drink_ratio"].max(), 31)
    assert np.abs(np.array(counts) - np.histogram(v["drink_ratio"], edges)[0]).max() <= 1
    x, h = v["drink_ratio"].to_numpy(), v["drink_ratio"].std() * len(v) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (h * np.sqrt(2 * np.pi)) * (x.max() - x.min()) / 30
    got = [r["height"] for r in kpi.drink_ratio_density(df).orderBy("point").collect()]
    assert got == pytest.approx(want.tolist(), abs=1e-3)


def test_findings(some_visits):
    df, v = some_visits
    hours = v.groupby("arrival_hour")["drink_ratio"].agg(["size", "mean"])
    want = hours[hours["size"] >= 30]["mean"].nsmallest(2)
    assert [r["arrival_hour"] for r in kpi.weak_hours(df).collect()] == want.index.to_list()
    r, zero = kpi.zero_drink_visits(df).first(), v[v["n_drink"] == 0]
    assert (r["n_zero"], r["zero_spend_per_head"]) == (len(zero), pytest.approx(zero["spend_per_head"].mean(), abs=0.01))
    assert r["lost_revenue"] == pytest.approx(len(zero) * v[v["n_drink"] > 0]["drink_revenue"].mean() * 0.5, abs=0.01)
    split = {x["is_weekend"]: x for x in kpi.weekend_split(df).collect()}
    for k, g in v.groupby("is_weekend"):
        assert (split[k]["n_visits"], split[k]["visits_per_day"]) == (len(g), pytest.approx(len(g) / g["date"].nunique(), abs=0.01))


def test_hidden_gems(spark):
    rng = np.random.default_rng(8)
    stats = pd.DataFrame({"item_id": [f"i{i}" for i in range(25)], "units": rng.choice([5, 5, 9, 12, 30], 25), "unit": rng.choice([10, 20, 20, 90], 25)})
    lines = spark.createDataFrame(stats).select("item_id", "units", (F.col("units") * F.col("unit")).cast("decimal(12,1)").alias("profit"))
    got = {r["item_id"] for r in kpi.hidden_gems(lines).collect()}
    want = stats[(stats["unit"].rank(pct=True) > 0.6) & (stats["units"].rank(pct=True) < 0.4)]
    assert got == set(want["item_id"]) and got


def test_top_items_break_ties_by_id(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "item_id STRING, profit INT")
    assert [r["item_id"] for r in kpi.top_items(df, 2).collect()] == ["c", "a"]


def test_rollup(spark):
    items = spark.createDataFrame(
        [
            ("v1", "f", "main", 1, Decimal("480"), Decimal("0.40")),
            ("v1", "f", "main", 1, Decimal("480"), Decimal("0.40")),  # the same dish twice
            ("v1", "w", "drink", 1, Decimal("300"), Decimal("0.63")),
            ("v2", "f", "main", 1, Decimal("480"), Decimal("0.40")),  # no drink
            ("v3", "w", "drink", 1, Decimal("300"), Decimal("0.63")),  # nothing to eat
            ("v4", "w", "drink", 1, Decimal("0"), Decimal("0.63")),  # on the house
        ],
        "visit_id STRING, item_id STRING, type STRING, units BIGINT, price DECIMAL(12,2), profit_margin DECIMAL(5,4)",
    )
    heads = spark.createDataFrame(
        [(f"v{i}", "c", date(2026, 2, 6), 24 if i == 1 else 20, 2, 90, 0) for i in range(1, 6)],
        "visit_id STRING, customer_id STRING, date DATE, arrival_hour BIGINT, party_size BIGINT, duration_min BIGINT, is_repeat BIGINT",
    )
    got = {r["visit_id"]: r for r in visits.visit_rollup(items, heads, ENGLISH_TYPES).collect()}
    assert set(got) == {"v1", "v2", "v3", "v4"}
    v1 = got["v1"]
    assert (v1["n_items"], v1["n_food"], v1["n_drink"], v1["weekday"], v1["is_weekend"], v1["is_buzz_hour"]) == (3, 2, 1, 4, 1, 1)
    assert [float(v1[c]) for c in ("food_revenue", "drink_revenue", "total_revenue", "total_profit", "drink_ratio", "spend_per_head")] == [
        960.0, 300.0, 1260.0, 573.0, 0.2381, 630.0,
    ]
    assert [float(got[v]["drink_ratio"]) for v in ("v2", "v3", "v4")] == [0.0, 1.0, 0.0]
    assert [c.split(" ")[0] for c in schemas.VISITS.split(", ")] == visits.visit_rollup(items, heads).columns


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "menu.csv"
    path.write_text("item_id,item_name,type,pairing_tag,price,profit_margin\nM01,舒肥紅酒燉牛肉,主食,Red_Meat,480,0.4\n", encoding="utf-8-sig")
    row = tables.read_table(spark, str(path), schemas.MENU, "csv").first()
    assert tuple(row) == ("M01", "舒肥紅酒燉牛肉", "主食", "Red_Meat", Decimal("480.00"), Decimal("0.4000"))
    row = visits.line_profit(tables.read_table(spark, str(path), schemas.MENU, "csv")).first()
    assert row["profit"] == Decimal("192.0")


def test_written_table_is_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("S01", 1), ("S02", 2)], "store_id STRING, n INT")
    for fmt in ("parquet", "csv"):
        out = str(tmp_path / fmt)
        tables.write_table(df, out, ["store_id"], fmt)
        tables.write_table(df, out, ["store_id"], fmt)
        assert (tmp_path / fmt / "store_id=S01").is_dir()
        back = tables.read_table(spark, out, "n INT, store_id STRING", fmt)
        assert sorted(tuple(r) for r in back.collect()) == [(1, "S01"), (2, "S02")]


def test_sales_sheet(spark):
    raw = spark.createDataFrame([("2026-07-03", "主廚牛排", "主餐", 7, 580.0, 4060.0)], ["日期", "品項", "分類", "數量", "單價(元)", "小計(元)"])
    row = sheets.normalise_sales(raw).first()
    assert tuple(row) == ("S01", "主廚牛排", "主餐", date(2026, 7, 3), 4, 7, 580.0, 4060.0)


def test_cost_lines(spark):
    cells = [(" 房租(元) ", "1", 1), ("房租(元)", "150000", 2), ("備註", "無", 3), (None, "5", 4), ("淨利率", None, 5), ("淨利率", "0.17", 6), ("x", "NaN", 7)]
    raw = spark.createDataFrame(cells, "label STRING, value STRING, row_no INT")
    lines = sheets.cost_lines(raw)
    assert {r["line"]: r["amount"] for r in lines.collect()} == {"房租(元)": 150000.0, "淨利率": 0.17}
    wide = sheets.cost_summary(lines, ["房租(元)", "淨利率", "營業額(元)"]).first()
    assert tuple(wide) == (150000.0, 0.17, None)


def test_point_of_sale_export(spark, tmp_path):
    """From exported files to recommendations, with the published type names."""
    from comanda.operators import basket, rerank
    from comanda.params import MenuTypes
    from comanda.session import materialise
    from comanda.sources import pos

    menu_lines = ["M06,香煎鮭魚佐檸檬,主食,Seafood,460,0.42", "W06,Negroni,酒水,Cheese,350,0.76", "W13,無酒精莫吉托,酒水,Universal,180,0.8"]
    item_lines, visit_lines = [], []
    for v in range(10):
        item_lines += [f"V{v},2026-02-06,M06,香煎鮭魚佐檸檬,主食,Seafood,460.0,193.2"] * 2
        item_lines.append(f"V{v},2026-02-06,{'W06,Negroni,酒水,Cheese,350.0,266.0' if v < 6 else 'W13,無酒精莫吉托,酒水,Universal,180.0,144.0'}")
        visit_lines.append(f"V{v},C{v},2026-02-06,4,1,{17 + v % 8},0,2,90,0,3,2,1,920.0,350.0,1270.0,652.4,0.2756,635.0")
    files = {"menu": (schemas.MENU, menu_lines), "items": (schemas.ORDER_ITEMS, item_lines), "visits": (schemas.VISITS, visit_lines)}
    for name, (schema, lines) in files.items():
        header = ",".join(c.split(" ")[0] for c in schema.replace("(12,", "(12;").split(", "))
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8-sig")
    menu = pos.load_menu(spark, str(tmp_path / "menu.csv"))
    items = pos.load_order_items(spark, str(tmp_path / "items.csv"), menu)
    visits_table = pos.load_visits(spark, str(tmp_path / "visits.csv"))
    assert items.filter("units = 1 AND store_id = 'S01' AND profit_margin IS NOT NULL").count() == 30
    assert kpi.kpi_summary(visits_table).first()["n_visits"] == 10
    types = MenuTypes()
    rules = materialise(basket.association_rules(basket.basket_sets(items, types), menu))
    assert {(r["consequent_id"], r["support"], float(r["expected_profit"])) for r in rules.collect()} == {("W06", 0.6, 159.6), ("W13", 0.4, 57.6)}
    scored = materialise(rerank.score_rules(rules, menu, rerank.taboo_table(spark), rerank.penalty_table(spark)))
    picked = rerank.recommend_visits(materialise(pos.visit_dishes(items, visits_table, types.foods)), scored).collect()
    assert len(picked) == 10 and {(r["consequent_id"], r["category"], r["rank"]) for r in picked} == {("W13", "alcohol_free", 1)}
