"""Cases that default parameters and the driver tables do not reach."""

import pytest

from comanda.operators import replenish, rerank
from comanda.params import HourFactors


@pytest.mark.parametrize("start", [19, 20])
def test_hour_factors_reach_the_recommendations(spark, start):
    rules = spark.createDataFrame(
        [("M1", "c1", 10.0, "cocktail", False)],
        "antecedent_id string, consequent_id string, pairing_score double, category string, slow_wine boolean",
    )
    factors = HourFactors(cocktail_from=start)
    scored = rules.selectExpr("antecedent_id", "consequent_id", "cast(pairing_score as decimal(18,1)) pairing_score", "category", "slow_wine")
    for hour in (18, 19, 20, 21, 22):
        adjusted = rerank.hour_adjusted(scored.selectExpr("*", f"{hour}L as arrival_hour"), factors).first()
        expected = 12.0 if hour >= start else 10.0
        assert float(adjusted["final_score"]) == expected


def test_no_spread_suggests_nothing(spark):
    profile = spark.createDataFrame(
        [("S", "D1", "Beer", "drink", "A", 10.0, 10.0, None, 2, 360, 5.0, 0.5, 100.0)],
        "store_id string, item_id string, item_name string, type string, abc string, avg_daily double, peak_daily double,"
        " std_daily double, lead_time int, shelf_life int, price double, profit_margin double, total_profit double",
    )
    stock = spark.createDataFrame([("S", "D1", 10)], "store_id string, item_id string, on_hand int")
    row = replenish.reorder_advice(profile, stock).first()
    assert row["suggested_qty"] == 0 and row["insufficient_data"] and row["reorder_point"] is None
