"""Expressions and ordered aggregates against pandas, with the path for large groups forced."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.functions import exprs, ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, values repeat."""
    rng = np.random.default_rng(1)
    n = 600
    pdf = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n)),
            "id": np.arange(n),
            "v": rng.choice([0, 0, 0, 1, 5, 7, 9, 11], n),
        }
    )
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("rows_per_task", [10, 1000])
@pytest.mark.parametrize("by", [(), ("g",)])
def test_running_total(skewed, by, rows_per_task):
    df, pdf = skewed
    got = ordered.running_total(df, "v", [F.desc("v"), F.asc("id")], by, rows_per_task=rows_per_task).toPandas()
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    want["want"] = want.groupby("g")["v"].cumsum() if by else want["v"].cumsum()
    both = got.merge(want[["id", "want"]], on="id")
    assert len(both) == len(pdf) and (both["running_total"] == both["want"]).all()


@pytest.mark.parametrize("rows_per_task", [2, 1000])
def test_average_rank_pct(skewed, rows_per_task):
    df, pdf = skewed
    got = ordered.average_rank_pct(df, "v", "pct", rows_per_task=rows_per_task).toPandas().sort_values("id")
    assert np.allclose(got["pct"].to_numpy(), pdf["v"].rank(pct=True).to_numpy())
    got = ordered.average_rank_pct(df, "v", "pct", ["g"], rows_per_task).toPandas().sort_values("id")
    assert np.allclose(got["pct"].to_numpy(), pdf.groupby("g")["v"].rank(pct=True).to_numpy())


@pytest.mark.parametrize("q", [0.0, 0.05, 0.333, 0.5, 0.9, 1.0])
def test_exact_quantile(skewed, q):
    df, pdf = skewed
    got = ordered.exact_quantile(df.withColumn("v", F.col("v").cast("double") / 7), "v", q, 3).first()[0]
    assert got == pytest.approx(np.quantile(pdf["v"] / 7, q))


def test_share_of_total(skewed):
    df, pdf = skewed
    got = ordered.share_of_total(df, {"v": "v"}, ["g"]).select("g", "v_total").distinct().toPandas()
    assert dict(zip(got["g"], got["v_total"])) == pdf.groupby("g")["v"].sum().to_dict()
    assert ordered.share_of_total(df, {"v": "v"}).first()["v_total"] == pdf["v"].sum()


def test_rounding(spark):
    df = spark.createDataFrame([(0.285, 2, 0.29), (1.005, 2, 1.01), (0.15, 1, 0.2), (-0.15, 1, -0.2)], "x DOUBLE, d INT, want DOUBLE")
    for d in (1, 2):
        for r in df.filter(F.col("d") == d).select(exprs.half_up("x", d).alias("got"), "want").collect():
            assert r["got"] == r["want"]


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(exprs.ratio(F.lit(3), F.lit(0))).first()[0] is None


def test_sample_std(spark):
    x = [3, 4, 4, 9, 0]
    df = spark.createDataFrame([(sum(x), sum(v * v for v in x), len(x)), (5, 25, 1)], "s BIGINT, q BIGINT, n BIGINT")
    got = [r[0] for r in df.select(exprs.sample_std(F.col("s"), F.col("q"), F.col("n"))).collect()]
    assert got[0] == pytest.approx(np.std(x, ddof=1)) and got[1] is None


def test_hours_after_midnight_belong_to_the_evening_before(spark):
    df = spark.createDataFrame([("2026-02-07 00:30:00",), ("2026-02-06 21:00:00",), ("2026-02-07 04:00:00",)], "ts STRING")
    df = df.select(F.to_timestamp_ntz("ts").alias("ts"))
    rows = df.select(exprs.business_date("ts").cast("string"), exprs.business_hour("ts")).collect()
    assert [tuple(r) for r in rows] == [("2026-02-06", 24), ("2026-02-06", 21), ("2026-02-07", 4)]


def test_weekday(spark):
    df = spark.createDataFrame([("2026-02-02",), ("2026-02-06",), ("2026-02-08",)], "d STRING").select(F.to_date("d").alias("d"))
    assert [tuple(r) for r in df.select(exprs.weekday("d"), exprs.is_weekend("d")).collect()] == [(0, 0), (4, 1), (6, 0)]


def test_interpolation(spark):
    points = {0.90: 1.28, 0.95: 1.65, 0.97: 1.88, 0.98: 2.05, 0.99: 2.33}
    levels = [0.5, 0.9, 0.92, 0.95, 0.96, 0.975, 0.98, 0.985, 0.99, 1.0]
    df = spark.createDataFrame([(x,) for x in levels], "x DOUBLE")
    got = [r[0] for r in df.select(exprs.linear_interp("x", list(points.items()))).collect()]
    assert got == pytest.approx(list(np.interp(levels, list(points), list(points.values()))))
    assert got[1] == 1.28 and got[6] == 2.05
