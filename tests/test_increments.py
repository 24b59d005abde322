"""Increments, mergeable sketches, level tables and the sampled silhouette."""

import glob
import os
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import demand, replenish, segment
from comanda.params import SERVICE_LEVEL_Z
from comanda.sources.incremental import DailyStore

LINES = "store_id STRING, sku_id STRING, date DATE, qty_sold BIGINT"


def lines(n, seed):
    rng = np.random.default_rng(seed)
    first = date(2026, 1, 1)
    return [(f"S{int(rng.integers(2))}", f"P{int(rng.integers(5))}", first + timedelta(days=int(rng.integers(200))), int(rng.integers(1, 9))) for _ in range(n)]


def rows(df):
    return sorted(tuple(r) for r in df.select("store_id", "sku_id", "date", "qty_sold").collect())


def test_increments_equal_one_run(spark, tmp_path):
    early, late = lines(300, 1), [r for r in lines(60, 2) if r[2].month in (2, 5)]
    store = DailyStore(spark, str(tmp_path / "lines"), str(tmp_path / "days"))
    store.add(spark.createDataFrame([*early, ("S1", "P1", None, 3)], LINES), "a")
    whole = lambda r: rows(demand.sku_days(spark.createDataFrame(r, LINES)))
    assert rows(store.days()) == whole(early)
    written = lambda: {p: os.path.getmtime(p) for p in glob.glob(str(tmp_path / "days" / "*" / "*.parquet"))}
    before = written()
    for _ in range(2):  # the second time changes nothing
        months = store.add(spark.createDataFrame(late, LINES), "b")
        assert {r["month"].month for r in months.collect()} == {2, 5}
        assert rows(store.days()) == whole(early + late)
    # files of the other months are the same ones
    other = {p for p in before if "month=2026-02" not in p and "month=2026-05" not in p}
    assert other and all(written().get(p) == before[p] for p in other)
    # a corrected increment replaces what it brought before
    store.add(spark.createDataFrame([(*r[:3], r[3] + 1) for r in late], LINES), "b")
    assert rows(store.days()) == whole(early + [(*r[:3], r[3] + 1) for r in late])


def test_sketches_merge_and_keep_their_rank_error(spark):
    rng = np.random.default_rng(3)
    first = date(2000, 1, 1)
    data = [("S1", "P1", first + timedelta(days=d), int(rng.lognormal(5, 1))) for d in range(9000)] + [("S1", "P2", first + timedelta(days=7 * d), d) for d in range(40)]
    days = spark.createDataFrame(data, LINES)
    sketches = demand.month_sketches(days)
    got = {(r["sku_id"], r["weekday"]): r for r in demand.quantiles_of_sketches(sketches).collect()}
    values = {k: np.sort([q for _, p, d, q in data if p == k[0] and (k[1] is None or d.weekday() == k[1])]) for k in got}
    assert len(got) == 10
    for k, r in got.items():
        assert r["n_days"] == len(values[k])
        for q, x in ((0.5, r["p50"]), (0.9, r["p90"])):
            low, high = np.searchsorted(values[k], x, "left") / len(values[k]), np.searchsorted(values[k], x, "right") / len(values[k])
            assert low - 2 * demand.SKETCH_ERROR <= q <= high + 2 * demand.SKETCH_ERROR
    assert (got["P2", None]["p50"], got["P2", None]["p90"]) == (19, 35)
    # a month that is corrected is replaced alone
    fixed = sketches.filter("month != '2000-02-01'").unionByName(demand.month_sketches(days.filter("trunc(date, 'month') = '2000-02-01'")))
    again = {(r["sku_id"], r["weekday"]): r["n_days"] for r in demand.quantiles_of_sketches(fixed).collect()}
    assert again == {k: r["n_days"] for k, r in got.items()}


def test_level_tables_per_store(spark):
    points = [("S1", float(x), float(z)) for x, z in SERVICE_LEVEL_Z.items()] + [("S2", 0.9, 1.0), ("S2", 0.8, 0.5), ("S4", 0.9, 2.0)]
    table = spark.createDataFrame(points, "store_id STRING, level DOUBLE, z DOUBLE")
    levels = [None, 0.0, 0.8, 0.85, 0.9, 0.905, 0.95, 0.96, 0.97, 0.975, 0.99, 1.0]
    df = spark.createDataFrame([(s, x) for s in ("S1", "S2", "S3", "S4") for x in levels], "store_id STRING, service_level DOUBLE")
    got = {(r["store_id"], r["service_level"]): r["z"] for r in replenish.service_z_by(df, table).collect()}
    assert len(got) == df.count()
    for s in ("S1", "S2", "S3", "S4"):
        own = sorted((x, z) for t, x, z in points if t == s)
        for x in levels:
            want = None if x is None or not own else float(np.interp(x, [p[0] for p in own], [p[1] for p in own]))
            assert got[s, x] == (pytest.approx(want) if want is not None else None)
    same = df.filter("store_id = 'S1'").select(F.max(F.abs(replenish.service_z(F.col("service_level")) - F.lit(1.0)))).first()[0]
    assert same == pytest.approx(max(abs(got["S1", x] - 1.0) for x in levels if x is not None))


def test_silhouette_is_exact_or_within_its_bound(spark):
    rng = np.random.default_rng(5)
    label = rng.choice(3, 1500, p=[0.6, 0.3, 0.1])
    z = label[:, None] * np.array([2.0, 0, 1, 0, 0.5]) + rng.normal(0, 1, (1500, 5))
    pdf = pd.DataFrame(z, columns=[f"z_{c}" for c in segment.FEATURES]).assign(customer_id=range(1500), cluster=label)
    far = np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
    mean = np.array([[far[i, label == k].sum() / max((label == k).sum() - (k == label[i]), 1) for k in range(3)] for i in range(1500)])
    a = mean[np.arange(1500), label]
    mean[np.arange(1500), label] = np.inf
    b = mean.min(axis=1)
    want = ((b - a) / np.maximum(a, b)).mean()
    df = spark.createDataFrame(pdf)
    exact = segment.silhouette(df).first()
    assert exact["silhouette"] == pytest.approx(want) and exact["error_bound"] == 0 and exact["n_sampled"] == 1500
    drawn = segment.silhouette(df, per_cluster=200).first()
    assert drawn["n_sampled"] == 200 + 200 + (label == 2).sum() and drawn["n_rows"] == 1500
    assert 0 < abs(drawn["silhouette"] - want) < drawn["error_bound"] < 1
    one = segment.silhouette(df.withColumn("cluster", F.lit(0))).first()
    assert one["silhouette"] == 0
