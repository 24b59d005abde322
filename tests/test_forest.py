"""Forests per store: gates, own quantiles, the same scores however rows are dealt."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import anomaly, forest


def counts(store, n, seed, odd=()):
    rng = np.random.default_rng(seed)
    ratio = np.r_[rng.normal(0, 0.02, n - len(odd)), list(odd)]
    pdf = pd.DataFrame({"store_id": store, "sku_id": [f"k{i:04d}" for i in range(n)], "category": rng.choice(["a", "b"], n), "theoretical_usage": 1000})
    pdf["variance_qty"] = (ratio * 1000).round().astype(int)
    pdf["variance_ratio"], pdf["alert_level"] = pdf["variance_qty"] / 1000, "低"
    return pdf


@pytest.fixture(scope="module")
def stores(spark):
    # the large store's spread would hide what is odd in the small one
    large = counts("S1", 400, 1, (2.0, -1.5, 3.0))
    large["variance_qty"] *= 30
    large["variance_ratio"] *= 30
    parts = [large, counts("S2", 80, 2, (0.6,)), counts("S3", 59, 3, (5.0,)), counts("S4", 60, 4)]
    return spark.createDataFrame(pd.concat(parts)).repartition(6)


def by_row(df):
    return {(r["store_id"], r["sku_id"]): (r["anomaly_score"], r["anomaly_flag"], r["alert_level"]) for r in df.collect()}


def test_every_store_has_its_own_gate_and_quantile(stores):
    got = by_row(forest.detect_anomalies_by(stores, trees=40))
    flagged = {s: [k for (t, k), v in got.items() if t == s and v[1]] for s in ("S1", "S2", "S3", "S4")}
    assert len(got) == 599 and {s: len(v) for s, v in flagged.items()}.keys() == flagged.keys()
    assert abs(len(flagged["S1"]) - 20) <= 1 and abs(len(flagged["S2"]) - 4) <= 1 and 2 <= len(flagged["S4"]) <= 4
    assert {"k0397", "k0398", "k0399"} <= set(flagged["S1"]) and "k0079" in flagged["S2"]
    assert all(v == (None, False, "低") for (s, _), v in got.items() if s == "S3")
    assert all(v[2] == "高" for v in got.values() if v[1])


def test_scores_do_not_depend_on_how_rows_are_dealt(stores):
    want = by_row(forest.detect_anomalies_by(stores, trees=10))
    assert by_row(forest.detect_anomalies_by(stores.repartition(2), trees=10, rows_per_task=37)) == want
    alone = by_row(forest.detect_anomalies_by(stores.filter("store_id = 'S2'"), trees=10))
    assert alone == {k: v for k, v in want.items() if k[0] == "S2"}


def test_paths_against_a_walk_by_hand(spark):
    rows = [("S1", f"k{i}", float(i % 7) / 7, float(i % 5), float(i % 3)) for i in range(50)] + [("S2", "a", 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, ["store_id", "sku_id", *anomaly.FEATURES])
    x = np.array([r[2:] for r in rows if r[0] == "S1"])
    nodes = [n for t in range(5) for n in forest.grow("S1", t, x)]
    table = spark.createDataFrame([("S1", *n) for n in nodes], "store_id STRING, " + forest.NODES)
    got = {r["sku_id"]: r["path_sum"] for r in forest.path_sums(df, table, ["store_id"], rows_per_task=8).collect()}

    def walked(row):
        total = 0
        for t in range(5):
            tree = {n[1]: n for n in nodes if n[0] == t}
            at = 1
            while tree[at][2] >= 0:
                at = 2 * at + (row[tree[at][2]] > tree[at][3])
            total += tree[at][4]
        return total

    assert got == {f"k{i}": walked(x[i]) for i in range(50)}


def test_samples_are_bounded_and_differ_by_tree(spark):
    df = spark.range(5000).select(F.lit("S1").alias("store_id"), F.concat(F.lit("k"), "id").alias("sku_id"), F.col("id").cast("double").alias("x"))
    sizes = forest.store_sizes(df, ["store_id"])
    drawn = forest.store_samples(df, sizes, ["store_id"], ["store_id", "sku_id"], ["x"], 20, 64).toPandas()
    assert (drawn.groupby("tree").size() == 64).all() and drawn["x"].nunique() > 900


def test_quantile_by_group(spark):
    from comanda.functions.ordered import exact_quantile

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(4, size=900), "v": rng.integers(50, size=900) / 7})
    want = pdf.groupby("g")["v"].quantile(0.05).to_dict()
    for rows in (10, 10_000):
        got = {r["g"]: r["quantile"] for r in exact_quantile(spark.createDataFrame(pdf), "v", 0.05, rows, by=["g"]).collect()}
        assert got == pytest.approx(want)


def test_samples_hash_a_row_once(spark, tmp_path):
    import hashlib

    ids = [("S1", f"k{i}") for i in range(700)] + [("S2", f"k{i}") for i in range(5)]
    spark.createDataFrame([(s, k, float(i)) for i, (s, k) in enumerate(ids)], "store_id string, sku_id string, x double").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    drawn = forest.store_samples(table, forest.store_sizes(table, ["store_id"]), ["store_id"], ["store_id", "sku_id"], ["x"], 7, 20, place="n")
    want = set()
    for store in ("S1", "S2"):
        for tree in range(7):
            draws = []
            for i, (s, k) in enumerate(ids):
                h = hashlib.md5(f"{s}|{k}".encode()).hexdigest()
                if s == store:
                    draws.append(((int(h[:8], 16) * (tree + 1) + int(h[8:16], 16)) % forest.DRAWS, k, float(i)))
            want |= {(store, tree, x, n) for n, (_, _, x) in enumerate(sorted(draws)[:20], 1)}
    assert {tuple(r) for r in drawn.collect()} == want
    # the hash is read below the rows' trees, not in a function of each tree
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.index("Generate") < plan.index("conv(")
