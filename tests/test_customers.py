"""Segments and drink models against numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comanda.operators import segment, upsell
from comanda.params import UPSELL_FEATURES
from comanda.session import materialise


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 4, (3, 5))
    x = np.vstack([rng.normal(c, 0.6, (60, 5)) for c in centres])
    pdf = pd.DataFrame(x, columns=segment.FEATURES).assign(customer_id=range(180), constant=1.0)
    return materialise(segment.standardise(spark.createDataFrame(pdf))), pdf


def test_standardise(points):
    df, pdf = points
    got = df.toPandas().sort_values("customer_id")
    for c in segment.FEATURES:
        assert np.allclose(got[f"z_{c}"], (pdf[c] - pdf[c].mean()) / pdf[c].std(ddof=0))


def test_constant_feature_becomes_zero(points):
    df, _ = points
    assert segment.standardise(df.select("customer_id", "constant"), ["constant"]).filter("z_constant <> 0").count() == 0


def test_kmeans(points):
    df, _ = points
    found = segment.fit_kmeans(df, range(2, 6), n_init=5)
    cost = [found[k].inertia for k in range(2, 6)]
    assert cost == sorted(cost, reverse=True)
    names = [f"z_{c}" for c in segment.FEATURES]
    x = df.orderBy("customer_id").toPandas()[names].to_numpy()
    centres = np.array(found[3].centres)
    distance = ((x[:, None] - centres) ** 2).sum(axis=2)
    assert found[3].inertia == pytest.approx(distance.min(axis=1).sum())
    assigned = segment.assign(df, found[3].centres).orderBy("customer_id").toPandas()
    assert (assigned["cluster"].to_numpy() == distance.argmin(axis=1)).all()
    # the three groups are found whole, and the centres are the means of their rows
    assert sorted(len(set(assigned["cluster"][i : i + 60])) for i in (0, 60, 120)) == [1, 1, 1]
    for i in range(3):
        assert np.allclose(x[distance.argmin(axis=1) == i].mean(axis=0), centres[i], atol=1e-2)
    scores = segment.choose_k(df, range(2, 6), n_init=3)
    assert segment.best_k(scores) == 3 and segment.best_k([(7, 1.0, 0.9), (2, 1.0, 0.1)]) == 4


def test_pca_and_covariance(points):
    df, _ = points
    names = [f"z_{c}" for c in segment.FEATURES]
    x = df.orderBy("customer_id").toPandas()[names].to_numpy()
    cov = np.cov(x.T)
    for r in segment.covariance(df).collect():
        i, j = segment.FEATURES.index(r["feature_a"]), segment.FEATURES.index(r["feature_b"])
        assert r["cov"] == pytest.approx(cov[i, j])
    vectors = segment.feature_vectors(df)
    model = segment.principal_components(vectors)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert model.explainedVariance.toArray() == pytest.approx(values[:2] / values.sum())
    got = segment.project(vectors, model).orderBy("customer_id").toPandas()
    _, _, vt = np.linalg.svd(x - x.mean(axis=0))
    for j, c in enumerate(("pc1", "pc2")):
        v = vt[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.allclose(got[c], x @ v)


def test_names_break_ties_by_cluster(spark):
    schema = "cluster INT, avg_visits DOUBLE, avg_drink_ratio DOUBLE"
    df = spark.createDataFrame([(0, 3.0, 0.2), (1, 3.0, 0.4), (2, 1.0, 0.4), (3, 1.0, 0.3), (4, 1.0, 0.2)], schema)
    got = {r["cluster"]: r["segment"] for r in segment.name_segments(df).collect()}
    assert got == {0: segment.CORE, 1: segment.NIGHT, 2: segment.GENERAL, 3: segment.GENERAL, 4: segment.DINING}
    two = segment.name_segments(spark.createDataFrame([(0, 1.0, 0.2), (1, 3.0, 0.4)], schema)).collect()
    assert {r["cluster"]: r["segment"] for r in two} == {0: segment.NIGHT, 1: segment.CORE}


@pytest.fixture(scope="module")
def tables_seated(spark):
    rng = np.random.default_rng(10)
    n = 1500
    hour = rng.integers(17, 25, n)
    pdf = pd.DataFrame(
        {
            "visit_id": [f"V{i}" for i in range(n)],
            "party_size": rng.integers(1, 7, n),
            "arrival_hour": hour,
            "is_buzz_hour": (hour >= 21).astype(int),
            "is_weekend": rng.integers(0, 2, n),
            "is_repeat": rng.integers(0, 2, n),
        }
    )
    margin = 0.3 * (hour - 20) + 0.6 * pdf["is_repeat"] - 0.2 * pdf["party_size"]
    pdf["label"] = (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(int)
    return spark.createDataFrame(pdf), pdf


def test_label_at_the_target(spark):
    df = spark.createDataFrame([("a", "0.4000"), ("b", "0.3999")], "visit_id STRING, r STRING")
    df = df.withColumn("drink_ratio", F.col("r").cast("decimal(9,4)")).withColumns({c: F.lit(1) for c in UPSELL_FEATURES})
    assert {r["visit_id"]: r["label"] for r in upsell.upsell_features(df).collect()} == {"a": 1, "b": 0}


def test_split(tables_seated):
    df, pdf = tables_seated
    first = upsell.stratified_split(df).toPandas()
    again = upsell.stratified_split(df.repartition(7)).toPandas()
    assert len(first) == len(pdf)
    for label, rows in first.groupby("label"):
        assert rows["is_test"].sum() == int(np.floor(0.25 * len(rows) + 0.5))
    assert set(first[first["is_test"] == 1]["visit_id"]) == set(again[again["is_test"] == 1]["visit_id"])


def newton(x, y, c=1.0):
    """Penalised logistic regression on scaled features, intercept free."""
    z = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / x.std(axis=0)])
    beta, penalty = np.zeros(z.shape[1]), np.r_[0.0, np.full(x.shape[1], 1.0 / c)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(penalty), z.T @ (p - y) + penalty * beta)
    return beta


def test_logistic_regression(tables_seated):
    df, pdf = tables_seated
    model = upsell.fit_logistic(df)
    want = newton(pdf[list(UPSELL_FEATURES)].to_numpy(dtype=float), pdf["label"].to_numpy())
    assert [model.intercept, *model.coefficients.values()] == pytest.approx(want.tolist(), abs=1e-5)
    odds = {r["feature"]: r["odds_ratio"] for r in upsell.odds_ratios(upsell.coefficient_table(df, model)).collect()}
    assert [odds[f] for f in UPSELL_FEATURES] == pytest.approx(np.exp(want[1:]).tolist(), abs=1e-3)


@pytest.fixture(scope="module")
def scored(tables_seated):
    df, _ = tables_seated
    return upsell.score(df, upsell.fit_logistic(df))


@pytest.mark.parametrize("rows_per_task", [5, 10_000])
def test_auc_and_roc(scored, rows_per_task):
    pdf = scored.toPandas()
    pos, neg = pdf[pdf["label"] == 1]["prob"].to_numpy().round(9), pdf[pdf["label"] == 0]["prob"].to_numpy().round(9)
    want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
    assert upsell.auc(scored, rows_per_task=rows_per_task).first()["auc"] == pytest.approx(want, abs=1e-6)
    curve = upsell.roc_curve(scored, rows_per_task=rows_per_task).orderBy(F.desc("threshold")).toPandas()
    assert (curve["fpr"].iloc[-1], curve["tpr"].iloc[-1]) == (1.0, 1.0)
    area = np.trapezoid(np.r_[0, curve["tpr"]], np.r_[0, curve["fpr"]])
    assert area == pytest.approx(want, abs=1e-4)
    middle = curve.iloc[len(curve) // 2]
    assert middle["tp"] == (pos >= middle["threshold"] - 1e-12).sum()


def test_confusion_and_report(scored):
    pdf = scored.toPandas()
    got = {r["label"]: (r["pred_0"], r["pred_1"]) for r in upsell.confusion_matrix(scored).collect()}
    want = pd.crosstab(pdf["label"], pdf["pred"])
    assert got == {k: (want.loc[k, 0], want.loc[k, 1]) for k in (0, 1)}
    report = {r["name"]: r for r in upsell.class_report(scored).collect()}
    hit = (pdf["label"] == pdf["pred"]).mean()
    precision = want.loc[1, 1] / want[1].sum()
    assert (report["accuracy"]["precision"], report["1"]["precision"]) == (pytest.approx(hit, abs=1e-3), pytest.approx(precision, abs=1e-3))
    assert report["weighted avg"]["recall"] == pytest.approx(hit, abs=1e-3) and report["macro avg"]["support"] == len(pdf)


def test_report_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label BIGINT, pred BIGINT")
    report = {r["name"]: r for r in upsell.class_report(df).collect()}
    assert (report["1"]["precision"], report["1"]["support"], report["0"]["f1"]) == (0.0, 0, 1.0)


def test_tree(tables_seated):
    df, pdf = tables_seated
    model = upsell.fit_tree(df)
    assert model.depth <= 4

    def gini(y):
        return 2 * y.mean() * (1 - y.mean()) * len(y)

    best = max(
        ((gini(pdf["label"]) - gini(left["label"]) - gini(right["label"]), f)
         for f in UPSELL_FEATURES for cut in sorted(pdf[f].unique())[:-1]
         for left, right in [(pdf[pdf[f] <= cut], pdf[pdf[f] > cut])] if min(len(left), len(right)) >= 40),
    )
    assert f"feature {UPSELL_FEATURES.index(best[1])} " in model.toDebugString.split("\n")[1]
    probs = upsell.score_tree(df, model)
    assert probs.groupBy("prob").count().agg(F.min("count")).first()[0] >= 40
    assert upsell.auc(probs).first()["auc"] > 0.6


def test_grid_and_tiers(spark):
    rows = [(0, 0, 0.2, 0.1, 100), (0, 0, 0.4, 0.3, 300), (1, 0, 0.9, 0.5, 900), (1, 1, 0.5, 0.5, 900)]
    df = spark.createDataFrame(rows, "is_buzz_hour BIGINT, is_repeat BIGINT, prob DOUBLE, drink_ratio DOUBLE, spend_per_head BIGINT")
    grid = {(r["is_buzz_hour"], r["is_repeat"]): r for r in upsell.action_grid(df).collect()}
    assert [k for k, r in grid.items() if r["is_best"]] == [(1, 0)]
    assert (grid[0, 0]["n_visits"], grid[0, 0]["avg_prob"], grid[0, 0]["avg_spend_per_head"]) == (2, 0.3, 200.0)
    edges = spark.createDataFrame([(0.6,), (0.59,), (0.4,), (0.39,)], "p DOUBLE")
    assert [r[0] for r in edges.select(upsell.potential_tier("p")).collect()] == ["high", "medium", "medium", "low"]


def test_customer_table_keeps_returning_customers(spark):
    visits = spark.createDataFrame(
        [("a", 10, 100), ("a", 20, 100), ("b", 5, 50), (None, 1, 1)], "customer_id STRING, spend_per_head INT, total_revenue INT"
    ).withColumns({c: F.lit(1) for c in ("drink_ratio", "duration_min", "arrival_hour", "total_profit")})
    rows = segment.customer_table(visits).collect()
    assert [(r["customer_id"], r["visits"], r["avg_spend"]) for r in rows] == [("a", 2, 15.0)]
    assert tuple(segment.repeat_share(visits).first()) == (2, 1, 0.8)


def test_cells_are_summed_before_they_meet_in_one_task(spark):
    rows = [(i, *[i // 2**j % 2 for j in range(len(UPSELL_FEATURES))], i % 3 % 2) for i in range(300)]
    df = spark.createDataFrame(rows, ["visit_id", *UPSELL_FEATURES, "label"])
    kept = []
    one_part, upsell.one_part = upsell.one_part, lambda *a: kept.append(one_part(*a)) or kept[-1]
    try:
        upsell.fit_logistic(df)
        upsell.fit_tree(df)
    finally:
        upsell.one_part = one_part
    assert len(kept) == 2
    for weighted in kept:
        # without a shuffle one task would run every partition of the aggregate
        assert "Repartition 1, true" in weighted._jdf.queryExecution().optimizedPlan().toString()
        assert weighted.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, weighted.collect())) == sorted(map(tuple, upsell.cells(df).collect()))


def test_the_rows_of_a_fit_are_held_by_mllib(points, monkeypatch):
    levels, whole = [], segment.KMeans

    class Watched(whole):
        def fit(self, vectors):
            levels.append(vectors.storageLevel)
            return super().fit(vectors)

    monkeypatch.setattr(segment, "KMeans", Watched)
    df, _ = points
    segment.fit_kmeans(df, [2], n_init=2)
    # what is persisted already is decoded again in every step
    assert len(levels) == 2 and not any(x.useMemory or x.useDisk for x in levels)
