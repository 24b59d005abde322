"""Models per store against plain numpy, store by store."""

import numpy as np
import pandas as pd
import pytest

from comanda.operators import by_store, segment
from comanda.params import UPSELL_FEATURES

NAMES = list(segment.FEATURES)


@pytest.fixture(scope="module")
def customers():
    rng = np.random.default_rng(4)
    parts = []
    for s, n in (("S1", 90), ("S2", 40), ("S3", 2)):
        centre = rng.integers(0, 3, n)
        x = centre[:, None] * [5, 100, 0.3, 20, 0] + rng.normal(0, 1, (n, 5)) * [1, 10, 0.05, 5, 0] + [3, 500, 0.4, 60, 19]
        parts.append(pd.DataFrame(x, columns=NAMES).assign(store_id=s, customer_id=range(n)))
    return pd.concat(parts, ignore_index=True)


def test_kmeans_of_every_store(spark, customers):
    df = by_store.standardise_by(spark.createDataFrame(customers).repartition(3), ["store_id"])
    got = by_store.kmeans_by(df, 3, starts=4).toPandas()
    assert len(got) == len(customers) and set(got.columns) == {*customers.columns, *[f"z_{c}" for c in NAMES], "cluster", "sq_distance"}
    for store, part in got.groupby("store_id"):
        z = part[[f"z_{c}" for c in NAMES]].to_numpy() / 1e6
        assert (z[:, 4] == 0).all()  # a feature that doesn't vary
        label = part["cluster"].to_numpy()
        assert set(label) == set(range(min(3, len(part))))
        centres = np.array([z[label == k].mean(axis=0) for k in sorted(set(label))])
        d = ((z[:, None] - centres) ** 2).sum(axis=2)
        # a fixed point of Lloyd's steps, numbered by its centres
        assert (d.argmin(axis=1) == label).all() and d.min(axis=1) == pytest.approx(part["sq_distance"], abs=1e-6)
        assert sorted(map(tuple, centres)) == list(map(tuple, centres))
        if store == "S1":
            assert d.min(axis=1).mean() < 1.2
    again = by_store.kmeans_by(df.filter("store_id = 'S2'"), 3, starts=4).toPandas()
    of = lambda t: dict(zip(t["customer_id"], t["cluster"], strict=True))
    assert of(got[got["store_id"] == "S2"]) == of(again)


def test_logistic_regression_of_every_store(spark):
    rng = np.random.default_rng(6)
    frames = []
    for s, n in (("S1", 800), ("S2", 300), ("S3", 50)):
        x = np.column_stack([rng.integers(1, 5, n), rng.integers(17, 25, n), rng.integers(0, 2, n), rng.integers(0, 2, n), np.ones(n, int)])
        y = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * x[:, 0] - 2 + x[:, 2])))).astype(int)
        frames.append(pd.DataFrame(x, columns=list(UPSELL_FEATURES)).assign(label=y if s != "S3" else 1, store_id=s))
    rows = pd.concat(frames)
    got = by_store.fit_logistic_by(spark.createDataFrame(rows)).toPandas()
    assert set(got["store_id"]) == {"S1", "S2"}  # one label only: no model
    for store, part in got.groupby("store_id"):
        data = rows[rows["store_id"] == store]
        x = data[list(UPSELL_FEATURES)].to_numpy(float)
        spread = x.std(axis=0)
        z = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / np.where(spread > 0, spread, 1)])
        b, ridge = np.zeros(6), np.r_[0.0, np.ones(5)]
        for _ in range(50):
            p = 1 / (1 + np.exp(-z @ b))
            b -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-12), z.T @ (p - data["label"].to_numpy()) + ridge * b)
        want = dict(zip(["intercept", *UPSELL_FEATURES], b, strict=True))
        assert dict(zip(part["feature"], part["coefficient"], strict=True)) == pytest.approx(want, abs=1e-7)
