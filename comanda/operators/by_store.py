"""Models of all stores at once: k-means and logistic regression whose steps are one aggregate by store.

Centres and coefficients are tables with a few rows per store. A step joins them to the rows (k-means) or to counted cells
(regression), sums by store, and writes the small table that comes out. Sums are of whole millionths where they decide
something, so results don't depend on row order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from comanda.functions.exprs import half_up
from comanda.operators import segment
from comanda.operators.forest import store_samples, store_sizes
from comanda.params import UPSELL_FEATURES
from comanda.session import broadcast_if_small, materialise

MILLION = 1_000_000


def standardise_by(df: DataFrame, keys: Sequence[str], features: Sequence[str] = segment.FEATURES) -> DataFrame:
    """Add `z_<feature>`, in whole millionths of the store's population spread from its mean; 0 where nothing varies."""
    stats = [x for c in features for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))]
    df = df.join(broadcast_if_small(materialise(df.groupBy(*keys).agg(*stats))), list(keys))

    def scaled(c: str) -> Column:
        z = (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
        return F.round(z * MILLION, 0).cast("bigint")

    return df.withColumns({f"z_{c}": scaled(c) for c in features}).drop(*[f"_{x}_{c}" for c in features for x in "ms"])


def _distance(points: Sequence[Column], centre: Column) -> Column:
    parts = [(p - centre[i]) * (p - centre[i]) for i, p in enumerate(points)]
    return reduce(lambda a, b: a + b, parts)


def nearest(df: DataFrame, centres: DataFrame, keys: Sequence[str], features: Sequence[str] = segment.FEATURES) -> DataFrame:
    """Every row for each start of its store with the nearest centre (the lower cluster on a tie) and its distance.

    `centres` (keys, start, cluster, centre) is folded to a row per store and start, which a row meets by its store.
    """
    folded = materialise(centres.groupBy(*keys, "start").agg(F.array_sort(F.collect_list(F.struct("cluster", "centre"))).alias("_centres")))
    points = [F.col(f"z_{c}") for c in features]
    best = F.array_min(F.transform("_centres", lambda c: F.struct(_distance(points, c["centre"]).alias("d"), c["cluster"].alias("cluster"))))
    met = df.join(broadcast_if_small(folded), list(keys)).withColumn("_best", best)
    return met.withColumns({"cluster": F.col("_best.cluster"), "sq_distance": F.col("_best.d")}).drop("_best", "_centres")


def kmeans_by(
    df: DataFrame, k: int, keys: Sequence[str] = ("store_id",), ids: Sequence[str] = ("store_id", "customer_id"),
    features: Sequence[str] = segment.FEATURES, starts: int = 5, max_iter: int = 100,
) -> DataFrame:
    """`df` with its cluster in the best of `starts` runs of Lloyd's steps within its store, and the squared distance.

    `df` is a written table with standardised features (`standardise_by`). A run starts from `k` rows drawn by a hash; a
    store with fewer rows has fewer clusters. A centre without rows stays. All stores and starts move together until
    no centre moves. Clusters are numbered by their centres, so equal outcomes of two starts are the same clusters.
    """
    keys, names = list(keys), [f"z_{c}" for c in features]
    drawn = store_samples(df, store_sizes(df, keys), keys, ids, names, starts, k, place="cluster")
    as_array = F.array(*[F.col(c).cast("double") for c in names])
    centres = materialise(drawn.select(*keys, F.col("tree").alias("start"), (F.col("cluster") - 1).alias("cluster"), as_array.alias("centre")))
    for _ in range(max_iter):
        moved = nearest(df, centres, keys, features).groupBy(*keys, "start", "cluster")
        moved = moved.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_{c}") for c in names])
        means = F.array(*[F.col(f"_{c}").cast("double") / F.col("_n").cast("double") for c in names])
        after = centres.join(moved, [*keys, "start", "cluster"], "left").select(*keys, "start", "cluster", "centre", F.when(F.col("_n").isNotNull(), means).otherwise(F.col("centre")).alias("_new"))
        after = materialise(after)
        centres = after.drop("centre").withColumnRenamed("_new", "centre")
        if after.filter("centre != _new").isEmpty():
            break
    assigned = materialise(nearest(df, centres, keys, features))
    cost = assigned.groupBy(*keys, "start").agg(half_up(F.sum("sq_distance") / float(MILLION) ** 2, 6).alias("_cost"))
    best = materialise(cost.groupBy(*keys).agg(F.min(F.struct("_cost", "start")).alias("_best")).select(*keys, "_best.start"))
    order = F.row_number().over(W.partitionBy(*keys).orderBy("centre", "cluster")).cast("bigint") - 1
    numbered = centres.join(broadcast_if_small(best), [*keys, "start"]).select(*keys, "start", "cluster", order.alias("_number"))
    out = assigned.join(broadcast_if_small(materialise(numbered)), [*keys, "start", "cluster"])
    return out.drop("start", "cluster").withColumnRenamed("_number", "cluster").withColumn("sq_distance", F.col("sq_distance") / float(MILLION) ** 2)


# --- logistic regression -----------------------------------------------------------------------------------------


def cells_by(rows: DataFrame, keys: Sequence[str], features: Sequence[str] = UPSELL_FEATURES) -> DataFrame:
    """Counted cells of equal features and label per store, with the features scaled by the store's rows."""
    cells = materialise(rows.groupBy(*keys, *features, "label").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    w = F.col("weight")
    sums = cells.groupBy(*keys).agg(F.sum(w).alias("_n"), *[x for c in features for x in (F.sum(w * F.col(c)).alias(f"_x_{c}"), F.sum(w * F.col(c) * F.col(c)).alias(f"_q_{c}"))])
    cells = cells.join(broadcast_if_small(materialise(sums)), list(keys))

    def scaled(c: str) -> Column:
        mean = F.col(f"_x_{c}") / F.col("_n")
        variance = F.greatest(F.col(f"_q_{c}") / F.col("_n") - mean * mean, F.lit(0.0))
        return (F.col(c) - mean) / F.when(variance > 1e-12, F.sqrt(variance)).otherwise(F.lit(1.0))

    return cells.select(*keys, "label", "weight", *[scaled(c).alias(f"z_{c}") for c in features])


def fit_logistic_by(
    rows: DataFrame, keys: Sequence[str] = ("store_id",), features: Sequence[str] = UPSELL_FEATURES, c: float = 1.0, max_iter: int = 40, tol: float = 1e-10
) -> DataFrame:
    """keys, feature, coefficient: a logistic regression with an L2 penalty of strength 1/c per store, on scaled features.

    Newton's steps of all stores go together: one aggregate over the cells gives every store's gradient and Hessian,
    a row each, and each row is solved. A store whose rows all have one label has no model and no rows here.
    """
    keys, names = list(keys), ["_one", *[f"z_{f}" for f in features]]
    size = len(names)
    cells = materialise(cells_by(rows, keys, features).withColumn("_one", F.lit(1.0)))
    both = cells.groupBy(*keys).agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a < _b")
    beta = materialise(both.select(*keys, F.array(*[F.lit(0.0)] * size).alias("beta"), F.lit(1e9).alias("moved")))
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    schema = ", ".join(f"`{k}` {t}" for k, t in beta.select(*keys).dtypes) + ", beta ARRAY<DOUBLE>, moved DOUBLE"
    rank_i, rank_j = np.array(upper).T

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if not len(part):
                continue
            b, sums = np.vstack(part["beta"]), np.vstack(part["sums"])
            ridge = np.r_[0.0, np.full(size - 1, 1.0 / c)]
            hessian = np.zeros((len(part), size, size))
            hessian[:, rank_i, rank_j] = sums[:, size:]
            hessian[:, rank_j, rank_i] = sums[:, size:]
            hessian += np.diag(ridge + 1e-12)
            step = np.linalg.solve(hessian, (sums[:, :size] + ridge * b)[:, :, None])[:, :, 0]
            # a long first step would overshoot where labels are nearly apart
            step *= np.minimum(1.0, 4.0 / np.maximum(np.abs(step).max(axis=1), 1e-300))[:, None]
            yield part[keys].assign(beta=list(b - step), moved=np.abs(step).max(axis=1))

    for _ in range(max_iter):
        met = cells.join(broadcast_if_small(beta.select(*keys, "beta")), keys)
        margin = reduce(lambda a, b: a + b, [F.col("beta")[i] * F.col(x) for i, x in enumerate(names)])
        met = met.withColumn("_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
        error, spread = F.col("weight") * (F.col("_p") - F.col("label")), F.col("weight") * F.col("_p") * (1 - F.col("_p"))
        sums = [F.sum(error * F.col(x)) for x in names] + [F.sum(spread * F.col(names[i]) * F.col(names[j])) for i, j in upper]
        asked = met.groupBy(*keys).agg(F.first("beta").alias("beta"), F.array(*sums).alias("sums"))
        beta = materialise(asked.mapInPandas(solve, schema))
        if (beta.agg(F.max("moved")).first()[0] or 0.0) < tol:
            break
    named = F.arrays_zip(F.lit(["intercept", *features]).alias("feature"), F.col("beta").alias("coefficient"))
    return beta.select(*keys, F.inline(named))
