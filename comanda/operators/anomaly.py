"""Isolation forest over stock-count features: trees grown in parallel on small samples, rows scored where they are."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from comanda.functions.exprs import half_up, ratio
from comanda.functions.ordered import exact_quantile
from comanda.operators.stocktake import LEVEL_HIGH
from comanda.params import ANOMALY_CONTAMINATION, ANOMALY_MIN_ROWS
from comanda.session import materialise

FEATURES = ("variance_ratio_feature", "waste_qty_ratio", "category_code")
NODE_SCHEMA = "tree INT, node INT, feature INT, threshold DOUBLE, yes INT, no INT, path DOUBLE"


def anomaly_features(df: DataFrame) -> DataFrame:
    """Variance ratio and its size (zero where unknown) and the category's place in the alphabet of categories."""
    categories = df.agg(F.array_sort(F.collect_set("category"))).scalar()
    return df.withColumns(
        {
            "variance_ratio_feature": F.coalesce("variance_ratio", F.lit(0.0)),
            "waste_qty_ratio": F.coalesce(ratio(F.abs("variance_qty"), "theoretical_usage"), F.lit(0.0)),
            "category_code": (F.array_position(categories, F.col("category")) - 1).cast("double"),
        }
    )


def expected_path(n: float) -> float:
    """Mean path of an unsuccessful search in a tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_tree(sample: pd.DataFrame, features: Sequence[str]) -> pd.DataFrame:
    """One tree over its sample: random feature, random cut, until rows are alone or the depth is used up."""
    tree = int(sample["tree"].iloc[0])
    rng = np.random.default_rng(tree)
    x = sample.sort_values("place")[list(features)].to_numpy(dtype=float)
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list] = []
    pending = [(x, 0, -1, False)]
    while pending:
        rows, depth, parent, yes_side = pending.pop()
        node = len(nodes)
        nodes.append([tree, node, -1, 0.0, -1, -1, depth + expected_path(len(rows))])
        if parent >= 0:
            nodes[parent][4 if yes_side else 5] = node
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(varying):
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = rows[:, feature] <= cut
        nodes[node][2:4] = [feature, cut]
        pending.append((rows[~below], depth + 1, node, False))
        pending.append((rows[below], depth + 1, node, True))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "yes", "no", "path"])


def tree_samples(df: DataFrame, ids: Sequence[str], features: Sequence[str], trees: int, rows: int) -> DataFrame:
    """A sample of `rows` rows for each tree, drawn from the whole table, the same on every run.

    A row's draw for a tree is a hash of the tree, its ids and its features; a tree takes the rows of the lowest
    draws. One scan keeps the draws low enough for about twice as many rows, so a tree's task sees no more than
    that. `df` is counted: pass a written table.
    """
    share = min(1.0, 2.0 * (rows + 100) / max(df.count(), 1))
    keyed = df.select(*features, F.xxhash64(*ids, *features).alias("_key"))
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.shiftrightunsigned(F.xxhash64(t, F.col("_key")), 1).alias("draw")),
    )
    low = F.filter(draws, lambda d: d["draw"] <= F.lit(int(share * (2**63 - 1024))))
    each = keyed.select(*features, F.explode(low).alias("_d")).select(*features, "_d.tree", "_d.draw")
    order = W.partitionBy("tree").orderBy("draw", *features)
    return each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows).drop("draw")


def fit_forest(df: DataFrame, ids: Sequence[str], features: Sequence[str] = FEATURES, trees: int = 100, rows: int = 256):
    """Nodes of the forest as a table: at most trees x 2 x rows of them, whatever the size of the data."""
    names = list(features)
    samples = tree_samples(df, ids, names, trees, rows)
    return samples.groupBy("tree").applyInPandas(lambda s: grow_tree(s, names), NODE_SCHEMA)


def score_rows(df: DataFrame, forest: pd.DataFrame, sample_rows: int, features: Sequence[str] = FEATURES) -> DataFrame:
    """Add `score`: minus the anomaly score, so that the lowest are the oddest."""
    arrays = [
        tuple(t.sort_values("node")[c].to_numpy() for c in ("feature", "threshold", "yes", "no", "path"))
        for _, t in forest.groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    scale = expected_path(sample_rows)

    @F.pandas_udf("double")
    def score(columns: pd.DataFrame) -> pd.Series:
        x = columns.to_numpy(dtype=float)
        every = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, threshold, yes, no, path in shared.value:
            node = np.zeros(len(x), dtype=int)
            while True:
                split = feature[node] >= 0
                if not split.any():
                    break
                f = np.where(split, feature[node], 0)
                go = np.where(x[every, f] <= threshold[node], yes[node], no[node])
                node = np.where(split, go, node)
            total += path[node]
        return pd.Series(-np.power(2.0, -total / len(shared.value) / scale))

    return df.withColumn("score", score(F.struct(*features)))


def detect_anomalies(
    df: DataFrame,
    ids: Sequence[str] = ("store_id", "sku_id"),
    contamination: float = ANOMALY_CONTAMINATION,
    min_rows: int = ANOMALY_MIN_ROWS,
    trees: int = 100,
    rows: int = 256,
) -> DataFrame:
    """Anomaly score and flag; flagged rows get the high alert level.

    Tables with fewer than `min_rows` rows are too small for this: no score, no flag. The score is relative to the
    quantile of the expected share of anomalies, so negative means flagged. Grows the forest when called.
    """
    table = materialise(anomaly_features(df))
    n = table.count()
    if n < min_rows:
        return table.withColumns({"anomaly_score": F.lit(None).cast("double"), "anomaly_flag": F.lit(False)})
    forest = fit_forest(table, ids, FEATURES, trees, rows).toPandas()
    scored = materialise(score_rows(table, forest, min(n, rows)))
    offset = exact_quantile(scored, "score", contamination).scalar()
    margin = F.col("score") - F.col("_offset")
    out = scored.withColumn("_offset", offset)
    out = out.withColumns({"anomaly_score": half_up(margin, 4), "anomaly_flag": margin < 0})
    return out.withColumn(
        "alert_level", F.when(F.col("anomaly_flag"), LEVEL_HIGH).otherwise(F.col("alert_level"))
    ).drop("score", "_offset")
