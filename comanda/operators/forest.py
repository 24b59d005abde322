"""Isolation forests per store: many small forests in one job.

A row's draw for a tree is linear in two halves of one hash of its ids, so a row is hashed once for all trees. A tree takes the rows
of the lowest draws of its store, and a cut its feature and place from a hash of store, tree and node: a forest depends
on the rows alone. Nodes are numbered as in a heap, and paths are whole billionths, so sums don't depend on row order.

Trees grow in groups of at most `rows` rows by (store, tree). Scoring brings the rows of a store and its nodes together; a
large store's rows are dealt over several groups, each with a copy of its nodes (at most trees x 2 x rows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from comanda.functions.exprs import half_up
from comanda.functions.ordered import exact_quantile
from comanda.operators.anomaly import FEATURES, anomaly_features, expected_path
from comanda.operators.stocktake import LEVEL_HIGH
from comanda.params import ANOMALY_CONTAMINATION, ANOMALY_MIN_ROWS
from comanda.session import broadcast_if_small, materialise

# Paths are counted in billionths.
UNIT = 1_000_000_000
# Draws lie below this prime.
DRAWS = 2**31 - 1
ROWS_PER_TASK = 100_000
NODES = "tree INT, node BIGINT, feature INT, threshold DOUBLE, path BIGINT"


def _hex(text: Column, start: int) -> Column:
    return F.conv(F.substring(text, start, 8), 16, 10).cast("bigint")


def path_units(n: int) -> int:
    return round(UNIT * expected_path(n))


def store_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))


def store_samples(df: DataFrame, sizes: DataFrame, keys: Sequence[str], ids: Sequence[str], features: Sequence[str], trees: int, rows: int, place: str = "") -> DataFrame:
    """`rows` rows for each tree of each store, those of the lowest draws, ties by the ids; numbered from 1 in `place`, if named.

    Only draws low enough for about twice as many rows are sorted, so a window of a tree sees no more than that.
    """
    hashed = df.join(broadcast_if_small(sizes), list(keys)).withColumn("_md5", F.md5(F.concat_ws("|", *ids)))
    share = F.least(F.lit(1.0), F.lit(2.0 * (rows + 100)) / F.col("_n"))
    hashed = hashed.select(*{*keys, *ids, *features}, _hex(F.col("_md5"), 1).alias("_a"), _hex(F.col("_md5"), 9).alias("_b"), (share * DRAWS).alias("_most"))
    # the halves are read from the hash below the explode, so once per row, not once per tree
    each = hashed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    each = each.withColumn("draw", F.pmod(F.col("_a") * (F.col("tree") + 1) + F.col("_b"), F.lit(DRAWS))).filter(F.col("draw") <= F.col("_most"))
    each = each.select(*keys, *ids_beside(ids, keys), *features, "tree", "draw")
    numbered = each.withColumn(place or "_place", F.row_number().over(W.partitionBy(*keys, "tree").orderBy("draw", *ids)))
    return numbered.filter(F.col(place or "_place") <= rows).select(*keys, "tree", *features, *([place] if place else []))


def ids_beside(ids: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [c for c in ids if c not in keys]


def grow(store: str, tree: int, x: np.ndarray) -> list[tuple]:
    """(tree, node, feature, threshold, path) of one tree over its rows; a leaf has feature -1."""
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    out, pending = [], [(1, 0, x)]
    while pending:
        node, depth, rows = pending.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(varying):
            out.append((tree, node, -1, 0.0, depth * UNIT + path_units(len(rows))))
            continue
        digest = hashlib.md5(f"{store}|{tree}|{node}".encode()).hexdigest()
        feature = int(varying[int(digest[:8], 16) % len(varying)])
        cut = float(low[feature] + int(digest[8:16], 16) / 2.0**32 * (high[feature] - low[feature]))
        out.append((tree, node, feature, cut, 0))
        below = rows[:, feature] <= cut
        pending += [(2 * node, depth + 1, rows[below]), (2 * node + 1, depth + 1, rows[~below])]
    return out


def fit_forests(
    df: DataFrame, sizes: DataFrame, keys: Sequence[str] = ("store_id",), ids: Sequence[str] = ("store_id", "sku_id"),
    features: Sequence[str] = FEATURES, trees: int = 100, rows: int = 256,
) -> DataFrame:
    """Nodes of every store's forest. `df` and `sizes` are written tables."""
    names, features = list(keys), list(features)
    schema = ", ".join(f"`{k}` {t}" for k, t in df.select(*names).dtypes) + ", " + NODES

    def one(sample: pd.DataFrame) -> pd.DataFrame:
        first = sample.iloc[0]
        store = "|".join(str(first[k]) for k in names)
        nodes = pd.DataFrame(grow(store, int(first["tree"]), sample[features].to_numpy(dtype=float)), columns=["tree", "node", "feature", "threshold", "path"])
        for i, k in enumerate(names):
            nodes.insert(i, k, first[k])
        return nodes

    samples = store_samples(df, sizes, names, ids, features, trees, rows)
    return samples.groupBy(*names, "tree").applyInPandas(one, schema)


def walk(x: np.ndarray, nodes: pa.Table) -> np.ndarray:
    """Sum of the rows' paths over the trees of `nodes`."""
    total, every = np.zeros(len(x), np.int64), np.arange(len(x))
    tree, node, feature, threshold, path = (nodes.column(c).to_numpy() for c in ("tree", "node", "feature", "threshold", "path"))
    size = int(node.max()) + 1
    for t in np.unique(tree):
        at = tree == t
        f, c, p = np.full(size, -1), np.zeros(size), np.zeros(size, np.int64)
        f[node[at]], c[node[at]], p[node[at]] = feature[at], threshold[at], path[at]
        place = np.ones(len(x), np.int64)
        while (inner := f[place] >= 0).any():
            asked = np.where(inner, f[place], 0)
            place = np.where(inner, 2 * place + (x[every, asked] > c[place]), place)
        total += p[place]
    return total


def path_sums(df: DataFrame, nodes: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES, out: str = "path_sum", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add the sum of each row's paths over the trees of its store; rows of stores without nodes are left out.

    `df` and `nodes` are written tables. A store with more than `rows_per_task` rows is dealt over several groups.
    """
    keys, features, columns = list(keys), list(features), df.columns
    deals = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("_deals"))
    deals = broadcast_if_small(materialise(deals.join(nodes.select(*keys).distinct(), keys)))
    dealt = df.join(deals, keys).withColumn("_deal", F.pmod(F.xxhash64(*columns), "_deals").cast("int")).drop("_deals")
    copies = nodes.join(deals, keys).withColumn("_deal", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1))).drop("_deals")

    def one(rows: pa.Table, forest: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        x = np.column_stack([rows.column(f).to_numpy().astype(float) for f in features])
        return rows.select(columns).append_column(out, pa.array(walk(x, forest), pa.int64())).cast(schema)

    done = df.withColumn(out, F.lit(0).cast("bigint")).schema
    schema = to_arrow_schema(done)
    return dealt.groupBy(*keys, "_deal").cogroup(copies.groupBy(*keys, "_deal")).applyInArrow(one, done)


def anomaly_margin(df: DataFrame, contamination: float, keys: Sequence[str]) -> DataFrame:
    """Add `score` (minus the anomaly score, to nine digits) less the store's quantile of the expected share, as `margin`."""
    offsets = exact_quantile(df, "score", contamination, by=keys).withColumnRenamed("quantile", "_offset")
    return df.join(broadcast_if_small(materialise(offsets)), list(keys)).withColumn("margin", F.col("score") - F.col("_offset")).drop("_offset")


def detect_anomalies_by(
    df: DataFrame, keys: Sequence[str] = ("store_id",), ids: Sequence[str] = ("store_id", "sku_id"), contamination: float = ANOMALY_CONTAMINATION,
    min_rows: int = ANOMALY_MIN_ROWS, trees: int = 100, rows: int = 256, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Anomaly score and flag of every row against its own store; flagged rows get the high alert level.

    A store with fewer than `min_rows` rows is too small: no score, no flag. The score is relative to the store's
    quantile of the expected share of anomalies, so negative means flagged. `ids` tell rows apart.
    """
    table = materialise(anomaly_features(df))
    sizes = store_sizes(table, keys)
    enough = materialise(sizes.filter(F.col("_n") >= min_rows))
    nodes = materialise(fit_forests(table, enough, keys, ids, FEATURES, trees, rows))
    summed = path_sums(table, nodes, keys, FEATURES, "_sum", rows_per_task)
    # the mean path of a search in a sample, by its size
    scale = F.element_at(F.lit([path_units(n) / UNIT for n in range(1, rows + 1)]), F.least(F.col("_n"), F.lit(rows)).cast("int"))
    mean_path = F.col("_sum") / F.lit(float(UNIT)) / F.lit(float(trees))
    scored = summed.join(broadcast_if_small(enough), list(keys)).withColumn("score", half_up(-F.pow(F.lit(2.0), -(mean_path / scale)), 9))
    judged = anomaly_margin(materialise(scored.drop("_sum", "_n")), contamination, keys)
    flag = F.col("margin") < 0
    judged = judged.withColumns({"anomaly_score": half_up("margin", 4), "anomaly_flag": flag, "alert_level": F.when(flag, LEVEL_HIGH).otherwise(F.col("alert_level"))})
    small = table.join(broadcast_if_small(enough.select(*keys)), list(keys), "left_anti")
    small = small.withColumns({"anomaly_score": F.lit(None).cast("double"), "anomaly_flag": F.lit(False)})
    return judged.drop("score", "margin").unionByName(small)
