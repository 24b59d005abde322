"""Customer table, standardised features, k-means segments, their profile, names and value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import half_up, mean, ratio
from comanda.params import MAX_SEGMENTS, MIN_VISITS
from comanda.session import materialise

FEATURES = ("visits", "avg_spend", "avg_drink_ratio", "avg_duration", "avg_hour")

# Segment names and what to do about them.
CORE, NIGHT, DINING, GENERAL = "核心常客", "夜間酒客", "餐點取向客", "一般客"
SEGMENT_NOTE = {
    CORE: "回訪頻率明顯高於其他群,是店的基本盤。維繫成本最低、CP 值最高 —— 記住他們的名字與慣點酒款,比任何折扣都有效",
    NIGHT: "入座時間晚、酒水佔比高、停留久。餐酒館真正的毛利來源,適合推新調酒與單杯精品酒;推餐點套餐對這群無效",
    DINING: "來吃飯而非喝酒,酒水佔比低、入座偏早、停留較短。對這群該推的是『餐酒搭配套餐』(把酒包進套餐降低決策門檻),而不是單點酒單",
    GENERAL: "消費模式無明顯特徵,可作為對照基準",
}


def per_customer(visits: DataFrame) -> DataFrame:
    """One row per customer: visits, means per visit, revenue and profit."""
    return (
        visits.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("visits"),
            mean("spend_per_head").alias("avg_spend"),
            mean("drink_ratio").alias("avg_drink_ratio"),
            mean("duration_min").alias("avg_duration"),
            mean("arrival_hour").alias("avg_hour"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_profit").alias("total_profit"),
        )
    )


def customer_table(visits: DataFrame, min_visits: int = MIN_VISITS) -> DataFrame:
    """Customers who came back; one visit says nothing about habits."""
    return per_customer(visits).filter(F.col("visits") >= min_visits)


def repeat_share(visits: DataFrame, min_visits: int = MIN_VISITS) -> DataFrame:
    """How many customers came back and their share of revenue."""
    customers = per_customer(visits)
    back = F.col("visits") >= min_visits
    repeat_revenue = F.sum(F.when(back, F.col("total_revenue")).otherwise(F.lit(0)))
    return customers.agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(back).alias("n_repeat"),
        half_up(ratio(repeat_revenue, F.sum("total_revenue")), 4).alias("repeat_revenue_share"),
    )


def standardise(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Each feature minus its mean over its population spread; a constant feature becomes zero."""
    stats = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("spread")).alias(c) for c in features]
    s = df.agg(F.struct(*stats)).scalar()
    df = df.withColumn("_stats", s)

    def scaled(c: str):
        spread = F.col(f"_stats.{c}.spread")
        return (F.col(c) - F.col(f"_stats.{c}.mean")) / F.when(spread > 0, spread).otherwise(F.lit(1.0))

    return df.withColumns({f"z_{c}": scaled(c) for c in features}).drop("_stats")


def feature_vectors(scaled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol="features")
    return assembler.transform(scaled)


@dataclass(frozen=True)
class Clustering:
    centres: list[list[float]]
    inertia: float


def fit_kmeans(
    points: DataFrame,
    ks: Sequence[int],
    n_init: int = 10,
    seed: int = 42,
    features: Sequence[str] = FEATURES,
    max_iter: int = 300,
    tol: float = 1e-4,
    parallel: int = 8,
) -> dict[int, Clustering]:
    """The best of `n_init` starts for every k. `points` must be a materialised table of standardised features.

    Starts are spread over the whole table by MLlib, `parallel` fits run at once; only centres reach the driver. More centres than rows are an error.
    """
    if max(ks) > (n := points.count()):
        raise ValueError(f"{max(ks)} segments asked of {n} rows")
    # not persisted here: MLlib holds the rows of a fit itself then, else every step decodes the persisted columns again
    vectors = feature_vectors(points, features).select("features")

    def fitted(start: tuple[int, int]) -> tuple[float, list[list[float]]]:
        model = KMeans(k=start[0], seed=seed + start[1], maxIter=max_iter, tol=tol).fit(vectors)
        return model.summary.trainingCost, [c.tolist() for c in model.clusterCenters()]

    starts = [(k, i) for k in ks for i in range(n_init)]
    with ThreadPool(parallel) as pool:
        fits = dict(zip(starts, pool.map(fitted, starts), strict=True))
    out = {}
    for k in ks:
        _, centres = min(fits[k, i] for i in range(n_init))
        cost = assign(points, centres, features).agg(F.sum("sq_distance")).first()[0]
        out[k] = Clustering(centres, float(cost))
    return out


def compare_k(points: DataFrame, found: dict[int, Clustering], features: Sequence[str] = FEATURES) -> list[tuple]:
    """(k, inertia, silhouette) of each clustering. The silhouette is the linear-time one on squared distances."""
    evaluator = ClusteringEvaluator(
        predictionCol="cluster", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    out = []
    for k, clustering in found.items():
        assigned = feature_vectors(assign(points, clustering.centres, features), features)
        out.append((k, clustering.inertia, float(evaluator.evaluate(assigned))))
    return out


def choose_k(
    points: DataFrame, ks: Sequence[int] = range(2, 8), n_init: int = 10, seed: int = 42, features: Sequence[str] = FEATURES
) -> list[tuple]:
    """(k, inertia, silhouette) of the best clustering for each k."""
    return compare_k(points, fit_kmeans(points, ks, n_init, seed, features), features)


def best_k(scores: list[tuple], most: int = MAX_SEGMENTS) -> int:
    """The k with the best silhouette, but not more segments than the floor can act on."""
    return min(max(scores, key=lambda s: (s[2], -s[0]))[0], most)


def assign(scaled: DataFrame, centres: Sequence[Sequence[float]], features: Sequence[str] = FEATURES) -> DataFrame:
    """Nearest of the given centres and the squared distance to it; the lower number on a tie."""
    points = [F.col(f"z_{c}") for c in features]

    def distance(centre: Sequence[float]):
        total = F.lit(0.0)
        for x, c in zip(points, centre):
            total = total + (x - F.lit(float(c))) * (x - F.lit(float(c)))
        return total

    nearest = F.least(*[F.struct(distance(c).alias("d"), F.lit(i).cast("bigint").alias("i")) for i, c in enumerate(centres)])
    return (
        scaled.withColumn("_nearest", nearest)
        .withColumns({"cluster": F.col("_nearest.i"), "sq_distance": F.col("_nearest.d")})
        .drop("_nearest")
    )


def silhouette(assigned: DataFrame, ids: Sequence[str] = ("customer_id",), features: Sequence[str] = FEATURES, per_cluster: int = 2000) -> DataFrame:
    """One row: n_rows, n_sampled, silhouette on plain distances, error_bound.

    Up to `per_cluster` rows of each cluster are drawn by a hash of their ids; a cluster with no more rows takes part
    whole, and if all do, the result is exact and the bound 0. Drawn rows are compared with the drawn rows of every
    cluster, a block per cluster, so the work is bounded by (clusters x per_cluster) squared distances. Clusters weigh by
    their true sizes. The bound holds with 95%: Hoeffding's for the means of the drawn rows' values, which lie in -1 to 1,
    plus twice the standard errors of their mean distances, relative to the larger one. `assigned` is a written table.
    """
    sizes = materialise(assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n")))
    hashed = assigned.join(F.broadcast(sizes), "cluster").withColumn("_hash", F.md5(F.concat_ws("|", *ids)))
    # only hashes low enough for about twice as many rows are sorted
    share = F.least(F.lit(1.0), F.lit(2.0 * (per_cluster + 100)) / F.col("_n"))
    low = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") <= share * F.lit(2.0**32)
    place = F.row_number().over(W.partitionBy("cluster").orderBy("_hash", *ids))
    point = F.array(*[F.col(f"z_{c}") for c in features])
    drawn = hashed.filter(low).withColumn("_place", place).filter(F.col("_place") <= per_cluster).select("cluster", "_n", point.alias("_point"))
    drawn = materialise(drawn)
    blocks = drawn.groupBy("cluster").agg(F.collect_list("_point").alias("_members")).withColumnRenamed("cluster", "_other")
    others = F.array([F.lit(r["cluster"]) for r in sizes.select("cluster").collect()])
    asked = drawn.repartition(len(features) * 8).withColumn("_uid", F.monotonically_increasing_id()).withColumn("_other", F.explode(others))

    def distance(m: Column) -> Column:
        return F.sqrt(reduce(lambda a, b: a + b, [(F.col("_point")[i] - m[i]) * (F.col("_point")[i] - m[i]) for i in range(len(features))]))

    far = F.transform("_members", distance)
    total = F.aggregate(far, F.lit(0.0), lambda a, d: a + d)
    squares = F.aggregate(far, F.lit(0.0), lambda a, d: a + d * d)
    met = asked.join(F.broadcast(blocks), "_other").select("_uid", "cluster", "_n", "_other", F.size("_members").alias("_m"), total.alias("_t"), squares.alias("_q"))
    own = F.col("cluster") == F.col("_other")
    seen = F.col("_m") - own.cast("int")
    mean = F.try_divide("_t", seen)
    error = F.sqrt(F.greatest(F.try_divide("_q", seen) - mean * mean, F.lit(0.0)) / seen)
    met = met.select("_uid", "cluster", "_n", own.alias("_own"), mean.alias("_mean"), error.alias("_error"))
    per_row = met.groupBy("_uid", "cluster", "_n").agg(
        F.max(F.when(F.col("_own"), F.struct("_mean", "_error"))).alias("a"), F.min(F.when(~F.col("_own"), F.struct("_mean", "_error"))).alias("b")
    )
    a, b = F.col("a._mean"), F.col("b._mean")
    top = F.greatest(a, b)
    value = F.when((F.col("_n") > 1) & b.isNotNull() & (top > 0), (b - a) / top).otherwise(F.lit(0.0))
    slack = F.when(top > 0, 2 * (F.col("a._error") + F.col("b._error")) / top).otherwise(F.lit(0.0))
    each = per_row.groupBy("cluster", "_n").agg(F.count(F.lit(1)).alias("_m"), F.avg(value).alias("_value"), F.avg(slack).alias("_slack"))
    n, k = F.sum("_n"), F.count(F.lit(1))
    drawn_only = F.col("_m") < F.col("_n")
    hoeffding = F.when(drawn_only, F.sqrt(F.lit(2.0) / F.col("_m"))).otherwise(F.lit(0.0))
    bound = F.sum(hoeffding * F.col("_n")) / n * F.sqrt(F.log(2 * k / F.lit(0.05))) + F.when(F.max(drawn_only.cast("int")) == 1, F.sum(F.col("_slack") * F.col("_n")) / n).otherwise(F.lit(0.0))
    return each.agg(n.alias("n_rows"), F.sum("_m").alias("n_sampled"), (F.sum(F.col("_value") * F.col("_n")) / n).alias("silhouette"), bound.alias("error_bound"))


def move_centres(assigned: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The means of the assigned rows: one step of the iteration."""
    means = [F.avg(f"z_{c}").alias(f"z_{c}") for c in features]
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *means)


def segment_profile(assigned: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Size, means and profit of each segment, to two decimals."""
    means = {
        "avg_visits": "visits",
        "avg_spend": "avg_spend",
        "avg_drink_ratio": "avg_drink_ratio",
        "avg_duration": "avg_duration",
        "avg_hour": "avg_hour",
    }
    return assigned.groupBy(*keys, "cluster").agg(
        F.count(F.lit(1)).alias("n_customers"),
        *[half_up(F.avg(c), 2).alias(name) for name, c in means.items()],
        F.round(F.sum("total_profit"), 2).alias("total_profit"),
    )


def name_segments(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Names by comparing segments: most visits, then of the rest the highest and the lowest drink ratio."""

    def first(df: DataFrame, order, name: str) -> DataFrame:
        unnamed = F.col("segment").isNull()
        place = F.row_number().over(W.partitionBy(*keys).orderBy(unnamed.desc(), order, "cluster"))
        return df.withColumn("segment", F.when(unnamed & (place == 1), name).otherwise(F.col("segment")))

    df = profile.withColumn("segment", F.lit(None).cast("string"))
    df = first(df, F.desc("avg_visits"), CORE)
    df = first(df, F.desc("avg_drink_ratio"), NIGHT)
    df = first(df, F.asc("avg_drink_ratio"), DINING)
    return df.withColumn("segment", F.coalesce("segment", F.lit(GENERAL)))


def segment_value(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of profit over share of customers. The profile has a handful of rows per key."""
    per_key = W.partitionBy(*keys)
    profit = ratio("total_profit", F.sum("total_profit").over(per_key))
    people = ratio("n_customers", F.sum("n_customers").over(per_key))
    return profile.withColumns(
        {
            "profit_share": half_up(profit, 4),
            "customer_share": half_up(people, 4),
            "value_multiple": half_up(F.try_divide(profit, people), 2),
        }
    )


def covariance(scaled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Sample covariance of the standardised features, one row per pair, in one pass."""
    pairs = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.covar_samp(f"z_{a}", f"z_{b}").alias("cov"))
        for i, a in enumerate(features)
        for b in list(features)[i:]
    ]
    return scaled.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def principal_components(vectors: DataFrame, k: int = 2):
    """PCA model on standardised vectors with the variance share of its components."""
    return PCA(k=k, inputCol="features", outputCol="pc").fit(vectors)


def project(vectors: DataFrame, model) -> DataFrame:
    """Coordinates on the components; the sign is set so that each component's largest loading is positive."""
    loadings = model.pc.toArray()
    out, coordinates = model.transform(vectors), {}
    for j in range(loadings.shape[1]):
        column = loadings[:, j]
        sign = 1.0 if column[abs(column).argmax()] >= 0 else -1.0
        coordinates[f"pc{j + 1}"] = vector_to_array("pc")[j] * F.lit(sign)
    return out.withColumns(coordinates).drop("pc")
