"""Which tables will drink: features known at seating, split, models, scores, measures and actions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import const, half_up, mean, ratio, tier
from comanda.functions.ordered import ROWS_PER_TASK, running_total
from comanda.params import DRINK_RATIO_TARGET, UPSELL_FEATURES


def upsell_features(visits: DataFrame, target: str = DRINK_RATIO_TARGET) -> DataFrame:
    """Label and the features known when the table is seated; length of stay and order are not among them."""
    label = (F.col("drink_ratio") >= const(target)).cast("bigint")
    return visits.select("visit_id", *UPSELL_FEATURES, label.alias("label"))


def stratified_split(rows: DataFrame, test_share: str = "0.25", id_col: str = "visit_id") -> DataFrame:
    """Exact share of each label for the test set, the same on every run: rows in the order of a hash of the id.

    Rows are ranked within 65,536 hash buckets per label and the buckets are counted, so a label is never sorted
    in one task.
    """
    hashed = rows.withColumn("_hash", F.md5(F.col(id_col).cast("string")))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, 4))
    counts = hashed.groupBy("label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy("label").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(upto), F.lit(0)),
            "_wanted": F.round(F.sum("_n").over(W.partitionBy("label")) * const(test_share), 0).cast("bigint"),
        }
    ).drop("_n")
    place = F.row_number().over(W.partitionBy("label", "_bucket").orderBy("_hash", id_col))
    ranked = hashed.withColumn("_place", place).join(counts, ["label", "_bucket"])
    is_test = (F.col("_before") + F.col("_place") <= F.col("_wanted")).cast("bigint")
    return ranked.withColumn("is_test", is_test).drop("_hash", "_bucket", "_before", "_wanted", "_place")


def cells(rows: DataFrame, features: Sequence[str] = UPSELL_FEATURES) -> DataFrame:
    """Rows with equal features and label counted together. The features take few values, so however many visits
    there are, the models are fitted on some hundreds of weighted rows."""
    return rows.groupBy(*features, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def one_part(weighted: DataFrame, features: Sequence[str] = UPSELL_FEATURES) -> DataFrame:
    """The cells, in order, in one cached partition for the steps of a fit. They are summed in the tasks of their own
    shuffle before: a single task would hold a hash table for each of its partitions."""
    return weighted.repartition(1).sortWithinPartitions(*features, "label").cache()


@dataclass(frozen=True)
class Scaling:
    mean: dict[str, float]
    spread: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"z_{c}": (F.col(c) - F.lit(m)) / F.lit(self.spread[c]) for c, m in self.mean.items()})


def fit_scaling(weighted: DataFrame, features: Sequence[str] = UPSELL_FEATURES) -> tuple[Scaling, float]:
    """Means and population spreads of the training rows, and how many there are."""
    w = F.col("weight")
    sums = [F.sum(w)] + [x for c in features for x in (F.sum(w * F.col(c)), F.sum(w * F.col(c) * F.col(c)))]
    row = weighted.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    n = row[0]
    mean_of, spread = {}, {}
    for i, c in enumerate(features):
        m = row[1 + 2 * i] / n
        variance = max(row[2 + 2 * i] / n - m * m, 0.0)
        mean_of[c], spread[c] = m, variance**0.5 or 1.0
    return Scaling(mean_of, spread), n


@dataclass(frozen=True)
class LogisticModel:
    scaling: Scaling
    coefficients: dict[str, float]
    intercept: float

    def margin(self) -> Column:
        total = F.lit(self.intercept)
        for c, beta in self.coefficients.items():
            z = (F.col(c) - F.lit(self.scaling.mean[c])) / F.lit(self.scaling.spread[c])
            total = total + F.lit(beta) * z
        return total


def fit_logistic(train: DataFrame, features: Sequence[str] = UPSELL_FEATURES, c: float = 1.0) -> LogisticModel:
    """Logistic regression with an L2 penalty of strength 1/c on features scaled by the training rows."""
    weighted = one_part(cells(train, features), features)
    scaling, n = fit_scaling(weighted, features)
    scaled = VectorAssembler(inputCols=[f"z_{f}" for f in features], outputCol="features").transform(
        scaling.apply(weighted)
    )
    fitted = LogisticRegression(
        weightCol="weight",
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=1e-12,
    ).fit(scaled)
    weighted.unpersist()
    return LogisticModel(scaling, dict(zip(features, (float(b) for b in fitted.coefficients))), float(fitted.intercept))


def score(rows: DataFrame, model: LogisticModel) -> DataFrame:
    """Probability and class for each visit, as plain column expressions."""
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin()))
    return rows.withColumn("prob", prob).withColumn("pred", (F.col("prob") >= 0.5).cast("bigint"))


def coefficient_table(train: DataFrame, model: LogisticModel) -> DataFrame:
    rows = [(f, b) for f, b in model.coefficients.items()]
    return train.sparkSession.createDataFrame(rows, "feature STRING, coefficient DOUBLE")


def odds_ratios(coefficients: DataFrame) -> DataFrame:
    """How much one standard step of a feature multiplies the odds."""
    return coefficients.select(
        "feature", half_up("coefficient", 3).alias("coefficient"), half_up(F.exp("coefficient"), 3).alias("odds_ratio")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    table = scored.groupBy("label").pivot("pred", [0, 1]).agg(F.count(F.lit(1)))
    return table.select("label", F.coalesce("0", F.lit(0)).alias("pred_0"), F.coalesce("1", F.lit(0)).alias("pred_1"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, plain and weighted means, in one pass."""
    counts = {
        (a, b): F.count_if((F.col("label") == a) & (F.col("pred") == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)
    }
    n = scored.agg(*counts.values())

    def of_class(k: int) -> tuple[Column, Column, Column, Column]:
        hit, wrong, missed = F.col(f"n{k}{k}"), F.col(f"n{1 - k}{k}"), F.col(f"n{k}{1 - k}")
        zero = F.lit(0.0)
        precision = F.coalesce(ratio(hit, hit + wrong), zero)
        recall = F.coalesce(ratio(hit, hit + missed), zero)
        f1 = F.coalesce(ratio(hit * 2, hit * 2 + wrong + missed), zero)
        return precision, recall, f1, hit + missed

    zero, one = of_class(0), of_class(1)
    total = zero[3] + one[3]
    accuracy = ratio(F.col("n00") + F.col("n11"), total)
    weighted = [(a * zero[3] + b * one[3]) / total for a, b in zip(zero[:3], one[:3])]
    rows = {
        "0": zero,
        "1": one,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": (*[(a + b) / 2 for a, b in zip(zero[:3], one[:3])], total),
        "weighted avg": (*weighted, total),
    }
    lines = [
        F.struct(
            F.lit(name).alias("name"),
            half_up(p, 3).alias("precision"),
            half_up(r, 3).alias("recall"),
            half_up(f, 3).alias("f1"),
            s.alias("support"),
        )
        for name, (p, r, f, s) in rows.items()
    ]
    return n.select(F.inline(F.array(*lines)))


def per_score(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """Positives and negatives per distinct score: far fewer rows than visits."""
    return scored.groupBy(half_up(prob, 9).alias("threshold")).agg(
        F.sum("label").alias("pos"), F.sum(F.lit(1) - F.col("label")).alias("neg")
    )


def auc(scored: DataFrame, prob: str = "prob", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in the right order, ties as half."""
    ranked = running_total(per_score(scored, prob), "neg", [F.asc("threshold")], out="_upto", rows_per_task=rows_per_task)
    below = F.col("_upto") * 2 - F.col("neg")
    won = F.sum((F.col("pos") * below).cast("decimal(38,0)"))
    pairs = F.sum("pos").cast("decimal(19,0)") * F.sum("neg").cast("decimal(19,0)") * 2
    return ranked.agg(half_up(ratio(won, pairs), 6).alias("auc"))


def roc_curve(scored: DataFrame, prob: str = "prob", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """False and true positive rate at each distinct score taken as the threshold."""
    order = [F.desc("threshold")]
    ranked = running_total(per_score(scored, prob), "pos", order, out="tp", rows_per_task=rows_per_task)
    ranked = running_total(ranked, "neg", order, out="fp", rows_per_task=rows_per_task)
    totals = ranked.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    return ranked.select(
        "threshold",
        "tp",
        "fp",
        half_up(ratio("fp", totals["neg"]), 6).alias("fpr"),
        half_up(ratio("tp", totals["pos"]), 6).alias("tpr"),
    )


def fit_tree(train: DataFrame, features: Sequence[str] = UPSELL_FEATURES, depth: int = 4, min_leaf: int = 40):
    """Tree on the raw features with at least `min_leaf` rows per leaf; its prediction is the probability.

    The variance of a 0/1 label is half its Gini impurity, so the regression tree splits as the classifier would,
    but keeps leaves apart that differ in probability and not in class. The rows are weighted cells, so the leaf
    size is a share of the weight.
    """
    weighted = one_part(cells(train, features), features)
    n, *distinct = weighted.agg(F.sum("weight"), *[F.count_distinct(f) for f in features]).first()
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(weighted)
    model = DecisionTreeRegressor(
        labelCol="label",
        weightCol="weight",
        maxDepth=depth,
        minInstancesPerNode=1,
        minWeightFractionPerNode=min((min_leaf - 0.5) / n, 0.499),
        maxBins=max(2, *distinct),  # no value shares a bin
        seed=42,
    ).fit(vectors)
    weighted.unpersist()
    return model


def score_tree(rows: DataFrame, model, features: Sequence[str] = UPSELL_FEATURES) -> DataFrame:
    out = model.transform(VectorAssembler(inputCols=list(features), outputCol="features").transform(rows))
    return out.withColumnRenamed("prediction", "prob").drop("features")


def model_choice(auc_logistic: DataFrame, auc_tree: DataFrame) -> DataFrame:
    """The logistic model unless the tree is better: its odds can be explained on the floor."""
    return auc_logistic.select(F.col("auc").alias("auc_logistic"), auc_tree.select("auc").scalar().alias("auc_tree")).withColumn(
        "chosen", F.when(F.col("auc_logistic") >= F.col("auc_tree"), "logistic").otherwise("tree")
    )


def action_grid(scored_visits: DataFrame) -> DataFrame:
    """Early and late, new and returning: how many tables, how likely to drink, what they spend, the best cell."""
    grid = scored_visits.groupBy("is_buzz_hour", "is_repeat").agg(
        F.count(F.lit(1)).alias("n_visits"),
        half_up(F.avg("prob"), 4).alias("avg_prob"),
        half_up(mean("drink_ratio"), 4).alias("avg_drink_ratio"),
        half_up(mean("spend_per_head"), 0).alias("avg_spend_per_head"),
    )
    cell = F.struct("avg_spend_per_head", -F.col("is_buzz_hour"), -F.col("is_repeat"))
    best = grid.agg(F.max_by(F.struct("is_buzz_hour", "is_repeat"), cell)).scalar()
    return grid.withColumn("is_best", F.struct("is_buzz_hour", "is_repeat") == best)


def potential_tier(prob: Column | str) -> Column:
    """How actively to offer drinks."""
    return tier(prob, [(">=", F.lit(0.6), "high"), (">=", F.lit(0.4), "medium")], "low")
