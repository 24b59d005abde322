"""Customer segments and drink potential over the driver tables, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from comanda.functions.exprs import half_up
from comanda.operators import by_store, segment, upsell
from comanda.params import UPSELL_FEATURES
from comanda.plans import basket_queries
from comanda.plans.queries import query
from comanda.session import materialise, new_folder
from comanda.sources import binding
from comanda.streaming import jobs

# Centres to assign to, in standard units of the features, for the part of k-means that does not iterate.
CENTRES = [
    [1.0, 0.2, 0.3, 0.3, 0.0],
    [-0.5, 0.8, 0.9, 0.4, 0.5],
    [-0.4, -0.6, -0.8, -0.4, -0.3],
    [0.0, -0.2, 0.4, -0.9, 0.2],
]

# Given coefficients, for the part of the model that does not fit.
GIVEN_MODEL = upsell.LogisticModel(
    upsell.Scaling(
        dict(zip(UPSELL_FEATURES, (2.3, 13.0, 0.2, 0.3, 0.9))), dict(zip(UPSELL_FEATURES, (1.1, 6.5, 0.4, 0.45, 0.3)))
    ),
    dict(zip(UPSELL_FEATURES, (-0.31, 0.127, 0.411, 0.083, -0.219))),
    -0.173,
)


def customers(spark, sf_dir):
    return segment.customer_table(binding.visits(spark, sf_dir))


def scaled(spark, sf_dir):
    return segment.standardise(materialise(customers(spark, sf_dir)))


def points(spark, sf_dir):
    """The standardised customers, written once for what reads them again and again."""
    return materialise(scaled(spark, sf_dir))


def assigned(spark, sf_dir):
    return segment.assign(scaled(spark, sf_dir), CENTRES)


@query("customer_table")
def customer_table(spark, sf_dir):
    rounded = {c: half_up(c, 6) for c in segment.FEATURES if c != "visits"}
    return customers(spark, sf_dir).withColumns(rounded)


@query("repeat_share")
def repeat_share(spark, sf_dir):
    return segment.repeat_share(binding.visits(spark, sf_dir))


@query("customer_scaled")
def customer_scaled(spark, sf_dir):
    names = [f"z_{c}" for c in segment.FEATURES]
    return scaled(spark, sf_dir).select("customer_id", *[half_up(c, 6).alias(c) for c in names])


@query("choose_k")
def choose_k(spark, sf_dir):
    scores = segment.choose_k(points(spark, sf_dir))
    chosen = segment.best_k(scores)
    rows = [(k, round(inertia, 1), round(s, 4), k == chosen) for k, inertia, s in scores]
    return spark.createDataFrame(rows, "k BIGINT, inertia DOUBLE, silhouette DOUBLE, chosen BOOLEAN")


@query("kmeans_segments")
def kmeans_segments(spark, sf_dir):
    rows = points(spark, sf_dir)
    found = segment.fit_kmeans(rows, range(2, 8))
    best = found[segment.best_k(segment.compare_k(rows, found))]
    return segment.assign(rows, best.centres).select("customer_id", "cluster")


def store_of(customer):
    """The store a customer counts for, as these tables have no home store."""
    return F.concat(F.lit("ST"), (customer % 5).cast("string"))


@query("kmeans_by_store")
def kmeans_by_store(spark, sf_dir):
    rows = materialise(customers(spark, sf_dir).withColumn("store_id", store_of(F.col("customer_id"))))
    found = by_store.kmeans_by(materialise(by_store.standardise_by(rows, ["store_id"])), 3, max_iter=12)
    return found.select("store_id", "customer_id", "cluster", half_up("sq_distance", 6).alias("sq_distance"))


@query("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    return assigned(spark, sf_dir).select("customer_id", "cluster", half_up("sq_distance", 6).alias("sq_distance"))


def by_fixed_centres(spark, sf_dir, measure):
    """(k, ...) of `measure` for the first two, three and four of the fixed centres."""
    rows = points(spark, sf_dir)
    each = [measure(materialise(segment.assign(rows, CENTRES[:k]))).withColumn("k", F.lit(k)) for k in (2, 3, 4)]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("inertia_fixed")
def inertia_fixed(spark, sf_dir):
    return by_fixed_centres(spark, sf_dir, lambda rows: rows.agg(half_up(F.sum("sq_distance"), 4).alias("inertia")))


@query("silhouette_fixed")
def silhouette_fixed(spark, sf_dir):
    found = by_fixed_centres(spark, sf_dir, segment.silhouette)
    return found.select("k", "n_rows", "n_sampled", half_up("silhouette", 4).alias("silhouette"), (F.col("error_bound") == 0).alias("exact"))


@query("kmeans_update")
def kmeans_update(spark, sf_dir):
    moved = segment.move_centres(assigned(spark, sf_dir))
    return moved.withColumns({f"z_{c}": half_up(f"z_{c}", 6) for c in segment.FEATURES})


@query("segment_profile")
def segment_profile(spark, sf_dir):
    return segment.segment_profile(assigned(spark, sf_dir))


@query("segment_names")
def segment_names(spark, sf_dir):
    named = segment.name_segments(segment.segment_profile(assigned(spark, sf_dir)))
    return named.select("cluster", "n_customers", "avg_visits", "avg_drink_ratio", "segment")


@query("segment_value")
def segment_value(spark, sf_dir):
    valued = segment.segment_value(segment.segment_profile(assigned(spark, sf_dir)))
    return valued.select("cluster", "n_customers", "total_profit", "profit_share", "customer_share", "value_multiple")


@query("customer_pca")
def customer_pca(spark, sf_dir):
    rows = segment.feature_vectors(points(spark, sf_dir))
    model = segment.principal_components(rows)
    shares = [float(v) for v in model.explainedVariance]
    return segment.project(rows, model).select(
        "customer_id",
        half_up("pc1", 6).alias("pc1"),
        half_up("pc2", 6).alias("pc2"),
        half_up(F.lit(shares[0]), 6).alias("variance_share_1"),
        half_up(F.lit(shares[1]), 6).alias("variance_share_2"),
    )


@query("customer_cov")
def customer_cov(spark, sf_dir):
    return segment.covariance(scaled(spark, sf_dir)).withColumn("cov", half_up("cov", 6))


# --- drink potential ---------------------------------------------------------------------------------------------


def features(spark, sf_dir):
    return upsell.upsell_features(binding.visits(spark, sf_dir))


def split(spark, sf_dir):
    return upsell.stratified_split(materialise(features(spark, sf_dir)))


def train_and_test(spark, sf_dir):
    rows = materialise(split(spark, sf_dir))
    return rows.filter("is_test = 0"), rows.filter("is_test = 1")


def scored(spark, sf_dir):
    return upsell.score(features(spark, sf_dir), GIVEN_MODEL)


@query("upsell_features")
def upsell_features(spark, sf_dir):
    return features(spark, sf_dir)


@query("stratified_split")
def stratified_split(spark, sf_dir):
    return split(spark, sf_dir).select("visit_id", "label", "is_test")


@query("upsell_fit")
def upsell_fit(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    model = upsell.fit_logistic(train)
    rows = [("intercept", model.intercept), *model.coefficients.items()]
    return spark.createDataFrame([(f, b) for f, b in rows], "feature STRING, coefficient DOUBLE").withColumn(
        "coefficient", half_up("coefficient", 4)
    )


@query("upsell_fit_by_store")
def upsell_fit_by_store(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    rows = train.withColumn("store_id", store_of(F.split("visit_id", "[|]")[0].cast("bigint")))
    return by_store.fit_logistic_by(rows).withColumn("coefficient", half_up("coefficient", 4))


@query("upsell_score")
def upsell_score(spark, sf_dir):
    return scored(spark, sf_dir).select("visit_id", half_up("prob", 6).alias("prob"), "pred")


@query("odds_ratio")
def odds_ratio(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    return upsell.odds_ratios(upsell.coefficient_table(train, upsell.fit_logistic(train)))


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return upsell.confusion_matrix(scored(spark, sf_dir))


@query("class_report")
def class_report(spark, sf_dir):
    return upsell.class_report(scored(spark, sf_dir))


@query("auc")
def auc(spark, sf_dir):
    return upsell.auc(scored(spark, sf_dir))


@query("roc_curve")
def roc_curve(spark, sf_dir):
    return upsell.roc_curve(scored(spark, sf_dir))


def tested(spark, sf_dir):
    """The visits of the test set, scored by the model fitted on the others."""
    train, test = train_and_test(spark, sf_dir)
    return materialise(upsell.score(test, upsell.fit_logistic(train)).select("label", "prob", "pred"))


def tested_tree(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    by_tree = upsell.score_tree(test, upsell.fit_tree(train))
    return materialise(by_tree.select("label", "prob", (F.col("prob") >= 0.5).cast("bigint").alias("pred")))


@query("confusion_matrix_test")
def confusion_matrix_test(spark, sf_dir):
    return upsell.confusion_matrix(tested(spark, sf_dir))


@query("class_report_test")
def class_report_test(spark, sf_dir):
    return upsell.class_report(tested(spark, sf_dir))


@query("auc_test")
def auc_test(spark, sf_dir):
    return upsell.auc(tested(spark, sf_dir))


@query("roc_curve_test")
def roc_curve_test(spark, sf_dir):
    return upsell.roc_curve(tested(spark, sf_dir)).drop("threshold")


@query("confusion_matrix_tree")
def confusion_matrix_tree(spark, sf_dir):
    return upsell.confusion_matrix(tested_tree(spark, sf_dir))


@query("class_report_tree")
def class_report_tree(spark, sf_dir):
    return upsell.class_report(tested_tree(spark, sf_dir))


@query("upsell_tree")
def upsell_tree(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    model = upsell.fit_tree(train)
    rows = [(f, float(v)) for f, v in zip(UPSELL_FEATURES, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").withColumn(
        "importance", half_up("importance", 3)
    )


@query("model_choice")
def model_choice(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    by_logistic = upsell.auc(upsell.score(test, upsell.fit_logistic(train)))
    by_tree = upsell.auc(upsell.score_tree(test, upsell.fit_tree(train)))
    return upsell.model_choice(by_logistic, by_tree)


@query("action_grid")
def action_grid(spark, sf_dir):
    return upsell.action_grid(upsell.score(binding.visits(spark, sf_dir), GIVEN_MODEL))


@query("potential_tier")
def potential_tier(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rows.select("visit_id", half_up("prob", 6).alias("prob"), upsell.potential_tier("prob").alias("tier"))


# --- streams -----------------------------------------------------------------------------------------------------

REQUEST_SCHEMA = "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT"


@query("recommend_stream_equiv")
def recommend_stream_equiv(spark, sf_dir):
    sets = basket_queries.sets_of(spark, sf_dir)
    rules = basket_queries.rules_from(sets, spark, sf_dir)
    scored_rules = basket_queries.scored_from(rules, spark, sf_dir)
    arriving = new_folder(spark, "requests")
    basket_queries.with_hour(sets, spark, sf_dir).write.parquet(arriving)
    out = new_folder(spark, "recommendations")
    requests = jobs.order_stream(spark, arriving, REQUEST_SCHEMA)
    jobs.finish(jobs.start_recommendations(requests, scored_rules, out, new_folder(spark, "recommendations-state")))
    return jobs.read_batches(spark, out).select(
        "visit_id", "rank", "consequent_id", "antecedent_id", "category", "expected_profit", "final_score"
    )


LINE_SCHEMA = "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT, ts TIMESTAMP"


@query("open_orders_stream_equiv")
def open_orders_stream_equiv(spark, sf_dir):
    """Every dish as a line of its own, in files of any order; what a table has ordered so far is the stream's state."""
    sets = basket_queries.sets_of(spark, sf_dir)
    scored_rules = basket_queries.scored_from(basket_queries.rules_from(sets, spark, sf_dir), spark, sf_dir)
    heads = binding.order_heads(spark, sf_dir).select("visit_id", "arrival_hour", "date")
    dishes = sets.select("visit_id", F.posexplode("foods").alias("place", "dish")).join(heads, "visit_id")
    minute = F.col("arrival_hour") * 60 + F.col("place")
    lines = dishes.select("visit_id", F.array("dish").alias("foods"), "arrival_hour", (F.col("date").cast("timestamp") + F.make_dt_interval(mins=minute.cast("int"))).alias("ts"))
    arriving, out = new_folder(spark, "lines"), new_folder(spark, "open-orders")
    lines.repartition(4).write.parquet(arriving)
    # the files of these tables come in no order of time, so no line counts as late
    stream = jobs.order_stream(spark, arriving, LINE_SCHEMA, files_per_batch=2)
    jobs.finish(jobs.start_open_orders(stream, scored_rules, out, new_folder(spark, "open-orders-state"), lateness="40000 days"))
    return jobs.read_batches(spark, out).select("visit_id", "rank", "consequent_id", "antecedent_id", "category", "expected_profit", "final_score")


@query("upsell_stream_equiv")
def upsell_stream_equiv(spark, sf_dir):
    seated = new_folder(spark, "seated")
    rows = features(spark, sf_dir)
    rows.drop("label").write.parquet(seated)
    schema = "visit_id STRING, " + ", ".join(f"{c} BIGINT" for c in UPSELL_FEATURES)
    out = new_folder(spark, "potential")
    stream = jobs.order_stream(spark, seated, schema)
    jobs.finish(jobs.start_potential(stream, GIVEN_MODEL, out, new_folder(spark, "potential-state")))
    return spark.read.parquet(out).select("visit_id", half_up("prob", 6).alias("prob"), "tier")
