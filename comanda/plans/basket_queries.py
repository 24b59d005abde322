"""Basket rules and recommendations over the driver tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators import basket, rerank
from comanda.params import DAYPARTS, ENGLISH_TYPES, HourFactors
from comanda.plans.queries import query
from comanda.session import materialise
from comanda.sources import binding

TYPES = ENGLISH_TYPES
# Other factors than the default ones: cocktails and still wines an hour earlier.
EARLIER = HourFactors(cocktail_from=20, wine_from=22)


def sets_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dishes and drinks per visit, written once: the order lines are read and shuffled a single time."""
    return materialise(basket.basket_sets(binding.order_lines(spark, sf_dir), TYPES))


def menu_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(binding.menu(spark, sf_dir))


def rules_from(sets: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule table, written once and read by what recommends from it."""
    return materialise(basket.association_rules(sets, menu_of(spark, sf_dir)))


def rules_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_from(sets_of(spark, sf_dir), spark, sf_dir)


def tagged(rules: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.with_tags(rules, binding.menu(spark, sf_dir))


def marked_from(rules: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank.mark_taboo(tagged(rules, spark, sf_dir), rerank.taboo_table(spark, binding.BOUND_TABOO))


def marked_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_from(rules_of(spark, sf_dir), spark, sf_dir)


def scored_from(rules: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    taboo, penalties = rerank.taboo_table(spark, binding.BOUND_TABOO), rerank.penalty_table(spark)
    return materialise(rerank.score_rules(rules, binding.menu(spark, sf_dir), taboo, penalties))


def with_hour(sets: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour of arrival joins after the lines have become one row per visit."""
    heads = binding.order_heads(spark, sf_dir).select("visit_id", "arrival_hour")
    return sets.select("visit_id", "foods").join(heads, "visit_id")


def ruled(spark: SparkSession, sf_dir: str, factors: HourFactors = HourFactors()) -> DataFrame:
    """The whole recommendation: baskets, rules, domain scores, the three drinks of every visit."""
    sets = sets_of(spark, sf_dir)
    scored = scored_from(rules_from(sets, spark, sf_dir), spark, sf_dir)
    return rerank.recommend_visits(materialise(with_hour(sets, spark, sf_dir)), scored, 3, factors)


@query("baskets")
def baskets(spark, sf_dir):
    return basket.build_baskets(binding.order_lines(spark, sf_dir))


@query("baskets_daypart")
def baskets_daypart(spark, sf_dir):
    heads = binding.order_heads(spark, sf_dir).select("visit_id", "arrival_hour")
    baskets = basket.build_baskets(binding.order_lines(spark, sf_dir)).join(heads, "visit_id")
    return basket.add_daypart(baskets, DAYPARTS).drop("arrival_hour")


@query("item_support")
def item_support(spark, sf_dir):
    return basket.item_support(binding.order_lines(spark, sf_dir))


@query("pair_counts")
def pair_counts(spark, sf_dir):
    return basket.pair_counts(basket.basket_sets(binding.order_lines(spark, sf_dir), TYPES))


@query("association_rules")
def association_rules(spark, sf_dir):
    return basket.association_rules(sets_of(spark, sf_dir), menu_of(spark, sf_dir))


@query("association_rules_blocks")
def association_rules_blocks(spark, sf_dir):
    return basket.association_rules_by_blocks(binding.order_lines(spark, sf_dir), menu_of(spark, sf_dir), TYPES)


@query("dessert_rules")
def dessert_rules(spark, sf_dir):
    types = replace(TYPES, antecedents=(TYPES.desserts,))
    sets = materialise(basket.basket_sets(binding.order_lines(spark, sf_dir), types))
    return basket.association_rules(sets, menu_of(spark, sf_dir))


@query("fpgrowth_pairs")
def fpgrowth_pairs(spark, sf_dir):
    return basket.fpgrowth_pairs(sets_of(spark, sf_dir))


def set_rules_from(sets: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(basket.set_rules(sets, menu_of(spark, sf_dir)))


@query("fpgrowth_rules")
def fpgrowth_rules(spark, sf_dir):
    rules = set_rules_from(sets_of(spark, sf_dir), spark, sf_dir)
    return rules.withColumn("n_dishes", F.size("dishes")).drop("dishes")


@query("recommend_sets")
def recommend_sets(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    rules = set_rules_from(sets, spark, sf_dir)
    picked = basket.for_all_visits(sets, lambda orders, group: basket.recommend_by_sets(orders, rules, group=group))
    return picked.select("visit_id", "rank", "consequent_id", "antecedent_id", "expected_profit")


@query("recommend_profit")
def recommend_profit(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    rules = rules_from(sets, spark, sf_dir)
    picked = basket.for_all_visits(sets, lambda orders, group: basket.recommend(orders, rules, 3, "profit", group))
    return picked.select("visit_id", "rank", "consequent_id", "antecedent_id", "expected_profit")


@query("recommend_confidence")
def recommend_confidence(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    rules = rules_from(sets, spark, sf_dir)
    picked = basket.for_all_visits(sets, lambda orders, group: basket.recommend(orders, rules, 3, "confidence", group))
    return picked.select("visit_id", "rank", "consequent_id", "antecedent_id", "confidence")


@query("strategy_uplift")
def strategy_uplift(spark, sf_dir):
    return basket.strategy_uplift(binding.menu(spark, sf_dir), rules_of(spark, sf_dir), TYPES)


@query("rules_by_daypart")
def rules_by_daypart(spark, sf_dir):
    heads = binding.order_heads(spark, sf_dir).select("visit_id", "arrival_hour")
    menu = menu_of(spark, sf_dir)
    sets = materialise(basket.add_daypart(sets_of(spark, sf_dir).join(heads, "visit_id"), DAYPARTS))
    rules = materialise(basket.association_rules(sets, menu, keys=["daypart"]))
    dishes = menu.filter(F.col("type").isin(*TYPES.foods))
    single = dishes.select(
        F.col("item_id").alias("pattern"),
        F.col("item_id").alias("antecedent_id"),
        F.explode(F.array(*[F.lit(d) for d in DAYPARTS])).alias("daypart"),
    )
    found = basket.hits(single, rules, ["daypart"])
    return basket.top_n(found, "expected_profit", 3, ["daypart", "pattern"]).select(
        "daypart", "antecedent_id", "rank", "consequent_id", "support", "confidence", "lift", "expected_profit"
    )


@query("taboo_kept")
def taboo_kept(spark, sf_dir):
    return rerank.kept(marked_rules(spark, sf_dir)).select("antecedent_id", "consequent_id", "expected_profit")


@query("taboo_blocked")
def taboo_blocked(spark, sf_dir):
    return rerank.blocked(marked_rules(spark, sf_dir)).select("antecedent_id", "consequent_id", "reason")


@query("blocked_by_visit")
def blocked_by_visit(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    marked = materialise(marked_from(rules_from(sets, spark, sf_dir), spark, sf_dir))
    orders = sets.select("visit_id", F.explode("foods").alias("antecedent_id"))
    found = rerank.blocked_in_orders(orders, marked)
    return found.select("visit_id", "antecedent_id", "consequent_id", "reason")


@query("pairing_penalty")
def pairing_penalty(spark, sf_dir):
    rules = tagged(rules_of(spark, sf_dir), spark, sf_dir)
    scored = rerank.pairing_penalty(rules, rerank.penalty_table(spark))
    return scored.select("antecedent_id", "consequent_id", "pairing_factor", "pairing_score")


@query("hour_adjusted")
def hour_adjusted(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    scored = scored_from(rules_from(sets, spark, sf_dir), spark, sf_dir)
    orders = with_hour(sets, spark, sf_dir).select("visit_id", "arrival_hour", F.explode("foods").alias("antecedent_id"))
    return rerank.hour_adjusted(basket.hits(orders, scored)).select(
        "visit_id", "antecedent_id", "consequent_id", "pairing_score", "hour_factor", "final_score"
    )


@query("diversified_topn")
def diversified_topn(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    rules = materialise(tagged(rules_from(sets, spark, sf_dir), spark, sf_dir))

    def varied(orders, group):
        best = basket.best_per_drink(basket.hits(orders, rules), "expected_profit", group)
        return rerank.diversify(best, 3, "expected_profit", group)

    return basket.for_all_visits(sets, varied).select("visit_id", "rank", "consequent_id", "category", "expected_profit")


@query("recommend_rules")
def recommend_rules(spark, sf_dir):
    return ruled(spark, sf_dir).select(
        "visit_id", "rank", "consequent_id", "antecedent_id", "category", "expected_profit", "final_score"
    )


@query("recommend_rules_factors")
def recommend_rules_factors(spark, sf_dir):
    return ruled(spark, sf_dir, EARLIER).select(
        "visit_id", "rank", "consequent_id", "antecedent_id", "category", "expected_profit", "final_score"
    )


@query("recommend_raw")
def recommend_raw(spark, sf_dir):
    sets = sets_of(spark, sf_dir)
    rules = rules_from(sets, spark, sf_dir)
    picked = basket.for_all_visits(sets, lambda orders, group: rerank.recommend_without_rules(orders, rules, 3, group))
    return picked.select("visit_id", "rank", "consequent_id", "antecedent_id", "final_score")


@query("rec_set_value")
def rec_set_value(spark, sf_dir):
    return basket.set_value(ruled(spark, sf_dir))
