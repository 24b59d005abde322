"""Domain rules over scored drinks: taboo pairings, pairing factors, hour of the evening, variety."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import const
from comanda.operators.basket import best_per_drink, for_all_visits, hits, top_n
from comanda.params import (
    ALCOHOL_FREE_MARK,
    BEERS,
    COCKTAILS,
    REDS,
    SOFT_PENALTY,
    TABOO,
    WINES,
    HourFactors,
)
from comanda.session import materialise

SCORE = "decimal(12,1)"


def taboo_table(spark: SparkSession, rows: Sequence[tuple[str, str, str]] = TABOO) -> DataFrame:
    return spark.createDataFrame(list(rows), "food_tag STRING, consequent_id STRING, reason STRING")


def penalty_table(spark: SparkSession, rows: Sequence[tuple[str, str, str]] = SOFT_PENALTY) -> DataFrame:
    table = spark.createDataFrame(list(rows), "food_tag STRING, drink_tag STRING, factor STRING")
    return table.withColumn("factor", F.col("factor").cast("decimal(5,2)"))


def drink_category(item_id: Column, item_name: Column) -> Column:
    """Category of a drink; the first that fits counts."""
    return (
        F.when(item_name.contains(ALCOHOL_FREE_MARK), "alcohol_free")
        .when(item_id.isin(*BEERS), "beer")
        .when(item_id.isin(*COCKTAILS), "cocktail")
        .when(item_id.isin(*REDS), "red")
        .otherwise("white_sparkling")
    )


def is_wine(item_id: Column) -> Column:
    """Still wines, the drinks that take time; sparkling is not among them."""
    return item_id.isin(*WINES)


def with_categories(menu: DataFrame) -> DataFrame:
    """The menu with the two drink columns the rules need, from its ids and names."""
    return menu.withColumns(
        {
            "drink_category": drink_category(F.col("item_id"), F.col("item_name")),
            "slow_wine": is_wine(F.col("item_id")),
        }
    )


def with_tags(rules: DataFrame, menu: DataFrame) -> DataFrame:
    """Rules with the tags of both items and the category of the drink.

    `menu` must be a few rows per item; it is joined on ids and AQE sees its size.
    """
    dish = menu.select(F.col("item_id").alias("antecedent_id"), F.col("pairing_tag").alias("food_tag"))
    drink = menu.select(
        F.col("item_id").alias("consequent_id"),
        F.col("pairing_tag").alias("drink_tag"),
        F.col("drink_category").alias("category"),
        F.col("slow_wine"),
    )
    return rules.join(dish, "antecedent_id").join(drink, "consequent_id")


def mark_taboo(tagged: DataFrame, taboo: DataFrame) -> DataFrame:
    """Each rule with the reason it is taboo, NULL where it is not."""
    return tagged.join(F.broadcast(taboo), ["food_tag", "consequent_id"], "left")


def kept(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("reason").isNull()).drop("reason")


def blocked(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("reason").isNotNull())


def blocked_in_orders(orders: DataFrame, marked: DataFrame) -> DataFrame:
    """The pairings not to offer with each open order, with their reasons. `marked` should be a written table."""
    return hits(orders, blocked(marked))


def pairing_penalty(tagged: DataFrame, penalties: DataFrame) -> DataFrame:
    """Pairing factor (1 where none is listed) and the expected profit under it, rounded."""
    out = tagged.join(F.broadcast(penalties), ["food_tag", "drink_tag"], "left")
    factor = F.coalesce("factor", const("1.00")).cast("decimal(5,2)")
    score = F.round(F.col("expected_profit").cast(SCORE) * factor, 1).cast(SCORE)
    return out.withColumn("pairing_factor", factor).withColumn("pairing_score", score).drop("factor")


def hour_factor(category: Column, slow_wine: Column, arrival_hour: Column, factors: HourFactors = HourFactors()) -> Column:
    late_cocktail = (arrival_hour >= factors.cocktail_from) & (category == "cocktail")
    late_wine = (arrival_hour >= factors.wine_from) & slow_wine
    return (
        F.when(late_cocktail, const(factors.cocktail_factor))
        .when(late_wine, const(factors.wine_factor))
        .otherwise(const("1.00"))
        .cast("decimal(5,2)")
    )


def hour_adjusted(scored: DataFrame, factors: HourFactors = HourFactors()) -> DataFrame:
    """Pairing score under the hour's factor, rounded a second time."""
    factor = hour_factor(F.col("category"), F.col("slow_wine"), F.col("arrival_hour"), factors)
    return scored.withColumn("hour_factor", factor).withColumn(
        "final_score", F.round(F.col("pairing_score") * factor, 1).cast(SCORE)
    )


def diversify(
    scored: DataFrame, n: int = 3, score: str = "final_score", group: Sequence[str] = ("pattern",)
) -> DataFrame:
    """At most one drink per category in score order, then the best of the rest up to n.

    Taking the best of each category first and filling up by score is the order (leader of its category first,
    score, id): the n best leaders come first, and others follow only when leaders run out.
    """
    leader = W.partitionBy(*group, "category").orderBy(F.desc(score), "consequent_id")
    leads = F.row_number().over(leader) == 1
    order = W.partitionBy(*group).orderBy(F.desc("_leads"), F.desc(score), "consequent_id")
    ranked = scored.withColumn("_leads", leads).withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("rank") <= n).drop("_leads")


def score_rules(rules: DataFrame, menu: DataFrame, taboo: DataFrame, penalties: DataFrame) -> DataFrame:
    """What does not depend on the visit, done once per rule: taboo rules out, pairing score in."""
    return pairing_penalty(kept(mark_taboo(with_tags(rules, menu), taboo)), penalties)


def hour_step(arrival_hour: Column, factors: HourFactors = HourFactors()) -> Column:
    """The hour as far as the factors tell hours apart: the last of their starts that has passed, else 0."""
    step = F.lit(0).cast("bigint")
    for start in sorted((factors.cocktail_from, factors.wine_from)):
        step = F.when(arrival_hour >= start, F.lit(start).cast("bigint")).otherwise(step)
    return step


def recommend_with_rules(
    orders: DataFrame,
    scored_rules: DataFrame,
    n: int = 3,
    group: Sequence[str] = ("pattern", "arrival_hour"),
    factors: HourFactors = HourFactors(),
) -> DataFrame:
    """Recall, rank and re-rank for every open order (dishes, arrival hour).

    `scored_rules` comes from `score_rules` and should be materialised. What follows the recall is grouped by
    order, so all windows share one partitioning.
    """
    candidates = hour_adjusted(hits(orders, scored_rules), factors)
    return diversify(best_per_drink(candidates, "final_score", group), n, "final_score", group)


def recommend_visits(
    sets: DataFrame, scored_rules: DataFrame, n: int = 3, factors: HourFactors = HourFactors(), keep: Callable[[DataFrame], DataFrame] = materialise
) -> DataFrame:
    """Re-ranked recommendations for visits (visit_id, arrival_hour, foods), worked out per distinct order and
    step of the evening. `keep` as in `for_all_visits`."""
    stepped = sets.withColumn("arrival_hour", hour_step(F.col("arrival_hour"), factors))

    def picked(orders: DataFrame, group: Sequence[str]) -> DataFrame:
        return recommend_with_rules(orders, scored_rules, n, group, factors)

    return for_all_visits(stepped, picked, ["arrival_hour"], keep).drop("arrival_hour")


def recommend_without_rules(orders: DataFrame, rules: DataFrame, n: int = 3, group: Sequence[str] = ("pattern",)) -> DataFrame:
    """The same recall and ranking with the expected profit as the score and nothing re-ranked."""
    scored = hits(orders, rules).withColumn("final_score", F.col("expected_profit"))
    return top_n(best_per_drink(scored, "final_score", group), "final_score", n, group)
