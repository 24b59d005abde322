"""Association rules between dishes and drinks, ranked by expected profit, and recommendations from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import const, half_up, ratio
from comanda.params import MenuTypes, RuleThresholds
from comanda.session import broadcast_if_small, materialise


# Between the item ids of an order; not a character of any id.
SEPARATOR = "\u0001"


def _nothing() -> Column:
    return F.lit(None).cast("string")


def build_baskets(items: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct items per visit."""
    known = F.col("visit_id").isNotNull() & F.col("item_id").isNotNull()
    return items.filter(known).select(*keys, "visit_id", "item_id").distinct()


def in_hours(items: DataFrame, visits: DataFrame, hours: tuple[int, int]) -> DataFrame:
    """Items of the visits that arrived within the hours, both ends included."""
    kept = visits.filter(F.col("arrival_hour").between(*hours)).select("visit_id")
    return items.join(kept, "visit_id", "left_semi")


def add_daypart(items: DataFrame, dayparts: dict[str, tuple[int, int]]) -> DataFrame:
    """Name of the daypart the visit arrived in; visits outside all of them are left out."""
    name = F.coalesce(*[F.when(F.col("arrival_hour").between(*hours), n) for n, hours in dayparts.items()])
    return items.withColumn("daypart", name).filter(F.col("daypart").isNotNull())


def basket_sets(items: DataFrame, types: MenuTypes, keys: Sequence[str] = ()) -> DataFrame:
    """One row per visit with its distinct dishes and drinks.

    Repeated items collapse before the shuffle, so a visit takes at most one entry per menu item however many
    lines it has.
    """
    known = F.col("visit_id").isNotNull() & F.col("item_id").isNotNull()
    return (
        items.filter(known)
        .groupBy(*keys, "visit_id")
        .agg(
            F.collect_set(F.when(F.col("type").isin(*types.foods), F.col("item_id"))).alias("foods"),
            F.collect_set(F.when(F.col("type") == types.drinks, F.col("item_id"))).alias("drinks"),
        )
    )


def _basket_total(counts: DataFrame, count: str, keys: Sequence[str]) -> DataFrame:
    """Add `n_baskets`, the count of the entry that stands for all baskets, and drop that entry.

    It comes from a small aggregate over the same counts, so the items of a key are not gathered in one task.
    """
    whole = F.max(F.when(F.col("item_id").isNull(), F.col(count)))
    if keys:
        counts = counts.join(counts.groupBy(*keys).agg(whole.alias("n_baskets")), list(keys))
    else:
        counts = counts.withColumn("n_baskets", counts.agg(whole).scalar())
    return counts.filter(F.col("item_id").isNotNull())


def item_support(items: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of all baskets that hold the item."""
    sets = items.filter(F.col("visit_id").isNotNull() & F.col("item_id").isNotNull())
    sets = sets.groupBy(*keys, "visit_id").agg(F.collect_set("item_id").alias("held"))
    # one entry per basket and one per item in it, counted in the same pass
    entries = sets.select(*keys, F.explode(F.array_append("held", _nothing())).alias("item_id"))
    counts = entries.groupBy(*keys, "item_id").agg(F.count(F.lit(1)).alias("baskets"))
    return _basket_total(counts, "baskets", keys).withColumn("support", half_up(ratio("baskets", "n_baskets"), 4))


def basket_counts(sets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Baskets in total (side and item NULL) and per dish (side a) and drink (side b), in one pass over the visits."""

    def entry(side: str, item: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), item.alias("item"))

    held = F.concat(
        F.transform("foods", lambda x: entry("a", x)),
        F.transform("drinks", lambda x: entry("b", x)),
        F.array(F.struct(_nothing().alias("side"), _nothing().alias("item"))),
    )
    entries = sets.select(*keys, F.inline(held))
    return entries.groupBy(*keys, "side", "item").agg(F.count(F.lit(1)).alias("n"))


def frequent_items(counts: DataFrame, min_support: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dishes and drinks frequent enough to be in a kept pair, with all baskets as `n_all`.

    A pair is never more frequent than either of its items, so leaving out the others cannot change the rules. At
    most (mean basket size / min_support) items per key are left, however long the menu is. `counts` comes from
    `basket_counts` and should be a written table.
    """
    whole = counts.filter(F.col("side").isNull()).select(*keys, F.col("n").alias("n_all"))
    items = counts.filter(F.col("side").isNotNull())
    if keys:
        items = items.join(whole, list(keys))
    else:
        items = items.withColumn("n_all", whole.scalar())
    return items.filter(F.col("n") >= F.col("n_all") * const(min_support))


def pair_counts(sets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Baskets per directed dish -> drink pair."""
    dishes = sets.select(*keys, F.explode("foods").alias("antecedent_id"), "drinks")
    pairs = dishes.select(*keys, "antecedent_id", F.explode("drinks").alias("consequent_id"))
    return pairs.groupBy(*keys, "antecedent_id", "consequent_id").agg(F.count(F.lit(1)).alias("baskets"))


def association_rules(
    sets: DataFrame,
    menu: DataFrame,
    thresholds: RuleThresholds = RuleThresholds(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Dish -> drink rules with support, confidence, lift and expected profit (confidence x unit profit).

    `keys` computes a separate rule set per store, daypart or the like in the same pass. The supports are shares
    of all baskets, with or without dishes and drinks. Items are counted first; pairs are made of frequent items
    only. Pass written tables for `sets` (from `basket_sets`) and `menu`.
    """
    frequent = materialise(frequent_items(materialise(basket_counts(sets, keys)), thresholds.min_support, keys))
    a, b = _sides(frequent, keys)
    dishes = sets.select(*keys, F.explode("foods").alias("a"), "drinks")
    dishes = dishes.join(broadcast_if_small(a.select(*keys, "a")), [*keys, "a"], "left_semi")
    pairs = dishes.select(*keys, "a", F.explode("drinks").alias("b"))
    pairs = pairs.join(broadcast_if_small(b.select(*keys, "b")), [*keys, "b"], "left_semi")
    counts = pairs.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("baskets"))
    return rules_from_counts(counts, frequent, menu, thresholds, keys)


def _sides(frequent: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    a = frequent.filter("side = 'a'").select(*keys, F.col("item").alias("a"), F.col("n").alias("n_a"), "n_all")
    b = frequent.filter("side = 'b'").select(*keys, F.col("item").alias("b"), F.col("n").alias("n_b"))
    return a, b


def rules_from_counts(counts: DataFrame, frequent: DataFrame, menu: DataFrame, thresholds: RuleThresholds, keys: Sequence[str]) -> DataFrame:
    """Rules above the thresholds from the baskets per pair (a, b) and per frequent item."""
    a, b = _sides(frequent, keys)
    n = F.col("baskets")
    metrics = (
        counts.join(broadcast_if_small(a), [*keys, "a"])
        .join(broadcast_if_small(b), [*keys, "b"])
        .filter(n >= F.col("n_all") * const(thresholds.min_support))
        .filter(n >= F.col("n_a") * const(thresholds.min_confidence))
    )
    dish = menu.select(F.col("item_id").alias("a"), F.col("item_name").alias("antecedent"))
    drink = menu.select(
        F.col("item_id").alias("b"),
        F.col("item_name").alias("consequent"),
        (F.col("price") * F.col("profit_margin")).alias("profit"),
    )
    confidence = ratio("baskets", "n_a")
    return (
        metrics.join(dish, "a")
        .join(drink, "b")
        .select(
            *keys,
            "antecedent",
            F.col("a").alias("antecedent_id"),
            "consequent",
            F.col("b").alias("consequent_id"),
            half_up(ratio("baskets", "n_all"), 4).alias("support"),
            half_up(confidence, 4).alias("confidence"),
            half_up(ratio(F.col("baskets") * F.col("n_all"), F.col("n_a") * F.col("n_b")), 3).alias("lift"),
            F.round("profit", 1).cast("decimal(12,1)").alias("unit_profit"),
            half_up(ratio(F.col("baskets") * F.col("profit"), "n_a"), 1).cast("decimal(12,1)").alias("expected_profit"),
        )
    )


# Items of a visit in one row; a larger basket is cut into blocks.
BLOCK_ITEMS = 256


def item_counts(lines: DataFrame, types: MenuTypes, keys: Sequence[str] = ()) -> DataFrame:
    """The counts of `basket_counts` from distinct (visit, item, type) lines, without a row per visit."""
    side = F.when(F.col("type").isin(*types.foods), "a").when(F.col("type") == types.drinks, "b")
    items = lines.select(*keys, side.alias("side"), F.col("item_id").alias("item")).filter("side is not null").groupBy(*keys, "side", "item").agg(F.count(F.lit(1)).alias("n"))
    visits = lines.select(*keys, "visit_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return items.unionByName(visits.select(*keys, _nothing().alias("side"), _nothing().alias("item"), "n"))


def blocks(lines: DataFrame, column: str, keys: Sequence[str], block: int) -> DataFrame:
    """keys, visit_id, and the items of a visit in arrays of about `block`, by a hash of the item."""
    sizes = lines.groupBy(*keys, "visit_id").agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks"))
    # small baskets have one block, so only the large ones are looked up
    large = sizes.filter("_blocks > 1")
    dealt = lines.join(large, [*keys, "visit_id"], "left").withColumn("_block", F.pmod(F.xxhash64("item"), F.coalesce("_blocks", F.lit(1))))
    return dealt.groupBy(*keys, "visit_id", "_block").agg(F.collect_list("item").alias(column)).drop("_block")


def association_rules_by_blocks(
    items: DataFrame, menu: DataFrame, types: MenuTypes, thresholds: RuleThresholds = RuleThresholds(), keys: Sequence[str] = (), block: int = BLOCK_ITEMS
) -> DataFrame:
    """The rules of `association_rules` from order lines, for baskets of any size.

    No row holds a whole visit: lines become distinct (visit, item) rows, infrequent items leave, and what is left of a
    visit's dishes and drinks is cut into blocks of about `block` items, of which every pair meets by the visit. Each
    (visit, dish, drink) is counted once.
    """
    known = F.col("visit_id").isNotNull() & F.col("item_id").isNotNull()
    lines = materialise(items.filter(known).select(*keys, "visit_id", "item_id", "type").distinct())
    frequent = materialise(frequent_items(materialise(item_counts(lines, types, keys)), thresholds.min_support, keys))

    def left(side: str, column: str) -> DataFrame:
        wanted = frequent.filter(F.col("side") == side).select(*keys, F.col("item").alias("item_id"))
        of_side = F.col("type").isin(*types.foods) if side == "a" else F.col("type") == types.drinks
        kept = lines.filter(of_side).join(broadcast_if_small(wanted), [*keys, "item_id"], "left_semi")
        return blocks(kept.select(*keys, "visit_id", F.col("item_id").alias("item")), column, keys, block)

    both = left("a", "_as").join(left("b", "_bs"), [*keys, "visit_id"])
    pairs = both.select(*keys, F.explode("_as").alias("a"), "_bs").select(*keys, "a", F.explode("_bs").alias("b"))
    counts = pairs.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("baskets"))
    return rules_from_counts(counts, frequent, menu, thresholds, keys)


def with_pattern(sets: DataFrame) -> DataFrame:
    """What was ordered, as one text, for the visits that ordered a dish."""
    ordered = sets.filter(F.size("foods") > 0)
    return ordered.withColumn("pattern", F.array_join(F.array_sort("foods"), SEPARATOR))


def open_orders(patterns: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct order and dish on it."""
    distinct = patterns.select("pattern", *keys).distinct()
    return distinct.withColumn("antecedent_id", F.explode(F.split("pattern", SEPARATOR)))


def for_all_visits(sets: DataFrame, recommend_orders, keys: Sequence[str] = (), keep: Callable[[DataFrame], DataFrame] = materialise) -> DataFrame:
    """Recommendations for every visit, worked out once per distinct order.

    What is recommended depends on the dishes (and `keys`) only, and a menu has far fewer combinations than there
    are visits, so the ranking runs over the distinct orders and its result is joined back. With few of them that
    join is a broadcast; beyond the bound it is a shuffle join. `sets` is read twice: pass a materialised table. `keep`
    holds the recommendations per order: a written table, or for a stream's batch something that goes with the batch.
    """
    patterns = with_pattern(sets)
    picked = keep(recommend_orders(open_orders(patterns, keys), ("pattern", *keys)))
    visits = patterns.select("visit_id", "pattern", *keys)
    return visits.join(broadcast_if_small(picked), ["pattern", *keys]).drop("pattern")


def hits(orders: DataFrame, rules: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All rules whose dish was ordered. `rules` should be a materialised table: its size is checked."""
    return orders.join(broadcast_if_small(rules), [*keys, "antecedent_id"])


def best_per_drink(scored: DataFrame, score: str, group: Sequence[str] = ("pattern",)) -> DataFrame:
    """The best-scoring rule for each drink; ties go to the lower dish id."""
    order = W.partitionBy(*group, "consequent_id").orderBy(F.desc(score), "antecedent_id")
    return scored.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def top_n(scored: DataFrame, score: str, n: int, group: Sequence[str] = ("pattern",)) -> DataFrame:
    """The n best rows per group with their rank; ties go to the lower drink id."""
    order = W.partitionBy(*group).orderBy(F.desc(score), "consequent_id", "antecedent_id")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("rank") <= n)


def recommend(
    orders: DataFrame, rules: DataFrame, n: int = 3, strategy: str = "profit", group: Sequence[str] = ("pattern",)
) -> DataFrame:
    """Top drinks for every open order, by expected profit or by confidence."""
    score = {"profit": "expected_profit", "confidence": "confidence"}[strategy]
    return top_n(best_per_drink(hits(orders, rules), score, group), score, n, group)


def strategy_uplift(menu: DataFrame, rules: DataFrame, types: MenuTypes, n: int = 3) -> DataFrame:
    """Mean expected profit of the top drinks per dish under both strategies and the uplift in percent."""
    dishes = menu.filter(F.col("type").isin(*types.foods))
    single = dishes.select(F.col("item_id").alias("pattern"), F.col("item_id").alias("antecedent_id"))

    def per_dish(strategy: str) -> DataFrame:
        picked = recommend(single, rules, n, strategy)
        return picked.groupBy("pattern").agg(F.sum("expected_profit").alias(strategy))

    both = per_dish("profit").join(per_dish("confidence"), "pattern")
    by_profit = ratio(F.sum("profit"), F.count("profit"))
    by_confidence = ratio(F.sum("confidence"), F.count("confidence"))
    return both.agg(
        F.count(F.lit(1)).alias("n_dishes"),
        half_up(by_profit, 2).alias("avg_by_profit"),
        half_up(by_confidence, 2).alias("avg_by_confidence"),
        half_up((ratio(F.sum("profit"), F.sum("confidence")) - 1) * 100, 2).alias("uplift_pct"),
    )


def set_value(recommended: DataFrame, group: Sequence[str] = ("visit_id",)) -> DataFrame:
    """Expected profit of each set of recommendations."""
    return recommended.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_drinks"), F.sum("expected_profit").alias("set_value")
    )


def frequent_sets(sets: DataFrame, min_support: str) -> DataFrame:
    """dishes (sorted), drinks (sorted), n: the frequent item sets by MLlib's FP-growth, dishes and drinks apart.

    Items carry their kind as a first letter, so the menu's drinks are never gathered.
    """
    from pyspark.ml.fpm import FPGrowth

    named = F.concat(F.transform("foods", lambda x: F.concat(F.lit("f"), x)), F.transform("drinks", lambda x: F.concat(F.lit("d"), x)))
    found = FPGrowth(itemsCol="items", minSupport=float(min_support)).fit(sets.select(named.alias("items"))).freqItemsets

    def of(kind: str) -> Column:
        return F.array_sort(F.transform(F.filter("items", lambda x: x.startswith(kind)), lambda x: F.substring(x, 2, 1 << 30)))

    return found.select(of("f").alias("dishes"), of("d").alias("drinks"), F.col("freq").alias("n"))


SET_MARK = "+"


def counted_rules(sets: DataFrame, thresholds: RuleThresholds, max_dishes: int | None) -> DataFrame:
    """dishes, consequent_id and the counts of every rule above the thresholds."""
    found = frequent_sets(sets, thresholds.min_support).filter(F.size("drinks") <= 1)
    found = materialise(found if max_dishes is None else found.filter(F.size("dishes") <= max_dishes))
    before = found.filter(F.size("drinks") == 0).select("dishes", F.col("n").alias("n_a"))
    after = found.filter((F.size("dishes") == 0) & (F.size("drinks") == 1)).select(F.col("drinks")[0].alias("consequent_id"), F.col("n").alias("n_b"))
    both = found.filter((F.size("dishes") > 0) & (F.size("drinks") == 1)).select("dishes", F.col("drinks")[0].alias("consequent_id"), F.col("n").alias("baskets"))
    counted = both.join(before, "dishes").join(after, "consequent_id").withColumn("n_all", sets.agg(F.count(F.lit(1))).scalar())
    n = F.col("baskets")
    return counted.filter((n >= F.col("n_all") * const(thresholds.min_support)) & (n >= F.col("n_a") * const(thresholds.min_confidence)))


def _rule_columns() -> list[Column]:
    n = F.col("baskets")
    return [
        F.array_join("dishes", SET_MARK).alias("antecedent_id"),
        F.col("consequent_id"),
        half_up(ratio(n, "n_all"), 4).alias("support"),
        half_up(ratio(n, "n_a"), 4).alias("confidence"),
        half_up(ratio(n * F.col("n_all"), F.col("n_a") * F.col("n_b")), 3).alias("lift"),
    ]


def set_rules(sets: DataFrame, menu: DataFrame, thresholds: RuleThresholds = RuleThresholds(), max_dishes: int | None = 2) -> DataFrame:
    """Rules with up to `max_dishes` dishes before the arrow, with support, confidence, lift and expected profit.

    `antecedent_id` joins the dishes, in order, by `SET_MARK`; `dishes` lists them. With one dish these are the rules of
    `association_rules`. Pass written tables for `sets` (from `basket_sets`) and `menu`.
    """
    drink = menu.select(F.col("item_id").alias("consequent_id"), (F.col("price") * F.col("profit_margin")).alias("profit"))
    return counted_rules(sets, thresholds, max_dishes).join(drink, "consequent_id").select(
        *_rule_columns(),
        "dishes",
        F.round("profit", 1).cast("decimal(12,1)").alias("unit_profit"),
        half_up(ratio(F.col("baskets") * F.col("profit"), "n_a"), 1).cast("decimal(12,1)").alias("expected_profit"),
    )


def fpgrowth_pairs(sets: DataFrame, thresholds: RuleThresholds = RuleThresholds(), max_antecedents: int | None = 1) -> DataFrame:
    """Rules from MLlib's FP-growth without the profit; with `max_antecedents=1` those of `association_rules`."""
    return counted_rules(sets, thresholds, max_antecedents).select(*_rule_columns())


def held_sets(orders: DataFrame, rules: DataFrame, keys: Sequence[str] = ("pattern",)) -> DataFrame:
    """`keys` and antecedent_id of every set of dishes in `rules` that an order holds whole.

    `orders` has a row per order and dish (as antecedent_id) and is read twice, `rules` comes from `set_rules`: pass
    written tables. A set is filed under its rarest dish, the one that fewest orders have, so an order meets a set
    once, by that dish; the set's other dishes are then matched and counted. Neither orders nor sets are crossed.
    """
    orders = orders.select(*keys, F.col("antecedent_id").alias("_dish")).distinct()
    wanted = rules.select("antecedent_id", "dishes").distinct()
    often = orders.groupBy("_dish").agg(F.count(F.lit(1)).alias("_n"))
    filed = wanted.select("antecedent_id", "dishes", F.explode("dishes").alias("_dish")).join(often, "_dish")
    rarest = filed.groupBy("antecedent_id", "dishes").agg(F.min(F.struct("_n", "_dish")).alias("_first"), F.count(F.lit(1)).alias("_known"))
    # a set with a dish that nobody ordered is held by no order
    index = materialise(rarest.filter(F.col("_known") == F.size("dishes")).select("antecedent_id", F.col("_first._dish").alias("_dish"), "dishes"))
    met = orders.join(broadcast_if_small(index), "_dish")
    alone = met.filter(F.size("dishes") == 1).select(*keys, "antecedent_id")
    others = met.filter(F.size("dishes") > 1).withColumn("_rest", F.array_remove("dishes", F.col("_dish")))
    asked = others.select(*keys, "antecedent_id", F.size("_rest").alias("_asked"), F.explode("_rest").alias("_dish"))
    matched = asked.join(orders, [*keys, "_dish"]).groupBy(*keys, "antecedent_id", "_asked").agg(F.count(F.lit(1)).alias("_found"))
    return alone.unionByName(matched.filter("_found = _asked").select(*keys, "antecedent_id"))


def recommend_by_sets(orders: DataFrame, rules: DataFrame, n: int = 3, strategy: str = "profit", group: Sequence[str] = ("pattern",)) -> DataFrame:
    """Top drinks for every open order by rules of one or more dishes, all of which must be on it."""
    orders, plain = materialise(orders), rules.drop("dishes")
    return recommend(held_sets(orders, rules, group), plain, n, strategy, group)
