"""Key figures and patterns over visits and item lines."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import half_up, mean, ratio
from comanda.functions.ordered import average_rank_pct
from comanda.params import MenuTypes
from comanda.session import materialise

DURATION_BINS = (0, 60, 90, 120, 150, 300)


def drinks_per_head() -> Column:
    return ratio("n_drink", "party_size").cast("decimal(18,9)")


def kpi_summary(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The key figures in one pass. The drink ratio is a ratio of sums, the per-head figures are means of visits."""
    days, n = F.count_distinct("date"), F.count(F.lit(1))
    revenue, profit = F.sum("total_revenue"), F.sum("total_profit")
    return visits.groupBy(*keys).agg(
        days.alias("n_days"),
        n.alias("n_visits"),
        half_up(ratio(n, days), 2).alias("visits_per_day"),
        revenue.alias("total_revenue"),
        half_up(ratio(revenue, days), 2).alias("revenue_per_day"),
        F.round(profit, 2).alias("total_profit"),
        half_up(ratio(profit, revenue), 4).alias("profit_margin"),
        half_up(mean("spend_per_head"), 2).alias("avg_spend_per_head"),
        half_up(mean("total_revenue"), 2).alias("avg_revenue"),
        half_up(mean("party_size"), 2).alias("avg_party_size"),
        half_up(mean("duration_min"), 2).alias("avg_duration"),
        half_up(ratio(F.sum("drink_revenue"), revenue), 4).alias("drink_ratio"),
        half_up(mean(drinks_per_head()), 4).alias("drinks_per_head"),
        half_up(ratio(F.count_if(F.col("n_drink") == 0), n), 4).alias("zero_drink_share"),
    )


def profit_structure(items: DataFrame, types: MenuTypes = MenuTypes(), keys: Sequence[str] = ()) -> DataFrame:
    """Revenue and profit of drinks and of everything else, with their shares."""
    drink = (F.col("type") == types.drinks).cast("bigint")
    both = items.groupBy(*keys, drink.alias("is_drink")).agg(F.sum("price").alias("revenue"), F.sum("profit").alias("profit"))
    # two rows per key
    of_key = W.partitionBy(*(keys or [F.lit(0)]))
    return both.select(
        *keys,
        "is_drink",
        "revenue",
        "profit",
        half_up(ratio("revenue", F.sum("revenue").over(of_key)), 4).alias("revenue_share"),
        half_up(ratio("profit", F.sum("profit").over(of_key)), 4).alias("profit_share"),
    )


def visits_by_hour(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return visits.groupBy(*keys, "arrival_hour").agg(F.count(F.lit(1)).alias("n_visits"))


def revenue_by_weekday(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return visits.groupBy(*keys, "weekday").agg(F.sum("total_revenue").alias("revenue"))


def drink_ratio_by_hour(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the visits' ratios, not the ratio of their sums."""
    return visits.groupBy(*keys, "arrival_hour").agg(half_up(mean("drink_ratio"), 4).alias("avg_drink_ratio"))


def _per_ratio(visits: DataFrame) -> DataFrame:
    """Visits per distinct drink ratio in ten-thousandths: at most 10,001 rows whatever the number of visits."""
    step = (F.col("drink_ratio") * 10000).cast("bigint")
    return visits.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"))


def drink_ratio_histogram(visits: DataFrame, bins: int = 30) -> DataFrame:
    """Visits in equal-width bins between the smallest and the largest ratio; the last bin is closed."""
    steps = _per_ratio(visits)
    ends = steps.agg(F.struct(F.min("step").alias("lo"), F.max("step").alias("hi"))).scalar()
    binned = steps.select("step", "n", ends["lo"].alias("lo"), ends["hi"].alias("hi"))
    place = F.expr(f"(step - lo) * {bins} div greatest(hi - lo, 1)")
    counts = binned.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("n"))
    every = steps.agg(F.min("step").alias("lo"), F.max("step").alias("hi")).select(
        "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")).alias("bin")
    )

    def edge(i: Column) -> Column:
        return half_up((F.col("lo") + i * ratio(F.col("hi") - F.col("lo"), F.lit(bins))) / 10000, 6)

    return every.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("from_ratio"),
        edge(F.col("bin") + 1).alias("to_ratio"),
        F.coalesce("n", F.lit(0)).alias("n_visits"),
    )


def drink_ratio_density(visits: DataFrame, grid: int = 200, bins: int = 30) -> DataFrame:
    """Gaussian kernel density of the ratio on an even grid, at the height of the histogram's counts.

    Bandwidth by Scott's rule. The kernel sums run over the distinct ratios with their counts, so their cost does
    not grow with the visits.
    """
    steps = _per_ratio(visits)
    n, s, s2 = F.sum("n"), F.sum(F.col("n") * F.col("step")), F.sum(F.col("n") * F.col("step") * F.col("step"))
    stats = steps.agg(
        n.alias("total"), s.alias("s"), s2.alias("s2"), F.min("step").alias("lo"), F.max("step").alias("hi")
    )
    total = F.col("total")
    spread = (F.col("s2").cast("decimal(38,0)") * total - F.col("s").cast("decimal(38,0)") * F.col("s")).cast("double")
    std = F.sqrt(ratio(spread, total.cast("double") * (total - 1)))
    width = std * F.pow(total.cast("double"), F.lit(-0.2))
    stats = stats.agg(
        F.struct(
            F.first("total").alias("total"),
            F.first("lo").alias("lo"),
            F.first("hi").alias("hi"),
            F.first(width).alias("width"),
        )
    ).scalar()
    points = steps.select(
        "step", "n", stats.alias("st"), F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point")
    )
    at = F.col("st.lo") + F.col("point") * ratio(F.col("st.hi") - F.col("st.lo"), F.lit(grid - 1))
    points = points.withColumn("at", at)
    z = ratio(F.col("at") - F.col("step"), "st.width")
    kernel = F.exp(z * z * F.lit(-0.5)) * F.col("n")
    bin_width = ratio(F.max("st.hi") - F.max("st.lo"), F.lit(bins))
    height = ratio(F.sum(kernel) * bin_width, F.max("st.width") * F.lit(math.sqrt(2 * math.pi)))
    return points.groupBy(F.col("point").cast("bigint").alias("point")).agg(
        half_up(F.max("at") / 10000, 6).alias("drink_ratio"), half_up(height, 4).alias("height")
    )


def duration_vs_drinks(visits: DataFrame, bins: Sequence[int] = DURATION_BINS, keys: Sequence[str] = ()) -> DataFrame:
    """Mean drinks per head by length of stay. Bins are open below and closed above; visits outside are left out."""
    stay, label = F.col("duration_min"), None
    for lo, hi in zip(bins, bins[1:]):
        inside, name = (stay > lo) & (stay <= hi), F.lit(f"({lo},{hi}]")
        label = F.when(inside, name) if label is None else label.when(inside, name)
    binned = visits.withColumn("duration_bin", label).filter(F.col("duration_bin").isNotNull())
    return binned.groupBy(*keys, "duration_bin").agg(
        F.count(F.lit(1)).alias("n_visits"), half_up(mean(drinks_per_head()), 4).alias("drinks_per_head")
    )


def _first(df: DataFrame, n: int, order: Sequence[Column | str], keys: Sequence[str]) -> DataFrame:
    """The first n rows of each key in `order`; a key has at most a menu or a day's hours of rows."""
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def top_items(items: DataFrame, n: int = 15, keys: Sequence[str] = ()) -> DataFrame:
    """The n items with the largest total profit."""
    totals = items.groupBy(*keys, "item_id").agg(F.sum("profit").alias("total_profit"))
    return _first(totals, n, [F.desc("total_profit"), "item_id"], keys)


def weak_hours(visits: DataFrame, min_visits: int = 30, n: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """The hours with the lowest mean drink ratio among those with enough visits."""
    hours = visits.groupBy(*keys, "arrival_hour").agg(
        F.count(F.lit(1)).alias("n_visits"), half_up(mean("drink_ratio"), 4).alias("avg_drink_ratio")
    )
    return _first(hours.filter(F.col("n_visits") >= min_visits), n, ["avg_drink_ratio", "arrival_hour"], keys)


def zero_drink_visits(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Visits without a drink: how many, what they spend, and the revenue lost if half had drunk as others do."""
    without = F.col("n_drink") == 0
    n_without = F.count_if(without)
    spend = F.when(without, F.col("spend_per_head"))
    drinkers = F.when(~without, F.col("drink_revenue"))
    return visits.groupBy(*keys).agg(
        n_without.alias("n_zero"),
        half_up(ratio(n_without, F.count(F.lit(1))), 4).alias("zero_share"),
        half_up(mean(spend), 2).alias("zero_spend_per_head"),
        half_up(mean("spend_per_head"), 2).alias("avg_spend_per_head"),
        half_up(ratio(F.sum(drinkers) * n_without, F.count(drinkers) * 2), 2).alias("lost_revenue"),
    )


def weekend_split(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Friday and Saturday against the other days: visits in total and per day, mean spend, mean ratio."""
    n, days = F.count(F.lit(1)), F.count_distinct("date")
    return visits.groupBy(*keys, "is_weekend").agg(
        n.alias("n_visits"),
        half_up(ratio(n, days), 2).alias("visits_per_day"),
        half_up(mean("spend_per_head"), 2).alias("avg_spend_per_head"),
        half_up(mean("drink_ratio"), 4).alias("avg_drink_ratio"),
    )


def hidden_gems(items: DataFrame, profit_above: float = 0.6, units_below: float = 0.4, keys: Sequence[str] = ()) -> DataFrame:
    """Items with a high unit profit that sell little, by their share ranks among all items."""
    stats = items.groupBy(*keys, "item_id").agg(
        F.sum("units").alias("units"),
        half_up(ratio(F.sum("profit"), F.sum("units")), 4).alias("unit_profit"),
        F.sum("profit").alias("total_profit"),
    )
    stats = materialise(stats)  # ranked twice and joined
    ranked = average_rank_pct(average_rank_pct(stats, "units", "units_pct", keys), "unit_profit", "profit_pct", keys)
    return ranked.filter((F.col("profit_pct") > profit_above) & (F.col("units_pct") < units_below)).select(
        *keys,
        "item_id",
        "units",
        "unit_profit",
        "total_profit",
        half_up("units_pct", 6).alias("units_pct"),
        half_up("profit_pct", 6).alias("profit_pct"),
    )


def buzz_split(visits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Drink share before and after the evening turns, as mean of ratios and as ratio of sums."""
    return visits.groupBy(*keys, "is_buzz_hour").agg(
        F.count(F.lit(1)).alias("n_visits"),
        half_up(mean("drink_ratio"), 4).alias("avg_drink_ratio"),
        half_up(ratio(F.sum("drink_revenue"), F.sum("total_revenue")), 4).alias("drink_share"),
    )
