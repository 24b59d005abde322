"""Replenishment advice: by profit class (model A) and by usage value and variation with (s, S) orders (model B)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import const, half_up, linear_interp, lookup, ratio, tier
from comanda.functions.ordered import ROWS_PER_TASK, running_total, share_of_total
from comanda.operators import demand
from comanda.params import (
    PEAK_WEEKDAYS,
    SERVICE_LEVEL_Z,
    SHELF_LIFE_BY_CATEGORY,
    SHELF_LIFE_FALLBACK,
    SUPPLIER_DEFAULTS,
    SUPPLIER_FALLBACK,
    MenuTypes,
    ProfitPolicy,
    StockPolicy,
)
from comanda.session import broadcast_if_small, materialise

URGENT, LOW, ENOUGH = "urgent", "low", "enough"
# The report's words for the three states.
STATUS_TEXT = {URGENT: "🔴 立即叫貨", LOW: "🟡 低於安全庫存", ENOUGH: "🟢 庫存充足"}


def abc_class(running: Column, total: Column, cuts: Sequence[tuple[str, str]], last: str = "C") -> Column:
    """Class by cumulative share; the item that crosses a cut is already in the next class."""
    label = None
    for name, cut in cuts:
        inside = running <= total * const(cut)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(last)


def classify_by_share(
    df: DataFrame,
    value: str,
    cuts: Sequence[tuple[str, str]],
    by: Sequence[str],
    tie: str,
    share: str,
    label: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the cumulative share of `value` from the largest down, and the class it falls in, per group of `by`."""
    order = [F.desc(value), F.asc(tie)]
    out = running_total(df, value, order, by, "_running", rows_per_task)
    out = share_of_total(out, {"_value": value}, by)
    running, total = F.col("_running"), F.col("_value_total")
    return (
        out.withColumn(share, half_up(ratio(running, total), 3))
        .withColumn(label, abc_class(running, total, cuts))
        .drop("_running", "_value_total")
    )


# --- model A -----------------------------------------------------------------------------------------------------


def item_policy(items: DataFrame, types: MenuTypes = MenuTypes(), policy: ProfitPolicy = ProfitPolicy()) -> DataFrame:
    """Shelf life and lead time in days, by tag; drinks have their own."""
    drink = F.col("type") == types.drinks
    shelf = F.when(drink, policy.drink_shelf_life).otherwise(
        lookup("pairing_tag", policy.shelf_life, policy.other_shelf_life)
    )
    lead = F.when(drink, policy.drink_lead_time).otherwise(
        lookup("pairing_tag", policy.lead_time, policy.other_lead_time)
    )
    return items.withColumns({"shelf_life": shelf.cast("bigint"), "lead_time": lead.cast("bigint")})


def abc_by_profit(
    stats: DataFrame,
    menu: DataFrame,
    policy: ProfitPolicy = ProfitPolicy(),
    keys: Sequence[str] = ("store_id",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Profit class of each item: unit profit to one decimal, total profit to whole units, cumulative share."""
    columns = ["item_id", "item_name", "type", "pairing_tag", "price", "profit_margin"]
    unit = F.round(F.col("price") * F.col("profit_margin"), 1).cast("decimal(12,1)")
    total = F.round(F.col("unit_profit") * F.col("total_units"), 0).cast("decimal(28,0)")
    priced = stats.join(menu.select(*columns), "item_id").withColumn("unit_profit", unit)
    return classify_by_share(
        priced.withColumn("total_profit", total),
        "total_profit",
        policy.abc_cuts,
        keys,
        "item_id",
        "cum_profit_share",
        "abc",
        rows_per_task,
    )


def demand_profile(
    daily: DataFrame,
    menu: DataFrame,
    types: MenuTypes = MenuTypes(),
    policy: ProfitPolicy = ProfitPolicy(),
    keys: Sequence[str] = ("store_id",),
) -> DataFrame:
    """Everything the advice needs per item: demand over business days, profit class, shelf life, lead time."""
    stats = demand.dense_demand(daily, keys)
    return item_policy(abc_by_profit(stats, menu, policy, keys), types, policy)


def service_z(level: Column) -> Column:
    """Safety factor of a service level: exact at the listed levels, linear between them, flat beyond."""
    return linear_interp(level, list(SERVICE_LEVEL_Z.items()))


def level_ranges(points: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """keys, lo, hi, z_lo, z_hi: the stretches between the break points (keys, level, z) of a store, and those beyond its ends.

    A stretch holds its lower end; the first has no lower end, the last no upper one, and z stays the same on both.
    """
    per_store = W.partitionBy(*keys).orderBy("level")
    after, z_after = F.lead("level").over(per_store), F.lead("z").over(per_store)
    from_here = points.select(*keys, F.col("level").alias("lo"), after.alias("hi"), F.col("z").alias("z_lo"), F.coalesce(z_after, "z").alias("z_hi"))
    first = points.groupBy(*keys).agg(F.min(F.struct("level", "z")).alias("_first"))
    nothing = F.lit(None).cast("double")
    before = first.select(*keys, nothing.alias("lo"), F.col("_first.level").alias("hi"), F.col("_first.z").alias("z_lo"), F.col("_first.z").alias("z_hi"))
    return from_here.unionByName(before)


def service_z_by(df: DataFrame, points: DataFrame, level: str = "service_level", keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Add `z`, the safety factor of a row's service level by its store's table of break points (keys, level, z).

    A range join within the store: the row meets the one stretch that holds its level. Linear between the break points,
    flat beyond them; null for a null level or a store without a table. The tables are small and broadcast when they
    are found to be; a store's rows are never gathered.
    """
    ranges = broadcast_if_small(materialise(level_ranges(points, keys)))
    x = F.col(level).cast("double")
    inside = (F.col("lo").isNull() | (x >= F.col("lo"))) & (F.col("hi").isNull() | (x < F.col("hi")))
    same = [F.col(f"_rows.{k}") == F.col(f"_ranges.{k}") for k in keys]
    joined = df.alias("_rows").join(ranges.alias("_ranges"), reduce(lambda a, b: a & b, same) & inside, "left")
    share = (x - F.col("lo")) / (F.col("hi") - F.col("lo"))
    z = F.when(F.col("lo").isNull() | F.col("hi").isNull(), F.col("z_lo")).otherwise(F.col("z_lo") + share * (F.col("z_hi") - F.col("z_lo")))
    return joined.select("_rows.*", F.when(x.isNotNull(), z).alias("z"))


def safety_stock(std: Column, lead_time: Column, z: Column) -> Column:
    return z * std * F.sqrt(lead_time.cast("double"))


def reorder_advice(
    profile: DataFrame,
    stock: DataFrame,
    target_weekday: int | None = None,
    policy: ProfitPolicy = ProfitPolicy(),
    keys: Sequence[str] = ("store_id",),
) -> DataFrame:
    """Order advice per item: reorder point, quantity within the shelf life, state, spoilage.

    `stock` holds store, item and on_hand; items not in it have none. Demand is that of the peak days when the
    target weekday is one of them, while the spread stays that of all days.
    """
    base = F.col("peak_daily" if target_weekday in PEAK_WEEKDAYS else "avg_daily")
    level = lookup("abc", policy.service_level)
    lead, shelf = F.col("lead_time"), F.col("shelf_life")
    df = profile.join(stock, [*keys, "item_id"], "left").withColumns(
        {"on_hand": F.coalesce(F.col("on_hand").cast("double"), F.lit(0.0)), "service_level": level, "base": base}
    )
    df = df.withColumn("_ss", safety_stock(F.col("std_daily"), lead, service_z(F.col("service_level"))))
    df = df.withColumn("_rop", F.col("base") * lead + F.col("_ss"))
    on_hand, rop, base = F.col("on_hand"), F.col("_rop"), F.col("base")
    sellable = base * shelf
    # greatest and least pass over NULL: without a spread there is no reorder point and nothing is suggested
    suggest = F.when(rop.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(rop - on_hand, sellable - on_hand)))
    cover = F.try_divide(on_hand, base)
    excess = F.greatest(F.lit(0.0), on_hand - sellable)
    cost = excess * F.col("price").cast("double") * (F.lit(1.0) - F.col("profit_margin").cast("double"))
    return df.select(
        *keys,
        "item_id",
        "item_name",
        "type",
        "abc",
        "service_level",
        half_up("base", 1).alias("daily_demand"),
        half_up("std_daily", 1).alias("demand_std"),
        "lead_time",
        "shelf_life",
        half_up("_ss", 1).alias("safety_stock"),
        half_up("_rop", 1).alias("reorder_point"),
        half_up("on_hand", 1).alias("on_hand"),
        half_up(cover, 1).alias("days_of_cover"),
        F.ceil(suggest).cast("bigint").alias("suggested_qty"),
        F.when(cover < lead, URGENT).when(on_hand < rop, LOW).otherwise(ENOUGH).alias("status"),
        half_up(excess, 1).alias("excess_qty"),
        half_up(cost, 0).alias("spoilage_cost"),
        "total_profit",
        F.col("std_daily").isNull().alias("insufficient_data"),
    )


def by_urgency(advice: DataFrame) -> DataFrame:
    """Report order: state, class, then profit."""
    state = lookup("status", {URGENT: 0, LOW: 1, ENOUGH: 2})
    return advice.orderBy(state, "abc", F.desc("total_profit"), "item_id")


def spoilage_risk(advice: DataFrame, n: int = 8, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """The n costliest surpluses of each store with the cost of all of the store's (its menu bounds the window).

    Without `keys` the whole table is one store.
    """
    store = W.partitionBy(*(keys or [F.lit(1)]))
    risky = advice.filter(F.col("excess_qty") > 0).withColumn(
        "total_spoilage_cost", F.sum(F.col("spoilage_cost").cast("decimal(28,0)")).over(store)
    )
    place = F.row_number().over(store.orderBy(F.desc("spoilage_cost"), "item_id"))
    worst = risky.withColumn("_place", place).filter(F.col("_place") <= n)
    columns = ["item_id", "abc", "shelf_life", "on_hand", "excess_qty", "spoilage_cost", "total_spoilage_cost"]
    return worst.orderBy(*keys, F.desc("spoilage_cost"), "item_id").select(*keys, *columns)


def abc_summary(profile: DataFrame, policy: ProfitPolicy = ProfitPolicy(), keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Items, profit share and service level per class."""
    classes = profile.groupBy(*keys, "abc").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("total_profit").alias("profit")
    )
    classes = share_of_total(classes, {"profit": "profit"}, keys)
    return classes.select(
        *keys,
        "abc",
        "n_items",
        half_up(ratio("profit", "profit_total"), 4).alias("profit_share"),
        lookup("abc", policy.service_level).alias("service_level"),
    )


def advice_summary(advice: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Items per state and units to order."""
    return advice.groupBy(*keys).agg(
        F.count_if(F.col("status") == URGENT).alias("n_urgent"),
        F.count_if(F.col("status") == LOW).alias("n_low"),
        F.count_if(F.col("status") == ENOUGH).alias("n_enough"),
        F.sum("suggested_qty").alias("total_suggested"),
        F.sum(F.col("spoilage_cost").cast("decimal(28,0)")).alias("total_spoilage_cost"),
    )


# --- model B -----------------------------------------------------------------------------------------------------

TERMS = ("lead_time_days_avg", "lead_time_days_std", "moq", "pack_size", "payment_term_days")


def supplier_master(
    inventory: DataFrame,
    defaults: dict = SUPPLIER_DEFAULTS,
    shelf_life: dict = SHELF_LIFE_BY_CATEGORY,
    real: DataFrame | None = None,
) -> DataFrame:
    """Supplier terms per store and sku. Real terms win where `real` has them; the rest take their category's
    defaults and are flagged as still to be filled in, without holding anything up."""
    terms = {
        name: lookup("category", {c: getattr(d, name) for c, d in defaults.items()}, getattr(SUPPLIER_FALLBACK, name))
        for name in TERMS
    }
    out = inventory.select(
        "store_id",
        "sku_id",
        "category",
        F.concat(F.lit("SUP-"), "category").alias("supplier_id"),
        F.col("unit_cost").alias("unit_price"),
        lookup("category", shelf_life, SHELF_LIFE_FALLBACK).cast("bigint").alias("shelf_life_days"),
        F.lit(True).alias("needs_data_fill"),
        *[c.cast("bigint" if name in ("moq", "pack_size", "payment_term_days") else "double").alias(name) for name, c in terms.items()],
    )
    if real is None:
        return out
    known = real.select("store_id", "sku_id", F.col("supplier_id").alias("_supplier"), *[F.col(t).alias(f"_{t}") for t in TERMS])
    joined = out.join(known, ["store_id", "sku_id"], "left")
    missing = F.lit(False)
    for t in TERMS:
        missing = missing | F.col(f"_{t}").isNull()
    filled = {t: F.coalesce(f"_{t}", t) for t in TERMS}
    filled["supplier_id"] = F.coalesce("_supplier", "supplier_id")
    filled["needs_data_fill"] = missing
    return joined.withColumns(filled).drop("_supplier", *[f"_{t}" for t in TERMS])


def classify_usage(
    stats: DataFrame, inventory: DataFrame, policy: StockPolicy = StockPolicy(), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """ABC by usage value (units x cost) and XYZ by variation of demand, per store."""
    stock = inventory.select("store_id", "sku_id", "category", "unit_cost", "price", "closing_stock", "on_order_qty")
    valued = stats.join(stock, ["store_id", "sku_id"], "left").withColumn(
        "usage_value", (F.col("total_qty") * F.col("unit_cost")).cast("decimal(28,2)")
    )
    out = classify_by_share(
        valued, "usage_value", policy.abc_cuts, ["store_id"], "sku_id", "cum_value_pct", "abc_class", rows_per_task
    )
    return xyz_class(out, policy)


def xyz_class(df: DataFrame, policy: StockPolicy = StockPolicy()) -> DataFrame:
    """X steady, Y varying, Z erratic; without a spread (one day of sales) Z, flagged as too little data."""
    label = tier("cv", [("<", F.lit(float(policy.x_below)), "X"), ("<=", F.lit(float(policy.y_upto)), "Y")], "Z")
    return df.withColumns({"xyz_class": label, "insufficient_data": F.col("cv").isNull()})


def abc_xyz_matrix(classified: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    table = classified.groupBy(*keys, "abc_class").pivot("xyz_class", ["X", "Y", "Z"]).agg(F.count(F.lit(1)))
    return table.na.fill(0, ["X", "Y", "Z"])


def add_safety_stock(classified: DataFrame, supplier: DataFrame, policy: StockPolicy = StockPolicy()) -> DataFrame:
    """Safety stock against both varying demand and varying delivery, and the review cycle of the class."""
    terms = supplier.select(
        "store_id", "sku_id", "lead_time_days_avg", "lead_time_days_std", "moq", "pack_size", "shelf_life_days", "needs_data_fill"
    )
    df = classified.join(terms, ["store_id", "sku_id"], "left")
    df = df.withColumn("service_level", lookup("abc_class", policy.service_level))
    mu, sigma = F.col("demand_avg"), F.col("demand_std")
    lt, lt_sigma = F.col("lead_time_days_avg"), F.col("lead_time_days_std")
    spread = F.sqrt(lt * sigma * sigma + mu * mu * lt_sigma * lt_sigma)
    return df.withColumns(
        {
            "z": service_z(F.col("service_level")),
            "safety_stock_qty": half_up(service_z(F.col("service_level")) * spread, 1),
            "review_cycle_days": lookup("abc_class", policy.review_cycle).cast("bigint"),
            "lead_time_days": F.greatest(F.bround("lead_time_days_avg", 0).cast("bigint"), F.lit(1)),
        }
    )


def _whole(value: Column) -> Column:
    """Whole number as text, halves to even."""
    return F.bround(value, 0).cast("bigint").cast("string")


def build_orders(stocked: DataFrame, forecast: DataFrame, policy: StockPolicy = StockPolicy()) -> DataFrame:
    """(s, S) orders: fill up to the target level in whole packs and at least the minimum order, but not beyond
    what sells within the shelf life; with the reasons a manager should look at the order."""
    df = stocked.join(forecast.select("store_id", "sku_id", "p50", "p90"), ["store_id", "sku_id"])
    stock, on_order = F.col("closing_stock").cast("double"), F.col("on_order_qty").cast("double")
    mu, moq, lt = F.col("demand_avg"), F.col("moq").cast("double"), F.col("lead_time_days")
    df = df.withColumns(
        {
            "_rop": F.col("p50") + F.col("safety_stock_qty"),
            "_available": stock + on_order,
            "_cap": mu * F.col("shelf_life_days"),
            "_pack": F.greatest(F.col("pack_size"), F.lit(1)),
        }
    )
    available, cap, pack = F.col("_available"), F.col("_cap"), F.col("_pack")
    target = F.col("_rop") + mu * policy.review_period_days
    below = F.coalesce(available < F.col("_rop"), F.lit(False))
    df = df.withColumns({"_below": below, "_target": target})
    df = df.withColumn("_raw", F.when(F.col("_below"), F.col("_target") - available).otherwise(0.0))
    df = df.withColumn("_packed", (F.ceil(F.col("_raw") / pack) * pack).cast("double"))
    raised = F.col("_below") & (F.col("_packed") < moq)
    df = df.withColumn("_qty", F.when(raised, moq).otherwise(F.col("_packed")))
    qty = F.col("_qty")
    room = F.greatest(F.lit(0.0), cap - available)
    capped = (qty > 0) & (available + qty > cap) & (room < qty)
    base = F.col("rolling_avg_4wk")
    swing = F.try_divide(F.abs(F.col("p50") / lt - base), base)
    limit = F.lit(float(policy.exception_threshold))
    limit_text = f"{float(policy.exception_threshold):.0%}"
    # Wording of the reasons.
    reasons = [
        F.when(raised, F.concat(F.lit("未達 MOQ "), F.col("moq"), F.lit(",已補足至最小訂購量"))),
        F.when(
            capped,
            F.concat(
                F.lit("受保存期 "),
                F.col("shelf_life_days"),
                F.lit(" 天限制,由 "),
                _whole(qty),
                F.lit(" 降為 "),
                _whole(room),
                F.lit("(超額部分將成廚餘)"),
            ),
        ),
        F.when(
            (moq > cap) & F.col("_below"),
            F.concat(
                F.lit("⚠️ MOQ "),
                F.col("moq"),
                F.lit(" 超過保存期內可銷量 "),
                _whole(cap),
                F.lit(",需與供應商議定拆箱或改期"),
            ),
        ),
        F.when(
            swing > limit,
            F.concat(F.lit("需求波動 "), _whole(swing * 100), F.lit(f"% 超過 {limit_text} 門檻")),
        ),
    ]
    df = df.withColumn("exception_reason", F.concat_ws(" / ", *reasons))
    return df.select(
        "store_id",
        "sku_id",
        "category",
        "abc_class",
        "xyz_class",
        "service_level",
        half_up("demand_avg", 1).alias("demand_avg"),
        half_up("demand_std", 1).alias("demand_std"),
        half_up("cv", 2).alias("cv"),
        "lead_time_days",
        half_up("p50", 1).alias("predicted_qty_p50_lt"),
        half_up("p90", 1).alias("predicted_qty_p90_lt"),
        "safety_stock_qty",
        half_up("_rop", 1).alias("reorder_point"),
        half_up("_target", 1).alias("target_level_S"),
        stock.alias("current_stock"),
        on_order.alias("on_order_qty"),
        half_up("_raw", 1).alias("order_qty_raw"),
        F.floor(F.when(capped, room).otherwise(qty)).cast("bigint").alias("recommended_order_qty"),
        "moq",
        "pack_size",
        "shelf_life_days",
        "review_cycle_days",
        (F.length("exception_reason") > 0).alias("exception_flag"),
        "exception_reason",
        F.col("needs_data_fill").alias("data_gap_flag"),
        "unit_cost",
        "insufficient_data",
    )


def order_summary(orders: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    qty = F.col("recommended_order_qty")
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(qty > 0).alias("n_to_order"),
        F.sum(qty).alias("total_units"),
        F.sum(qty * F.col("unit_cost")).alias("spend"),
        F.count_if("exception_flag").alias("n_exceptions"),
        F.count_if("data_gap_flag").alias("n_data_gaps"),
    )
