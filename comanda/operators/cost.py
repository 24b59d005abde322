"""Cost structure, food cost reconciliation, item margins and supplier scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import const, half_up, ratio
from comanda.functions.ordered import ROWS_PER_TASK, running_total, share_of_total
from comanda.params import COST_BANDS, FULL_PAYMENT_TERM_DAYS, MISSING_METRIC, SCORE_WEIGHTS
from comanda.session import materialise

HIGH, WITHIN, BELOW = "high", "within", "below"
# The report's words for the three verdicts.
VERDICT_TEXT = {HIGH: "🔴 偏高", WITHIN: "🟡 區間內", BELOW: "🟢 低於標竿"}


def cost_structure(
    lines: DataFrame, revenue: DataFrame, bands: dict = COST_BANDS, keys: Sequence[str] = ("store_id",)
) -> DataFrame:
    """Each cost line as a share of revenue against its band; both ends of the band belong to it.

    `lines` has one row per key and line, `revenue` one per key. A line that is not there counts as zero. The
    verdict compares amounts, not the rounded share. `total_over` sums what is over the bands of a key.
    """
    rows = [
        F.struct(F.lit(name).alias("line"), const(lo).alias("lo"), const(hi).alias("hi")) for name, (lo, hi) in bands.items()
    ]
    every = revenue.select(*keys, "revenue", F.inline(F.array(*rows)))
    amounts = lines.select(*keys, "line", F.col("amount").cast("decimal(38,4)").alias("amount"))
    df = every.join(amounts, [*keys, "line"], "left").withColumn(
        "amount", F.coalesce("amount", F.lit(0).cast("decimal(38,4)"))
    )
    income = F.col("revenue").cast("decimal(28,2)")
    high, low = income * F.col("hi"), income * F.col("lo")
    amount = F.col("amount")
    none = F.coalesce(income == 0, F.lit(True))
    df = df.withColumns(
        {
            "share": F.coalesce(half_up(ratio(amount, income), 6), F.lit(0.0)),
            "band": F.concat(
                (F.col("lo") * 100).cast("int").cast("string"), F.lit("%~"), (F.col("hi") * 100).cast("int").cast("string"), F.lit("%")
            ),
            "verdict": F.when(none, BELOW).when(amount > high, HIGH).when(amount < low, BELOW).otherwise(WITHIN),
            "over_amount": F.when(~none & (amount > high), amount - high).otherwise(const(0)).cast("decimal(38,4)"),
        }
    )
    total = F.sum("over_amount").alias("total_over")
    totals = df.groupBy(*keys).agg(total) if keys else None
    df = df.join(totals, list(keys)) if keys else df.withColumn("total_over", df.agg(total).scalar())
    return df.select(
        *keys,
        "line",
        "amount",
        "share",
        "band",
        "verdict",
        half_up("over_amount", 2).alias("over_amount"),
        half_up("total_over", 2).alias("total_over"),
    )


def reconcile_items(inventory: DataFrame) -> DataFrame:
    """Cost of what was sold, bought, put into stock and lost, per item."""
    cost = F.col("unit_cost")
    change = F.col("closing_stock") - F.col("opening_stock")
    waste = F.col("opening_stock") + F.col("received_qty") - F.col("closing_stock") - F.col("qty_sold")
    return inventory.withColumns(
        {
            "theoretical_cost": F.col("qty_sold") * cost,
            "purchase_cost": F.col("received_qty") * cost,
            "stock_change_qty": change,
            "stock_change_cost": change * cost,
            "waste_qty": waste,
            "waste_cost": waste * cost,
        }
    )


def reconcile_totals(items: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Totals and both cost rates.

    Purchases = cost of sales + stock change + net waste; the residual of that identity is given. Positive waste
    alone, as reported on the floor, does not close it.
    """
    lost = F.when(F.col("waste_qty") > 0, F.col("waste_cost")).otherwise(F.lit(0))
    totals = items.groupBy(*keys).agg(
        F.sum(F.col("qty_sold") * F.col("price")).alias("revenue"),
        F.sum("theoretical_cost").alias("theoretical_cost"),
        F.sum("purchase_cost").alias("purchase_cost"),
        F.sum("stock_change_cost").alias("stock_change_cost"),
        F.sum(lost).alias("waste_positive"),
        F.sum("waste_cost").alias("waste_net"),
    )
    gap = F.col("purchase_cost") - F.col("theoretical_cost")
    return totals.withColumns(
        {
            "difference": gap,
            "residual": gap - F.col("stock_change_cost") - F.col("waste_net"),
            "theoretical_rate": F.coalesce(half_up(ratio("theoretical_cost", "revenue"), 4), F.lit(0.0)),
            "purchase_rate": F.coalesce(half_up(ratio("purchase_cost", "revenue"), 4), F.lit(0.0)),
        }
    )


def item_margin(inventory: DataFrame, keys: Sequence[str] = ("store_id",)) -> DataFrame:
    """Margin per unit and in total, shares of cost and margin, flagged where the cost share is the larger."""
    qty, price, cost = F.col("qty_sold"), F.col("price"), F.col("unit_cost")
    df = inventory.withColumns(
        {
            "unit_margin": price - cost,
            "margin_rate": half_up(ratio(price - cost, price), 6),
            "revenue": qty * price,
            "total_cost": (qty * cost).cast("decimal(28,2)"),
            "total_margin": (qty * (price - cost)).cast("decimal(28,2)"),
        }
    )
    df = share_of_total(df, {"cost": "total_cost", "margin": "total_margin"}, keys)
    cost_share, margin_share = ratio("total_cost", "cost_total"), ratio("total_margin", "margin_total")
    return df.withColumns(
        {
            "cost_share": half_up(cost_share, 6),
            "margin_share": half_up(margin_share, 6),
            "eats_margin": cost_share > margin_share,
        }
    ).drop("cost_total", "margin_total")


def supplier_metrics(receipts: DataFrame) -> DataFrame:
    """On-time and defect rate and price competitiveness per supplier from its deliveries.

    Competitiveness compares the supplier's mean cost in a category with the cheapest supplier's, weighted by the
    quantity it delivers there. The receipts are read once: their totals per supplier and category are written.
    """
    per_category = receipts.groupBy("supplier_id", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("on_time").alias("n_on_time"),
        F.count_if("defective").alias("n_defective"),
        F.sum("quantity").alias("quantity"),
        F.sum("amount").alias("amount"),
    )
    per_category = materialise(per_category.withColumn("avg_cost", ratio("amount", "quantity")))
    cheapest = per_category.groupBy("category").agg(F.min("avg_cost").alias("lowest"))
    weighted = (F.try_divide("lowest", "avg_cost") * F.col("quantity")).cast("decimal(28,8)")
    return (
        per_category.join(cheapest, "category")
        .groupBy("supplier_id")
        .agg(
            F.sum("n").alias("n_receipts"),
            half_up(ratio(F.sum("n_on_time"), F.sum("n")), 6).alias("on_time_rate"),
            half_up(ratio(F.sum("n_defective"), F.sum("n")), 6).alias("defect_rate"),
            half_up(ratio(F.sum(weighted), F.sum("quantity")), 6).alias("price_competitiveness"),
        )
    )


def score_suppliers(
    supplier: DataFrame, metrics: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Weighted supplier score and rank, one row per supplier.

    Of several rows of a supplier the one with the lowest sku counts. A metric that is not known counts as neutral
    and is listed; the score is usable for decisions only when none is missing.
    """
    fields = ["category", "lead_time_days_avg", "lead_time_days_std", "payment_term_days"]
    first = supplier.groupBy("supplier_id").agg(F.min_by(F.struct(*fields), "sku_id").alias("t"))
    df = first.select("supplier_id", "t.*")
    if metrics is None:
        null = F.lit(None).cast("double")
        df = df.withColumns({"on_time_rate": null, "defect_rate": null, "price_competitiveness": null})
    else:
        known = metrics.select("supplier_id", "on_time_rate", "defect_rate", "price_competitiveness")
        df = df.join(known, "supplier_id", "left")
    neutral = F.lit(float(MISSING_METRIC))
    term = F.least(ratio("payment_term_days", F.lit(FULL_PAYMENT_TERM_DAYS)), F.lit(1.0))
    parts = {
        "on_time_rate": F.coalesce("on_time_rate", neutral),
        "quality": F.coalesce(F.lit(1.0) - F.col("defect_rate"), neutral),
        "price_competitiveness": F.coalesce("price_competitiveness", neutral),
        "payment_term": term,
    }
    score = sum((F.lit(float(SCORE_WEIGHTS[name])) * value for name, value in parts.items()), F.lit(0.0)) * 100
    missing = F.concat_ws(
        ",",
        F.when(F.col("on_time_rate").isNull(), "on_time_rate"),
        F.when(F.col("defect_rate").isNull(), "defect_rate"),
        F.when(F.col("price_competitiveness").isNull(), "price_competitiveness"),
    )
    scored = df.select(
        "supplier_id",
        "category",
        F.col("lead_time_days_avg").alias("lead_time_avg"),
        F.col("lead_time_days_std").alias("lead_time_std"),
        "payment_term_days",
        half_up(term, 2).alias("payment_term_score"),
        half_up(score, 1).alias("score"),
        missing.alias("missing_metrics"),
        (F.length(missing) == 0).alias("usable"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    order = [F.desc("score"), F.asc("supplier_id")]
    return running_total(scored, "_one", order, out="rank", rows_per_task=rows_per_task).drop("_one")
