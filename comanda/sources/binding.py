"""The driver tables read as the domain tables.

The driver tables have no menu, margins, party sizes or stock counts; those are fixed expressions over the
columns they do have. Money is in decimals, counts are integers, so totals do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.functions.exprs import business_date, business_hour, half_up, is_weekend, lookup, weekday

TYPE_OF_PART = {
    "PROMO": "drink",
    "LARGE": "drink",
    "ECONOMY": "main",
    "STANDARD": "main",
    "MEDIUM": "side",
    "SMALL": "dessert",
}
TAGS = {0: "Red_Meat", 1: "Seafood", 2: "Cheese", 3: "Fried", 4: "Universal"}
DRINK_CATEGORY = {0: "red", 1: "white_sparkling", 2: "cocktail", 3: "beer", 4: "alcohol_free"}
MONEY = "decimal(18,2)"

# Pairings not to be made between the items of these tables: (food tag, drink, reason).
BOUND_TABOO = [
    ("Seafood", "PROMO-2", "bitter covers the fish"),
    ("Seafood", "LARGE-2", "spirit against the fish"),
    ("Seafood", "PROMO-0", "tannin turns metallic"),
    ("Fried", "LARGE-0", "too dry"),
]


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _item_id() -> Column:
    return F.concat("p_type", F.lit("-"), (F.col("p_size") % 5).cast("string"))


def _margin(type_: Column, tag_no: Column) -> Column:
    fixed = lookup(type_, {"main": "0.40", "side": "0.68", "dessert": "0.66"}).cast("decimal(5,4)")
    drink = (F.lit(55) + tag_no * 5).cast("decimal(5,0)") / F.lit(100).cast("decimal(3,0)")
    return F.coalesce(fixed, drink.cast("decimal(5,4)"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part key with the menu item it stands for."""
    tag_no = F.col("p_size") % 5
    type_ = lookup("p_type", TYPE_OF_PART, "dessert")
    return driver_table(spark, sf_dir, "part").select(
        "p_partkey",
        _item_id().alias("item_id"),
        type_.alias("type"),
        lookup(tag_no, TAGS).alias("pairing_tag"),
        tag_no.cast("bigint").alias("tag_no"),
        _margin(type_, tag_no).alias("profit_margin"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("retail_cents"),
    )


def menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per menu item (30 of them, whatever the scale): part type x size class, mean retail price."""
    mean_cents = F.expr("(sum(retail_cents) * 2 + count(*)) div (count(*) * 2)")
    category = F.when(F.col("type") == "drink", lookup(F.col("tag_no").cast("int"), DRINK_CATEGORY))
    return (
        parts(spark, sf_dir)
        .groupBy("item_id", "type", "pairing_tag", "tag_no", "profit_margin")
        .agg((mean_cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY).alias("price"))
        .select(
            "item_id",
            F.col("item_id").alias("item_name"),
            "type",
            "pairing_tag",
            "price",
            "profit_margin",
            category.alias("drink_category"),
            ((F.col("type") == "drink") & F.col("tag_no").isin(0, 1)).alias("slow_wine"),
        )
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines without their order's head: one row per line item."""
    price = F.col("l_extendedprice").cast(MONEY)
    return (
        driver_table(spark, sf_dir, "lineitem")
        .join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("ST"), (F.col("l_orderkey") % 10).cast("string")).alias("store_id"),
            F.col("l_orderkey").alias("visit_id"),
            "item_id",
            F.col("item_id").alias("item_name"),
            "type",
            "pairing_tag",
            F.col("l_quantity").cast("bigint").alias("units"),
            price.alias("price"),
            "profit_margin",
            (price * F.col("profit_margin")).alias("profit"),
        )
    )


def order_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: who came, when, how many, how long."""
    key = F.col("o_orderkey")
    return driver_table(spark, sf_dir, "orders").select(
        key.alias("visit_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        (key % 8 + 17).alias("arrival_hour"),
        (key % 6 + 1).alias("party_size"),
        (key % 211 + 30).alias("duration_min"),
        (key % 10 < 3).cast("bigint").alias("is_repeat"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with date, customer and arrival hour of their order."""
    heads = order_heads(spark, sf_dir).select("visit_id", "customer_id", "date", "arrival_hour")
    return order_lines(spark, sf_dir).join(heads, "visit_id")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits from the event stream: what one user did on one business day."""
    events = driver_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type", F.col("value").cast(MONEY).alias("value"), business_date("ts").alias("date")
    )
    is_drink = F.col("event_type").isin("purchase", "click")
    zero = F.lit(0).cast(MONEY)
    per_day = events.groupBy("user_id", "date").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.size(F.collect_set("event_type")).cast("bigint").alias("party_size"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(is_drink).alias("n_drink"),
        F.sum(F.when(is_drink, F.col("value")).otherwise(zero)).cast(MONEY).alias("drink_revenue"),
        F.sum("value").cast(MONEY).alias("total_revenue"),
    )
    # a user has at most one row per day of the calendar here
    first_day = F.min("date").over(W.partitionBy("user_id"))
    drink, total = F.col("drink_revenue"), F.col("total_revenue")
    food_rate, drink_rate = F.lit("0.45").cast("decimal(5,2)"), F.lit("0.65").cast("decimal(5,2)")
    share = F.coalesce(F.try_divide(drink.cast("double"), total.cast("double")), F.lit(0.0))
    hour = business_hour("first_ts")
    return per_day.withColumn("first_date", first_day).select(
        F.concat(F.col("user_id").cast("string"), F.lit("|"), F.col("date").cast("string")).alias("visit_id"),
        F.col("user_id").alias("customer_id"),
        "date",
        weekday("date").alias("weekday"),
        is_weekend("date").alias("is_weekend"),
        hour.alias("arrival_hour"),
        (hour >= 21).cast("bigint").alias("is_buzz_hour"),
        "party_size",
        F.expr("timestampdiff(MINUTE, first_ts, last_ts)").cast("bigint").alias("duration_min"),
        (F.col("date") > F.col("first_date")).cast("bigint").alias("is_repeat"),
        "n_items",
        (F.col("n_items") - F.col("n_drink")).alias("n_food"),
        "n_drink",
        (total - drink).cast(MONEY).alias("food_revenue"),
        "drink_revenue",
        "total_revenue",
        ((total - drink) * food_rate + drink * drink_rate).cast("decimal(18,4)").alias("total_profit"),
        half_up(share, 4).cast("decimal(9,4)").alias("drink_ratio"),
        half_up(F.try_divide(total.cast("double"), F.col("party_size").cast("double")), 1)
        .cast("decimal(18,1)")
        .alias("spend_per_head"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock count per store and menu item; lines returned ('R') are what did not sell."""
    lines = driver_table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("store_no"),
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    sold = F.sum(F.when(~F.col("returned"), F.col("quantity")).otherwise(0))
    returned = F.sum(F.when(F.col("returned"), F.col("quantity")).otherwise(0))
    per_item = (
        lines.join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("store_no", "item_id", "type", "tag_no")
        .agg(F.sum("quantity").alias("opening_stock"), sold.alias("qty_sold"), returned.alias("returned_qty"))
    )
    prices = menu(spark, sf_dir).select("item_id", "price", "profit_margin")
    variance = F.floor((F.col("returned_qty") * (F.col("tag_no") - 2)).cast("decimal(20,0)") / 4).cast("bigint")
    theoretical = F.col("opening_stock") * 2 - F.col("qty_sold")
    return (
        per_item.join(prices, "item_id")
        .select(
            F.concat(F.lit("ST"), F.col("store_no").cast("string")).alias("store_id"),
            F.col("item_id").alias("sku_id"),
            F.col("type").alias("category"),
            F.lit("unit").alias("uom"),
            "opening_stock",
            F.col("opening_stock").alias("received_qty"),
            "qty_sold",
            theoretical.alias("theoretical_stock"),
            (theoretical - variance).alias("closing_stock"),
            variance.alias("variance_qty_raw"),
            F.try_divide(variance.cast("double"), theoretical.cast("double")).alias("variance_ratio_legacy"),
            (F.col("price") * (F.lit(1) - F.col("profit_margin"))).cast(MONEY).alias("unit_cost"),
            F.col("price").cast(MONEY).alias("price"),
            F.lit(0.0).alias("on_order_qty"),
        )
    )


def part_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock count per store and part, as `inventory`; lines are summed per store and part before parts are joined."""
    lines = driver_table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("bigint")
    summed = lines.groupBy((F.col("l_suppkey") % 10).alias("store_no"), "l_partkey").agg(
        F.sum(quantity).alias("opening_stock"), F.sum(F.when(~returned, quantity).otherwise(0)).alias("qty_sold"), F.sum(F.when(returned, quantity).otherwise(0)).alias("returned_qty")
    )
    variance = F.floor((F.col("returned_qty") * (F.col("tag_no") - 2)).cast("decimal(20,0)") / 4).cast("bigint")
    theoretical = F.col("opening_stock") * 2 - F.col("qty_sold")
    return summed.join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("ST"), F.col("store_no").cast("string")).alias("store_id"),
        _sku_id(F.col("p_partkey")).alias("sku_id"),
        F.col("type").alias("category"),
        "opening_stock",
        F.col("opening_stock").alias("received_qty"),
        "qty_sold",
        theoretical.alias("theoretical_stock"),
        (theoretical - variance).alias("closing_stock"),
        variance.alias("variance_qty_raw"),
        F.lit(1).cast(MONEY).alias("unit_cost"),
    )


def _sku_store(part_key: Column) -> Column:
    return F.concat(F.lit("ST"), (part_key % 10).cast("string"))


def _sku_id(part_key: Column) -> Column:
    return F.concat(F.lit("P"), part_key.cast("string"))


def _sku_category(type_: Column, tag_no: Column) -> Column:
    return F.when((type_ == "dessert") & (tag_no == 4), "other").otherwise(type_)


def sku_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines at part level: store, sku, date, quantity. Each part is sold by one store."""
    return sku_sales_with_status(spark, sf_dir).drop("status")


def sku_sales_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`sku_sales` with the status of the line."""
    key = F.col("l_partkey")
    lines = driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        _sku_store(key).alias("store_id"),
        _sku_id(key).alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("qty_sold"),
        F.col("l_linestatus").alias("status"),
    )
    dates = driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("date")
    )
    return lines.join(dates, "l_orderkey").select("store_id", "sku_id", "date", "qty_sold", "status")


def sku_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per part: cost from price and margin, stock levels from the key."""
    key = F.col("p_partkey")
    price = (F.col("retail_cents").cast("decimal(16,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)
    return parts(spark, sf_dir).select(
        _sku_store(key).alias("store_id"),
        _sku_id(key).alias("sku_id"),
        _sku_category(F.col("type"), F.col("tag_no")).alias("category"),
        (price * (F.lit(1) - F.col("profit_margin"))).cast(MONEY).alias("unit_cost"),
        price.alias("price"),
        (key * 37 % 160).alias("closing_stock"),
        F.when(key % 7 == 0, 12).otherwise(0).cast("bigint").alias("on_order_qty"),
    )


def on_hand(profile: DataFrame) -> DataFrame:
    """Stock on hand per store and item, for the advice: (1 .. 5) x 3 mean days, floored, none for class 3."""
    step = F.substring_index("item_id", "-", -1).cast("int")
    counted = profile.filter(step != 3).withColumn("_step", step.cast("bigint") + 1)
    return counted.select("store_id", "item_id", F.expr("total_units * _step * 3 div business_days").alias("on_hand"))


def cost_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label/value sheet per order year: padded labels, repeated labels, some cells that are not numbers."""
    orders = driver_table(spark, sf_dir, "orders")
    cell = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(
        F.col("o_totalprice").cast(MONEY).cast("string")
    )
    return orders.select(
        F.year("o_orderdate").cast("bigint").alias("period"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("label"),
        F.when(F.col("o_orderkey") % 13 != 0, cell).alias("value"),
        F.col("o_orderkey").alias("row_no"),
    )


def monthly_costs(inventory_df: DataFrame) -> DataFrame:
    """Cost lines per store: food from the purchases, the others as fixed shares of revenue."""
    totals = inventory_df.groupBy("store_id").agg(
        F.sum(F.col("qty_sold") * F.col("price")).alias("revenue"),
        F.sum(F.col("received_qty") * F.col("unit_cost")).alias("food"),
    )
    # one share inside, one above, one below its band, one on its upper end
    shares = {"labour": "0.27", "rent": "0.16", "utilities": "0.02", "marketing": "0.03"}
    lines = [F.struct(F.lit("food").alias("line"), F.col("food").cast("decimal(38,4)").alias("amount"))]
    lines += [
        F.struct(
            F.lit(name).alias("line"),
            (F.col("revenue").cast("decimal(28,2)") * F.lit(s).cast("decimal(3,2)"))
            .cast("decimal(38,4)")
            .alias("amount"),
        )
        for name, s in shares.items()
    ]
    return totals.select("store_id", "revenue", F.inline(F.array(*lines)))


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries by supplier: on time where the line is fulfilled, defective where it was returned."""
    items = parts(spark, sf_dir).select("p_partkey", F.col("type").alias("category"))
    return (
        driver_table(spark, sf_dir, "lineitem")
        .join(items, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_suppkey").alias("supplier_id"),
            "category",
            (F.col("l_linestatus") == "F").alias("on_time"),
            (F.col("l_returnflag") == "R").alias("defective"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
        )
    )


def supplier_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and its first sku, with terms by its category except for the payment term."""
    category = lookup((F.col("s_suppkey") % 5).cast("int"), {0: "main", 1: "side", 2: "dessert", 3: "drink", 4: "other"})
    return driver_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        _sku_id(F.col("s_suppkey")).alias("sku_id"),
        category.alias("category"),
        lookup(category, {"drink": 5.0, "dessert": 1.0}, 2.0).alias("lead_time_days_avg"),
        lookup(category, {"drink": 1.2, "main": 0.6, "dessert": 0.3}, 0.5).alias("lead_time_days_std"),
        (F.col("s_suppkey") % 4 * 15 + 15).alias("payment_term_days"),
    )


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines of the stores that count stock: store, menu item, date, quantity."""
    lines = driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.concat(F.lit("ST"), (F.col("l_suppkey") % 10).cast("string")).alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("qty_sold"),
    )
    dates = driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("date")
    )
    items = parts(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), F.col("item_id").alias("sku_id"))
    return lines.join(items, "l_partkey").join(dates, "l_orderkey").select("store_id", "sku_id", "date", "qty_sold")
