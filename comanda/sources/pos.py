"""Point-of-sale exports (menu, item lines, visits) as the tables the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators.rerank import with_categories
from comanda.sources import schemas
from comanda.sources.tables import read_table


def load_menu(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Menu with the category of its drinks."""
    return with_categories(read_table(spark, path, schemas.MENU, fmt))


def load_visits(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.VISITS, fmt)


def load_order_items(
    spark: SparkSession, path: str, menu: DataFrame, store_id: str | Column = "S01", fmt: str = "csv"
) -> DataFrame:
    """Item lines, one per unit ordered, with store, units and the margin of the item."""
    lines = read_table(spark, path, schemas.ORDER_ITEMS, fmt)
    store = F.lit(store_id) if isinstance(store_id, str) else store_id
    margins = menu.select("item_id", "profit_margin")
    return lines.join(margins, "item_id", "left").withColumns({"store_id": store, "units": F.lit(1).cast("bigint")})


def visit_dishes(items: DataFrame, visits: DataFrame, foods: tuple[str, str]) -> DataFrame:
    """Visits with their hour and dishes (visit_id, arrival_hour, foods), to recommend drinks for."""
    ordered = items.filter(F.col("visit_id").isNotNull() & F.col("type").isin(*foods))
    dishes = ordered.groupBy("visit_id").agg(F.collect_set("item_id").alias("foods"))
    return dishes.join(visits.select("visit_id", "arrival_hour"), "visit_id")
