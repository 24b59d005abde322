"""Workbook sheets, given as tables, to normalised fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.exprs import weekday

# Column headings of the sales sheet.
SALES_HEADINGS = {
    "日期": "date",
    "品項": "sku_id",
    "分類": "category",
    "數量": "qty_sold",
    "單價(元)": "unit_price",
    "小計(元)": "amount",
}

# Column headings of the stock-count sheet.
INVENTORY_HEADINGS = {
    "品項": "sku_id",
    "分類": "category",
    "單位": "uom",
    "期初庫存(份)": "opening_stock",
    "本月叫貨量(份)": "received_qty",
    "本月銷售量(份)": "qty_sold",
    "理論庫存(份)": "theoretical_stock",
    "實際盤點(份)": "closing_stock",
    "差異/耗損(份)": "variance_qty_raw",
    "差異率": "variance_ratio_legacy",
    "進貨成本單價(元)": "unit_cost",
    "售價(元)": "price",
}


def _renamed(raw: DataFrame, headings: dict[str, str]) -> DataFrame:
    return raw.withColumnsRenamed(headings)


def _store(store_id: str | Column) -> Column:
    return F.lit(store_id) if isinstance(store_id, str) else store_id


def normalise_sales(raw: DataFrame, store_id: str | Column = "S01") -> DataFrame:
    """Sales sheet to one row per line with a parsed date, its weekday and the store."""
    dated = _renamed(raw, SALES_HEADINGS).withColumn("date", F.to_date("date"))
    return dated.select(
        _store(store_id).alias("store_id"),
        "sku_id",
        "category",
        "date",
        weekday("date").alias("weekday"),
        "qty_sold",
        "unit_price",
        "amount",
    )


def normalise_inventory(raw: DataFrame, store_id: str | Column = "S01") -> DataFrame:
    """Stock-count sheet to one row per item; what is on order is not in the sheet and starts at zero."""
    return (
        _renamed(raw, INVENTORY_HEADINGS)
        .withColumn("store_id", _store(store_id))
        .withColumn("on_order_qty", F.lit(0.0))
    )


def cost_lines(raw: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Label/value sheet (label, value, row_no) to numeric lines: trimmed labels, last numeric value wins."""
    value = F.col("value").try_cast("double")
    lines = raw.select(*keys, F.trim("label").alias("line"), value.alias("value"), "row_no")
    return (
        lines.filter(F.col("line").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys, "line")
        .agg(F.max_by("value", "row_no").alias("amount"))
    )


def cost_summary(lines: DataFrame, names: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Cost lines side by side, one column per name, one row per key."""
    return lines.groupBy(*keys).pivot("line", names).agg(F.max("amount"))
