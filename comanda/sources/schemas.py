"""Declared schemas of the domain tables."""

from __future__ import annotations

MENU = "item_id STRING, item_name STRING, type STRING, pairing_tag STRING, price DECIMAL(12,2), profit_margin DECIMAL(5,4)"

ORDER_ITEMS = (
    "visit_id STRING, date DATE, item_id STRING, item_name STRING, type STRING, pairing_tag STRING, "
    "price DECIMAL(12,2), profit DECIMAL(12,1)"
)

VISITS = (
    "visit_id STRING, customer_id STRING, date DATE, weekday BIGINT, is_weekend BIGINT, arrival_hour BIGINT, "
    "is_buzz_hour BIGINT, party_size BIGINT, duration_min BIGINT, is_repeat BIGINT, n_items BIGINT, n_food BIGINT, "
    "n_drink BIGINT, food_revenue DECIMAL(18,2), drink_revenue DECIMAL(18,2), total_revenue DECIMAL(18,2), "
    "total_profit DECIMAL(18,2), drink_ratio DECIMAL(9,4), spend_per_head DECIMAL(18,1)"
)

SALES_DAILY = (
    "store_id STRING, sku_id STRING, category STRING, date DATE, weekday BIGINT, qty_sold BIGINT, "
    "unit_price DECIMAL(12,2), amount DECIMAL(18,2)"
)

INVENTORY = (
    "sku_id STRING, category STRING, uom STRING, opening_stock BIGINT, received_qty BIGINT, qty_sold BIGINT, "
    "theoretical_stock BIGINT, closing_stock BIGINT, variance_qty_raw BIGINT, variance_ratio_legacy DOUBLE, "
    "unit_cost DECIMAL(12,2), price DECIMAL(12,2), store_id STRING, on_order_qty DOUBLE"
)

RULES = (
    "antecedent STRING, antecedent_id STRING, consequent STRING, consequent_id STRING, support DOUBLE, "
    "confidence DOUBLE, lift DOUBLE, unit_profit DECIMAL(12,1), expected_profit DECIMAL(12,1)"
)
