"""SQL of the sheets, the visit rollup and the key figures."""

from __future__ import annotations

from comanda.plans.oracle import SELECTS, hu, rt, select, view

view(
    "inventory_v",
    """SELECT concat('ST', CAST(store_no AS VARCHAR)) AS store_id, sku_id, category, 'unit' AS uom, opening_stock, received_qty, qty_sold,
  opening_stock + received_qty - qty_sold AS theoretical_stock,
  opening_stock + received_qty - qty_sold - variance_qty_raw AS closing_stock, variance_qty_raw,
  CAST(price * (1 - profit_margin) AS DECIMAL(18,2)) AS unit_cost, price
FROM (SELECT l_suppkey % 10 AS store_no, p.item_id AS sku_id, p.type AS category,
    CAST(sum(l_quantity) AS BIGINT) AS opening_stock, CAST(sum(l_quantity) AS BIGINT) AS received_qty,
    CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS qty_sold,
    CAST(floor(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) * (p.tag_no - 2) / 4) AS BIGINT) AS variance_qty_raw
  FROM lineitem JOIN parts_b p ON l_partkey = p_partkey GROUP BY 1, 2, 3, p.tag_no) t
JOIN menu_b m ON m.item_id = sku_id""",
)
view(
    "visits_v",
    f"""SELECT concat(CAST(user_id AS VARCHAR), '|', CAST(date AS VARCHAR)) AS visit_id, user_id AS customer_id, date,
  isodow(date) - 1 AS weekday, CASE WHEN isodow(date) IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
  arrival_hour, CASE WHEN arrival_hour >= 21 THEN 1 ELSE 0 END AS is_buzz_hour, party_size,
  date_sub('minute', first_ts, last_ts) AS duration_min, is_repeat, n_items, n_drink, n_items - n_drink AS n_food,
  total_revenue - drink_revenue AS food_revenue, drink_revenue, total_revenue,
  CAST((total_revenue - drink_revenue) * 0.45 + drink_revenue * 0.65 AS DECIMAL(18,4)) AS total_profit,
  CAST({hu('coalesce(' + rt('drink_revenue', 'total_revenue') + ', 0)', 4)} AS DECIMAL(9,4)) AS drink_ratio,
  CAST({hu(rt('total_revenue', 'party_size'), 1)} AS DECIMAL(18,1)) AS spend_per_head
FROM (SELECT user_id, date, min(ts) AS first_ts, max(ts) AS last_ts,
    CASE WHEN hour(min(ts)) < 4 THEN hour(min(ts)) + 24 ELSE hour(min(ts)) END AS arrival_hour,
    count(DISTINCT event_type) AS party_size, count(*) AS n_items,
    CAST(sum(CASE WHEN event_type IN ('purchase','click') THEN 1 ELSE 0 END) AS BIGINT) AS n_drink,
    CAST(sum(CASE WHEN event_type IN ('purchase','click') THEN value ELSE 0 END) AS DECIMAL(18,2)) AS drink_revenue,
    CAST(sum(value) AS DECIMAL(18,2)) AS total_revenue,
    CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY date) > 1 THEN 1 ELSE 0 END AS is_repeat
  FROM (SELECT user_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS value, CAST(ts - INTERVAL 4 HOUR AS DATE) AS date FROM events) e
  GROUP BY user_id, date) v""",
)

select(
    "norm_sales",
    f"""SELECT store_id, item_id AS sku_id, type AS category, CAST(date AS VARCHAR) AS date, isodow(date) - 1 AS weekday, units AS qty_sold,
  {hu(rt('price', 'units'), 2)} AS unit_price, CAST(price AS DOUBLE) AS amount FROM order_items_b""",
)
select(
    "norm_inventory",
    f"""SELECT sku_id, category, uom, opening_stock, received_qty, qty_sold, theoretical_stock, closing_stock, variance_qty_raw,
  {hu(rt('variance_qty_raw', 'theoretical_stock'), 9)} AS variance_ratio_legacy, CAST(unit_cost AS DOUBLE) AS unit_cost,
  CAST(price AS DOUBLE) AS price, store_id, CAST(0 AS DOUBLE) AS on_order_qty FROM inventory_v""",
)
view(
    "cost_lines_v",
    """SELECT period, line, CAST(arg_max(value, o_orderkey) AS DOUBLE) AS amount FROM (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS period, trim(concat('  ', o_orderpriority, ' ')) AS line, o_orderkey,
    CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0) t
GROUP BY period, line""",
)
select("cost_lines", "SELECT period, line, amount FROM cost_lines_v")
select(
    "cost_summary_wide",
    """SELECT period, max(CASE WHEN line = '1-URGENT' THEN amount END) AS "1-URGENT", max(CASE WHEN line = '2-HIGH' THEN amount END) AS "2-HIGH",
  max(CASE WHEN line = '3-MEDIUM' THEN amount END) AS "3-MEDIUM", max(CASE WHEN line = '4-NOT SPECIFIED' THEN amount END) AS "4-NOT SPECIFIED",
  max(CASE WHEN line = '5-LOW' THEN amount END) AS "5-LOW" FROM cost_lines_v GROUP BY period""",
)
select(
    "visit_rollup",
    f"""SELECT visit_id, customer_id, CAST(date AS VARCHAR) AS date, isodow(date) - 1 AS weekday,
  CAST(CASE WHEN isodow(date) IN (5, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend, arrival_hour,
  CAST(CASE WHEN arrival_hour >= 21 THEN 1 ELSE 0 END AS BIGINT) AS is_buzz_hour, party_size, duration_min, is_repeat,
  n_items, n_items - n_drink AS n_food, n_drink, CAST(round(total - drink, 1) AS DOUBLE) AS food_revenue,
  CAST(round(drink, 1) AS DOUBLE) AS drink_revenue, CAST(round(total, 1) AS DOUBLE) AS total_revenue,
  CAST(round(profit, 1) AS DOUBLE) AS total_profit, {hu('coalesce(' + rt('drink', 'total') + ', 0)', 4)} AS drink_ratio,
  {hu(rt('total', 'party_size'), 1)} AS spend_per_head
FROM (SELECT i.visit_id, CAST(sum(units) AS BIGINT) AS n_items, CAST(sum(CASE WHEN type = 'drink' THEN units ELSE 0 END) AS BIGINT) AS n_drink,
    sum(CASE WHEN type = 'drink' THEN price ELSE 0 END) AS drink, sum(price) AS total, sum(profit) AS profit
  FROM order_items_b i GROUP BY i.visit_id) s JOIN heads_b USING (visit_id)""",
)
select(
    "line_profit",
    """SELECT visit_id, item_id, units, CAST(price AS DOUBLE) AS price, CAST(round(price * profit_margin, 1) AS DOUBLE) AS profit FROM order_items_b""",
)

# --- key figures -------------------------------------------------------------------------------------------------

PER_HEAD = f"CAST({rt('n_drink', 'party_size')} AS DECIMAL(18,9))"


def avg(x: str, digits: int) -> str:
    return hu(rt(f"sum({x})", f"count({x})"), digits)


select(
    "kpi_summary",
    f"""SELECT count(DISTINCT date) AS n_days, count(*) AS n_visits, {hu(rt('count(*)', 'count(DISTINCT date)'), 2)} AS visits_per_day,
  CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, {hu(rt('sum(total_revenue)', 'count(DISTINCT date)'), 2)} AS revenue_per_day,
  CAST(round(sum(total_profit), 2) AS DOUBLE) AS total_profit, {hu(rt('sum(total_profit)', 'sum(total_revenue)'), 4)} AS profit_margin,
  {avg('spend_per_head', 2)} AS avg_spend_per_head, {avg('total_revenue', 2)} AS avg_revenue, {avg('party_size', 2)} AS avg_party_size,
  {avg('duration_min', 2)} AS avg_duration, {hu(rt('sum(drink_revenue)', 'sum(total_revenue)'), 4)} AS drink_ratio,
  {avg(PER_HEAD, 4)} AS drinks_per_head, {hu(rt('sum(CASE WHEN n_drink = 0 THEN 1 ELSE 0 END)', 'count(*)'), 4)} AS zero_drink_share
FROM visits_v""",
)
STORE = "concat('ST', CAST(customer_id % 10 AS VARCHAR))"
select("kpi_by_store", SELECTS["kpi_summary"].replace("SELECT ", f"SELECT {STORE} AS store_id, ", 1) + f" GROUP BY {STORE}")
view("profit_lines_v", "SELECT store_id, item_id, type, units, price, round(price * profit_margin, 1) AS profit FROM order_items_b")
select(
    "profit_structure",
    f"""SELECT CAST(is_drink AS BIGINT) AS is_drink, CAST(r AS DOUBLE) AS revenue, CAST(p AS DOUBLE) AS profit,
  {hu(rt('r', 'sum(r) OVER ()'), 4)} AS revenue_share, {hu(rt('p', 'sum(p) OVER ()'), 4)} AS profit_share
FROM (SELECT CASE WHEN type = 'drink' THEN 1 ELSE 0 END AS is_drink, sum(price) AS r, sum(profit) AS p FROM profit_lines_v GROUP BY 1) t""",
)
select("visits_by_hour", "SELECT CAST(arrival_hour AS BIGINT) AS arrival_hour, count(*) AS n_visits FROM visits_v GROUP BY 1")
select(
    "revenue_by_weekday",
    "SELECT CAST(weekday AS BIGINT) AS weekday, CAST(sum(total_revenue) AS DOUBLE) AS revenue FROM visits_v GROUP BY 1",
)
view("steps_v", "SELECT CAST(drink_ratio * 10000 AS BIGINT) AS step FROM visits_v")
select(
    "drink_ratio_hist",
    f"""SELECT bin, {hu("(lo + bin * (CAST(hi - lo AS DOUBLE) / 30)) / 10000", 6)} AS from_ratio,
  {hu("(lo + (bin + 1) * (CAST(hi - lo AS DOUBLE) / 30)) / 10000", 6)} AS to_ratio,
  (SELECT count(*) FROM steps_v WHERE least((step - lo) * 30 // greatest(hi - lo, 1), 29) = bin) AS n_visits
FROM (SELECT min(step) AS lo, max(step) AS hi FROM steps_v) e, (SELECT unnest(range(30)) AS bin) b""",
)
select(
    "drink_ratio_kde",
    f"""SELECT point, {hu('max(x) / 10000', 6)} AS drink_ratio,
  {hu("sum(exp(-0.5 * ((x - step) / width) * ((x - step) / width))) * (CAST(max(hi) - max(lo) AS DOUBLE) / 30) / (max(width) * sqrt(2 * pi()))", 4)} AS height
FROM (SELECT step, lo, hi, width, point, lo + point * (CAST(hi - lo AS DOUBLE) / 199) AS x FROM steps_v,
  (SELECT min(step) AS lo, max(step) AS hi, stddev_samp(step) * pow(count(*), -0.2) AS width FROM steps_v) e, (SELECT unnest(range(200)) AS point) g) t
GROUP BY point""",
)
select(
    "duration_vs_drinks",
    f"""SELECT duration_bin, count(*) AS n_visits, {avg(PER_HEAD, 4)} AS drinks_per_head FROM (
  SELECT *, CASE WHEN duration_min > 0 AND duration_min <= 60 THEN '(0,60]' WHEN duration_min > 60 AND duration_min <= 240 THEN '(60,240]'
    WHEN duration_min > 240 AND duration_min <= 480 THEN '(240,480]' WHEN duration_min > 480 AND duration_min <= 720 THEN '(480,720]'
    WHEN duration_min > 720 AND duration_min <= 1440 THEN '(720,1440]' END AS duration_bin FROM visits_v) t
WHERE duration_bin IS NOT NULL GROUP BY duration_bin""",
)
select(
    "top_items_profit",
    """SELECT item_id, CAST(sum(profit) AS DOUBLE) AS total_profit FROM profit_lines_v GROUP BY item_id ORDER BY sum(profit) DESC, item_id LIMIT 15""",
)
view(
    "hours_v",
    f"SELECT CAST(arrival_hour AS BIGINT) AS arrival_hour, count(*) AS n_visits, {avg('drink_ratio', 4)} AS avg_drink_ratio FROM visits_v GROUP BY 1",
)
select("drink_ratio_by_hour", "SELECT arrival_hour, avg_drink_ratio FROM hours_v")
select("weak_hours", "SELECT * FROM hours_v WHERE n_visits >= 30 ORDER BY avg_drink_ratio, arrival_hour LIMIT 2")
select(
    "weak_hours_by_store",
    f"""SELECT store_id, arrival_hour, n_visits, avg_drink_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY avg_drink_ratio, arrival_hour) AS k FROM (
    SELECT {STORE} AS store_id, CAST(arrival_hour AS BIGINT) AS arrival_hour, count(*) AS n_visits, {avg('drink_ratio', 4)} AS avg_drink_ratio
    FROM visits_v GROUP BY 1, 2) h) r WHERE k <= 2""",
)
select(
    "zero_drink_visits",
    f"""SELECT count(*) FILTER (WHERE n_drink = 0) AS n_zero, {hu(rt('count(*) FILTER (WHERE n_drink = 0)', 'count(*)'), 4)} AS zero_share,
  {hu(rt('sum(spend_per_head) FILTER (WHERE n_drink = 0)', 'count(*) FILTER (WHERE n_drink = 0)'), 2)} AS zero_spend_per_head,
  {avg('spend_per_head', 2)} AS avg_spend_per_head,
  {hu(rt('sum(drink_revenue) FILTER (WHERE n_drink > 0) * count(*) FILTER (WHERE n_drink = 0)', 'count(*) FILTER (WHERE n_drink > 0) * 2'), 2)} AS lost_revenue
FROM visits_v""",
)
select(
    "weekend_split",
    f"""SELECT CAST(is_weekend AS BIGINT) AS is_weekend, count(*) AS n_visits, {hu(rt('count(*)', 'count(DISTINCT date)'), 2)} AS visits_per_day,
  {avg('spend_per_head', 2)} AS avg_spend_per_head, {avg('drink_ratio', 4)} AS avg_drink_ratio FROM visits_v GROUP BY is_weekend""",
)
select(
    "hidden_gems",
    f"""SELECT item_id, units, unit_profit, CAST(total_profit AS DOUBLE) AS total_profit, {hu('units_pct', 6)} AS units_pct, {hu('profit_pct', 6)} AS profit_pct FROM (
  SELECT *, (rank() OVER (ORDER BY units) + (count(*) OVER (PARTITION BY units) - 1) / 2.0) / count(*) OVER () AS units_pct,
    (rank() OVER (ORDER BY unit_profit) + (count(*) OVER (PARTITION BY unit_profit) - 1) / 2.0) / count(*) OVER () AS profit_pct
  FROM (SELECT item_id, CAST(sum(units) AS BIGINT) AS units, {hu(rt('sum(profit)', 'sum(units)'), 4)} AS unit_profit, sum(profit) AS total_profit
    FROM profit_lines_v GROUP BY item_id) s) t WHERE profit_pct > 0.6 AND units_pct < 0.4""",
)
select(
    "hidden_gems_by_store",
    f"""SELECT store_id, item_id, units, unit_profit, CAST(total_profit AS DOUBLE) AS total_profit, {hu('units_pct', 6)} AS units_pct, {hu('profit_pct', 6)} AS profit_pct FROM (
  SELECT *, (rank() OVER (PARTITION BY store_id ORDER BY units) + (count(*) OVER (PARTITION BY store_id, units) - 1) / 2.0) / count(*) OVER (PARTITION BY store_id) AS units_pct,
    (rank() OVER (PARTITION BY store_id ORDER BY unit_profit) + (count(*) OVER (PARTITION BY store_id, unit_profit) - 1) / 2.0) / count(*) OVER (PARTITION BY store_id) AS profit_pct
  FROM (SELECT store_id, item_id, CAST(sum(units) AS BIGINT) AS units, {hu(rt('sum(profit)', 'sum(units)'), 4)} AS unit_profit, sum(profit) AS total_profit
    FROM profit_lines_v GROUP BY store_id, item_id) s) t WHERE profit_pct > 0.6 AND units_pct < 0.4""",
)
select(
    "buzz_split",
    f"""SELECT CAST(is_buzz_hour AS BIGINT) AS is_buzz_hour, count(*) AS n_visits, {avg('drink_ratio', 4)} AS avg_drink_ratio,
  {hu(rt('sum(drink_revenue)', 'sum(total_revenue)'), 4)} AS drink_share FROM visits_v GROUP BY is_buzz_hour""",
)
