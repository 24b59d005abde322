"""SQL of demand and replenishment."""

from __future__ import annotations

from comanda.params import SERVICE_LEVEL_Z
from comanda.plans.oracle import hu, rt, select, view
from comanda.plans.reorder_queries import OTHER_LEVELS

view(
    "daily_v",
    """SELECT store_id, date, item_id, type, pairing_tag, CAST(sum(units) AS BIGINT) AS units, isodow(date) - 1 AS weekday
FROM order_items_b GROUP BY store_id, date, item_id, type, pairing_tag""",
)
view("days_v", "SELECT DISTINCT store_id, date, weekday FROM daily_v WHERE weekday <> 0")
# the full item x business day grid, days without sales as zero
view(
    "grid_v",
    """SELECT i.store_id, i.item_id, d.date, d.weekday, coalesce(s.units, 0) AS units
FROM (SELECT DISTINCT store_id, item_id FROM daily_v WHERE weekday <> 0) i JOIN days_v d ON d.store_id = i.store_id
LEFT JOIN daily_v s ON s.store_id = i.store_id AND s.item_id = i.item_id AND s.date = d.date""",
)


def std(s: str, sq: str, n: str) -> str:
    return (
        f"CASE WHEN {n} > 1 THEN sqrt(CAST({sq} * {n} - CAST({s} AS HUGEINT) * {s} AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE)) END"
    )


view(
    "dense_v",
    f"""SELECT *, {rt('total_units', 'business_days')} AS avg_daily, {std('total_units', 'sq', 'business_days')} AS std_daily
FROM (SELECT store_id, item_id, CAST(sum(units) AS BIGINT) AS total_units, CAST(sum(units * units) AS BIGINT) AS sq, count(*) AS business_days,
    stddev_samp(units) AS std_direct, {rt('sum(CASE WHEN weekday IN (4, 5) THEN units END)', 'count(CASE WHEN weekday IN (4, 5) THEN 1 END)')} AS peak_daily
  FROM grid_v GROUP BY store_id, item_id) t""",
)
view(
    "policy_v",
    """SELECT item_id, type, pairing_tag, price, profit_margin,
  CAST(CASE WHEN type = 'drink' THEN 365 ELSE CASE pairing_tag WHEN 'Seafood' THEN 2 WHEN 'Dessert' THEN 3 WHEN 'Red_Meat' THEN 4
    WHEN 'Universal' THEN 7 WHEN 'Cheese' THEN 14 WHEN 'Fried' THEN 30 ELSE 7 END END AS BIGINT) AS shelf_life,
  CAST(CASE WHEN type = 'drink' THEN 5 ELSE CASE pairing_tag WHEN 'Seafood' THEN 1 WHEN 'Dessert' THEN 1 WHEN 'Red_Meat' THEN 2
    WHEN 'Universal' THEN 2 WHEN 'Cheese' THEN 3 WHEN 'Fried' THEN 3 ELSE 2 END END AS BIGINT) AS lead_time FROM menu_b""",
)
view(
    "profile_v",
    f"""SELECT *, {hu(rt('running', 'total'), 3)} AS cum_profit_share,
  CASE WHEN running <= total * 0.70 THEN 'A' WHEN running <= total * 0.90 THEN 'B' ELSE 'C' END AS abc
FROM (SELECT *, sum(total_profit) OVER (PARTITION BY store_id ORDER BY total_profit DESC, item_id ROWS UNBOUNDED PRECEDING) AS running,
    sum(total_profit) OVER (PARTITION BY store_id) AS total
  FROM (SELECT *, CAST(round(unit_profit * total_units, 0) AS DECIMAL(28,0)) AS total_profit
    FROM (SELECT d.*, p.* EXCLUDE (item_id), CAST(round(price * profit_margin, 1) AS DECIMAL(12,1)) AS unit_profit
      FROM dense_v d JOIN policy_v p ON p.item_id = d.item_id) a) b) c""",
)
view(
    "advice_v",
    f"""SELECT *, base * lead_time + ss AS rop, greatest(0.0, oh - base * shelf_life) AS excess,
  CASE WHEN oh / NULLIF(base, 0) < lead_time THEN 'urgent' WHEN oh < base * lead_time + ss THEN 'low' ELSE 'enough' END AS status,
  CAST(CASE WHEN ss IS NULL THEN 0 ELSE ceil(greatest(0.0, least(base * lead_time + ss - oh, base * shelf_life - oh))) END AS BIGINT) AS suggested_qty
FROM (SELECT *, peak_daily AS base, z * std_daily * sqrt(CAST(lead_time AS DOUBLE)) AS ss,
    CASE WHEN tag = 3 THEN 0.0::DOUBLE ELSE CAST(total_units * (tag + 1) * 3 // business_days AS DOUBLE) END AS oh
  FROM (SELECT *, CAST(right(item_id, 1) AS BIGINT) AS tag, CASE abc WHEN 'A' THEN 0.98 WHEN 'B' THEN 0.95 ELSE 0.90 END AS service_level,
      CAST(CASE abc WHEN 'A' THEN 2.05 WHEN 'B' THEN 1.65 ELSE 1.28 END AS DOUBLE) AS z FROM profile_v) p) q""",
)
COST = "excess * CAST(price AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(profit_margin AS DOUBLE))"

select("daily_demand", "SELECT store_id, CAST(date AS VARCHAR) AS date, item_id, type, pairing_tag, units, CAST(weekday AS BIGINT) AS weekday FROM daily_v")
select("business_days", "SELECT store_id, CAST(date AS VARCHAR) AS date, CAST(weekday AS BIGINT) AS weekday FROM days_v")
select(
    "dense_demand_stats",
    f"""SELECT store_id, item_id, total_units, {hu('avg_daily', 6)} AS avg_daily, {hu('std_direct', 6)} AS std_daily, business_days FROM dense_v""",
)
select("peak_demand", f"SELECT store_id, item_id, {hu('peak_daily', 6)} AS peak_daily FROM dense_v")
select(
    "abc_profit",
    """SELECT store_id, item_id, total_units, CAST(unit_profit AS DOUBLE) AS unit_profit, CAST(total_profit AS DOUBLE) AS total_profit, cum_profit_share, abc FROM profile_v""",
)
select("item_policy", "SELECT item_id, type, pairing_tag, shelf_life, lead_time FROM policy_v")
select(
    "demand_profile",
    f"""SELECT store_id, item_id, total_units, {hu('avg_daily', 6)} AS avg_daily, {hu('std_daily', 6)} AS std_daily, {hu('peak_daily', 6)} AS peak_daily,
  business_days, type, pairing_tag, CAST(price AS DOUBLE) AS price, CAST(profit_margin AS DOUBLE) AS profit_margin, CAST(unit_profit AS DOUBLE) AS unit_profit,
  CAST(total_profit AS DOUBLE) AS total_profit, cum_profit_share, abc, shelf_life, lead_time FROM profile_v""",
)
select("safety_stock_a", f"SELECT store_id, item_id, z, {hu('ss', 4)} AS safety_stock FROM advice_v")
select(
    "reorder_advice",
    f"""SELECT store_id, item_id, type, abc, CAST(service_level AS DOUBLE) AS service_level, {hu('base', 1)} AS daily_demand, {hu('std_daily', 1)} AS demand_std,
  lead_time, shelf_life, {hu('ss', 1)} AS safety_stock, {hu('rop', 1)} AS reorder_point, {hu('oh', 1)} AS on_hand, {hu('oh / NULLIF(base, 0)', 1)} AS days_of_cover,
  suggested_qty, status, {hu('excess', 1)} AS excess_qty, {hu(COST, 0)} AS spoilage_cost, CAST(total_profit AS DOUBLE) AS total_profit,
  std_daily IS NULL AS insufficient_data FROM advice_v""",
)
view("risky_v", f"SELECT *, {hu('excess', 1)} AS excess_qty, {hu(COST, 0)} AS spoilage_cost FROM advice_v WHERE {hu('excess', 1)} > 0")
select(
    "spoilage_risk",
    f"""SELECT store_id, item_id, abc, shelf_life, {hu('oh', 1)} AS on_hand, excess_qty, spoilage_cost,
  sum(spoilage_cost) OVER (PARTITION BY store_id) AS total_spoilage_cost FROM risky_v
QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY spoilage_cost DESC, item_id) <= 8""",
)
select(
    "abc_summary",
    f"""SELECT store_id, abc, count(*) AS n_items, {hu(rt('sum(total_profit)', 'max(total)'), 4)} AS profit_share,
  CAST(CASE abc WHEN 'A' THEN 0.98 WHEN 'B' THEN 0.95 ELSE 0.90 END AS DOUBLE) AS service_level FROM profile_v GROUP BY store_id, abc""",
)
select(
    "advice_summary",
    f"""SELECT store_id, count(*) FILTER (WHERE status = 'urgent') AS n_urgent, count(*) FILTER (WHERE status = 'low') AS n_low,
  count(*) FILTER (WHERE status = 'enough') AS n_enough, CAST(sum(suggested_qty) AS BIGINT) AS total_suggested, sum({hu(COST, 0)}) AS total_spoilage_cost
FROM advice_v GROUP BY store_id""",
)

# --- usage value and variation -----------------------------------------------------------------------------------

view(
    "sku_v",
    """SELECT concat('ST', CAST(p_partkey % 10 AS VARCHAR)) AS store_id, concat('P', CAST(p_partkey AS VARCHAR)) AS sku_id,
  CASE WHEN type = 'dessert' AND tag_no = 4 THEN 'other' ELSE type END AS category,
  CAST(round(CAST(retail_cents AS DECIMAL(16,0)) * (1 - profit_margin), 0) / 100 AS DECIMAL(18,2)) AS unit_cost,
  CAST(CAST(retail_cents AS DECIMAL(16,0)) / 100 AS DECIMAL(18,2)) AS price,
  p_partkey * 37 % 160 AS closing_stock, CASE WHEN p_partkey % 7 = 0 THEN 12 ELSE 0 END AS on_order_qty, p_partkey
FROM parts_b""",
)
view(
    "sku_days_v",
    """SELECT concat('ST', CAST(l_partkey % 10 AS VARCHAR)) AS store_id, concat('P', CAST(l_partkey AS VARCHAR)) AS sku_id,
  CAST(o_orderdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS qty_sold
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
)
view(
    "supplier_v",
    """SELECT store_id, sku_id, category, concat('SUP-', category) AS supplier_id, unit_cost AS unit_price,
  CAST(CASE category WHEN 'drink' THEN 365 WHEN 'side' THEN 5 WHEN 'main' THEN 3 WHEN 'dessert' THEN 3 ELSE 5 END AS BIGINT) AS shelf_life_days,
  true AS needs_data_fill,
  CAST(CASE category WHEN 'drink' THEN 5 WHEN 'side' THEN 2 WHEN 'main' THEN 2 WHEN 'dessert' THEN 1 ELSE 2 END AS DOUBLE) AS lead_time_days_avg,
  CAST(CASE category WHEN 'drink' THEN 1.2 WHEN 'side' THEN 0.5 WHEN 'main' THEN 0.6 WHEN 'dessert' THEN 0.3 ELSE 0.5 END AS DOUBLE) AS lead_time_days_std,
  CAST(CASE category WHEN 'drink' THEN 12 WHEN 'side' THEN 20 WHEN 'main' THEN 10 WHEN 'dessert' THEN 12 ELSE 10 END AS BIGINT) AS moq,
  CAST(CASE category WHEN 'drink' THEN 12 WHEN 'side' THEN 10 WHEN 'main' THEN 5 WHEN 'dessert' THEN 6 ELSE 1 END AS BIGINT) AS pack_size,
  CAST(CASE category WHEN 'drink' THEN 45 ELSE 30 END AS BIGINT) AS payment_term_days
FROM sku_v""",
)
view(
    "stats_v",
    f"""SELECT *, {rt('total_qty', 'n_days')} AS demand_avg, {std('total_qty', 'sq', 'n_days')} AS demand_std FROM (
  SELECT store_id, sku_id, CAST(sum(qty_sold) AS BIGINT) AS total_qty, CAST(sum(qty_sold * qty_sold) AS BIGINT) AS sq, count(*) AS n_days,
    max(date) AS last_date, {rt('sum(qty_sold) FILTER (WHERE date > (SELECT max(date) FROM sku_days_v) - 28)', 'count(*) FILTER (WHERE date > (SELECT max(date) FROM sku_days_v) - 28)')} AS rolling_avg_4wk
  FROM sku_days_v GROUP BY store_id, sku_id) t""",
)
view(
    "classified_v",
    f"""SELECT *, demand_std / NULLIF(demand_avg, 0) AS cv, {hu(rt('running', 'total'), 3)} AS cum_value_pct,
  CASE WHEN running <= total * 0.80 THEN 'A' WHEN running <= total * 0.95 THEN 'B' ELSE 'C' END AS abc_class,
  CASE WHEN demand_std / NULLIF(demand_avg, 0) < 0.5 THEN 'X' WHEN demand_std / NULLIF(demand_avg, 0) <= 0.6 THEN 'Y' ELSE 'Z' END AS xyz_class
FROM (SELECT *, sum(usage_value) OVER (PARTITION BY store_id ORDER BY usage_value DESC, sku_id ROWS UNBOUNDED PRECEDING) AS running,
    sum(usage_value) OVER (PARTITION BY store_id) AS total
  FROM (SELECT s.*, k.category, k.unit_cost, k.price, k.closing_stock, k.on_order_qty, CAST(total_qty * unit_cost AS DECIMAL(28,2)) AS usage_value
    FROM stats_v s LEFT JOIN sku_v k ON k.store_id = s.store_id AND k.sku_id = s.sku_id) a) b""",
)
view(
    "stocked_v",
    f"""SELECT c.*, lead_time_days_avg, lead_time_days_std, moq, pack_size, shelf_life_days, needs_data_fill,
  CAST(CASE abc_class WHEN 'A' THEN 0.98 WHEN 'B' THEN 0.95 ELSE 0.90 END AS DOUBLE) AS service_level,
  CAST(CASE abc_class WHEN 'A' THEN 2.05 WHEN 'B' THEN 1.65 ELSE 1.28 END AS DOUBLE) AS z,
  {hu("CAST(CASE abc_class WHEN 'A' THEN 2.05 WHEN 'B' THEN 1.65 ELSE 1.28 END AS DOUBLE) * sqrt(lead_time_days_avg * demand_std * demand_std + demand_avg * demand_avg * lead_time_days_std * lead_time_days_std)", 1)} AS safety_stock_qty,
  CAST(CASE abc_class WHEN 'A' THEN 1 WHEN 'B' THEN 3 ELSE 7 END AS BIGINT) AS review_cycle_days,
  greatest(CAST(round_even(lead_time_days_avg, 0) AS BIGINT), 1) AS lead_time_days
FROM classified_v c LEFT JOIN supplier_v s ON s.store_id = c.store_id AND s.sku_id = c.sku_id""",
)
view(
    "quantiles_v",
    """SELECT store_id, sku_id, isodow(date) - 1 AS weekday, quantile_cont(qty_sold, 0.5) AS p50, quantile_cont(qty_sold, 0.9) AS p90
FROM sku_days_v GROUP BY 1, 2, 3
UNION ALL SELECT store_id, sku_id, -1, quantile_cont(qty_sold, 0.5), quantile_cont(qty_sold, 0.9) FROM sku_days_v GROUP BY 1, 2""",
)
# every day of the horizon listed and looked up
view(
    "forecast_v",
    """SELECT h.store_id, h.sku_id, max(h.days) AS days, sum(coalesce(q.p50, o.p50)) AS p50, sum(coalesce(q.p90, o.p90)) AS p90
FROM (SELECT s.store_id, s.sku_id, s.last_date, greatest(CAST(round_even(lead_time_days_avg, 0) AS BIGINT), 1) AS days,
    unnest(range(1, 1 + greatest(CAST(round_even(lead_time_days_avg, 0) AS BIGINT), 1))) AS ahead
  FROM stats_v s JOIN supplier_v USING (store_id, sku_id)) h
LEFT JOIN quantiles_v q ON q.store_id = h.store_id AND q.sku_id = h.sku_id AND q.weekday = isodow(h.last_date + CAST(ahead AS INTEGER)) - 1
JOIN quantiles_v o ON o.store_id = h.store_id AND o.sku_id = h.sku_id AND o.weekday = -1 GROUP BY 1, 2""",
)
view(
    "orders_v",
    """SELECT *, CASE WHEN capped THEN room ELSE qty END AS final_qty,
  concat_ws(' / ', CASE WHEN raised THEN concat('未達 MOQ ', moq, ',已補足至最小訂購量') END,
    CASE WHEN capped THEN concat('受保存期 ', shelf_life_days, ' 天限制,由 ', CAST(round_even(qty, 0) AS BIGINT), ' 降為 ', CAST(round_even(room, 0) AS BIGINT), '(超額部分將成廚餘)') END,
    CASE WHEN moq > cap AND below THEN concat('⚠️ MOQ ', moq, ' 超過保存期內可銷量 ', CAST(round_even(cap, 0) AS BIGINT), ',需與供應商議定拆箱或改期') END,
    CASE WHEN swing > 0.30::DOUBLE THEN concat('需求波動 ', CAST(round_even(swing * 100, 0) AS BIGINT), '% 超過 30% 門檻') END) AS reason
FROM (SELECT *, qty > 0 AND available + qty > cap AND room < qty AS capped
  FROM (SELECT *, below AND packed < moq AS raised, CASE WHEN below AND packed < moq THEN CAST(moq AS DOUBLE) ELSE packed END AS qty, greatest(0.0::DOUBLE, cap - available) AS room
    FROM (SELECT *, CAST(ceil(raw / greatest(pack_size, 1)) * greatest(pack_size, 1) AS DOUBLE) AS packed
      FROM (SELECT *, CASE WHEN below THEN target - available ELSE 0.0::DOUBLE END AS raw
        FROM (SELECT *, coalesce(available < rop, false) AS below, rop + demand_avg AS target, abs(p50 / lead_time_days - rolling_avg_4wk) / NULLIF(rolling_avg_4wk, 0) AS swing
          FROM (SELECT s.*, f.p50, f.p90, f.p50 + safety_stock_qty AS rop, CAST(closing_stock AS DOUBLE) + on_order_qty AS available, demand_avg * shelf_life_days AS cap
            FROM stocked_v s JOIN forecast_v f ON f.store_id = s.store_id AND f.sku_id = s.sku_id) a) b) c) d) e) g""",
)

select(
    "supplier_master",
    """SELECT store_id, sku_id, category, supplier_id, CAST(unit_price AS DOUBLE) AS unit_price, shelf_life_days, needs_data_fill,
  lead_time_days_avg, lead_time_days_std, moq, pack_size, payment_term_days FROM supplier_v""",
)
select(
    "demand_stats",
    f"""SELECT store_id, sku_id, total_qty, n_days, CAST(last_date AS VARCHAR) AS last_date, {hu('demand_avg', 6)} AS demand_avg, {hu('demand_std', 6)} AS demand_std,
  {hu('demand_std / NULLIF(demand_avg, 0)', 6)} AS cv FROM stats_v""",
)
select("rolling_avg_4wk", f"SELECT store_id, sku_id, {hu('rolling_avg_4wk', 6)} AS rolling_avg_4wk FROM stats_v")
select("weekday_quantiles", f"SELECT store_id, sku_id, CAST(weekday AS BIGINT) AS weekday, {hu('p50', 4)} AS p50, {hu('p90', 4)} AS p90 FROM quantiles_v")
select("forecast_horizon", f"SELECT store_id, sku_id, days, {hu('p50', 4)} AS p50, {hu('p90', 4)} AS p90 FROM forecast_v")
select("abc_usage", "SELECT store_id, sku_id, CAST(usage_value AS DOUBLE) AS usage_value, cum_value_pct, abc_class FROM classified_v")
select("xyz_class", f"SELECT store_id, sku_id, {hu('cv', 6)} AS cv, xyz_class, cv IS NULL AS insufficient_data FROM classified_v")
select(
    "abc_xyz_matrix",
    """SELECT store_id, abc_class, count(*) FILTER (WHERE xyz_class = 'X') AS "X", count(*) FILTER (WHERE xyz_class = 'Y') AS "Y",
  count(*) FILTER (WHERE xyz_class = 'Z') AS "Z" FROM classified_v GROUP BY store_id, abc_class""",
)
select(
    "service_z",
    f"""SELECT p_partkey, service_level, {hu('''CASE WHEN pct <= 90 THEN 1.28 WHEN pct <= 95 THEN 1.28 + (pct - 90) * (1.65 - 1.28) / 5
  WHEN pct <= 97 THEN 1.65 + (pct - 95) * (1.88 - 1.65) / 2 WHEN pct <= 98 THEN 1.88 + (pct - 97) * (2.05 - 1.88)
  WHEN pct <= 99 THEN 2.05 + (pct - 98) * (2.33 - 2.05) ELSE 2.33 END''', 6)} AS z
FROM (SELECT p_partkey, p_partkey % 16 + 85 AS pct, CAST(p_partkey % 16 + 85 AS DOUBLE) / 100 AS service_level FROM part) t""",
)
select(
    "safety_stock_b",
    """SELECT store_id, sku_id, abc_class, service_level, z, safety_stock_qty, review_cycle_days, lead_time_days FROM stocked_v""",
)
select(
    "ss_orders",
    f"""SELECT store_id, sku_id, category, abc_class, xyz_class, service_level, {hu('demand_avg', 1)} AS demand_avg, {hu('demand_std', 1)} AS demand_std, {hu('cv', 2)} AS cv,
  lead_time_days, {hu('p50', 1)} AS predicted_qty_p50_lt, {hu('p90', 1)} AS predicted_qty_p90_lt, safety_stock_qty, {hu('rop', 1)} AS reorder_point,
  {hu('target', 1)} AS "target_level_S", CAST(closing_stock AS DOUBLE) AS current_stock, CAST(on_order_qty AS DOUBLE) AS on_order_qty, {hu('raw', 1)} AS order_qty_raw,
  CAST(floor(final_qty) AS BIGINT) AS recommended_order_qty, moq, pack_size, shelf_life_days, review_cycle_days, CAST(unit_cost AS DOUBLE) AS unit_cost FROM orders_v""",
)
select(
    "order_exceptions",
    """SELECT store_id, sku_id, CAST(floor(final_qty) AS BIGINT) AS recommended_order_qty, reason <> '' AS exception_flag, reason AS exception_reason,
  needs_data_fill AS data_gap_flag FROM orders_v""",
)
select(
    "order_summary",
    """SELECT store_id, count(*) AS n_items, count(*) FILTER (WHERE floor(final_qty) > 0) AS n_to_order, CAST(sum(floor(final_qty)) AS BIGINT) AS total_units,
  CAST(sum(CAST(floor(final_qty) AS BIGINT) * unit_cost) AS DOUBLE) AS spend, count(*) FILTER (WHERE reason <> '') AS n_exceptions,
  count(*) FILTER (WHERE needs_data_fill) AS n_data_gaps FROM orders_v GROUP BY store_id""",
)

_POINTS = ", ".join(
    f"('ST{s}', {x}::DOUBLE, {z}::DOUBLE)" for s in range(10) for x, z in (SERVICE_LEVEL_Z if s % 2 == 0 else OTHER_LEVELS).items()
)
select(
    "service_z_table",
    f"""SELECT p_partkey, r.store_id, service_level, {hu('coalesce(max(z) FILTER (WHERE level <= service_level AND (next IS NULL OR service_level < next) AND next IS NULL), max(z + (service_level - level) / (next - level) * (z_next - z)) FILTER (WHERE level <= service_level AND service_level < next), arg_min(z, level))', 6)} AS z
FROM (SELECT p_partkey, concat('ST', CAST(p_partkey % 10 AS VARCHAR)) AS store_id, CAST(p_partkey % 16 + 85 AS DOUBLE) / 100 AS service_level FROM part) r
JOIN (SELECT *, lead(level) OVER (PARTITION BY store_id ORDER BY level) AS next, lead(z) OVER (PARTITION BY store_id ORDER BY level) AS z_next
  FROM (VALUES {_POINTS}) AS t(store_id, level, z)) p ON p.store_id = r.store_id GROUP BY 1, 2, 3""",
)
select("daily_by_increments", "SELECT store_id, sku_id, CAST(date AS VARCHAR) AS date, CAST(qty_sold AS BIGINT) AS qty_sold FROM sku_days_v")
select(
    "weekday_quantiles_sketch",
    """SELECT store_id, sku_id, CAST(isodow(date) - 1 AS BIGINT) AS weekday, count(*) AS n_days, CAST(quantile_disc(qty_sold, 0.5) AS BIGINT) AS p50, CAST(quantile_disc(qty_sold, 0.9) AS BIGINT) AS p90
FROM sku_days_v GROUP BY 1, 2, 3
UNION ALL SELECT store_id, sku_id, -1, count(*), CAST(quantile_disc(qty_sold, 0.5) AS BIGINT), CAST(quantile_disc(qty_sold, 0.9) AS BIGINT) FROM sku_days_v GROUP BY 1, 2""",
)
