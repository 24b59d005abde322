"""SQL of costs, suppliers and stock counts."""

from __future__ import annotations

from comanda.plans.oracle import hu, rt, select, view

view(
    "cost_sheet_v",
    """SELECT store_id, revenue, line, CASE line WHEN 'food' THEN food WHEN 'labour' THEN revenue * 0.27 WHEN 'rent' THEN revenue * 0.16
    WHEN 'utilities' THEN revenue * 0.02 ELSE revenue * 0.03 END AS amount, lo, hi, band
FROM (SELECT store_id, CAST(sum(qty_sold * price) AS DECIMAL(28,4)) AS revenue, CAST(sum(received_qty * unit_cost) AS DECIMAL(28,4)) AS food FROM inventory_v GROUP BY store_id) t,
  (VALUES ('food', 0.28, 0.35, '28%~35%'), ('labour', 0.25, 0.32, '25%~32%'), ('rent', 0.08, 0.15, '8%~15%'),
    ('utilities', 0.03, 0.06, '3%~6%'), ('marketing', 0.01, 0.03, '1%~3%')) AS b(line, lo, hi, band)""",
)
OVER = "CASE WHEN amount > revenue * hi THEN amount - revenue * hi ELSE 0 END"
select(
    "cost_structure",
    f"""SELECT store_id, line, CAST(amount AS DOUBLE) AS amount, {hu(rt('amount', 'revenue'), 6)} AS share, band,
  CASE WHEN amount > revenue * hi THEN 'high' WHEN amount < revenue * lo THEN 'below' ELSE 'within' END AS verdict,
  {hu(OVER, 2)} AS over_amount, {hu(f'sum({OVER}) OVER (PARTITION BY store_id)', 2)} AS total_over FROM cost_sheet_v""",
)
view(
    "recon_v",
    """SELECT *, qty_sold * unit_cost AS theoretical_cost, received_qty * unit_cost AS purchase_cost, closing_stock - opening_stock AS stock_change_qty,
  (closing_stock - opening_stock) * unit_cost AS stock_change_cost, opening_stock + received_qty - closing_stock - qty_sold AS waste_qty,
  (opening_stock + received_qty - closing_stock - qty_sold) * unit_cost AS waste_cost FROM inventory_v""",
)
select(
    "cost_recon_items",
    """SELECT store_id, sku_id, CAST(theoretical_cost AS DOUBLE) AS theoretical_cost, CAST(purchase_cost AS DOUBLE) AS purchase_cost, stock_change_qty,
  CAST(stock_change_cost AS DOUBLE) AS stock_change_cost, waste_qty, CAST(waste_cost AS DOUBLE) AS waste_cost FROM recon_v""",
)
select(
    "cost_recon_totals",
    f"""SELECT store_id, CAST(revenue AS DOUBLE) AS revenue, CAST(t AS DOUBLE) AS theoretical_cost, CAST(p AS DOUBLE) AS purchase_cost, CAST(c AS DOUBLE) AS stock_change_cost,
  CAST(wp AS DOUBLE) AS waste_positive, CAST(wn AS DOUBLE) AS waste_net, CAST(p - t AS DOUBLE) AS difference, CAST(p - t - c - wn AS DOUBLE) AS residual,
  {hu(rt('t', 'revenue'), 4)} AS theoretical_rate, {hu(rt('p', 'revenue'), 4)} AS purchase_rate
FROM (SELECT store_id, sum(qty_sold * price) AS revenue, sum(theoretical_cost) AS t, sum(purchase_cost) AS p, sum(stock_change_cost) AS c,
    sum(CASE WHEN waste_qty > 0 THEN waste_cost ELSE 0 END) AS wp, sum(waste_cost) AS wn FROM recon_v GROUP BY store_id) x""",
)
select(
    "item_margin",
    f"""SELECT store_id, sku_id, CAST(price - unit_cost AS DOUBLE) AS unit_margin, {hu(rt('price - unit_cost', 'price'), 6)} AS margin_rate, CAST(revenue AS DOUBLE) AS revenue,
  CAST(m AS DOUBLE) AS total_margin, {hu(rt('c', 'tc'), 6)} AS cost_share, {hu(rt('m', 'tm'), 6)} AS margin_share, {rt('c', 'tc')} > {rt('m', 'tm')} AS eats_margin
FROM (SELECT *, qty_sold * price AS revenue, qty_sold * unit_cost AS c, qty_sold * (price - unit_cost) AS m,
    sum(qty_sold * unit_cost) OVER (PARTITION BY store_id) AS tc, sum(qty_sold * (price - unit_cost)) OVER (PARTITION BY store_id) AS tm FROM inventory_v) t""",
)
view(
    "metrics_v",
    f"""SELECT supplier_id, CAST(sum(n) AS BIGINT) AS n_receipts, {hu(rt('sum(n_on_time)', 'sum(n)'), 6)} AS on_time_rate, {hu(rt('sum(n_defective)', 'sum(n)'), 6)} AS defect_rate,
  {hu(rt('sum(CAST(lowest / avg_cost * quantity AS DECIMAL(28,8)))', 'sum(quantity)'), 6)} AS price_competitiveness
FROM (SELECT *, min(avg_cost) OVER (PARTITION BY category) AS lowest FROM (
  SELECT l_suppkey AS supplier_id, p.type AS category, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS n_on_time,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_defective, CAST(sum(l_quantity) AS BIGINT) AS quantity,
    {rt('sum(CAST(l_extendedprice AS DECIMAL(18,2)))', 'CAST(sum(l_quantity) AS BIGINT)')} AS avg_cost
  FROM lineitem JOIN parts_b p ON l_partkey = p_partkey GROUP BY 1, 2) t) u GROUP BY supplier_id""",
)
select("supplier_metrics", "SELECT * FROM metrics_v")
view(
    "scored_v",
    f"""SELECT *, {hu('least(' + rt('payment_term_days', '45') + ', 1)', 2)} AS payment_term_score,
  {hu("(0.35::DOUBLE * coalesce(on_time_rate, 0.5) + 0.30::DOUBLE * coalesce(1 - defect_rate, 0.5) + 0.25::DOUBLE * coalesce(pc, 0.5) + 0.10::DOUBLE * least(" + rt('payment_term_days', '45') + ", 1)) * 100", 1)} AS score,
  concat_ws(',', CASE WHEN on_time_rate IS NULL THEN 'on_time_rate' END, CASE WHEN defect_rate IS NULL THEN 'defect_rate' END,
    CASE WHEN pc IS NULL THEN 'price_competitiveness' END) AS missing_metrics
FROM (SELECT s_suppkey AS supplier_id, category, CAST(CASE category WHEN 'drink' THEN 5 WHEN 'dessert' THEN 1 ELSE 2 END AS DOUBLE) AS lead_time_avg,
    CAST(CASE category WHEN 'drink' THEN 1.2 WHEN 'main' THEN 0.6 WHEN 'dessert' THEN 0.3 ELSE 0.5 END AS DOUBLE) AS lead_time_std,
    s_suppkey % 4 * 15 + 15 AS payment_term_days, on_time_rate, defect_rate, CASE WHEN s_suppkey % 3 <> 0 THEN price_competitiveness END AS pc
  FROM (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'main' WHEN 1 THEN 'side' WHEN 2 THEN 'dessert' WHEN 3 THEN 'drink' ELSE 'other' END AS category FROM supplier) s
  LEFT JOIN metrics_v ON supplier_id = s_suppkey) x""",
)
select(
    "supplier_score",
    """SELECT supplier_id, category, lead_time_avg, lead_time_std, payment_term_days, payment_term_score, score, missing_metrics, missing_metrics = '' AS usable,
  row_number() OVER (ORDER BY score DESC, supplier_id) AS rank FROM scored_v""",
)
view(
    "variance_v",
    f"""SELECT *, {rt('variance_qty', 'qty_sold')} AS variance_ratio, variance_qty * unit_cost AS waste_cost,
  CASE WHEN qty_sold = 0 THEN '低' WHEN variance_qty > qty_sold * 0.15 OR variance_qty < qty_sold * -0.15 THEN '中' ELSE '低' END AS alert_level
FROM (SELECT *, opening_stock + received_qty - closing_stock AS actual_usage, opening_stock + received_qty - closing_stock - qty_sold AS variance_qty FROM inventory_v) t""",
)
select(
    "usage_variance",
    f"""SELECT store_id, sku_id, actual_usage, qty_sold AS theoretical_usage, variance_qty, {hu('variance_ratio', 6)} AS variance_ratio,
  theoretical_stock - closing_stock AS stock_variance_qty, CAST(waste_cost AS DOUBLE) AS waste_cost FROM variance_v""",
)
PCT = f"CAST({hu('abs(variance_ratio) * 100', 1)} AS VARCHAR)"
select(
    "variance_alerts",
    f"""SELECT store_id, sku_id, alert_level, CASE WHEN qty_sold = 0 THEN '無銷售紀錄,無法判斷'
  WHEN variance_qty > qty_sold * 0.15 THEN concat('實際用量超出理論用量 ', {PCT}, '%,超過 ±15% 門檻')
  WHEN variance_qty < qty_sold * -0.15 THEN concat('實際用量低於理論用量 ', {PCT}, '% —— 庫存比帳上多,屬**資料登記問題**而非耗損')
  ELSE '差異率在正常範圍內' END AS alert_reason FROM variance_v""",
)
LEGACY = "abs(variance_qty_raw) > abs(theoretical_stock) * 0.15"
select(
    "legacy_false_alarms",
    f"""SELECT store_id, count(*) AS n_items, count(*) FILTER (WHERE {LEGACY}) AS n_legacy, count(*) FILTER (WHERE alert_level <> '低') AS n_usage_based,
  count(*) FILTER (WHERE {LEGACY} AND alert_level = '低') AS n_false FROM variance_v GROUP BY store_id""",
)
select(
    "anomaly_features",
    f"""SELECT store_id, sku_id, {hu('coalesce(variance_ratio, 0)', 6)} AS variance_ratio_feature, {hu('coalesce(abs(variance_ratio), 0)', 6)} AS waste_qty_ratio,
  CAST((SELECT count(DISTINCT category) FROM variance_v o WHERE o.category < v.category) AS DOUBLE) AS category_code FROM variance_v v""",
)
view(
    "cover_v",
    f"""SELECT *, {hu('small_stock / NULLIF(avg_daily, 0)', 2)} AS days_of_cover FROM (
  SELECT v.*, v.closing_stock % 11 AS small_stock, {rt('s.qty', 'd.n_days')} AS avg_daily FROM variance_v v
  LEFT JOIN (SELECT concat('ST', CAST(l_suppkey % 10 AS VARCHAR)) AS store_id, item_id AS sku_id, sum(l_quantity) AS qty
    FROM lineitem JOIN parts_b ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) s ON s.store_id = v.store_id AND s.sku_id = v.sku_id
  LEFT JOIN (SELECT concat('ST', CAST(l_suppkey % 10 AS VARCHAR)) AS store_id, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) d ON d.store_id = v.store_id) t""",
)
RISK = "CASE WHEN days_of_cover < 1.0 THEN '🔴 不足 1 日' WHEN days_of_cover < 3.0 THEN '🟡 不足 3 日' ELSE '🟢 充足' END"
select(
    "stockout_risk",
    f"""SELECT store_id, sku_id, small_stock AS closing_stock, {hu('avg_daily', 6)} AS avg_daily, days_of_cover, {RISK} AS stockout_risk,
  days_of_cover IS NULL AS insufficient_data FROM cover_v""",
)
select(
    "waste_summary",
    f"""SELECT store_id, CAST(sum(CASE WHEN variance_qty > 0 THEN waste_cost ELSE 0 END) AS DOUBLE) AS waste_cost,
  {hu(rt('sum(greatest(variance_qty, 0))', 'sum(qty_sold)'), 6)} AS waste_rate, count(*) FILTER (WHERE alert_level = '中') AS n_alerts,
  count(*) FILTER (WHERE days_of_cover < 3.0) AS n_stockout, count(*) FILTER (WHERE variance_qty < 0) AS n_negative FROM cover_v GROUP BY store_id""",
)
select(
    "negative_variance",
    "SELECT store_id, sku_id, variance_qty, CAST(waste_cost AS DOUBLE) AS waste_cost FROM variance_v WHERE variance_qty < 0",
)

# --- isolation forests per store, grown level by level --------------------------------------------------------------

view(
    "part_counts_v",
    """SELECT *, variance_qty_raw AS variance_qty, CAST(variance_qty_raw AS DOUBLE) / NULLIF(CAST(qty_sold AS DOUBLE), 0) AS ratio FROM (
  SELECT *, CAST(floor(CAST(returned_qty * (tag_no - 2) AS DOUBLE) / 4) AS BIGINT) AS variance_qty_raw FROM (
    SELECT concat('ST', CAST(l_suppkey % 10 AS VARCHAR)) AS store_id, concat('P', CAST(l_partkey AS VARCHAR)) AS sku_id, type AS category, tag_no,
      CAST(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS sold, CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 0) AS BIGINT) AS qty_sold,
      CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS BIGINT) AS returned_qty
    FROM lineitem JOIN parts_b ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4) s) t""",
)
view(
    "iso_rows_v",
    """SELECT store_id, sku_id, qty_sold, variance_qty, coalesce(ratio, 0) AS f0, coalesce(abs(ratio), 0) AS f1,
  CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS f2, count(*) OVER (PARTITION BY store_id) AS n,
  CAST('0x' || substr(md5(store_id || '|' || sku_id), 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(md5(store_id || '|' || sku_id), 9, 8) AS BIGINT) AS h2
FROM part_counts_v""",
)
view(
    "iso_l0_v",
    """SELECT store_id, tree, 1 AS node, least(n, 256) AS m, f0, f1, f2 FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, tree ORDER BY (h1 * (tree + 1) + h2) % 2147483647, store_id, sku_id) AS place
  FROM iso_rows_v, (SELECT range AS tree FROM range(100)) WHERE n >= 60) t WHERE place <= 256""",
)
LEVELS = 8
PATH = "CASE WHEN k <= 1 THEN 0 WHEN k = 2 THEN 1 ELSE 2 * (ln(k - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (k - 1.0::DOUBLE) / k END"
HASH = "md5(store_id || '|' || CAST(tree AS VARCHAR) || '|' || CAST(node AS VARCHAR))"
for level in range(LEVELS + 1):
    view(
        f"iso_c{level}_v",
        f"""SELECT store_id, tree, node, feature, CASE feature WHEN 0 THEN a0 + u * (b0 - a0) WHEN 1 THEN a1 + u * (b1 - a1) WHEN 2 THEN a2 + u * (b2 - a2) ELSE 0 END AS threshold,
  CASE WHEN feature < 0 THEN CAST({level}000000000 + round(1000000000 * ({PATH})) AS BIGINT) ELSE 0 END AS path
FROM (SELECT *, CASE WHEN stop THEN -1 ELSE varying[1 + CAST('0x' || substr(h, 1, 8) AS BIGINT) % len(varying)] END AS feature,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM (SELECT *, {HASH} AS h, {level} >= ceil(log2(greatest(m, 2))) OR k <= 1 OR len(varying) = 0 AS stop
    FROM (SELECT *, list_concat(list_concat(CASE WHEN b0 > a0 THEN [0] ELSE [] END, CASE WHEN b1 > a1 THEN [1] ELSE [] END), CASE WHEN b2 > a2 THEN [2] ELSE [] END) AS varying
      FROM (SELECT store_id, tree, node, max(m) AS m, count(*) AS k, min(f0) AS a0, max(f0) AS b0, min(f1) AS a1, max(f1) AS b1, min(f2) AS a2, max(f2) AS b2
        FROM iso_l{level}_v GROUP BY 1, 2, 3) g) v) w) x""",
    )
    if level < LEVELS:
        view(
            f"iso_l{level + 1}_v",
            f"""SELECT l.store_id, l.tree, 2 * l.node + CASE WHEN CASE feature WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END > threshold THEN 1 ELSE 0 END AS node, m, f0, f1, f2
FROM iso_l{level}_v l JOIN iso_c{level}_v c ON c.store_id = l.store_id AND c.tree = l.tree AND c.node = l.node WHERE feature >= 0""",
        )
view("iso_nodes_v", " UNION ALL ".join(f"SELECT * FROM iso_c{level}_v" for level in range(LEVELS + 1)))


def _walk(nodes: str, same: str) -> str:
    return f"""SELECT r.store_id, r.sku_id, f0, f1, f2, t.tree, t.node, t.feature, t.threshold, t.path FROM iso_rows_v r JOIN {nodes} t ON {same} t.node = 1
UNION ALL
SELECT w.store_id, w.sku_id, f0, f1, f2, t.tree, t.node, t.feature, t.threshold, t.path FROM {{}} w JOIN {nodes} t ON {same.replace('r.', 'w.')} t.tree = w.tree
  AND t.node = 2 * w.node + CASE WHEN CASE w.feature WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END > w.threshold THEN 1 ELSE 0 END WHERE w.feature >= 0"""


view("iso_walk_v", _walk("iso_nodes_v", "t.store_id = r.store_id AND").format("iso_walk_v"))
view(
    "iso_scored_v",
    f"""SELECT s.store_id, s.sku_id, {hu("-pow(2.0::DOUBLE, -(total / 1000000000.0::DOUBLE / 100.0::DOUBLE / (round(1000000000 * (" + PATH.replace('k', 'least(n, 256)') + ")) / 1000000000.0::DOUBLE)))", 9)} AS score
FROM (SELECT store_id, sku_id, CAST(sum(path) AS DOUBLE) AS total FROM iso_walk_v WHERE feature < 0 GROUP BY 1, 2) s JOIN iso_rows_v r ON r.store_id = s.store_id AND r.sku_id = s.sku_id""",
)
select(
    "isolation_by_store",
    f"""SELECT r.store_id, r.sku_id, {hu('margin', 4)} AS anomaly_score, coalesce(margin < 0, false) AS anomaly_flag,
  CASE WHEN margin < 0 THEN '高' WHEN qty_sold = 0 THEN '低' WHEN variance_qty > qty_sold * 0.15 OR variance_qty < qty_sold * -0.15 THEN '中' ELSE '低' END AS alert_level
FROM iso_rows_v r LEFT JOIN (SELECT store_id, sku_id, score - quantile_cont(score, 0.05) OVER (PARTITION BY store_id) AS margin FROM iso_scored_v) s
  ON s.store_id = r.store_id AND s.sku_id = r.sku_id""",
)
view(
    "given_nodes_v",
    """SELECT * FROM (VALUES (0, 1, 0, 0.1::DOUBLE, 0), (0, 2, 1, 0.05, 0), (0, 3, -1, 0.0, 1500000000), (0, 4, 2, 1.5, 0), (0, 5, -1, 0.0, 2250000000), (0, 8, -1, 0.0, 4125000000),
  (0, 9, -1, 0.0, 3000000000), (1, 1, 2, 0.5, 0), (1, 2, -1, 0.0, 2000000000), (1, 3, 0, -0.2, 0), (1, 6, -1, 0.0, 2000000000), (1, 7, -1, 0.0, 3375000000), (2, 1, -1, 0.0, 1000000000))
  AS t(tree, node, feature, threshold, path)""",
)
view("given_walk_v", _walk("given_nodes_v", "").format("given_walk_v"))
select(
    "isolation_score",
    f"""SELECT store_id, sku_id, CAST(total AS BIGINT) AS path_sum, {hu("-pow(2.0::DOUBLE, -(CAST(total AS DOUBLE) / 1000000000.0::DOUBLE / 3.0::DOUBLE / 4.0::DOUBLE))", 9)} AS score
FROM (SELECT store_id, sku_id, sum(path) AS total FROM given_walk_v WHERE feature < 0 GROUP BY 1, 2) t""",
)
