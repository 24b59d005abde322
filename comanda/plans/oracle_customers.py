"""SQL of customer segments and drink potential."""

from __future__ import annotations

from comanda.operators.segment import FEATURES
from comanda.params import UPSELL_FEATURES
from comanda.plans.customer_queries import CENTRES, GIVEN_MODEL
from comanda.plans.oracle import SELECTS, VIEWS, hu, rt, select, view

view(
    "per_customer_v",
    f"""SELECT customer_id, count(*) AS visits, {rt('sum(spend_per_head)', 'count(*)')} AS avg_spend, {rt('sum(drink_ratio)', 'count(*)')} AS avg_drink_ratio,
  {rt('sum(duration_min)', 'count(*)')} AS avg_duration, {rt('sum(arrival_hour)', 'count(*)')} AS avg_hour,
  sum(total_revenue) AS total_revenue, sum(total_profit) AS total_profit FROM visits_v GROUP BY customer_id""",
)
view("customers_v", "SELECT * FROM per_customer_v WHERE visits >= 2")
select(
    "customer_table",
    f"""SELECT customer_id, visits, {', '.join(f'{hu(c, 6)} AS {c}' for c in FEATURES if c != 'visits')},
  CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit FROM customers_v""",
)
select(
    "repeat_share",
    f"""SELECT count(*) AS n_customers, count(*) FILTER (WHERE visits >= 2) AS n_repeat,
  {hu(rt('sum(CASE WHEN visits >= 2 THEN total_revenue ELSE 0 END)', 'sum(total_revenue)'), 4)} AS repeat_revenue_share FROM per_customer_v""",
)
view(
    "scaled_v",
    "SELECT *, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / coalesce(NULLIF(stddev_pop({c}) OVER (), 0), 1) AS z_{c}" for c in FEATURES)
    + " FROM customers_v",
)
select("customer_scaled", f"SELECT customer_id, {', '.join(f'{hu(f'z_{c}', 6)} AS z_{c}' for c in FEATURES)} FROM scaled_v")


def _distance(centre: list[float]) -> str:
    return " + ".join(f"(z_{c} - ({v}::DOUBLE)) * (z_{c} - ({v}::DOUBLE))" for c, v in zip(FEATURES, centre))


_D = [f"d{i}" for i in range(len(CENTRES))]
view(
    "assigned_v",
    f"""SELECT *, least({', '.join(_D)}) AS sq_distance, CAST(CASE least({', '.join(_D)}) {' '.join(f'WHEN {d} THEN {i}' for i, d in enumerate(_D))} END AS BIGINT) AS cluster
FROM (SELECT *, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(CENTRES))} FROM scaled_v) t""",
)
select("kmeans_assign", f"SELECT customer_id, cluster, {hu('sq_distance', 6)} AS sq_distance FROM assigned_v")
for _k in (2, 3, 4):
    view(
        f"fixed{_k}_v",
        f"""SELECT *, least({', '.join(_D[:_k])}) AS sq_distance, CASE least({', '.join(_D[:_k])}) {' '.join(f'WHEN {d} THEN {i}' for i, d in enumerate(_D[:_k]))} END AS cluster
FROM (SELECT *, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(CENTRES[:_k]))} FROM scaled_v) t""",
    )
    view(
        f"drawn{_k}_v",
        f"""SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cluster) AS n, row_number() OVER (PARTITION BY cluster ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) AS place
FROM fixed{_k}_v) t WHERE place <= 2000""",
    )
    view(
        f"far{_k}_v",
        f"""SELECT a.customer_id, a.cluster, a.n, b.cluster AS other,
  sum(sqrt({' + '.join(f'(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})' for c in FEATURES)})) / NULLIF(count(*) - CASE WHEN a.cluster = b.cluster THEN 1 ELSE 0 END, 0) AS mean
FROM drawn{_k}_v a, drawn{_k}_v b GROUP BY 1, 2, 3, 4""",
    )
    view(
        f"silhouette{_k}_v",
        f"""SELECT {_k} AS k, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(m) AS BIGINT) AS n_sampled, {hu('sum(v * n) / sum(n)', 4)} AS silhouette, bool_and(m = n) AS exact
FROM (SELECT cluster, n, count(*) AS m, avg(CASE WHEN n > 1 AND b IS NOT NULL AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS v
  FROM (SELECT customer_id, cluster, n, max(mean) FILTER (WHERE other = cluster) AS a, min(mean) FILTER (WHERE other <> cluster) AS b FROM far{_k}_v GROUP BY 1, 2, 3) r GROUP BY 1, 2) c""",
    )
select("silhouette_fixed", " UNION ALL ".join(f"SELECT CAST(k AS BIGINT) AS k, n_rows, n_sampled, silhouette, exact FROM silhouette{k}_v" for k in (2, 3, 4)))
select("inertia_fixed", " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS k, {hu('sum(sq_distance)', 4)} AS inertia FROM fixed{k}_v" for k in (2, 3, 4)))
select(
    "kmeans_update",
    f"SELECT cluster, count(*) AS n, {', '.join(f'{hu(f'avg(z_{c})', 6)} AS z_{c}' for c in FEATURES)} FROM assigned_v GROUP BY cluster",
)
view(
    "segments_v",
    f"""SELECT cluster, count(*) AS n_customers, {hu('avg(visits)', 2)} AS avg_visits, {hu('avg(avg_spend)', 2)} AS avg_spend,
  {hu('avg(avg_drink_ratio)', 2)} AS avg_drink_ratio, {hu('avg(avg_duration)', 2)} AS avg_duration, {hu('avg(avg_hour)', 2)} AS avg_hour,
  round(sum(total_profit), 2) AS total_profit FROM assigned_v GROUP BY cluster""",
)
select(
    "segment_profile",
    "SELECT cluster, n_customers, avg_visits, avg_spend, avg_drink_ratio, avg_duration, avg_hour, CAST(total_profit AS DOUBLE) AS total_profit FROM segments_v",
)
view("core_v", "SELECT cluster FROM segments_v ORDER BY avg_visits DESC, cluster LIMIT 1")
view(
    "night_v",
    "SELECT cluster FROM segments_v WHERE cluster NOT IN (SELECT cluster FROM core_v) ORDER BY avg_drink_ratio DESC, cluster LIMIT 1",
)
view(
    "dining_v",
    """SELECT cluster FROM segments_v WHERE cluster NOT IN (SELECT cluster FROM core_v) AND cluster NOT IN (SELECT cluster FROM night_v)
ORDER BY avg_drink_ratio, cluster LIMIT 1""",
)
select(
    "segment_names",
    """SELECT cluster, n_customers, avg_visits, avg_drink_ratio, CASE WHEN cluster IN (SELECT cluster FROM core_v) THEN '核心常客'
  WHEN cluster IN (SELECT cluster FROM night_v) THEN '夜間酒客' WHEN cluster IN (SELECT cluster FROM dining_v) THEN '餐點取向客' ELSE '一般客' END AS segment FROM segments_v""",
)
select(
    "segment_value",
    f"""SELECT cluster, n_customers, CAST(total_profit AS DOUBLE) AS total_profit, {hu('ps', 4)} AS profit_share, {hu('cs', 4)} AS customer_share, {hu('ps / cs', 2)} AS value_multiple
FROM (SELECT *, {rt('total_profit', 'sum(total_profit) OVER ()')} AS ps, {rt('n_customers', 'sum(n_customers) OVER ()')} AS cs FROM segments_v) t""",
)
select(
    "customer_cov",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {hu(f'covar_samp(z_{a}, z_{b})', 6)} AS cov FROM scaled_v"
        for i, a in enumerate(FEATURES)
        for b in FEATURES[i:]
    ),
)

# --- drink potential ---------------------------------------------------------------------------------------------

_F = ", ".join(UPSELL_FEATURES)
view("labelled_v", f"SELECT visit_id, {_F}, drink_ratio, spend_per_head, CASE WHEN drink_ratio >= 0.40 THEN 1 ELSE 0 END AS label FROM visits_v")
select(
    "upsell_features",
    f"SELECT visit_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in UPSELL_FEATURES)}, CAST(label AS BIGINT) AS label FROM labelled_v",
)
view(
    "split_v",
    """SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(visit_id), visit_id) <= round(count(*) OVER (PARTITION BY label) * 0.25, 0)
  THEN 1 ELSE 0 END AS is_test FROM labelled_v""",
)
select("stratified_split", "SELECT visit_id, CAST(label AS BIGINT) AS label, CAST(is_test AS BIGINT) AS is_test FROM split_v")


def _margin() -> str:
    terms = [
        f"({GIVEN_MODEL.coefficients[c]}::DOUBLE) * ((CAST({c} AS DOUBLE) - ({GIVEN_MODEL.scaling.mean[c]}::DOUBLE)) / ({GIVEN_MODEL.scaling.spread[c]}::DOUBLE))"
        for c in UPSELL_FEATURES
    ]
    return f"({GIVEN_MODEL.intercept}::DOUBLE) + " + " + ".join(terms)


view(
    "prob_v",
    f"""SELECT *, {hu('prob', 9)} AS threshold, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred
FROM (SELECT *, 1 / (1 + exp(-({_margin()}))) AS prob FROM labelled_v) t""",
)
select("upsell_score", f"SELECT visit_id, {hu('prob', 6)} AS prob, CAST(pred AS BIGINT) AS pred FROM prob_v")
select(
    "confusion_matrix",
    "SELECT CAST(label AS BIGINT) AS label, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1 FROM prob_v GROUP BY label",
)
view(
    "per_class_v",
    f"""SELECT k, {rt('tp', 'np')} AS p, {rt('tp', 'nl')} AS r, {rt('2 * tp', 'np + nl')} AS f, nl AS s, (SELECT count(*) FROM prob_v) AS n,
  (SELECT count(*) FROM prob_v WHERE label = pred) AS hits
FROM (SELECT k, count(*) FILTER (WHERE label = k AND pred = k) AS tp, count(*) FILTER (WHERE pred = k) AS np, count(*) FILTER (WHERE label = k) AS nl
  FROM prob_v, (VALUES (0), (1)) AS c(k) GROUP BY k) t""",
)
select(
    "class_report",
    f"""SELECT CAST(k AS VARCHAR) AS name, {hu('p', 3)} AS precision, {hu('r', 3)} AS recall, {hu('f', 3)} AS f1, s AS support FROM per_class_v
UNION ALL SELECT 'accuracy', {hu(rt('max(hits)', 'max(n)'), 3)}, {hu(rt('max(hits)', 'max(n)'), 3)}, {hu(rt('max(hits)', 'max(n)'), 3)}, max(n) FROM per_class_v
UNION ALL SELECT 'macro avg', {hu('sum(p) / 2', 3)}, {hu('sum(r) / 2', 3)}, {hu('sum(f) / 2', 3)}, max(n) FROM per_class_v
UNION ALL SELECT 'weighted avg', {hu('sum(p * s) / max(n)', 3)}, {hu('sum(r * s) / max(n)', 3)}, {hu('sum(f * s) / max(n)', 3)}, max(n) FROM per_class_v""",
)
# rank sum of the positives, ties at their mean rank
AUC = "(sum(rk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)"
select(
    "auc",
    f"""SELECT {hu(rt(AUC, 'count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)'), 6)} AS auc
FROM (SELECT label, rank() OVER (ORDER BY threshold) + (count(*) OVER (PARTITION BY threshold) - 1) / 2.0 AS rk FROM prob_v) t""",
)
select(
    "roc_curve",
    f"""SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, {hu(rt('fp', '(SELECT count(*) FROM prob_v WHERE label = 0)'), 6)} AS fpr,
  {hu(rt('tp', '(SELECT count(*) FROM prob_v WHERE label = 1)'), 6)} AS tpr
FROM (SELECT t.threshold, count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label = 0) AS fp
  FROM (SELECT DISTINCT threshold FROM prob_v) t JOIN prob_v p ON p.threshold >= t.threshold GROUP BY t.threshold) u""",
)
view(
    "grid_cells_v",
    f"""SELECT CAST(is_buzz_hour AS BIGINT) AS is_buzz_hour, CAST(is_repeat AS BIGINT) AS is_repeat, count(*) AS n_visits, {hu('avg(prob)', 4)} AS avg_prob,
  {hu(rt('sum(drink_ratio)', 'count(*)'), 4)} AS avg_drink_ratio, {hu(rt('sum(spend_per_head)', 'count(*)'), 0)} AS avg_spend_per_head FROM prob_v GROUP BY 1, 2""",
)
select(
    "action_grid",
    "SELECT *, row_number() OVER (ORDER BY avg_spend_per_head DESC, is_buzz_hour, is_repeat) = 1 AS is_best FROM grid_cells_v",
)
TIER = "CASE WHEN prob >= 0.6 THEN 'high' WHEN prob >= 0.4 THEN 'medium' ELSE 'low' END"
select("potential_tier", f"SELECT visit_id, {hu('prob', 6)} AS prob, {TIER} AS tier FROM prob_v")
select("upsell_stream_equiv", f"SELECT visit_id, {hu('prob', 6)} AS prob, {TIER} AS tier FROM prob_v")
select("recommend_stream_equiv", SELECTS["recommend_rules"])
select("open_orders_stream_equiv", SELECTS["recommend_rules"])

# the logistic regression by gradient descent over the counted cells
view(
    "cells_v",
    f"SELECT {_F}, label, CAST(count(*) AS DOUBLE) AS weight FROM split_v WHERE is_test = 0 GROUP BY {_F}, label",
)
_MEANS = ", ".join(f"sum(weight * {c}) / sum(weight) AS m_{c}, sum(weight * {c} * {c}) / sum(weight) AS q_{c}" for c in UPSELL_FEATURES)
_Z = ", ".join(f"({c} - m_{c}) / sqrt(q_{c} - m_{c} * m_{c}) AS z{i + 1}" for i, c in enumerate(UPSELL_FEATURES))
view(
    "zcells_v",
    f"SELECT CAST(label AS DOUBLE) AS y, weight / n AS w, 1 / n AS penalty, {_Z} FROM cells_v, (SELECT sum(weight) AS n, {_MEANS} FROM cells_v) s",
)
_N = range(1, len(UPSELL_FEATURES) + 1)
_B = ", ".join(f"b{i}" for i in _N)
view(
    "descent_v",
    f"""SELECT 0 AS step, CAST(0 AS DOUBLE) AS b0, {', '.join(f'CAST(0 AS DOUBLE) AS b{i}' for i in _N)}
UNION ALL
SELECT step + 1, b0 - 1.2 * sum(w * (p - y)), {', '.join(f'b{i} - 1.2 * (sum(w * (p - y) * z{i}) + max(penalty) * b{i})' for i in _N)}
FROM (SELECT d.*, z.*, 1 / (1 + exp(-(b0 + {' + '.join(f'b{i} * z{i}' for i in _N)}))) AS p FROM descent_v d, zcells_v z WHERE step < 1500) t
GROUP BY step, b0, {_B}""",
)
view(
    "coefficients_v",
    "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in ("intercept", *UPSELL_FEATURES))
    + f"]) AS feature, unnest([b0, {_B}]) AS coefficient FROM descent_v WHERE step = 1500",
)
select("upsell_fit", f"SELECT feature, {hu('coefficient', 4)} AS coefficient FROM coefficients_v")
select(
    "odds_ratio",
    f"SELECT feature, {hu('coefficient', 3)} AS coefficient, {hu('exp(coefficient)', 3)} AS odds_ratio FROM coefficients_v WHERE feature <> 'intercept'",
)

# --- the tree, level by level ------------------------------------------------------------------------------------

_LEVELS = range(4)
view(
    "tree0_v",
    f"SELECT 1 AS node, {_F}, sum(weight) AS w, sum(weight * label) AS pos FROM cells_v GROUP BY {_F}",
)
view(
    "cuts_v",
    " UNION ALL ".join(
        f"SELECT {i} AS f, (v + lead(v) OVER (ORDER BY v)) / 2.0 AS cut FROM (SELECT DISTINCT {c} AS v FROM cells_v) t"
        for i, c in enumerate(UPSELL_FEATURES)
    ),
)
_X = f"CASE f {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(UPSELL_FEATURES))} END"


def _impurity(w: str, pos: str) -> str:
    return f"({pos} - {pos} * {pos} / {w})"


for _level in _LEVELS:
    view(
        f"best{_level}_v",
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut) AS place FROM (
  SELECT *, {_impurity('w', 'pos')} - {_impurity('wl', 'pl')} - {_impurity('(w - wl)', '(pos - pl)')} AS gain FROM (
    SELECT node, f, cut, sum(w) AS w, sum(pos) AS pos, sum(CASE WHEN {_X} <= cut THEN w ELSE 0 END) AS wl, sum(CASE WHEN {_X} <= cut THEN pos ELSE 0 END) AS pl
    FROM tree{_level}_v, cuts_v WHERE cut IS NOT NULL GROUP BY node, f, cut) a WHERE wl >= 40 AND w - wl >= 40) b WHERE gain > 1e-12) c WHERE place = 1""",
    )
    view(
        f"tree{_level + 1}_v",
        f"""SELECT t.node * 2 + CASE WHEN {_X} <= cut THEN 0 ELSE 1 END AS node, {_F}, t.w, t.pos
FROM tree{_level}_v t JOIN best{_level}_v b ON b.node = t.node""",
    )
view("splits_v", " UNION ALL ".join(f"SELECT node, f, cut, gain FROM best{level}_v" for level in _LEVELS))
select(
    "upsell_tree",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {hu(f'coalesce(sum(gain) FILTER (WHERE f = {i}), 0) / sum(gain)', 3)} AS importance FROM splits_v"
        for i, c in enumerate(UPSELL_FEATURES)
    ),
)
# where the visits of the test set end up, and the share of positives among the training rows there
view("test0_v", f"SELECT visit_id, label, {_F}, 1 AS node FROM split_v WHERE is_test = 1")
for _level in _LEVELS:
    view(
        f"test{_level + 1}_v",
        f"""SELECT visit_id, label, {_F}, CASE WHEN b.node IS NULL THEN t.node WHEN {_X} <= cut THEN t.node * 2 ELSE t.node * 2 + 1 END AS node
FROM test{_level}_v t LEFT JOIN splits_v b ON b.node = t.node""",
    )
view("leaves_v", " UNION ALL ".join(f"SELECT node, sum(pos) / sum(w) AS prob FROM tree{level}_v GROUP BY node" for level in range(5)))


def _auc_of(scores: str) -> str:
    return f"""SELECT {hu(rt(AUC, 'count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)'), 6)} AS auc
FROM (SELECT label, rank() OVER (ORDER BY threshold) + (count(*) OVER (PARTITION BY threshold) - 1) / 2.0 AS rk FROM ({scores}) s) t"""


_SCALES = ", ".join(f"sum(weight * {c}) / sum(weight) AS m_{c}, sum(weight * {c} * {c}) / sum(weight) AS q_{c}" for c in UPSELL_FEATURES)
_LINE = " + ".join(f"b{i} * ({c} - m_{c}) / sqrt(q_{c} - m_{c} * m_{c})" for i, c in enumerate(UPSELL_FEATURES, 1))
_BY_LOGISTIC = f"""SELECT label, {hu(f'1 / (1 + exp(-(b0 + {_LINE})))', 9)} AS threshold
FROM test0_v, (SELECT * FROM descent_v WHERE step = 1500) d, (SELECT {_SCALES} FROM cells_v) m"""
_BY_TREE = f"SELECT label, {hu('prob', 9)} AS threshold FROM test4_v t JOIN leaves_v l ON l.node = t.node"
select(
    "model_choice",
    f"""SELECT a.auc AS auc_logistic, b.auc AS auc_tree, CASE WHEN a.auc >= b.auc THEN 'logistic' ELSE 'tree' END AS chosen
FROM ({_auc_of(_BY_LOGISTIC)}) a, ({_auc_of(_BY_TREE)}) b""",
)

# --- both models on the visits of the test set -------------------------------------------------------------------

_PRED = "CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS pred"
view(
    "tested_v",
    f"""SELECT label, {hu('prob', 9)} AS threshold, {_PRED} FROM (SELECT label, 1 / (1 + exp(-(b0 + {_LINE}))) AS prob
FROM test0_v, (SELECT * FROM descent_v WHERE step = 1500) d, (SELECT {_SCALES} FROM cells_v) m) t""",
)
view("tested_tree_v", f"SELECT label, {_PRED} FROM test4_v t JOIN leaves_v l ON l.node = t.node")
for _name, _rows in (("test", "tested_v"), ("tree", "tested_tree_v")):
    view(f"class_{_name}_v", VIEWS["per_class_v"].replace("prob_v", _rows))
    select(f"confusion_matrix_{_name}", SELECTS["confusion_matrix"].replace("prob_v", _rows))
    select(f"class_report_{_name}", SELECTS["class_report"].replace("per_class_v", f"class_{_name}_v"))
select("auc_test", SELECTS["auc"].replace("prob_v", "tested_v"))
select("roc_curve_test", SELECTS["roc_curve"].replace("SELECT threshold, CAST", "SELECT CAST", 1).replace("prob_v", "tested_v"))

# --- models per store --------------------------------------------------------------------------------------------

view(
    "store_cells_v",
    f"""SELECT concat('ST', CAST(CAST(split_part(visit_id, '|', 1) AS BIGINT) % 5 AS VARCHAR)) AS store_id, {_F}, label, CAST(count(*) AS DOUBLE) AS weight
FROM split_v WHERE is_test = 0 GROUP BY 1, {_F}, label""",
)
_ZS = ", ".join(f"CASE WHEN q_{c} - m_{c} * m_{c} > 1e-12 THEN ({c} - m_{c}) / sqrt(q_{c} - m_{c} * m_{c}) ELSE 0 END AS z{i + 1}" for i, c in enumerate(UPSELL_FEATURES))
view(
    "store_zcells_v",
    f"""SELECT c.store_id, CAST(label AS DOUBLE) AS y, weight / n AS w, 1 / n AS penalty, {_ZS} FROM store_cells_v c
JOIN (SELECT store_id, sum(weight) AS n, min(label) AS a, max(label) AS b, {_MEANS} FROM store_cells_v GROUP BY store_id) s ON s.store_id = c.store_id WHERE a < b""",
)
view(
    "store_descent_v",
    f"""SELECT DISTINCT store_id, 0 AS step, CAST(0 AS DOUBLE) AS b0, {', '.join(f'CAST(0 AS DOUBLE) AS b{i}' for i in _N)} FROM store_zcells_v
UNION ALL
SELECT store_id, step + 1, b0 - 1.2 * sum(w * (p - y)), {', '.join(f'b{i} - 1.2 * (sum(w * (p - y) * z{i}) + max(penalty) * b{i})' for i in _N)}
FROM (SELECT d.*, z.* EXCLUDE (store_id), 1 / (1 + exp(-(b0 + {' + '.join(f'b{i} * z{i}' for i in _N)}))) AS p FROM store_descent_v d JOIN store_zcells_v z ON z.store_id = d.store_id WHERE step < 1500) t
GROUP BY store_id, step, b0, {_B}""",
)
select(
    "upsell_fit_by_store",
    f"""SELECT store_id, feature, {hu('coefficient', 4)} AS coefficient FROM (SELECT store_id, unnest(["""
    + ", ".join(f"'{c}'" for c in ("intercept", *UPSELL_FEATURES))
    + f"]) AS feature, unnest([b0, {_B}]) AS coefficient FROM store_descent_v WHERE step = 1500) t",
)
_ZI = [f"z{i}" for i in range(len(FEATURES))]
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)
view(
    "store_points_v",
    f"""SELECT c.store_id, customer_id, {', '.join(f'CAST(round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END * 1000000, 0) AS BIGINT) AS z{i}' for i, c in enumerate(FEATURES))}
FROM (SELECT *, concat('ST', CAST(customer_id % 5 AS VARCHAR)) AS store_id FROM customers_v) c
JOIN (SELECT concat('ST', CAST(customer_id % 5 AS VARCHAR)) AS store_id, {_STATS} FROM customers_v GROUP BY 1) s ON s.store_id = c.store_id""",
)
view(
    "centres0_v",
    f"""SELECT store_id, start, place - 1 AS cluster, {', '.join(f'CAST({z} AS DOUBLE) AS c{i}' for i, z in enumerate(_ZI))} FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, start ORDER BY (h1 * (start + 1) + h2) % 2147483647, store_id, customer_id) AS place FROM (
    SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2
    FROM (SELECT *, md5(store_id || '|' || CAST(customer_id AS VARCHAR)) AS h FROM store_points_v) a) b, (SELECT range AS start FROM range(5)) r) t WHERE place <= 3""",
)
_D = " + ".join(f"(z{i} - c{i}) * (z{i} - c{i})" for i in range(len(FEATURES)))


def _near(centres: str) -> str:
    return f"""SELECT * FROM (SELECT p.*, start, cluster, {_D} AS d, row_number() OVER (PARTITION BY p.store_id, start, customer_id ORDER BY {_D}, cluster) AS k
    FROM store_points_v p JOIN {centres} c ON c.store_id = p.store_id) n WHERE k = 1"""


for _step in range(12):
    view(
        f"centres{_step + 1}_v",
        f"""SELECT o.store_id, o.start, o.cluster, {', '.join(f'coalesce(n{i}, c{i}) AS c{i}' for i in range(len(FEATURES)))} FROM centres{_step}_v o LEFT JOIN (
  SELECT store_id, start, cluster, {', '.join(f'CAST(sum(z{i}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS n{i}' for i in range(len(FEATURES)))} FROM ({_near(f'centres{_step}_v')}) a
  GROUP BY 1, 2, 3) m ON m.store_id = o.store_id AND m.start = o.start AND m.cluster = o.cluster""",
    )
view("store_near_v", _near("centres12_v"))
select(
    "kmeans_by_store",
    f"""SELECT a.store_id, customer_id, number AS cluster, {hu('d / 1000000000000.0::DOUBLE', 6)} AS sq_distance FROM store_near_v a
JOIN (SELECT store_id, start FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY cost, start) AS k
    FROM (SELECT store_id, start, {hu('sum(d) / 1000000000000.0::DOUBLE', 6)} AS cost FROM store_near_v GROUP BY 1, 2) c) t WHERE k = 1) b ON b.store_id = a.store_id AND b.start = a.start
JOIN (SELECT store_id, start, cluster, row_number() OVER (PARTITION BY store_id, start ORDER BY {', '.join(f'c{i}' for i in range(len(FEATURES)))}, cluster) - 1 AS number
    FROM centres12_v) n ON n.store_id = a.store_id AND n.start = a.start AND n.cluster = a.cluster""",
)

# --- principal components by power iteration ---------------------------------------------------------------------

_K = range(len(FEATURES))
view(
    "cov_v",
    "SELECT "
    + ", ".join(f"covar_samp(z_{FEATURES[min(i, j)]}, z_{FEATURES[max(i, j)]}) AS c{i}{j}" for i in _K for j in _K)
    + " FROM scaled_v",
)


def _iterate(name: str, matrix: str, start: list[float]) -> None:
    """1500 steps of v <- M v / |M v|; `matrix` has the columns c00 .. c44."""
    product = ", ".join(" + ".join(f"c{i}{j} * v{j}" for j in _K) + f" AS u{i}" for i in _K)
    norm = "sqrt(" + " + ".join(f"u{i} * u{i}" for i in _K) + ")"
    view(
        name,
        f"""SELECT 0 AS step, {', '.join(f'CAST({x} AS DOUBLE) AS v{i}' for i, x in enumerate(start))}, CAST(0 AS DOUBLE) AS value
UNION ALL
SELECT step + 1, {', '.join(f'u{i} / {norm}' for i in _K)}, {norm} FROM (SELECT step, {product} FROM {name}, {matrix} WHERE step < 1500) t""",
    )


_iterate("first_pc_v", "cov_v", [1.0, 0.9, 0.8, 0.7, 0.6])
view(
    "deflated_v",
    "SELECT "
    + ", ".join(f"c{i}{j} - value * v{i} * v{j} AS c{i}{j}" for i in _K for j in _K)
    + " FROM cov_v, first_pc_v WHERE step = 1500",
)
_iterate("second_pc_v", "deflated_v", [0.5, -0.6, 0.7, 0.8, -0.9])


def _signed(name: str) -> str:
    """The component with its largest loading positive."""
    largest = "greatest(" + ", ".join(f"abs(v{i})" for i in _K) + ")"
    sign = f"CASE WHEN {' OR '.join(f'v{i} = {largest}' for i in _K)} THEN 1 ELSE -1 END"
    return f"(SELECT {', '.join(f'v{i} * {sign} AS {name}{i}' for i in _K)}, value AS {name}_value FROM {name}_pc_v WHERE step = 1500)"


_TRACE = " + ".join(f"c{i}{i}" for i in _K)
select(
    "customer_pca",
    f"""SELECT customer_id, {hu(' + '.join(f'z_{c} * first{i}' for i, c in enumerate(FEATURES)), 6)} AS pc1,
  {hu(' + '.join(f'z_{c} * second{i}' for i, c in enumerate(FEATURES)), 6)} AS pc2,
  {hu(f'first_value / ({_TRACE})', 6)} AS variance_share_1, {hu(f'second_value / ({_TRACE})', 6)} AS variance_share_2
FROM scaled_v, {_signed('first')} a, {_signed('second')} b, cov_v""",
)
