"""The same queries as plain SQL over the driver tables, to check results against another engine."""

from __future__ import annotations

import re

from comanda.sources.binding import BOUND_TABOO

VIEWS: dict[str, str] = {}
SELECTS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def select(name: str, sql: str) -> None:
    SELECTS[name] = sql


def hu(x: str, digits: int) -> str:
    """Half-up rounding on the decimal text, as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def rt(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def _kind(name: str) -> str:
    """What an iteration or a later level reads again is computed once."""
    once = ("set_rules_v", "zcells_v", "cov_v", "deflated_v", "cells_v", "split_v", "splits_v")
    return " MATERIALIZED" if name in once or re.match(r"(tree|best|test|iso_l|iso_c)\d_v|iso_(rows|nodes)_v|centres\d+_v|(drawn|fixed)\d_v|store_(points|zcells|near)_v", name) else ""


def with_views(sql: str) -> str:
    """Prefix the statement with the views it names, each after the views it reads."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    if not needed:
        return sql
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in VIEWS:
            if other != name and other not in ordered and re.search(rf"\b{other}\b", VIEWS[name]):
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(needed):
        place(name)
    ctes = ",\n".join(f"{name} AS{_kind(name)} (\n{VIEWS[name]}\n)" for name in ordered)
    return f"WITH RECURSIVE {ctes}\n{sql}"


def load_all() -> dict[str, str]:
    from comanda.plans import oracle_customers, oracle_reorder, oracle_stock, oracle_visits  # noqa: F401

    return {name: with_views(sql) for name, sql in SELECTS.items()}


# --- the driver tables as domain tables -------------------------------------------------------------------------

view(
    "parts_b",
    """SELECT p_partkey, concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS item_id, type,
  CASE p_size % 5 WHEN 0 THEN 'Red_Meat' WHEN 1 THEN 'Seafood' WHEN 2 THEN 'Cheese' WHEN 3 THEN 'Fried' ELSE 'Universal' END AS pairing_tag,
  CAST(p_size % 5 AS BIGINT) AS tag_no,
  CAST(CASE type WHEN 'main' THEN 0.40 WHEN 'side' THEN 0.68 WHEN 'dessert' THEN 0.66 ELSE 0.55 + 0.05 * (p_size % 5) END AS DECIMAL(5,4)) AS profit_margin,
  CAST(round(p_retailprice * 100) AS BIGINT) AS retail_cents
FROM (SELECT *, CASE WHEN p_type IN ('PROMO','LARGE') THEN 'drink' WHEN p_type IN ('ECONOMY','STANDARD') THEN 'main'
  WHEN p_type = 'MEDIUM' THEN 'side' ELSE 'dessert' END AS type FROM part) t""",
)
view(
    "menu_b",
    """SELECT item_id, type, pairing_tag, tag_no, profit_margin,
  CAST(CAST((sum(retail_cents) * 2 + count(*)) // (count(*) * 2) AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)) AS price,
  CASE WHEN type = 'drink' THEN CASE tag_no WHEN 0 THEN 'red' WHEN 1 THEN 'white_sparkling' WHEN 2 THEN 'cocktail'
    WHEN 3 THEN 'beer' ELSE 'alcohol_free' END END AS drink_category,
  type = 'drink' AND tag_no IN (0, 1) AS slow_wine
FROM parts_b GROUP BY item_id, type, pairing_tag, tag_no, profit_margin""",
)
view(
    "order_items_b",
    """SELECT concat('ST', CAST(l_orderkey % 10 AS VARCHAR)) AS store_id, l_orderkey AS visit_id, o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS date, p.item_id, p.type, p.pairing_tag, 17 + o_orderkey % 8 AS arrival_hour,
  CAST(l_quantity AS BIGINT) AS units, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, p.profit_margin,
  CAST(l_extendedprice AS DECIMAL(18,2)) * p.profit_margin AS profit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN parts_b p ON l_partkey = p.p_partkey""",
)
view(
    "heads_b",
    """SELECT o_orderkey AS visit_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date, 17 + o_orderkey % 8 AS arrival_hour,
  1 + o_orderkey % 6 AS party_size, 30 + o_orderkey % 211 AS duration_min,
  CAST(CASE WHEN o_orderkey % 10 < 3 THEN 1 ELSE 0 END AS BIGINT) AS is_repeat
FROM orders""",
)

# --- basket rules ------------------------------------------------------------------------------------------------

select("baskets", "SELECT DISTINCT visit_id, item_id FROM order_items_b")
select(
    "baskets_daypart",
    "SELECT daypart, visit_id, item_id FROM dayparts_v WHERE daypart IS NOT NULL",
)
view("baskets_v", "SELECT DISTINCT visit_id, arrival_hour, item_id, type, pairing_tag FROM order_items_b")
view(
    "support_v",
    """SELECT item_id, type, count(*) AS n_item, (SELECT count(DISTINCT visit_id) FROM baskets_v) AS n
FROM baskets_v GROUP BY item_id, type""",
)
view(
    "pairs_v",
    """SELECT a.item_id AS antecedent_id, b.item_id AS consequent_id, count(*) AS n_ab
FROM baskets_v a JOIN baskets_v b ON a.visit_id = b.visit_id
WHERE a.type IN ('main','side') AND b.type = 'drink' GROUP BY 1, 2""",
)
view(
    "rules_v",
    f"""SELECT p.antecedent_id, p.consequent_id, {hu(rt('n_ab', 'a.n'), 4)} AS support, {hu(rt('n_ab', 'a.n_item'), 4)} AS confidence,
  {hu(rt('n_ab * a.n', 'a.n_item * b.n_item'), 3)} AS lift,
  round(m.price * m.profit_margin, 1) AS unit_profit,
  CAST({hu(rt('n_ab * (m.price * m.profit_margin)', 'a.n_item'), 1)} AS DECIMAL(12,1)) AS expected_profit
FROM pairs_v p JOIN support_v a ON a.item_id = p.antecedent_id JOIN support_v b ON b.item_id = p.consequent_id
JOIN menu_b m ON m.item_id = p.consequent_id
WHERE n_ab >= a.n * 0.01 AND n_ab >= a.n_item * 0.05""",
)
select(
    "item_support",
    f"""SELECT item_id, n_item AS baskets, n AS n_baskets, {hu(rt('n_item', 'n'), 4)} AS support FROM support_v""",
)
select("pair_counts", "SELECT antecedent_id, consequent_id, n_ab AS baskets FROM pairs_v")
select(
    "association_rules",
    """SELECT antecedent_id AS antecedent, antecedent_id, consequent_id AS consequent, consequent_id, support, confidence, lift,
  CAST(unit_profit AS DOUBLE) AS unit_profit, CAST(expected_profit AS DOUBLE) AS expected_profit FROM rules_v""",
)
select("association_rules_blocks", SELECTS["association_rules"])
view("dessert_pairs_v", VIEWS["pairs_v"].replace("a.type IN ('main','side')", "a.type = 'dessert'"))
view("dessert_rules_v", VIEWS["rules_v"].replace("pairs_v", "dessert_pairs_v"))
select("dessert_rules", SELECTS["association_rules"].replace("rules_v", "dessert_rules_v"))
select("fpgrowth_pairs", "SELECT antecedent_id, consequent_id, support, confidence, lift FROM rules_v")
view(
    "set_counts_v",
    """SELECT a.item_id AS antecedent_id, 1 AS n_dishes, a.n_item AS n_a FROM support_v a WHERE a.type IN ('main','side')
UNION ALL
SELECT concat(x.item_id, '+', y.item_id), 2, count(*) FROM baskets_v x JOIN baskets_v y ON x.visit_id = y.visit_id AND x.item_id < y.item_id
WHERE x.type IN ('main','side') AND y.type IN ('main','side') GROUP BY x.item_id, y.item_id""",
)
view(
    "set_visits_v",
    """SELECT visit_id, item_id AS antecedent_id FROM baskets_v WHERE type IN ('main','side')
UNION ALL
SELECT x.visit_id, concat(x.item_id, '+', y.item_id) FROM baskets_v x JOIN baskets_v y ON x.visit_id = y.visit_id AND x.item_id < y.item_id
WHERE x.type IN ('main','side') AND y.type IN ('main','side')""",
)
view(
    "set_rules_v",
    f"""SELECT p.antecedent_id, p.consequent_id, a.n_dishes, {hu(rt('n_ab', 'b.n'), 4)} AS support, {hu(rt('n_ab', 'a.n_a'), 4)} AS confidence,
  {hu(rt('n_ab * b.n', 'a.n_a * b.n_item'), 3)} AS lift, round(m.price * m.profit_margin, 1) AS unit_profit,
  CAST({hu(rt('n_ab * (m.price * m.profit_margin)', 'a.n_a'), 1)} AS DECIMAL(12,1)) AS expected_profit
FROM (SELECT s.antecedent_id, b.item_id AS consequent_id, count(*) AS n_ab FROM set_visits_v s JOIN baskets_v b ON b.visit_id = s.visit_id
    WHERE b.type = 'drink' GROUP BY 1, 2) p
JOIN set_counts_v a ON a.antecedent_id = p.antecedent_id JOIN support_v b ON b.item_id = p.consequent_id JOIN menu_b m ON m.item_id = p.consequent_id
WHERE n_ab >= b.n * 0.01 AND n_ab >= a.n_a * 0.05""",
)
select(
    "fpgrowth_rules",
    """SELECT antecedent_id, consequent_id, support, confidence, lift, CAST(unit_profit AS DOUBLE) AS unit_profit,
  CAST(expected_profit AS DOUBLE) AS expected_profit, CAST(n_dishes AS BIGINT) AS n_dishes FROM set_rules_v""",
)
view("set_hits_v", "SELECT s.visit_id, r.* FROM set_visits_v s JOIN set_rules_v r ON r.antecedent_id = s.antecedent_id")
view(
    "hits_v",
    """SELECT o.visit_id, o.arrival_hour, r.* FROM baskets_v o JOIN rules_v r ON r.antecedent_id = o.item_id
WHERE o.type IN ('main','side')""",
)


def _recommend(score: str, extra: str) -> str:
    return f"""SELECT visit_id, CAST(rank AS BIGINT) AS rank, consequent_id, antecedent_id, {extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY visit_id ORDER BY {score} DESC, consequent_id, antecedent_id) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY visit_id, consequent_id ORDER BY {score} DESC, antecedent_id) AS k FROM hits_v) t
  WHERE k = 1) u WHERE rank <= 3"""


select("recommend_profit", _recommend("expected_profit", "CAST(expected_profit AS DOUBLE) AS expected_profit"))
select("recommend_confidence", _recommend("confidence", "confidence"))
select("recommend_sets", _recommend("expected_profit", "CAST(expected_profit AS DOUBLE) AS expected_profit").replace("hits_v", "set_hits_v"))
select("recommend_raw", _recommend("expected_profit", "CAST(expected_profit AS DOUBLE) AS final_score"))


def _per_dish(score: str) -> str:
    return f"""SELECT antecedent_id, sum(expected_profit) AS v FROM (
  SELECT *, row_number() OVER (PARTITION BY antecedent_id ORDER BY {score} DESC, consequent_id) AS k FROM rules_v) t
  WHERE k <= 3 GROUP BY antecedent_id"""


select(
    "strategy_uplift",
    f"""SELECT count(*) AS n_dishes, {hu(rt('sum(p.v)', 'count(*)'), 2)} AS avg_by_profit,
  {hu(rt('sum(c.v)', 'count(*)'), 2)} AS avg_by_confidence, {hu('(' + rt('sum(p.v)', 'sum(c.v)') + ' - 1) * 100', 2)} AS uplift_pct
FROM ({_per_dish('expected_profit')}) p JOIN ({_per_dish('confidence')}) c ON p.antecedent_id = c.antecedent_id""",
)
select(
    "rules_by_daypart",
    f"""SELECT daypart, antecedent_id, CAST(rank AS BIGINT) AS rank, consequent_id, support, confidence, lift, CAST(expected_profit AS DOUBLE) AS expected_profit FROM (
  SELECT *, row_number() OVER (PARTITION BY daypart, antecedent_id ORDER BY expected_profit DESC, consequent_id) AS rank FROM (
    SELECT p.daypart, a.item_id AS antecedent_id, b.item_id AS consequent_id, {hu(rt('n_ab', 'n'), 4)} AS support,
      {hu(rt('n_ab', 'a.n_item'), 4)} AS confidence, {hu(rt('n_ab * n', 'a.n_item * b.n_item'), 3)} AS lift,
      CAST({hu(rt('n_ab * (m.price * m.profit_margin)', 'a.n_item'), 1)} AS DECIMAL(12,1)) AS expected_profit
    FROM (SELECT a.daypart, a.item_id AS a, b.item_id AS b, count(*) AS n_ab FROM dayparts_v a JOIN dayparts_v b
          ON a.visit_id = b.visit_id WHERE a.type IN ('main','side') AND b.type = 'drink' GROUP BY 1, 2, 3) p
    JOIN (SELECT daypart, count(DISTINCT visit_id) AS n FROM dayparts_v GROUP BY 1) t ON t.daypart = p.daypart
    JOIN (SELECT daypart, item_id, count(*) AS n_item FROM dayparts_v GROUP BY 1, 2) a ON a.daypart = p.daypart AND a.item_id = p.a
    JOIN (SELECT daypart, item_id, count(*) AS n_item FROM dayparts_v GROUP BY 1, 2) b ON b.daypart = p.daypart AND b.item_id = p.b
    JOIN menu_b m ON m.item_id = p.b
    WHERE n_ab >= n * 0.01 AND n_ab >= a.n_item * 0.05) r) s WHERE rank <= 3""",
)
view(
    "dayparts_v",
    """SELECT CASE WHEN arrival_hour BETWEEN 17 AND 20 THEN 'dinner' WHEN arrival_hour BETWEEN 21 AND 24 THEN 'buzz' END AS daypart, * FROM baskets_v""",
)

# --- domain rules ------------------------------------------------------------------------------------------------

_TABOO = ", ".join(f"('{f}', '{d}', '{r}')" for f, d, r in BOUND_TABOO)
view("taboo_v", f"SELECT * FROM (VALUES {_TABOO}) AS t(food_tag, consequent_id, reason)")
view(
    "marked_v",
    """SELECT r.*, f.pairing_tag AS food_tag, d.pairing_tag AS drink_tag, d.drink_category AS category, d.slow_wine, t.reason
FROM rules_v r JOIN menu_b f ON f.item_id = r.antecedent_id JOIN menu_b d ON d.item_id = r.consequent_id
LEFT JOIN taboo_v t ON t.food_tag = f.pairing_tag AND t.consequent_id = r.consequent_id""",
)
view(
    "penalised_v",
    """SELECT *, round(expected_profit * pairing_factor, 1) AS pairing_score FROM (
  SELECT *, CAST(CASE WHEN food_tag = 'Red_Meat' AND drink_tag = 'Seafood' THEN 0.75
    WHEN food_tag = 'Seafood' AND drink_tag = 'Red_Meat' THEN 0.70 ELSE 1.00 END AS DECIMAL(5,2)) AS pairing_factor FROM marked_v) t""",
)
select(
    "taboo_kept",
    "SELECT antecedent_id, consequent_id, CAST(expected_profit AS DOUBLE) AS expected_profit FROM marked_v WHERE reason IS NULL",
)
select("taboo_blocked", "SELECT antecedent_id, consequent_id, reason FROM marked_v WHERE reason IS NOT NULL")
select(
    "blocked_by_visit",
    """SELECT o.visit_id, r.antecedent_id, r.consequent_id, r.reason FROM baskets_v o JOIN marked_v r ON r.antecedent_id = o.item_id
WHERE o.type IN ('main','side') AND r.reason IS NOT NULL""",
)
select(
    "pairing_penalty",
    """SELECT antecedent_id, consequent_id, CAST(pairing_factor AS DOUBLE) AS pairing_factor,
  CAST(pairing_score AS DOUBLE) AS pairing_score FROM penalised_v""",
)
view(
    "adjusted_v",
    """SELECT *, round(pairing_score * hour_factor, 1) AS final_score FROM (
  SELECT o.visit_id, o.arrival_hour, r.*, CAST(CASE WHEN o.arrival_hour >= 21 AND r.category = 'cocktail' THEN 1.20
    WHEN o.arrival_hour >= 23 AND r.slow_wine THEN 0.70 ELSE 1.00 END AS DECIMAL(5,2)) AS hour_factor
  FROM baskets_v o JOIN penalised_v r ON r.antecedent_id = o.item_id WHERE o.type IN ('main','side') AND r.reason IS NULL) t""",
)
select(
    "hour_adjusted",
    """SELECT visit_id, antecedent_id, consequent_id, CAST(pairing_score AS DOUBLE) AS pairing_score,
  CAST(hour_factor AS DOUBLE) AS hour_factor, CAST(final_score AS DOUBLE) AS final_score FROM adjusted_v""",
)


def _diversify(source: str, score: str) -> str:
    """Greedy in score order: leaders of their category first, the others after them."""
    return f"""SELECT *, CASE WHEN lead = 1 THEN 0 ELSE 1 END AS grp, row_number() OVER (
    PARTITION BY visit_id ORDER BY CASE WHEN lead = 1 THEN 0 ELSE 1 END, {score} DESC, consequent_id) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY visit_id, category ORDER BY {score} DESC, consequent_id) AS lead
    FROM (SELECT *, row_number() OVER (PARTITION BY visit_id, consequent_id ORDER BY {score} DESC, antecedent_id) AS k
      FROM {source}) t WHERE k = 1) u"""


view(
    "tagged_hits_v",
    """SELECT o.visit_id, r.* FROM baskets_v o JOIN marked_v r ON r.antecedent_id = o.item_id WHERE o.type IN ('main','side')""",
)
view("ruled_v", _diversify("adjusted_v", "final_score"))
select(
    "diversified_topn",
    f"""SELECT visit_id, CAST(rank AS BIGINT) AS rank, consequent_id, category, CAST(expected_profit AS DOUBLE) AS expected_profit
FROM ({_diversify('tagged_hits_v', 'expected_profit')}) d WHERE rank <= 3""",
)
RULED = """SELECT visit_id, CAST(rank AS BIGINT) AS rank, consequent_id, antecedent_id, category,
  CAST(expected_profit AS DOUBLE) AS expected_profit, CAST(final_score AS DOUBLE) AS final_score FROM ruled_v WHERE rank <= 3"""
select("recommend_rules", RULED)
view("adjusted_earlier_v", VIEWS["adjusted_v"].replace("arrival_hour >= 21", "arrival_hour >= 20").replace("arrival_hour >= 23", "arrival_hour >= 22"))
view("ruled_earlier_v", _diversify("adjusted_earlier_v", "final_score"))
select("recommend_rules_factors", RULED.replace("ruled_v", "ruled_earlier_v"))
select(
    "rec_set_value",
    """SELECT visit_id, count(*) AS n_drinks, CAST(sum(expected_profit) AS DOUBLE) AS set_value FROM ruled_v WHERE rank <= 3 GROUP BY visit_id""",
)
