"""Baskets, rules and re-ranking against plain loops over small random data."""

import itertools
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from comanda.operators import basket, rerank
from comanda.params import ENGLISH_TYPES as TYPES
from comanda.params import HourFactors, RuleThresholds
from comanda.sources import schemas

FOODS, SWEETS, DRINKS = [f"f{i}" for i in range(8)], ["s0", "s1"], [f"w{i}" for i in range(6)]
TYPE = {**{f: "main" if i % 2 else "side" for i, f in enumerate(FOODS)}, **{s: "dessert" for s in SWEETS}, **{w: "drink" for w in DRINKS}}


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    lines = []
    for v in range(300):
        for item in rng.choices(FOODS + SWEETS + DRINKS, weights=[9, 8, 7, 6, 5, 4, 3, 1] + [3, 1] + [9, 7, 5, 3, 2, 1], k=rng.randint(1, 7)):
            lines.append((v, item, TYPE[item], rng.choice([18, 19, 21, 24])))
    lines += [(1000, "s0", "dessert", 18)]  # neither dish nor drink, still a basket
    lines += [(1001, rng.choice(FOODS), "main", 18) for _ in range(400)]  # one visit with most of the lines
    lines = [(v, i, TYPE[i], 18 + v % 7) for v, i, _, _ in lines]
    df = spark.createDataFrame(lines, "visit_id BIGINT, item_id STRING, type STRING, arrival_hour BIGINT")
    menu = [(i, i.upper(), t, "Universal", Decimal(100 + 10 * n), Decimal("0.5")) for n, (i, t) in enumerate(TYPE.items())]
    return df, lines, spark.createDataFrame(menu, schemas.MENU)


def baskets_of(lines):
    out = {}
    for v, item, *_ in lines:
        out.setdefault(v, set()).add(item)
    return out


def counts_of(baskets):
    single, pair = Counter(), Counter()
    for items in baskets.values():
        single.update(items)
        pair.update((a, b) for a in items for b in items if TYPE[a] in TYPES.foods and TYPE[b] == "drink")
    return single, pair


def test_baskets_and_counts(data):
    df, lines, _ = data
    want = baskets_of(lines)
    got = basket.build_baskets(df).collect()
    assert {(r["visit_id"], r["item_id"]) for r in got} == {(v, i) for v, s in want.items() for i in s}
    assert len(got) == sum(map(len, want.values()))
    single, pair = counts_of(want)
    support = basket.item_support(df).collect()
    assert {r["item_id"]: (r["baskets"], r["n_baskets"]) for r in support} == {i: (n, len(want)) for i, n in single.items()}
    found = basket.pair_counts(basket.basket_sets(df, TYPES)).collect()
    assert {(r["antecedent_id"], r["consequent_id"]): r["baskets"] for r in found} == dict(pair)


@pytest.mark.parametrize("min_support", ["0.01", "0.05"])
def test_rules(data, min_support):
    df, lines, menu = data
    want = baskets_of(lines)
    single, pair = counts_of(want)
    n = len(want)
    keep = {
        (a, b) for (a, b), c in pair.items() if Decimal(c) >= n * Decimal(min_support) and Decimal(c) >= single[a] * Decimal("0.05")
    }
    rules = basket.association_rules(basket.basket_sets(df, TYPES), menu, RuleThresholds(min_support)).collect()
    assert {(r["antecedent_id"], r["consequent_id"]) for r in rules} == keep and len(rules) == len(keep)
    price = {i: 100 + 10 * k for k, i in enumerate(TYPE)}
    for r in rules:
        a, b = r["antecedent_id"], r["consequent_id"]
        assert r["support"] == pytest.approx(pair[a, b] / n, abs=6e-5)
        assert r["confidence"] == pytest.approx(pair[a, b] / single[a], abs=6e-5) and 0 <= r["confidence"] <= 1
        assert r["lift"] == pytest.approx(pair[a, b] * n / single[a] / single[b], abs=6e-4)
        assert float(r["expected_profit"]) == pytest.approx(pair[a, b] / single[a] * price[b] * 0.5, abs=0.051)
        assert (r["antecedent"], r["consequent"]) == (a.upper(), b.upper())


def test_support_at_the_threshold_is_kept(spark):
    # 100 baskets, the pair in exactly one: support 0.01
    lines = [(v, "f0" if v else "f1", "main") for v in range(100)] + [(0, "w0", "drink")]
    df = spark.createDataFrame(lines, "visit_id BIGINT, item_id STRING, type STRING")
    menu = spark.createDataFrame([(i, i, "", "", Decimal(10), Decimal("0.5")) for i in ("f0", "f1", "w0")], schemas.MENU)
    rules = basket.association_rules(basket.basket_sets(df, TYPES), menu).collect()
    assert [(r["antecedent_id"], r["support"], r["confidence"], r["lift"]) for r in rules] == [("f1", 0.01, 1.0, 100.0)]


def test_rules_per_daypart(data):
    df, lines, menu = data
    parts = {"dinner": (17, 20), "buzz": (21, 24)}
    keyed = basket.basket_sets(basket.add_daypart(df, parts), TYPES, ["daypart"])
    together = basket.association_rules(keyed, menu, keys=["daypart"]).collect()
    for name, hours in parts.items():
        visits = df.select("visit_id", "arrival_hour").distinct()
        alone = basket.association_rules(basket.basket_sets(basket.in_hours(df.drop("arrival_hour"), visits, hours), TYPES), menu)
        want = {tuple(r[c] for c in ("antecedent_id", "consequent_id", "support", "lift")) for r in alone.collect()}
        got = {tuple(r[c] for c in ("antecedent_id", "consequent_id", "support", "lift")) for r in together if r["daypart"] == name}
        assert got == want and got


def test_fpgrowth_gives_the_same_rules(data):
    df, _, menu = data
    sets = basket.basket_sets(df, TYPES)
    columns = ("antecedent_id", "consequent_id", "support", "confidence", "lift")
    mine = {tuple(r[c] for c in columns) for r in basket.association_rules(sets, menu).collect()}
    theirs = {tuple(r[c] for c in columns) for r in basket.fpgrowth_pairs(sets).collect()}
    assert mine == theirs
    assert any("+" in r["antecedent_id"] for r in basket.fpgrowth_pairs(sets, max_antecedents=None).collect())


def random_rules(rng):
    return [(a, b, Decimal(rng.randint(1, 60)) / 2, rng.randint(1, 20) / 20) for a in FOODS for b in DRINKS if rng.random() < 0.7]


@pytest.mark.parametrize("strategy", ["profit", "confidence"])
def test_recommend_for_all_visits(spark, data, strategy):
    df, lines, _ = data
    rules = random_rules(random.Random(5))
    table = spark.createDataFrame(rules, "antecedent_id STRING, consequent_id STRING, expected_profit DECIMAL(12,1), confidence DOUBLE")
    score = {(a, b): (p if strategy == "profit" else c) for a, b, p, c in rules}
    sets = basket.basket_sets(df, TYPES)
    got = {}
    picked = basket.for_all_visits(sets, lambda orders, group: basket.recommend(orders, table, 3, strategy, group))
    for r in picked.collect():
        got.setdefault(r["visit_id"], {})[r["rank"]] = (r["consequent_id"], r["antecedent_id"])
    want = {}
    for v, items in baskets_of(lines).items():
        best = {}
        for a in sorted(items):
            for b in DRINKS:
                if (a, b) in score and TYPE[a] in TYPES.foods and (b not in best or score[a, b] > score[best[b], b]):
                    best[b] = a
        top = sorted(best, key=lambda b: (-score[best[b], b], b))[:3]
        if top:
            want[v] = {i + 1: (b, best[b]) for i, b in enumerate(top)}
    assert got == want


def greedy(rows, n):
    """rows sorted by score: one per category, then fill up."""
    picked, used = [], set()
    for drink, category, _ in rows:
        if category not in used and len(picked) < n:
            used.add(category)
            picked.append(drink)
    for drink, _, _ in rows:
        if drink not in picked and len(picked) < n:
            picked.append(drink)
    return picked


def test_diversify_is_the_greedy_choice(spark):
    rng = random.Random(11)
    cases = {}
    for case in range(400):
        rows = [(f"w{i:02d}", rng.choice("abcd"), Decimal(rng.randint(1, 8))) for i in range(rng.randint(0, 9))]
        cases[case] = sorted(rows, key=lambda r: (-r[2], r[0]))
    flat = [(c, *r) for c, rows in cases.items() for r in rows]
    df = spark.createDataFrame(flat, "visit_id INT, consequent_id STRING, category STRING, final_score DECIMAL(12,1)")
    got = {}
    for r in rerank.diversify(df, 3, group=["visit_id"]).orderBy("visit_id", "rank").collect():
        got.setdefault(r["visit_id"], []).append(r["consequent_id"])
    assert got == {c: greedy(rows, 3) for c, rows in cases.items() if rows}


def test_hour_factor_edges(spark):
    rows = [("cocktail", False, h) for h in (20, 21, 24)] + [("red", True, h) for h in (22, 23, 24)] + [("beer", False, 24)]
    df = spark.createDataFrame(rows, "category STRING, slow_wine BOOLEAN, arrival_hour BIGINT")
    factor = rerank.hour_factor(F.col("category"), F.col("slow_wine"), F.col("arrival_hour"))
    assert [float(r[0]) for r in df.select(factor).collect()] == [1.0, 1.2, 1.2, 1.0, 0.7, 0.7, 1.0]
    step = rerank.hour_step(F.col("h"), HourFactors())
    hours = spark.range(17, 25).select(F.col("id").alias("h")).select("h", step.alias("s")).collect()
    assert [r["s"] for r in hours] == [0, 0, 0, 0, 21, 21, 23, 23]


def test_categories(spark):
    names = {"W13": "無酒精莫吉托", "W07": "Old Fashioned", "W01": "x", "W05": "x", "W09": "x", "W12": "x"}
    menu = spark.createDataFrame(list(names.items()), "item_id STRING, item_name STRING")
    got = {r["item_id"]: (r["drink_category"], r["slow_wine"]) for r in rerank.with_categories(menu).collect()}
    assert got == {
        "W13": ("alcohol_free", False),
        "W07": ("cocktail", False),
        "W01": ("red", True),
        "W05": ("white_sparkling", False),
        "W09": ("beer", False),
        "W12": ("cocktail", False),
    }


def test_rows_without_keys_are_left_out(spark):
    df = spark.createDataFrame([(1, "f0", "main"), (None, "f1", "main"), (2, None, "main")], "visit_id BIGINT, item_id STRING, type STRING")
    assert [tuple(r) for r in basket.build_baskets(df).collect()] == [(1, "f0")]
    assert basket.basket_sets(df, TYPES).count() == 1


def sets_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for v in range(n):
        foods = sorted({f"f{int(x)}" for x in rng.zipf(1.5, int(rng.integers(0, 6))) if x < 9})
        drinks = sorted({f"d{int(x)}" for x in rng.integers(0, 4, int(rng.integers(0, 3)))})
        rows.append((v, foods, drinks))
    return rows, spark.createDataFrame(rows, "visit_id BIGINT, foods ARRAY<STRING>, drinks ARRAY<STRING>")


@pytest.mark.parametrize("most", [1, 2, 3])
def test_rules_of_several_dishes(spark, most):
    rows, sets = sets_frame(spark)
    menu = spark.createDataFrame([(f"d{i}", Decimal(10 * i + 5), Decimal("0.5")) for i in range(4)], "item_id STRING, price DECIMAL(8,2), profit_margin DECIMAL(5,4)")
    got = {(r["antecedent_id"], r["consequent_id"]): (r["support"], r["confidence"], r["lift"], r["expected_profit"]) for r in basket.set_rules(sets, menu, RuleThresholds("0.02", "0.1"), most).collect()}
    want = {}
    count = lambda *items: sum(set(items) <= set(f) | set(d) for _, f, d in rows)
    for k in range(1, most + 1):
        for dishes in itertools.combinations([f"f{i}" for i in range(1, 9)], k):
            for d in ("d0", "d1", "d2", "d3"):
                ab, a, b = count(*dishes, d), count(*dishes), count(d)
                if ab >= 0.02 * len(rows) and ab >= 0.1 * a:
                    want["+".join(dishes), d] = (ab / len(rows), ab / a, ab * len(rows) / (a * b), ab * (10 * int(d[1]) + 5) / 2 / a)
    assert got.keys() == want.keys() and any("+" in a for a, _ in want) == (most > 1)
    for k, (s, c, lift, profit) in want.items():
        assert [float(x) for x in got[k]] == pytest.approx([s, c, lift, profit], abs=0.051) and abs(got[k][0] - s) < 6e-5 and abs(got[k][2] - lift) < 6e-4


def test_orders_hold_sets(spark):
    rows, _ = sets_frame(spark, 200, 5)
    wanted = [["f1"], ["f1", "f2"], ["f1", "f2", "f3"], ["f3", "f4"], ["f1", "zz"], ["zz"]]
    rules = spark.createDataFrame([("+".join(d), d) for d in wanted], "antecedent_id STRING, dishes ARRAY<STRING>")
    orders = spark.createDataFrame([(v, f) for v, foods, _ in rows for f in [*foods, *foods[:1]]], "pattern BIGINT, antecedent_id STRING")
    held = basket.held_sets(orders, rules)
    got = sorted(tuple(r) for r in held.collect())
    assert got == sorted((v, "+".join(d)) for v, foods, _ in rows for d in wanted if set(d) <= set(foods)) and any(k.count("+") == 2 for _, k in got)
    plan = held._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_recommendations_by_sets(spark):
    rules = [("f1", ["f1"], "d0", 5), ("f2", ["f2"], "d1", 9), ("f1+f2", ["f1", "f2"], "d0", 12), ("f1+f2", ["f1", "f2"], "d2", 9), ("f3", ["f3"], "d3", 1)]
    table = spark.createDataFrame([(a, s, d, Decimal(p)) for a, s, d, p in rules], "antecedent_id STRING, dishes ARRAY<STRING>, consequent_id STRING, expected_profit DECIMAL(12,1)")
    orders = spark.createDataFrame([("x", "f1"), ("x", "f2"), ("x", "f3"), ("y", "f1"), ("z", "f9")], "pattern STRING, antecedent_id STRING")
    got = sorted((r["pattern"], r["rank"], r["consequent_id"], r["antecedent_id"]) for r in basket.recommend_by_sets(orders, table).collect())
    assert got == [("x", 1, "d0", "f1+f2"), ("x", 2, "d1", "f2"), ("x", 3, "d2", "f1+f2"), ("y", 1, "d0", "f1")]


@pytest.mark.parametrize("block", [1, 3, 256])
def test_rules_by_blocks_are_the_rules(spark, block):
    rng = np.random.default_rng(7)
    kinds = {f"f{i}": "main" for i in range(12)} | {f"w{i}": "drink" for i in range(7)} | {"s0": "dessert"}
    names = sorted(kinds)
    lines = [(f"T{v % 2}", v, names[int(x)], kinds[names[int(x)]]) for v in range(150) for x in rng.integers(0, len(names), int(rng.integers(0, 25)))]
    lines += [("T0", None, "f1", "main"), ("T0", 7, None, "main")]
    items = spark.createDataFrame(lines, "store_id STRING, visit_id BIGINT, item_id STRING, type STRING").repartition(4)
    menu = spark.createDataFrame([(n, n, Decimal(9), Decimal("0.5")) for n in names], "item_id STRING, item_name STRING, price DECIMAL(8,2), profit_margin DECIMAL(5,4)")
    for keys in ([], ["store_id"]):
        plain = basket.association_rules(basket.basket_sets(items, TYPES, keys), menu, RuleThresholds("0.05", "0.1"), keys)
        blocked = basket.association_rules_by_blocks(items, menu, TYPES, RuleThresholds("0.05", "0.1"), keys, block)
        assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, plain.collect())) and plain.count() > 20


def test_a_visit_of_a_million_items(spark):
    large = spark.range(1_000_000).select(F.lit(0).cast("bigint").alias("visit_id"), F.concat(F.lit("i"), "id").alias("item_id"), F.when(F.col("id") % 2 == 0, "main").otherwise("drink").alias("type"))
    small = spark.createDataFrame([(v, i, t) for v in range(1, 60) for i, t in (("i0", "main"), ("i1", "drink"), ("i2", "main"))], "visit_id BIGINT, item_id STRING, type STRING")
    items = large.unionByName(small)
    menu = spark.createDataFrame([("i0", "x", Decimal(9), Decimal("0.5")), ("i1", "y", Decimal(9), Decimal("0.5")), ("i2", "z", Decimal(9), Decimal("0.5"))], "item_id STRING, item_name STRING, price DECIMAL(8,2), profit_margin DECIMAL(5,4)")
    got = basket.association_rules_by_blocks(items, menu, TYPES, RuleThresholds("0.05", "0.1")).collect()
    assert sorted((r["antecedent_id"], r["consequent_id"], r["support"]) for r in got) == [("i0", "i1", 1.0), ("i2", "i1", 1.0)]
    held = basket.blocks(large.withColumn("item", F.col("item_id")), "held", [], 256).select(F.size("held").alias("n"))
    assert held.agg(F.max("n"), F.sum("n")).first()[:] <= (400, 1_000_000)
