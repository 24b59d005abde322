"""The streams give what the batch gives, over several files and batches, and again after a restart."""

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from comanda.operators import rerank, upsell
from comanda.params import UPSELL_FEATURES
from comanda.session import shared_folder
from comanda.streaming import jobs

RULES = "antecedent_id STRING, consequent_id STRING, expected_profit DECIMAL(12,1), pairing_score DECIMAL(12,1), category STRING, slow_wine BOOLEAN"


@pytest.fixture(scope="module")
def rules(spark):
    rows = [(f"f{a}", f"w{b}", Decimal(10 * a + b), Decimal(10 * a + 7 * b % 11), "abc"[b % 3], b % 2 == 0) for a in range(4) for b in range(5)]
    return spark.createDataFrame(rows, RULES)


def key(rows):
    return sorted((r["visit_id"], r["rank"], r["consequent_id"], r["antecedent_id"], float(r["final_score"])) for r in rows)


def test_recommendations(spark, rules, tmp_path):
    requests = spark.createDataFrame(
        [(v, [f"f{v % 4}", f"f{v % 3}"] if v % 5 else [], 17 + v % 8) for v in range(40)],
        "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT",
    )
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    requests.filter("visit_id < 25").repartition(4).write.parquet(folder)

    def run():
        stream = jobs.order_stream(spark, folder, "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT", files_per_batch=1)
        jobs.finish(jobs.start_recommendations(stream, rules, out, state))
        return key(jobs.read_batches(spark, out).collect())

    def batch(rows):
        return key(rerank.recommend_visits(rows, rules).collect())

    assert run() == batch(requests.filter("visit_id < 25"))
    requests.filter("visit_id >= 25").write.mode("append").parquet(folder)
    assert run() == batch(requests)
    assert run() == batch(requests)  # nothing new: nothing doubled


def test_a_visit_that_orders_again(spark, rules, tmp_path):
    schema = "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT"
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    orders = [[(1, ["f0"], 18), (2, ["f1"], 19)], [(1, ["f0", "f2"], 18)], [(1, ["f0", "f2", "f3"], 18), (2, ["f1", "f3"], 19)]]
    for rows in orders:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.finish(jobs.start_recommendations(jobs.order_stream(spark, folder, schema), rules, out, state))
    last = spark.createDataFrame(orders[-1], schema)
    assert key(jobs.read_batches(spark, out).collect()) == key(rerank.recommend_visits(last, rules).collect())
    # all of them in one batch
    at_once, state = str(tmp_path / "at_once"), str(tmp_path / "state2")
    jobs.finish(jobs.start_recommendations(jobs.order_stream(spark, folder, schema), rules, at_once, state))
    assert key(jobs.read_batches(spark, at_once).collect()) == key(rerank.recommend_visits(last, rules).collect())


def test_potential(spark, tmp_path):
    names = list(UPSELL_FEATURES)
    seated = spark.createDataFrame([(f"V{i}", i % 6 + 1, 17 + i % 8, i % 2, i % 3 % 2, i % 2) for i in range(50)], ["visit_id", *names])
    model = upsell.LogisticModel(
        upsell.Scaling({c: 1.0 for c in names}, {c: 2.0 for c in names}), {c: 0.3 - 0.1 * i for i, c in enumerate(names)}, -0.2
    )
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    seated.repartition(3).write.parquet(folder)
    schema = "visit_id STRING, " + ", ".join(f"{c} BIGINT" for c in names)
    stream = jobs.order_stream(spark, folder, schema, files_per_batch=1)
    jobs.finish(jobs.start_potential(stream, model, out, str(tmp_path / "state")))
    want = upsell.score(seated, model).withColumn("tier", upsell.potential_tier("prob"))
    columns = ("visit_id", "prob", "pred", "tier")
    assert sorted(tuple(r[c] for c in columns) for r in spark.read.parquet(out).collect()) == sorted(tuple(r[c] for c in columns) for r in want.collect())


LINES = "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT, ts TIMESTAMP"


def at(minutes):
    return datetime(2026, 7, 1, 18) + timedelta(minutes=minutes)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(folder)


def test_open_orders_keep_state_over_batches(spark, rules, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    batches = [
        [(1, ["f0"], 18, at(5)), (2, ["f1"], 18, at(0)), (None, ["f1"], 18, at(1)), (4, None, 18, at(1))],
        [(1, ["f2"], 19, at(50)), (1, ["f2"], 19, at(50)), (2, ["f1"], 18, at(0)), (2, ["f1", "f1"], 18, at(0))],
        # late, but within the bound: the hour is that of the earliest line
        [(1, ["f3"], 17, at(25)), (3, [], 19, at(55))],
    ]

    def tables():
        return len([p for p in os.listdir(shared_folder(spark)) if p.startswith("table-")])

    before = tables()
    for rows in batches:
        feed(spark, folder, rows)
        jobs.finish(jobs.start_open_orders(jobs.order_stream(spark, folder, LINES, files_per_batch=1), rules, out, state))
    assert tables() == before
    whole = spark.createDataFrame([(1, ["f0", "f2", "f3"], 18), (2, ["f1"], 18)], "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT")
    assert key(jobs.read_batches(spark, out).collect()) == key(rerank.recommend_visits(whole, rules).collect())
    # repeated lines change nothing, so nothing is written for visit 2 again
    assert {r["batch"] for r in spark.read.parquet(out).filter("visit_id = 2").collect()} == {0}


def test_open_orders_are_dropped_after_their_time(spark, rules, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def held():
        rows = spark.read.format("statestore").option("path", state).option("stateVarName", "order").load().collect()
        return sorted(r["key"]["visit_id"] for r in rows)

    for rows, kept in [([(1, ["f0"], 18, at(0)), (2, ["f1"], 18, at(200))], [1, 2]), ([(3, ["f1"], 23, at(300))], [2, 3]), ([(1, ["f3"], 23, at(5))], [2, 3])]:
        feed(spark, folder, rows)
        jobs.finish(jobs.start_open_orders(jobs.order_stream(spark, folder, LINES, files_per_batch=1), rules, out, state))
        assert held() == kept  # the last line is later than the bound and is left out


def test_a_batch_is_worked_out_before_it_is_read(spark, rules, tmp_path, monkeypatch):
    orders = spark.range(0, 40, 1, 4).selectExpr("id AS visit_id", "18L AS arrival_hour", "array(concat('f', id % 4)) AS foods")
    held, work = [], rerank.recommend_visits

    def noted(*args):
        held.extend((r.numCachedPartitions(), r.numPartitions()) for r in spark.sparkContext._jsc.sc().getRDDStorageInfo())
        return work(*args)

    monkeypatch.setattr(rerank, "recommend_visits", noted)
    jobs.write_recommendations(orders, rules, str(tmp_path / "out"), 3, jobs.HourFactors())
    assert (4, 4) in held  # two stages that need the state's rows at once would both work them out
    assert key(spark.read.parquet(str(tmp_path / "out")).collect()) == key(work(orders, rules).collect())


def test_times_of_open_orders_do_not_depend_on_the_time_zone(spark, rules, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    feed(spark, folder, [(1, ["f0"], 18, at(5)), (1, ["f1"], 18, at(9))])
    (want,) = spark.read.parquet(folder).selectExpr("unix_millis(min(ts))", "unix_millis(max(ts))").collect()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        jobs.finish(jobs.start_open_orders(jobs.order_stream(spark, folder, LINES), rules, out, state))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    (got,) = spark.read.format("statestore").option("path", state).option("stateVarName", "order").load().selectExpr("value.first_ms", "value.last_ms").collect()
    assert tuple(got) == tuple(want)
