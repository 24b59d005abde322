"""Recommendations and drink potential as streaming jobs over files that arrive."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from comanda.operators import rerank, upsell
from comanda.params import HourFactors


def order_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files_per_batch: int = 64) -> DataFrame:
    """Rows of the files arriving in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


# What has arrived, and then the end; {"processingTime": "10 seconds"} keeps a job up.
ONCE = {"availableNow": True}


def start_recommendations(
    requests: DataFrame,
    scored_rules: DataFrame,
    out: str,
    state: str,
    n: int = 3,
    factors: HourFactors = HourFactors(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Recommend drinks for every request (visit_id, arrival_hour, foods) as it arrives.

    A request holds all a table has ordered so far, so the latest one counts; those of a visit that meet in one batch
    are taken together, and `read_batches` reads the newest batch of each visit. Each batch writes its own folder and
    overwrites it when it is run again: a restart neither loses nor doubles a recommendation.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        foods = F.array_distinct(F.flatten(F.collect_list("foods"))).alias("foods")
        write_recommendations(batch.groupBy("visit_id").agg(F.max("arrival_hour").alias("arrival_hour"), foods), scored_rules, f"{out}/batch={batch_id}", n, factors)

    return (
        requests.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", state)
        .trigger(**(trigger or ONCE))
        .start()
    )


def write_recommendations(orders: DataFrame, scored_rules: DataFrame, path: str, n: int, factors: HourFactors) -> None:
    """One batch's recommendations. What is read twice is persisted for the batch; no table is left behind.

    The orders are worked out before anything reads them: of stages that first need them at the same time each would do
    so, and two tasks would write the same state.
    """
    held = [orders.persist()]
    orders.count()

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    try:
        rerank.recommend_visits(orders, scored_rules, n, factors, keep).write.mode("overwrite").parquet(path)
    finally:
        for df in held:
            df.unpersist()


# --- open orders as state --------------------------------------------------------------------------------------------

# How late a line may come, and how long after its last line a table's order is kept.
LATENESS, OPEN_FOR = "30 minutes", 4 * 3600
ORDER_STATE = "foods ARRAY<STRING>, arrival_hour BIGINT, first_ms BIGINT, last_ms BIGINT, version BIGINT"
OPEN_ORDER = "visit_id BIGINT, arrival_hour BIGINT, foods ARRAY<STRING>, version BIGINT"


class OpenOrder(StatefulProcessor):
    """What a table has ordered so far, from lines (visit_id, foods, arrival_hour, ts) in any order and any number of times.

    Dishes are united, and the hour is that of the earliest line, so neither late nor repeated lines change the
    outcome. A changed order is handed on with a version that grows. `open_for` seconds after its latest line, by event
    time, the order's state is dropped.
    """

    def __init__(self, open_for: int = OPEN_FOR) -> None:
        self.open_for = open_for

    def init(self, handle) -> None:
        self.handle = handle
        self.order = handle.getValueState("order", ORDER_STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.order.get() if self.order.exists() else None  # asked for what is not there, Spark writes a line to its log
        foods, hour, first, last, version = (list(known[0]), *known[1:]) if known else ([], None, None, None, 0)
        before = (sorted(foods), hour)
        for line in rows:
            dishes, arrived, ts = line["foods"], line["arrival_hour"], line["ts"]
            ms = int((ts if ts.tzinfo else ts.replace(tzinfo=timezone.utc)).timestamp() * 1000)
            foods = sorted({*foods, *(dishes if dishes is not None else ())})
            if first is None or (ms, arrived) < (first, hour):
                first, hour = ms, int(arrived)
            last = ms if last is None else max(last, ms)
        if (foods, hour) != before:
            version += 1
            yield Row(visit_id=key[0], arrival_hour=hour, foods=foods, version=version)
        if known and (foods, hour, first, last, version) == (list(known[0]), *known[1:]):
            return
        self.order.update((foods, hour, first, last, version))
        if known and known[3] != last:
            self.handle.deleteTimer(known[3] + 1000 * self.open_for)
        if not known or known[3] != last:
            self.handle.registerTimer(last + 1000 * self.open_for)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.order.clear()
        return iter(())

    def close(self) -> None:
        pass


def open_orders(lines: DataFrame, lateness: str = LATENESS, open_for: int = OPEN_FOR) -> DataFrame:
    """visit_id, arrival_hour, foods, version of every order that changed, from a stream of lines with their time `ts`."""
    spark = lines.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = lines.filter("visit_id is not null and ts is not null").withWatermark("ts", lateness)
    # sent whole: the process that prepares the state on the driver's side finds neither what the driver has put on its
    # sys.path nor files added to the session
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        return timed.groupBy("visit_id").transformWithState(OpenOrder(open_for), OPEN_ORDER, "Update", "EventTime")
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def start_open_orders(
    lines: DataFrame, scored_rules: DataFrame, out: str, state: str, n: int = 3, factors: HourFactors = HourFactors(),
    lateness: str = LATENESS, open_for: int = OPEN_FOR, trigger: dict | None = None,
) -> StreamingQuery:
    """Recommend drinks for all a table has ordered so far whenever a line (visit_id, foods, arrival_hour, ts) adds to it.

    Lines may come late, up to `lateness` behind the newest one, and more than once. Each batch writes its own folder
    and overwrites it when it is run again; `read_batches` reads the newest of each visit.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_recommendations(batch.select("visit_id", "arrival_hour", "foods"), scored_rules, f"{out}/batch={batch_id}", n, factors)

    changed = open_orders(lines, lateness, open_for)
    return changed.writeStream.foreachBatch(write_batch).outputMode("update").option("checkpointLocation", state).trigger(**(trigger or ONCE)).start()


def start_potential(
    seated: DataFrame, model: upsell.LogisticModel, out: str, state: str, trigger: dict | None = None
) -> StreamingQuery:
    """Probability and tier for every table as it is seated: a stateless projection of the stream."""
    scored = upsell.score(seated, model).withColumn("tier", upsell.potential_tier("prob"))
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(**(trigger or ONCE))
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait until what has arrived is processed; raises what the job raised."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """The newest recommendations of every visit in the batches written so far."""
    every = spark.read.parquet(out)
    newest = F.max("batch").over(W.partitionBy("visit_id"))  # a few rows per request of a visit
    return every.withColumn("_newest", newest).filter("batch = _newest").drop("batch", "_newest")
