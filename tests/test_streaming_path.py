"""The state of open orders where only the driver's own sys.path finds the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from datetime import datetime
from comanda.session import build_session
from comanda.streaming import jobs

spark = build_session("path", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false", spark__checkpoint__dir="ck")
lines = "visit_id BIGINT, foods ARRAY<STRING>, arrival_hour BIGINT, ts TIMESTAMP"
rows = [(1, ["f0"], 18, datetime(2026, 7, 1, 18)), (1, ["f1"], 19, datetime(2026, 7, 1, 19))]
spark.createDataFrame(rows, lines).write.parquet("in")
changed = jobs.open_orders(jobs.order_stream(spark, "in", lines))
write = lambda batch, i: batch.write.mode("append").parquet("out")
jobs.finish(changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", "state").trigger(availableNow=True).start())
print([tuple(r) for r in spark.read.parquet("out").select("visit_id", "arrival_hour", "foods").collect()])
spark.stop()
"""


def test_the_package_is_on_the_drivers_path_only(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.strip().splitlines()[-1] == "[(1, 18, ['f0', 'f1'])]"
