"""Small helpers the operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.session import materialise

# Rows whose texts a Python worker holds at once.
SLICE_ROWS = 500
# Rows one window task sorts at most when ranks are taken within a hot group.
RANK_BUCKET = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """`materialise`, and let go of the shuffle files that led to it.

    Spark removes a finished shuffle's files once the driver has collected the plan that refers to them, which by itself
    may take long. For steps that each shuffle about as much as their input, what is done would fill the disks.
    """
    out = materialise(df)
    del df
    let_go(out.sparkSession)
    return out


def let_go(spark: SparkSession) -> None:
    """Have the driver collect the plans nobody refers to any more, and with them their shuffle files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_written(tables: list[DataFrame]) -> None:
    """Delete the folders of `written` tables that nothing reads any more. The frames can't be used afterwards."""
    for df in tables:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        spark = df.sparkSession
        for folder in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `rows` rows, all of them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def rank_within(df: DataFrame, group: str, uid: str, order: Sequence[str], out: str, bucket: int = RANK_BUCKET) -> DataFrame:
    """Add the 0-based rank of each row in its `group`, without gathering a group in one task.

    `df` must be a written table, `uid` unique per row, and the number of groups bounded by a parameter of the
    caller (the counts per group are broadcast). A group is dealt over buckets of about `bucket` rows by a hash of
    `uid`; rows are ordered by (bucket, `order`, `uid`), and the rows of earlier buckets are added to the rank
    within the bucket.
    """
    counts = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / bucket).cast("long").alias("_buckets"))
    dealt = df.join(F.broadcast(counts), group).withColumn("_bucket", F.pmod(F.xxhash64(uid), "_buckets")).drop("_buckets")
    sums = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    within = W.partitionBy(group, "_bucket").orderBy(*order, uid)
    ranked = dealt.withColumn("_within", F.row_number().over(within)).join(sums, [group, "_bucket"])
    return ranked.withColumn(out, F.col("_before") + F.col("_within") - 1).drop("_bucket", "_within", "_before")
