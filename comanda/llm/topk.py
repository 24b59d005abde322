"""Exact top-k inner products by columnar branch and bound.

Vectors are packed into blocks in vertical layout (one row per dimension). Every block of queries meets every block of
candidates of the same dimension: the stated query set against all rows, in blocks. For a query, inner products are
accumulated a block of dimensions at a time, the dimensions with most mass first. What the remaining dimensions can
still add is at most the product of the remaining norms; candidates that cannot reach the query's k-th best so far are
dropped and the survivors compacted. A first pass over one candidate block gives every query a lower bound of its k-th
score, so that later blocks drop most candidates early and return only rows that can matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from comanda.session import materialise

BLOCK, QUERY_BLOCK = 4096, 2048
# Dimensions accumulated between two bounds.
STEP = 16
# Scaled components are cut to this range, where doubles still hold every integer.
LIMIT = float(1 << 53)

BLOCKS = "dim int, block long, ids binary, uids binary, data binary"


def valid_vectors(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values, starts and lengths of the vectors; length -1 for null ones and those with null or non-finite parts."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    lengths = np.diff(offsets)
    lengths[bad[offsets[1:]] > bad[offsets[:-1]]] = -1
    lengths[lists.is_null().to_numpy(zero_copy_only=False)] = -1
    return values, offsets[:-1], lengths


def blocks(vectors: DataFrame, scale: float, rows: int) -> DataFrame:
    """Blocks of at most `rows` vectors: ids, row numbers, and the scaled components by dimension."""

    def pack(batches):
        for batch in batches:
            values, starts, lengths = valid_vectors(batch.column("vector"))
            ids = np.asarray(batch.column("id").fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            ok = ~batch.column("id").is_null().to_numpy(zero_copy_only=False)
            uids = batch.column("uid").to_numpy()
            out: dict[str, list] = {k: [] for k in ("dim", "block", "ids", "uids", "data")}
            for dim in np.unique(lengths[(lengths >= 0) & ok]):
                at = np.flatnonzero((lengths == dim) & ok)
                for i in range(0, len(at), rows):
                    part = at[i : i + rows]
                    data = np.clip(np.floor(scale * values[starts[part][None, :] + np.arange(dim)[:, None]]), -LIMIT, LIMIT)
                    row = (int(dim), int(uids[part[0]]), ids[part].tobytes(), uids[part].tobytes(), data.astype("<f4" if np.abs(data).max(initial=0) < 1 << 24 else "<f8").tobytes())
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            if out["dim"]:
                yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)})

    return vectors.select("id", "vector", "uid").mapInArrow(pack, BLOCKS)


def unpack(dim: int, ids: bytes, uids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(ids) // 8
    kind = "<f4" if len(data) == 4 * dim * n else "<f8"
    return np.frombuffer(ids, "<i8"), np.frombuffer(uids, "<i8"), np.frombuffer(data, kind).reshape(dim, n).astype(np.float64)


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products with Python integers, cut to the range of a long, for values doubles cannot add exactly."""
    whole = (np.array([[int(x) for x in row] for row in c.T], object).reshape(c.shape[1], c.shape[0]) * [int(x) for x in q]).sum(axis=1)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(x))) for x in whole], np.int64)


def branch_and_bound(q: np.ndarray, c: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best candidates of one query that reach `floor`; ties to smaller ids.

    `c` is vertical (dimension by candidate); candidates of `own` are the query's row and take no part.
    """
    left = np.flatnonzero(own)
    mass = np.abs(q).sum() * np.abs(c).max(initial=0.0)
    if mass >= LIMIT:
        scores = exact_scores(q, c[:, left])
    else:
        order = np.argsort(-np.square(q), kind="stable")
        energy = np.square(c[:, left])
        rest = energy.sum(axis=0)
        q_rest = float(np.square(q).sum())
        total = np.zeros(len(left))
        for i in range(0, len(order), STEP):
            dims = order[i : i + STEP]
            total += q[dims] @ c[np.ix_(dims, left)]
            rest = rest - energy[dims].sum(axis=0)
            q_rest -= float(np.square(q[dims]).sum())
            if i + STEP < len(order) and len(left) > k:
                reach = np.sqrt(max(q_rest, 0.0)) * np.sqrt(np.maximum(rest, 0.0))
                floor = max(floor, float(np.partition(total - reach, len(left) - k)[len(left) - k]))
                alive = total + reach + 1e-6 * (1 + np.abs(total)) >= floor
                if alive.sum() < len(left):
                    left, total, rest, energy = left[alive], total[alive], rest[alive], energy[:, alive]
        scores = np.rint(total).astype(np.int64)
    keep = np.flatnonzero(scores >= floor)
    best = keep[np.lexsort((ids[left[keep]], -scores[keep]))][:k]
    return left[best], scores[best]


def top_k(vectors: DataFrame, queries: str, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), `id_col`, score: the k best other rows of every row for which `queries` (SQL over id) holds.

    Components x become floor(scale * x). Vectors that are null or hold null or non-finite components, and rows with a
    null id, take no part; vectors meet those of equal dimension only. Repeated rows are rows of their own: a copy of
    the query's row is a candidate. Equal scores rank by smaller id. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).withColumn("uid", F.monotonically_increasing_id())
    every = materialise(blocks(rows, scale, BLOCK))
    asked = materialise(blocks(rows.filter(queries), scale, QUERY_BLOCK))

    def first_bounds(batches):
        for batch in batches:
            floors = []
            for r in batch.to_pylist():
                _, uids, q = unpack(r["dim"], r["ids"], r["uids"], r["data"])
                ids, cuids, c = unpack(r["dim"], r["c_ids"], r["c_uids"], r["c_data"])
                low = np.full(len(uids), -np.inf)
                for j in range(len(uids)):
                    _, scores = branch_and_bound(q[:, j], c, cuids != uids[j], ids, k, -np.inf)
                    if len(scores) == k:
                        low[j] = scores[-1]
                floors.append(low.tobytes())
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("dim", "block", "ids", "uids", "data")} | {"floors": pa.array(floors, pa.binary())})

    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qids, uids, q = unpack(r["dim"], r["ids"], r["uids"], r["data"])
                ids, cuids, c = unpack(r["dim"], r["c_ids"], r["c_uids"], r["c_data"])
                floors = np.frombuffer(r["floors"])
                found = [branch_and_bound(q[:, j], c, cuids != uids[j], ids, k, floors[j]) for j in range(len(uids))]
                sizes = [len(s) for _, s in found]
                at = np.concatenate([a for a, _ in found]) if found else np.empty(0, int)
                yield pa.RecordBatch.from_pydict({"query_uid": np.repeat(uids, sizes), "query_id": np.repeat(qids, sizes), "id": ids[at], "uid": cuids[at], "score": np.concatenate([s for _, s in found])})

    candidates = every.select("dim", F.col("block").alias("c_block"), F.col("ids").alias("c_ids"), F.col("uids").alias("c_uids"), F.col("data").alias("c_data"))
    pilot = candidates.groupBy("dim").agg(F.min_by(F.struct("c_ids", "c_uids", "c_data"), "c_block").alias("c")).select("dim", "c.*")
    asked = materialise(asked.join(pilot, "dim").repartition(F.col("block")).mapInArrow(first_bounds, BLOCKS + ", floors binary"))
    # every query block goes to every candidate block of its dimension
    numbers = every.select("dim", F.col("block").alias("c_block"))
    pairs = asked.join(numbers, "dim").join(candidates, ["dim", "c_block"]).repartition(F.col("block"), F.col("c_block"))
    found = pairs.drop("c_block").mapInArrow(search, "query_uid long, query_id long, id long, uid long, score long")
    best = W.partitionBy("query_uid").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
