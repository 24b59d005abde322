"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Every shard owns the cells before each of its virtual nodes. A row's cell is a
hash of its text, so equal texts meet in one cell and stay in one shard unless a full shard cuts the cell. A shard takes
keys up to its bound; keys beyond it continue clockwise to the next shard with room. With `slack` 0 the bounds add up
to the number of rows, so the shards' row counts differ by at most one.

Only counts per cell (a parameter bounds them) reach the driver; rows find their shard by their rank in the cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import rank_within
from comanda.session import materialise

CELLS = 1 << 14
VIRTUAL_NODES = 64

# cell, ranks in the cell from (inclusive) and to (exclusive), shard, slot of the first of them
Interval = tuple[int, int, int, int, int]


def ring_nodes(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. Two nodes never share a cell."""
    if shards * virtual_nodes > cells:
        raise ValueError("more virtual nodes than cells")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(virtual_nodes):
            cell = xxhash.xxh64_intdigest(f"{shard}/{replica}") % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows each shard may take; without slack they add up to `rows`."""
    if slack > 0:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(counts: dict[int, int], shards: int, virtual_nodes: int, cells: int, slack: float) -> list[Interval]:
    """Where the keys of every cell go. Bounded by cells plus virtual nodes, however many rows there are.

    First each cell fills its owner; what a full owner could not take continues clockwise, cell by cell.
    """
    nodes = ring_nodes(shards, virtual_nodes, cells)
    free = bounds(sum(counts.values()), shards, slack)
    used = [0] * shards
    out: list[Interval] = []
    spilled: list[tuple[int, int, int]] = []

    def take(cell: int, start: int, shard: int) -> int:
        n = min(free[shard], counts[cell] - start)
        if n:
            out.append((cell, start, start + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return start + n

    at = 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        done = take(cell, 0, nodes[at % len(nodes)][1])
        if done < counts[cell]:
            spilled.append((cell, done, at % len(nodes)))
    follow = [(i + 1) % len(nodes) for i in range(len(nodes))]
    for cell, done, node in spilled:
        passed = []
        while done < counts[cell]:
            passed.append(node)
            node = follow[node]
            done = take(cell, done, nodes[node][1])
        for p in passed:  # all of these shards are full now
            follow[p] = node if p != node else follow[p]
    return out


def assign_shards(
    docs: DataFrame,
    shards: int,
    text: str = "text",
    order: Sequence[str] = ("doc_id",),
    virtual_nodes: int = VIRTUAL_NODES,
    cells: int = CELLS,
    slack: float = 0.0,
) -> DataFrame:
    """`order` columns, size, text_crc32, shard and slot of every row of `docs`; slots are gapless from 0 per shard.

    A null text counts as empty (size 16). Repeated rows are separate rows. An empty table gives no rows; other
    columns of `docs` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        *[F.col(c).alias(f"key_{i}") for i, c in enumerate(order)],
        (F.octet_length(whole) + 16).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("point"),
    )
    slim = materialise(
        slim.withColumn("cell", F.pmod("point", F.lit(cells)).cast("int")).withColumn("uid", F.monotonically_increasing_id())
    )
    counts = {r["cell"]: r["count"] for r in slim.groupBy("cell").count().collect()}
    plan = place(counts, shards, virtual_nodes, cells, slack)
    intervals = spark.createDataFrame(plan, "cell int, first long, past long, shard int, slot_from long")
    keys = [f"key_{i}" for i in range(len(order))]
    ranked = rank_within(slim, "cell", "uid", ["point", *keys], "rank")
    placed = ranked.join(F.broadcast(intervals), "cell").filter("rank >= first and rank < past")
    return placed.select(
        *[F.col(k).alias(c) for k, c in zip(keys, order, strict=True)],
        "size",
        "text_crc32",
        "shard",
        (F.col("slot_from") + F.col("rank") - F.col("first")).alias("slot"),
    )
