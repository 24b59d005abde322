"""Exact repeats between documents by fixed-block anchors.

A repeat is a window of `WINDOW` consecutive words that also starts in a document with a smaller id. Every document is cut
into non-overlapping blocks of `BLOCK` words; a window of 50 words holds at least `RUN` (five) whole blocks in a row. Every
rolling window of `BLOCK` words is a probe. Of five blocks in a row the one of smallest hash is the anchor, and a
rolling window that is smallest of no five in a row, a block apart, can't meet one; so only anchors are indexed and only
possible anchors are sent, and no repeat is lost.

The index holds each anchor once, with its smallest document id, so the join with the probes makes at most one row per
probe whatever the number of copies. Hits are then extended: around each hit anchor and each hitting probe all windows of
50 words that hold it are looked up by a 128-bit hash, again with one row per different window. What overlaps joins to
the maximal repeat. No pair of documents is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import remove_written, slices, written

WINDOW, BLOCK = 50, 8
# Whole blocks that every window holds, wherever it starts.
RUN = (WINDOW - BLOCK + 1) // BLOCK
# Rows sent to the JVM at once, and texts a worker reads at once.
SEND_ROWS, TEXTS = 50_000, 200

FACTORS = np.random.default_rng(13).integers(1 << 62, size=(2, WINDOW), dtype=np.uint64) * np.uint64(4) + np.uint64(1)


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, as UTF-8; a null text has none."""
    return (text or "").encode().split()


class Numbers:
    """Words to their 64-bit hashes. A table of known words' hashes would miss the processor's caches and take longer."""

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def rolling(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every window of `size` words: a sum of products with fixed odd factors, mixed at the end."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = hashes ^ (hashes >> np.uint64(31)) if seed else hashes
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += h[k : k + n] * FACTORS[seed, k]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(29))


def anchors(hashes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Where a rolling hash is at most those of some `RUN` in a row, `BLOCK` apart, that it belongs to.

    `at` (places BLOCK apart) restricts the rows to the document's own blocks.
    """
    h, step = (hashes, BLOCK) if at is None else (hashes[at], 1)
    n = len(h) - (RUN - 1) * step
    if n <= 0:
        return np.zeros(0, np.int64)
    least = h[:n].copy()
    for k in range(1, RUN):
        np.minimum(least, h[k * step : k * step + n], out=least)
    chosen = np.zeros(len(h), bool)
    for k in range(RUN):
        part = h[k * step : k * step + n]
        chosen[k * step : k * step + n] |= part == least
    found = np.flatnonzero(chosen)
    return found if at is None else at[found]


def key(text: str = "text") -> Column:
    """Tells rows of the same id with different texts apart."""
    return F.xxhash64(F.col(text), F.length(text))


def _sent(columns: dict[str, list[np.ndarray]], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(columns[n]) if columns[n] else [], t) for n, t in types.items()], list(types))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _batches(texts: Iterator[tuple], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows of arrays by column, one tuple per text, in batches of about `SEND_ROWS` rows."""
    out: dict[str, list] = {n: [] for n in types}
    rows = 0
    for arrays in texts:
        for n, x in zip(types, arrays, strict=True):
            out[n].append(x)
        rows += len(arrays[0])
        if rows >= SEND_ROWS:
            yield _sent(out, types)
            out, rows = {n: [] for n in types}, 0
    yield _sent(out, types)


def anchor_rows(docs: DataFrame, own: bool) -> DataFrame:
    """h, doc_id, at: a text's own anchors (`own`), or its rolling windows that can be an anchor elsewhere."""
    types = {"h": pa.int64(), "doc_id": pa.int64(), "at": pa.int32()}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()

        def each(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words(text)
                if len(found) >= WINDOW:
                    h = rolling(numbers.of(found), BLOCK)
                    at = anchors(h, np.arange(0, len(h), BLOCK)) if own else anchors(h)
                    yield _signed(h[at]), np.full(len(at), doc, np.int64), at.astype(np.int32)

        for batch in slices(batches, TEXTS):
            yield from _batches(each(batch), types)

    asked = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return asked.mapInArrow(emit, "h long, doc_id long, at int")


def marked(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """doc_id, hits, blocks, and the written tables behind them: the probes of an id's texts that meet an anchor of a smaller id, and its own anchors met.

    The index has one row per anchor; a hot anchor's probes are rows of one skewed join key. The indexes are written
    first, so that both sides of a join are plain shuffles, which AQE can split.
    """
    own = written(anchor_rows(docs, own=True))
    index = written(own.groupBy("h").agg(F.min("doc_id").alias("first")))
    hits = written(anchor_rows(docs, own=False).join(index, "h").filter("first < doc_id").select("h", "doc_id", "at"))
    met = written(hits.groupBy("h").agg(F.max("doc_id").alias("last")))
    blocks = own.join(met, "h").filter("doc_id < last").select("doc_id", "at", F.lit(True).alias("is_block"))
    both = hits.select("doc_id", "at", F.lit(False).alias("is_block")).unionByName(blocks)
    # an id's marks are bounded by its words
    marks = both.groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("is_block"), F.col("at"))).alias("hits"), F.collect_set(F.when(F.col("is_block"), F.col("at"))).alias("blocks")
    )
    return marks, [own, index, hits, met]


def around(at: list[int], windows: int) -> np.ndarray:
    """Starts of the windows of `WINDOW` words that hold the block of `BLOCK` words at one of `at`, of those within the text."""
    held = np.zeros(windows + 1, np.int32)
    a = np.array(at, np.int64)
    a = a[a < windows + WINDOW - BLOCK]
    np.add.at(held, np.maximum(a - (WINDOW - BLOCK), 0), 1)
    np.add.at(held, np.minimum(a + 1, windows), -1)
    return np.flatnonzero(np.cumsum(held[:-1]) > 0)


def windows(texts: DataFrame, marks: str) -> DataFrame:
    """h1, h2, doc_id, doc_key, at: every window around the marks of the marked texts."""
    types = {"h1": pa.int64(), "h2": pa.int64(), "doc_id": pa.int64(), "doc_key": pa.int64(), "at": pa.int32()}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()

        def each(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc, doc_key, text, places in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "doc_key", "text", marks)), strict=True):
                found = words(text) if places else []
                if len(found) >= WINDOW:
                    h = numbers.of(found)
                    at = around(places, len(h) - WINDOW + 1)
                    h1, h2 = (rolling(h, WINDOW, seed)[at] for seed in (0, 1))
                    yield _signed(h1), _signed(h2), np.full(len(at), doc, np.int64), np.full(len(at), doc_key, np.int64), at.astype(np.int32)

        for batch in slices(batches, TEXTS):
            yield from _batches(each(batch), types)

    return texts.select("doc_id", "doc_key", "text", marks).mapInArrow(emit, "h1 long, h2 long, doc_id long, doc_key long, at int")


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key, text and spans of every row with a repeat: its maximal repeats as (start, end) in words, in order."""
    base = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    base = base.select(F.col("doc_id").cast("long").alias("doc_id"), key().alias("doc_key"), "text")
    marks, behind = marked(docs)
    texts = written(base.join(marks, "doc_id"))
    del marks
    remove_written(behind)
    index = written(windows(texts, "blocks").groupBy("h1", "h2").agg(F.min("doc_id").alias("first")))
    again = windows(texts, "hits").join(index, ["h1", "h2"]).filter("first < doc_id")
    starts = again.groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("at")).alias("at"))
    # windows that touch or overlap make one span
    new = f"filter(at, (x, i) -> i = 0 or x - at[i - 1] > {WINDOW})"
    last = f"filter(at, (x, i) -> i = size(at) - 1 or at[i + 1] - x > {WINDOW})"
    spans = starts.withColumn("spans", F.expr(f"zip_with({new}, {last}, (a, b) -> struct(a as start, b + {WINDOW} as end))")).drop("at")
    return texts.select("doc_id", "doc_key", "text").join(written(spans), ["doc_id", "doc_key"])


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, without the words of its repeats.

    A null text has no words. Rows with equal ids don't repeat one another; a row without an id neither loses words nor
    counts as an earlier one. Repeated rows are reported each; other columns are ignored. An empty table gives no rows.
    """

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS):
            found = [words(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "doc_key": batch.column("doc_key"), "n_words": pa.array(map(len, found), pa.int64()), "whole": pa.array(map(_digest, found), pa.string())}
            )

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS):
            removed, digests = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                found = words(text)
                kept, at = [], 0
                for s in spans:
                    kept += found[at : s["start"]]
                    at = s["end"]
                kept += found[at:]
                removed.append(len(found) - len(kept))
                digests.append(_digest(kept))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "doc_key": batch.column("doc_key"), "n_removed": pa.array(removed, pa.int64()), "cut": pa.array(digests, pa.string())}
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key().alias("doc_key"), "text")
    rows = rows.mapInArrow(plain, "doc_id long, doc_key long, n_words long, whole string")
    cut = repeats(docs).mapInArrow(left, "doc_id long, doc_key long, n_removed long, cut string").dropDuplicates(["doc_id", "doc_key"])
    out = rows.join(cut, ["doc_id", "doc_key"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("cut", "whole").alias("kept_sha256"))
