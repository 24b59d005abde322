"""Stupid-backoff language-model scores, worked out as a join of n-gram counts with the documents' n-grams.

Documents are packed into units of about `UNIT_WORDS` words (a written table). A unit asks for the numbers of its distinct
words: they are cut into partitions by hash, a partition holds the words themselves, numbers them by frequency and counts
them over the whole corpus. An n-gram's key is its words' numbers side by side in 128 bits, so different n-grams never
share a key. A unit asks for its distinct n-grams in the same way: a partition answers every unit with the counts in the
order asked. The answers are joined back to the units, scores are summed per document. Keys and counts travel sorted, as
differences and compressed, so an n-gram costs a few bytes instead of a row.

N-grams of two words or more count only from `min_count` occurrences in the corpus on; a rarer one backs off.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import let_go, remove_written, slices, written

ORDER, BACKOFF, MIN_COUNT = 3, 0.4, 2
# Words of a unit, and distinct words and n-grams asked of a partition, about.
UNIT_WORDS, PARTITION_WORDS, PARTITION_KEYS = 1_000_000, 500_000, 2_000_000

MIX1, MIX2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def pack(a: np.ndarray) -> bytes:
    """The array's bytes, first all lowest, then all next ones, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) if len(a) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)).astype(np.uint64))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split()


def distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted different keys of two halves each, and where each key is among them."""
    order = places(np.lexsort((low, high)) if high.any() else np.argsort(low))
    high, low = high[order], low[order]
    first = np.ones(len(order), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.empty_like(order)
    at[order] = np.cumsum(first, dtype=order.dtype) - 1
    return high[first], low[first], at


def places(at: np.ndarray) -> np.ndarray:
    """Positions, or numbers that are not more, in four bytes if those are enough: a worker holds several per n-gram."""
    return at.astype(np.int32) if len(at) < 1 << 31 else at


def grams(words: np.ndarray, place: np.ndarray, order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For 2 to `order` words: positions of last words, and the upper and lower halves of the keys.

    Words' numbers have `bits` bits and are not 0, so keys of different length differ too. `place` is the position within
    the document.
    """
    if bits * order > 128:
        raise ValueError(f"{order} words of {bits} bits don't fit a key")
    out = []
    for n in range(2, order + 1):
        at = np.flatnonzero(place >= n - 1)
        high, low = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for i in range(n - 1, -1, -1):
            high, low = (high << np.uint64(bits)) | (low >> np.uint64(64 - bits)), (low << np.uint64(bits)) | words[at - i]
        out.append((at, high, low))
    return out


def units(docs: DataFrame, size: int) -> DataFrame:
    """unit, docs (ids), lengths, known (distinct words), words (numbers of the known ones), n_words, n_known."""
    schema = "docs array<long>, lengths binary, known binary, words binary, n_words long, n_known long"

    def row(ids: list, lengths: list, held: list, numbers: dict) -> pa.RecordBatch:
        at, known = np.concatenate(held), list(numbers)
        often = np.argsort(-np.bincount(at, minlength=len(known)), kind="stable")  # frequent words get small numbers, which compress well
        rank = np.empty(len(known), np.int64)
        rank[often] = np.arange(len(known))
        values = (ids, np.asarray(lengths, "<i4").tobytes(), pack_words([known[i] for i in often.tolist()]), pack(rank[at].astype("<u4")), len(at), len(known))
        kinds = (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["docs", "lengths", "known", "words", "n_words", "n_known"])

    def gather(batches):
        ids, lengths, held, n, numbers = [], [], [], 0, _Numbers()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                cut = (text or "").encode().split()  # bytes are cut at space and U+0009 to U+000D
                ids.append(doc_id)
                lengths.append(len(cut))
                held.append(np.fromiter(map(numbers.__getitem__, cut), np.int64, len(cut)))
                n += len(cut)
                if n >= size:
                    yield row(ids, lengths, held, numbers)
                    ids, lengths, held, n, numbers = [], [], [], 0, _Numbers()
        if ids:
            yield row(ids, lengths, held, numbers)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(slim.mapInArrow(gather, schema).withColumn("unit", F.monotonically_increasing_id()))


def numbered(packed: DataFrame) -> DataFrame:
    """The units with the corpus's number of each known word (from 1, equal words have equal ones) and its count."""
    parts = max(1, -(-(packed.agg(F.sum("n_known")).first()[0] or 0) // PARTITION_WORDS))

    def dealt(known: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        part = np.fromiter((xxhash.xxh64_intdigest(w) % parts for w in known), np.int64, len(known))
        order = np.argsort(part, kind="stable")
        return order, np.searchsorted(part[order], np.arange(parts + 1))

    def ask(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                known = unpack_words(row["known"])
                n = np.bincount(unpack(row["words"], "<u4"), minlength=len(known))
                order, cuts = dealt(known)
                out = [(p, pack_words([known[i] for i in order[a:b].tolist()]), pack(n[order[a:b]].astype("<u4"))) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                if out:
                    yield pa.RecordBatch.from_pydict(
                        {"unit": pa.array([row["unit"]] * len(out), pa.int64()), "part": pa.array([p for p, _, _ in out], pa.int64()), "known": pa.array([k for _, k, _ in out], pa.binary()), "n": pa.array([c for _, _, c in out], pa.binary())}
                    )

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        part, total = int(group["part"].iloc[0]), Counter()
        for known, n in zip(group["known"], group["n"], strict=True):
            for w, k in zip(unpack_words(known), unpack(n, "<u4").tolist(), strict=True):
                total[w] += k
        number = {w: i * parts + part + 1 for i, w in enumerate(sorted(total, key=lambda w: (-total[w], w)))}
        asked = [unpack_words(k) for k in group["known"]]
        pick = lambda of: [pack(np.fromiter((of[w] for w in words), "<u8", len(words))) for words in asked]
        return pd.DataFrame({"unit": group["unit"], "part": group["part"], "numbers": pick(number), "totals": pick(total), "most": len(number) * parts + part + 1})

    def put(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                order, _ = dealt(unpack_words(row["known"]))
                answers = sorted((a["part"], a["numbers"], a["totals"], a["most"]) for a in row["answers"] or ())
                arrays = {n: pa.array([row[n]], batch.schema.field(n).type) for n in ("unit", "docs", "lengths", "words")}
                for i, name in enumerate(("numbers", "totals"), 1):
                    held = np.zeros(len(order), np.uint64)
                    held[order] = np.concatenate([unpack(a[i], "<u8") for a in answers]) if answers else 0
                    arrays[name] = pa.array([pack(held)], pa.binary())
                arrays["most"] = pa.array([max((a[3] for a in answers), default=0)], pa.int64())
                yield pa.RecordBatch.from_pydict(arrays)

    answers = packed.select("unit", "known", "words").mapInArrow(ask, "unit long, part long, known binary, n binary").groupBy("part")
    answers = answers.applyInPandas(answer, "unit long, part long, numbers binary, totals binary, most long")
    answers = answers.groupBy("unit").agg(F.collect_list(F.struct("part", "numbers", "totals", "most")).alias("answers"))
    return written(packed.join(answers, "unit", "left").mapInArrow(put, "unit long, docs array<long>, lengths binary, words binary, numbers binary, totals binary, most long"))


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, min_count: int = MIN_COUNT, unit: int = UNIT_WORDS) -> DataFrame:
    """doc_id, n_words, n_by_<n> (words scored by n-grams of n words), log_score (sum of the words' log scores) per row.

    Words are runs of characters other than space and U+0009 to U+000D. The first word of a document is scored by its
    own frequency, without a penalty. A null or empty text has no words and the score 0. Repeated rows are scored, and
    counted, each; other columns are ignored. An empty table gives no rows.
    """
    unnumbered = units(docs, unit)
    total = unnumbered.agg(F.sum("n_words")).first()[0] or 0
    packed = numbered(unnumbered)
    remove_written([unnumbered])
    bits = int(packed.agg(F.max("most")).first()[0] or 1).bit_length()
    let_go(docs.sparkSession)  # once more: right after a table is written, Spark's listeners may still hold its plan
    parts = max(1, -(-total * (order - 1) // PARTITION_KEYS))

    def keys_of(row: dict):
        lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        words = unpack(row["words"], "<u4")
        place = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        by_order = grams(unpack(row["numbers"], "<u8")[words], place, order, bits)
        none = np.zeros(0, np.uint64)
        where, high, low = [w for w, _, _ in by_order], np.concatenate([none, *(h for _, h, _ in by_order)]), np.concatenate([none, *(x for _, _, x in by_order)])
        del by_order
        high, low, at = distinct(high, low)
        part = places(((mix(mix(low + GOLD) ^ high) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32))
        dealt = places(np.argsort(part, kind="stable"))
        return where, words, place, lengths, high, low, at, dealt, np.searchsorted(part[dealt], np.arange(parts + 1))

    def ask(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                high, low, at, dealt, cuts = keys_of(row)[4:]
                n = np.bincount(at, minlength=len(low)).astype("<u4")
                del at
                out = [(p, pack_sorted(high[dealt[a:b]]), pack_sorted(low[dealt[a:b]]), pack(n[dealt[a:b]])) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                if out:
                    arrays = {"unit": pa.array([row["unit"]] * len(out), pa.int64()), "part": pa.array([x[0] for x in out], pa.int64())}
                    yield pa.RecordBatch.from_pydict(arrays | {name: pa.array([x[i] for x in out], pa.binary()) for i, name in enumerate(("high", "low", "n"), 1)})

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        low = [unpack_sorted(k) for k in group["low"]]
        ends = np.cumsum([len(k) for k in low])[:-1]
        low = np.concatenate(low)
        at = distinct(np.concatenate([unpack_sorted(k) for k in group["high"]]), low)[2]
        del low
        n = np.bincount(at, np.concatenate([unpack(c, "<u4") for c in group["n"]])).astype(np.int64)
        n[n < min_count] = 0
        return pd.DataFrame({"unit": group["unit"], "part": group["part"], "found": [pack(n[x].astype("<u8")) for x in np.split(at, ends)]})

    def score(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                by_order, words, place, lengths, _, low, at, dealt, _ = keys_of(row)
                answers = sorted((a["part"], a["found"]) for a in row["answers"] or ())
                found = np.zeros(len(low))
                found[dealt] = np.concatenate([unpack(t, "<u8") for _, t in answers]) if answers else 0
                counts, start = [unpack(row["totals"], "<u8")[words].astype(np.float64)], 0
                for where in by_order:
                    c = np.zeros(len(place))
                    c[where] = found[at[start : start + len(where)]]
                    counts.append(c)
                    start += len(where)
                # by single words, each order missed costs a factor
                log = np.log(np.maximum(counts[0], 1) / max(total, 1)) + np.minimum(place, order - 1) * np.log(backoff)
                by = np.ones(len(place), np.int64)
                for n in range(2, order + 1):
                    here = np.flatnonzero(counts[n - 1])
                    missed = np.minimum(place[here], order - 1) - (n - 1)
                    log[here] = np.log(counts[n - 1][here] / counts[n - 2][here - 1]) + missed * np.log(backoff)
                    by[here] = n
                doc = np.repeat(np.arange(len(lengths)), lengths)
                arrays = {"doc_id": pa.array(row["docs"], pa.int64()), "n_words": pa.array(lengths)}
                for n in range(1, order + 1):
                    arrays[f"n_by_{n}"] = pa.array(np.bincount(doc[by == n], minlength=len(lengths)).astype(np.int64))
                arrays["log_score"] = pa.array(np.bincount(doc, log, minlength=len(lengths)))
                yield pa.RecordBatch.from_pydict(arrays)

    answers = packed.mapInArrow(ask, "unit long, part long, high binary, low binary, n binary").groupBy("part").applyInPandas(answer, "unit long, part long, found binary")
    answers = answers.groupBy("unit").agg(F.collect_list(F.struct("part", "found")).alias("answers"))
    by_order = ", ".join(f"n_by_{n} long" for n in range(1, order + 1))
    return packed.join(answers, "unit", "left").mapInArrow(score, f"doc_id long, n_words long, {by_order}, log_score double")
