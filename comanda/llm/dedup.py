"""Near-duplicates by improved consistent weighted sampling over TF-IDF word shingles.

Shingles are five lower-case words; a shingle that occurs n times stands for n elements, so set operations on elements
are those on term frequencies. An element weighs by the inverse document frequency of its shingle: on the scale of the
logarithm from 1 for a shingle of one text to `LEAST_WEIGHT` for one of all texts. Frequencies are exact counts over all
leading texts: copies and likely near copies of a text with a smaller node don't count, as they would make just the
shingles that near-duplicates share weigh less. A text leads that is the smallest in each bucket of its plain samples.
Texts get a signature of consistent weighted samples; texts that agree in a band of them share a bucket.

Shingles are counted in packed units: a unit of texts asks for its distinct shingles, cut into partitions by hash; a
partition answers every unit with those that two or more texts have. The answers are joined back to the units.

Texts of a bucket whose signatures agree often enough are likely pairs. Likely pairs join texts into zones: in every
bucket all are compared with the smallest first, and only in buckets that still hold several zones all with all, in
blocks of bounded size. Within a zone, the exact weighted Jaccard similarity of all pairs is worked out as a product of
incidence matrices, again in blocks; the pairs that reach the threshold make the classes. Every step hands on at most
one link per text and block, however large a group of copies is, and no pair of a zone is left out.

Equal texts are one node from the start. No links, components or fingerprints reach the driver.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import let_go, remove_written, slices, written
from comanda.llm.ngram import pack, pack_sorted, unpack, unpack_sorted
from comanda.session import materialise

WORDS, THRESHOLD = 5, 0.8
# 12 bands of 3 samples find a pair of similarity 0.8 with probability 0.9998.
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
# Equal samples a likely pair has at least: a pair of similarity 0.8 has fewer once in 5,000.
LIKELY = 20
LEAST_WEIGHT = 0.5
# Shingles and texts of a unit at most (a text is never cut), and shingles asked of a partition, about.
UNIT_ELEMENTS, UNIT_TEXTS, PARTITION_KEYS = 500_000, 50_000, 2_000_000
# Members of a bucket compared in one task.
BLOCK_MEMBERS = 1000
# Elements of a zone held by one block, and columns of an incidence matrix held at once.
BLOCK_ELEMENTS, COLUMNS = 400_000, 2048

MIX1, MIX2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


# Characters besides U+0009 to U+000D, U+001C to U+0020 at which words are cut; random numbers for bytes; powers, and their inverses.
OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd number and of its inverse."""
    if not POWERS or len(POWERS[0]) <= n:
        size = max(1 << 16, 2 * n)
        base = [MIX1, np.uint64(pow(int(MIX1), -1, 1 << 64))]
        POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b)]), dtype=np.uint64) for b in base]
    return POWERS[0], POWERS[1]


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-case words of the whole text: of each, the polynomial of its UTF-8 bytes, mixed."""
    low = (text or "").lower()
    data = np.frombuffer((low if low.isascii() else OTHER_SPACE.sub(" ", low)).encode() + b" ", np.uint8)
    gap = SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edge = edge if gap[0] else np.concatenate([[0], edge])
    if not len(edge):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * power[: len(data)], out=total[1:])
    start, end = edge[::2], edge[1::2]
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


_FACTORS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * GOLD) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the shingles of the whole text; fewer than five words are one shingle, none are none."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, min(len(h), WORDS), np.uint64)
    for i in range(min(WORDS, len(h))):
        out += h[i : i + n] * _FACTORS[i]
    return mix(out)


def weight(n: np.ndarray, texts: int) -> np.ndarray:
    """Weights of shingles that are in `n` of all `texts` leading texts."""
    return 1 - (1 - LEAST_WEIGHT) * np.log(n) / np.log(max(texts, 2))


def elements(s: np.ndarray, times: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted elements and their weights, of sorted different shingles with how often each occurs and its weight."""
    if len(s) and times.max() > 1:
        first = np.repeat(np.cumsum(times) - times, times)
        turn = (np.arange(times.sum()) - first).astype(np.uint64)
        s, w = np.repeat(s, times), np.repeat(w, times)
        s = np.where(turn > 0, mix(s + turn * GOLD), s)
        order = np.argsort(s)
        s, w = s[order], w[order]
    return s, w


DRAWS = 20
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Draws of the variates r, log c and beta, sorted by the value they give a weight of 1, that value, and a factor per sample."""
    if not _TABLES:
        rng = np.random.default_rng(20)
        r, c = (rng.gamma(2.0, 1.0, 1 << DRAWS).astype(np.float32) for _ in range(2))
        c, beta = np.log(c), rng.random(1 << DRAWS).astype(np.float32)
        value = c - r * (1 - beta.astype(np.float64))
        order = np.argsort(value)
        _TABLES.extend([r[order], c[order], beta[order], value[order], mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * GOLD) | np.uint64(1)])
    return _TABLES


def signature(s: np.ndarray, w: np.ndarray, chunk: int = 2048) -> bytes:
    """Consistent weighted samples: of each, 32 bits that name the element and its quantised weight.

    The value of an element (weights are at most 1) is never less than with a weight of 1, which is known from its draw
    alone. So only elements whose draw is below a limit are valued; the limit is one that the least value exceeds once in
    ten million samples, and then that sample is taken over all elements.
    """
    if not len(s):
        return b""
    r_table, c_table, beta_table, values, factors = _tables()
    log_w = np.log(w)
    name = np.zeros(SAMPLES, np.uint64)

    def sample(which: np.ndarray, limit: int) -> np.ndarray:
        """Put the names of these samples; those whose least value isn't certain are returned."""
        found = []
        for i in range(0, len(s), chunk):
            h = s[i : i + chunk] * factors[which, None]
            below = np.flatnonzero(h < np.uint64(limit << (64 - DRAWS)) if limit < 1 << DRAWS else np.ones(h.shape, bool))
            k = below // h.shape[1]
            found.append((k, below - k * h.shape[1] + i, h.ravel()[below] >> np.uint64(64 - DRAWS)))
        k, at, draw = found[0] if len(found) == 1 else (np.concatenate(x) for x in zip(*found, strict=True))
        r, beta, lw = r_table[draw], beta_table[draw], log_w[at]
        t = np.floor(lw / r + beta)
        value = c_table[draw] - r * (t - beta + 1)
        least = np.full(len(which), values[limit] if limit < 1 << DRAWS else np.inf)
        np.minimum.at(least, k, value)
        best = np.flatnonzero(value == least[k])[::-1]  # of equal values the first element's stays
        name[which[k[best]]] = mix(s[at[best]] + t[best].astype(np.int64).astype(np.uint64) * GOLD)
        return np.delete(which, k[best])

    left = sample(np.arange(SAMPLES), min(int(np.searchsorted(values, np.log(16 / w.sum()))), 1 << DRAWS))
    if len(left):
        sample(left, 1 << DRAWS)
    return (name >> np.uint64(32)).astype("<u4").tobytes()


def plain_samples(s: np.ndarray, chunk: int = 2048) -> bytes:
    """As `signature`, of different shingles that all weigh 1: then each sample is the shingle of the least draw."""
    if not len(s):
        return b""
    factors = _tables()[-1]
    least = [(s[i : i + chunk] * factors[:, None]).min(axis=1) for i in range(0, len(s), chunk)]
    return (np.min(least, axis=0) >> np.uint64(32)).astype("<u4").tobytes()


def similarities(left: list[np.ndarray], right: list[np.ndarray], weights: list[np.ndarray], weights_right: list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard similarity of every left with every right array of elements."""
    sizes = [len(x) for x in (*left, *right)]
    every, at, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    w = np.concatenate([*weights, *weights_right])
    row = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(row, w, len(sizes))
    shared = count[at] > 1
    column = (np.cumsum(count > 1) - 1)[at[shared]]
    row, w = row[shared], w[shared]
    kind = np.float32 if (w == 1).all() else np.float64
    order = np.argsort(column, kind="stable")
    row, column, w = row[order], column[order], np.sqrt(w[order])
    both = np.zeros((len(left), len(right)), kind)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, (low, low + COLUMNS))
        x = np.zeros((len(sizes), COLUMNS), kind)
        x[row[i:j], column[i:j] - low] = w[i:j]
        both += x[: len(left)] @ x[len(left) :].T
    union = total[: len(left), None] + total[None, len(left) :] - both
    return both / np.maximum(union, 1e-300)


class Forest:
    """Union-find over any keys; `join` tells whether the two were apart."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def text_keys(text: Column) -> list[Column]:
    """128 bits that name a text; null is a text of its own only if empty texts are (both count as empty)."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole, F.octet_length(whole)).alias("k2")]


def _units(docs: DataFrame, leaders: DataFrame) -> DataFrame:
    """unit, k1, k2 (keys of its texts), lengths, s (sorted different shingles of one text after the other), times, leads, n_leaders, n_shingles.

    A text of several rows is taken once.
    """
    most, most_texts = UNIT_ELEMENTS, UNIT_TEXTS

    def row(keys: list, held: list) -> pa.RecordBatch:
        s, times = np.concatenate([s for s, _ in held]), np.concatenate([n for _, n in held])
        k1, k2, leads = (np.array(x, kind) for x, kind in zip(zip(*keys, strict=True), ("<i8", "<i8", bool), strict=True))
        lengths = np.array([len(s) for s, _ in held], "<i4")
        binary = [x.tobytes() for x in (k1, k2, lengths)] + [pack_sorted(s), pack(times.astype("<u4")), leads.tobytes()]  # s ascends within a text, where one ends differences wrap
        arrays = [pa.array([x], pa.binary()) for x in binary] + [pa.array([int(leads.sum())], pa.int64()), pa.array([len(s)], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "lengths", "s", "times", "leads", "n_leaders", "n_shingles"])

    def gather(batches):
        keys, held, size = [], [], 0
        for batch in slices(batches):
            for *key, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "leads", "text")), strict=True):
                got = np.unique(shingles(text), return_counts=True)
                if held and (size + len(got[0]) > most or len(held) >= most_texts):
                    yield row(keys, held)
                    keys, held, size = [], [], 0
                keys.append(key)
                held.append(got)
                size += len(got[0])
        if held:
            yield row(keys, held)

    once = docs.select(*text_keys(F.col("text")), "text").groupBy("k1", "k2").agg(F.any_value("text").alias("text"))
    marked = once.join(leaders.select("k1", "k2", F.lit(True).alias("leads")), ["k1", "k2"], "left").select("k1", "k2", F.coalesce("leads", F.lit(False)).alias("leads"), "text")
    packed = marked.mapInArrow(gather, "k1 binary, k2 binary, lengths binary, s binary, times binary, leads binary, n_leaders long, n_shingles long")
    return written(packed.withColumn("unit", F.monotonically_increasing_id()))


def _shared(units: DataFrame, total: int) -> DataFrame:
    """unit, answers (part, s, n): the unit's shingles that are in n leading texts, two or more, of all units."""
    parts = max(1, -(-total // PARTITION_KEYS))

    def ask(batches):
        for batch in slices(batches, 1):
            for unit, s, lengths, leads in zip(*(batch.column(c).to_pylist() for c in ("unit", "s", "lengths", "leads")), strict=True):
                s, counts = unpack_sorted(s), np.repeat(np.frombuffer(leads, bool), np.frombuffer(lengths, "<i4"))
                order = np.argsort(s)
                s, counts = s[order], counts[order]
                first = np.flatnonzero(np.diff(s, prepend=~s[:1]))
                s, n = s[first], np.add.reduceat(counts, first, dtype=np.int64) if len(s) else counts
                part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending as s is
                cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()
                out = [(p, pack_sorted(s[a:b]), pack(n[a:b].astype("<u4"))) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                if out:
                    yield pa.RecordBatch.from_pydict(
                        {"unit": pa.array([unit] * len(out), pa.int64()), "part": pa.array([p for p, _, _ in out], pa.int64()), "s": pa.array([s for _, s, _ in out], pa.binary()), "n": pa.array([n for _, _, n in out], pa.binary())}
                    )

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        asked = [unpack_sorted(s) for s in group["s"]]
        n = [unpack(x, "<u4") for x in group["n"]]
        every = np.sort(np.concatenate(asked))
        several = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *(s[k > 1] for s, k in zip(asked, n, strict=True))]))
        del every  # `several` may hold shingles that one leader has only, and those drop out below
        total, hits = np.zeros(len(several), np.int64), []
        for s, k in zip(asked, n, strict=True):
            at = np.searchsorted(several, s)
            here = np.flatnonzero(several[np.minimum(at, len(several) - 1)] == s) if len(several) else np.zeros(0, np.int64)
            hits.append(at[here])
            total[hits[-1]] += k[here]
        hits = [x[total[x] > 1] for x in hits]
        return pd.DataFrame({"unit": group["unit"], "part": group["part"], "s": [pack_sorted(several[x]) if len(x) else b"" for x in hits], "n": [pack(total[x].astype("<u4")) for x in hits]})

    answers = units.select("unit", "s", "lengths", "leads").mapInArrow(ask, "unit long, part long, s binary, n binary").groupBy("part")
    answers = answers.applyInPandas(answer, "unit long, part long, s binary, n binary").filter(F.octet_length("s") > 0)
    return written(answers.groupBy("unit").agg(F.collect_list(F.struct("part", "s", "n")).alias("answers")))


def _leaders(texts: DataFrame) -> DataFrame:
    """The texts (k1, k2, node, plain) that are the smallest in each of their buckets."""
    members = _members(texts, "plain")
    least = members.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    led = members.join(least, "bucket").filter("node > least").select("node").distinct()
    return texts.join(led, "node", "left_anti")


def sketched(docs: DataFrame, leaders: DataFrame) -> tuple[DataFrame, int]:
    """k1, k2, sig, often of every different text, and the number of leading texts.

    `often` holds the places, among the text's sorted different shingles, of those in two or more leading texts, then the
    number of these of each.
    """
    units = _units(docs, leaders)
    sums = units.agg(F.sum("n_leaders"), F.sum("n_shingles")).first()
    of, total = sums[0] or 0, sums[1] or 0
    let_go(docs.sparkSession)  # once more, and below: right after a table is written, Spark's listeners may still hold its plan
    answers = _shared(units, total)
    answers.count()
    let_go(docs.sparkSession)

    def sketch(batches):
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                k1, k2 = (np.frombuffer(row[c], "<i8") for c in ("k1", "k2"))
                s, times = unpack_sorted(row["s"]), unpack(row["times"], "<u4").astype(np.int64)
                ends = np.cumsum(np.frombuffer(row["lengths"], "<i4").astype(np.int64)).tolist()
                got = sorted(((a["part"], a["s"], a["n"]) for a in row["answers"] or ()), key=lambda a: a[0])
                several = np.concatenate([np.zeros(0, np.uint64), *(unpack_sorted(a[1]) for a in got)])
                n = np.concatenate([np.zeros(0, "<u4"), *(unpack(a[2], "<u4") for a in got)])
                count = np.ones(len(s), "<u4")
                if len(several):
                    at = np.minimum(np.searchsorted(several, s), len(several) - 1)
                    count = np.where(several[at] == s, n[at], count)
                w = weight(count, of)
                sig, often = [], []
                for a, b in zip([0, *ends], ends, strict=False):
                    sig.append(signature(*elements(s[a:b], times[a:b], w[a:b])))
                    places = np.flatnonzero(count[a:b] > 1)
                    often.append(places.astype("<u4").tobytes() + count[a:b][places].tobytes())
                yield pa.RecordBatch.from_pydict({"k1": pa.array(k1), "k2": pa.array(k2), "sig": pa.array(sig, pa.binary()), "often": pa.array(often, pa.binary())})

    out = written(units.join(answers, "unit", "left").mapInArrow(sketch, "k1 long, k2 long, sig binary, often binary"))
    remove_written([units, answers])
    out.count()
    let_go(docs.sparkSession)
    return out, of


def _members(texts: DataFrame, sig: str) -> DataFrame:
    """node, bucket: one row per band of the samples in the column `sig`."""
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring(sig, 4 * ROWS * b + 1, 4 * ROWS)) for b in range(BANDS)])
    return texts.filter(F.octet_length(sig) > 0).select("node", F.explode(bands).alias("bucket"))


def _connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the links (a, b); by large and small stars."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select("e.u", F.col("e.m").alias("v"))
        edges = materialise(small.filter("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state


def _matches(a: str, b: str) -> Column:
    """Number of equal samples of two signatures."""
    return F.expr(" + ".join(f"int(substring({a}, {4 * i + 1}, 4) = substring({b}, {4 * i + 1}, 4))" for i in range(SAMPLES)))


def _dealt(members: DataFrame, group: str, blocks: Column, per_bin: int) -> DataFrame:
    """`members` with the block `own` and the pairs of blocks (p, q) they take part in, and the task `bin` of each.

    Groups of one block share bins of about `per_bin` rows; of others every pair of blocks is a bin of its own.
    """
    bins = max(1, members.count() // per_bin)
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    single = F.pmod(F.xxhash64(group), F.lit(bins))
    return dealt.withColumn("bin", F.when(F.col("blocks") == 1, single).otherwise(F.xxhash64(group, "p", "q"))).drop("blocks", "other")


def _likely(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """Links between the zones of each bucket: pairs with at least `LIKELY` equal samples, as many as join the zones."""

    def across(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby(["bucket", "p", "q"], sort=False):
            p, q = part["p"].iloc[0], part["q"].iloc[0]
            sig = np.frombuffer(b"".join(part["sig"]), "<u4").reshape(len(part), SAMPLES)
            node, zone, own = (part[c].to_numpy() for c in ("node", "zone", "own"))
            left, right, joined = np.flatnonzero(own == p), np.flatnonzero(own == q), Forest()
            for i in left:
                to = right[zone[right] != zone[i]]
                to = to[(sig[to] == sig[i]).sum(axis=1) >= LIKELY]
                out += [(node[i], node[j]) for j in to if joined.join(zone[i], zone[j])]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    blocks = F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int")
    dealt = _dealt(members, "bucket", blocks, 2 * BLOCK_MEMBERS).join(signatures, "node")
    return dealt.select("bin", "bucket", "p", "q", "own", "node", "zone", "sig").groupBy("bin").applyInPandas(across, "a long, b long")


def _links(zones: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """Links of pairs of a zone whose weighted Jaccard similarity is at least `threshold`, as many as join the classes."""

    def verified(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby(["zone", "p", "q"], sort=False):
            p, q = part["p"].iloc[0], part["q"].iloc[0]
            node, own = part["node"].to_numpy(), part["own"].to_numpy()
            s = [np.frombuffer(x, np.uint64) for x in part["s"]]
            w = [np.frombuffer(x, float) if x else np.ones(len(y)) for x, y in zip(part["w"], s, strict=True)]
            left, right, joined = np.flatnonzero(own == p), np.flatnonzero(own == q), Forest()
            if not len(left) or not len(right):
                continue
            alike = similarities([s[i] for i in left], [s[i] for i in right], [w[i] for i in left], [w[i] for i in right]) >= threshold - 1e-12
            out += [(node[left[i]], node[right[j]]) for i, j in np.argwhere(alike) if node[left[i]] != node[right[j]] and joined.join(node[left[i]], node[right[j]])]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    sized = zones.join(held.select("node", (F.octet_length("s") / 8).alias("n")), "node")
    totals = sized.groupBy("zone").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_ELEMENTS), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS)).cast("int").alias("of_zone"))
    # bins of about as many elements as a block has
    mean = sized.agg(F.avg("n")).first()[0] or 1.0
    dealt = _dealt(materialise(zones.join(totals, "zone")), "zone", F.col("of_zone"), max(1, int(BLOCK_ELEMENTS / mean)))
    return dealt.join(held, "node").select("bin", "zone", "p", "q", "own", "node", "s", "w").groupBy("bin").applyInPandas(verified, "a long, b long")


def _elements_of(docs: DataFrame, texts: DataFrame, nodes: DataFrame, of: int) -> DataFrame:
    """node, elements and their weights (empty: all 1) of the given nodes; `of` is the number of leading texts."""
    wanted = nodes.join(texts.select("node", "k1", "k2", "rep_doc", "often"), "node")
    # by the representative's id too, so that copies of a text don't meet in one task
    keyed = docs.select(F.col("doc_id").alias("rep_doc"), "text", *text_keys(F.col("text")))
    same = F.expr("d.rep_doc <=> w.rep_doc and d.k1 = w.k1 and d.k2 = w.k2")
    chosen = keyed.alias("d").join(wanted.alias("w"), same).select("w.node", "d.text", "w.often")

    def weighted(text: str | None, often: bytes) -> tuple[np.ndarray, np.ndarray]:
        s, times = np.unique(shingles(text), return_counts=True)
        places, n = np.frombuffer(often, "<u4").reshape(2, -1)
        w = np.ones(len(s))
        w[places] = weight(n, of)
        return elements(s, times, w)

    def arrays(batches):
        for batch in slices(batches):
            got = [weighted(t, o) for t, o in zip(batch.column("text").to_pylist(), batch.column("often").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "s": pa.array([s.tobytes() for s, _ in got], pa.binary()), "w": pa.array([b"" if (w == 1).all() else w.tobytes() for _, w in got], pa.binary())})

    return chosen.mapInArrow(arrays, "node long, s binary, w binary").groupBy("node").agg(F.any_value("s").alias("s"), F.any_value("w").alias("w"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row's doc_id, text keys, class_id (smallest doc_id of its class), kept, copies.

    `kept` marks one row of every class; `copies` counts the rows with the same id and text. Null texts count as empty;
    all empty texts are one class. Repeated rows are rows of one class. An empty table gives no rows. Other columns are
    ignored.
    """
    slim = docs.select("doc_id", "text", *text_keys(F.col("text")))

    def sampled(batches):
        for batch in slices(batches):
            got = [plain_samples(shingles(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("doc_id", "k1", "k2")} | {"plain": pa.array(got, pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = materialise(slim.mapInArrow(sampled, f"doc_id {kind}, k1 long, k2 long, plain binary").withColumn("uid", F.monotonically_increasing_id()))
    texts = rows.groupBy("k1", "k2").agg(F.min(F.struct("uid", "doc_id")).alias("rep"), F.any_value("plain").alias("plain"))
    texts = materialise(texts.select("k1", "k2", F.col("rep.uid").alias("node"), F.col("rep.doc_id").alias("rep_doc"), "plain"))
    sketches, of = sketched(docs, _leaders(texts))
    texts = materialise(texts.drop("plain").join(sketches, ["k1", "k2"]))
    signatures = texts.select("node", "sig")

    members = _members(texts, "sig")
    buckets = members.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = materialise(members.join(buckets, "bucket"))
    pairs = members.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(signatures.toDF("a", "sig_a"), "a").join(signatures.toDF("b", "sig_b"), "b")
    likely = materialise(pairs.filter(_matches("sig_a", "sig_b") >= LIKELY).select("a", "b"))
    zones = materialise(_connected(likely))

    # a bucket of two has had its only pair compared
    placed = members.filter("size > 2").join(zones, "node", "left").withColumn("zone", F.coalesce("component", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("zone").alias("low"), F.max("zone").alias("high")).filter("low <> high").select("bucket")
    placed = materialise(placed.join(mixed, "bucket").select("bucket", "size", "node", "zone"))
    more = materialise(_likely(placed, signatures).distinct())
    if more.count():
        zones = materialise(_connected(likely.unionByName(more)))

    zones = zones.withColumnRenamed("component", "zone")
    held = materialise(_elements_of(docs, texts, zones.select("node"), of))
    found = materialise(_connected(materialise(_links(zones, held, threshold))))

    nodes = texts.select("k1", "k2", "node").join(found, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    placed_rows = materialise(rows.drop("plain").join(nodes, ["k1", "k2"]))
    same = placed_rows.groupBy("component", "doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("uid").alias("low"))
    best = same.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "low")).alias("best"))
    copies = same.select(F.col("doc_id").alias("same_doc"), F.col("k1").alias("c1"), F.col("k2").alias("c2"), "copies")
    out = placed_rows.join(best, "component").join(copies, F.expr("doc_id <=> same_doc and k1 = c1 and k2 = c2"))
    return out.select("doc_id", "k1", "k2", F.col("best.doc_id").alias("class_id"), (F.col("uid") == F.col("best.low")).alias("kept"), "copies")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of `docs` per class, with its columns as they were."""
    kept = classes(docs, threshold).filter("kept").select(F.col("doc_id").alias("kept_doc"), F.col("k1").alias("c1"), F.col("k2").alias("c2"), "copies")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", *text_keys(F.col("text")))
    found = materialise(whole.join(kept, F.expr("doc_id <=> kept_doc and k1 = c1 and k2 = c2")).select("row", "doc_id", "k1", "k2", "copies"))
    once = found.filter("copies = 1").select("row.*")
    # rows with the same id and text: one of them
    again = found.filter("copies > 1").groupBy("doc_id", "k1", "k2").agg(F.any_value("row").alias("row")).select("row.*")
    return once.unionByName(again)
