"""Periodic runs of words by suffix trees.

A run is a stretch of words with smallest period q, of at least max(`LEAST`, `TIMES` * q) words, that no neighbouring word
extends. Ukkonen's algorithm builds the suffix trees of the words and of their reversal. An Euler tour of a tree, kept as
the least depths between neighbouring leaves with a table of minima over powers of two, gives the lowest common ancestor
of two leaves, and with it the longest common extension (LCE) of two places, in constant time. The longest Lyndon word that
starts at a place ends before the next smaller suffix; for one of the two orders of the alphabet every run has such a word
as a root. So each place and order gives one candidate period, which is extended in both directions by one LCE each.

Only stretches that can hold a run get trees: within a run each word sequence of `gram(...)` words occurs twice, so places
whose sequence of that length is unique within its stretch are no part of one. That leaves out no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import slices

LEAST, TIMES = 24, 3
# Texts a worker reads at once.
TEXTS = 200
FACTORS = np.random.default_rng(12).integers(1 << 62, size=64, dtype=np.uint64) * np.uint64(4) + np.uint64(1)

Run = tuple[int, int, int]  # start, length, period


class SuffixTree:
    """Ukkonen's tree of a list of numbers from 0 on; an end mark, smaller than all, closes it."""

    END = -1

    def __init__(self, symbols: list[int]) -> None:
        s = [*symbols, self.END]
        size = len(s)
        start, stop, link = [0], [0], [0]
        kids: list[dict[int, int] | None] = [{}]  # None: a leaf; leaves arise in the order of their suffixes
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(s[edge])
                if child is None:
                    kids[node][s[edge]] = len(start)
                    start.append(i)
                    stop.append(size)
                    link.append(0)
                    kids.append(None)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    at = start[child]
                    span = stop[child] - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[at + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner = len(start)
                    start += (at, i)
                    stop += (at + length, size)
                    link += (0, 0)
                    kids += ({s[at + length]: child, c: inner + 1}, None)
                    kids[node][s[edge]] = inner
                    start[child] = at + length
                    if last:
                        link[last] = inner
                    last = inner
                waiting -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - waiting + 1
                else:
                    node = link[node]
        self.size, self._start, self._stop, self._kids = size, start, stop, kids
        self._suffix = dict(zip((v for v, k in enumerate(kids) if k is None), range(size), strict=True))

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of a tour, and before each the depth of its ancestor shared with the leaf before.

        Children are taken by rising symbols, or falling ones but the end mark first.
        """
        leaves, depths = [], []
        stack = [(0, 0, 0)]
        start, stop, kids, suffix = self._start, self._stop, self._kids, self._suffix
        while stack:
            v, above, shared = stack.pop()
            below = kids[v]
            if below is None:
                leaves.append(suffix[v])
                depths.append(shared)
                continue
            depth = above + stop[v] - start[v]
            symbols = sorted(below, reverse=not falling)
            if falling and symbols[0] == self.END:
                symbols.append(symbols.pop(0))
            # the last one pushed is visited first, and shares what its parent shares
            stack += [(below[c], depth, depth) for c in symbols[:-1]]
            stack.append((below[symbols[-1]], depth, shared))
        return np.array(leaves), np.array(depths, np.int32)


class Extensions:
    """Longest common extensions of pairs of places, from one tour of a tree."""

    def __init__(self, tree: SuffixTree) -> None:
        leaves, depths = tree.tour()
        self.rank = np.empty(tree.size, np.int64)
        self.rank[leaves] = np.arange(tree.size)
        self.minima = [depths]
        while (step := 1 << (len(self.minima) - 1)) * 2 <= tree.size:
            m = self.minima[-1]
            self.minima.append(np.minimum(m[:-step], m[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols agree from places a and b (different ones) on."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            m = self.minima[k]
            out[at] = np.minimum(m[low[at]], m[high[at] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every place but the last the next place of smaller rank."""
    values, out, stack = rank.tolist(), [0] * (len(rank) - 1), []
    for i, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def tree_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """Runs of a stretch by its two trees, by start and period."""
    n = len(codes)
    if n < max(least, times):
        return []
    tree = SuffixTree(codes.tolist())
    ahead, back = Extensions(tree), Extensions(SuffixTree(codes[::-1].tolist()))
    rising = ahead.rank
    falling = np.empty(n + 1, np.int64)
    falling[tree.tour(falling=True)[0]] = np.arange(n + 1)
    places = np.arange(n)
    found: set[Run] = set()
    for rank in (rising, falling):
        ends = next_smaller(rank)
        period = ends - places
        right = ahead(places, ends)
        left = back(n - places, n - ends)
        start, length = places - left, left + period + right
        for at in np.flatnonzero((length >= least) & (length >= times * period)).tolist():
            found.add((int(start[at]), int(length[at]), int(period[at])))
    return sorted(found, key=lambda r: (r[0], r[2]))


def gram(least: int, times: int) -> int:
    """Length of word sequences each of which occurs twice in every run that holds it; below 1 there is none."""
    return min(max(least, times * q) - 2 * q for q in range(1, least + 2)) if times > 2 else 0


def stretches(codes: np.ndarray, size: int, least: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of at least `least` words in which every sequence of `size` words occurs twice."""
    if size < 1:
        return [(0, len(codes))]
    n = len(codes) - size + 1
    if n + size - 1 < least:
        return []
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h += mixed[k : k + n] * FACTORS[k]
    out, todo = [], [(0, n)]
    while todo:
        a, b = todo.pop()
        part = h[a:b]
        ordered = np.sort(part)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        if len(twice) == len(part) - 1:
            kept = np.ones(len(part), bool)
        else:
            kept = np.isin(part, twice)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if y - x + size - 1 >= least:
                (out if y - x == b - a else todo).append((a + x, a + y))
    return [(a, b + size - 1) for a, b in out]


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word as the number of its first occurrence among the different words."""
    known = dict.fromkeys(words)
    for i, w in enumerate(known):
        known[w] = i
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def find_runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs of a text's words, by start and period. A text without words has none."""
    codes = numbered(words)
    out = []
    for a, b in stretches(codes, gram(least, times), least):
        out += [(a + s, length, p) for s, length, p in tree_runs(codes[a:b], least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period; ties to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def with_planted_runs(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, in every tenth document by its id's crc32 periodic from some word on. A row without an id stays as it is."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def document_runs(docs: DataFrame, prepare: Prepare | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length, period in words) and collapsed (the text without repeated periods) of every row.

    Words are runs of characters other than space and U+0009 to U+000D, taken after `prepare`. A null text has no words;
    repeated rows are searched each; other columns are ignored; an empty table gives no rows. A document is searched
    whole by one worker, in memory that grows with its words.
    """
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS):
            ids = batch.column("doc_id").to_pylist()
            sizes, runs, left = [], [], []
            for doc, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                words = (text or "").encode().split()
                if prepare:
                    words = prepare(doc, words)
                found = find_runs(words, least, times)
                sizes.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                left.append(b" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run and hashes of all runs and of the collapsed words, with planted runs."""
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS):
            rows = []
            for doc, runs, left in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "runs", "collapsed")), strict=True):
                found = [(r["start"], r["length"], r["period"]) for r in runs]
                best = strongest(found)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                hashes = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), left)]
                rows.append((doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *hashes))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return document_runs(docs, with_planted_runs).mapInArrow(put, schema)
