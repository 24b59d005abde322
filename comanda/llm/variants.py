"""Spelling variants by search schemes over a bidirectional FM-index.

The vocabulary is counted over all documents. Two words are near if one code point is inserted, deleted or replaced. One
error can't be in both halves of a word, so each word is searched twice: its right half is matched exactly backwards from
the delimiter and extended to the left with one error, and its left half, in the index of the reversed words, is matched
exactly from the other delimiter and extended to the right with one error. The two indexes are the two directions of one
bidirectional index, entered from its two ends, so no step has to keep both intervals. States are intervals of suffix
ranks; all words of a group advance together.

Words and searches meet by the half that has to agree. A half is a row's group; groups of a part are indexed together, and a
half with more than `PART_WORDS` words is dealt over several parts, each of which all its searches visit, so no task
holds more than a bounded number of words. A word's form is its most frequent near word if that is ten times as frequent;
chains of forms have at most log10(greatest count) links and are followed by doubling.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import slices
from comanda.session import materialise

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SHORTEST, FEWEST, RATIO = 7, 2, 10
DELETE_EVERY = 31
# Different words a counting worker holds, words of one index at about, and searches that advance together.
HELD, PART_WORDS, SEARCHES = 200_000, 20_000, 5_000
TEXTS = 500

Change = Callable[[int | None, str], str]


def with_deletions(doc_id: int | None, run: str) -> str:
    """The run, in one of 31 by the crc32 of `<doc_id>:<run>` without one code point. A null id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, change: Change | None = None, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """word, n: the runs of letters of all texts, A to Z in lower case, with at least `shortest` letters and `fewest` occurrences.

    A null text has none. `change` may shorten a run, not make it longer. Counts are summed within a worker before the
    shuffle.
    """
    letters = re.compile(f"[A-Za-z\u00c0-\u00ff]{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        send = lambda: pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})
        for batch in slices(batches, TEXTS):
            for doc, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text")), strict=True):
                own: Counter = Counter()
                for run, n in Counter(letters.findall(text or "")).items():
                    own[run.translate(LOWER)] += n
                for run, n in own.items():
                    word = change(doc, run) if change else run
                    if len(word) >= shortest:
                        total[word] += n
            if len(total) > HELD:
                yield send()
                total.clear()
        yield send()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return materialise(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest))


class Index:
    """Rank structure over the suffixes of delimited words."""

    def __init__(self, words: list[str]) -> None:
        points, sizes = _points(words)
        self.letters = np.unique(points)
        codes = np.searchsorted(self.letters, points) + 1
        ends = np.cumsum(sizes + 1) - 1
        self.size = size = len(points) + len(words)
        text = np.zeros(size, np.int64)
        at = np.ones(size, bool)
        at[ends] = False
        text[at] = codes
        word_at = np.repeat(np.arange(len(words)), sizes + 1)
        # delimiters rank by their word, so suffixes differ by the end of their word at the latest
        rank = text + len(words) - 1
        rank[ends] = np.arange(len(words))
        step = 1
        while True:
            after = np.zeros(size, np.int64)
            after[:-step] = rank[step:] + 1
            order = np.argsort(rank * (rank.max() + 2) + after, kind="stable")
            pair, second = rank[order], after[order]
            new = np.concatenate([[0], np.cumsum((pair[1:] != pair[:-1]) | (second[1:] != second[:-1]))])
            rank[order] = new
            if new[-1] == size - 1:
                break
            step *= 2
        self.word_of = word_at[order]
        before = np.where(order, text[order - 1], 0)
        self.before = before
        # the rows of a letter, by letter and row; a row's place here is where its suffix, led by that letter, ranks
        self.rows = np.sort(before * (size + 1) + np.arange(size))
        self.delimiters = len(words)

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Numbers of code points; those that no word has get a number that no row has."""
        at = np.searchsorted(self.letters, points)
        known = at < len(self.letters)
        known[known] = self.letters[at[known]] == points[known]
        return np.where(known, at + 1, len(self.letters) + 1)

    def step(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks after putting a letter in front of suffixes at ranks."""
        return np.searchsorted(self.rows, codes * (self.size + 1) + places)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64), np.array([len(w) for w in words], np.int64)


def _spread(index: Index, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every letter before every interval: (state, letter, low, high). Small intervals are read, others asked by letter."""
    n_letters = len(index.letters)
    width = high - low
    small = np.flatnonzero(width <= n_letters)
    large = np.flatnonzero(width > n_letters)
    total = width[small]
    state = np.repeat(small, total)
    rows = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total) + low[state]
    pairs = np.unique(state * (n_letters + 1) + index.before[rows])
    state, letter = pairs // (n_letters + 1), pairs % (n_letters + 1)
    state = np.concatenate([state, np.repeat(large, n_letters)])
    letter = np.concatenate([letter, np.tile(np.arange(1, n_letters + 1), len(large))])
    kept = letter > 0
    state, letter = state[kept], letter[kept]
    a, b = index.step(letter, low[state]), index.step(letter, high[state])
    kept = a < b
    return state[kept], letter[kept], a[kept], b[kept]


def near(index: Index, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(search, indexed word) of all words one edit away whose last `exact` code points agree; a pair may come twice."""
    points, sizes = _points(words)
    codes, first = index.codes(points), np.cumsum(sizes) - sizes
    search = np.arange(len(words))
    low, high, left = np.zeros(len(words), np.int64), np.full(len(words), index.delimiters), sizes.copy()
    rest = sizes - exact
    while True:  # the half that agrees
        at = np.flatnonzero(left > rest[search])
        if not len(at):
            break
        left[at] -= 1
        c = codes[first[search[at]] + left[at]]
        low[at], high[at] = index.step(c, low[at]), index.step(c, high[at])
        alive = low < high
        search, low, high, left = search[alive], low[alive], high[alive], left[alive]
    clean, wrong = (search, low, high, left), []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(clean[0]) or wrong:
        put = []
        search, low, high, left = clean
        if len(search):
            state, letter, a, b = _spread(index, low, high)
            of, at = search[state], left[state]
            put.append((of, a, b, at))  # one more letter in the indexed word
            more = at > 0
            same = np.zeros(len(of), bool)
            same[more] = letter[more] == codes[first[of[more]] + at[more] - 1]
            other = more & ~same
            put.append((of[other], a[other], b[other], at[other] - 1))
            less = left > 0  # one letter fewer
            put.append((search[less], low[less], high[less], left[less] - 1))
            clean = (of[same], a[same], b[same], at[same] - 1)
        if wrong:
            search, low, high, left = wrong
            done = left == 0
            a, b = (index.step(np.zeros(done.sum(), np.int64), x[done]) for x in (low, high))
            hits = b - a
            rows = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(a, hits)
            found.append((np.repeat(search[done], hits), index.word_of[index.rows[rows] % (index.size + 1)]))
            on = ~done
            search, low, high, left = search[on], low[on], high[on], left[on] - 1
            c = codes[first[search] + left]
            low, high = index.step(c, low), index.step(c, high)
            alive = low < high
            put.append((search[alive], low[alive], high[alive], left[alive]))
        joined = [np.concatenate(x) for x in zip(*put, strict=True)]
        wrong = joined if len(joined[0]) else []
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_words(vocab: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """word, near, near_n: every pair of near words, both ways, once. `vocab` is a written table of different words."""
    total = vocab.count()
    parts = max(1, -(-4 * total // part_words))
    # the halves a search has to agree with, and the stretches of an indexed word that can be such halves
    asked = F.array(F.struct(F.lit(False).alias("right"), F.expr("left(word, length(word) div 2)").alias("half")), F.struct(F.lit(True).alias("right"), F.expr("right(word, length(word) - length(word) div 2)").alias("half")))
    held = F.expr(
        "array_distinct(flatten(transform(array(-1, 0, 1), d -> array("
        "named_struct('right', false, 'half', left(word, (length(word) + d) div 2)),"
        " named_struct('right', true, 'half', right(word, length(word) + d - (length(word) + d) div 2))))))"
    )
    searches = vocab.select("word", F.explode(asked).alias("k")).select("word", "k.*")
    indexed = vocab.select("word", "n", F.explode(held).alias("k")).select("word", "n", "k.*")
    large = materialise(indexed.groupBy("right", "half").agg(F.ceil(F.count(F.lit(1)) / part_words).cast("long").alias("deals")).filter("deals > 1"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows of a large half take one `own` deal by their word and every `other` one."""
        df = df.join(large, ["right", "half"], "left").withColumn("deals", F.coalesce("deals", F.lit(1).cast("long")))
        df = df.withColumn(own, F.pmod(F.xxhash64("word"), F.col("deals"))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
        return df.withColumn("part", F.pmod(F.xxhash64("right", "half", "search_deal", "index_deal"), F.lit(parts)))

    asks = dealt(searches, "search_deal", "index_deal").select("part", "right", F.lit(None).cast("long").alias("n"), "word", F.length("half").alias("exact"))
    holds = dealt(indexed, "index_deal", "search_deal").select("part", "right", "n", "word", F.lit(None).cast("int").alias("exact")).distinct()

    def search(table: pa.Table) -> pa.Table:
        out = {"word": [], "near": [], "near_n": []}
        right = table.column("right")[0].as_py()
        turn = (lambda w: w) if right else (lambda w: w[::-1])
        is_held = table.column("exact").is_null()
        own, asks = table.filter(is_held), table.filter(pa.compute.invert(is_held))
        if own.num_rows and asks.num_rows:
            words = own.column("word").to_pylist()
            counts = own.column("n").to_numpy()
            index = Index([turn(w) for w in words])
            for at in range(0, asks.num_rows, SEARCHES):
                block = asks.slice(at, SEARCHES)
                asked = block.column("word").to_pylist()
                a, b = near(index, [turn(w) for w in asked], block.column("exact").to_numpy().astype(np.int64))
                pairs = np.unique(a * len(words) + b)
                a, b = (pairs // len(words)).tolist(), pairs % len(words)
                out["word"] += [asked[i] for i in a]
                out["near"] += [words[i] for i in b.tolist()]
                out["near_n"] += counts[b].tolist()
        return pa.table({"word": pa.array(out["word"], pa.string()), "near": pa.array(out["near"], pa.string()), "near_n": pa.array(out["near_n"], pa.int64())})

    both = asks.unionByName(holds)
    return both.groupBy("part", "right").applyInArrow(search, "word string, near string, near_n long").distinct()


def groups(vocab: DataFrame, ratio: int = RATIO, part_words: int = PART_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of `vocab` (word, n), a written table of different words.

    Of near words with equal counts the first in code-point order is the form. An empty table gives no rows.
    """
    best = near_words(vocab, part_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    found = vocab.join(best, "word", "left")
    is_form = -F.col("best.n") >= ratio * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")
    )
    found = materialise(found)
    greatest = found.agg(F.max("n")).first()[0] or 1
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    # every link multiplies the count by `ratio` at least, which bounds the links of a chain; each round doubles them
    for _ in range(math.ceil(math.log2(math.log(greatest, ratio) + 1))):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = materialise(links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
    out = found.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_groups(docs: DataFrame, change: Change | None = with_deletions) -> DataFrame:
    """`groups` of the vocabulary of all documents. Other columns are ignored, repeated rows counted each."""
    return groups(vocabulary(docs, change))
