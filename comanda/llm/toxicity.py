"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Every word of every example is a feature; word beginnings and repeated words are features too where the labels tie them to
toxicity. A feature weighs its IDF over all documents times a factor from the labels (`LEAST` to 1), so that words without a
tie to toxicity count little but none is left out. The index keeps, per feature and block of examples that have it, the
largest weight; a query leaves out the blocks that can't reach its k-th best, so the k nearest are exact. Their votes, weighted
by similarity, are calibrated on the examples, each left out once.

Only a bounded sample of labelled rows (`EXAMPLES`) becomes examples; every document is counted and scored over its whole text.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm.common import slices
from comanda.session import materialise

EXAMPLES, NEIGHBOURS = 8000, 15
# Lengths of the beginnings taken as features, and how often a feature must occur to count as a repeated one as well.
PREFIXES, REPEATS = (4, 5, 6), (2, 4)
# The factor of a feature rises from LEAST to 1 between these standard scores of its share of toxic examples, if SUPPORT of
# them have it. Beginnings and repeats are features from MARKS toxic examples and the lower score on.
LEAST, SCORES, SUPPORT, MARKS = 0.05, (2.0, 8.0), 2, 3
# Similarity that votes for the share of toxic examples, so that few or distant neighbours decide little.
PRIOR = 1.0
# Examples in a block of the index, and in the parts of it whose best similarities give a floor for the k-th best of all.
BLOCK, PART = 1024, 64
# A feature that one in so many examples has is kept as a row of weights for all of them; so many texts' features are found
# at once, and so many are multiplied with the rows at once.
FREQUENT, TOGETHER, MULTIPLIED = 16, 50, 200
# Words a worker remembers the features of beginnings of.
REMEMBERED = 200_000
REJECT_FROM = 0.7

WORD = re.compile(r"\w+")
BEGINNING = itemgetter(slice(PREFIXES[0]))
# Bytes as they are, but a space for what can't be part of a word in ASCII.
APART = bytes(i if i > 127 or WORD.match(chr(i)) else 32 for i in range(256))


def held_out(doc_id: str = "doc_id") -> Column:
    """True where labels may not be learned from: crc32(doc_id as text) mod 3 is 1. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) >= n)]


def words(text: str | None) -> Counter:
    """How often each word (`WORD`) occurs in the lower-cased text, by splitting at what is no part of a word first."""
    n = Counter((text or "").lower().encode().translate(APART).decode().split())
    for token in [t for t in n if not t.isalnum()]:
        times = n.pop(token)
        for word in WORD.findall(token):
            n[word] += times
    return n


class Met(dict):
    """Numbers of the words met so far and the features of the beginnings of each, one after the other; words without any share 0."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known, self.features, self.starts = known, array("i"), array("i", [0, 0])

    def __missing__(self, word: str) -> int:
        self.features.extend(self.known[f] for f in features(word)[1:] if f in self.known)
        if len(self.features) > self.starts[-1]:
            self.starts.append(len(self.features))
            self[word] = len(self.starts) - 2
        else:
            self[word] = 0
        return self[word]


class Lexicon(dict):
    """Numbers of features; remembers which of them the words met so far have."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        # how words with features of beginnings begin; most words don't
        self.begun = {BEGINNING(f) for f in known if f[-1:] == "-"}
        self.again = {r: np.full(len(known), -1, np.int32) for r in REPEATS}
        for f, i in known.items():
            of, _, r = f.partition("*")
            if r and of in known:
                self.again[int(r)][known[of]] = i
        self.met = Met(self)

    def __reduce__(self):
        return Lexicon, (dict(self),)

    def found(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the whole texts have: place of the text times the number of features plus the feature's number, rising, and
        how often, but for features of repeats; then the same of these, each once."""
        if len(self.met) >= REMEMBERED:
            self.met = Met(self)
        counted = [words(t) for t in texts]
        text = np.repeat(np.arange(len(texts)), [len(c) for c in counted])
        times = np.fromiter(chain.from_iterable(c.values() for c in counted), np.int64)
        flat = list(chain.from_iterable(counted))
        own = np.fromiter(map(self.get, flat, repeat(-1)), np.int32, len(flat))
        begun = np.flatnonzero(np.fromiter(map(self.begun.__contains__, map(BEGINNING, flat)), bool, len(flat)))
        numbers = np.fromiter(map(self.met.__getitem__, map(flat.__getitem__, begun.tolist())), np.int32, len(begun))
        at, n = gather(numbers, np.frombuffer(self.met.starts, np.int32))
        place = np.concatenate([np.flatnonzero(own >= 0), np.repeat(begun, n)])
        of = np.concatenate([own[own >= 0], np.frombuffer(self.met.features, np.int32)[at] if len(at) else at])
        keys, times = sums(text[place] * len(self) + of, times[place])
        often = keys[times >= REPEATS[0]]
        n = times[times >= REPEATS[0]]
        of = often % (len(self) or 1)
        more = []
        for r in REPEATS:
            to = self.again[r][of]
            more.append((often - of + to)[(to >= 0) & (n >= r)])
        return keys, times, np.sort(np.concatenate(more))

    def occurrences(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The features in the whole texts, one text after the other: place of the text, number of the feature, rising, and
        how often it occurs; and where each text's features start."""
        keys, times, more = self.found(texts)
        places = np.searchsorted(keys, more)
        keys, times = np.insert(keys, places, more), np.insert(times, places, 1)
        starts = np.searchsorted(keys, np.arange(len(texts) + 1) * len(self))
        text = np.repeat(np.arange(len(texts)), np.diff(starts))
        return text, (keys - text * len(self)).astype(np.int32), times, starts


def sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, rising, and the sum of the values of each. Keys are below 2^32, values below 2^31."""
    both = np.sort(keys << 31 | values)
    keys = both >> 31
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first], np.add.reduceat(both & (1 << 31) - 1, np.flatnonzero(first)) if len(keys) else values


def counts(text: str | None, known: dict[str, int] | None = None) -> dict:
    """How often each feature occurs in the whole text; with `known`, those in it, by their numbers there."""
    if known is not None:
        _, at, n, _ = (known if isinstance(known, Lexicon) else Lexicon(known)).occurrences([text])
        return dict(zip(at.tolist(), n.tolist(), strict=True))
    found: Counter = Counter()
    for word, n in words(text).items():
        for f in features(word):
            found[f] += n
    found.update({f"{f}*{r}": 1 for f, n in found.items() if n >= REPEATS[0] for r in REPEATS if n >= r})
    return found


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text, toxic of at most `rows` labelled documents with different texts, in the order of a hash of the id.

    Documents whose labels conflict, and held-out ones, are left out.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id")
    known = known.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_high")).filter("toxic = _high").drop("_high")
    chosen = materialise(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))  # the bound of what is broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return materialise(texts.dropDuplicates(["text"]).select("doc_id", "text", "toxic"))


def gather(at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions `starts[i]` up to `starts[i + 1]` of each i of `at`, one after the other, and how many each has."""
    first = starts[at]
    n = starts[at + 1] - first
    ends = np.cumsum(n)
    return np.repeat(first - ends + n, n) + np.arange(ends[-1] if len(ends) else 0), n


def floor(best: np.ndarray, k: int) -> float:
    """What the k-th best of all reaches at least, by the best of each part; 0 for too few parts."""
    return float(np.partition(best, -k)[-k]) if len(best) >= k else 0.0


# What `Model.prepare` makes.
PREPARED = {"block", "most", "starts", "parts", "blocks", "row", "rows"}


@dataclass
class Model:
    """Index over the examples, by feature and block of examples, and the calibration of their votes."""

    known: Lexicon
    weights: np.ndarray  # of the features
    ids: np.ndarray
    toxic: np.ndarray
    offsets: np.ndarray  # where a feature's postings start
    example: np.ndarray  # of a posting, rising within a feature
    weight: np.ndarray
    empty_score: float
    base: float
    curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))
    shared: Broadcast | None = field(default=None, repr=False)

    def __getattr__(self, name: str):
        """The parts of the index are made when they are first asked for: where texts are searched, not in the driver."""
        if name not in PREPARED:
            raise AttributeError(name)
        self.prepare()
        return self.__dict__[name]

    def prepare(self) -> None:
        """The parts of the index: what a block holds of a feature."""
        block = self.example // BLOCK
        first = np.ones(len(block), bool)
        first[1:] = block[1:] != block[:-1]
        first[self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]] = True
        starts = np.flatnonzero(first)
        self.block = block[starts]  # of a part
        self.most = np.maximum.reduceat(self.weight, starts) if len(starts) else self.weight  # the largest weight in a part
        self.starts = np.append(starts, len(block)).astype(np.int32)  # of a part's postings
        self.parts = np.searchsorted(starts, self.offsets).astype(np.int32)  # where a feature's parts start
        self.blocks = len(self.ids) // BLOCK + 1
        often = np.flatnonzero(np.diff(self.offsets) * FREQUENT > len(self.ids))
        self.row = np.full(len(self.weights), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), self.blocks * BLOCK), np.float32)
        for i, f in enumerate(often.tolist()):
            mine = slice(self.offsets[f], self.offsets[f + 1])
            self.rows[i, self.example[mine]] = self.weight[mine]

    def __reduce__(self):
        return Model, (self.known, self.weights, self.ids, self.toxic, self.offsets.astype(np.int32, copy=False), self.example.astype(np.int32, copy=False), self.weight.astype(np.float32, copy=False), self.empty_score, self.base)

    def share(self, spark: SparkSession) -> Broadcast:
        """The index sent to the workers once (`EXAMPLES` bounds it); the calibration goes with each job."""
        self.shared = self.shared or spark.sparkContext.broadcast(self)
        return self.shared

    def vector(self, counted: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        at, n = np.fromiter(counted.keys(), np.int32, len(counted)), np.fromiter(counted.values(), float, len(counted))
        order = np.argsort(at)
        w = (1 + np.log(n[order])) * self.weights[at[order]]
        return at[order], w / (np.sqrt(np.square(w).sum()) or 1.0)

    def vectors(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """`vector` of the counts of each text."""
        text, at, n, starts = self.known.occurrences(texts)
        w = (1 + np.log(n)) * self.weights[at]
        norms = np.sqrt(np.bincount(text, np.square(w), len(texts)))
        w /= np.where(norms > 0, norms, 1)[text]
        return [(at[a:b], w[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False)]

    def frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent features of each vector add to the cosine with each example."""
        q = np.zeros((len(vectors), len(self.rows)), np.float32)
        for i, (at, w) in enumerate(vectors):
            row = self.row[at]
            q[i, row[row >= 0]] = w[row >= 0]
        return q @ self.rows

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int | None = None, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine, ties to the smaller id; none of similarity 0, nor the one of id `without`.

        `known` is what `frequent` gives for the vector. A block reaches at most its best by the frequent features and the
        largest weights of the others. The k-th best by the frequent features
        alone is less than the k-th best by all, so blocks that reach less are left out.
        """
        known = self.frequent([(at, w)])[0] if known is None else known
        if without is not None:
            known[: len(self.ids)][self.ids == without] = 0
        others = self.row[at] < 0
        part, n = gather(at[others], self.parts)
        q, block = np.repeat(w[others], n), self.block[part]
        best = known.reshape(-1, PART).max(1)
        reach = best.reshape(self.blocks, -1).max(1) + np.bincount(block, q * self.most[part], self.blocks)
        turn = (reach > 0) & (reach * (1 + 1e-6) >= floor(best, k))
        if turn.all():
            q, (posting, n) = w[others], gather(at[others], self.offsets)
        else:
            mine = turn[block]
            q, (posting, n) = q[mine], gather(part[mine], self.starts)
            known = known * np.repeat(turn, BLOCK)
        total = np.bincount(self.example[posting], np.repeat(q, n) * self.weight[posting], len(known)) + known
        if without is not None:
            total[: len(self.ids)][self.ids == without] = 0
        best = np.flatnonzero(total >= (floor(total.reshape(-1, PART).max(1), k) or np.finfo(float).tiny))  # with all that tie
        best = best[np.lexsort((self.ids[best], -total[best]))[:k]]
        return best, total[best]

    def vote(self, best: np.ndarray, scores: np.ndarray) -> float:
        return float((scores @ self.toxic[best] + PRIOR * self.base) / (scores.sum() + PRIOR))

    def votes(self, texts: list[str | None], without: list[int] | None = None) -> Iterator[tuple[float | None, list[int]]]:
        """What the nearest examples of each text vote for, before calibration, and their ids; None without any."""
        for first in range(0, len(texts), MULTIPLIED):
            some = texts[first : first + MULTIPLIED]
            vectors = [v for i in range(0, len(some), TOGETHER) for v in self.vectors(some[i : i + TOGETHER])]
            for i, ((at, w), known) in enumerate(zip(vectors, self.frequent(vectors), strict=True), first):
                best, scores = self.nearest(at, w, NEIGHBOURS, without and without[i], known) if len(at) else ((), ())
                yield (self.vote(best, scores), self.ids[best].tolist()) if len(best) else (None, [])

    def score_all(self, texts: list[str | None], curve: tuple[np.ndarray, np.ndarray]) -> list[tuple[float, list[int]]]:
        """Calibrated scores of whole texts and the ids of their nearest examples, nearest first."""
        return [(self.empty_score, []) if raw is None else (0.999 * float(np.interp(raw, *curve)) + 0.001 * raw, ids) for raw, ids in self.votes(texts)]

    def score(self, text: str | None) -> tuple[float, list[int]]:
        return self.score_all([text], self.curve)[0]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step curve nearest to the points, as its corners (pool adjacent violators)."""
    blocks: list[list[float]] = []  # mean, weight, from, to
    order = np.argsort(x, kind="stable")
    values, first = np.unique(x[order], return_index=True)
    for v, part in zip(values, np.split(y[order], first[1:]), strict=True):
        blocks.append([float(part.mean()), len(part), v, v])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            n = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / n, n, a[2], b[3]])
    xs = np.array([v for b in blocks for v in (b[2], b[3])])
    return xs, np.array([b[0] for b in blocks for _ in (0, 1)])


def select_features(examples: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """The numbers of all words of the examples and of the beginnings and repeats that mark toxic ones; their factors."""

    def found(batches):
        for batch in slices(batches, 200):
            n: Counter = Counter()
            p: Counter = Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen = counts(text).keys()
                n.update(seen)
                p.update(seen if y == 1 else ())
            yield pa.RecordBatch.from_pydict({"feature": pa.array(n.keys(), pa.string()), "n": pa.array(n.values(), pa.int64()), "p": pa.array([p[f] for f in n], pa.int64())})

    share = examples.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    by = examples.select("text", "toxic").mapInArrow(found, "feature string, n long, p long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    spread = F.sqrt(F.col("n") * F.lit(share * (1 - share) + 1e-12))
    rows = by.withColumn("z", (F.col("p") - F.col("n") * share) / spread)
    rows = rows.filter(~F.col("feature").rlike("[-*]") | (F.col("p") >= MARKS) & (F.col("z") >= SCORES[0]))
    got = rows.select("feature", "p", "z").orderBy("feature").toArrow()
    rise = np.clip((got["z"].to_numpy() - SCORES[0]) / (SCORES[1] - SCORES[0]), 0, 1)
    factors = LEAST + (1 - LEAST) * np.where(got["p"].to_numpy() >= SUPPORT, rise, 0)
    return Lexicon({f: i for i, f in enumerate(got["feature"].to_pylist())}), factors


def idf(docs: DataFrame, known: dict[str, int]) -> np.ndarray:
    """The IDF of each known feature over all documents, counted in one pass over their whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(known if isinstance(known, Lexicon) else Lexicon(known))

    def having(batches):
        known = shared.value
        n = np.zeros(len(known), np.int64)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            got = [k for i in range(0, len(texts), TOGETHER) for k in known.found(texts[i : i + TOGETHER])[::2]]
            n[:] += np.bincount(np.concatenate(got) % (len(known) or 1), minlength=len(n)) if texts else 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    got = docs.select("text").mapInArrow(having, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    df = np.zeros(len(known))
    df[got["at"].to_numpy()] = got["n"].to_numpy()
    return np.log((docs.count() + 1) / (df + 1)) + 1


def index(known: Lexicon, weights: np.ndarray, examples: pa.Table) -> Model:
    """The index over the examples (doc_id, toxic, and the numbers and counts of their features), not calibrated yet."""
    examples = examples.sort_by([("toxic", "descending"), ("doc_id", "ascending")])  # blocks of one kind reach less
    lengths = examples["at"].combine_chunks().value_lengths().to_numpy()
    toxic = (examples["toxic"].to_numpy() == 1).astype(float)
    base, rest = float(toxic.mean()) if len(toxic) else 0.0, toxic[lengths == 0]
    ids = examples["doc_id"].to_numpy()
    f = examples["at"].combine_chunks().flatten().to_numpy()
    w = np.log(examples["n"].combine_chunks().flatten().to_numpy(), dtype=float)
    del examples
    # postings are millions: in place, and no wider than they have to be
    w += 1
    w *= weights[f]
    e = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    w /= np.sqrt(np.bincount(e, np.square(w), len(lengths)))[e]
    w = w.astype(np.float32)
    order = np.argsort(f, kind="stable")  # examples rise already
    e, w = e[order], w[order]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(f, minlength=len(known)))]).astype(np.int32)
    empty = (rest.sum() + 0.5 * bool(len(rest))) / (len(rest) + 1)
    return Model(known, weights, ids, toxic, offsets, e, w, float(empty), base)


def fit(docs: DataFrame, labels: DataFrame, rows: int = EXAMPLES) -> Model:
    """Learn from at most `rows` labelled documents that are not held out. Without labels every score is 0."""
    examples = sample(docs, labels, rows)
    known, factors = select_features(examples)

    lexicon = docs.sparkSession.sparkContext.broadcast(known)

    def vectors(batches):
        for batch in slices(batches, TOGETHER):
            _, at, n, starts = lexicon.value.occurrences(batch.column("text").to_pylist())
            starts = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "toxic": batch.column("toxic").cast(pa.int32()), "at": pa.ListArray.from_arrays(starts, pa.array(at, pa.int32())), "n": pa.ListArray.from_arrays(starts, pa.array(n, pa.int32()))}
            )

    model = index(known, factors * idf(docs, known), examples.mapInArrow(vectors, "doc_id long, toxic int, at array<int>, n array<int>").toArrow())
    lexicon.destroy()
    shared = model.share(docs.sparkSession)

    def left_out(batches):
        for batch in slices(batches):
            ids, texts, toxic = (batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))
            got = [(raw, int(y == 1)) for (raw, _), y in zip(shared.value.votes(texts, ids), toxic, strict=True)]
            yield pa.RecordBatch.from_pydict({"raw": pa.array([r for r, _ in got], pa.float64()), "toxic": pa.array([y for _, y in got], pa.int32())})

    votes = examples.mapInArrow(left_out, "raw double, toxic int").filter("raw IS NOT NULL").orderBy("raw", "toxic").toArrow()
    if votes.num_rows:
        model.curve = isotonic(votes["raw"].to_numpy(), votes["toxic"].to_numpy())
    return model


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted and the ids of the nearest examples, for every row of `docs`.

    Null and empty texts get the share of toxic examples without features. Other columns are ignored.
    """
    shared, curve = model.share(docs.sparkSession), model.curve

    def score(batches):
        for batch in slices(batches):
            got = shared.value.score_all(batch.column("text").to_pylist(), curve)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "score": pa.array([s for s, _ in got], pa.float64()), "predicted": pa.array([int(s >= REJECT_FROM) for s, _ in got], pa.int32()), "nearest": pa.array([n for _, n in got], pa.list_(pa.int64()))}
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int, nearest array<long>")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, columns as they were."""
    shared, curve = model.share(docs.sparkSession), model.curve

    def keep(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array([score < REJECT_FROM for score, _ in shared.value.score_all(batch.column("text").to_pylist(), curve)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
