"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares.

Documents become token pieces of at most `size` ids. Only the histogram of piece lengths (at most `size` rows) reaches
the driver. There, patterns of up to `parts` length bins that fill a sequence exactly are enumerated, their repeat
counts are fitted to the histogram by non-negative least squares and rounded, and what is left is packed best fit
decreasing into the gaps and into new sequences. The plan is kept in runs of equal sequences, so its size depends on
the lengths, not on the number of documents. Pieces find their place by their rank among pieces of equal length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import rank_within, slices
from comanda.session import materialise

SIZE = 4096
END_ID = 1
# Lengths are binned by this many ids for the patterns; patterns have up to this many pieces.
UNIT, PARTS = 16, 3
# Words whose ids a worker keeps; beyond that it starts anew.
KEPT_WORDS = 200_000
# Words encoded in one call.
JOINED_WORDS = 2000
# Characters encoded at once, which bounds the words looked up together.
SLICE_CHARS = 1_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# A mark that ends a word after a letter or number is a pre-token of its own.
LAST_MARK = re.compile(r"[.,;:!?](?<=[^\W_].)(?!\S)")
# Texts with these are not lowered or cut at marks: special ids, and letters whose lower case depends on what is around.
ODD = ("<|", "\u03a3", "\u0130")


class WordIds:
    """Ids of whole texts, by words that are looked up or encoded once.

    Texts are cut at spaces, tabs and line ends, and before the mark that ends a word. The vocabulary's pre-tokenizer
    drops white space and never joins across these places, so the ids of a text are those of its words in order. It
    lowers texts too, so words are looked up in lower case. A word of letters only is one pre-token: such words are
    encoded together, joined by spaces, and their ids told apart by the number of the pre-token.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    def words(self, text: str) -> list[str]:
        if not any(map(text.__contains__, ODD)):
            text = LAST_MARK.sub(r" \g<0>", text.lower())
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def learn(self, words: list[str]) -> None:
        # letters that the normalizer leaves letters
        plain = {w for w in words if w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w) and w == w.lower())}
        other = [w for w in words if w not in plain]
        plain = list(plain)
        for at in range(0, len(plain), JOINED_WORDS):
            part = plain[at : at + JOINED_WORDS]
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, number = np.asarray(got.ids, "<u4"), np.asarray(got.word_ids, np.int64)
            ends = np.searchsorted(number, np.arange(len(part)), "right") * 4
            data, start = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.known[word] = data[start:end]
                start = end
        for word, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.known[word] = np.asarray(got.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            cut = [self.words(t) for t in texts[at:end]]
            if len(self.known) > KEPT_WORDS:
                self.known = {"": b""}
            self.learn(list({w for words in cut for w in words if w not in self.known}))
            for words in cut:
                yield b"".join(map(self.known.__getitem__, words))
            at = end


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One encoder per worker process and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def cut(ids: bytes, size: int) -> list[tuple[int, int, bytes]]:
    """(start, length, ids) of the pieces of a document."""
    step = 4 * size
    return [(a // 4, len(ids[a : a + step]) // 4, ids[a : a + step]) for a in range(0, len(ids), step)]


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and `ids`) of every piece of every document.

    A null text is an empty one: its only id is `end_id`. Whole texts are encoded.
    """

    def pieces(batches):
        words = encoder(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(texts), strict=True):
                for i, (start, length, part) in enumerate(cut(ids + end, size)):
                    values = (doc_id, i, start, length, zlib.crc32(part), np.frombuffer(part, "<u4").tolist() if with_ids else None)
                    for k, v in zip(out, values, strict=True):
                        out[k].append(v)
            arrays = {k: pa.array(out[k], t) for k, t in (("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()))}
            if with_ids:
                arrays["ids"] = pa.array(out["ids"], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(arrays)

    schema = PIECES + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pieces, schema)


def patterns(bins: int, parts: int) -> list[tuple[int, ...]]:
    """Every multiset of at most `parts` bins that adds up to `bins`, largest first."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, most: int, taken: tuple[int, ...]) -> None:
        if not left:
            out.append(taken)
        elif len(taken) < parts:
            least = -(-left // (parts - len(taken)))
            for b in range(min(left, most), least - 1, -1):
                grow(left - b, b, (*taken, b))

    grow(bins, bins, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set of columns (each column enters by the steepest gradient)."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    limit = tolerance * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(6 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= limit:
            break
        active[best] = True
        while True:
            cols = np.flatnonzero(active)
            sub = a[:, cols]
            z = np.linalg.solve(sub.T @ sub + 1e-10 * np.eye(len(cols)), sub.T @ b)
            if z.min() > 0:
                x[:] = 0
                x[cols] = z
                break
            bad = z <= 0
            share = (x[cols][bad] / np.maximum(x[cols][bad] - z[bad], 1e-300)).min()
            x[cols] += share * (z - x[cols])
            x[cols[bad & (x[cols] <= 1e-12)]] = 0
            drop = cols[x[cols] <= 1e-12]
            active[drop], x[drop] = False, 0
            if not active.any():
                break
    return x


class Plan:
    """Runs of equal sequences: [first sequence, how many, [(length, first rank)], ids used]."""

    def __init__(self, histogram: dict[int, int], size: int) -> None:
        self.size, self.left, self.rank = size, dict(histogram), dict.fromkeys(histogram, 0)
        self.sequences, self.runs = 0, []

    def draw(self, length: int, n: int) -> int:
        """The first rank of the next n pieces of this length."""
        first = self.rank[length]
        self.rank[length] += n
        self.left[length] -= n
        return first

    def open(self, n: int, items: list[tuple[int, int]], used: int) -> list:
        run = [self.sequences, n, items, used]
        self.sequences += n
        self.runs.append(run)
        return run

    def fit_patterns(self, unit: int, parts: int) -> None:
        bins = self.size // unit
        by_bin: dict[int, list[int]] = {}
        for length in sorted(self.left, reverse=True):
            by_bin.setdefault(-(-length // unit), []).append(length)
        have = np.zeros(bins)
        for b, lengths in by_bin.items():
            have[b - 1] = sum(self.left[x] for x in lengths)
        usable = [p for p in patterns(bins, parts) if all(b in by_bin for b in p)]
        if not usable:
            return
        a = np.zeros((bins, len(usable)))
        for j, p in enumerate(usable):
            for b in p:
                a[b - 1, j] += 1
        repeats = nnls(a, have)
        for j in np.argsort(-repeats, kind="stable"):
            need = a[:, j]
            n = int(min(round(repeats[j]), (have[need > 0] // need[need > 0]).min()))
            if n <= 0:
                continue
            have -= n * need
            while n:  # the longest pieces of each bin first, in runs of equal lengths
                lengths = []
                for b in usable[j]:
                    lengths.append(next(x for x in by_bin[b] if self.left[x] > lengths.count(x)))
                run = min(n, *(self.left[x] // lengths.count(x) for x in lengths))
                self.open(run, [(x, self.draw(x, run)) for x in lengths], sum(lengths))
                n -= run

    def fill(self) -> None:
        """Best fit decreasing of what is left, into the gaps and then into new sequences."""
        gaps: dict[int, list] = {}
        spaces: list[int] = []

        def offer(run: list) -> None:
            space = self.size - run[3]
            if space:
                if space not in gaps:
                    gaps[space] = []
                    insort(spaces, space)
                gaps[space].append(run)

        for run in self.runs:
            offer(run)
        for length in sorted((x for x, n in self.left.items() if n), reverse=True):
            while n := self.left[length]:
                at = bisect_left(spaces, length)
                if at == len(spaces):
                    each = min(self.size // length, n)
                    many = n // each
                    offer(self.open(many, [(length, self.draw(length, many)) for _ in range(each)], each * length))
                    continue
                space = spaces[at]
                run = gaps[space].pop()
                if not gaps[space]:
                    del gaps[space]
                    del spaces[at]
                each = min(space // length, n)
                many = min(run[1], n // each)
                if many < run[1]:
                    rest = [run[0] + many, run[1] - many, [(x, r + many) for x, r in run[2]], run[3]]
                    self.runs.append(rest)
                    offer(rest)
                    run[1] = many
                run[2].extend((length, self.draw(length, many)) for _ in range(each))
                run[3] += each * length
                offer(run)

    def places(self) -> np.ndarray:
        """Rows (length, first rank, first sequence, offset), sorted by length and rank."""
        rows = []
        for first, _, items, _ in self.runs:
            offset = 0
            for length, rank in items:
                rows.append((length, rank, first, offset))
                offset += length
        return np.asarray(sorted(rows), np.int64).reshape(-1, 4)


def plan(histogram: dict[int, int], size: int = SIZE, unit: int = UNIT, parts: int = PARTS) -> Plan:
    out = Plan(histogram, size)
    if size % unit == 0:
        out.fit_patterns(unit, parts)
    out.fill()
    return out


def pack(
    docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID, unit: int = UNIT, parts: int = PARTS, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document with sequence_id and offset; sequences hold at most `size` ids, offsets have no gaps.

    Repeated rows are packed each. An empty table gives no rows. Columns other than doc_id and text are ignored. With
    `with_ids` the ids themselves come along.
    """
    pieces = materialise(token_pieces(docs, vocabulary, size, end_id, with_ids).withColumn("uid", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = plan(histogram, size, unit, parts).places()
    ranked = rank_within(pieces, "length", "uid", ["doc_id", "piece"], "rank")
    keys = (places[:, 0] << 44) + places[:, 1]
    names = [c for c in pieces.columns if c != "uid"]

    def put(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            arrays = {c: batch.column(c) for c in names}
            arrays["sequence_id"] = pa.array(places[at, 2] + rank - places[at, 1])
            arrays["offset"] = pa.array(places[at, 3])
            yield pa.RecordBatch.from_pydict(arrays)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "uid")
    return ranked.select(*names, "rank").mapInArrow(put, schema + ", sequence_id long, offset long")
