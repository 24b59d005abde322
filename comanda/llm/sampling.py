"""Sampled segmentations of texts into SentencePiece pieces, without replacement, and decoding.

A text is cut before every space that no piece of the vocabulary crosses; a word with its space marks is a lattice of the
vocabulary's pieces, with byte pieces where a character has none. Words of any length are whole: long ones are cut further, but
only where no piece crosses, so no segmentation of the text is left out. A segmentation's probability is the product of its pieces' (by rank in the vocabulary,
Zipf). Top-down Gumbel sampling visits the tree of prefixes best first: the best segmentation keeps the root's perturbed
value, and at every node of its path the mass not taken gets a perturbed value below it, drawn from a truncated Gumbel
distribution. The best of these branches is where the next segmentation leaves the path. So the k segmentations of the
largest perturbed values come out, all different, in order. Noise depends on the row's key and the place only.

Lattices are worked out once per distinct word of many batches, samples for all documents of a batch at once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# Characters sampled at once. Longer words are cut where no piece crosses; so many places of a word share a number for the noise.
BATCH_CHARS, WORD_CHARS = 1_000_000, 256
# Characters of the words whose lattices a worker remembers from batch to batch.
REMEMBERED = 4_000_000
ZIPF = 2.0

MIX1, MIX2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, word: np.ndarray, place: np.ndarray, use: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key, the word's number, the place in it and the use only.

    A word of more than `WORD_CHARS` places takes the numbers behind its own as well.
    """
    at = (word.astype(np.uint64) << np.uint64(24)) + (place.astype(np.uint64) << np.uint64(16)) + np.uint64(use)
    return ((mix(key + at * GOLD) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Vocabulary:
    """Pieces by hash of their characters, with log probabilities."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        inner = sorted((self.pieces[i] for i in plain if MARK in self.pieces[i][1:]), key=len, reverse=True)
        self.joints = {p[i - 1 : i + 1].replace(MARK, " ") for p in inner for i in range(1, len(p)) if p[i] == MARK}
        self.inner = re.compile("(?=(" + "|".join(map(re.escape, inner)) + "))")  # the longest piece from a place on that crosses a space
        rank = np.array([-model.get_score(i) for i in plain])
        mass = 1 / (rank + ZIPF)
        total = mass.sum() + len(self.bytes) / (n + ZIPF)
        self.longest = max(len(self.pieces[i]) for i in plain)
        self.factors = mix(np.arange(1, self.longest + 1, dtype=np.uint64) * GOLD) | np.uint64(1)
        keys = np.array([self.key(self.pieces[i]) for i in plain], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids, self.logs = keys[order], np.array(plain)[order], np.log(mass / total)[order]
        self.byte_log = -np.log((n + ZIPF) * total)
        self.byte_ids = np.array([self.bytes[b] for b in range(128)], np.int32)
        self.text_of = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        self.wide = {i for i, b in self.byte_of.items() if b >= 128}
        self.filter = np.zeros(1 << 22, bool)
        slots = (self.keys >> np.uint64(42)).astype(np.int64)
        self.filter[slots] = True
        self.place = np.zeros(1 << 22, np.int32)  # of a slot's last key; other keys of the slot are searched for
        self.place[slots] = np.arange(len(slots))
        self.shared = np.zeros(1 << 22, bool)
        self.shared[slots[1:][slots[1:] == slots[:-1]]] = True

    def key(self, piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for i, c in enumerate(piece):
            h = h + np.array([ord(c)], np.uint64) * self.factors[i]
        return int(mix(h + np.uint64(len(piece)))[0])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are pieces, and their places in `ids` and `logs`."""
        slots = (keys >> np.uint64(42)).astype(np.int64)
        may = np.flatnonzero(self.filter[slots])
        slots, keys = slots[may], keys[may]
        at = self.place[slots]
        more = np.flatnonzero(self.shared[slots])
        at[more] = np.minimum(np.searchsorted(self.keys, keys[more]), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return may[hit], at[hit]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


class Lattice:
    """All segmentations of each word met so far. A character's place has the arcs from `first` of it on, which rise by length.

    An arc has its length less one, its log probability given its place, the sum of the probabilities up to it (2 for the
    last) and its piece. Arrays have room behind what is filled.
    """

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.numbers, self.places, self.arcs = v, defaultdict(), 0, 0
        self.numbers.default_factory = self.numbers.__len__
        self.starts, self.ends, self.first = (np.zeros(1, np.int32) for _ in range(3))
        self.chars = np.zeros(1, np.uint32)
        self.size, self.log, self.cum, self.piece = np.zeros(1, np.int8), np.zeros(1), np.zeros(1), np.zeros(1, np.int32)

    def number(self, words: list[str]) -> np.ndarray:
        """The words' numbers; the lattices of new ones are worked out."""
        met = len(self.numbers)
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if len(self.numbers) > met:
            self.add(met, list(islice(self.numbers, met, None)))
        return found

    def add(self, n: int, words: list[str]) -> None:
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        chars, size, log, cum, piece, counts = arcs_of(words, sizes, ends, self.v)
        p, a = self.places, self.arcs
        self.put(n, starts=ends - sizes + p, ends=ends + p)
        self.put(p, chars=chars, first=np.cumsum(counts) - counts + a)
        self.put(a, size=size, log=log, cum=cum, piece=piece)
        self.places, self.arcs = p + len(chars), a + len(log)
        self.put(self.places, first=np.array([self.arcs]))

    def put(self, at: int, **columns: np.ndarray) -> None:
        for name, new in columns.items():
            held = getattr(self, name)
            if at + len(new) > len(held):
                more = np.empty(max(at + len(new), len(held) * 3 // 2), held.dtype)
                more[:at] = held[:at]
                setattr(self, name, held := more)
            held[at : at + len(new)] = new

    def dense(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By place and length less one: the arcs' log probabilities, -inf without one, and their numbers."""
        first = self.first[places].astype(np.int64)
        n = self.first[places + 1] - first
        row, ends = np.repeat(np.arange(len(places)), n), np.cumsum(n)
        arc = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + n, n)
        log = np.full((len(places), self.v.longest), -np.inf)
        at = np.zeros(log.shape, np.int64)
        log[row, self.size[arc]], at[row, self.size[arc]] = self.log[arc], arc
        return log, at


def matches(chars: np.ndarray, left: np.ndarray, v: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length from 1 on the places that have a piece so long, and its place in `ids` and `logs`. `left`: characters up to the end of the place's word."""
    n = len(chars)
    padded = np.concatenate([chars.astype(np.uint64), np.zeros(v.longest, np.uint64)])
    padded[padded == ord(" ")] = 0x110000  # a mark that the text itself holds is spelled in bytes
    h = np.zeros(n, np.uint64)
    fits = np.arange(n)
    for i in range(v.longest):
        h += padded[i : i + n] * v.factors[i]
        fits = fits[left[fits] > i]
        hit, at = v.find(mix(h[fits] + np.uint64(i + 1)))
        yield fits[hit], at


def arcs_of(words: list[str], sizes: np.ndarray, ends: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """The words' characters, then of all arcs in order the size, log, cum and piece, and how many arcs each place has."""
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    n, longest = len(chars), v.longest
    left = np.repeat(ends, sizes) - np.arange(n)
    hits = list(matches(chars, left, v))
    chars[chars == ord(" ")] = ord(MARK)  # as the text has it
    # characters that are no piece are spelled, so every place has an arc of size 0
    spelled = np.ones(n, bool)
    spelled[hits[0][0]] = False
    spelled = np.flatnonzero(spelled)
    code = chars[spelled]
    width = 1 + (code >= 0x80).astype(int) + (code >= 0x800) + (code >= 0x10000)
    bytes_ = np.where(width == 1, v.byte_ids[np.minimum(code, 0x7F).astype(np.int64)], -1)
    place = np.concatenate([spelled, *(to for to, _ in hits)])
    size = np.repeat(np.array([0, *range(longest)], np.int8), [len(spelled), *(len(to) for to, _ in hits)])
    log = np.concatenate([v.byte_log * width, *(v.logs[at] for _, at in hits)])
    piece = np.concatenate([bytes_, *(v.ids[at] for _, at in hits)]).astype(np.int32)
    counts = np.bincount(place, minlength=n)
    # arcs by how far their place is from the word's end, places with many arcs first, then by place and size
    rank = left * (longest + 1) - counts
    order = np.argsort(rank.astype(np.int16) if rank.max() < 1 << 15 else rank, kind="stable")
    turn = np.empty(n, np.int64)
    turn[order] = np.arange(n)
    count = counts[order]
    first = np.cumsum(count) - count
    to = first[turn[place]]
    met, low = np.zeros(n, np.int64), 0
    for found in (spelled, *(x for x, _ in hits)):
        to[low : low + len(found)] += met[found]
        met[found] += 1
        low += len(found)
    log, piece, size, place = (moved(x, to) for x in (log, piece, size, place))
    reach = place + size + 1
    reach[size + 1 == left[place]] = n  # after the word's end nothing is to come
    # in the end `log` holds the log probability of each arc given its place, `cum` the sums up to it
    cum, beta = np.empty(len(log)), np.zeros(n + 1)
    levels = np.searchsorted(left[order], np.arange(1, int(sizes.max()) + 2)).tolist()
    for lo, hi in zip(levels, levels[1:], strict=False):
        begin, c = first[lo], count[lo:hi]
        f, end = first[lo:hi] - begin, first[hi - 1] + count[hi - 1]
        values = log[begin:end] + beta[reach[begin:end]]
        top = np.maximum.reduceat(values, f)
        p = np.exp(values - np.repeat(top, c))
        sums = p.copy()
        for k in range(1, int(c[0])):
            i = f[: np.searchsorted(-c, -k, "left")] + k
            sums[i] += sums[i - 1]
        last = f + c - 1
        total = top + np.log(sums[last])
        beta[order[lo:hi]] = total
        log[begin:end] = values - np.repeat(total, c)
        sums /= np.repeat(sums[last], c)
        for i in np.flatnonzero(p[last] == 0).tolist():  # arcs too unlikely for a number
            while p[last[i]] == 0:
                sums[last[i]] = 2.0
                last[i] -= 1
        sums[last] = 2.0
        cum[begin:end] = sums
    # by place
    back = np.repeat(first[turn] - (np.cumsum(counts) - counts), counts) + np.arange(len(log))
    return chars, size[back], log[back], cum[back], piece[back], counts


def moved(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    out = np.empty_like(x)
    out[to] = x
    return out


_LATTICES: dict[str, Lattice] = {}


def remembered(v: Vocabulary) -> Lattice:
    """The lattice of the batches before, or an empty one once that holds `REMEMBERED` characters."""
    lattice = _LATTICES.get("last")
    if lattice is None or lattice.v is not v or lattice.places >= REMEMBERED:
        lattice = _LATTICES["last"] = Lattice(v)
    return lattice


def draw(lattice: Lattice, key: np.ndarray, word: np.ndarray, occurrence: np.ndarray, use: int, first: np.ndarray, places: np.ndarray, taken: np.ndarray) -> dict[str, np.ndarray]:
    """Samples of words, as nodes in order: row, place, arc, its log probability, the mass of arcs not taken, sizes of arcs taken.

    The words `first` go on from `places`, where the arcs in `taken` may not be used.
    """
    begin, end = lattice.starts[word].astype(np.int64), lattice.ends[word]
    got: list[tuple[np.ndarray, ...]] = []
    live, at = np.arange(len(word)), begin.copy()
    at[first] = places
    step = 0
    while len(live):
        u = uniform(key[live], occurrence[live], at - begin[live], use)
        arc = lattice.first[at].astype(np.int64)
        todo = np.flatnonzero(lattice.cum[arc] <= u)
        while len(todo):
            arc[todo] += 1
            todo = todo[lattice.cum[arc[todo]] <= u[todo]]
        log = lattice.log[arc]
        rest = -np.expm1(log)
        used = np.zeros(len(live), np.int64)
        if step == 0 and len(first):
            logs, arcs = lattice.dense(places)
            p = np.exp(logs)
            p[(taken[:, None] >> np.arange(p.shape[1])) & 1 == 1] = 0.0
            sums = np.cumsum(p, axis=1)
            chosen = (sums <= (u[first] * sums[:, -1])[:, None]).sum(axis=1)
            each = np.arange(len(first))
            chosen = np.where((chosen < p.shape[1]) & (p[each, np.minimum(chosen, p.shape[1] - 1)] > 0), chosen, p.argmax(axis=1))
            arc[first], log[first], rest[first], used[first] = arcs[each, chosen], logs[each, chosen], sums[:, -1] - p[each, chosen], taken
        size = lattice.size[arc].astype(np.int64)
        got.append((live, at, arc, log, np.where(rest > 1e-15, rest, 0.0), used | (1 << size)))
        at = at + size + 1
        go = at < end[live]
        live, at = live[go], at[go]
        step += 1
    names = ("row", "at", "arc", "log", "rest", "taken")
    if not got:
        return {n: np.zeros(0, np.int64) for n in names}
    counts = np.zeros(len(word), np.int64)
    for g in got:
        counts[g[0]] += 1
    low = np.cumsum(counts) - counts
    out = {n: np.empty(int(counts.sum()), x.dtype) for n, x in zip(names, got[0], strict=True)}
    for i, g in enumerate(got):
        to = low[g[0]] + i
        for n, x in zip(names, g, strict=True):
            out[n][to] = x
    return out


def cut(text: str) -> list[str]:
    """Words with their mark; empty for an empty text. Marks that the text itself holds are spaces in them."""
    if not text:
        return []
    words = (MARK + text.replace(" ", " " + MARK)).split(" ")
    return [MARK + w[1:].replace(MARK, " ") for w in words] if MARK in text else words


def parts(text: str, v: Vocabulary) -> list[str]:
    """The text's words, in one where a piece crosses the space between them, and long ones cut where none crosses."""
    words = cut(text)
    if v.joints and any(x in " " + text for x in v.joints):
        words = joined(words, v)
    if words and max(map(len, words)) > WORD_CHARS:
        words = [part for w in words for part in (apart(w, v) if len(w) > WORD_CHARS else (w,))]
    return words


def joined(words: list[str], v: Vocabulary) -> list[str]:
    crossed, end = set(), 0
    for m in v.inner.finditer("".join(words)):
        low, end = max(m.start() + 1, end), max(end, m.end(1))
        crossed.update(range(low, end))
    out, at = [], 0
    for w in words:
        if at in crossed:
            out[-1].append(w)
        else:
            out.append([w])
        at += len(w)
    return list(map("".join, out))


def apart(word: str, v: Vocabulary) -> list[str]:
    chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(chars)
    crossing = np.zeros(n + 1, np.int64)  # pieces over the place's left side, as differences
    for i, (at, _) in enumerate(matches(chars, np.arange(n, 0, -1), v)):
        crossing[at + 1] += 1
        crossing[at + i + 1] -= 1
    free = np.flatnonzero(np.cumsum(crossing)[:n] == 0).tolist()
    return [word[a:b] for a, b in pairwise([*free, n])]


def own_runs(turns: list[dict[str, np.ndarray]], t: int, d: int, until: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pieces, places) of a document's sample, as runs: up to the branch from its parent, then its own nodes.

    `until` counts the own nodes of this turn; all runs before it stay.
    """
    held = turns[t]
    j = held["index"][d]
    mine = slice(held["low"][j], held["low"][j] + held["nodes"][j])
    own = held["piece"][mine][:until], held["at"][mine][:until]
    if held["parent"][j] < 0:
        return [own]
    return [*own_runs(turns, int(held["parent"][j]), d, int(held["from"][j])), own]


def sample(texts: list[str], keys: np.ndarray, k: int, v: Vocabulary) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k segmentations: (ids, log probability, perturbed value, inclusion probability)."""
    cuts = [parts(t, v) for t in texts]
    flat = list(chain.from_iterable(cuts))
    lattice = remembered(v)
    word = lattice.number(flat)
    sizes = np.array([len(c) for c in cuts], np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)
    numbers = np.concatenate([[0], np.cumsum((lattice.ends[word] - lattice.starts[word] + WORD_CHARS - 1) // WORD_CHARS)])
    occurrence = numbers[:-1] - np.repeat(numbers[ends - sizes], sizes)
    none = np.zeros(len(texts), np.int64)
    out: list[list] = [[] for _ in texts]
    value = -np.log(-np.log(uniform(keys, none, none, 0)))  # perturbed value of the next sample of each document
    start = {"doc": np.arange(len(texts)), "path": none - 1, "node": none, "word": ends - sizes, "at": none, "taken": none, "prefix": np.zeros(len(texts))}
    turns: list[dict[str, np.ndarray]] = []  # the nodes of each turn's samples, by document, with the values of their open branches
    for turn in range(k):
        docs = start["doc"]
        if not len(docs):
            break
        count = ends[docs] - start["word"]  # words from the branch on
        low = np.cumsum(count) - count
        rows = np.repeat(start["word"] - low, count) + np.arange(count.sum())
        first = low if turn else np.zeros(0, np.int64)
        new = draw(lattice, keys[doc[rows]], word[rows], occurrence[rows], 2 * turn + 1, first, start["at"][: len(first)], start["taken"][: len(first)])
        words = rows[new["row"]]
        nodes = np.bincount(np.repeat(np.arange(len(docs)), count)[new["row"]], minlength=len(docs)) if len(rows) else np.zeros(len(docs), np.int64)
        low = np.cumsum(nodes) - nodes
        sums = np.concatenate([[0.0], np.cumsum(new["log"])])
        prefix = sums[:-1] + np.repeat(start["prefix"] - sums[low], nodes)
        log = sums[low + nodes] - sums[low] + start["prefix"]
        in_doc = doc[words]
        u = uniform(keys[in_doc], occurrence[words], new["at"] - lattice.starts[word[words]], 2 * turn + 2)
        with np.errstate(divide="ignore"):
            below = -np.logaddexp(-value[in_doc], np.log(-np.log(u)) - prefix - np.log(new["rest"]))
        below[new["rest"] <= 0] = -np.inf
        new |= {"value": below, "prefix": prefix, "words": words, "docs": docs, "low": low, "nodes": nodes, "parent": start["path"], "from": start["node"]}
        new["piece"] = lattice.piece[new["arc"]]
        new["index"] = np.full(len(texts), -1)
        new["index"][docs] = np.arange(len(docs))
        turns.append(new)
        for j, d in enumerate(docs.tolist()):
            out[d].append((turn, float(log[j]), float(value[d])))
        # the best open branch of each document is where its next sample leaves, or, after the last, the threshold
        value = np.full(len(texts), -np.inf)
        where, node = np.full(len(texts), -1), np.zeros(len(texts), np.int64)
        for t, held in enumerate(turns):
            some = held["nodes"] > 0
            if not some.any():
                continue
            best = np.maximum.reduceat(held["value"], held["low"][some])
            hit = np.flatnonzero(held["value"] == np.repeat(best, held["nodes"][some]))
            at_doc = np.searchsorted(held["low"][some], hit, "right") - 1
            hit = hit[np.concatenate([[True], np.diff(at_doc) > 0])]
            of = held["docs"][some]
            better = best > value[of]
            value[of[better]], where[of[better]], node[of[better]] = best[better], t, hit[better]
        chosen = np.flatnonzero(where >= 0)
        start = {n: np.zeros(len(chosen), float if n == "prefix" else np.int64) for n in start}
        for t, held in enumerate(turns):
            here = np.flatnonzero(where[chosen] == t)
            at = node[chosen[here]]
            j = held["index"][chosen[here]]
            for n, x in (("doc", chosen[here]), ("path", t), ("node", at - held["low"][j]), ("word", held["words"][at]), ("at", held["at"][at]), ("taken", held["taken"][at]), ("prefix", held["prefix"][at])):
                start[n][here] = x
            if turn + 1 < k:
                held["value"][at] = -np.inf
    result = []
    for d, samples in enumerate(out):
        made = []
        for t, log, perturbed in samples:
            runs = own_runs(turns, t, d)
            ids, places = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
            inclusion = 1.0 if value[d] == -np.inf else float(-np.expm1(-np.exp(min(log - value[d], 700.0))))
            made.append((spell(lattice, ids, places, v), log, perturbed, inclusion))
        result.append(made)
    return result


def spell(lattice: Lattice, ids: np.ndarray, places: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Ids, with those of its bytes for every character that has no piece."""
    wide = np.flatnonzero(ids < 0)
    if len(wide):
        own = [[v.bytes[b] for b in chr(int(lattice.chars[places[i]])).encode("utf-8", "surrogatepass")] for i in wide]
        parts, at = [], 0
        for i, more in zip(wide.tolist(), own, strict=True):
            parts += [ids[at:i], np.array(more)]
            at = i + 1
        ids = np.concatenate([*parts, ids[at:]])
    return ids.astype("<u4")


def decode(ids: list[int], v: Vocabulary) -> str:
    """The text whose segmentation this is."""
    if v.wide.isdisjoint(ids):
        return "".join(map(v.text_of.__getitem__, ids))[1:]
    out, at = [], 0
    while at < len(ids):
        end = at
        while end < len(ids) and ids[end] in v.byte_of:
            end += 1
        out.append(bytes(map(v.byte_of.__getitem__, ids[at:end])).decode("utf-8", "replace") if end > at else v.text_of[ids[at]])
        at = max(end, at + 1)
    return "".join(out)[1:]


def segmentations(docs: DataFrame, path: str, k: int, key: Column | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, sample (from 1, by falling perturbed value), n_pieces, ids_crc32, log_prob, perturbed, inclusion, exact
    and, with `with_ids`, ids: up to k different segmentations of every row's whole text.

    `exact` tells that decoding gave the text back. Noise depends on `key` (doc_id, by default) only, so repeated rows
    get the same samples. A null or empty text has one segmentation, the empty one. Other columns are ignored.
    """

    def rows(batches):
        v = vocabulary(path)
        for batch in batches:
            ids_, texts, keys = (batch.column(c).to_pylist() for c in ("doc_id", "text", "key"))
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= BATCH_CHARS):
                    chars += len(texts[end])
                    end += 1
                got = sample(texts[at:end], np.array(keys[at:end], np.int64).view(np.uint64), k, v)
                flat = [(d, i + 1, s, t) for d, t, samples in zip(ids_[at:end], texts[at:end], got, strict=True) for i, s in enumerate(samples)]
                arrays = {
                    "doc_id": pa.array([d for d, *_ in flat], pa.int64()),
                    "sample": pa.array([i for _, i, *_ in flat], pa.int32()),
                    "n_pieces": pa.array([len(s[0]) for _, _, s, _ in flat], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(s[0].tobytes()) for _, _, s, _ in flat], pa.int64()),
                    "log_prob": pa.array([s[1] for _, _, s, _ in flat], pa.float64()),
                    "perturbed": pa.array([s[2] for _, _, s, _ in flat], pa.float64()),
                    "inclusion": pa.array([s[3] for _, _, s, _ in flat], pa.float64()),
                    "exact": pa.array([decode(s[0].tolist(), v) == t for _, _, s, t in flat], pa.bool_()),
                }
                if with_ids:
                    arrays["ids"] = pa.array([s[0].tolist() for _, _, s, _ in flat], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(arrays)
                at = end

    seed = F.xxhash64(key if key is not None else F.col("doc_id"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), seed.alias("key"))
    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double, exact boolean"
    return slim.mapInArrow(rows, schema + (", ids array<int>" if with_ids else ""))
