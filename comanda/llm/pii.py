"""Personal data: base patterns, and a semi-Markov conditional random field for what is written otherwise.

The base patterns' spans always stay. Around digits, @ signs and spelled-out @ signs outside of them, the text is cut
into atoms (runs of letters, runs of digits, single other characters). A candidate segment is a run of at most
`MOST_ATOMS` atoms; whole-span features (grouping of digits, separators, checksum, domain ending, neighbours) score it
for every kind. A dynamic program over the atoms chooses boundaries and kinds jointly.

The field is fitted on windows of a bounded sample of documents: base spans as they are and rewritten in other common
forms are positive, rewritten into invalid ones and all other digits are negative. Every document is searched whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import slices
from comanda.session import materialise

KINDS = ("email", "ip", "card", "phone")

# Documents whose windows may be learned from, windows learned from, and passes over them.
SAMPLE_DOCS, SAMPLE_WINDOWS, PASSES = 2000, 400, 8
# Stretches of one text that may be learned from.
PER_TEXT = 30
MOST_ATOMS = 24
# Longer segments of an address are all tried up to so many; an address of 64 + 253 characters has fewer. Beyond it, those
# that have the address's whole left or whole right side.
ADDRESS_SEGMENTS = 10_000
# Longer spans than this don't stay in the features' cache.
KEPT_SPAN = 200
# How much better than none a found span's score must be.
MARGIN = 2.0
# How much worse a span is that breaks off an address at a spelled-out dot.
CUT = 4.0

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]+")

SPELLED_AT = re.compile(r"[\[({]\s*at\s*[\])}]|\sat\s(?=\S+\s(?:dot|punkt|punto|point)\s)", re.I)
# What stands for a dot between two labels, and the labels before and after an at.
DOT = r"(?:\.|[^\S\n]*[\[({][^\S\n]*(?:dot|punkt|punto|point|\.)[^\S\n]*[\])}][^\S\n]*|[^\S\n]+(?:dot|punkt|punto|point|\.)[^\S\n]+)"
TAIL = re.compile(rf"[^\S\n]*[\w-]+(?:{DOT}[\w-]+)*", re.I)
DOT_ANY = re.compile(DOT, re.I)
DOT_ON = re.compile(rf"(?!\.){DOT}\w", re.I)
DOT_BACK = re.compile(rf"[\w%+-]{DOT}\Z", re.I)
AT = re.compile(f"@|{SPELLED_AT.pattern}", re.I)
LONGEST_DOT = 40
ATOM = re.compile(r"[^\W\d_]+|[0-9]+|[^\S\n]+|.", re.S)
ANCHOR = re.compile(r"[0-9]+|@")
CUES = {"tel", "phone", "call", "fax", "mobile", "cell", "telefon", "card", "visa", "credit", "ip", "host", "server", "mail", "email", "contact", "password", "token", "key", "version", "id"}


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octet(s: str) -> bool:
    """Whether a run of digits, of any length, is at most 255."""
    s = s.lstrip("0")
    return len(s) <= 3 and int(s or 0) <= 255


def luhn(digits: str) -> bool:
    odd = [int(c) for c in reversed(digits)]
    return sum(odd[::2] + [d * 2 - 9 * (d > 4) for d in odd[1::2]]) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern, found from the @ signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans, by kind and start. A failing match is dropped and not tried again."""
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(octet, m[0].split(".")))]
        out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def reach(text: str, a: int, b: int) -> tuple[int, int]:
    """From where to where an address may go around the at that is text[a:b]: labels with dots, written or spelled out."""
    start = a
    while start and text[start - 1].isspace() and text[start - 1] != "\n":
        start -= 1
    while start:
        label = start
        while label and (text[label - 1] in LOCAL or text[label - 1].isalnum()):
            label -= 1
        if label == start:
            break
        start = label
        low = max(0, start - LONGEST_DOT)
        m = DOT_BACK.search(text[low:start])
        if not m:
            break
        start = low + m.start() + 1
    m = TAIL.match(text, b)
    return start, m.end() if m else b


def bucket(n: int) -> str:
    return next((f"<{b}" for b in (1, 4, 7, 8, 9, 12, 13, 16, 17, 20) if n < b), "20+")


@lru_cache(maxsize=50_000)
def segment_features(span: str, left: str, right: str, cue: str) -> tuple[str, ...]:
    """Features of a whole candidate span and its neighbours."""
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    letters = sum(c.isalpha() for c in span)
    separators = "".join(sorted({c for c in span if not c.isalnum()}))
    spelled = bool(SPELLED_AT.search(span))
    out = [
        f"digits{bucket(len(digits))}",
        f"letters{bucket(letters)}",
        f"separators{separators if len(separators) <= 4 else 'many'}|{letters > 0}",
        f"left{left}",
        f"right{right}",
        f"cue{cue}",
    ]
    if not letters:
        out.append("groups" + ("-".join(str(len(g)) for g in groups) if len(groups) <= 6 else "many"))
        if 13 <= len(digits) <= 19:
            out.append(f"luhn{luhn(digits)}")
        if len(groups) == 4:
            out.append(f"octets{all(map(octet, groups))}|{len(set(re.findall(r'[^0-9]+', span))) == 1}")
    at = "@" in span or spelled
    out.append(f"at{'@' in span}{spelled}")
    if at:
        out.append(f"domain{bool(re.search(r'(?:[.]|[ (\[{]+(?:dot|punkt|punto|point|[.])[ )\]}]+)[A-Za-z]{2,10}$', span))}{len(re.findall('@|' + SPELLED_AT.pattern, span, re.I))}")
        out.append(f"local{bool(re.match(r'[\w.%+-]+ ?(?:@|[ \[({])', span))}{span.count(' ')}")
    elif letters:
        out.append("mixed")
    out.append(f"first{'d' if span[0].isdigit() else 'a' if span[0].isalpha() else span[0]}")
    return tuple(out)


def neighbour(c: str) -> str:
    return "none" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c if c in "=.-_/@:+" else "other"


@dataclass
class Window:
    """A stretch of text cut into atoms; `spans` are the known ones in it, as (kind, start, end)."""

    text: str
    spans: list[tuple[str, int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.ends = [0, *(m.end() for m in ATOM.finditer(self.text))]
        n = len(self.ends) - 1
        atoms = [self.text[a:b] for a, b in zip(self.ends, self.ends[1:], strict=False)]
        special = [bool(ANCHOR.search(a)) for a in atoms]
        for m in SPELLED_AT.finditer(self.text):
            for i in range(n):
                special[i] |= m.start() <= self.ends[i] < m.end() and atoms[i].lower() == "at"
        count = np.concatenate([[0], np.cumsum(special)])
        opens = [a[0].isalnum() or a in "+([" for a in atoms]
        closes = [a[-1].isalnum() for a in atoms]
        self.atoms = atoms
        longer = self._longer(n, opens, closes)
        self.segments: list[tuple[int, int, tuple[str, ...]]] = []
        words = [w for w in re.findall(r"[^\W\d_]+", self.text)]
        cue = next((w.lower() for w in words if w.lower() in CUES), "")
        for i in range(n):
            if not opens[i]:
                continue
            for j in range(i + 1, min(n, i + MOST_ATOMS) + 1):
                if atoms[j - 1] == "\n":
                    break
                if closes[j - 1] and count[j] > count[i]:
                    self._add(i, j, cue)
        for i, j in longer:
            self._add(i, j, cue)
        # an atom outside of spans
        self.outside = [f"o{'at' if '@' in a else 'd' + bucket(len(a)) if s and a[0].isdigit() else 's' if s else ''}" for a, s in zip(atoms, special, strict=True)]

    def _add(self, i: int, j: int, cue: str) -> None:
        a, b = self.ends[i], self.ends[j]
        near = neighbour(self.text[a - 1 : a]), neighbour(self.text[b : b + 1])
        span = self.text[a:b]
        self.segments.append((i, j, (segment_features if len(span) <= KEPT_SPAN else segment_features.__wrapped__)(span, *near, cue)))

    def cuts(self, i: int, j: int) -> bool:
        """Whether a spelled-out dot and a label go on before or after an address from atom i to j."""
        a, b = self.ends[i], self.ends[j]
        return any(a < y and x < b for x, y in self.ats) and bool(DOT_ON.match(self.text, b) or self.text[a - 1 : a] != "." and DOT_BACK.search(self.text[max(0, a - LONGEST_DOT) : a]))

    def _longer(self, n: int, opens: list[bool], closes: list[bool]) -> list[tuple[int, int]]:
        """Segments of more than `MOST_ATOMS` atoms that an address around an at can be."""
        self.ats = [m.span() for m in AT.finditer(self.text)]
        out: set[tuple[int, int]] = set()
        for a, b in self.ats:
            low, high = reach(self.text, a, b)
            first, last = bisect_left(self.ends, low), bisect_right(self.ends, high) - 1
            if last - first <= MOST_ATOMS:
                continue
            starts = [i for i in range(first, bisect_left(self.ends, a)) if opens[i]]
            stops = [j for j in range(bisect_right(self.ends, b), last + 1) if closes[j - 1]]
            if len(starts) * len(stops) > ADDRESS_SEGMENTS:
                tried = [(starts[0], j) for j in stops] + [(i, stops[-1]) for i in starts]
            else:
                tried = [(i, j) for i in starts for j in stops]
            out.update((i, j) for i, j in tried if j - i > MOST_ATOMS)
        return sorted(out)


class Field:
    """Weights by kind and feature; scores, expectations and the best segmentation."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None) -> None:
        self.weights = weights or {}

    def scored(self, w: Window) -> tuple[list[float], list[tuple[int, int, str, float, tuple[str, ...]]]]:
        get = self.weights.get
        outside = [get(("", f), 0.0) for f in w.outside]
        return outside, [(i, j, k, get((k, "bias"), 0.0) + sum(get((k, f), 0.0) for f in fs), fs) for i, j, fs in w.segments for k in KINDS]

    def gradient(self, w: Window) -> dict[tuple[str, str], float]:
        """Observed minus expected features of a window."""
        outside, segments = self.scored(w)
        n = len(outside)
        ending, starting = defaultdict(list), defaultdict(list)
        for s in segments:
            ending[s[1]].append(s)
            starting[s[0]].append(s)
        alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            alpha[j] = logsum([alpha[j - 1] + outside[j - 1], *(alpha[s[0]] + s[3] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            beta[i] = logsum([beta[i + 1] + outside[i], *(beta[s[1]] + s[3] for s in starting[i])])
        out: dict[tuple[str, str], float] = defaultdict(float)
        gold = {(a, b): k for k, a, b in w.spans}
        inside = [any(a <= w.ends[i] < b for _, a, b in w.spans) for i in range(n)]
        for i in range(n):
            out["", w.outside[i]] += (not inside[i]) - math.exp(alpha[i] + outside[i] + beta[i + 1] - alpha[n])
        for i, j, k, score, fs in segments:
            d = (gold.get((w.ends[i], w.ends[j])) == k) - math.exp(alpha[i] + score + beta[j] - alpha[n])
            if abs(d) > 1e-4:
                for f in ("bias", *fs):
                    out[k, f] += d
        return out

    def best(self, w: Window) -> list[tuple[str, int, int]]:
        """The spans of the best segmentation; a span must beat its atoms outside of spans by `MARGIN`, part of an address by `CUT` more."""
        outside, segments = self.scored(w)
        n = len(outside)
        ending = defaultdict(list)
        for s in segments:
            ending[s[1]].append(s)
        top: list[tuple[float, tuple | None]] = [(0.0, None)]
        for j in range(1, n + 1):
            choice: tuple[float, tuple | None] = (top[j - 1][0] + outside[j - 1], None)
            for s in ending[j]:
                if (value := top[s[0]][0] + s[3] - MARGIN) > choice[0] and (value := value - CUT * w.cuts(s[0], s[1])) > choice[0]:
                    choice = (value, s)
            top.append(choice)
        out, j = [], n
        while j:
            s = top[j][1]
            if s:
                out.append((s[2], w.ends[s[0]], w.ends[s[1]]))
            j = s[0] if s else j - 1
        return out[::-1]


def logsum(values: list[float]) -> float:
    top = max(values)
    return top if len(values) == 1 else top + math.log(sum(math.exp(v - top) for v in values))


def windows(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches around digits and @ signs outside of `taken`, never across a taken span or a line end.

    A stretch takes in two words on each side, and all labels of an address; stretches that touch are one.
    """
    if not (ANCHOR.search(text) or SPELLED_AT.search(text)):
        return []
    taken = sorted(taken)
    out: list[list[int]] = []
    t = 0
    marks = sorted([m.span() for m in ANCHOR.finditer(text)] + [m.span() for m in SPELLED_AT.finditer(text)])
    for a, b in marks:
        while t < len(taken) and taken[t][1] <= a:
            t += 1
        if t < len(taken) and taken[t][0] < b:
            continue
        low = max(taken[t - 1][1] if t else 0, out[-1][1] if out else 0, text.rfind("\n", 0, a) + 1)
        high = min(taken[t][0] if t < len(taken) else len(text), (text.find("\n", b) + 1 or len(text) + 1) - 1)
        start = max(low, words_back(text, a, low))
        end = words_on(text, b, high)
        if not text[a].isdigit():
            first, last = reach(text, a, b)
            start = max(low, min(start, first - 1))
            end = max(end, words_on(text, last, high) if DOT_ANY.search(text, b, last) else min(last, high))
        if out and start <= out[-1][1] and "\n" not in text[out[-1][1] : a] and not any(x >= out[-1][1] and x < a for x, _ in taken[max(0, t - 1) : t]):
            out[-1][1] = max(end, out[-1][1])
        elif end > start:
            out.append([start, end])
    return [(a, b) for a, b in out]


def words_back(text: str, at: int, low: int) -> int:
    for _ in range(3):
        cut = text.rfind(" ", low, at)
        if cut < 0 or at - cut > 60:
            return low if at - low <= 60 else at - 60
        at = cut
    return at + 1


def words_on(text: str, at: int, high: int) -> int:
    for _ in range(3):
        cut = text.find(" ", at, high)
        if cut < 0 or cut - at > 60:
            return min(high, at + 60)
        at = cut + 1
    return at - 1


def found(text: str, model: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the spans the field adds, of a whole text."""
    base = base_spans(text)
    added = []
    for a, b in windows(text, merged([(x, y) for _, x, y in base])):
        added += [(k, a + x, a + y) for k, x, y in model.best(Window(text[a:b]))]
    return base, added


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def rewrites(kind: str, s: str) -> list[tuple[str, bool]]:
    """Other ways to write a span: (text, whether it is still personal data)."""
    d = digits_of(s)
    if kind == "phone":
        n, country = d[-10:], d[:-10] or "1"
        a, b, c = n[:3], n[3:6], n[6:]
        return [(f"({a}) {b}-{c}", True), (f"{a}-{b}-{c}", True), (f"{country}-{a}-{b}-{c}", True), (f"{a}.{b}.{c}", True), (f"00{country} {a} {b} {c}", True), (f"({a}) {b} {c}", True), (f"{b}{c[:1]}", False), (f"{a}-{b}", False)]
    if kind == "card":
        four = [d[i : i + 4] for i in range(0, len(d), 4)]
        wrong = d[:-1] + str((int(d[-1]) + 3) % 10)
        return [(".".join(four), True), ("/".join(four), True), ("  ".join(four), True), (wrong, False), (" ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), False), (d[:7], False), (d[:10], False)]
    if kind == "ip":
        p = s.split(".")
        return [("[.]".join(p), True), ("(.)".join(p), True), (" . ".join(p), True), (".".join(p[:3]), False), (".".join(p[:2]), False), (".".join([*p[:3], "999"]), False), (d[:4], False)]
    local, _, domain = s.partition("@")
    spelled = domain.replace(".", " dot ")
    return [(f"{local} [at] {domain}", True), (f"{local}(at){domain}", True), (f"{local} at {spelled}", True), (f"{local} [at] {domain.replace('.', ' [dot] ')}", True), (f"{local} @ {domain}", True), (f"@{local}", False), (f"{local} at {domain.split('.')[0]}", False)]


def examples(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Stretches to learn from in a text: base spans as written and rewritten, and other digits, at most `PER_TEXT`."""
    out = []
    base = base_spans(text)
    n = len(text)
    for i, (kind, a, b) in enumerate(base[:PER_TEXT]):
        left, right = text[words_back(text, a, max(0, a - 40)) : a], text[b : words_on(text, b, min(len(text), b + 40))]
        left, right = left.rpartition("\n")[2], right.partition("\n")[0]
        if DIGIT.search(left + right):
            continue
        forms = rewrites(kind, text[a:b])
        for form, real in [(text[a:b], True), forms[(n + i) % len(forms)], forms[(n + i + 3) % len(forms)]]:
            out.append((left + form + right, [(kind, len(left), len(left) + len(form))] if real else []))
    out += [(text[a:b], []) for a, b in windows(text, merged([(x, y) for _, x, y in base]))]
    return out[:PER_TEXT]


def training_windows(made: list[tuple[str, list[tuple[str, int, int]]]], most: int) -> list[Window]:
    """At most `most` of the stretches, of different shape where there are enough."""
    shaped: dict[str, list] = defaultdict(list)
    for text, spans in made:
        shaped[re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", text))].append((text, spans))
    turns = [x for i in range(max(map(len, shaped.values()), default=0)) for x in (v[i] for v in shaped.values() if len(v) > i)]
    step = max(1, len(shaped) // most)
    chosen = (turns[: len(shaped)][::step] + turns[len(shaped) :])[:most]
    return [w for w in (Window(t, s) for t, s in chosen) if len(w.atoms) <= 60]


def train(made: list[Window], passes: int = PASSES, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Adaptive gradient ascent on the conditional likelihood."""
    model, squares = Field(), defaultdict(float)
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(made)):
            for f, g in model.gradient(made[i]).items():
                g -= decay * model.weights.get(f, 0.0)
                squares[f] += g * g
                model.weights[f] = model.weights.get(f, 0.0) + rate * g / math.sqrt(squares[f] + 1e-8)
    return model


def fit(docs: DataFrame, rows: int = SAMPLE_DOCS, most: int = SAMPLE_WINDOWS) -> Field:
    """Fit on at most `rows` different texts with digits or @ signs, in the order of a hash. None: an empty field."""
    some = docs.select("text").filter(F.col("text").rlike("[0-9@]")).withColumn("key", F.xxhash64("text"))
    keys = materialise(some.select("key").distinct().orderBy("key").limit(rows))  # the bound of what is broadcast
    texts = some.join(F.broadcast(keys), "key").dropDuplicates(["key"])

    def stretches(batches):
        for batch in slices(batches):
            got = [x for t in batch.column("text").to_pylist() for x in examples(t)]
            kinds, starts, ends = ([[s[i] for s in spans] for _, spans in got] for i in range(3))
            yield pa.RecordBatch.from_pydict(
                {"text": pa.array([t for t, _ in got], pa.string()), "kind": pa.array(kinds, pa.list_(pa.string())), "start": pa.array(starts, pa.list_(pa.int32())), "end": pa.array(ends, pa.list_(pa.int32()))}
            )

    got = texts.select("text").mapInArrow(stretches, "text string, kind array<string>, start array<int>, end array<int>").collect()
    return train(training_windows(sorted((r["text"], list(zip(r["kind"], r["start"], r["end"], strict=True))) for r in got), most))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def personal_data(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, base (the base spans), spans (all spans) of every row, each as kind, start, end in code points.

    A null text is empty. Repeated rows are searched each; other columns are ignored.
    """

    def search(batches):
        for batch in slices(batches):
            got = [found(t or "", model) for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            rows = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "base": pa.array([rows(b) for b, _ in got], kind), "spans": pa.array([rows(b + a) for b, a in got], kind)}
            )

    spans = "array<struct<kind: string, start: int, end: int>>"
    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id long, base {spans}, spans {spans}")


def digests(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, number of base spans per kind, hash of the base spans, and all spans as text."""

    def search(batches):
        for batch in slices(batches):
            got = [found(t or "", model) for t in batch.column("text").to_pylist()]
            arrays = {"doc_id": batch.column("doc_id").cast(pa.int64())}
            for k in KINDS:
                arrays[f"n_{k}"] = pa.array([sum(s[0] == k for s in b) for b, _ in got], pa.int64())
            arrays["base_sha256"] = pa.array([hashlib.sha256(digest(b).encode()).hexdigest() for b, _ in got], pa.string())
            arrays["spans"] = pa.array([digest(b + a) for b, a in got], pa.string())
            yield pa.RecordBatch.from_pydict(arrays)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id long, {counts}, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by the kind of its first, in brackets."""
    out, at = [], 0
    kinds = {a: k for k, a, _ in sorted(spans, key=lambda s: -s[2])}
    for a, b in merged([(x, y) for _, x, y in spans]):
        out += [text[at:a], f"[{kinds[a].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, model: Field) -> DataFrame:
    """`docs` with personal data in `text` masked, and `n_chars`, if there, as long as the new text. A null text stays."""

    def put(batches):
        for batch in slices(batches):
            texts = [None if t is None else mask(t, sum(found(t, model), [])) for t in batch.column("text").to_pylist()]
            arrays = {n: batch.column(n) for n in batch.schema.names}
            arrays["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    out = docs.mapInArrow(put, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
