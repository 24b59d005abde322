"""Periodic runs against brute force over all periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from comanda.llm import runs
from comanda.llm.queries import QUERIES


def brute(words, least=runs.LEAST, times=runs.TIMES):
    """Maximal stretches of every period, smallest periods first; a stretch found with a smaller one is left out."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(least, times * q) and (start, end) not in seen:
                seen.add((start, end))
                out.append((start, end - start, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(rng, kind):
    n = int(rng.integers(0, 160))
    if kind == 0:
        return [b"%d" % x for x in rng.integers(2, size=n)]
    if kind == 1:  # Fibonacci words have many runs
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    out = []
    while len(out) < n:
        part = [b"%d" % x for x in rng.integers(4 if kind == 2 else 10**9, size=int(rng.integers(1, 15)))]
        out += (part * 12)[: int(rng.integers(1, 60))]
    return out


@pytest.mark.parametrize("kind", range(4))
def test_runs_against_brute_force(kind):
    rng = np.random.default_rng(kind)
    for _ in range(60):
        words = words_of(rng, kind)
        assert runs.find_runs(words) == brute(words)
        assert runs.find_runs(words, 2, 2) == brute(words, 2, 2)
        assert runs.find_runs(words, 10, 3) == brute(words, 10, 3)


def test_tree_gives_suffix_order_and_extensions():
    rng = np.random.default_rng(9)
    for size in (1, 2, 3, 40, 200):
        s = rng.integers(3, size=size).tolist()
        tree = runs.SuffixTree(s)
        assert tree.tour()[0].tolist() == sorted(range(size + 1), key=lambda i: [*s[i:], -1])
        assert tree.tour(falling=True)[0].tolist() == sorted(range(size + 1), key=lambda i: [*(-x for x in s[i:]), -9])
        a, b = np.array([(i, j) for i in range(size + 1) for j in range(size + 1) if i != j]).T
        common = [next((k for k in range(size) if [*s, -1][i + k] != [*s, -1][j + k]), 0) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        assert runs.Extensions(tree)(a, b).tolist() == common


def test_long_periodic_text_is_linear():
    words = [b"%d" % (i % 7) for i in range(60_000)] + [b"%d" % i for i in range(60_000)]
    assert runs.find_runs(words) == [(0, 60_000, 7)]


def expected(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = sorted(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1] or [(None,) * 3]
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *best[0], 1000 * best[0][1] // best[0][2] if found else None, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(x.decode() for x in words_of(rng, i % 4))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, "a " * 40), (903, "é ☃ " * 30), (903, "é ☃ " * 30), (904, "z\x1c y\x0b" * 20)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start long, runs string").repartition(3)
    got = sorted((tuple(r) for r in runs.digests(docs).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in rows), key=str)
    assert any(r[1] > 1 for r in got) and runs.digests(docs.limit(0)).count() == 0


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, small).collect()}
    some = [i for i in docs if len((docs[i] or "").split()) < 800]
    assert len(got) == len(docs) and len(some) > 100 and all(got[i] == expected(i, docs[i]) for i in some)
