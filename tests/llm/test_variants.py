"""Spelling variants against all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from comanda.llm import variants
from comanda.llm.queries import QUERIES


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute_groups(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def brute_vocabulary(rows):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def made(rng, letters, n):
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters, int(rng.integers(7, 12))))
        for _ in range(3):
            words.add(w)
            k = int(rng.integers(len(w)))
            w = [w[:k] + w[k + 1 :], w[:k] + str(rng.choice(letters)) + w[k + 1 :], w[:k] + str(rng.choice(letters)) + w[k:]][int(rng.integers(3))]
            if len(w) < 7:
                break
    return sorted(words)


def test_index_ranks_suffixes():
    words = ["banana", "anan", "nab", "éa", "a"]
    index = variants.Index(words)
    for w in ("ana", "a", "an", "ab", "x", "éa"):
        low, high = 0, index.delimiters
        for c in index.codes(np.array([ord(c) for c in reversed(w)])):
            low, high = (int(index.step(np.array([c]), np.array([x]))[0]) for x in (low, high))
        assert sorted(index.word_of[low:high].tolist()) == [i for i, v in enumerate(words) if v.endswith(w)]


@pytest.mark.parametrize("letters", [["a", "b"], ["a", "b", "c", "é", "ÿ"], [chr(97 + i) for i in range(26)]])
def test_near_words_against_all_pairs(letters):
    rng = np.random.default_rng(len(letters))
    words = made(rng, letters, 150)
    for right in (True, False):
        turn = (lambda w: w) if right else (lambda w: w[::-1])
        exact = np.array([len(w) - len(w) // 2 if right else len(w) // 2 for w in words])
        a, b = variants.near(variants.Index([turn(w) for w in words]), [turn(w) for w in words], exact)
        want = {(i, j) for i, w in enumerate(words) for j, v in enumerate(words) if one_edit(w, v) and turn(v).endswith(turn(w)[-exact[i] :])}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) >= want
        assert all(one_edit(words[i], words[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True))


@pytest.mark.parametrize("part_words", [20_000, 7])
def test_groups(spark, part_words):
    rng = np.random.default_rng(8)
    words = made(rng, ["a", "b", "c"], 150) + made(rng, [chr(97 + i) for i in range(26)], 150) + ["z" * 3000, "z" * 2999]
    counts = {w: int(10 ** rng.integers(0, 5)) * int(rng.integers(2, 5)) for w in words}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in variants.groups(vocab, part_words=part_words).collect())
    assert got == brute_groups(counts)
    # chains of several forms
    assert any(f and r != f for _, f, r, *_ in got)


def test_rows_of_every_kind(spark):
    rng = np.random.default_rng(3)
    pool = made(rng, ["a", "b", "c", "d", "é"], 120)
    texts = [" ".join(rng.choice(pool, 200, p=(w := 1 / np.arange(1, len(pool) + 1)) / w.sum())) for _ in range(60)]
    texts += [None, "", "1234567 !!", "ABCDEFG abcdefg Abcdefg", "ÉÉÉabcd éééabcd ××××××× " * 2, "x" * 5000 + " " + "x" * 5000]
    rows = [*enumerate(texts), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, 5, "w") for i, t in rows], "doc_id long, text string, n long, word string").repartition(3)
    got = sorted(tuple(r) for r in variants.document_groups(docs).collect())
    assert got == brute_groups(brute_vocabulary(rows)) and any(r[4] for r in got)
    assert variants.document_groups(docs.limit(0)).count() == 0
    assert variants.document_groups(spark.createDataFrame([(None, "abcdefgh abcdefgh")], "doc_id long, text string")).count() == 1


def test_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r["word"]: tuple(r) for r in QUERIES["op11_spelling_variants"](spark, small).collect()}
    counts = brute_vocabulary(rows)
    assert {w: r[3] for w, r in got.items()} == counts
    some = sorted(counts)[:: max(1, len(counts) // 300)]
    for w in some:
        vs = [v for v in counts if one_edit(w, v)]
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        assert got[w][4] == len(vs)
        assert got[w][1] == (best if best is not None and counts[best] >= 10 * counts[w] else None)
