"""Exact repeats against brute force, with copies, shared passages and odd rows."""

import hashlib
import re

import numpy as np
import pytest
from compare import compare, duck

from comanda.llm import repeats
from comanda.llm.queries import QUERIES, SQL


def brute(rows):
    """(doc_id, n_words, n_removed, kept_sha256) of every (doc_id, text)."""
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, split, strict=True):
        for at in range(len(w) - 49) if i is not None else ():
            k = tuple(w[at : at + 50])
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = {at + x for at in range(len(w) - 49) if i is not None and first[tuple(w[at : at + 50])] < i for x in range(50)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = np.random.default_rng(1)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(1 << 40, size=n))
    passages = [fresh(n) for n in (49, 50, 51, 73, 200)]
    rows = [(None, None), (0, None), (1, ""), (2, " \t\n"), (3, "one é ☃"), (None, passages[4])]
    # every alignment of a passage to the blocks, on both sides
    rows += [(10 + k, f"{fresh(k)} {passages[k % 5]}\n\n{fresh(30)}") for k in range(60)]
    rows += [(100 + k, f"{passages[4]} {fresh(k % 3)} {passages[3]}") for k in range(40)]
    copy = fresh(120)
    rows += [(200 + k, copy) for k in range(30)] + [(215, copy), (215, "other " + copy), (199, copy + " end")]
    rows += [(300 + k, " ".join(["same"] * (45 + k))) for k in range(12)]
    rows += [(400 + k, " ".join(["a", "b", "c"] * (10 + k))) for k in range(14)]
    rows += [(500, fresh(3000) + " " + copy), (501, "x\x1cy z " * 60), (502, "x\x1cy z " * 60)]
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, 7, "k") for i, t in rows], "doc_id long, text string, n_words long, h string").repartition(5)
    got = sorted((tuple(r) for r in repeats.remove_repeats(docs).collect()), key=str)
    assert got == brute(rows)
    assert any(r[2] for r in got) and repeats.remove_repeats(docs.limit(0)).count() == 0


def test_small_alphabet(spark):
    # words of which every window is near many others, and blocks tie
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["a", "b"], int(n)))) for i, n in enumerate(rng.integers(40, 400, 40))]
    rows += [(40 + i, rows[i][1][rng.integers(40) * 2 :]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in repeats.remove_repeats(docs).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("seed", range(20))
def test_every_shared_window_has_an_anchor_and_its_probe(seed):
    rng = np.random.default_rng(seed)
    shared = [b"%d" % x for x in rng.integers(1 << 30 if seed % 2 else 3, size=50)]
    before = [[b"x%d" % x for x in rng.integers(99, size=int(n))] for n in rng.integers(0, 40, 2)]
    numbers = repeats.Numbers()
    h = [repeats.rolling(numbers.of(b + shared + b[:7]), repeats.BLOCK) for b in before]
    own = repeats.anchors(h[0], np.arange(0, len(h[0]), repeats.BLOCK))
    inside = {int(a) - len(before[0]) for a in own if 0 <= a - len(before[0]) <= 50 - repeats.BLOCK}
    sent = {int(a) - len(before[1]) for a in repeats.anchors(h[1])}
    assert inside & sent


def test_sql(spark, small):
    name = "op13_substring_dedup"
    assert compare(QUERIES[name](spark, small), duck(small), SQL[name]) == []
