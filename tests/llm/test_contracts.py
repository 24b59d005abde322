"""The registered queries against their SQL, and the pipeline against its stages one by one."""

import collections
import zlib

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from comanda.llm import dedup, packing, pii, quality, sharding, toxicity
from comanda.llm.queries import QUERIES, SQL, vocabulary


@pytest.mark.parametrize("name", ["op2_lm_scoring", "op4_topk"])
def test_sql(spark, small, name):
    assert compare(QUERIES[name](spark, small), duck(small), SQL[name]) == []


def test_the_pipeline_is_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def kept(df):
        assert df.columns == columns
        return {r["doc_id"]: r["text"] for r in df.collect()}

    stages = [f for _, f in corpus_pipeline.STAGES]
    model = toxicity.fit(docs, labels)
    one = stages[0](spark, docs, small)
    assert kept(one) == {i: t for i, t in texts.items() if model.score(t)[0] < toxicity.REJECT_FROM}
    two = stages[1](spark, one, small)
    judged, _ = quality.quality_table(one, labels)
    assert kept(two) == {r["doc_id"]: texts[r["doc_id"]] for r in judged.filter("kept").collect()}
    three = stages[2](spark, two, small)
    classes = collections.defaultdict(list)
    for r in dedup.classes(two).collect():
        classes[r["class_id"]].append(r["doc_id"])
    left = kept(three)
    assert len(left) == len(classes) and all(len(left.keys() & set(c)) == 1 for c in classes.values())
    four = stages[3](spark, three, small)
    field = pii.fit(three)
    assert kept(four) == {i: None if t is None else pii.mask(t, sum(pii.found(t, field), [])) for i, t in left.items()}
    pieces = stages[4](spark, four, small).collect()
    ran = corpus_pipeline.run(spark, small).collect()
    of = lambda rows: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert of(ran) == of(pieces) and {r["doc_id"] for r in ran} == left.keys()
    whole = collections.Counter()
    for r in ran:
        whole[r["doc_id"]] += r["length"]
    ids = packing.encoder(vocabulary("word_bpe_49k.json"))
    masked = kept(four)
    some = sorted(masked)[:20]
    for i, got in zip(some, ids.encode([masked[i] or "" for i in some]), strict=True):
        assert whole[i] == len(np.frombuffer(got, "<u4")) + 1


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_bounded_ring_against_a_plain_walk(slack):
    rng = np.random.default_rng(1)
    counts = {int(c): int(n) for c, n in zip(rng.permutation(sharding.CELLS)[:300], rng.zipf(1.4, 300).clip(1, 900), strict=True)}
    got = collections.defaultdict(dict)
    for cell, start, end, shard, _ in sharding.place(counts, 7, 64, sharding.CELLS, slack):
        got[cell] |= dict.fromkeys(range(start, end), shard)
    # key by key: first every key to its owner while there is room, then what is over clockwise to the next with room
    nodes = sharding.ring_nodes(7, 64, sharding.CELLS)
    free = sharding.bounds(sum(counts.values()), 7, slack)
    want, over = collections.defaultdict(dict), []
    for cell in sorted(counts):
        at = next((i for i, n in enumerate(nodes) if n[0] >= cell), 0)
        for key in range(counts[cell]):
            if free[nodes[at][1]]:
                free[nodes[at][1]] -= 1
                want[cell][key] = nodes[at][1]
            else:
                over.append((cell, key, at))
    for cell, key, at in over:
        while not free[nodes[at][1]]:
            at = (at + 1) % len(nodes)
        free[nodes[at][1]] -= 1
        want[cell][key] = nodes[at][1]
    assert got == want and over


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_against_all_pairs(spark, monkeypatch, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(25):
        base = list(rng.choice(words, 120))
        for _ in range(int(rng.integers(1, 5))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = str(rng.choice(words))
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    shingles = [collections.Counter(tuple(t.split()[i : i + 5]) for i in range(116)) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sure = []
    for i in range(len(texts)):
        for j in range(i):
            both, either = sum((shingles[i] & shingles[j]).values()), sum((shingles[i] | shingles[j]).values())
            if both >= 0.8 * either:
                parent[root(i)] = root(j)
                sure.append((i, j))
    want = collections.defaultdict(set)
    for i in range(len(texts)):
        want[root(i)].add(i)

    def classes():
        got = collections.defaultdict(set)
        for r in dedup.classes(docs).collect():
            got[r["class_id"]].add(r["doc_id"])
        return sorted(map(sorted, got.values()))

    assert len(sure) > 10 and classes() == sorted(map(sorted, want.values()))
    # blocks of a few rows give the same
    monkeypatch.setattr(dedup, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(dedup, "BLOCK_ELEMENTS", 500)
    assert classes() == sorted(map(sorted, want.values()))


def test_base_patterns_against_plain_expressions():
    import re

    rng = np.random.default_rng(3)
    alphabet = list("0123456789" * 3 + " .-+()@a\n") + ["4111111111111111", "+1 (415) 555-1234", "10.0.0.7", "192.168.1.1"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet, 60))
        want = []
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(x) <= 255 for x in m[0].split(".")):
                want.append(("ip", *m.span()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = [int(c) for c in m[0] if c.isdigit()]
            doubled = [x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d))]
            if 13 <= len(d) <= 19 and sum(doubled) % 10 == 0:
                want.append(("card", *m.span()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                want.append(("phone", *m.span()))
        assert sorted(s for s in pii.base_spans(text) if s[0] != "email") == sorted(want)


def test_sizes_and_hashes_of_shards(spark, small):
    rows = QUERIES["op5_sharding"](spark, small).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]])) for r in rows)


def test_idf_counts_every_shingle_over_leading_texts(spark, monkeypatch):
    # units of few shingles and many partitions, copies, repeated rows and a null; all but exact copies lead
    monkeypatch.setattr(dedup, "UNIT_ELEMENTS", 60)
    monkeypatch.setattr(dedup, "PARTITION_KEYS", 100)
    rng = np.random.default_rng(5)
    texts = [" ".join(str(x) for x in [*rng.integers(5000, size=20), *range(i % 3 * 10), *["again"] * (i % 7)]) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(0, texts[0])] * 3 + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = docs.select("doc_id", "text", *dedup.text_keys(F.col("text")))
    of_key = {(r["k1"], r["k2"]): r["text"] or "" for r in keyed.collect()}
    out, of = dedup.sketched(docs, keyed.select("k1", "k2").distinct())
    got = out.collect()
    assert of == len(got) == 61
    every = collections.Counter(s for t in set(of_key.values()) for s in set(dedup.shingles(t).tolist()))
    assert max(every.values()) == 40
    for r in got:
        s = np.unique(dedup.shingles(of_key[r["k1"], r["k2"]]))
        n = np.ones(len(s), np.int64)
        places, counts = np.frombuffer(r["often"], "<u4").reshape(2, -1)
        n[places] = counts
        assert n.tolist() == [every[x] for x in s.tolist()]
    assert dedup.weight(np.array([1, 7, 49]), 49) == pytest.approx([1.0, 0.75, 0.5])


def test_a_passage_of_one_text_in_forty_weighs_less(spark):
    # 10 of 400 texts share 82% of their shingles but none is in more than 5% of all texts
    common = [f"c{i}" for i in range(94)]
    texts = [" ".join([*common, *(f"u{i}x{j}" for j in range(10))]) if i < 10 else " ".join(f"w{i}x{j}" for j in range(30)) for i in range(400)]
    nodes = spark.createDataFrame([(i, i, i, None, t) for i, t in enumerate(texts)], "doc_id long, node long, rep_doc long, plain binary, text string")
    docs = nodes.select("doc_id", "text")
    keyed = nodes.select("node", "rep_doc", *dedup.text_keys(F.col("text")))
    out, of = dedup.sketched(docs, keyed)  # all lead
    held = dedup._elements_of(docs, keyed.join(out, ["k1", "k2"]), keyed.filter("node < 2").select("node"), of).collect()
    s, w = [np.frombuffer(r["s"], np.uint64) for r in held], [np.frombuffer(r["w"]) for r in held]
    plain = dedup.similarities(s[:1], s[1:], [np.ones(len(s[0]))], [np.ones(len(s[1]))])[0, 0]
    light = 1 - np.log(10) / np.log(400) / 2
    assert plain == pytest.approx(90 / 110) and dedup.similarities(s[:1], s[1:], w[:1], w[1:])[0, 0] == pytest.approx(90 * light / (90 * light + 20)) and 90 * light / (90 * light + 20) < 0.8
