"""What the driver and a worker hold of large things."""

import os

import numpy as np

from comanda.llm import ngram, sampling, toxicity
from comanda.llm.queries import vocabulary


def test_the_driver_holds_postings_only(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 5} " + ("vile" if i % 3 == 0 else "kind")) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert not toxicity.PREPARED & vars(model).keys()
    assert (model.example.dtype, model.weight.dtype, model.offsets.dtype) == (np.int32, np.float32, np.int32)
    # postings in the order of features and examples, and of length 1 by example
    order = np.repeat(np.arange(len(model.weights)), np.diff(model.offsets)) * len(model.ids) + model.example
    assert (np.diff(order) > 0).all()
    has = np.bincount(model.example, np.square(model.weight.astype(float)), len(model.ids))
    assert np.allclose(has, 1, atol=1e-6) and model.score("vile")[0] > model.score("kind")[0]
    assert toxicity.PREPARED <= vars(model).keys()


def test_numbering_leaves_no_units_behind(spark):
    docs = spark.createDataFrame([(i, f"a{i % 3} b c a{i % 5}") for i in range(50)], "doc_id long, text string")
    made = []
    keep, ngram.units = ngram.units, lambda *a: made.append(keep(*a)) or made[-1]
    try:
        rows = ngram.scores(docs, unit=40)
    finally:
        ngram.units = keep
    folders = {f.removeprefix("file:").rsplit("/", 1)[0] for f in made[0].inputFiles()}
    assert folders and not any(os.path.exists(f) for f in folders) and rows.count() == 50


def test_places_take_four_bytes():
    high, low, at = ngram.distinct(np.array([0, 1, 0, 1], np.uint64), np.array([5, 5, 5, 4], np.uint64))
    assert (high.tolist(), low.tolist(), at.tolist(), at.dtype) == ([0, 1, 1], [5, 4, 5], [0, 2, 0, 1], np.int32)


def test_a_worker_keeps_postings_narrow_and_words_with_beginnings_only(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 5} " + ("vileness" if i % 3 == 0 else "kindness")) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(model.rows) and (model.example.dtype, model.weight.dtype, model.starts.dtype) == (np.int32, np.float32, np.int32)
    assert model.known.begun == {"vile"} and not model.known.met
    # words whose beginnings are no features are not remembered, whether known or not
    keys, times, more = model.known.found(["vilest kindness unheard of", None, "vileness vileness"])
    assert set(model.known.met) == {"vilest", "vileness"}
    names = {i: f for f, i in model.known.items()}
    got = {(k // len(names), names[k % len(names)]): n for k, n in zip(keys.tolist(), times.tolist(), strict=True)}
    assert got == {(0, "vile-"): 1, (0, "kindness"): 1, (2, "vileness"): 2, (2, "vile-"): 2, (2, "vilen-"): 2, (2, "vilene-"): 2}


def test_lattices_of_words_are_worked_out_once_and_let_go(monkeypatch):
    v = sampling.vocabulary(vocabulary("piece_bpe_32k.model"))
    texts = ["the cat sat on the mat", "", "straße \U0001f600 the▁cat " + "x" * 600, "a cat"]
    keys = sampling.mix(np.arange(4, dtype=np.uint64) * sampling.GOLD)
    built, work = [], sampling.arcs_of
    monkeypatch.setattr(sampling, "arcs_of", lambda words, *a: built.extend(words) or work(words, *a))
    monkeypatch.setattr(sampling, "_LATTICES", {})
    plain = lambda samples: [[(ids.tolist(), *x) for ids, *x in s] for s in samples]
    at_once = plain(sampling.sample(texts, keys, 3, v))
    again = plain(s for i in range(4) for s in sampling.sample(texts[i : i + 1], keys[i : i + 1], 3, v))
    assert len(built) == len(set(built)) == len({w for t in texts for w in sampling.cut(t)})
    monkeypatch.setattr(sampling, "REMEMBERED", 0)
    alone = plain(s for i in range(4) for s in sampling.sample(texts[i : i + 1], keys[i : i + 1], 3, v))
    assert [[s[0] for s in x] for x in at_once] == [[s[0] for s in x] for x in again] and again == alone
    assert sampling.remembered(v).places == 0 and all(sampling.decode(s[0], v) == t for t, x in zip(texts, alone, strict=True) for s in x)
    # an arc for every piece that fits and one for every character, whose probabilities add up
    lattice = sampling.Lattice(v)
    lattice.number(["▁the", "▁Ωq"])
    log, _ = lattice.dense(np.arange(lattice.places))
    assert lattice.places == 7 and np.allclose(np.exp(log).sum(axis=1), 1) and (np.diff(lattice.first[:8]) >= 1).all()
