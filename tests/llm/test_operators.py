"""The text operators against brute force on small tables, with nulls, empty and repeated rows and odd columns."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from comanda.llm import dedup, html, ngram, packing, pii, quality, sampling, sharding, topk, toxicity
from comanda.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, size string"
LONG = " ".join(f"word{i} and so on" for i in range(6000))
BASE = " ".join(f"w{i}" for i in range(120))
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    BASE,
    BASE,
    BASE.replace("w50 ", "changed "),
    BASE.upper(),
    LONG,
    "a b c a b c a b c\na b c\na b c",
    "mail bob.b@mail.example.com or +1 (988) 555-2485, 42.144.35.254, 4041894974608795",
    "é ▁ ☃ 😀  two  spaces\r\nline",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s", None, 1.5, "x", None) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, None, None, None, None), rows[4]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_statistics(docs):
    for r in quality.statistics(docs).collect():
        t = r["text"] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        at = collections.defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i : i + 3])].append(i)
        covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(3)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected


def test_rules_find_planted_threshold(spark, docs, labels, empty):
    good = " ".join(f"good{i}" for i in range(80))
    rows = [(i, good + (" #" * 30 if i % 3 == 0 else f" x{i}")) for i in range(300)]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)], "doc_id long, quality int")
    judged, rules = quality.quality_table(planted, marks)
    assert rules and all(r["kept"] == (r["doc_id"] % 3 != 0) for r in judged.collect())
    assert sorted(r["doc_id"] for r in quality.keep_quality(planted, marks).collect()) == [i for i in range(300) if i % 3]
    assert quality.keep_quality(docs, labels).columns == docs.columns
    assert quality.quality_table(empty, labels)[0].count() == 0


def test_backoff_scores(docs, empty):
    got = [r for r in ngram.scores(docs, unit=50).collect()]
    texts = [r["text"] for r in docs.collect()]
    words = [(t or "").encode().split() for t in texts]
    c = collections.Counter(tuple(w[i : i + n]) for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1))
    c = {g: k for g, k in c.items() if k >= 2 or len(g) == 1}
    total = sum(map(len, words))

    def score(w, i):
        penalty = 1.0
        for n in range(min(3, i + 1), 0, -1):
            g = tuple(w[i - n + 1 : i + 1])
            if g in c:
                return penalty * c[g] / (c[g[:-1]] if n > 1 else total)
            penalty *= 0.4

    expected = sorted((len(w), round(sum(np.log(score(w, i)) for i in range(len(w))), 6)) for w in words)
    found = sorted((r["n_words"], round(r["log_score"], 6)) for r in got)
    assert np.array(found) == pytest.approx(np.array(expected), abs=1e-5)
    assert ngram.scores(empty).count() == 0


def test_backoff_counts_are_exact(spark):
    # no n-gram of different words occurs twice; among a few million keys, hashes of 43 bits meet
    rows = [(d, " ".join(f"w{d * 2000 + i}" for i in range(2000))) for d in range(1000)]
    got = ngram.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert len(got) == 1000 and all((r["n_by_1"], r["n_by_2"], r["n_by_3"]) == (2000, 0, 0) for r in got)


def test_backoff_keys_are_one_to_one():
    for bits in (2, 31, 42):
        top = 2**bits - 1
        words = np.array([x for t in itertools.product((1, 2, top), repeat=3) for x in t], np.uint64)
        keys = collections.defaultdict(set)
        for at, high, low in ngram.grams(words, np.arange(len(words)), 3, bits):
            n = 2 if len(at) == len(words) - 1 else 3
            for i, k in zip(at.tolist(), zip(high.tolist(), low.tolist(), strict=True), strict=True):
                keys[k].add(tuple(words[i - n + 1 : i + 1].tolist()))
        assert all(len(v) == 1 for v in keys.values())


def test_pages(spark):
    main = "".join(f"<p>Paragraph {i} of the article, long enough to count &amp; more.</p>" for i in range(5))
    page = f"<html><body><nav><a href=x>Menu</a></nav><div class='wrap'><div class='post-12'><h1>Title</h1>{main}</div><div class='comments'><p>{'A comment. ' * 40}</p></div></div><footer>f</footer></body>"
    rows = [(1, "http://a.example.org/1", page), (2, "http://a.example.org/2", page.replace("post-12", "post-7")), (3, None, None), (4, "odd", ""), (5, "x://y/", "plain <b>text")]
    got = {r["page_id"]: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"].startswith("Title\n\nParagraph 0 of the article, long enough to count & more.") and got[1]["text"].count("\n\n") == 5
    assert got[1]["path"] == got[2]["path"] and "post-#" in got[1]["path"]
    assert got[3]["text"] == got[4]["text"] == "" and got[5]["text"] == "plain text"
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("wrap", ["article", "main", "div class='content'"])
@pytest.mark.parametrize("body", ["ul", "table", "quote", "sections"])
def test_pages_keep_the_whole_article(spark, wrap, body):
    parts = [f"Part {i} of the text goes on for some hundred characters so that it is the heavier one of {i}." for i in range(12)]
    held = {
        "ul": "<ul>" + "".join(f"<li>{t}</li>" for t in parts) + "</ul>",
        "table": "<table>" + "".join(f"<tr><td>{t}</td></tr>" for t in parts) + "</table>",
        "quote": "".join(f"<blockquote><p>{t}</p></blockquote>" for t in parts),
        "sections": "".join(f"<section><h2>S</h2><p>{t}</p></section>" for t in parts),
    }[body]
    intro = "An introduction of a few words."
    page = f"<html><body><nav>menu</nav><{wrap}><h1>Title</h1><p>{intro}</p>{held}</{wrap.split()[0]}><footer>f</footer></body></html>"
    rows = [(i, "http://a.example.org/", page) for i in range(2)]
    want = ["Title", intro, *(x for t in parts for x in (["S", t] if body == "sections" else [t]))]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"].split("\n\n") for r in got] == [want, want]


def test_rare_paths_keep_their_votes(spark):
    # one page's scores alone take the wrapper; six others of its template vote for the post, on a host of 2,000 pages too
    text = "Words of the post that fill a line of the page well enough. " * 4
    common = [(i, "http://h.example.org/", f"<html><body><div class='c'><p>{text}</p></div></body></html>") for i in range(2000)]
    rare = f"<html><body><div class='r'><div class='p'><p>{text}</p></div></div></body></html>"
    odd = f"<html><body><div class='r'><p>{text}</p><p>More</p><div class='p'><p>{text}</p></div></div></body></html>"
    few = [(3000 + i, "http://h.example.org/", rare) for i in range(6)] + [(4000, "http://h.example.org/", odd)]
    take = lambda rows: {r["page_id"]: (r["text"], r["path"]) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    small, large = take(few), take(few + common)
    assert small[4000] == large[4000] and large[4000][1].endswith("div.p")


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=24).round(1)], "x") for i in range(300)]
    rows += [rows[50], (400, None, "n"), (450, [1.0, None], "n"), (500, [float("nan")] * 24, "n"), (550, [float("inf")] * 24, "n"), (600, [1.0, 2.0], "d"), (601, [1.0, 1.0], "d"), (None, [0.0] * 24, "z")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4), "id % 50 = 0", 5).collect()
    usable = [(i, np.floor(256 * np.array(v))) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    expected = []
    for n, (i, v) in enumerate(usable):
        if i % 50 == 0:
            best = sorted((-int(v @ w), j) for m, (j, w) in enumerate(usable) if m != n and len(w) == len(v))[:5]
            expected += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_ring(docs, empty):
    for n in (3, 40):
        rows = sharding.assign_shards(docs, n).collect()
        counts = collections.Counter(r["shard"] for r in rows)
        assert len(rows) == docs.count() and max(counts.values()) - min([*counts.values(), *([0] if len(counts) < n else [])]) <= 1
        for s in counts:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    sizes = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}
    assert all(sizes[i] == (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in enumerate(TEXTS))
    assert sharding.assign_shards(empty, 4).count() == 0


def test_more_shards_move_few_keys():
    counts = {c: 10 for c in range(sharding.CELLS)}
    owner = lambda n: {c: s for c, a, _, s, _ in sharding.place(counts, n, 64, sharding.CELLS, 0.2) if a == 0}
    a, b = owner(20), owner(21)
    assert sum(a[c] != b[c] for c in counts) < 0.25 * len(counts)


def test_near_duplicates(docs, empty):
    rows = dedup.classes(docs).collect()
    by = {r["doc_id"]: r["class_id"] for r in rows}
    assert by[4] == by[5] == by[6] == by[7] == 4 and by[0] == by[1] and by[2] != by[3] and by[8] == 8
    kept = dedup.drop_near_duplicates(docs).collect()
    assert len(kept) == len({r["class_id"] for r in rows}) and dedup.drop_near_duplicates(docs).columns == docs.columns
    assert dedup.classes(empty).count() == 0


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    pool = dedup.mix(np.arange(1, 4001, dtype=np.uint64))
    weight = dict(zip(pool.tolist(), rng.choice([0.5, 0.8, 1.0], 4000), strict=True))
    agreed = expected = 0.0
    for i in range(40):
        part = rng.permutation(4000)[:130]
        a, b = np.sort(pool[part[:115]]), np.sort(pool[part[15:]])
        wa, wb = (np.array([weight[x] for x in y.tolist()]) for y in (a, b))
        expected += dedup.similarities([a], [b], [wa], [wb])[0, 0]
        agreed += np.mean(np.frombuffer(dedup.signature(a, wa), "<u4") == np.frombuffer(dedup.signature(b, wb), "<u4"))
    assert abs(agreed - expected) / 40 < 0.04


def test_similarities_match_sets():
    a, b = np.array([1, 2, 3, 9], np.uint64), np.array([2, 3, 4], np.uint64)
    half = {2: 0.5}
    wa, wb = (np.array([half.get(x, 1.0) for x in y.tolist()]) for y in (a, b))
    assert dedup.similarities([a, b], [b], [wa, wb], [wb])[:, 0] == pytest.approx([1.5 / 4.5, 1.0])
    assert dedup.similarities([a], [b], [np.ones(4)], [np.ones(3)])[0, 0] == pytest.approx(2 / 5)


def test_segmentations(docs, empty):
    path = vocabulary("piece_bpe_32k.model")
    v = sampling.vocabulary(path)
    got = sampling.segmentations(docs, path, 3).collect()
    by = collections.defaultdict(dict)
    for r in got:
        by[r["doc_id"]][r["sample"]] = r
        assert r["exact"]
    for i, t in enumerate(TEXTS):
        samples = [by[i][k] for k in sorted(by[i])]
        assert all(sampling.decode(s["ids"], v) == (t or "") for s in samples)
        assert len({tuple(s["ids"]) for s in samples}) == len(samples) and len(samples) == (3 if t and t.strip() else len(samples))
        assert all(a["perturbed"] >= b["perturbed"] for a, b in itertools.pairwise(samples))
    assert sampling.segmentations(empty, path, 2).count() == 0


def test_samples_follow_the_distribution():
    v = sampling.vocabulary(vocabulary("piece_bpe_32k.model"))
    n = 20_000
    got = sampling.sample(["the cat"] * n, sampling.mix(np.arange(n, dtype=np.uint64) * sampling.GOLD), 2, v)
    first, p = collections.Counter(), {}
    pairs = collections.Counter()
    for a, b in got:
        x, y = tuple(a[0]), tuple(b[0])
        first[x] += 1
        pairs[x, y] += 1
        p[x], p[y] = np.exp(a[1]), np.exp(b[1])
    for x, k in first.most_common(3):
        assert abs(k / n - p[x]) < 0.02
    for (x, y), k in pairs.most_common(3):
        assert abs(k / n - p[x] * p[y] / (1 - p[x])) < 0.02


def test_toxicity(spark, docs, labels, empty):
    rng = np.random.default_rng(5)
    words = [f"plain{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 60)) + (" vile nasty vile" if i % 5 == 0 else "") for i in range(900)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(900)], "doc_id long, toxic int")
    model = toxicity.fit(table, marks)
    rows = toxicity.scores(table, model).withColumn("held", toxicity.held_out()).filter("held").collect()
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in rows)
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    # every word of the examples is a feature, and the index gives the nearest of brute force
    assert set(" ".join(texts[i] for i in model.ids).split()) <= model.known.keys()
    for text in (texts[0], texts[1], "plain1 plain2 nothing else", "vile"):
        at, w = model.vector(toxicity.counts(text, model.known))
        brute = np.zeros(len(model.ids))
        for f, q in zip(at, w, strict=True):
            part = slice(model.starts[model.parts[f]], model.starts[model.parts[f + 1]])
            brute[model.example[part]] += q * model.weight[part]
        expected = [i for i in np.lexsort((model.ids, -brute)) if brute[i] > 0][: toxicity.NEIGHBOURS]
        best, scores = model.nearest(at, w)
        assert scores == pytest.approx(brute[expected]) and sorted(brute[best]) == pytest.approx(sorted(brute[expected]))
        assert model.ids[best[0]] not in model.ids[model.nearest(at, w, without=model.ids[best[0]])[0]]
    # document frequencies come from all documents
    assert toxicity.idf(table, {"vile": 0, "absent": 1}) == pytest.approx([math.log(901 / 181) + 1, math.log(901) + 1])
    # a word of few toxic examples is a sign as well
    rare = [t + (f" rare{i % 25}" if i % 5 == 0 else "") for i, t in enumerate(t.replace(" vile nasty vile", "") for t in texts)]
    few = toxicity.fit(spark.createDataFrame([(i, t) for i, t in enumerate(rare)], "doc_id long, text string"), marks)
    assert min(few.score(rare[i])[0] for i in few.ids.tolist() if i % 5 == 0) > max(few.score(rare[i])[0] for i in few.ids.tolist() if i % 5)
    odd = toxicity.fit(docs, labels)
    assert toxicity.scores(docs, odd).count() == docs.count() and toxicity.reject_toxic(docs, odd).columns == docs.columns
    assert toxicity.scores(empty, toxicity.fit(empty, labels)).count() == 0


def test_personal_data(docs, empty):
    model = pii.fit(docs)
    rows = {r["doc_id"]: r for r in pii.digests(docs, model).collect()}
    assert [rows[10][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    masked = {r["doc_id"]: r for r in pii.mask_documents(docs, model).collect()}
    assert masked[10]["text"] == "mail [EMAIL] or [PHONE], [IP], [CARD]" and masked[10]["n_chars"] == len(masked[10]["text"])
    assert masked[0]["text"] is None and masked[8]["text"] == LONG
    assert pii.digests(empty, pii.fit(empty)).count() == 0


@pytest.mark.parametrize("text", ["a@b.c@d.e.f @x.y a@ b@c", "x" * 50 + "@a-b.c-d.", "a@b a.b@c.d-e..f@g.h", ""])
def test_emails_match_the_pattern(text):
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert pii.emails(text) == [m.span() for m in pattern.finditer(text)]


def test_field_finds_other_forms():
    made = [x for i in range(60) for x in pii.examples(f"call +1 ({200 + i}) 555-{1000 + 37 * i} now or mail ab{i}@mail.example.com soon version {i}.0")]
    model = pii.train(pii.training_windows(made, 300))
    _, added = pii.found("please call (415) 555-1234 today", model)
    assert added == [("phone", 12, 26)]
    assert pii.found("chapter 12 on page 7", model) == ([], [])


def test_field_finds_every_rewritten_form_whole():
    names = ["bob", "ann.lee", "first.last", "k9.smith", "info", "sales_team", "x.y.z"]
    domains = ["mail.example.com", "example.org", "dept.uni.ac.uk", "b.co.uk", "shop.example.co.jp"]
    made = []
    for i in range(300):
        mail = f"{names[i % 7]}@{domains[i % 5]}"
        made += pii.examples(f"{'so ' * (i % 9)}write to {mail} about the order, page {i % 50} of it")
        made += pii.examples(f"{'so ' * (i % 7)}call +1 ({200 + i}) 555-{1000 + 37 * i % 9000} now, host 10.{i % 250}.3.{i % 99} is up")
    model = pii.train(pii.training_windows(made, 400))
    for mail in ("bob@mail.example.com", "a@b.co.uk", "first.last@dept.uni.ac.uk"):
        for form, real in pii.rewrites("email", mail):
            text = f"please write to {form} about the order"
            if real:
                assert pii.found(text, model) == ([], [("email", 16, 16 + len(form))]), form
    long = "first.last [at] " + " [dot] ".join(f"part{chr(97 + i)}" for i in range(20)) + " [dot] com"
    a, b = pii.windows(f"write to {long} now", [])[0]
    assert a <= 9 and b >= 9 + len(long)
    w = pii.Window(long)
    assert (0, len(w.atoms)) in {(i, j) for i, j, _ in w.segments}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, with_ids=True).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(TEXTS)}
    for i in ids:
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])[:: 2 if i == 4 else 1]
        assert [x for r in pieces for x in r["ids"]] == ids[i]
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in pieces)
    for _, part in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        part = list(part)
        assert [r["offset"] for r in part] == [0, *itertools.accumulate(r["length"] for r in part[:-1])] and sum(r["length"] for r in part) <= 4096
    assert packing.pack(empty, path).count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(2)
    lengths = np.minimum(4096, rng.lognormal(6.5, 1, 20_000).astype(int) + 1)
    made = packing.plan(dict(collections.Counter(lengths.tolist())))
    assert sum(n for _, n, items, _ in made.runs for _ in items) == len(lengths)
    assert made.sequences <= 1.01 * -(-lengths.sum() // 4096)


def test_nnls_is_optimal():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 3, (8, 20)).astype(float), rng.random(8) * 10
    x = packing.nnls(a, b)
    gradient = a.T @ (a @ x - b)
    assert (x >= 0).all() and gradient.min() > -1e-6 and abs(x @ gradient) < 1e-5


def test_pipeline_keeps_columns(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert corpus_pipeline.STAGES[3][1](spark, docs, small).columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer

    whole, by_word = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), packing.encoder(vocabulary("word_bpe_49k.json"))
    odd = ["Σας ΣΑΣ İstanbul", "a<|endoftext|>, b <|ENDOFTEXT|>.", "don't, it's. x'S! ...! a², ½. é, ́! Å; ﬁ, ǅ!  , x .\x0b, ,\x0b. 12, 3_! _.", "漢字, ไทย่,  x. ẞ? \x1c.\x1fa,", "", "  ", "e ́ a,́ 힣, क़.", "ª, ⅷ. Ⅷ ʰ. Ꭰ, Ა. ŉ, 😀, a😀."]
    for text, got in zip(odd, by_word.encode(odd), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
