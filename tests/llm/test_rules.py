"""Decision lists of several rules and conditions."""

from comanda.llm import pii, quality

WORDS = " ".join(f"good{i}" for i in range(80))


def test_a_list_of_two_rules(spark):
    # one kind of bad text is full of symbols, another of capitals
    tails = ["#{}", "LOUD{}", "calm{}", "still{}"]
    rows = [(i, WORDS + "".join(" " + tails[i % 4].format(k) for k in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 > 1)) for i in range(400)], "doc_id long, quality int")
    judged, rules = quality.quality_table(docs, marks)
    assert len(rules) >= 2 and all(r["kept"] == (r["doc_id"] % 4 > 1) for r in judged.collect())
    assert sorted(r["doc_id"] for r in quality.keep_quality(docs, marks).collect()) == [i for i in range(400) if i % 4 > 1]


def test_a_rule_of_two_conditions_and_ties(spark):
    # bad only where both symbols and capitals occur; many rows tie
    rows = [(i, WORDS + " #" * (30 if i % 2 else 0) + " LOUD LOUDER" * (10 if i % 4 > 1 else 0) + " x y") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 != 3)) for i in range(400)], "doc_id long, quality int")
    judged, rules = quality.quality_table(docs, marks)
    assert [len(r) for r in rules] == [2] and all(r["kept"] == (r["doc_id"] % 4 != 3) for r in judged.collect())


def test_the_first_rule_that_holds_is_named(spark):
    a, b = (quality.Condition("symbols_per_word", 0, t, True) for t in (0.5, 0.1))
    stats = spark.createDataFrame([(1.0, 10), (0.2 * 10, 10), (9.0, 10), (0.0, 10)], "n_symbols double, n_words long")
    got = stats.select("n_symbols", quality.verdict([(a,), (b,), (b, a)]).alias("rule")).collect()
    assert {r["n_symbols"]: r["rule"] for r in got} == {1.0: None, 2.0: b.text(), 9.0: a.text(), 0.0: None}


def test_long_digit_runs_are_no_address(spark):
    long = "host 1.2.3." + "4" * 5000 + " and 10.0.0." + "0" * 5000 + "7"
    assert [s[0] for s in pii.base_spans(long)] == ["ip"]
    docs = spark.createDataFrame([(1, long), (2, "9" * 5000)], "doc_id long, text string")
    model = pii.fit(docs)
    assert pii.digests(docs, model).count() == 2
    assert {r["doc_id"]: r["text"] for r in pii.mask_documents(docs, model).collect()}[1].count("[IP]") == 1
