"""Quality rules: a learned decision list of threshold conjunctions over text statistics, all in Spark expressions.

Statistics are DataFrame expressions over the whole text. The list is learned by sequential covering: a rule grows by
the condition with the best information gain on two thirds of the labelled rows, is pruned back to the prefix with the
best precision on the other third, and the rows it covers are set aside before the next one grows; a rule that pruning
rejects is left out and its rows are set aside from growing only. Each step is one aggregate over the labelled statistics (rows per feature and bin), so only bounded counts reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.session import materialise

# The contract's base rules.
MIN_WORDS, MOST_REPEATED = 50, 50

SPACE = " \\t-\\r"
SHARES = (0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 1.0)
FEATURES = {
    "words": "cast(n_words as double)",
    "chars_per_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "distinct_share": "n_distinct / n_words",
    "words_per_line": "n_words / n_lines",
}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_distinct.

    Words are runs of characters other than space and U+0009 to U+000D; a null text has none. Repeated windows are
    found by sorting (window hash, position) as one long per window: the hash keeps the bits the position leaves free.
    """
    out = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("_s", F.expr("btrim(_t, ' \\t\\n\\u000b\\u000c\\r')"))
    out = out.withColumn("_w", F.expr(f"if(_s = '', array(), split(_s, '[{SPACE}]+'))")).withColumn("n_words", F.size("_w").cast("long"))
    out = out.withColumn("_lines", F.expr("filter(split(_t, '\\n'), x -> btrim(x, ' \\t\\n\\u000b\\u000c\\r') != '')"))
    out = out.withColumns(
        {
            "word_chars": F.expr("cast(length(array_join(_w, '')) as bigint)"),
            "n_symbols": F.expr("cast(length(regexp_replace(_t, '[^#*$%&|<>]+', '')) as bigint)"),
            "n_upper": F.expr("cast(length(regexp_replace(_t, '[^\\\\p{Lu}]+', '')) as bigint)"),
            "n_lines": F.expr("cast(size(_lines) as bigint)"),
            "n_dup_lines": F.expr("cast(size(_lines) - size(array_distinct(_lines)) as bigint)"),
            "n_distinct": F.expr("cast(size(array_distinct(_w)) as bigint)"),
            "_bits": F.expr("cast(ceil(log2(n_words + 1)) as int)"),
        }
    )
    out = out.withColumn(
        "_windows",
        F.expr(
            "if(n_words < 3, array(), sort_array(transform(sequence(0, cast(n_words as int) - 3),"
            " i -> shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), _bits) | cast(i as bigint))))"
        ),
    )
    same = "shiftrightunsigned({0}, _bits) = shiftrightunsigned({1}, _bits)"
    out = out.withColumn(
        "_again",
        F.expr(
            f"filter(_windows, (x, i) -> (i > 0 and {same.format('get(_windows, i - 1)', 'x')})"
            f" or (i < n_words - 3 and {same.format('get(_windows, i + 1)', 'x')}))"
        ),
    )
    out = out.withColumn(
        "n_repeat_words",
        F.expr(
            "cast(size(array_distinct(flatten(transform(_again, x -> array(x & (shiftleft(1L, _bits) - 1),"
            " (x & (shiftleft(1L, _bits) - 1)) + 1, (x & (shiftleft(1L, _bits) - 1)) + 2))))) as bigint)"
        ),
    )
    return out.drop("_t", "_s", "_w", "_lines", "_bits", "_windows", "_again")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """`feature` above or at most `threshold`; `cut` is the number of the threshold among the feature's."""

    feature: str
    cut: int
    threshold: float
    above: bool

    def text(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"

    def on_bins(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.on_bins() for c in rule), F.lit(True))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn_rules(
    labelled: DataFrame, bad: str = "bad", key: str = "doc_id", max_rules: int = 8, max_conditions: int = 4, precision: float = 0.95, least: int = 5
) -> list[Rule]:
    """Rules for rejection, in order, from `labelled` statistics with a boolean `bad`.

    `precision` is asked of a pruned rule on the rows kept for pruning, `least` the bad rows it has to cover when
    growing. No labelled or no bad rows: no rules.
    """
    names = list(FEATURES)
    valued = labelled.filter("n_words > 0").select(F.col(key), F.col(bad).alias("bad"), *[F.expr(e).alias(n) for n, e in FEATURES.items()])
    asked = [F.percentile_approx(F.when(F.col("bad") == is_bad, F.col(n)), list(SHARES), 10_000).alias(f"{n}_{is_bad}") for n in names for is_bad in (True, False)]
    found = valued.agg(*asked).first()
    cuts = {}
    for n in names:
        values = sorted({v for is_bad in (True, False) for v in (found[f"{n}_{is_bad}"] or [])})
        cuts[n] = sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:], strict=False))})
    # the bin of a value is the number of thresholds below it
    binned = [F.expr(" + ".join([f"int({n} > {t!r}D)" for t in cuts[n]]) or "0").alias(n) for n in names]
    fold = F.pmod(F.xxhash64(key), F.lit(3)) == 0
    rows = materialise(valued.select("bad", fold.alias("for_pruning"), *binned))

    def counts(covered: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x")
        by = covered.select("bad", pairs).groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
        return {(r["f"], r["b"]): (r["p"], r["n"]) for r in by.collect()}

    def grow(left: DataFrame) -> Rule:
        rule: Rule = ()
        while len(rule) < max_conditions:
            by = counts(left.filter(_all(rule)))
            p0, n0 = (sum(v[i] for (f, _), v in by.items() if f == names[0]) for i in (0, 1))
            best, best_gain = None, 1e-9
            for f in names if p0 >= least and n0 else []:
                p = n = 0
                for cut, threshold in enumerate(cuts[f]):
                    p, n = p + by.get((f, cut), (0, 0))[0], n + by.get((f, cut), (0, 0))[1]
                    for above, (pc, nc) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        gain = _gain(pc, nc, p0, n0) if pc >= least else 0.0
                        # of equal thresholds the one that covers least, to leave unlike rows alone
                        tighter = above and best is not None and best.above and best.feature == f and gain == best_gain
                        if gain > best_gain or tighter:
                            best, best_gain = Condition(f, cut, threshold, above), gain
            if best is None:
                break
            rule += (best,)
        return rule

    def prune(left: DataFrame, rule: Rule) -> Rule:
        asked = [F.count_if(_all(rule[: i + 1]) & (F.col("bad") == b)).alias(f"{'p' if b else 'n'}{i}") for i in range(len(rule)) for b in (True, False)]
        got = left.agg(*asked).first()
        best, worth = (), -1.0
        for i in range(len(rule)):
            p, n = got[f"p{i}"], got[f"n{i}"]
            if p and p >= precision * (p + n) and (p - n) / (p + n) > worth:
                best, worth = rule[: i + 1], (p - n) / (p + n)
        return best

    rules: list[Rule] = []
    left = rows
    grown_on = left.filter(~F.col("for_pruning"))
    for _ in range(2 * max_rules):
        grown = grow(grown_on)
        if not grown or len(rules) == max_rules:
            break
        rule = prune(left.filter("for_pruning"), grown)
        if rule:
            rules.append(rule)
            left = left.filter(~_all(rule))
        # what a rejected rule covers is set aside from growing only
        grown_on = grown_on.filter(~_all(rule or grown))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The text of the first rule that holds, else null."""
    out = None
    for rule in rules:
        text = " and ".join(c.text() for c in rule)
        out = F.when(F.expr(text), F.lit(text)) if out is None else out.when(F.expr(text), F.lit(text))
    return F.lit(None).cast("string") if out is None else out


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the labelled rows that pass the base rules; documents with conflicting labels are left out."""
    quality = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
    quality = quality.filter("_low = _high").select("doc_id", (F.col("_low") == 0).alias("bad"))
    return stats.filter(~base_failed()).join(quality, "doc_id")


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (null: none) and kept. Documents without words fail the base rules."""
    judged = stats.withColumn("base_failed", base_failed())
    judged = judged.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct"]


def quality_table(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """One row per document with statistics, base_failed, rule and kept; and the learned rules.

    Repeated rows are judged each; an empty table gives no rows; other columns of `docs` are ignored.
    """
    stats = materialise(statistics(docs.select("doc_id", "text")).select("doc_id", *COUNTS))
    rules = learn_rules(labelled_statistics(stats, labels))
    return judge(stats, rules), rules


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with their columns as they were.

    Null and empty texts fail the base rules; repeated rows are judged each; an empty table gives no rows. A row
    without an id, or with conflicting labels, is judged but not learned from.
    """
    _, rules = quality_table(docs, labels)
    plain = statistics(docs.select(F.struct("*").alias("_row"), "doc_id", "text"))
    # a number per row keeps the optimizer from writing the statistics out again inside the filter
    numbered = plain.withColumn("_number", F.monotonically_increasing_id())
    return judge(numbered, rules).filter("kept and _number >= 0").select("_row.*")
