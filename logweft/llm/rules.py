"""Quality rules by weak supervision.

Every rule looks at one statistic of a text and votes for it, against it, or abstains.  How accurate a rule is, and
how often it speaks, is not given but estimated from how the rules agree over all texts: expectation-maximisation
for a model in which the votes are independent given the unknown quality.  The posterior probability of good quality
then decides, in place of a filter that all rules must pass.

Counting vote patterns is one aggregation with few groups (three to the power of the number of rules at most,
whatever the input), so what reaches the driver is bounded; every text counts.  The estimated log odds go back as
constants of a column expression.  Statistics are array expressions over one row, linear or log-linear in its words.

Base statistics: words (runs of characters other than space and \\t, \\n, \\v, \\f, \\r), characters in words, signs
``#*$%&|<>``, lines with a word that equal an earlier line, and words in 8-word windows that occur twice or more.

Defined cases: a null text is empty; an empty text has zeros, fails the base rule and is not kept; without rows the
result is empty; repeated rows are judged alike, and count as often as they occur; columns named like an added one
are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm.landing import landed

WORD_GAP = r"[ \t-\r]+"


@dataclass(frozen=True)
class Rule:
    """Votes ``bad`` where that column holds, else ``good`` where that one holds, else nothing."""

    name: str
    bad: Column
    good: Column


@dataclass(frozen=True)
class RuleConfig:
    min_words: int = 20
    repeat_percent: int = 30
    window: int = 8
    keep_from: float = 0.5
    iterations: int = 100
    #: Accuracy a rule is assumed to have at the start, and the share of good texts.
    first_accuracy: float = 0.8
    first_share: float = 0.8

    def __post_init__(self):
        if self.window < 1 or self.window & (self.window - 1):
            raise ValueError("window must be a power of two")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _with_windows(found: DataFrame, window: int) -> DataFrame:
    """``_windows``: hashes of all windows of so many words, from ``_hashes``, in steps that double their length."""
    found, size = found.withColumn("_windows", F.col("_hashes")), 1
    while size < window:
        now = F.col("_windows")
        later = F.slice(now, F.lit(size + 1), F.greatest(F.size(now) - size, F.lit(0)))
        found, size = found.withColumn("_windows", F.zip_with(now, later, lambda a, b: F.xxhash64(a, b))), 2 * size
    # The last ones, for which words are missing, are cut off.
    return found.withColumn("_windows", F.slice("_windows", F.lit(1), F.greatest(F.size("_windows") - (window - 1), F.lit(0))))


def _repeat_words(ordered: Column, window: int) -> Column:
    """Words in windows that occur more than once; ``ordered`` are (hash, place) of all windows, sorted."""
    again = F.filter(ordered, lambda p, k: (F.get(ordered, k - 1)["h"] == p["h"]) | (F.get(ordered, k + 1)["h"] == p["h"]))
    starts = F.sort_array(F.transform(again, lambda p: p["i"]))
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + window - F.greatest(i, s["end"])).alias("n"), (i + window).alias("end")),
        lambda s: s["n"])


def text_statistics(rows: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """All columns with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_caps_words, n_equal_next,
    n_lines, n_distinct_words, base_failed``."""
    text = F.coalesce("text", F.lit(""))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_caps_words", "n_equal_next", "n_lines",
             "n_distinct_words", "base_failed"]
    kept = [c for c in rows.columns if c.lower() not in added]
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    # The given columns go into one struct, so that none can be called like a helper.
    found = rows.select(F.struct(*kept).alias("row"), text.alias("text"), _words(text).alias("_words"), lines.alias("_lines")).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    # Places are sorted only for the few texts in which a window occurs again.
    found = _with_windows(found, config.window).withColumn("_ordered", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    long = "long"
    found = found.select(
        "row",
        F.size("_words").cast(long).alias("n_words"),
        F.length(F.array_join("_words", "")).cast(long).alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast(long).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast(long).alias("n_dup_lines"),
        F.when(F.col("_ordered").isNull(), F.lit(0).cast(long))
        .otherwise(_repeat_words(F.col("_ordered"), config.window)).alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: w.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"))).cast(long).alias("n_caps_words"),
        F.size(F.filter("_hashes", lambda h, i: F.get(F.col("_hashes"), i - 1) == h)).cast(long).alias("n_equal_next"),
        F.size("_lines").cast(long).alias("n_lines"),
        F.size(F.array_distinct("_hashes")).cast(long).alias("n_distinct_words"))
    few = F.col("n_words") < config.min_words
    repeats = 100 * F.col("n_repeat_words") > config.repeat_percent * F.col("n_words")
    return found.withColumn("base_failed", few | repeats).select("row.*", *added)


def default_rules() -> list[Rule]:
    """Rules on the statistics above."""
    words = F.col("n_words")
    chars = F.col("word_chars")
    return [
        Rule("length", words < 20, words >= 50),
        Rule("repeats", 100 * F.col("n_repeat_words") > 30 * words, 100 * F.col("n_repeat_words") < 10 * words),
        Rule("signs", 100 * F.col("n_symbols") > 10 * chars, 100 * F.col("n_symbols") < 3 * chars),
        Rule("capitals", 100 * F.col("n_caps_words") > 40 * words, 100 * F.col("n_caps_words") < 10 * words),
        Rule("doubled", 100 * F.col("n_equal_next") > 20 * words, 100 * F.col("n_equal_next") < 5 * words),
        Rule("word_length", (chars < 2 * words) | (chars > 15 * words), chars.between(3 * words, 10 * words)),
        Rule("lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"), 100 * F.col("n_dup_lines") < 10 * F.col("n_lines")),
    ]


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 for none."""
    return F.when(F.coalesce(rule.bad, F.lit(False)), -1).when(F.coalesce(rule.good, F.lit(False)), 1).otherwise(0)


@dataclass(frozen=True)
class Estimate:
    """Share of good texts, and per rule the log odds that a vote of -1, 0 or 1 adds for good quality."""

    share: float
    log_odds: list[dict[int, float]]

    def probability(self, votes) -> float:
        odds = math.log(self.share / (1 - self.share)) + sum(o[v] for o, v in zip(self.log_odds, votes, strict=True))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def estimate(patterns: list[tuple[tuple[int, ...], int]], config: RuleConfig = RuleConfig()) -> Estimate:
    """Expectation-maximisation over counted vote patterns.

    Counts are smoothed by one vote of each kind, so that no rule is ever certain.
    """
    patterns = sorted(patterns)
    rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    share, a = config.first_share, config.first_accuracy
    speaks = [sum(n for p, n in patterns if p[j]) / max(1, total) for j in range(rules)]
    table = [{q: {q: s * a, -q: s * (1 - a), 0: 1 - s} for q in (1, -1)} for s in (min(0.99, max(0.01, x)) for x in speaks)]

    def now() -> Estimate:
        return Estimate(share, [{v: math.log(t[1][v] / t[-1][v]) for v in (-1, 0, 1)} for t in table])

    for _ in range(config.iterations if total else 0):
        current = now()
        good = [(p, n, n * current.probability(p)) for p, n in patterns]
        weight = sum(g for _, _, g in good)
        share = min(1 - 1e-6, max(1e-6, (weight + 1) / (total + 2)))
        for j in range(rules):
            for quality in (1, -1):
                count = {v: 1.0 for v in (-1, 0, 1)}
                for p, n, g in good:
                    count[p[j]] += g if quality == 1 else n - g
                whole = sum(count.values())
                table[j][quality] = {v: c / whole for v, c in count.items()}
    return now()


def judge(rows: DataFrame, rules: list[Rule] | None = None, config: RuleConfig = RuleConfig()) -> DataFrame:
    """``text_statistics`` without the text, with ``good_probability`` and ``kept``.

    Statistics are computed once and written to the shared folder; the rules' votes are then counted over all rows.
    """
    rules = default_rules() if rules is None else rules
    found = text_statistics(rows, config)
    found = landed(found.drop("text", *[c for c in found.columns if c.lower() in ("good_probability", "kept")]), "rule-statistics")
    votes = F.array(*[vote(r) for r in rules])
    counted = found.groupBy(votes.alias("votes")).count().collect()
    model = estimate([(tuple(r.votes), r["count"]) for r in counted], config)
    odds = F.lit(math.log(model.share / (1 - model.share)))
    for rule, of in zip(rules, model.log_odds if counted else [dict.fromkeys((-1, 0, 1), 0.0)] * len(rules), strict=True):
        cast = vote(rule)
        odds = odds + F.when(cast == 1, of[1]).when(cast == -1, of[-1]).otherwise(of[0])
    good = 1 / (1 + F.exp(-odds))
    return found.withColumn("good_probability", good).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good_probability") >= config.keep_from))
