"""Weak supervision of text quality: rules vote or abstain, EM weighs them.

Each rule looks at one statistic of a text and votes good, bad, or abstains.  No
rule decides alone.  The hidden class of a text is good or one of a few kinds of fault; given the
class the votes are taken as independent.  Expectation-maximisation over all texts estimates the
share of each class and, per rule and class, how often it votes bad.  The posterior probability of
the good class replaces all-must-pass filtering.

Each kind of fault has two rules or more, so that EM finds it as votes that go together, however
frequent it is; with one class for all faults the likelihood is highest where the most frequent fault counts as
normal.  What a rule's bad vote is worth is learned: short texts are common among good ones, so a vote
against the length alone condemns no text.  Start values and weak priors (PRIOR_VOTES pseudo-votes a
number) only name the classes; the verdicts don't depend on them (tests).

The votes of a text are a string over ``+ - .``, one character a rule.  EM needs
only the number of texts per vote string, at most 3 ** rules rows whatever the
corpus, so a corpus costs one aggregation with a map-side combine and each EM step
touches that bounded table.  Only the model (a few numbers a rule) reaches the
driver.  Everything runs as built-in column expressions.

Defined cases: null or blank texts count as texts without words; rules about
shares abstain on them; an empty table gives an empty result.  Extra columns, whatever their names, are
kept as they are by ``filter_by_rules`` and ignored by ``quality_posteriors``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed, let
from ledgerline.llm.stats import COUNTS, text_stats

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes good if value is in [good_from, good_to], bad outside [bad_below, bad_above]."""

    name: str
    top: str
    bottom: str
    good_from: float
    good_to: float
    bad_below: float
    bad_above: float
    least: int = 1  # abstains while the denominator is smaller
    fault: str = ""  # the kind of fault it looks for


INF = float("inf")
RULES = (
    Rule("length", "n_words", "", 100, INF, 20, INF),
    Rule("word_length", "word_chars", "n_words", 3, 10, 2, 14, 5),
    Rule("symbols", "n_symbols", "n_words", 0, 0.1, -INF, 0.4, 5, "symbols"),
    Rule("symbol_share", "n_symbols", "word_chars", 0, 0.02, -INF, 0.06, 20, "symbols"),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0, 0.1, -INF, 0.4, 3, "repeats"),
    Rule("repeated_words", "n_repeat_words", "n_words", 0, 0.2, -INF, 0.4, 10, "repeats"),
    Rule("doubled_words", "n_doubled", "n_words", 0, 0.05, -INF, 0.2, 5, "repeats"),
    Rule("variety", "n_distinct", "n_words", 0.5, INF, 0.35, INF, 50, "repeats"),
    Rule("capitals", "n_upper", "word_chars", 0, 0.15, -INF, 0.4, 10, "shouting"),
    Rule("exclamations", "n_bangs", "n_words", 0, 0.1, -INF, 0.4, 5, "shouting"),
)
FAULTS = ("symbols", "repeats", "shouting")

# Start values and means of the priors: share of good texts, how often a rule votes bad on a good text, on
# its own kind of fault and on another.  Then the weight of a prior in pseudo-votes, and the steps.
START_GOOD, BAD_ON_GOOD, BAD_ON_OWN, BAD_ON_OTHER, PRIOR_VOTES, STEPS = 0.8, 0.02, 0.7, 0.1, 20.0, 20


def vote(rule: Rule, stats: Column) -> Column:
    bottom = stats[rule.bottom] if rule.bottom else F.lit(1)
    value = stats[rule.top] / F.greatest(bottom, F.lit(1))
    return (F.when(bottom < rule.least, ".")
            .when((value < rule.bad_below) | (value > rule.bad_above), "-")
            .when((value >= rule.good_from) & (value <= rule.good_to), "+").otherwise("."))


def votes(stats: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.concat(*[vote(r, stats) for r in rules])


def codes(pattern: Column, n_rules: int) -> Column:
    """A vote string as places in a table with three entries a rule: abstains, good, bad."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_rules - 1)), lambda i: 3 * i + F.when(
        F.substring(pattern, i + 1, F.lit(1)) == "+", 1).when(F.substring(pattern, i + 1, F.lit(1)) == "-", 2).otherwise(0))


def shares_of(logs: list[Column]) -> list[Column]:
    """exp of each, divided by their sum."""
    most = F.greatest(*logs)
    total = reduce(lambda a, b: a + b, [F.exp(x - most) for x in logs])
    return [F.exp(x - most) / total for x in logs]


@dataclass(frozen=True)
class Model:
    """Share of each class, the good one first; per class and rule P(vote bad | class), if it votes."""

    shares: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    def logs(self, places: Column) -> list[Column]:
        """log of P(class, votes) of each class, from ``codes``; the terms are added in the rules' order."""
        def one(share: float, bad: tuple[float, ...]) -> Column:
            # A literal table: every EM step runs the same compiled code.
            table = F.array(*[F.lit(x) for b in bad for x in (0.0, math.log(1 - b), math.log(b))])
            return F.aggregate(places, F.lit(math.log(share)), lambda s, c: s + F.get(table, c))

        return [one(*c) for c in zip(self.shares, self.bad)]

    def posterior(self, pattern: Column) -> Column:
        """P(good | votes)."""
        return let(codes(pattern, len(self.bad[0])), lambda c: let(
            F.array(*self.logs(c)), lambda x: shares_of([x[k] for k in range(len(self.shares))])[0]))


def start(rules: tuple[Rule, ...] = RULES) -> Model:
    shares = (START_GOOD, *[(1 - START_GOOD) / len(FAULTS)] * len(FAULTS))
    return Model(shares, (tuple(BAD_ON_GOOD for _ in rules), *[
        tuple(BAD_ON_OWN if r.fault == f else BAD_ON_OTHER for r in rules) for f in FAULTS]))


def count_patterns(patterns: DataFrame) -> DataFrame:
    """(pattern, n) of a DataFrame with a column ``pattern``, cut from its lineage."""
    return checkpointed(patterns.groupBy("pattern").agg(F.count("*").alias("n")).coalesce(1))


def fit(counts: DataFrame, rules: tuple[Rule, ...] = RULES, steps: int = STEPS) -> Model:
    """EM over (pattern, n); a table without rows leaves the start values."""
    prior = model = start(rules)
    classes = range(len(prior.shares))
    table = counts.select("n", codes(F.col("pattern"), len(rules)).alias("codes"))
    for _ in range(steps):
        # Every rule of a text has one place: the sums per place are all that a step needs.
        own = table.select("n", "codes", *[x.alias(f"l{k}") for k, x in enumerate(model.logs(F.col("codes")))])
        own = own.select("codes", *[(x * F.col("n")).alias(f"p{k}") for k, x in enumerate(shares_of([F.col(f"l{k}") for k in classes]))])
        sums = own.select(F.explode("codes").alias("place"), *[f"p{k}" for k in classes]).groupBy("place").agg(
            *[F.sum(f"p{k}").alias(f"p{k}") for k in classes]).collect()  # three rows a rule
        got = [[0.0] * (3 * len(rules)) for _ in classes]
        for r in sums:
            for k in classes:
                got[k][r["place"]] = r[f"p{k}"]
        total = [sum(g[:3]) for g in got]
        smooth = lambda hit, of, mean: (hit + mean * PRIOR_VOTES) / (of + PRIOR_VOTES)
        model = Model(
            tuple(smooth(total[k], sum(total), prior.shares[k]) for k in classes),
            tuple(tuple(smooth(got[k][3 * i + 2], got[k][3 * i + 1] + got[k][3 * i + 2], prior.bad[k][i])
                        for i in range(len(rules))) for k in classes))
    return model


def base_failed(stats: Column) -> Column:
    return (stats.n_words < MIN_WORDS) | (
        100 * stats.n_repeat_words > MAX_REPEAT_PERCENT * stats.n_words)


def quality_posteriors(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       threshold: float = 0.5) -> DataFrame:
    """One row per input row: key, counts, votes, posterior, base_failed, kept."""
    judged = docs.select(F.col(f"`{key}`").alias(key), text_stats(F.col(f"`{text}`")).alias("_stats"))
    judged = checkpointed(judged.withColumn("pattern", votes(F.col("_stats"))))
    model = fit(count_patterns(judged.select("pattern")))
    s = F.col("_stats")
    return (judged.withColumn("posterior", model.posterior(F.col("pattern")))
            .withColumn("base_failed", base_failed(s))
            .select(key, *[s[c].alias(c) for c in COUNTS], F.col("pattern").alias("votes"),
                    "posterior", "base_failed",
                    (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept")))


def filter_by_rules(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were.

    The statistics are computed twice, once for the counts and once beside the
    rows: a table of the rows with their votes would stand on disk as long as the result is used.
    """
    stats = text_stats(F.col(f"`{text}`"))
    model = fit(count_patterns(docs.select(let(stats, lambda s: votes(s)).alias("pattern"))))
    return docs.where(let(stats, lambda s: ~base_failed(s) & let(
        votes(s), lambda v: model.posterior(v) >= threshold)))
