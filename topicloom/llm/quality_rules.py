"""Quality rules whose cutoffs bound how many good documents they may reject.

A rule rejects a document when its value lies above a cutoff. For every stratum the
labelled documents that pass the base checks are a holdout: at each cutoff, the number of
good ones above it is binomial, and the exact lower tail tests the claim that more than
``risk`` of the good documents would be rejected. The cutoffs of a rule are tested from
the most lenient on and testing stops at the first that fails (fixed-sequence testing);
strata and rules share the error probability evenly (Bonferroni). So with probability
``1 - delta`` no chosen cutoff rejects more than its share of the good documents of a stratum.

Defined cases: a null text has no words and fails the base checks; a null language
shares the stratum of the empty name; without labels nothing is certified and only the base checks reject;
a document with several labels is good only if all of them say so; every row is judged on
its own, so repeated rows get equal verdicts. Other columns are carried along untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm.common import WORD_GAP, stored
from topicloom.runtime import lookup_join

SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Value of every rule, all of them shares or means, as expressions over the statistics.
RULES = {
    "symbols_per_word": "n_symbols / n_words",
    "repeated_words": "n_repeat_words / n_words",
    "repeated_lines_per_word": "n_dup_lines / n_words",
    "mean_word_chars": "word_chars / n_words",
}


@dataclass(frozen=True)
class RiskControl:
    """``risk`` bounds the share of good documents that all rules together may reject in a
    stratum, ``delta`` the probability that any bound is broken. ``price`` is how many bad
    documents a cutoff must reject for each good one. Cutoffs go from lenient to strict."""

    risk: float = 0.08
    delta: float = 0.1
    price: float = 10.0
    cutoffs: dict[str, tuple[float, ...]] = field(
        default_factory=lambda: {
            "symbols_per_word": (2.0, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
            "repeated_words": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
            "repeated_lines_per_word": (0.1, 0.05, 0.03, 0.02, 0.01),
            "mean_word_chars": (40.0, 25.0, 18.0, 14.0, 12.0, 10.0),
        }
    )


def text_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` of ``(row, doc_id, stratum, text)`` with the counts of :data:`STATISTICS`.

    Everything stays inside the row. Arrays that lambdas look into are columns of their
    own, so that no element computes them again.
    """
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("text", text).withColumn("_words", F.array_remove(F.split("text", WORD_GAP), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumn("_lines", lines).withColumn("n_words", F.size("_words").cast("long"))
    windows = F.transform(
        "_words", lambda x, i: F.xxhash64(x, F.get("_words", i + 1), F.get("_words", i + 2))
    )
    rows = rows.withColumn("_windows", windows)
    rows = rows.withColumn(
        "_windows", F.when(F.col("n_words") >= 3, F.slice("_windows", 1, (F.col("n_words") - 2).cast("int")))
    )
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda x, i: F.struct(x.alias("w"), i.alias("at")))
    rows = rows.withColumn("_sorted", F.when(again, F.sort_array(placed)))
    twice = F.filter(
        "_sorted",
        lambda x, i: F.coalesce(x["w"] == F.get("_sorted", i - 1)["w"], F.lit(False))
        | F.coalesce(x["w"] == F.get("_sorted", i + 1)["w"], F.lit(False)),
    )
    rows = rows.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["at"])))
    covered = F.transform("_at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("_at", i + 1) - x, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("_repeated", F.coalesce(total, F.lit(0)).cast("long"))
    counts = F.struct(
        "n_words",
        F.length(F.regexp_replace("text", WORD_GAP, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeated").alias("n_repeat_words"),
        ((F.col("n_words") < 50) | (100 * F.col("_repeated") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    # an explode of one element, since later filters would otherwise be moved down to the
    # text and compute the nested arrays over and over
    return rows.select("row", "doc_id", "stratum", F.explode(F.array(counts)).alias("_counts")).select(
        "row", "doc_id", "stratum", "_counts.*"
    )


def rule_value(rule: str) -> Column:
    return F.when(F.col("n_words") > 0, F.expr(RULES[rule])).otherwise(F.lit(0.0))


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series beyond 64, where its next term is below 1e-15."""
    x = n.cast("double")
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(65)])
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    large = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series
    return F.when(x <= 64, F.get(small, n.cast("int"))).otherwise(large)


def lower_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial with ``n`` trials of probability ``p``, where ``k < n * p``.

    The largest term is the last, and going down each is ``i / (n - i + 1) * (1 - p) / p`` of
    the one above, a ratio below 1 that falls. Terms are summed relative to the last one, over as
    many steps as can change a double: with a first ratio of ``1 - gap`` terms shrink by
    ``exp(-40)`` within ``40 / gap`` steps, and by as much within ``9 * sqrt(n * p)`` steps.
    """
    k, n = k.cast("double"), n.cast("double")
    last = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p
    gap = 1 - k / (n - k + 1) * odds
    reach = F.least(k, F.ceil(F.least(F.try_divide(F.lit(40.0), F.greatest(gap, F.lit(1e-12))), 9 * F.sqrt(n * p) + 9)))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, s: Column) -> Column:
        i = k - s + 1  # from the term of i to that of i - 1
        term = acc["term"] * i / (n - i + 1) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    steps = F.when(reach > 0, F.sequence(F.lit(1), F.greatest(reach, F.lit(1)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.exp(last) * F.aggregate(steps, start, add)["sum"]


def choose_cutoffs(statistics: DataFrame, labels: DataFrame, control: RiskControl = RiskControl()) -> DataFrame:
    """``(stratum, cutoffs MAP<rule, value>)``; a rule without a certified useful cutoff is absent.

    ``labels`` is ``(doc_id, quality)`` with 1 for good. Only counts per stratum, rule and
    level leave the join.
    """
    good = labels.where("quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    held = statistics.where(~F.col("base_failed")).join(good, "doc_id")
    # level: how many of the rule's cutoffs let the value pass, which are the most lenient ones
    levels = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum((rule_value(rule) <= c).cast("int") for c in cuts).alias("level"),
        )
        for rule, cuts in control.cutoffs.items()
    ]
    counts = (
        held.select("stratum", "good", F.explode(F.array(*levels)).alias("x"))
        .groupBy("stratum", "x.rule", "x.level")
        .agg(
            F.sum(F.col("good").cast("long")).alias("good"),
            F.sum((~F.col("good")).cast("long")).alias("bad"),
        )
    )
    counts = stored(counts, "rule_levels")
    # a certificate is only possible while fewer than risk * n good ones are rejected
    risk = control.risk / len(control.cutoffs)
    tests = F.lit(len(control.cutoffs)) * F.greatest(F.lit(1), counts.select(F.count_distinct("stratum")).scalar())
    cuts = F.create_map(
        *[x for r, c in control.cutoffs.items() for x in (F.lit(r), F.array(*[F.lit(v) for v in c]))]
    )
    longest = max(map(len, control.cutoffs.values()))

    def above(side: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("level") <= c, F.col(side)).otherwise(0)) for c in range(longest)])

    sums = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n"), above("good").alias("lost"), above("bad").alias("caught")
    )
    each = sums.select(
        "stratum", "rule", "n", F.posexplode(cuts[F.col("rule")]).alias("at", "cutoff"), "lost", "caught"
    ).select(
        "stratum", "rule", "n", "at", "cutoff", F.get("lost", F.col("at")).alias("k"), F.get("caught", F.col("at")).alias("b")
    )
    possible = (F.col("n") > 0) & (F.col("k") < F.col("n") * risk)
    passes = F.when(possible, lower_tail(F.col("k"), F.col("n"), risk)).otherwise(F.lit(1.0)) <= control.delta / tests
    tested = each.withColumn("passes", passes).withColumn("gain", F.col("b") - control.price * F.col("k"))
    found = tested.groupBy("stratum", "rule").agg(
        F.min(F.when(~F.col("passes"), F.col("at"))).alias("stop"),
        F.sort_array(F.collect_list(F.struct((-F.col("gain")).alias("cost"), "at", "cutoff"))).alias("all"),
    )
    best = F.get(F.filter("all", lambda x: F.coalesce(x["at"] < F.col("stop"), F.lit(True)) & (x["cost"] < 0)), F.lit(0))
    chosen = found.select("stratum", "rule", best.alias("best")).where("best is not null")
    return stored(
        chosen.groupBy("stratum").agg(
            F.map_from_entries(F.collect_list(F.struct("rule", F.col("best")["cutoff"]))).alias("cutoffs")
        ),
        "rule_cutoffs",
    )


def judge(statistics: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``statistics`` with ``kept`` and ``failed_rules``, the certified rules that reject."""
    found = lookup_join(statistics, cutoffs, "stratum")
    failed = F.filter(
        F.array(
            *[
                F.when(rule_value(rule) > F.coalesce(F.col("cutoffs")[rule], F.lit(float("inf"))), F.lit(rule))
                for rule in RULES
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return (
        found.withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop("cutoffs")
    )


def as_rows(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """``(row, doc_id, stratum, text)``; ``row`` holds all columns when they are wanted later."""
    row = F.struct(*[docs[c] for c in docs.columns]) if keep_row else F.lit(None).cast("boolean")
    return docs.select(row.alias("row"), "doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "text")


def quality_verdicts(docs: DataFrame, labels: DataFrame, control: RiskControl = RiskControl()) -> DataFrame:
    """Statistics and verdict of every document of ``(doc_id, text, lang)``."""
    statistics = stored(text_statistics(as_rows(docs)).drop("row"), "rule_statistics")
    return judge(statistics, choose_cutoffs(statistics, labels, control))


def keep_good(docs: DataFrame, labels: DataFrame, control: RiskControl = RiskControl()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The statistics are computed once for the cutoffs and once for the verdicts, so that no
    text is shuffled.
    """
    cutoffs = choose_cutoffs(text_statistics(as_rows(docs)), labels, control)
    judged = judge(text_statistics(as_rows(docs, keep_row=True)), cutoffs)
    return judged.where("kept").select("row.*")
