"""Array expressions that stay inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def argmax(c: Column | str) -> Column:
    """Index of the largest element, the lowest index on ties."""
    values = F.col(c) if isinstance(c, str) else c
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def one_hot(topic: Column | str, k: int) -> Column:
    """Array of length ``k`` with 1.0 at ``topic``; all zero for an outlier (-1)."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == t, 1.0).otherwise(0.0))


def row_normalise(c: Column | str) -> Column:
    """Negative entries cut to 0, then divided by the sum; a zero row stays zero."""
    values = F.col(c) if isinstance(c, str) else c

    def scaled(row: Column) -> Column:
        total = F.aggregate(row, F.lit(0.0), lambda a, x: a + x)
        return F.transform(row, lambda x: x / F.when(total == 0, F.lit(1.0)).otherwise(total))

    return let(F.transform(values, lambda x: F.greatest(x, F.lit(0.0))), scaled)


def run_lengths(tokens: Column | str) -> Column:
    """Distinct tokens of a row with their counts, as ``array<struct<term, tf>>``.

    Equal tokens are neighbours in the sorted array, so a count is the distance to the
    next start. The counting needs no shuffle because it never leaves the row.
    """
    words = F.col(tokens) if isinstance(tokens, str) else tokens

    def counts(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, j: F.struct(
                    F.get(s, start).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(s)) - start).cast("long").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(words) > 0, let(F.sort_array(words), counts)).otherwise(empty)


def ngrams(tokens: Column | str, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by spaces; shorter runs first."""
    words = F.col(tokens) if isinstance(tokens, str) else tokens

    def runs(n: int) -> Column:
        if n == 1:
            return words
        last = F.size(words) - n + 1
        return F.when(
            last >= 1,
            F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), " ")),
        ).otherwise(F.array().cast("array<string>"))

    parts = [runs(n) for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)
