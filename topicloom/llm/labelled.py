"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import fold


def label_sample(labels: DataFrame, label: str, parts: int, held_out: int, bound: int) -> DataFrame:
    """``(doc_id, y)`` of at most ``bound`` labelled ids outside the held-out fold, by hash order.

    An id with several labels gets the largest; ids and labels that are null are left out.
    """
    learn = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", parts) != held_out))
    return (
        learn.groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )


def labelled_texts(docs: DataFrame, sample: DataFrame, *columns: str) -> DataFrame:
    """The sampled documents with their label; the sample is small enough to send to every task."""
    return docs.select("doc_id", *columns).join(F.broadcast(sample), "doc_id")


def one_row(made: DataFrame, *columns: str) -> DataFrame:
    """``(doc_id, y)`` and ``columns``, which are binaries, of one row of each id.

    Of rows that repeat an id the smallest by its ``columns`` stays, so that the rows are bounded
    by the sample as well as the ids. They are merged where they are made before they are shuffled.
    """
    return made.groupBy("doc_id").agg(F.min("y").alias("y"), F.min(F.struct(*columns)).alias("row")).select(
        "doc_id", "y", *[F.col(f"row.{c}").alias(c) for c in columns]
    )


def adagrad(value, total, grad, rate):
    """One step of a parameter array in place."""
    total += grad * grad
    value -= rate * grad / (total**0.5 + 1e-8)
