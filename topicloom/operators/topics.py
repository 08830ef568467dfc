"""What every topic model hands over: topic words and document topics.

``topic_words``: ``(topic_id, rank, word, weight)``; ``doc_topics``:
``(id, topic_dist ARRAY<DOUBLE>)``; ``sweep``: ``(k, score, position, is_optimal)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from topicloom.functions import arrays
from topicloom.runtime import row_total


def rank_words(weights: DataFrame, n: int) -> DataFrame:
    """First ``n`` words of each topic from ``(topic_id, word, weight)``, ties by word."""
    order = Window.partitionBy("topic_id").orderBy(F.desc("weight"), "word")
    return (
        weights.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select("topic_id", "rank", "word", "weight")
    )


def topic_diversity(topic_words: DataFrame, n: int = 10) -> DataFrame:
    """One row: distinct words among the first ``n`` of all topics over topics x ``n``."""
    first = topic_words.where(F.col("rank") <= n)
    topics = row_total(topic_words.select("topic_id").distinct())
    return first.agg(F.count_distinct("word").alias("n_words")).select(
        (F.col("n_words") / (topics * n)).alias("diversity")
    )


def normalise_topics(doc_topics: DataFrame) -> DataFrame:
    """Non-negative rows that sum to 1; rows of zeros stay zero."""
    return doc_topics.withColumn("topic_dist", arrays.row_normalise("topic_dist"))


def sweep_table(
    spark: SparkSession, ks: Sequence[int], scores: Sequence[float], largest: bool
) -> DataFrame:
    """Scores per topic count with the chosen one marked; the first of equal scores wins."""
    better = max if largest else min
    chosen = list(scores).index(better(scores))
    rows = [(int(k), float(s), i, i == chosen) for i, (k, s) in enumerate(zip(ks, scores))]
    return spark.createDataFrame(rows, "k int, score double, position int, is_optimal boolean")


def chosen_k(sweep: DataFrame) -> int:
    return sweep.where("is_optimal").select("k").first()[0]


def mark_optimal(scores: DataFrame, largest: bool) -> DataFrame:
    """Mark the best row of ``(k, score, position)``; the first of equal scores wins."""
    best = F.max("score") if largest else F.min("score")
    top = scores.agg(best.alias("best")).scalar()
    first = scores.where(F.col("score") == top).agg(F.min("position").alias("first")).scalar()
    return scores.withColumn("is_optimal", F.col("position") == first)
