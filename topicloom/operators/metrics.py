"""Classification quality from label pairs.

Every function takes ``pairs``: ``(true_category, predicted_category, n)``, the counted
pairs of true and predicted category. No document is touched again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.runtime import cut_lineage

def _ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0 where the divisor is 0."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def pairs_of(predictions: DataFrame, true: str = "primary_category", predicted: str = "predicted_category") -> DataFrame:
    """Count the label pairs of a document table; missing true categories are left out."""
    return (
        predictions.where(F.col(true).isNotNull())
        .groupBy(F.col(true).alias("true_category"), F.col(predicted).alias("predicted_category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def support(pairs: DataFrame) -> DataFrame:
    """Documents per true category."""
    return pairs.groupBy(F.col("true_category").alias("category")).agg(F.sum("n").alias("support"))


def universe(pairs: DataFrame) -> DataFrame:
    """Sorted union of true and predicted categories."""
    true = pairs.select(F.col("true_category").alias("category"))
    predicted = pairs.select(F.col("predicted_category").alias("category"))
    return true.union(predicted).distinct().orderBy("category")


def supported(pairs: DataFrame, min_support: int) -> DataFrame:
    """Categories with at least ``min_support`` documents."""
    return support(pairs).where(F.col("support") >= min_support)


def top_categories(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest true categories with their position by size."""
    largest = support(pairs).orderBy(F.desc("support"), "category").limit(n)
    order = Window.orderBy(F.desc("support"), "category")  # at most n rows
    return largest.withColumn("position", F.row_number().over(order).cast("int"))


def keep_true(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """Pairs whose true category is listed."""
    return pairs.join(categories.select(F.col("category").alias("true_category")), "true_category", "left_semi")


def accuracy(pairs: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("true_category") == F.col("predicted_category"), F.col("n")).otherwise(0))
    return pairs.agg((hits / F.sum("n")).alias("accuracy"))


def label_scores(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every label seen as true or predicted.

    Each pair is counted once under its true and once under its predicted label.
    """
    hit = F.when(F.col("true_category") == F.col("predicted_category"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("true_category").alias("category"), hit.alias("tp"), F.col("n").alias("t"), zero.alias("p")),
                F.struct(F.col("predicted_category").alias("category"), zero.alias("tp"), zero.alias("t"), F.col("n").alias("p")),
            )
        )
    )
    sums = sides.groupBy("category").agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"), F.sum("p").alias("predicted"))
    tp, t, p = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        "category",
        _ratio(tp, p).alias("precision"),
        _ratio(tp, t).alias("recall"),
        _ratio(2 * tp, t + p).alias("f1"),
        "support",
    )


def category_scores(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """Scores of the listed categories; a category never seen scores 0."""
    listed = categories.select("category").join(label_scores(pairs), "category", "left")
    return listed.select(
        "category",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")],
        F.coalesce("support", F.lit(0)).alias("support"),
    )


def macro_average(pairs: DataFrame) -> DataFrame:
    """Plain mean over all labels seen as true or predicted."""
    return label_scores(pairs).agg(*[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f1")])


def weighted_average(pairs: DataFrame) -> DataFrame:
    """Mean weighted by the true support."""
    total = F.sum("support")
    return label_scores(pairs).agg(
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")]
    )


def overall_scores(pairs: DataFrame) -> DataFrame:
    """One row: accuracy, macro and weighted averages. All null without pairs."""
    total = F.sum("support")
    scores = ("precision", "recall", "f1")
    return label_scores(pairs).agg(
        *[F.avg(c).alias(f"{c}_macro") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"{c}_weighted") for c in scores],
        # recall times support is the number of hits of a label
        (F.sum(F.col("recall") * F.col("support")) / total).alias("accuracy"),
    ).select("accuracy", *[f"{c}_macro" for c in scores], *[f"{c}_weighted" for c in scores])


def confusion(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """Counts for every pair of listed categories, zero cells included.

    The grid is the result itself; its rows and columns are the listed categories.
    """
    true = categories.select(F.col("category").alias("true_category"))
    columns = categories.agg(F.collect_set("category").alias("all")).scalar()
    grid = true.select("true_category", F.explode(columns).alias("predicted_category"))
    return grid.join(pairs, ["true_category", "predicted_category"], "left").select(
        "true_category", "predicted_category", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification(
    pairs: DataFrame, categories: DataFrame | None = None, min_support: int | None = None
) -> dict[str, DataFrame]:
    """All metrics, after the minimum-support filter where one is given.

    The pairs are written first: a row per true and predicted category, read many times.
    """
    pairs = cut_lineage(pairs)
    listed = universe(pairs) if categories is None else categories.select("category")
    if min_support is not None:
        listed = listed.join(supported(pairs, min_support).select("category"), "category", "left_semi")
        pairs = keep_true(pairs, listed)
    return {
        "overall": overall_scores(pairs),
        "per_category": category_scores(pairs, listed),
        "confusion": confusion(pairs, listed),
        "pairs": pairs,
    }


def top_classification(pairs: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """Metrics on documents of the ``n`` largest categories only."""
    pairs = cut_lineage(pairs)
    largest = top_categories(pairs, n)
    return classification(keep_true(pairs, largest), largest)


def topic_accuracy(table: DataFrame, predicted: DataFrame) -> DataFrame:
    """Accuracy of each topic from 0 to the largest dominant topic seen.

    ``table`` is the contingency table, ``predicted`` the category of each topic.
    """
    joined = table.join(predicted, "dominant_topic")
    hit = F.when(F.col("primary_category") == F.col("predicted_category"), F.col("n")).otherwise(0)
    sums = joined.groupBy("dominant_topic", "predicted_category").agg(
        F.sum(hit).alias("correct"), F.sum("n").alias("total")
    )
    last = table.agg(F.max("dominant_topic").alias("last")).scalar()
    seen = predicted.select("dominant_topic").where(F.col("dominant_topic") <= last)
    return seen.join(sums, "dominant_topic", "left").select(
        F.col("dominant_topic").alias("topic"),
        F.coalesce(F.col("correct") / F.col("total"), F.lit(0.0)).alias("accuracy"),
        F.coalesce("correct", F.lit(0)).alias("correct"),
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("predicted_category", F.lit("Unknown")).alias("predicted_category"),
    )
