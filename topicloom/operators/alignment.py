"""Topics against known categories.

``docs`` has ``id``, ``primary_category`` and ``categories`` (comma-separated text);
``doc_topics`` has ``id`` and ``topic_dist ARRAY<DOUBLE>``. Tables are matched by id. Most
results come from the contingency table, which has one row per category and topic.
Ties always go to the larger count, then the smaller category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.functions import arrays
from topicloom.runtime import cut_lineage, lookup_join, row_total


def n_rows() -> Column:
    return F.count(F.lit(1))


def split_categories(c: Column | str) -> Column:
    """Comma-separated categories as a trimmed list; missing text gives no list."""
    return F.transform(F.split(F.col(c) if isinstance(c, str) else c, ","), lambda x: F.trim(x))


def topic_range(spark, k: int) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("dominant_topic"))


# -- category tables ---------------------------------------------------------------


def primary_category_counts(docs: DataFrame) -> DataFrame:
    return (
        docs.where(F.col("primary_category").isNotNull())
        .groupBy("primary_category")
        .agg(n_rows().alias("n"))
    )


def all_category_counts(docs: DataFrame) -> DataFrame:
    listed = docs.select(F.explode(split_categories("categories")).alias("category"))
    return listed.groupBy("category").agg(n_rows().alias("n"))


def category_totals(docs: DataFrame) -> DataFrame:
    """One row: papers, distinct primary categories, distinct listed categories."""
    primary = primary_category_counts(docs)
    listed = all_category_counts(docs)
    return docs.agg(n_rows().alias("total_papers")).select(
        "total_papers",
        row_total(primary).alias("n_primary_categories"),
        row_total(listed).alias("n_all_categories"),
    )


# -- documents with topics ---------------------------------------------------------


def dominant_topics(doc_topics: DataFrame) -> DataFrame:
    return doc_topics.select("id", arrays.argmax("topic_dist").alias("dominant_topic"))


def attach_topics(docs: DataFrame, doc_topics: DataFrame) -> DataFrame:
    """Documents that have a topic distribution, with their dominant topic."""
    return docs.join(dominant_topics(doc_topics), "id")


def contingency(analysis: DataFrame) -> DataFrame:
    """``(primary_category, dominant_topic, n)``; a missing category is its own row."""
    return analysis.groupBy("primary_category", "dominant_topic").agg(n_rows().alias("n"))


# -- shares and purity -------------------------------------------------------------


def _share(counts: DataFrame) -> DataFrame:
    of_topic = Window.partitionBy("dominant_topic")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(of_topic))


def category_shares(table: DataFrame) -> DataFrame:
    """Share of each primary category among a topic's documents with a category."""
    return _share(table.where(F.col("primary_category").isNotNull())).select(
        "dominant_topic", F.col("primary_category").alias("category"), "n", "share"
    )


def all_category_shares(analysis: DataFrame) -> DataFrame:
    """Share of each listed category among all category mentions in a topic."""
    mentions = analysis.select("dominant_topic", F.explode(split_categories("categories")).alias("category"))
    return _share(mentions.groupBy("dominant_topic", "category").agg(n_rows().alias("n")))


def keep_empty_topics(per_topic: DataFrame, k: int) -> DataFrame:
    """All topics 0..k-1; topics without rows get nulls in the other columns."""
    return topic_range(per_topic.sparkSession, k).join(per_topic, "dominant_topic", "left")


def topic_purity(table: DataFrame, k: int) -> DataFrame:
    """Largest category count over topic size; the size includes missing categories."""
    sizes = table.groupBy("dominant_topic").agg(
        F.sum("n").alias("size"),
        F.max(F.when(F.col("primary_category").isNotNull(), F.col("n"))).alias("largest"),
    )
    return keep_empty_topics(sizes, k).select(
        "dominant_topic",
        F.coalesce("size", F.lit(0)).alias("size"),
        F.coalesce(F.col("largest") / F.col("size"), F.lit(0.0)).alias("purity"),
    )


def average_purity(table: DataFrame, k: int) -> DataFrame:
    return topic_purity(table, k).agg(F.avg("purity").alias("average_purity"))


def category_labels(docs: DataFrame) -> DataFrame:
    """Integer label of each category, in category order, missing first.

    One row per distinct category; the numbering window sees only those.
    """
    names = docs.select("primary_category").distinct()
    ordered = Window.orderBy(F.asc_nulls_first("primary_category"))
    return names.withColumn("label", (F.row_number().over(ordered) - 1).cast("int"))


# -- agreement of two partitions ---------------------------------------------------


def _pairs(c: Column) -> Column:
    return c * (c - 1) / 2


def _margins(table: DataFrame) -> DataFrame:
    by_category = Window.partitionBy("primary_category")
    by_topic = Window.partitionBy("dominant_topic")
    return table.select(
        F.col("n").cast("double").alias("n"),
        F.sum("n").over(by_category).cast("double").alias("a"),
        F.sum("n").over(by_topic).cast("double").alias("b"),
    )


def adjusted_rand(table: DataFrame) -> DataFrame:
    """One row: Adjusted Rand Index. Each cell carries its share of the margin pair counts."""
    sums = _margins(table).agg(
        F.sum(_pairs(F.col("n"))).alias("cells"),
        # a margin appears in several cells, so it is spread over them in proportion to n
        F.sum(F.col("n") * (F.col("a") - 1) / 2).alias("categories"),
        F.sum(F.col("n") * (F.col("b") - 1) / 2).alias("topics"),
        F.sum("n").alias("total"),
    )
    expected = F.col("categories") * F.col("topics") / F.nullif(_pairs(F.col("total")), F.lit(0.0))
    span = (F.col("categories") + F.col("topics")) / 2 - expected
    return sums.select(
        F.coalesce((F.col("cells") - expected) / F.nullif(span, F.lit(0.0)), F.lit(1.0)).alias("ari")
    )


def normalized_mutual_info(table: DataFrame) -> DataFrame:
    """One row: mutual information over the mean of the two entropies.

    With total T, MI = ln T + (sum n ln n - sum n ln a - sum n ln b) / T and
    H(a) = ln T - sum n ln a / T, so one aggregation over the cells is enough.
    """
    n, a, b = (F.col(c) for c in ("n", "a", "b"))
    sums = _margins(table).agg(
        F.sum("n").alias("t"),
        F.sum(n * F.log(n)).alias("cells"),
        F.sum(n * F.log(a)).alias("categories"),
        F.sum(n * F.log(b)).alias("topics"),
    )
    t = F.col("t")
    mi = F.log(t) + (F.col("cells") - F.col("categories") - F.col("topics")) / t
    mean = F.log(t) - (F.col("categories") + F.col("topics")) / (2 * t)
    # below this the entropy is rounding error of a single cluster
    return sums.select(F.when(mean < 1e-12, F.lit(1.0)).otherwise(mi / F.nullif(mean, F.lit(0.0))).alias("nmi"))


def alignment_summary(table: DataFrame, k: int) -> DataFrame:
    """One row: ARI, NMI, average purity, topics, categories."""
    return (
        average_purity(table, k)
        .select(
            "average_purity",
            adjusted_rand(table).scalar().alias("ari"),
            normalized_mutual_info(table).scalar().alias("nmi"),
            F.lit(k).alias("num_topics"),
            row_total(table.select("primary_category").distinct()).alias("num_categories"),
        )
    )


def alignment(docs: DataFrame, doc_topics: DataFrame, k: int) -> dict[str, DataFrame]:
    """All alignment tables of one method.

    The contingency table is written once: it is small, and every result but the shares
    of listed categories comes from it, so the documents are read a single time for them.
    """
    analysis = attach_topics(docs, doc_topics)
    table = cut_lineage(contingency(analysis))
    return {
        "analysis": analysis,
        "contingency": table,
        "primary_shares": category_shares(table),
        "all_shares": all_category_shares(analysis),
        "purity": topic_purity(table, k),
        "summary": alignment_summary(table, k),
    }


# -- predicted categories ----------------------------------------------------------


def predicted_by_topic(table: DataFrame, k: int) -> DataFrame:
    """Most common category of each topic; 'Unknown' for an empty topic."""
    best = (
        table.where(F.col("primary_category").isNotNull())
        .groupBy("dominant_topic")
        .agg(F.min_by("primary_category", F.struct((-F.col("n")).alias("n"), F.col("primary_category"))).alias("best"))
    )
    return keep_empty_topics(best, k).select(
        "dominant_topic", F.coalesce("best", F.lit("Unknown")).alias("predicted_category")
    )


def predict(analysis: DataFrame, predicted: DataFrame) -> DataFrame:
    """Predicted category of each document.

    ``predicted`` has one row per topic and is written first, since the size check and
    the join both read it.
    """
    return lookup_join(analysis, cut_lineage(predicted), "dominant_topic", how="inner")


def label_pairs(table: DataFrame, predicted: DataFrame) -> DataFrame:
    """``(true_category, predicted_category, n)`` from the contingency table.

    Missing true categories are left out.
    """
    return (
        table.where(F.col("primary_category").isNotNull())
        .join(predicted, "dominant_topic")
        .groupBy(F.col("primary_category").alias("true_category"), "predicted_category")
        .agg(F.sum("n").alias("n"))
    )
