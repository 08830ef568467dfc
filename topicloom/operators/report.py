"""Tables behind the report: small selections over the results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.runtime import cut_lineage, row_total


def normalised_confusion(confusion: DataFrame) -> DataFrame:
    """Each row of the confusion matrix divided by its sum; an empty row stays 0."""
    row = F.sum("n").over(Window.partitionBy("true_category"))
    return confusion.withColumn("share", F.coalesce(F.col("n") / F.nullif(row, F.lit(0)), F.lit(0.0)))


def best_supported(per_category: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` categories with the largest support and their scores."""
    return per_category.orderBy(F.desc("support"), "category").limit(n)


def _ranked(shares: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("dominant_topic").orderBy(F.desc("share"), "category")
    return shares.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def topic_summary(shares: DataFrame, purity: DataFrame, n: int = 3, digits: int = 1) -> DataFrame:
    """Top category, its percentage, purity and the top ``n`` as text, per non-empty topic."""
    label = F.format_string(f"%s(%.{digits}f%%)", F.col("category"), F.col("share") * 100)
    entry = F.struct("rank", label.alias("label"))
    best = _ranked(shares, n).groupBy("dominant_topic").agg(
        F.min_by("category", "rank").alias("top_category"),
        F.max("share").alias("top_share"),
        F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["label"]), ", ").alias("top_list"),
    )
    return best.join(purity.select("dominant_topic", "purity"), "dominant_topic")


def category_matrix(shares: DataFrame, topics: DataFrame, categories: list[str]) -> DataFrame:
    """Wide topic x category matrix of shares with zeros filled in."""
    wide = shares.groupBy("dominant_topic").pivot("category", categories).agg(F.first("share"))
    full = topics.select("dominant_topic").join(wide, "dominant_topic", "left")
    return full.na.fill(0.0, subset=categories)


def category_cells(shares: DataFrame, topics: DataFrame, categories: DataFrame) -> DataFrame:
    """The same matrix in long form: a row per topic and category, zeros included."""
    names = categories.agg(F.collect_set("category").alias("all")).scalar()
    grid = topics.select("dominant_topic", F.explode(names).alias("category"))
    return grid.join(shares.select("dominant_topic", "category", "share"), ["dominant_topic", "category"], "left").select(
        "dominant_topic", "category", F.coalesce("share", F.lit(0.0)).alias("share")
    )


def topic_accuracy_series(per_topic: DataFrame) -> DataFrame:
    return per_topic.select("topic", "accuracy").orderBy("topic")


def most_common(counts: DataFrame, n: int = 15, column: str = "category") -> DataFrame:
    return counts.orderBy(F.desc("n"), column).limit(n)


def categories_by_share(shares: DataFrame, n: int = 10) -> DataFrame:
    """Categories with the largest sum of shares over the topics."""
    sums = shares.groupBy("category").agg(F.sum("share").alias("total_share"))
    return sums.orderBy(F.desc(F.round("total_share", 9)), "category").limit(n)


def top_words(topic_words: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` words of each topic as ``word (0.123)`` text."""
    entry = F.struct("rank", F.format_string("%s (%.3f)", F.col("word"), F.col("weight")).alias("label"))
    return topic_words.where(F.col("rank") <= n).groupBy("topic_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["label"]), ", ").alias("words")
    )


def topic_trend(analysis: DataFrame, year: str = "year") -> DataFrame:
    """Share of each topic in each year, zeros included, as ``(year, dominant_topic, n, share)``.

    Topics are those seen in any year. Raises KeyError without a year column.
    """
    if year not in analysis.columns:
        raise KeyError(f"no column {year!r}")
    counts = cut_lineage(
        analysis.groupBy(F.col(year).alias("year"), "dominant_topic").agg(F.count(F.lit(1)).alias("n"))
    )
    seen = counts.agg(F.collect_set("dominant_topic").alias("all")).scalar()
    grid = counts.select("year").distinct().select("year", F.explode(seen).alias("dominant_topic"))
    filled = grid.join(counts, ["year", "dominant_topic"], "left").na.fill(0, ["n"])
    return filled.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("year")))


def best_categories(per_category: DataFrame, min_support: int = 50, n: int = 15) -> DataFrame:
    """Best ``n`` categories by F1 among those with enough support."""
    known = per_category.where(F.col("support") >= min_support)
    return known.orderBy(F.desc("f1"), "category").limit(n)


def topic_categories(shares: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most common categories of each topic."""
    return _ranked(shares, n).select("dominant_topic", "rank", "category", "share")


def repeatable_sample(df: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """At most ``n`` rows in the order of a seeded hash of the id, shown in id order.

    The same rows come out however the data is partitioned.
    """
    key = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))
    return df.orderBy(key, "id").limit(n).orderBy("id")


def topic_sizes(analysis: DataFrame) -> DataFrame:
    return analysis.groupBy("dominant_topic").agg(F.count(F.lit(1)).alias("n")).orderBy("dominant_topic")


def dashboard_totals(analysis: DataFrame, topic_words: DataFrame) -> DataFrame:
    """One row: documents, distinct topics, topic-word pairs."""
    return analysis.agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_distinct("dominant_topic").alias("n_topics")
    ).select("n_documents", "n_topics", row_total(topic_words).alias("n_topic_words"))


def words_for_display(topic_words: DataFrame, n: int = 15) -> DataFrame:
    """First ``n`` words of each topic, lightest first."""
    return topic_words.where(F.col("rank") <= n).orderBy("topic_id", "weight", F.desc("word"))


def topic_document_block(doc_topics: DataFrame) -> DataFrame:
    """Topics x documents in long form: ``(topic_id, id, weight)``."""
    return doc_topics.select("id", F.posexplode("topic_dist").alias("topic_id", "weight")).select(
        "topic_id", "id", "weight"
    )


def explore(
    wide: DataFrame,
    id_contains: str | None = None,
    topic: int | None = None,
    sort_by: str | None = None,
    ascending: bool = False,
) -> DataFrame:
    """Filter a wide document-topic table by id text and topic, and sort it by a column."""
    out = wide
    if id_contains:
        out = out.where(F.contains(F.lower(F.col("id").cast("string")), F.lit(id_contains.lower())))
    if topic is not None:
        out = out.where(F.col("dominant_topic") == topic)
    if sort_by:
        first: Column = F.asc(sort_by) if ascending else F.desc(sort_by)
        out = out.orderBy(first, "id")
    return out


def run_summary(
    alignment_summary: DataFrame, overall: DataFrame, category_totals: DataFrame, sweep: DataFrame
) -> DataFrame:
    """One row: chosen topics and score, agreement with the categories, corpus totals."""
    chosen = sweep.where("is_optimal")
    return alignment_summary.select(
        chosen.select("k").scalar().alias("optimal_topics"),
        chosen.select("score").scalar().alias("optimal_score"),
        overall.select("accuracy").scalar().alias("accuracy"),
        overall.select("f1_weighted").scalar().alias("f1_weighted"),
        overall.select("f1_macro").scalar().alias("f1_macro"),
        "ari",
        "nmi",
        "average_purity",
        category_totals.select("total_papers").scalar().alias("total_papers"),
        category_totals.select("n_primary_categories").scalar().alias("n_primary_categories"),
        category_totals.select("n_all_categories").scalar().alias("n_all_categories"),
    )


def sweep_curve(sweep: DataFrame) -> DataFrame:
    return sweep.select("k", "score", "is_optimal").orderBy("k")
