"""Several topic models scored on the same documents."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from topicloom.config import TopicConfig
from topicloom.operators import alignment as al, metrics as me


def evaluate_method(
    docs: DataFrame, doc_topics: DataFrame, k: int, method: str, config: TopicConfig = TopicConfig()
) -> dict[str, DataFrame]:
    """Alignment, predictions and metrics of one method."""
    tables = al.alignment(docs, doc_topics, k)
    predicted = al.predicted_by_topic(tables["contingency"], k)
    pairs = al.label_pairs(tables["contingency"], predicted)
    scores = me.classification(pairs, min_support=config.min_category_count)
    top = me.top_classification(pairs, config.top_categories)
    top_row = top["overall"]
    summary = scores["overall"].select(
        F.lit(method).alias("method"),
        "accuracy",
        "f1_weighted",
        "f1_macro",
        F.lit(k).alias("num_topics"),
        top_row.select("accuracy").scalar().alias("top_accuracy"),
        top_row.select("f1_weighted").scalar().alias("top_f1_weighted"),
    )
    return {
        **tables,
        "predicted_by_topic": predicted,
        "pairs": pairs,
        "overall": scores["overall"],
        "per_category": scores["per_category"],
        "confusion": scores["confusion"],
        "top_overall": top["overall"],
        "top_per_category": top["per_category"],
        "method_summary": summary,
    }


def compare_methods(
    docs: DataFrame,
    results: Mapping[str, tuple[DataFrame, int] | None],
    config: TopicConfig = TopicConfig(),
) -> DataFrame:
    """Summary row of every available method, in the order given.

    ``results`` maps a method to its document topics and topic count; a method without
    results maps to None and is skipped.
    """
    rows = [
        evaluate_method(docs, found[0], found[1], method, config)["method_summary"].withColumn("position", F.lit(i))
        for i, (method, found) in enumerate(results.items())
        if found is not None
    ]
    if not rows:
        raise ValueError("no method has results")
    return reduce(DataFrame.unionByName, rows)


def comparison_summary(rows: DataFrame) -> DataFrame:
    """Method, accuracy, F1 and topic counts."""
    return rows.select(
        "method", "accuracy", "f1_weighted", "f1_macro", "num_topics", "top_accuracy", "top_f1_weighted"
    )


def best_method(rows: DataFrame) -> DataFrame:
    """The method with the highest accuracy above 0; the earlier method wins a tie."""
    best = rows.where(F.col("accuracy") > 0).orderBy(F.desc("accuracy"), "position").limit(1)
    return best.select("method", "accuracy")


def method_rows(rows: DataFrame) -> DataFrame:
    """The five figures reported per method, in report order."""
    return rows.orderBy("position").select(
        "position", "method", "accuracy", "f1_weighted", "f1_macro", "top_accuracy", "num_topics"
    )
