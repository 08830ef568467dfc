"""Fitted models on storage, as tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import LDAModel, LocalLDAModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.operators.features import Lexicon
from topicloom.operators.nmf import Factors, factor_table
from topicloom.sources.tables import load_table, save_table


def save_vocabulary(vocab: DataFrame, path: str) -> DataFrame:
    return save_table(vocab, path)


def load_lexicon(spark: SparkSession, path: str) -> Lexicon:
    return Lexicon.of(load_table(spark, path))


def save_lda(model: LDAModel, vocab: DataFrame, path: str) -> str:
    """The model and, next to it, its vocabulary."""
    model.write().overwrite().save(f"{path}/model")
    save_table(vocab, f"{path}/vocabulary")
    return path


def load_lda(spark: SparkSession, path: str) -> tuple[LocalLDAModel, Lexicon]:
    return LocalLDAModel.load(f"{path}/model"), load_lexicon(spark, f"{path}/vocabulary")


def save_nmf(spark: SparkSession, model: Factors, lexicon: Lexicon, path: str) -> DataFrame:
    """H in long form, with the start weight and penalties of the document side."""
    table = factor_table(spark, model, lexicon).select(
        "*", F.lit(float(model.start)).alias("start"), F.lit(model.l1).alias("l1"), F.lit(model.l2).alias("l2")
    )
    return save_table(table, path)


def load_nmf(spark: SparkSession, path: str, lexicon: Lexicon) -> Factors:
    """Topics x vocabulary rows, bounded by the vocabulary cap."""
    frame = load_table(spark, path).toPandas()
    position = {t: i for i, t in enumerate(lexicon.terms)}
    h = np.zeros((int(frame["topic_id"].max()) + 1, len(lexicon)))
    h[frame["topic_id"], frame["word"].map(position)] = frame["weight"]
    first = frame.iloc[0]
    return Factors(h, start=float(first["start"]), l1=float(first["l1"]), l2=float(first["l2"]))


def save_clusters(centroids: DataFrame, path: str) -> DataFrame:
    """Centroids of an embedding-cluster model: ``(topic, centroid)``."""
    return save_table(centroids, path)
