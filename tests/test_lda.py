"""LDA as Spark ML fits it: the same models, with passes that all topic counts share. Methods side by side."""

import threading

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from planted import topic_corpus
from topicloom.config import TopicConfig
from topicloom.operators import features as fe, lda, online_lda as ol
from topicloom.plans import runs
from topicloom.runtime import array_sums


@pytest.fixture(scope="module")
def planted(spark):
    rows = topic_corpus(k=3, words=20, docs=30)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, ["unknown"])], "id long, tokens array<string>")
    docs = docs.repartition(3).persist()
    lexicon = fe.Lexicon.of(fe.vocabulary(docs))
    return docs, lexicon, fe.tfidf_vectors(docs, lexicon).select("id", "features").persist()


def by_spark(vectors, k, passes, share=1.0):
    batches = round(1 / share)
    config = TopicConfig()
    return LDA(
        k=k, optimizer="online", optimizeDocConcentration=True, topicConcentration=config.lda_topic_prior,
        subsamplingRate=1.0 / batches, maxIter=passes * batches, seed=config.seed, featuresCol="features",
    ).fit(vectors)


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_models_are_those_of_spark(planted, share):
    _, _, vectors = planted
    found = lda.fit_many(vectors, [2, 3], TopicConfig(lda_batch_share=share), passes=3)
    for k in (2, 3):
        want = by_spark(vectors, k, 3, share)
        assert found[k].topicsMatrix().toArray() == pytest.approx(want.topicsMatrix().toArray(), rel=1e-7)
        assert found[k].estimatedDocConcentration().toArray() == pytest.approx(want.estimatedDocConcentration().toArray(), rel=1e-7)
        assert (found[k].getK(), found[k].getMaxIter()) == (want.getK(), want.getMaxIter())


def test_a_sweep_reads_the_vectors_once_a_pass(planted, monkeypatch):
    docs, lexicon, vectors = planted
    read, plain = [], ol.update_sums

    def counted(rows, models, *more, **steps):
        read.append(sorted(models))
        return plain(rows, models, *more, **steps)

    monkeypatch.setattr(ol, "update_sums", counted)
    table, model = lda.sweep(vectors, docs, lexicon, [2, 3, 4], passes=2)
    assert read == [[2, 3, 4]] * 2
    assert [r["k"] for r in table.orderBy("k").collect()] == [2, 3, 4] and model.getK() in (2, 3, 4)


def test_topics_and_likelihood_are_those_of_spark(planted, tmp_path):
    _, _, vectors = planted
    model = by_spark(vectors, 3, 2)
    want = model.transform(vectors).select("id", vector_to_array("topicDistribution").alias("d")).collect()
    got = {r["id"]: r["topic_dist"] for r in lda.document_topics(model, vectors).collect()}
    assert got[900] == [0.0] * 3 and len(got) == len(want)
    assert all(got[r["id"]] == pytest.approx(list(r["d"]), abs=1e-9) for r in want)
    quality = lda.fit_quality(model, vectors).first()
    assert quality["log_likelihood"] == pytest.approx(model.logLikelihood(vectors), rel=1e-7)
    assert quality["log_perplexity"] == pytest.approx(model.logPerplexity(vectors), rel=1e-7)
    lda.fit_lda(vectors, 2, passes=1).write().save(str(tmp_path / "m"))


def test_quality_and_topics_take_one_pass_of_their_own(planted, monkeypatch):
    """Neither Spark ML's likelihood, which makes topics x vocabulary exponentials for every
    document, nor its perplexity, which does so again, is asked for."""
    _, _, vectors = planted
    model = by_spark(vectors, 2, 1)

    def unwanted(*_):
        raise AssertionError("a pass of Spark ML")

    for name in ("logLikelihood", "logPerplexity", "transform"):
        monkeypatch.setattr(type(model), name, unwanted)
    passes, plain = [], type(vectors).mapInArrow
    monkeypatch.setattr(type(vectors), "mapInArrow", lambda df, *more: passes.append(1) or plain(df, *more))
    quality = lda.fit_quality(model, vectors).first()
    assert len(passes) == 1 and quality["log_likelihood"] < 0 < quality["log_perplexity"]
    assert lda.document_topics(model, vectors).count() == vectors.count()


def test_dense_vectors_and_zeros_count_as_in_spark(spark):
    rows = [(i, Vectors.dense([i % 3, 1.0, (i * 7) % 4, 0.0])) for i in range(30)] + [(40, Vectors.dense([0.0] * 4))]
    vectors = spark.createDataFrame(rows, ["id", "features"]).coalesce(2).persist()
    found, want = lda.fit_lda(vectors, 2, passes=4), by_spark(vectors, 2, 4)
    assert found.topicsMatrix().toArray() == pytest.approx(want.topicsMatrix().toArray(), rel=1e-7)
    assert lda.fit_quality(found, vectors).first()["log_likelihood"] == pytest.approx(want.logLikelihood(vectors), rel=1e-7)


@pytest.mark.parametrize("seed", [7, -3, 5 << 32, (1 << 62) + 12345])
def test_start_weights_are_those_of_spark(spark, seed):
    random, gamma = spark._jvm.org.apache.commons.math3.random, spark._jvm.breeze.stats.distributions
    twister = random.MersenneTwister(0)
    words = spark.sparkContext._gateway.new_array(spark._jvm.int, 2)
    for i, w in enumerate(((seed >> 32) & 0xFFFFFFFF, seed & 0xFFFFFFFF)):
        words[i] = w - (1 << 32) if w >> 31 else w
    twister.setSeed(words)
    draws = gamma.Gamma(lda.START_SHAPE, 1 / lda.START_SHAPE, gamma.RandBasis(twister))
    assert lda.start_weights(seed, 7) == pytest.approx([draws.draw() for _ in range(7)], rel=1e-12)


def test_array_sums_of_no_rows(spark):
    def total(batches):
        return [np.full(3, float(sum(b.num_rows for b in batches)))]

    rows = spark.range(10).repartition(4)
    assert array_sums(rows, total)[0].tolist() == [10.0] * 3
    assert array_sums(spark.createDataFrame([], "id long"), total)[0].tolist() == [0.0] * 3
    assert array_sums(rows.where(F.col("id") > 100), total)[0].tolist() == [0.0] * 3


def test_methods_run_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    def waits(features, base, config, find_optimal):
        both.wait()
        return {"rows": spark.range(features["n"])}

    def fails(*_):
        raise ValueError("no topics")

    monkeypatch.setattr(runs, "RUNNERS", {"a": waits, "b": waits, "c": fails})
    found = runs.run_methods({"n": 3}, "unused", methods=("b", "c", "a", "unknown"))
    assert list(found) == ["b", "c", "a", "unknown"] and found["a"]["rows"].count() == found["b"]["rows"].count() == 3
    assert isinstance(found["c"], ValueError) and isinstance(found["unknown"], KeyError)
    assert runs.run_methods({"n": 3}, "unused", methods=()) == {}
