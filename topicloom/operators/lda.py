"""Latent Dirichlet allocation by the online updates of Spark ML, over the sparse feature vectors.

A fit makes the updates that ``pyspark.ml.clustering.LDA`` makes with its online optimiser, from
the same random numbers, and gives the same models. Other than there, all topic counts of a sweep
are updated in the same pass, a document that an update samples repeatedly is settled once, and
documents of about the same length are settled together (see ``online_lda``). So is what is asked
of a fitted model: its likelihood and the topics of documents.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import LDA, LDAModel, LocalLDAModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Matrices as OldMatrices, Vectors as OldVectors
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.config import TopicConfig
from topicloom.operators import online_lda, topics
from topicloom.operators.coherence import topic_coherence
from topicloom.operators.features import Lexicon

#: Shape of the gamma distribution of random starts.
START_SHAPE = 100.0


class _Longs:
    """The numbers of ``java.util.Random.nextLong``, one after the other."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _bits(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        bits = self.state >> 16
        return bits - (1 << 32) if bits >> 31 else bits

    def take(self) -> int:
        return _as_long((self._bits() << 32) + self._bits())

    def peek(self) -> int:
        kept = self.state
        found, self.state = self.take(), kept
        return found


def _as_long(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def start_weights(seed: int, k: int) -> np.ndarray:
    """The topic weights a document starts with: ``k`` gamma variables of mean 1 for a seed, by
    Marsaglia and Tsang over the Mersenne twister, as Spark ML draws them."""
    high, low = (seed >> 32) & 0xFFFFFFFF, seed & 0xFFFFFFFF
    if low:
        bits = random.Random(high | low << 32).getrandbits
    else:  # two words are needed, also where the last is zero
        words = np.random.RandomState([high, low])
        bits = lambda n: int(words.randint(0, 1 << 32, dtype=np.uint64)) >> (32 - n)
    d = START_SHAPE - 1 / 3
    c = 1 / math.sqrt(9 * d)
    spare, out = None, []
    while len(out) < k:
        if spare is None:
            angle = 2 * math.pi * ((bits(26) << 26 | bits(26)) * 2.0**-52)
            size = math.sqrt(-2 * math.log((bits(26) << 26 | bits(26)) * 2.0**-52))
            x, spare = size * math.cos(angle), size * math.sin(angle)
        else:
            x, spare = spare, None
        v = (1 + c * x) ** 3
        if v <= 0:
            continue
        u = (bits(26) << 26 | bits(26)) * 2.0**-52
        if u < 1 - 0.0331 * x**4 or math.log(u) < 0.5 * x * x + d * (1 - v + math.log(v)):
            out.append(d * v / START_SHAPE)
    return np.array(out)


def _numbered(vectors: DataFrame, *more: str) -> DataFrame:
    """``more`` columns, a number ``row``, and the entries ``(indices, weights)`` of each vector."""
    inner = F.unwrap_udt("features")
    places = F.coalesce(inner["indices"], F.sequence(F.lit(0), F.size(inner["values"]) - 1))
    return vectors.select(
        *more, F.monotonically_increasing_id().alias("row"), places.alias("indices"), inner["values"].alias("weights")
    )


def _state(model: LDAModel) -> tuple[online_lda.OnlineLda, float, int]:
    """Weights and prior of a model, its topic prior, and the seed of its starts."""
    old = model._java_obj.oldLocalModel()
    weights = np.ascontiguousarray(model.topicsMatrix().toArray().T)
    state = online_lda.OnlineLda(weights, np.array(model.estimatedDocConcentration().toArray()))
    return state, float(old.topicConcentration()), int(old.seed())


def _as_model(estimator: LDA, state: online_lda.OnlineLda, eta: float, vectors: DataFrame) -> LocalLDAModel:
    """What the estimator's fit would return for the state."""
    spark = vectors.sparkSession
    jvm, context = spark._jvm, spark.sparkContext
    k, n_terms = state.weights.shape
    matrix = _py2java(context, OldMatrices.dense(n_terms, k, state.weights.ravel().tolist()))
    prior = _py2java(context, OldVectors.dense(state.prior.tolist()))
    old = jvm.org.apache.spark.mllib.clustering.LocalLDAModel(matrix, prior, eta, START_SHAPE)
    made = jvm.org.apache.spark.ml.clustering.LocalLDAModel(estimator.uid, n_terms, old, spark._jsparkSession)
    estimator._transfer_params_to_java()
    estimator._java_obj.copyValues(made, jvm.org.apache.spark.ml.param.ParamMap())
    model = LocalLDAModel(made)
    model._resetUid(estimator.uid)
    return estimator._copyValues(model)


def _fit_once(
    vectors: DataFrame, ks: Sequence[int], config: TopicConfig, passes: int, seed: int, n_docs: int
) -> dict[int, LDAModel]:
    """A model of each topic count, updated in the same passes."""
    batches = max(1, round(1 / config.lda_batch_share))
    estimators, models, eta = {}, {}, 0.0
    for k in ks:
        estimator = estimators[k] = LDA(
            k=k,
            optimizer="online",
            optimizeDocConcentration=True,
            topicConcentration=config.lda_topic_prior,
            subsamplingRate=1.0 / batches,
            maxIter=passes * batches,
            seed=seed,
            featuresCol="features",
        )
        # no update is made here: the random start needs one vector, for their size
        models[k], eta, _ = _state(estimator.fit(vectors.limit(1), {estimator.maxIter: 0}))
    offset, decay = estimator.getLearningOffset(), estimator.getLearningDecay()
    rows, n_terms = _numbered(vectors), models[k].weights.shape[1]
    scale = n_docs / math.ceil(n_docs / batches)
    longs = _Longs(seed)
    longs.take()  # the start of the topics
    update = 0
    for _ in range(passes * batches):
        sample = rows.sample(True, 1.0 / batches, longs.take())
        first = longs.peek()
        found = online_lda.update_sums(
            sample, models, n_terms, lambda part, k: start_weights(first + part, k), steps=online_lda.ANY_STEPS
        )
        if not next(iter(found.values()))["rows"]:
            continue  # nothing was sampled, so no number is drawn and the update doesn't count
        longs.take()
        update += 1
        rate = (offset + update) ** -decay
        for k, sums in found.items():
            if sums["docs"]:
                m = models[k]
                m.weights = (1 - rate) * m.weights + rate * (scale * sums["parts"] + eta)
                m.prior = online_lda.better_prior(m.prior, sums["logs"], sums["docs"], rate)
    return {k: _as_model(estimators[k], m, eta, vectors) for k, m in models.items()}


def fit_many(
    vectors: DataFrame,
    ks: Sequence[int],
    config: TopicConfig = TopicConfig(),
    passes: int | None = None,
    restarts: int | None = None,
    n_docs: int | None = None,
) -> dict[int, LDAModel]:
    """Online LDA with a learned document prior, for each topic count.

    Each restart uses the next seed; the model with the lowest log perplexity is kept.
    ``vectors`` should be cached: every update reads it, once for all topic counts. An update
    samples the share ``config.lda_batch_share`` of the documents at every corpus size, so a fit
    scans the vectors ``passes / lda_batch_share`` times.
    """
    passes = config.lda_passes if passes is None else passes
    restarts = config.lda_restarts if restarts is None else restarts
    n_docs = vectors.count() if n_docs is None else n_docs
    best: dict[int, tuple[float, LDAModel]] = {}
    for attempt in range(restarts):
        fitted = _fit_once(vectors, ks, config, passes, config.seed + attempt, n_docs)
        if restarts == 1:
            return fitted
        for k, model in fitted.items():
            score = _likelihood(model, vectors)[1]
            if k not in best or score < best[k][0]:
                best[k] = (score, model)
    return {k: model for k, (_, model) in best.items()}


def fit_lda(vectors: DataFrame, k: int, config: TopicConfig = TopicConfig(), **fit_options) -> LDAModel:
    """Fit one topic count, see ``fit_many``."""
    return fit_many(vectors, [k], config, **fit_options)[k]


def _likelihood(model: LDAModel, vectors: DataFrame) -> tuple[float, float]:
    """Log likelihood bound and log perplexity, in one pass over the vectors.

    As in Spark ML a document starts from weights that its number in the table seeds.
    """
    state, eta, seed = _state(model)
    k, prior, shares = state.k, state.prior, np.exp(online_lda.expected_logs(state.weights)).T

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = tokens = 0.0
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            for at, counts, terms, bounds in online_lda._filled(batch):
                start = np.array([start_weights(seed + n, k) for n in numbers[at].tolist()])
                gamma, _, norms = online_lda.settle(
                    counts, terms, bounds, shares, prior, steps=online_lda.ANY_STEPS, start=start
                )
                some = np.add.reduceat(counts, bounds[:-1]) > 0
                bound += online_lda._bounds(gamma, prior, counts, norms, bounds)[some].sum()
                tokens += counts.sum()
        yield pa.RecordBatch.from_arrays([pa.array([bound]), pa.array([tokens])], ["bound", "tokens"])

    sums = _numbered(vectors).mapInArrow(partial, "bound double, tokens double").agg(F.sum("bound"), F.sum("tokens")).first()
    bound = sums[0] + online_lda._topic_part(state, eta)
    return bound, -bound / sums[1] if sums[1] else math.nan


def fit_quality(model: LDAModel, vectors: DataFrame) -> DataFrame:
    """One row: log likelihood bound and log perplexity."""
    return vectors.sparkSession.createDataFrame([_likelihood(model, vectors)], "log_likelihood double, log_perplexity double")


def topic_words(model: LDAModel, lexicon: Lexicon, n: int = 15) -> DataFrame:
    """First ``n`` words of each topic with their probability."""
    described = model.describeTopics(n)
    spark = described.sparkSession
    named = spark.createDataFrame(list(enumerate(lexicon.terms)), "term_id int, word string")
    words = described.select(
        F.col("topic").alias("topic_id"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "t")
    ).select("topic_id", "pos", F.col("t.termIndices").alias("term_id"), F.col("t.termWeights").alias("weight"))
    # the vocabulary is capped, so its size is known
    return words.join(F.broadcast(named), "term_id").select(
        "topic_id", (F.col("pos") + 1).alias("rank"), "word", "weight"
    )


def topic_term_table(model: LDAModel, lexicon: Lexicon) -> DataFrame:
    """``(topic_id, term, p)``: the whole topic-term distribution, topics x vocabulary."""
    return topic_words(model, lexicon, len(lexicon)).select("topic_id", F.col("word").alias("term"), F.col("weight").alias("p"))


def document_topics(model: LDAModel, vectors: DataFrame) -> DataFrame:
    """``(id, topic_dist)`` with all topics kept; zeros for a document without a term."""
    state, _, seed = _state(model)
    return online_lda.document_topics(_numbered(vectors, "id"), state, start_weights(seed, state.k), empty=0.0)


def sweep(
    vectors: DataFrame,
    docs: DataFrame,
    lexicon: Lexicon,
    ks: Sequence[int],
    config: TopicConfig = TopicConfig(),
    **fit_options,
) -> tuple[DataFrame, LDAModel]:
    """Fit every ``k`` in the same passes, score its coherence over ``docs`` and keep the best model.

    The words of all models are scored in one pass over the documents; topic ``t`` of the
    model at position ``i`` is numbered ``i * max(ks) + t`` meanwhile.
    """
    fitted = fit_many(vectors, ks, config, **fit_options)
    models = [fitted[k] for k in ks]
    step = max(ks)
    words = reduce(
        DataFrame.unionByName,
        [
            topic_words(m, lexicon, config.coherence_words).withColumn("topic_id", F.col("topic_id") + i * step)
            for i, m in enumerate(models)
        ],
    )
    coherence = topic_coherence(docs, words, config.coherence)
    position = F.floor(F.col("topic_id") / step).cast("int").alias("position")
    means = {r["position"]: r["score"] for r in coherence.groupBy(position).agg(F.avg("coherence").alias("score")).collect()}
    scores = [means[i] for i in range(len(ks))]
    table = topics.sweep_table(vectors.sparkSession, ks, scores, largest=True)
    return table, models[scores.index(max(scores))]


# -- tables behind a topic explorer ------------------------------------------------


def topic_shares(doc_topics: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(topic_id, share)``: topic weight over all tokens; ``lengths`` is ``(id, n_tokens)``."""
    weighted = doc_topics.join(lengths, "id").select(
        F.posexplode("topic_dist").alias("topic_id", "p"), F.col("n_tokens")
    )
    sums = weighted.groupBy("topic_id").agg(F.sum(F.col("p") * F.col("n_tokens")).alias("weight"))
    total = sums.agg(F.sum("weight").alias("total")).scalar()
    return sums.select("topic_id", (F.col("weight") / total).alias("share"))


def _marginals(topic_terms: DataFrame, shares: DataFrame) -> DataFrame:
    joint = topic_terms.join(shares, "topic_id").withColumn("joint", F.col("p") * F.col("share"))
    return joint.withColumn("p_term", F.sum("joint").over(Window.partitionBy("term")))


def term_relevance(topic_terms: DataFrame, shares: DataFrame, n: int = 30, weight: float = 0.6) -> DataFrame:
    """The ``n`` most relevant terms of each topic.

    Relevance mixes the log probability in the topic with the log lift over the corpus.
    """
    relevance = weight * F.log("p") + (1 - weight) * F.log(
        F.col("p") / F.nullif(F.col("p_term"), F.lit(0.0))
    )
    scored = _marginals(topic_terms, shares).where("p > 0").withColumn("relevance", relevance)
    order = Window.partitionBy("topic_id").orderBy(F.desc("relevance"), "term")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select("topic_id", "rank", "term", "relevance")
    )


def term_saliency(topic_terms: DataFrame, shares: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` most salient terms: probability times the divergence of their topics."""
    given = F.col("joint") / F.col("p_term")
    distinct = F.sum(F.when(F.col("joint") > 0, given * F.log(given / F.col("share"))).otherwise(0.0))
    salient = (
        _marginals(topic_terms, shares)
        .where("p_term > 0")
        .groupBy("term")
        .agg((F.max("p_term") * distinct).alias("saliency"))
    )
    return salient.orderBy(F.desc(F.round("saliency", 12)), "term").limit(n)


def topic_distances(topic_terms: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence of every two topics.

    A term that only one of two topics has adds its probability times ln 2, so the terms
    can be given without their zeros. Only shared terms are joined; a term has at most
    one row per topic.
    """
    left = topic_terms.select("term", F.col("topic_id").alias("topic_a"), F.col("p").alias("p"))
    right = topic_terms.select("term", F.col("topic_id").alias("topic_b"), F.col("p").alias("q"))
    middle = (F.col("p") + F.col("q")) / 2

    def part(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / middle)).otherwise(0.0)

    shared = (
        left.join(right, "term")
        .where("topic_a < topic_b")
        .groupBy("topic_a", "topic_b")
        .agg(F.sum(part("p") + part("q")).alias("both"), F.sum(F.col("p") + F.col("q")).alias("mass"))
    )
    known = topic_terms.agg(F.collect_set("topic_id").alias("all")).scalar()
    topics_a = topic_terms.select(F.col("topic_id").alias("topic_a")).distinct()
    grid = topics_a.select("topic_a", F.explode(known).alias("topic_b")).where("topic_a < topic_b")
    apart = F.log(F.lit(2.0)) * (2 - F.coalesce("mass", F.lit(0.0)))
    return grid.join(shared, ["topic_a", "topic_b"], "left").select(
        "topic_a", "topic_b", ((F.coalesce("both", F.lit(0.0)) + apart) / 2).alias("distance")
    )
