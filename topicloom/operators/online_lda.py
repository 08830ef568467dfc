"""Latent Dirichlet allocation by online variational updates over shares of the documents.

The documents are dealt into shares once and written by share, so an update reads its own share
and nothing else: a fit scans the documents as often as it has passes, whatever the size of a
share. All topic counts of a sweep are updated in the same pass. Tasks return sums of topics x
vocabulary, which Spark adds up; documents keep no state.

Every update also gives the variational bound of its share under the model before the update,
so the trace of log perplexity costs nothing. The state is appended to a table every few
updates; a fit that finds a state there goes on from it.

Documents without a term of the vocabulary take no part in a fit, and have equal shares of all
topics.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.config import TopicConfig
from topicloom.operators import topics
from topicloom.operators.coherence import topic_coherence
from topicloom.operators.features import Lexicon
from topicloom.operators.nmf import _slices
from topicloom.runtime import array_sums, shared_path

#: Steps for the topic shares of a document, and the mean change at which they end.
ROW_STEPS, ROW_CHANGE = 50, 1e-3

#: Steps where nothing but the change ends them.
ANY_STEPS = 10**9

#: Cells of terms x topics handled at a time, and sparse entries of the slice they are picked from.
BLOCK_CELLS, SLICE_ENTRIES = 512_000, 1_000_000

#: How fast updates lose weight: (OFFSET + update) ** -DECAY.
OFFSET, DECAY = 1.0, 0.5

TINY = 1e-100


@dataclass
class OnlineLda:
    """A fitted model: ``weights`` is topics x vocabulary, ``prior`` the document prior."""

    weights: np.ndarray
    prior: np.ndarray
    update: int = 0
    #: ``(update, documents, log perplexity)`` of every update of this session.
    trace: list[tuple[int, int, float]] = field(default_factory=list)

    @property
    def k(self) -> int:
        return len(self.weights)

    def term_shares(self) -> np.ndarray:
        return self.weights / self.weights.sum(axis=1, keepdims=True)


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the logarithm of the gamma function, for positive numbers."""
    x, out = np.array(x, float), 0.0
    for _ in range(12):  # up to where the series is good to twelve digits
        out, x = out - 1 / x, x + 1
    s = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of the logarithm of the gamma function, for positive numbers."""
    x, out = np.array(x, float), 0.0
    for _ in range(12):
        out, x = out + 1 / (x * x), x + 1
    s = 1 / (x * x)
    return out + 1 / x + 0.5 * s + s / x * (1 / 6 - s * (1 / 30 - s * (1 / 42 - s / 30)))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function, for positive numbers."""
    x, out = np.array(x, float), 0.0
    for _ in range(12):
        out, x = out - np.log(x), x + 1
    s = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s / 1680))) / x


def expected_logs(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms of Dirichlet variables, row by row."""
    return digamma(weights) - digamma(weights.sum(axis=1, keepdims=True))


def _exp_digamma(x: np.ndarray) -> np.ndarray:
    """Exponential of ``digamma``, with one division for six steps up to where its series is good."""
    y = x * (x + 5)
    a, b = y + 4, y + 6
    ya = y * a
    steps = (2 * x + 5) * (a * b + y * b + ya) / (ya * b)
    z = x + 6
    r = 1 / z
    s = r * r
    series = s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s * (1 / 132 - s * (691 / 32760 - s / 12))))))
    return z * np.exp(-(steps + 0.5 * r + series))


def _topic_shares(gamma: np.ndarray) -> np.ndarray:
    """Exponentials of ``expected_logs``."""
    both = _exp_digamma(np.concatenate([gamma, gamma.sum(axis=1, keepdims=True)], axis=1))
    return both[:, :-1] / both[:, -1:]


def _blocks(lengths: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Documents of about the same length, filled up to ``BLOCK_CELLS`` cells of terms x topics."""
    order = np.argsort(lengths, kind="stable")
    ordered, first = lengths[order], 0
    while first < len(order):
        widest = max(int(ordered[first] * 1.25), int(ordered[first]) + 8)
        last = int(np.searchsorted(ordered, widest, side="right"))
        last = min(last, first + max(1, BLOCK_CELLS // (k * widest)))
        yield order[first:last]
        first = last


def settle(
    counts: np.ndarray,
    terms: np.ndarray,
    bounds: np.ndarray,
    shares: np.ndarray,
    prior: np.ndarray,
    steps: int = ROW_STEPS,
    least_change: float = ROW_CHANGE,
    start: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(gamma, theta, norms)`` of a slice of documents, none of them empty.

    ``shares`` is vocabulary x topics, exponentials of expected logarithms. ``gamma`` holds the
    topic weights of the documents, ``theta`` the exponentials of their expected logarithms, and
    ``norms`` the likelihood of every entry. Documents start with even weights or from ``start``,
    so a result depends on nothing but the document and the model.

    Documents of about the same length are settled together, as products of small matrices
    padded with counts of zero.
    """
    k, lengths, table = len(prior), np.diff(bounds), np.ascontiguousarray(shares.T)
    gamma, theta, norms = np.empty((len(lengths), k)), np.empty((len(lengths), k)), np.empty(len(counts))
    gamma[:] = prior + (np.add.reduceat(counts, bounds[:-1]) / k)[:, None] if start is None else start
    for docs in _blocks(lengths, k):
        places = np.arange(lengths[docs[-1]])
        inside = places < lengths[docs][:, None]
        at = bounds[docs][:, None] + np.where(inside, places, 0)
        own, n = table[:, terms[at]], np.where(inside, counts[at], 0.0)
        # documents leave once they are settled, so that a slow one doesn't hold up its block
        live, done = np.arange(len(docs)), np.zeros(len(docs), bool)
        mine, left, now, found = own, n, gamma[docs], np.empty((len(docs), k))
        for _ in range(steps):
            part = _topic_shares(now)
            weights = mine.transpose(1, 0, 2)
            whole = np.matmul(part[:, None, :], weights)[:, 0] + TINY
            after = prior + part * np.matmul(weights, (left / whole)[:, :, None])[:, :, 0]
            found[live[~done]] = after[~done]
            done |= ~(np.abs(after - now).mean(axis=1) > least_change)
            now = after
            if done.all():
                break
            if done.mean() > 0.25:
                kept = ~done
                mine, left, live, now = mine[:, kept], left[kept], live[kept], now[kept]
                done = np.zeros(len(live), bool)
        gamma[docs], theta[docs] = found, _topic_shares(found)
        norms[at[inside]] = (np.matmul(theta[docs][:, None, :], own.transpose(1, 0, 2))[:, 0] + TINY)[inside]
    return gamma, theta, norms


def row_topics(
    counts: np.ndarray, terms: np.ndarray, bounds: np.ndarray, shares: np.ndarray, prior: np.ndarray, **steps
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(gamma, parts, norms)`` of a slice of documents, see ``settle``; ``parts`` is how every
    entry's count falls on topics."""
    gamma, theta, norms = settle(counts, terms, bounds, shares, prior, **steps)
    return gamma, np.repeat(theta, np.diff(bounds), axis=0) * shares[terms] * (counts / norms)[:, None], norms


def _bounds(gamma: np.ndarray, prior: np.ndarray, counts: np.ndarray, norms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Variational bound of each document of a slice, without the topics' own part."""
    logs = expected_logs(gamma)
    whole = np.add.reduceat(counts * np.log(norms), bounds[:-1])
    whole = whole + ((prior - gamma) * logs).sum(axis=1) + (log_gamma(gamma) - log_gamma(prior)).sum(axis=1)
    return whole + log_gamma(prior.sum()) - log_gamma(gamma.sum(axis=1))


def _filled(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, counts, terms, bounds)`` of slices without their empty documents."""
    for low, _, counts, terms, bounds in _slices(batch, SLICE_ENTRIES):
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            yield low + some, counts, terms, np.append(bounds[:-1][some], bounds[-1])


def _without_repeats(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows that follow each other with the same ``row`` are one, and how many these were."""
    numbers = batch.column(batch.schema.get_field_index("row")).to_numpy(zero_copy_only=False)
    first = np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)]
    times = np.diff(np.append(np.flatnonzero(first), len(numbers)))
    return batch.filter(pa.array(first)), times


#: Sums over documents, which every task returns after those of terms.
_LOGS, _BOUND, _TOKENS, _DOCS, _ROWS = range(5)


def update_sums(
    rows: DataFrame, models: dict[int, OnlineLda], n_terms: int, starts: Callable[[int, int], np.ndarray] | None = None, **steps
) -> dict[int, dict]:
    """What one update needs of every model: ``parts`` (topics x vocabulary), ``logs`` (sums of
    expected logarithms of topic shares), ``bound``, ``tokens``, ``docs`` and ``rows`` (empty
    documents included).

    The driver gets topics x vocabulary numbers of every model, bounded by the vocabulary's cap.
    ``starts`` gives the weights that the documents of a partition start with, by its number and
    that of topics; such rows have a number ``row``, and those that repeat it are computed once.
    ``steps`` goes to ``settle``.
    """
    shared = {k: (np.exp(expected_logs(m.weights)).T, m.prior) for k, m in models.items()}
    ends = np.cumsum([0, *shared]).tolist()
    place = {k: slice(a, b) for k, a, b in zip(shared, ends, ends[1:])}

    def partial(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        parts, extra = np.zeros((ends[-1], n_terms)), np.zeros((5, ends[-1]))
        own = dict.fromkeys(shared)
        for batch in batches:
            if starts is not None:
                own = {k: starts(TaskContext.get().partitionId(), k) for k in shared}
            extra[_ROWS] += batch.num_rows
            batch, repeats = (batch, None) if starts is None else _without_repeats(batch)
            for at, counts, terms, bounds in _filled(batch):
                lengths = np.diff(bounds)
                times = np.ones(len(at)) if repeats is None else repeats[at] * (np.add.reduceat(counts, bounds[:-1]) > 0)
                weighted = np.repeat(times, lengths) * counts
                for k, (shares, prior) in shared.items():
                    gamma, theta, norms = settle(counts, terms, bounds, shares, prior, start=own[k], **steps)
                    ratio = weighted / norms
                    for t in range(k):
                        falls = np.bincount(terms, ratio * np.repeat(theta[:, t], lengths), minlength=n_terms)
                        parts[place[k].start + t] += falls
                    extra[_LOGS, place[k]] += times @ expected_logs(gamma)
                    extra[_BOUND, place[k]] += times @ _bounds(gamma, prior, counts, norms, bounds)
                extra[_TOKENS] += weighted.sum()
                extra[_DOCS] += times.sum()
        for k, (shares, _) in shared.items():
            parts[place[k]] *= shares.T
        return [*parts, *extra]

    needed = [c for c in ("row", "indices", "weights") if c != "row" or starts is not None]
    sums = array_sums(rows.select(*needed), partial)
    parts, extra = np.array(sums[: ends[-1]]), sums[ends[-1] :]
    return {
        k: {
            "parts": parts[own],
            "logs": extra[_LOGS][own],
            "bound": float(extra[_BOUND][own.start]),
            "tokens": float(extra[_TOKENS][own.start]),
            "docs": int(extra[_DOCS][own.start]),
            "rows": int(extra[_ROWS][own.start]),
        }
        for k, own in place.items()
    }


def better_prior(prior: np.ndarray, logs: np.ndarray, docs: int, rate: float) -> np.ndarray:
    """One Newton step of the document prior towards the sums of expected logarithms."""
    total = prior.sum()
    slope = docs * (digamma(total) - digamma(prior) + logs / docs)
    bend = -docs * trigamma(prior)
    shift = (slope / bend).sum() / (1 / (docs * trigamma(total)) + (1 / bend).sum())
    after = prior - rate * (slope - shift) / bend
    return after if (after > 0).all() else prior


def _topic_part(model: OnlineLda, eta: float) -> float:
    """The topics' own part of the bound."""
    logs, w = expected_logs(model.weights), model.weights
    part = ((eta - w) * logs).sum() + (log_gamma(w) - log_gamma(np.float64(eta))).sum()
    return float(part + (log_gamma(np.float64(eta * w.shape[1])) - log_gamma(w.sum(axis=1))).sum())


def save_state(spark: SparkSession, models: dict[int, OnlineLda], path: str) -> None:
    """Append the state of all models; a table of topics x vocabulary numbers an update."""
    rows = [(k, m.update, t, m.weights[t].tolist(), float(m.prior[t])) for k, m in models.items() for t in range(k)]
    spark.createDataFrame(rows, "k int, update int, topic int, weights array<double>, prior double").write.mode("append").parquet(path)


def load_state(spark: SparkSession, ks: Sequence[int], path: str) -> dict[int, OnlineLda] | None:
    """The latest state that holds all of ``ks`` whole, if there is one."""
    try:
        states = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    states = states.where(F.col("k").isin(list(ks))).dropDuplicates(["k", "update", "topic"])
    whole = states.groupBy("update").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == sum(ks))
    last = whole.agg(F.max("update").alias("u")).first()["u"]
    if last is None:
        return None
    models = {}
    rows = states.where(F.col("update") == last).orderBy("k", "topic").collect()
    for k in ks:
        own = [r for r in rows if r["k"] == k]
        models[k] = OnlineLda(np.array([r["weights"] for r in own]), np.array([r["prior"] for r in own]), last)
    return models


def fit_many(
    rows: DataFrame,
    n_terms: int,
    ks: Sequence[int],
    config: TopicConfig = TopicConfig(),
    passes: int | None = None,
    state_path: str | None = None,
    every: int = 10,
) -> dict[int, OnlineLda]:
    """Fit a model for each topic count in the same passes.

    ``rows`` is ``(id, indices, weights)``. With ``config.lda_batch_share`` below 1 an update
    takes that share of the documents, which are dealt by a hash of their id. With
    ``state_path`` the state is stored every ``every`` updates and a fit goes on from there.
    """
    spark = rows.sparkSession
    passes = config.lda_passes if passes is None else passes
    batches = max(1, round(1 / config.lda_batch_share))
    if batches > 1:
        path = shared_path(spark, "lda_shares")
        dealt = rows.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int"))
        dealt.repartition("share", F.spark_partition_id()).write.partitionBy("share").parquet(path)
        rows = spark.read.schema(dealt.schema).parquet(path)
    eta = config.lda_topic_prior
    models = load_state(spark, ks, state_path) if state_path else None
    if models is None:
        models = {
            k: OnlineLda(np.random.RandomState(config.seed).gamma(100.0, 0.01, (k, n_terms)), np.full(k, 1.0 / k)) for k in ks
        }
    n_docs = rows.where(F.size("indices") > 0).count()
    if not n_docs:
        return models
    for update in range(min(m.update for m in models.values()), passes * batches):
        own = rows.where(F.col("share") == update % batches) if batches > 1 else rows
        sums = update_sums(own, models, n_terms) if batches == 1 or not own.isEmpty() else {}
        rate = (OFFSET + update) ** -DECAY
        for k, m in models.items():
            m.update = update + 1
            found = sums.get(k)
            if not found or not found["docs"]:
                continue
            scale = n_docs / found["docs"]
            whole = scale * found["bound"] + _topic_part(m, eta)
            m.trace.append((update + 1, found["docs"], -whole / max(scale * found["tokens"], TINY)))
            m.weights = (1 - rate) * m.weights + rate * (eta + scale * found["parts"])
            m.prior = better_prior(m.prior, found["logs"], found["docs"], rate)
        if state_path and (update + 1) % every == 0:
            save_state(spark, models, state_path)
    return models


def sweep(
    rows: DataFrame, docs: DataFrame, lexicon: Lexicon, ks: Sequence[int], config: TopicConfig = TopicConfig(), **fit_options
) -> tuple[DataFrame, OnlineLda]:
    """Coherence of every topic count over ``docs``, and the model with the highest.

    All models are fitted in the same passes, and their words are scored in one more.
    """
    spark, step = rows.sparkSession, max(ks)
    models = fit_many(rows, len(lexicon), ks, config, **fit_options)
    # topic t of the model at position i is numbered i * step + t meanwhile
    words = [
        topic_words(spark, models[k], lexicon, config.coherence_words).withColumn("topic_id", F.col("topic_id") + i * step)
        for i, k in enumerate(ks)
    ]
    coherence = topic_coherence(docs, reduce(DataFrame.unionByName, words), config.coherence)
    position = F.floor(F.col("topic_id") / step).cast("int").alias("position")
    means = {r["position"]: r["score"] for r in coherence.groupBy(position).agg(F.avg("coherence").alias("score")).collect()}
    table = topics.sweep_table(spark, ks, [means[i] for i in range(len(ks))], largest=True)
    return table, models[topics.chosen_k(table)]


def trace_table(spark: SparkSession, models: dict[int, OnlineLda], every: int = 1) -> DataFrame:
    """``(k, update, documents, log_perplexity)`` of every ``every``-th update."""
    rows = [(k, u, n, x) for k, m in models.items() for u, n, x in m.trace if u % every == 0]
    return spark.createDataFrame(rows, "k int, update int, documents long, log_perplexity double")


def topic_words(spark: SparkSession, model: OnlineLda, lexicon: Lexicon, n: int = 15) -> DataFrame:
    shares = model.term_shares()
    best = np.argsort(-shares, axis=1, kind="stable")[:, : 2 * n]
    rows = [(t, lexicon.terms[i], float(shares[t, i])) for t in range(model.k) for i in best[t]]
    return topics.rank_words(spark.createDataFrame(rows, "topic_id int, word string, weight double"), n)


def document_topics(rows: DataFrame, model: OnlineLda, start: np.ndarray | None = None, empty: float | None = None) -> DataFrame:
    """``(id, topic_dist)``: shares of the topics in each document, which start even or from
    ``start``. A document without terms has equal shares, or ``empty`` of each."""
    shares, prior, k = np.exp(expected_logs(model.weights)).T, model.prior, model.k
    steps = {} if start is None else {"start": start, "steps": ANY_STEPS}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full((batch.num_rows, k), 1.0 / k if empty is None else empty)
            for at, counts, terms, bounds in _filled(batch):
                gamma = settle(counts, terms, bounds, shares, prior, **steps)[0]
                out[at] = gamma / gamma.sum(axis=1, keepdims=True)
            offsets = pa.array(np.arange(0, out.size + 1, k, dtype=np.int32))
            ids = batch.column(batch.schema.get_field_index("id"))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], ["id", "topic_dist"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "indices", "weights").mapInArrow(solve, f"id {kind}, topic_dist array<double>")
