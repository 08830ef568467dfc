"""Online LDA against plain formulas, on planted topics, and after a loss."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from planted import adjusted_rand, topic_corpus
from topicloom.config import TopicConfig
from topicloom.operators import features as fe, online_lda as ol


@pytest.fixture(scope="module")
def planted(spark):
    rows = topic_corpus(k=4, docs=50)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, tokens array<string>")
    lexicon = fe.Lexicon.of(fe.vocabulary(docs))
    found = fe.sparse_rows(fe.feature_vectors(docs, lexicon, "bow")).persist()
    return found, lexicon, {i: label for i, _, label in rows}


def test_gamma_functions():
    x = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 7.0, 123.4])
    h = 1e-5
    slope = [(math.lgamma(v * (1 + h)) - math.lgamma(v * (1 - h))) / (2 * h * v) for v in x]
    assert ol.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)
    assert ol.digamma(x) == pytest.approx(slope, rel=1e-7, abs=1e-7)
    assert ol.trigamma(x) == pytest.approx((ol.digamma(x * (1 + h)) - ol.digamma(x * (1 - h))) / (2 * h * x), rel=1e-6)


def plain_sums(docs, model):
    """Topic sums and bound by loops over documents and words."""
    shares = np.exp(ol.expected_logs(model.weights))
    parts, bound = np.zeros_like(model.weights), 0.0
    for words in docs:
        gamma = model.prior + sum(words.values()) / model.k
        for _ in range(400):
            theta = np.exp(ol.digamma(gamma) - ol.digamma(gamma.sum()))
            after = model.prior.copy()
            for w, n in words.items():
                after += n * theta * shares[:, w] / (theta @ shares[:, w])
            gamma = after
        theta = np.exp(ol.digamma(gamma) - ol.digamma(gamma.sum()))
        for w, n in words.items():
            parts[:, w] += n * theta * shares[:, w] / (theta @ shares[:, w])
            bound += n * math.log(theta @ shares[:, w])
        bound += ((model.prior - gamma) * np.log(theta)).sum() + math.lgamma(model.prior.sum()) - math.lgamma(gamma.sum())
        bound += sum(math.lgamma(g) - math.lgamma(a) for g, a in zip(gamma, model.prior))
    return parts, bound


def test_sums_are_the_plain_ones(spark):
    chance = np.random.default_rng(1)
    docs = [{int(w): int(n) for w, n in zip(chance.permutation(12)[:5], chance.integers(1, 6, 5))} for _ in range(20)]
    rows = [(i, sorted(d), [float(d[w]) for w in sorted(d)]) for i, d in enumerate(docs)] + [(99, [], [])]
    df = spark.createDataFrame(rows, "id long, indices array<int>, weights array<double>").repartition(3)
    models = {k: ol.OnlineLda(chance.gamma(3, 1, (k, 12)), np.full(k, 0.4)) for k in (2, 3)}
    for k, found in ol.update_sums(df, models, 12, steps=400, least_change=0.0).items():
        parts, bound = plain_sums(docs, models[k])
        assert found["parts"] == pytest.approx(parts, rel=1e-6, abs=1e-9) and found["bound"] == pytest.approx(bound, rel=1e-9)
        assert found["docs"] == 20 and found["tokens"] == sum(sum(d.values()) for d in docs)


@pytest.mark.parametrize("share", [1.0, 0.25])
def test_planted_topics_and_trace(spark, planted, share):
    rows, lexicon, labels = planted
    config = TopicConfig(lda_batch_share=share)
    models = ol.fit_many(rows, len(lexicon), [2, 4], config, passes=12 if share == 1 else 6)
    trace = ol.trace_table(spark, models).collect()
    own = [r["log_perplexity"] for r in trace if r["k"] == 4]
    assert len(own) == (12 if share == 1 else 24) and np.mean(own[-4:]) < np.mean(own[:4]) - 0.1
    assert np.mean(own[-4:]) < np.mean([r["log_perplexity"] for r in trace if r["k"] == 2][-4:]), "four topics fit better than two"
    dist = {r["id"]: r["topic_dist"] for r in ol.document_topics(rows, models[4]).collect()}
    assert all(sum(d) == pytest.approx(1) for d in dist.values())
    ids = sorted(labels)
    assert adjusted_rand([int(np.argmax(dist[i])) for i in ids], [labels[i] for i in ids]) >= 0.9
    words = ol.topic_words(spark, models[4], lexicon, 8).collect()
    assert all(len({r["word"][0] for r in words if r["topic_id"] == t}) == 1 for t in range(4))


def test_topic_counts_share_passes_without_touching_each_other(planted):
    rows, lexicon, _ = planted
    together = ol.fit_many(rows, len(lexicon), [2, 3], passes=3)
    alone = ol.fit_many(rows, len(lexicon), [3], passes=3)[3]
    assert together[3].weights == pytest.approx(alone.weights) and together[3].prior == pytest.approx(alone.prior)


def test_a_fit_goes_on_from_its_stored_state(planted, tmp_path):
    rows, lexicon, _ = planted
    config = TopicConfig(lda_batch_share=0.5)
    whole = ol.fit_many(rows, len(lexicon), [3], config, passes=4)[3]
    path = str(tmp_path / "state")
    ol.fit_many(rows, len(lexicon), [3], config, passes=2, state_path=path, every=3)  # stores update 3 of 4
    again = ol.fit_many(rows, len(lexicon), [3], config, passes=4, state_path=path, every=3)[3]
    assert again.trace[0][0] == 4 and again.weights == pytest.approx(whole.weights, rel=1e-9)


def test_shares_are_read_alone(spark, planted):
    rows, lexicon, _ = planted
    counts = []
    plain = ol.update_sums

    def counted(own, models, n_terms):
        counts.append(own.count())
        return plain(own, models, n_terms)

    ol.update_sums = counted
    try:
        ol.fit_many(rows, len(lexicon), [2], TopicConfig(lda_batch_share=0.25), passes=2)
    finally:
        ol.update_sums = plain
    assert len(counts) == 8 and sum(counts) == 2 * rows.count()
    assert ol.fit_many(rows.limit(0), len(lexicon), [2], passes=2)[2].trace == []


def test_topics_of_a_document_do_not_depend_on_its_slice():
    """A document that takes long to settle doesn't change what others get."""
    chance = np.random.default_rng(5)
    shares, prior = chance.gamma(0.3, 1.0, (40, 4)) + 1e-3, np.full(4, 0.25)
    lengths = chance.integers(1, 30, 60)
    terms = np.concatenate([chance.choice(40, n, replace=False) for n in lengths])
    counts, bounds = chance.integers(1, 60, len(terms)).astype(float), np.concatenate([[0], np.cumsum(lengths)])
    together = ol.row_topics(counts, terms, bounds, shares, prior)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        alone = ol.row_topics(counts[a:b], terms[a:b], np.array([0, b - a]), shares, prior)
        assert together[0][i] == pytest.approx(alone[0][0], rel=1e-9)
        assert together[1][a:b] == pytest.approx(alone[1], rel=1e-9)


def test_blocks_of_documents_settle_as_one_by_one(monkeypatch):
    """Padding and the cut into blocks don't change what a document gets, from a given start."""
    chance = np.random.default_rng(6)
    shares, prior, start = chance.gamma(0.3, 1.0, (80, 3)) + 1e-3, np.array([0.1, 0.4, 0.02]), np.array([1.1, 0.9, 1.0])
    lengths = np.append(chance.integers(1, 60, 70), 1)
    terms = np.concatenate([chance.choice(80, n, replace=False) for n in lengths])
    counts, bounds = chance.gamma(1.0, 1.0, len(terms)), np.concatenate([[0], np.cumsum(lengths)])
    for cells in (1, 600, 10**6):
        monkeypatch.setattr(ol, "BLOCK_CELLS", cells)
        gamma, theta, norms = ol.settle(counts, terms, bounds, shares, prior, ol.ANY_STEPS, 1e-3, start)
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            now, own, n, change = start, shares[terms[a:b]], counts[a:b], 1.0
            while change > 1e-3:
                part = np.exp(ol.digamma(now) - ol.digamma(now.sum()))
                after = prior + part * (own.T @ (n / (own @ part)))
                now, change = after, np.abs(after - now).mean()
            part = np.exp(ol.digamma(now) - ol.digamma(now.sum()))
            assert gamma[i] == pytest.approx(now, rel=1e-9) and theta[i] == pytest.approx(part, rel=1e-9)
            assert norms[a:b] == pytest.approx(own @ part, rel=1e-9)
