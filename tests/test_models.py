import random
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from planted import adjusted_rand, topic_corpus, vector_groups
from topicloom.catalog.base import Fitted, processed
from topicloom.config import TopicConfig
from topicloom.operators import alignment as al, clusters as cl, coherence as ch, features as fe, lda, nmf, topics as tp
from topicloom.sources import models as mo


class Planted:
    def __init__(self, spark):
        rows = topic_corpus()
        self.labels = {i: t for i, _, t in rows}
        self.docs = spark.createDataFrame(rows, "id long, tokens array<string>, label int").repartition(4)
        self.vocab = fe.vocabulary(self.docs)
        self.lexicon = fe.Lexicon.of(self.vocab)
        self.vectors = fe.tfidf_vectors(self.docs, self.lexicon).persist(StorageLevel.MEMORY_AND_DISK)
        self.rows = fe.sparse_rows(self.vectors)

    def agreement(self, doc_topics):
        got = {r["id"]: r["dominant_topic"] for r in al.dominant_topics(doc_topics).collect()}
        ids = sorted(self.labels)
        return adjusted_rand([self.labels[i] for i in ids], [got[i] for i in ids])


@pytest.fixture(scope="module")
def planted(spark):
    return Planted(spark)


def test_nmf_finds_planted_topics(spark, planted):
    model = nmf.fit_nmf(planted.rows, len(planted.lexicon), 5)
    assert planted.agreement(nmf.document_topics(planted.rows, model)) >= 0.9
    assert all(b <= a * (1 + 1e-9) for a, b in zip(model.errors, model.errors[1:]))
    dist = nmf.document_topics(planted.rows, model).select(F.aggregate("topic_dist", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert all(abs(r["s"] - 1) < 1e-9 for r in dist.collect())
    words = nmf.topic_words(spark, model, planted.lexicon, 10).collect()
    firsts = {t: Counter(r["word"][0] for r in words if r["topic_id"] == t) for t in range(5)}
    assert all(len(c) == 1 for c in firsts.values()), "words of a topic come from one planted set"


def test_nmf_sweep_fits_all_counts_together(planted):
    together = nmf.fit_many(planted.rows, len(planted.lexicon), [3, 5], max_iter=6)
    alone = nmf.fit_many(planted.rows, len(planted.lexicon), [5], max_iter=6)[5]
    assert together[5].h == pytest.approx(alone.h, rel=1e-6, abs=1e-9)
    table, best = nmf.sweep(planted.rows, len(planted.lexicon), [3, 5], max_iter=6)
    assert tp.chosen_k(table) == best.k == 5


def test_nmf_error_is_the_squared_difference(planted):
    model = nmf.fit_many(planted.rows, len(planted.lexicon), [3], max_iter=2)[3]
    x = np.zeros((len(planted.labels), len(planted.lexicon)))
    for r in planted.rows.collect():
        x[r["id"], r["indices"]] = r["weights"]
    w = np.zeros((len(x), 3))
    for r in nmf.document_weights(planted.rows, model, steps=nmf.ROW_STEPS).collect():
        w[r["id"]] = r["topic_dist"]
    assert np.mean((x - w @ model.h) ** 2) == pytest.approx(model.error, rel=1e-9)


def test_nmf_collapse_is_refitted(planted):
    strong = dict(alpha=0.1, scale_penalty=True, max_iter=5)
    assert nmf.fit_many(planted.rows, len(planted.lexicon), [4], **strong)[4].h.max() <= nmf.TINY
    assert nmf.fit_nmf(planted.rows, len(planted.lexicon), 4, **strong).h.max() > 0.01


def test_nmf_survives_saving(spark, planted, tmp_path):
    model = nmf.fit_many(planted.rows, len(planted.lexicon), [3], max_iter=2)[3]
    mo.save_nmf(spark, model, planted.lexicon, str(tmp_path / "m"))
    again = mo.load_nmf(spark, str(tmp_path / "m"), planted.lexicon)
    assert np.array_equal(again.h, model.h) and again.start == model.start


def test_lda_finds_planted_topics_and_repeats(planted):
    model = lda.fit_lda(planted.vectors, 5, passes=30, restarts=8)
    assert planted.agreement(lda.document_topics(model, planted.vectors)) >= 0.9
    first, second = (
        lda.topic_words(lda.fit_lda(planted.vectors, 3, passes=2), planted.lexicon).orderBy("topic_id", "rank").collect()
        for _ in range(2)
    )
    assert [r["word"] for r in first] == [r["word"] for r in second]


def test_planted_topics_are_more_coherent_than_mixed_ones(spark, planted):
    rng = random.Random(0)
    lists = [[w for w in planted.lexicon.terms if w[0] == c][:10] for c in "abcde"]
    words = [w for ws in lists for w in ws]
    rng.shuffle(words)
    mixed = [words[i * 10 : i * 10 + 10] for i in range(5)]

    def score(groups):
        rows = [(t, r, w, 1.0) for t, ws in enumerate(groups) for r, w in enumerate(ws, 1)]
        return ch.model_coherence(planted.docs, spark.createDataFrame(rows, "topic_id int, rank int, word string, weight double")).first()[0]

    assert score(lists) > score(mixed)


def test_lda_sweep_prefers_the_first_best(spark):
    table = tp.sweep_table(spark, [3, 5, 7], [0.2, 0.4, 0.4], largest=True)
    assert tp.chosen_k(table) == 5
    assert tp.chosen_k(tp.mark_optimal(table.drop("is_optimal"), largest=False)) == 3


def brute_density(points, width, min_points, min_size):
    """Grid clusters by a plain search over the cells."""
    cells = Counter(tuple(int(np.floor(x / width)) for x in p) for p in points)
    steps = list(product((-1, 0, 1), repeat=len(points[0])))

    def near(c):
        return [n for s in steps if (n := tuple(a + b for a, b in zip(c, s))) in cells]

    dense = {c for c in cells if sum(cells[n] for n in near(c)) >= min_points}
    label = {}

    def name(c):
        return ":".join(map(str, c))

    for start in sorted(dense, key=name):
        todo = [start]
        while todo:
            c = todo.pop()
            if c not in label:
                label[c] = name(start)
                todo += [n for n in near(c) if n in dense and n not in label]
    for c in set(cells) - dense:
        around = [label[n] for n in near(c) if n in dense]
        if around:
            label[c] = min(around)
    sizes = Counter()
    for c, l in label.items():
        sizes[l] += cells[c]
    large = sorted((l for l in sizes if sizes[l] >= min_size), key=lambda l: (-sizes[l], l))
    number = {l: i for i, l in enumerate(large)}
    return [number.get(label.get(tuple(int(np.floor(x / width)) for x in p)), -1) for p in points]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_density_by_brute_force(spark, seed):
    rng = np.random.RandomState(seed)
    chain = np.column_stack([np.linspace(0, 40, 150), rng.normal(0, 0.2, 150)])  # one long thin cluster
    blob = rng.normal((20, 15), 1.0, (80, 2))
    copies = np.tile([[-5.0, -5.0]], (60, 1))  # a third of equal points in one cell
    points = np.vstack([chain, blob, copies, rng.uniform(-40, 60, (40, 2))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, coords array<double>").repartition(4)
    got = {r["id"]: r["topic"] for r in cl.density_topics(df, 4, 10, widths=[0.7, 0.7]).collect()}
    assert [got[i] for i in range(len(points))] == brute_density(points, 0.7, 4, 10)


def test_density_on_planted_vectors(spark):
    rows = vector_groups()
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    coords = cl.reduce_dimensions(df, 3).checkpoint()
    got = {r["id"]: r["topic"] for r in cl.density_topics(coords, 5, 10, widths=[6.0] * 3).collect()}
    grouped = [(label, got[i]) for i, _, label in rows if label >= 0]
    assert adjusted_rand(*zip(*grouped)) >= 0.9
    assert sum(got[i] == -1 for i, _, label in rows if label < 0) >= 13


def test_density_without_any_topic(spark):
    df = spark.createDataFrame([(i, [i * 10.0, 0.0]) for i in range(20)], "id long, coords array<double>")
    assert {r["topic"] for r in cl.density_topics(df, 5, 10, widths=[1.0, 1.0]).collect()} == {-1}


def test_components_of_a_long_chain(spark):
    names = [f"n{i:03d}" for i in range(200)]
    nodes = spark.createDataFrame([(n,) for n in names + ["z"]], "node string")
    links = list(zip(names, names[1:]))
    edges = spark.createDataFrame(links + [(b, a) for a, b in links], "src string, dst string")
    got = {r["node"]: r["label"] for r in cl.connected_components(nodes, edges).collect()}
    assert set(got[n] for n in names) == {"n000"} and got["z"] == "z"


def test_reduce_topics_keeps_outliers(spark, planted):
    assigned = planted.docs.select("id", F.when(F.col("id") % 20 == 0, -1).otherwise(F.col("label")).alias("topic"))
    got = cl.reduce_topics(planted.docs, assigned, 2)
    counts = {r["topic"]: r["count"] for r in got.groupBy("topic").count().collect()}
    assert set(counts) == {-1, 0, 1} and sum(counts.values()) == 300 and counts[0] >= counts[1]


def test_soft_topics_follow_the_nearest_centre(spark):
    rows = vector_groups(far=0)
    df = spark.createDataFrame([(i, v, t) for i, v, t in rows], "id long, coords array<double>, topic int")
    soft = cl.document_topics(df.select("id", "coords"), df.select("id", "topic"), 16)
    got = {r["id"]: r["dominant_topic"] for r in al.dominant_topics(soft).collect()}
    assert all(got[i] == t for i, _, t in rows)


def test_embeddings(spark, planted):
    with pytest.raises(ValueError):
        cl.embed(planted.docs)
    trained = cl.embed(planted.docs, planted.lexicon, dims=8, trained=True).collect()
    assert all(len(r["embedding"]) == 8 for r in trained) and len(trained) == 300
    hashed = cl.embed(planted.vectors, lexicon=planted.lexicon, dims=32).collect()
    assert all(len(r["embedding"]) == 32 for r in hashed) and len(hashed) == 300

    def encoder(frames):
        for f in frames:
            yield f.assign(embedding=[[float(len(t))] for t in f["text"]])[["id", "embedding"]]

    texts = planted.docs.select("id", F.array_join("tokens", " ").alias("text"))
    assert cl.embed(texts, encoder=encoder).first()["embedding"][0] > 100


@pytest.mark.parametrize("n", [2_000, 20_000, 400_000])
def test_density_topics_do_not_depend_on_the_number_of_documents(spark, n):
    """Four planted groups and a tenth of noise in 5 dimensions, with the defaults."""
    chance, noise = np.random.default_rng(1), n // 10
    centres = np.array([[8.0 if i >> j % 2 & 1 else -8.0 for j in range(5)] for i in range(4)])
    group = np.concatenate([np.arange(n - noise) % 4, np.full(noise, -1)])
    x = np.where(group[:, None] >= 0, centres[group] + chance.normal(size=(n, 5)), chance.uniform(-14, 14, size=(n, 5)))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 5 * n + 1, 5, dtype=np.int32)), pa.array(x.ravel()))
    coords = spark.createDataFrame(pa.table({"id": np.arange(n), "coords": lists})).repartition(8)
    rows = cl.density_topics(coords, dims=5).toPandas()
    topic = rows.sort_values("id")["topic"].to_numpy()
    assert set(topic) == {-1, 0, 1, 2, 3}
    main = [np.bincount(topic[group == g] + 1).argmax() - 1 for g in range(4)]
    assert sorted(main) == [0, 1, 2, 3]
    assert all(np.mean(topic[group == g] == main[g]) >= 0.98 for g in range(4))
    assert np.mean(topic[group == -1] == -1) >= 0.75


def test_fits_keep_no_rows_in_memory(spark, tmp_path):
    """A fit goes on from vectors without texts or tokens, on disk."""
    rows = [(i, " ".join(tokens), "web", "en") for i, tokens, _ in topic_corpus(k=2, docs=20)]
    docs = spark.createDataFrame([*rows, (-1, None, "web", "en")], "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    with Fitted(spark, str(tmp_path)) as f:
        assert f.docs.columns == ["id", "tokens"] and f.vectors.columns == ["id", "features"]
        assert f.vectors.count() == f.docs.count() == len(rows)
        assert not any(df.storageLevel.useMemory for df in (f.docs, f.vectors))
        nmf.fit_many(f.rows, len(f.lexicon), [2], max_iter=1)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == cached


def test_fits_keep_no_blocks_on_executors(spark, tmp_path):
    """While a fit runs, its rows are in no executor's store, and in the partitions they were made in."""
    rows = [(i, " ".join(tokens), "web", "en") for i, tokens, _ in topic_corpus(k=2, docs=20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = [[r["id"] for r in part] for part in processed(spark, str(tmp_path)).select("id").rdd.glom().collect()]
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    with Fitted(spark, str(tmp_path)) as f:
        for df in (f.docs, f.vectors):
            assert [[r["id"] for r in part] for part in df.select("id").rdd.glom().collect()] == ids
        assert set(spark.sparkContext._jsc.getPersistentRDDs()) == cached
