import math
from collections import Counter

import pytest

from topicloom.config import TopicConfig
from topicloom.operators import features as fe

DOCS = [
    (1, ["cat", "dog", "cat"]), (2, ["dog", "bird"]), (3, ["cat", "fish", "dog"]), (4, ["dog", "bird", "bird"]), (5, ["rare"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, tokens array<string>")


def test_vocabulary_prunes_both_ends(docs):
    vocab = {r["term"]: r for r in fe.vocabulary(docs, min_df=2, max_df=0.7).collect()}
    assert set(vocab) == {"bird", "cat"}  # dog is in 4 of 5 documents, fish and rare in one
    assert [vocab[t]["term_id"] for t in ("bird", "cat")] == [0, 1]
    assert vocab["cat"]["df"] == 2 and vocab["cat"]["ctf"] == 3
    assert math.isclose(vocab["cat"]["idf"], math.log(6 / 3) + 1)


def test_cap_keeps_the_most_frequent_and_breaks_ties_by_term(docs):
    assert [r["term"] for r in fe.vocabulary(docs, 1, 1.0, max_terms=3).orderBy("term_id").collect()] == ["bird", "cat", "dog"]
    assert [r["term"] for r in fe.vocabulary(docs, 1, 1.0, max_terms=2, keep_by="df").orderBy("term_id").collect()] == ["bird", "dog"]


def test_tfidf_by_hand(docs):
    vocab, rows = fe.tfidf_features(docs, min_df=1, max_df=1.0)
    names = {r["term_id"]: r["term"] for r in vocab.collect()}
    got = {(r["id"], names[r["term_id"]]): r["weight"] for r in rows.collect()}
    df = Counter(t for _, ts in DOCS for t in set(ts))
    for i, tokens in DOCS:
        raw = {t: n * (math.log((1 + len(DOCS)) / (1 + df[t])) + 1) for t, n in Counter(tokens).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for t, x in raw.items():
            assert math.isclose(got.pop((i, t)), x / norm, rel_tol=1e-12)
    assert not got


def test_document_without_known_terms_stays_empty(docs):
    lexicon = fe.Lexicon.of(fe.vocabulary(docs, 2, 1.0))
    vectors = fe.tfidf_vectors(docs, lexicon)
    assert {r["id"]: len(r["entries"]) for r in fe.nested_rows(vectors).collect()}[5] == 0
    assert 5 not in {r["id"] for r in fe.long_rows(vectors).collect()}


def test_document_side_does_not_shuffle(docs):
    lexicon = fe.Lexicon.of(fe.vocabulary(docs, 1, 1.0))
    plan = fe.long_rows(fe.tfidf_vectors(docs, lexicon))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_feature_tables_by_weighting(docs):
    for weighting in ("tfidf", "bow"):
        built = fe.build_features(docs, TopicConfig(weighting=weighting, min_df=1, max_df=1.0))
        assert set(built) == {"vocabulary", "features", "vocabulary_bow", "bow"}
    with pytest.raises(ValueError):
        fe.feature_vectors(docs, fe.Lexicon(("cat",), (1.0,)), "other")


def test_same_vocabulary_in_every_run(docs):
    first = fe.Lexicon.of(fe.vocabulary(docs, 1, 1.0))
    assert first == fe.Lexicon.of(fe.vocabulary(docs.repartition(5), 1, 1.0))


def test_queries_that_read_tokens_repeatedly_prepare_them_once(spark, tmp_path):
    """Their rows come from written tokens, not from the texts again."""
    from topicloom.catalog import load_queries
    from topicloom.catalog.base import QUERIES

    load_queries()
    rows = [(i, f"apples {'pears ' * (i % 3)} plums{'x' * (i % 2)}", "web", "en") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("v05_bow_features", "v08_tfidf", "v11_nested_rows", "v14_weighting_switch", "m15_hash_embedding"):
        found = QUERIES[name](spark, str(tmp_path))
        assert found.count() > 0
        assert not any("documents.parquet" in path for path in found.inputFiles())
