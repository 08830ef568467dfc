"""Every operator and stage on null, empty, long, repeated and clashing input, and on no rows."""

import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_samples import ODD_ROWS
from topicloom.llm import (
    factorisation,
    katz,
    licences,
    near_duplicates,
    nearest,
    packing,
    piece_encoding,
    quality_rules,
    toxicity,
    url_trust,
)
from topicloom.llm.queries import BYTE_BPE, URL_RULES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def ids_of(rows):
    return sorted((r.doc_id is None, r.doc_id) for r in rows)


ALL_IDS = sorted((r[0] is None, r[0]) for r in ODD_ROWS)


def test_near_duplicates(odd_docs):
    rows = near_duplicates.near_duplicates(odd_docs).collect()
    assert ids_of(rows) == ALL_IDS
    comp = {r.doc_id: r.component_id for r in rows}
    assert comp[1] == 1 and comp[2] == 2 and comp[3] == 3  # empty sets are linked with nothing
    assert comp[4] == comp[10] == 4
    assert comp[6] == comp[7] == comp[8] == 6
    none = next(r for r in rows if r.doc_id is None)
    assert none.component_id is None and none.kept
    kept = near_duplicates.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert ids_of(kept.collect()) == sorted([(False, i) for i in (1, 2, 3, 4, 5, 6, 9)] + [(True, None)])


def test_katz(odd_docs):
    rows = katz.fold_scores(odd_docs).collect()
    assert ids_of(rows) == ALL_IDS
    by = {r.doc_id: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1
    assert by[1].held_out == (zlib.crc32(b"1") % 5 == 1)
    assert all(r.score < 0 for r in rows)


def test_quality_rules(odd_docs, odd_labels):
    rows = quality_rules.quality_verdicts(odd_docs, odd_labels).collect()
    assert ids_of(rows) == ALL_IDS
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed
    assert by[6].n_words == 18000
    kept = quality_rules.keep_good(odd_docs, odd_labels)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_classifiers(odd_docs, odd_labels):
    for operator in (factorisation, toxicity):
        model = operator.train(odd_docs, odd_labels)
        rows = operator.score(odd_docs, model).collect()
        assert ids_of(rows) == ALL_IDS
        assert all(0 <= r.score <= 1 for r in rows)
    clean = toxicity.keep_clean(odd_docs, odd_labels)
    assert clean.columns == odd_docs.columns
    assert clean.count() <= odd_docs.count()


def test_packing(odd_docs):
    rows = packing.packed_pieces(odd_docs, BYTE_BPE).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in ODD_ROWS}
    assert [(r.start, r.length, r.doc_tokens) for r in rows if r.doc_id in (1, 2)] == [(0, 1, 1), (0, 1, 1)]
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_pieces(odd_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in piece_encoding.encoded(odd_docs, PIECES).collect():
        text = next((x[1] or "") for x in ODD_ROWS if x[0] == r.doc_id)
        want = [1, *model.encode(text), 2]
        assert [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)] == want
        assert r.decoded == model.decode(want)


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "no address", ""), (3, "HTTP://A.Example.ORG", "x"), (4, "http://a.org/b?c#d", None),
         (4, "http://a.org/b?c#d", None), (None, "://", "<a href=//a.org>"), (5, "http://EXAMPLE.org/es/1", "")],
        "page_id bigint, url string, html string",
    ).withColumns({c: F.lit(1) for c in ("host", "path", "rule", "n", "trust")})
    rows = url_trust.url_verdicts(pages, URL_RULES).collect()
    assert len(rows) == 7
    by = {r.page_id: r for r in rows}
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("", "", None, "allow")
    assert (by[3].host, by[3].path, by[3].rule) == ("a.example.org", "", None)  # no path, so "org/" doesn't fit
    assert (by[4].host, by[4].path, by[4].rule) == ("a.org", "/b", "org/")
    assert (by[5].rule, by[5].verdict) == ("example.org/es/", "block")


def test_licences(odd_docs):
    files = odd_docs.select(
        F.col("doc_id").alias("file_id"), F.when(F.col("doc_id") != 5, "a/b/c").alias("path"), "text",
        F.lit(True).alias("is_licence_file"), "score",
    )
    rows = licences.scanned(files).collect()
    assert len(rows) == len([r for r in ODD_ROWS]) and all(r.licence is None for r in rows)


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [None, 1.0]), (7, [1.0, 1.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [2.0, 0.0]), (10, [2.0, 0.0]),
            (20, [0.0, 1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit(1))
    found = nearest.nearest(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found if r.query_id == 0]
    assert got[:2] == [(0, 1, 9, 2.0), (0, 2, 10, 2.0)]
    assert {r.query_id for r in found} <= {0, 20} and all(r.vec_id in (0, 8, 9, 10, 20) for r in found)


def test_no_rows(spark, odd_docs, odd_labels):
    docs, labels = odd_docs.where("doc_id > 1000"), odd_labels.where("doc_id > 1000")
    assert near_duplicates.near_duplicates(docs).count() == 0
    assert katz.fold_scores(docs).count() == 0
    assert quality_rules.quality_verdicts(docs, labels).count() == 0
    assert factorisation.score(docs, factorisation.train(docs, labels)).count() == 0
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == 0
    assert packing.packed_pieces(docs, BYTE_BPE).count() == 0
    assert piece_encoding.encoded(docs, PIECES).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest.nearest(vectors, F.col("vec_id") % 20 == 0).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert url_trust.url_verdicts(pages, URL_RULES).count() == 0
    files = docs.select(F.col("doc_id").alias("file_id"), F.col("lang").alias("path"), "text", F.lit(True).alias("is_licence_file"))
    assert licences.scanned(files).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd_docs, odd_labels, tmp_path, name, stage):
    odd_labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, odd_docs.where("doc_id > 1000")):
        out = stage(spark, docs, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        assert name == "packing" or out.count() <= docs.count()
