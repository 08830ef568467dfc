"""Vocabulary and features (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    features_sql, papers, processed, query, r6, rounded, table, tf_sql, tfidf_sql, tokens_sql, vocab_sql, with_sql, written_tokens,
)
from topicloom.config import TopicConfig
from topicloom.operators import features as fe
from topicloom.operators.normalise import preprocess_abstracts
from topicloom.runtime import row_total, shared_path


@query("v01_split_tokens", with_sql(tokens_sql(), select="SELECT id, CAST(count(*) AS INTEGER) AS n, min(term) AS least, max(term) AS greatest FROM tok GROUP BY id"))
def split_tokens(spark, sf):
    docs = fe.split_tokens(processed(spark, sf).select("id", "processed_text"))
    return docs.select("id", F.size("tokens").alias("n"), F.array_min("tokens").alias("least"), F.array_max("tokens").alias("greatest"))


@query("v02_document_frequencies", with_sql(
    tokens_sql(), tf_sql(), select="SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM tf GROUP BY term"))
def document_frequencies(spark, sf):
    return fe.document_frequencies(processed(spark, sf))


@query("v03_prune", with_sql(tokens_sql(), tf_sql(), vocab_sql("df", 100_000), select="SELECT term, df FROM kept"))
def prune(spark, sf):
    docs = processed(spark, sf)
    return fe.prune(fe.document_frequencies(docs), row_total(docs), 2, 0.95).select("term", "df")


@query("v04_bag_of_words", with_sql(
    tokens_sql(), tf_sql(), vocab_sql(), select="SELECT id, term_id, tf FROM tf JOIN vocab USING (term)"))
def bag_of_words(spark, sf):
    docs = written_tokens(spark, sf)
    return fe.bag_of_words(docs, fe.Lexicon.of(fe.vocabulary(docs)))


@query("v05_bow_features", with_sql(
    tokens_sql(), tf_sql(), vocab_sql("df", 100_000),
    select="SELECT v.term, v.df, count(*) AS n_docs, CAST(sum(tf.tf) AS BIGINT) AS total FROM tf JOIN vocab v USING (term) GROUP BY ALL"))
def bow_features(spark, sf):
    vocab, rows = fe.bow_features(written_tokens(spark, sf))
    sums = rows.groupBy("term_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("total"))
    return vocab.select("term", "term_id", "df").join(sums, "term_id").drop("term_id")


@query("v06_vocabulary", with_sql(
    tokens_sql(), tf_sql(), vocab_sql(), select="SELECT term, term_id, df, ctf, round(idf, 6) AS idf FROM vocab"))
def vocabulary(spark, sf):
    return rounded(fe.vocabulary(processed(spark, sf)), "idf")


@query("v07_ngrams", with_sql(
    tokens_sql(),
    "ordered AS (SELECT id, term, lead(term) OVER (PARTITION BY id ORDER BY pos) AS next FROM tok)",
    """grams AS (SELECT id, term AS gram FROM ordered UNION ALL SELECT id, term || ' ' || next FROM ordered WHERE next IS NOT NULL)""",
    select="SELECT gram, count(DISTINCT id) AS df, count(*) AS ctf FROM grams GROUP BY gram"))
def ngrams(spark, sf):
    grams = fe.document_frequencies(fe.add_ngrams(processed(spark, sf).select("id", "tokens"), 1, 2))
    return grams.withColumnRenamed("term", "gram")


@query("v08_tfidf", with_sql(features_sql(), select="SELECT id, term_id, round(weight, 6) AS weight FROM tfidf"))
def tfidf(spark, sf):
    _, rows = fe.tfidf_features(written_tokens(spark, sf))
    return rounded(rows, "weight")


def _benchmark_sql() -> str:
    """Vocabulary from the documents, applied to the benchmark texts."""
    other = tokens_sql(source="papers AS (SELECT item_id AS id, text AS abstract FROM benchmark)")
    for name in ("papers", "cleaned", "words", "raw", "lem", "tok"):
        other = other.replace(f"{name} AS", f"b_{name} AS").replace(f"FROM {name}", f"FROM b_{name}")
    return with_sql(
        tokens_sql(), tf_sql(), vocab_sql(), other,
        "b_tf AS (SELECT id, term, count(*) AS tf FROM b_tok GROUP BY id, term)",
        "w AS (SELECT b.id, v.term_id, b.tf * v.idf AS w FROM b_tf b JOIN vocab v USING (term))",
        select="SELECT id, term_id, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w")


@query("v09_apply_vocabulary", _benchmark_sql())
def apply_vocabulary(spark, sf):
    lexicon = fe.Lexicon.of(fe.vocabulary(processed(spark, sf)))
    unseen = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("abstract"))
    return rounded(fe.long_rows(fe.tfidf_vectors(preprocess_abstracts(unseen), lexicon)), "weight")


@query("v10_remap_terms", with_sql(
    tokens_sql(), tf_sql(), vocab_sql(),
    """v2 AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS target_id FROM (
      SELECT freq.term FROM freq, n WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n.n ORDER BY df DESC, freq.term LIMIT 5000))""",
    select="SELECT term, term_id AS source_id, target_id FROM vocab JOIN v2 USING (term)"))
def remap_terms(spark, sf):
    docs = written_tokens(spark, sf)
    return fe.remap_terms(fe.vocabulary(docs), fe.vocabulary(docs, max_terms=5000, keep_by="df"))


@query("v11_nested_rows", with_sql(features_sql(), select="""SELECT id,
string_agg(term_id || ':' || CAST(CAST(round(weight * 10000) AS BIGINT) AS VARCHAR), ' ' ORDER BY term_id) AS entries FROM tfidf GROUP BY id"""))
def nested_rows(spark, sf):
    docs = written_tokens(spark, sf)
    rows = fe.nested_rows(fe.tfidf_vectors(docs, fe.Lexicon.of(fe.vocabulary(docs)))).where(F.size("entries") > 0)

    def shown(e):
        return F.concat(e["term_id"].cast("string"), F.lit(":"), F.round(e["weight"] * 10000).cast("long").cast("string"))

    return rows.select("id", F.array_join(F.transform("entries", shown), " ").alias("entries"))


@query("v12_tfidf_features", with_sql(
    features_sql(), select="""SELECT v.term, v.df, count(*) AS n_docs, round(avg(t.weight), 6) AS mean_weight
    FROM tfidf t JOIN vocab v USING (term_id) GROUP BY ALL"""))
def tfidf_features(spark, sf):
    vocab, rows = fe.tfidf_features(written_tokens(spark, sf))
    sums = rows.groupBy("term_id").agg(F.count(F.lit(1)).alias("n_docs"), r6(F.avg("weight")).alias("mean_weight"))
    return vocab.select("term", "term_id", "df").join(sums, "term_id").drop("term_id")


@query("v13_feature_totals", with_sql(
    features_sql(), select="""SELECT n.n AS n_docs, (SELECT count(*) FROM vocab) AS n_terms,
    round((SELECT count(*) FROM tfidf) / CAST(n.n AS DOUBLE), 6) AS mean_terms FROM n"""))
def feature_totals(spark, sf):
    docs = written_tokens(spark, sf)
    return rounded(fe.feature_totals(docs, fe.Lexicon.of(fe.vocabulary(docs))), "mean_terms")


@query("v14_weighting_switch", with_sql(
    features_sql(), select="""SELECT 'tfidf' AS weighting, count(*) AS n, round(sum(weight), 4) AS total FROM tfidf UNION ALL
    SELECT 'bow', count(*), round(CAST(sum(tf) AS DOUBLE), 4) FROM tf JOIN vocab USING (term)"""))
def weighting_switch(spark, sf):
    docs = written_tokens(spark, sf)
    lexicon = fe.Lexicon.of(fe.vocabulary(docs))
    parts = [
        fe.long_rows(fe.feature_vectors(docs, lexicon, kind)).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 4).alias("total")
        ).select(F.lit(kind).alias("weighting"), "n", "total")
        for kind in ("tfidf", "bow")
    ]
    return parts[0].unionByName(parts[1])


@query("v15_feature_tables", with_sql(
    tokens_sql(), tf_sql(), vocab_sql(), tfidf_sql(), "vb AS (SELECT term FROM freq, n WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n.n)",
    select="""SELECT 'processed' AS name, n.n AS rows FROM n UNION ALL SELECT 'vocabulary', count(*) FROM vocab UNION ALL
    SELECT 'features', count(*) FROM tfidf UNION ALL SELECT 'vocabulary_bow', least(count(*), 100000) FROM vb UNION ALL
    SELECT 'bow', count(*) FROM tf WHERE term IN (SELECT term FROM vb)"""))
def feature_tables(spark, sf):
    from topicloom.plans.runs import run_features

    tables = run_features(papers(spark, sf), shared_path(spark, "features"), TopicConfig())
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
