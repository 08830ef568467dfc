"""Sources and sinks (S): every table is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    Fitted, K, analysis_sql, cluster_topics, dist_sql, embedding_coords, features_sql, fixed_topics, papers, papers_sql,
    predicted_sql, query, rounded, source_words, table, tokens_sql, with_sql,
)
from topicloom.catalog.evaluation_queries import analysis
from topicloom.catalog.report_queries import source_words_sql, _WIDE_COLUMNS
from topicloom.operators import alignment as al, clusters as cl, features as fe, lda, nmf
from topicloom.operators.normalise import preprocess_abstracts
from topicloom.runtime import shared_path
from topicloom.sources import models as mo, tables as ta


@query("s01_read_csv", "SELECT doc_id AS id, text, lang FROM documents")
def read_csv(spark, sf):
    """Whole texts, with their line breaks and quotes, through CSV."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    path = ta.write_csv(docs, shared_path(spark, "documents_csv"))
    return ta.read_csv(spark, path, "id LONG, text STRING, lang STRING")


@query("s02_write_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def write_csv(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = ta.write_csv(orders, shared_path(spark, "orders_csv"))
    return ta.read_csv(spark, path, "o_orderkey LONG, o_orderstatus STRING, o_totalprice DOUBLE")


@query("s03_json_results", with_sql(papers_sql("source"), select="SELECT primary_category, count(*) AS n FROM papers GROUP BY 1"))
def json_results(spark, sf):
    counts = al.primary_category_counts(papers(spark, sf, "source"))
    path = ta.write_json(counts, shared_path(spark, "counts_json"))
    return ta.read_json(spark, path, "primary_category STRING, n LONG")


@query("s04_intermediates", with_sql(features_sql(), select="""SELECT 'vocabulary' AS name, count(*) AS rows, CAST(sum(df) AS BIGINT) AS total FROM vocab
UNION ALL SELECT 'features', count(*), CAST(sum(term_id) AS BIGINT) FROM tfidf"""))
def intermediates(spark, sf):
    base = shared_path(spark, "stage")
    docs = ta.save_table(preprocess_abstracts(papers(spark, sf)), f"{base}/processed")
    vocab = mo.save_vocabulary(fe.vocabulary(docs), f"{base}/vocabulary")
    lexicon = mo.load_lexicon(spark, f"{base}/vocabulary")
    rows = ta.save_table(fe.long_rows(fe.tfidf_vectors(docs, lexicon)), f"{base}/features")
    n = F.count(F.lit(1)).alias("rows")
    first = vocab.agg(n, F.sum("df").alias("total")).select(F.lit("vocabulary").alias("name"), "rows", "total")
    return first.unionByName(rows.agg(n, F.sum("term_id").alias("total")).select(F.lit("features").alias("name"), "rows", "total"))


@query("s05_lda_model")
def lda_model(spark, sf):
    """Topic words of a model that was saved and loaded."""
    with Fitted(spark, sf) as f:
        path = shared_path(spark, "lda")
        mo.save_lda(lda.fit_lda(f.vectors, 5), f.vocab, path)
        model, lexicon = mo.load_lda(spark, path)
        return lda.topic_words(model, lexicon)


@query("s06_nmf_model")
def nmf_model(spark, sf):
    """Topic words of a factorisation that was saved and loaded."""
    with Fitted(spark, sf) as f:
        path = shared_path(spark, "nmf")
        mo.save_nmf(spark, nmf.fit_nmf(f.rows, len(f.lexicon), 5), f.lexicon, path)
        return nmf.topic_words(spark, mo.load_nmf(spark, path, f.lexicon), f.lexicon)


@query("s06_cluster_model", """SELECT topic, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) AS mean FROM (
SELECT CAST(label % 4 AS INTEGER) AS topic, unnest(range(0, 64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY ALL""")
def cluster_model(spark, sf):
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 4).cast("int").alias("topic"))
    found = mo.save_clusters(cl.centroids(embedding_coords(spark, sf), labels, 64), shared_path(spark, "centroids"))
    return rounded(found.select("topic", F.posexplode("centroid").alias("pos", "mean")), "mean")


@query("s07_wide_document_topics", with_sql(
    tokens_sql(), dist_sql(), select=f"SELECT id, dominant_topic, {_WIDE_COLUMNS} FROM dist JOIN dom USING (id)"))
def wide_document_topics(spark, sf):
    path = ta.write_csv(ta.wide_document_topics(fixed_topics(spark, sf), K), shared_path(spark, "wide_csv"))
    columns = [f"topic_{j}" for j in range(K)]
    schema = "id LONG, dominant_topic INT, " + ", ".join(f"{c} DOUBLE" for c in columns)
    return rounded(ta.read_csv(spark, path, schema), *columns)


@query("s08_long_topic_words", with_sql(
    tokens_sql("source"), source_words_sql(), select="SELECT topic_id, word, weight AS probability FROM sw"))
def long_topic_words(spark, sf):
    path = ta.write_csv(ta.long_topic_words(source_words(spark, sf)), shared_path(spark, "words_csv"))
    return ta.read_csv(spark, path, "topic_id INT, word STRING, probability DOUBLE")


@query("s09_nested_topic_words", with_sql(
    tokens_sql("source"), source_words_sql(), select="""SELECT 'topic_' || topic_id AS topic, CAST(count(*) AS INTEGER) AS n_words,
    string_agg(word, ' ' ORDER BY rank) AS words FROM sw GROUP BY topic_id"""))
def nested_topic_words(spark, sf):
    path = ta.write_json(ta.nested_topic_words(source_words(spark, sf)), shared_path(spark, "nested_json"))
    back = ta.read_json(spark, path, "topic STRING, words MAP<STRING, DOUBLE>")
    return back.select("topic", F.size("words").alias("n_words"), F.array_join(F.map_keys("words"), " ").alias("words"))


@query("s10_reload_topic_words", with_sql(
    tokens_sql("source"), source_words_sql(), select="SELECT topic_id, rank, word, weight FROM sw"))
def reload_topic_words(spark, sf):
    path = ta.write_topic_words_json(source_words(spark, sf), shared_path(spark, "topic_words_json"))
    return ta.read_topic_words_json(spark, path)


@query("s11_predictions", with_sql(
    analysis_sql("source"), predicted_sql(), select="""SELECT id, predicted_category, primary_category AS ground_truth
    FROM analysis JOIN predicted USING (dominant_topic)"""))
def predictions(spark, sf):
    docs = analysis(spark, sf, "source")
    found = al.predict(docs, al.predicted_by_topic(al.contingency(docs), K))
    path = ta.write_csv(ta.predictions(found), shared_path(spark, "predictions_csv"))
    return ta.read_csv(spark, path, "id LONG, predicted_category STRING, ground_truth STRING")


@query("s12_analysis_table", with_sql(analysis_sql(), select="SELECT id, primary_category, categories, dominant_topic FROM analysis"))
def analysis_table(spark, sf):
    columns = ["id", "primary_category", "categories", "dominant_topic"]
    return ta.save_table(analysis(spark, sf).select(*columns), shared_path(spark, "analysis"))


@query("s13_reuse_stage", with_sql(papers_sql(), select="SELECT id, primary_category FROM papers"))
def reuse_stage(spark, sf):
    """The second call finds the table and must not build it."""
    path = shared_path(spark, "papers")
    ta.stage(spark, path, lambda: papers(spark, sf).select("id", "primary_category"))

    def never():
        raise AssertionError("the stage was built twice")

    return ta.stage(spark, path, never)


@query("s14_load_results", """SELECT 'topics' AS name, count(DISTINCT doc_id) AS rows FROM documents UNION ALL SELECT 'labels', count(*) FROM labels""")
def load_results(spark, sf):
    base = shared_path(spark, "results")
    ta.save_table(cluster_topics(spark, sf), f"{base}/topics")
    ta.save_table(table(spark, sf, "labels"), f"{base}/labels")
    found = ta.load_results(spark, base, ["topics", "labels", "not_there"])
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, t in found.items()]
    return parts[0].unionByName(parts[1])
