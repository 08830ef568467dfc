"""Report tables (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    K, analysis_sql, dist_sql, fixed_topics, papers, papers_sql, query, rounded, scores_sql, source_words,
    table, tokens_sql, with_sql,
)
from topicloom.catalog.evaluation_queries import (
    _ARI, _CONFUSION, _NMI, _SHARES, _SUPPORTED, _methods_sql, _pairs_sql, _purity_sql,
    MIN_SUPPORT, WIDE, analysis, contingency, method_rows, pairs,
)
from topicloom.operators import alignment as al, comparison as cm, metrics as me, report as re
from topicloom.operators.topics import mark_optimal
from topicloom.runtime import cut_lineage
from topicloom.sources.tables import wide_document_topics


@query("r01_normalised_confusion", with_sql(
    _pairs_sql("source"), _SUPPORTED, _CONFUSION, select="""SELECT *, CASE WHEN sum(n) OVER (PARTITION BY true_category) = 0 THEN 0.0
    ELSE round(n / CAST(sum(n) OVER (PARTITION BY true_category) AS DOUBLE), 6) END AS share FROM confusion"""))
def normalised_confusion(spark, sf):
    found = me.classification(cut_lineage(pairs(spark, sf, "source")), min_support=MIN_SUPPORT)
    return rounded(re.normalised_confusion(found["confusion"]), "share")


_SCORES = "category, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"


def _scores(spark, sf, category):
    counted = cut_lineage(pairs(spark, sf, category))
    return me.category_scores(counted, me.universe(counted))


@query("r02_best_supported", with_sql(
    _pairs_sql("source"), scores_sql(), select=f"SELECT {_SCORES} FROM scores ORDER BY support DESC, category LIMIT 12"))
def best_supported(spark, sf):
    return rounded(re.best_supported(_scores(spark, sf, "source"), 12), "precision", "recall", "f1")


@query("r03_topic_summary", with_sql(
    analysis_sql("source"), _SHARES, _purity_sql(K), """ranked AS (SELECT *, row_number() OVER (PARTITION BY dominant_topic ORDER BY share DESC, category) AS rank FROM shares)""",
    select="""SELECT r.dominant_topic, max(category) FILTER (WHERE rank = 1) AS top_category, round(max(share), 6) AS top_share,
    string_agg(printf('%s(%.1f%%)', category, share * 100), ', ' ORDER BY rank) AS top_list, round(any_value(p.purity), 6) AS purity
    FROM ranked r JOIN purity p USING (dominant_topic) WHERE rank <= 3 GROUP BY r.dominant_topic"""))
def topic_summary(spark, sf):
    cells = cut_lineage(contingency(spark, sf, "source"))
    found = re.topic_summary(al.category_shares(cells), al.topic_purity(cells, K))
    return rounded(found, "top_share", "purity")


_TOP_CATEGORIES = """top_c AS (SELECT primary_category AS category FROM (SELECT primary_category, sum(n) AS s FROM cont GROUP BY 1) ORDER BY s DESC, 1 LIMIT 10)"""


@query("r04_topic_category_cells", with_sql(
    analysis_sql("source"), _SHARES, _TOP_CATEGORIES,
    select=f"""SELECT CAST(t AS INTEGER) AS dominant_topic, c.category, round(coalesce(s.share, 0.0), 6) AS share
    FROM range({WIDE}) r(t) CROSS JOIN top_c c LEFT JOIN shares s ON s.dominant_topic = t AND s.category = c.category"""))
def topic_category_cells(spark, sf):
    cells = cut_lineage(contingency(spark, sf, "source"))
    counts = cells.groupBy("primary_category").agg(F.sum("n").alias("n"))
    top = re.most_common(counts, 10, "primary_category").select(F.col("primary_category").alias("category"))
    return rounded(re.category_cells(al.category_shares(cells), al.topic_range(spark, WIDE), top), "share")


@query("r05_topic_accuracy_series", with_sql(
    _pairs_sql("source"), select="""SELECT dominant_topic AS topic, round(sum(CASE WHEN primary_category = predicted_category THEN n ELSE 0 END)
    / CAST(sum(n) AS DOUBLE), 6) AS accuracy FROM cont JOIN predicted USING (dominant_topic) GROUP BY 1"""))
def topic_accuracy_series(spark, sf):
    cells = cut_lineage(contingency(spark, sf, "source"))
    found = me.topic_accuracy(cells, al.predicted_by_topic(cells, K)).where("total > 0")
    return rounded(re.topic_accuracy_series(found), "accuracy")


@query("r06_most_common", with_sql(
    papers_sql("source"), "c AS (SELECT unnest(string_split(categories, ', ')) AS category FROM papers)",
    "p AS (SELECT 'primary' AS kind, primary_category AS category, count(*) AS n FROM papers GROUP BY 2 ORDER BY n DESC, 2 LIMIT 15)",
    "a AS (SELECT 'all' AS kind, category, count(*) AS n FROM c GROUP BY 2 ORDER BY n DESC, 2 LIMIT 15)",
    select="SELECT * FROM p UNION ALL SELECT * FROM a"))
def most_common(spark, sf):
    docs = papers(spark, sf, "source")
    primary = al.primary_category_counts(docs).withColumnRenamed("primary_category", "category")
    parts = {"primary": re.most_common(primary), "all": re.most_common(al.all_category_counts(docs))}
    return parts["primary"].withColumn("kind", F.lit("primary")).unionByName(parts["all"].withColumn("kind", F.lit("all")))


LANGS = ["de", "en", "es", "fr"]
_WIDE_LANGS = ", ".join(f"round(coalesce(max(share) FILTER (WHERE category = '{c}'), 0.0), 6) AS {c}" for c in LANGS)


@query("r07_category_matrix", with_sql(
    analysis_sql(), _SHARES, select=f"SELECT CAST(t AS INTEGER) AS dominant_topic, {_WIDE_LANGS} FROM range({WIDE}) r(t) LEFT JOIN shares ON dominant_topic = t GROUP BY t"))
def category_matrix(spark, sf):
    cells = cut_lineage(contingency(spark, sf))
    names = [r[0] for r in cells.select("primary_category").where("primary_category IS NOT NULL").distinct().orderBy("primary_category").collect()]
    return rounded(re.category_matrix(al.category_shares(cells), al.topic_range(spark, WIDE), names), *names)


@query("r08_categories_by_share", with_sql(
    analysis_sql("source"), _SHARES, """by_share AS (SELECT category, sum(share) AS total FROM shares GROUP BY 1 ORDER BY round(total, 9) DESC, 1 LIMIT 10)""",
    select=f"""SELECT CAST(t AS INTEGER) AS dominant_topic, b.category, round(coalesce(s.share, 0.0), 6) AS share
    FROM range({K}) r(t) CROSS JOIN by_share b LEFT JOIN shares s ON s.dominant_topic = t AND s.category = b.category"""))
def categories_by_share(spark, sf):
    shares = al.category_shares(cut_lineage(contingency(spark, sf, "source")))
    return rounded(re.category_cells(shares, al.topic_range(spark, K), re.categories_by_share(shares)), "share")


def source_words_sql(n: int = 20) -> str:
    """CTE ``sw (topic_id, rank, word, weight)``: most frequent terms of each source."""
    return f"""sc AS (SELECT p.primary_category AS src, term AS word, CAST(count(*) AS DOUBLE) AS weight FROM tok JOIN papers p USING (id) GROUP BY ALL),
sw AS MATERIALIZED (SELECT CAST(dense_rank() OVER (ORDER BY src) - 1 AS INTEGER) AS topic_id, CAST(rank AS INTEGER) AS rank, word, weight
  FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC, word) AS rank FROM sc) WHERE rank <= {n})"""


@query("r09_top_words", with_sql(
    tokens_sql("source"), source_words_sql(), select="""SELECT topic_id, string_agg(printf('%s (%.3f)', word, weight), ', ' ORDER BY rank) AS words
    FROM sw WHERE rank <= 10 GROUP BY topic_id"""))
def top_words(spark, sf):
    return re.top_words(source_words(spark, sf))


@query("r10_topic_trend", """
WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_custkey % 4 AS INTEGER) AS topic FROM orders),
g AS (SELECT * FROM (SELECT DISTINCT year FROM a) CROSS JOIN (SELECT DISTINCT topic FROM a)),
c AS (SELECT year, topic, count(*) AS n FROM a GROUP BY ALL)
SELECT g.year, g.topic AS dominant_topic, coalesce(n, 0) AS n,
  round(coalesce(n, 0) / CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.year) AS DOUBLE), 6) AS share
FROM g LEFT JOIN c ON c.year = g.year AND c.topic = g.topic""")
def topic_trend(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 4).cast("int").alias("dominant_topic")
    )
    return rounded(re.topic_trend(orders), "share")


@query("r10_document_trend", with_sql(
    analysis_sql(), "a AS (SELECT CAST(year(published) AS INTEGER) AS year, dominant_topic FROM analysis)",
    "g AS (SELECT * FROM (SELECT DISTINCT year FROM a) CROSS JOIN (SELECT DISTINCT dominant_topic FROM a))",
    "c AS (SELECT year, dominant_topic, count(*) AS n FROM a GROUP BY ALL)",
    select="""SELECT g.year, g.dominant_topic, coalesce(n, 0) AS n,
    round(coalesce(n, 0) / CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.year) AS DOUBLE), 6) AS share
    FROM g LEFT JOIN c USING (year, dominant_topic)"""))
def document_trend(spark, sf):
    docs = analysis(spark, sf).select(F.year("published").alias("year"), "dominant_topic")
    return rounded(re.topic_trend(docs), "share")


@query("r11_best_categories", with_sql(
    _pairs_sql("source"), scores_sql(), select=f"SELECT {_SCORES} FROM scores WHERE support >= {MIN_SUPPORT} ORDER BY scores.f1 DESC, category LIMIT 15"))
def best_categories(spark, sf):
    return rounded(re.best_categories(_scores(spark, sf, "source")), "precision", "recall", "f1")


@query("r12_topic_categories", with_sql(
    analysis_sql("source"), _SHARES, select="""SELECT dominant_topic, category, round(share, 6) AS share,
    CAST(row_number() OVER (PARTITION BY dominant_topic ORDER BY shares.share DESC, category) AS INTEGER) AS rank FROM shares QUALIFY rank <= 10"""))
def topic_categories(spark, sf):
    return rounded(re.topic_categories(al.category_shares(contingency(spark, sf, "source"))), "share")


@query("r13_repeatable_sample", with_sql(
    papers_sql(), select="SELECT id, primary_category FROM papers ORDER BY md5(id || ':42'), id LIMIT 500"))
def repeatable_sample(spark, sf):
    return re.repeatable_sample(papers(spark, sf).select("id", "primary_category"))


@query("r14_topic_sizes", with_sql(analysis_sql(), select="SELECT dominant_topic, count(*) AS n FROM analysis GROUP BY 1"))
def topic_sizes(spark, sf):
    return re.topic_sizes(al.dominant_topics(fixed_topics(spark, sf)))


@query("r15_dashboard_totals", with_sql(
    tokens_sql("source"), dist_sql(), source_words_sql(), select="""SELECT count(*) AS n_documents, count(DISTINCT dominant_topic) AS n_topics,
    (SELECT count(*) FROM sw) AS n_topic_words FROM dom"""))
def dashboard_totals(spark, sf):
    return re.dashboard_totals(al.dominant_topics(fixed_topics(spark, sf)), source_words(spark, sf))


@query("r16_words_for_display", with_sql(tokens_sql("source"), source_words_sql(), select="SELECT * FROM sw WHERE rank <= 15"))
def words_for_display(spark, sf):
    return re.words_for_display(source_words(spark, sf))


_WEIGHTS = " UNION ALL ".join(f"SELECT {j} AS topic_id, id, round(c{j} / CAST(size AS DOUBLE), 6) AS weight FROM dist" for j in range(K))


@query("r17_topic_document_block", with_sql(tokens_sql(), dist_sql(), select=_WEIGHTS))
def topic_document_block(spark, sf):
    return rounded(re.topic_document_block(fixed_topics(spark, sf)), "weight")


_WIDE_COLUMNS = ", ".join(f"round(c{j} / CAST(size AS DOUBLE), 6) AS topic_{j}" for j in range(K))


@query("r18_explore", with_sql(
    tokens_sql(), dist_sql(), select=f"""SELECT id, dominant_topic, {_WIDE_COLUMNS} FROM dist JOIN dom USING (id)
    WHERE CAST(id AS VARCHAR) LIKE '%7%' AND dominant_topic = 2"""))
def explore(spark, sf):
    wide = rounded(wide_document_topics(fixed_topics(spark, sf), K), *[f"topic_{j}" for j in range(K)])
    return re.explore(wide, id_contains="7", topic=2, sort_by="topic_2")


@query("r19_run_summary", with_sql(
    _pairs_sql(), _purity_sql(K), _ARI, _NMI, scores_sql(),
    f"mentions AS (SELECT unnest(string_split(categories, ', ')) AS c FROM papers)",
    "sw AS (SELECT size % 3 + 3 AS k, count(*) AS score FROM dist GROUP BY 1)",
    select=f"""SELECT CAST((SELECT arg_max(k, struct_pack(s := score, p := -k)) FROM sw) AS INTEGER) AS optimal_topics,
    CAST((SELECT max(score) FROM sw) AS DOUBLE) AS optimal_score,
    round((SELECT sum(recall * support) / sum(support) FROM scores), 6) AS accuracy,
    round((SELECT sum(f1 * support) / sum(support) FROM scores), 6) AS f1_weighted, round((SELECT avg(f1) FROM scores), 6) AS f1_macro,
    round((SELECT ari FROM ari), 6) AS ari, round((SELECT nmi FROM nmi), 6) AS nmi, round((SELECT avg(purity) FROM purity), 6) AS average_purity,
    (SELECT count(*) FROM papers) AS total_papers, (SELECT count(DISTINCT primary_category) FROM papers) AS n_primary_categories,
    (SELECT count(DISTINCT c) FROM mentions) AS n_all_categories"""))
def run_summary(spark, sf):
    docs = papers(spark, sf)
    parts = al.alignment(docs, fixed_topics(spark, sf), K)
    counted = al.label_pairs(parts["contingency"], al.predicted_by_topic(parts["contingency"], K))
    found = re.run_summary(parts["summary"], me.overall_scores(counted), al.category_totals(docs), _sweep(spark, sf))
    return rounded(found, "accuracy", "f1_weighted", "f1_macro", "ari", "nmi", "average_purity")


def _sweep(spark, sf):
    """Scores of three topic counts: the number of documents by token count modulo 3."""
    from topicloom.catalog.base import processed

    docs = processed(spark, sf).select((F.size("tokens") % 3).alias("r"))
    scores = docs.groupBy("r").agg(F.count(F.lit(1)).cast("double").alias("score"))
    named = scores.select((F.col("r") + 3).alias("k"), "score", F.col("r").alias("position"))
    return mark_optimal(cut_lineage(named), largest=True)


_SWEEP = "s AS (SELECT CAST(size % 3 + 3 AS INTEGER) AS k, CAST(count(*) AS DOUBLE) AS score FROM dist GROUP BY 1)"


@query("r20_sweep_curve", with_sql(
    tokens_sql(), dist_sql(), _SWEEP, select="SELECT k, score, k = (SELECT min(k) FROM s WHERE score = (SELECT max(score) FROM s)) AS is_optimal FROM s"))
def sweep_curve(spark, sf):
    return re.sweep_curve(_sweep(spark, sf))


@query("r21_method_rows", with_sql(
    _methods_sql("source"), select="""SELECT method, num_topics, CAST(CASE position WHEN 0 THEN 0 ELSE 2 END AS INTEGER) AS position,
    round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro, round(top_accuracy, 6) AS top_accuracy FROM methods"""))
def method_figures(spark, sf):
    found = cm.method_rows(method_rows(spark, sf, "source"))
    return rounded(found, "accuracy", "f1_weighted", "f1_macro", "top_accuracy")
