"""Topics against categories (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    K, analysis_sql, fixed_topics, other_topics, papers, papers_sql, predicted_sql, query, rounded, scores_sql, with_sql,
)
from topicloom.operators import alignment as al, comparison as cm, metrics as me
from topicloom.plans.runs import run_report
from topicloom.runtime import cut_lineage

SPLIT = "list_transform(string_split(categories, ','), lambda x: trim(x))"


def analysis(spark, sf, category="lang"):
    return al.attach_topics(papers(spark, sf, category), fixed_topics(spark, sf))


def contingency(spark, sf, category="lang"):
    return al.contingency(analysis(spark, sf, category))


def pairs(spark, sf, category="lang"):
    """Label pairs from the fixed topics."""
    table = cut_lineage(contingency(spark, sf, category))
    return al.label_pairs(table, al.predicted_by_topic(table, K))


def _pairs_sql(category: str = "lang") -> str:
    return f"{analysis_sql(category)},\n{predicted_sql()}"


@query("e01_dominant_topic", with_sql(analysis_sql(), select="SELECT id, dominant_topic FROM dom"))
def dominant_topic(spark, sf):
    return al.dominant_topics(fixed_topics(spark, sf))


@query("e02_primary_category_counts", with_sql(papers_sql("source"), select="SELECT primary_category, count(*) AS n FROM papers GROUP BY 1"))
def primary_category_counts(spark, sf):
    return al.primary_category_counts(papers(spark, sf, "source"))


@query("e02_category_totals", with_sql(papers_sql(), select=f"""SELECT count(*) AS total_papers,
count(DISTINCT primary_category) AS n_primary_categories,
(SELECT count(DISTINCT c) FROM (SELECT unnest({SPLIT}) AS c FROM papers)) AS n_all_categories FROM papers"""))
def category_totals(spark, sf):
    return al.category_totals(papers(spark, sf))


@query("e03_all_category_counts", with_sql(papers_sql(), select=f"SELECT category, count(*) AS n FROM (SELECT unnest({SPLIT}) AS category FROM papers) GROUP BY 1"))
def all_category_counts(spark, sf):
    return al.all_category_counts(papers(spark, sf))


@query("e04_attach_topics", with_sql(analysis_sql(), select="SELECT id, primary_category, dominant_topic FROM analysis"))
def attach_topics(spark, sf):
    return analysis(spark, sf).select("id", "primary_category", "dominant_topic")


_SHARES = """shares AS (SELECT dominant_topic, primary_category AS category, n,
  n / CAST(sum(n) OVER (PARTITION BY dominant_topic) AS DOUBLE) AS share FROM cont WHERE primary_category IS NOT NULL)"""


@query("e05_category_shares", with_sql(analysis_sql(), _SHARES, select="SELECT dominant_topic, category, n, round(share, 6) AS share FROM shares"))
def category_shares(spark, sf):
    return rounded(al.category_shares(contingency(spark, sf)), "share")


_ALL = f"""mentions AS (SELECT dominant_topic, unnest({SPLIT}) AS category FROM analysis),
all_cont AS (SELECT dominant_topic, category, count(*) AS n FROM mentions GROUP BY ALL)"""


@query("e06_all_category_shares", with_sql(
    analysis_sql(), _ALL, select="""SELECT dominant_topic, category, n,
    round(n / CAST(sum(n) OVER (PARTITION BY dominant_topic) AS DOUBLE), 6) AS share FROM all_cont"""))
def all_category_shares(spark, sf):
    return rounded(al.all_category_shares(analysis(spark, sf)), "share")


#: Two topics more than the matrix has, so that some are empty.
WIDE = K + 2


def _purity_sql(k: int) -> str:
    return f"""purity AS (SELECT CAST(t AS INTEGER) AS dominant_topic, CAST(coalesce(size, 0) AS BIGINT) AS size,
  coalesce(largest / CAST(size AS DOUBLE), 0.0) AS purity
  FROM range({k}) r(t) LEFT JOIN (SELECT dominant_topic, sum(n) AS size, max(n) FILTER (WHERE primary_category IS NOT NULL) AS largest
    FROM cont GROUP BY 1) s ON s.dominant_topic = r.t)"""


@query("e07_empty_topics", with_sql(
    analysis_sql(), f"sizes AS (SELECT dominant_topic, CAST(sum(n) AS BIGINT) AS n FROM cont GROUP BY 1)",
    select=f"SELECT CAST(t AS INTEGER) AS dominant_topic, coalesce(n, 0) AS n FROM range({WIDE}) r(t) LEFT JOIN sizes ON dominant_topic = t"))
def empty_topics(spark, sf):
    sizes = contingency(spark, sf).groupBy("dominant_topic").agg(F.sum("n").alias("n"))
    return al.keep_empty_topics(sizes, WIDE).na.fill(0, ["n"])


@query("e08_topic_purity", with_sql(
    analysis_sql(), _purity_sql(WIDE), select="SELECT dominant_topic, size, round(purity, 6) AS purity FROM purity"))
def topic_purity(spark, sf):
    return rounded(al.topic_purity(contingency(spark, sf), WIDE), "purity")


@query("e09_average_purity", with_sql(
    analysis_sql(), _purity_sql(WIDE), select="SELECT round(avg(purity), 6) AS average_purity FROM purity"))
def average_purity(spark, sf):
    return rounded(al.average_purity(contingency(spark, sf), WIDE), "average_purity")


@query("e10_category_labels", with_sql(
    papers_sql("source"), select="""SELECT id, primary_category, CAST(dense_rank() OVER (ORDER BY primary_category) - 1 AS INTEGER) AS label FROM papers"""))
def category_labels(spark, sf):
    docs = papers(spark, sf, "source").select("id", "primary_category")
    labels = al.category_labels(docs).withColumnRenamed("primary_category", "_category")
    same = F.col("primary_category").eqNullSafe(F.col("_category"))  # a missing category has a label too
    return docs.join(labels, same).drop("_category")


_ARI = """m AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM cont) AS i,
  (SELECT sum(a * (a - 1) / 2.0) FROM (SELECT sum(n) AS a FROM cont GROUP BY primary_category)) AS a,
  (SELECT sum(b * (b - 1) / 2.0) FROM (SELECT sum(n) AS b FROM cont GROUP BY dominant_topic)) AS b,
  (SELECT sum(n) FROM cont) AS t),
ari AS (SELECT CAST(CASE WHEN (a + b) / 2 - a * b / (t * (t - 1) / 2.0) = 0 THEN 1.0
  ELSE (i - a * b / (t * (t - 1) / 2.0)) / ((a + b) / 2 - a * b / (t * (t - 1) / 2.0)) END AS DOUBLE) AS ari FROM m)"""


@query("e11_adjusted_rand", with_sql(analysis_sql(), _ARI, select="SELECT round(ari, 6) AS ari FROM ari"))
def adjusted_rand(spark, sf):
    return rounded(al.adjusted_rand(contingency(spark, sf)), "ari")


_NMI = """tot AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM cont),
ha AS (SELECT -sum(a / t * ln(a / t)) AS h FROM (SELECT sum(n) AS a FROM cont GROUP BY primary_category), tot),
hb AS (SELECT -sum(b / t * ln(b / t)) AS h FROM (SELECT sum(n) AS b FROM cont GROUP BY dominant_topic), tot),
hab AS (SELECT -sum(n / t * ln(n / t)) AS h FROM cont, tot),
nmi AS (SELECT CASE WHEN ha.h + hb.h = 0 THEN 1.0 ELSE (ha.h + hb.h - hab.h) / ((ha.h + hb.h) / 2) END AS nmi FROM ha, hb, hab)"""


@query("e12_normalized_mutual_info", with_sql(analysis_sql(), _NMI, select="SELECT round(nmi, 6) AS nmi FROM nmi"))
def normalized_mutual_info(spark, sf):
    return rounded(al.normalized_mutual_info(contingency(spark, sf)), "nmi")


_SUMMARY = with_sql(
    analysis_sql(), _purity_sql(K), _ARI, _NMI,
    select=f"""SELECT round(avg(purity), 6) AS average_purity, round(any_value(ari.ari), 6) AS ari, round(any_value(nmi.nmi), 6) AS nmi,
    {K} AS num_topics, (SELECT count(DISTINCT primary_category) FROM cont) AS num_categories FROM purity, ari, nmi""")


@query("e13_alignment_summary", _SUMMARY)
def alignment_summary(spark, sf):
    tables = al.alignment(papers(spark, sf), fixed_topics(spark, sf), K)
    return rounded(tables["summary"], "average_purity", "ari", "nmi")


@query("e14_predicted_by_topic", with_sql(analysis_sql("source"), predicted_sql(WIDE), select="SELECT * FROM predicted"))
def predicted_by_topic(spark, sf):
    return al.predicted_by_topic(contingency(spark, sf, "source"), WIDE)


@query("e15_predict", with_sql(_pairs_sql("source"), select="SELECT id, predicted_category FROM analysis JOIN predicted USING (dominant_topic)"))
def predict(spark, sf):
    docs = analysis(spark, sf, "source")
    return al.predict(docs, al.predicted_by_topic(al.contingency(docs), K)).select("id", "predicted_category")


MIN_SUPPORT = 50
_SUPPORTED = f"""valid AS (SELECT true_category AS category, CAST(sum(n) AS BIGINT) AS support FROM pairs GROUP BY 1 HAVING sum(n) >= {MIN_SUPPORT}),
kept AS (SELECT pairs.* FROM pairs WHERE true_category IN (SELECT category FROM valid))"""


@query("e16_supported_categories", with_sql(_pairs_sql("source"), _SUPPORTED, select="SELECT * FROM kept"))
def supported_categories(spark, sf):
    counted = pairs(spark, sf, "source")
    return me.keep_true(counted, me.supported(counted, MIN_SUPPORT))


@query("e17_category_universe", with_sql(
    _pairs_sql("source"), select="SELECT true_category AS category FROM pairs UNION SELECT predicted_category FROM pairs"))
def category_universe(spark, sf):
    return me.universe(pairs(spark, sf, "source"))


@query("e18_accuracy", with_sql(
    _pairs_sql(), select="SELECT round(sum(n) FILTER (WHERE true_category = predicted_category) / CAST(sum(n) AS DOUBLE), 6) AS accuracy FROM pairs"))
def accuracy(spark, sf):
    docs = analysis(spark, sf)
    predictions = al.predict(docs, al.predicted_by_topic(al.contingency(docs), K))
    return rounded(me.accuracy(me.pairs_of(predictions)), "accuracy")


_SCORE_COLUMNS = "category, round(CAST(precision AS DOUBLE), 6) AS precision, round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1 AS DOUBLE), 6) AS f1, support"


@query("e19_category_scores", with_sql(_pairs_sql(), scores_sql(), select=f"SELECT {_SCORE_COLUMNS} FROM scores"))
def category_scores(spark, sf):
    counted = pairs(spark, sf)
    return rounded(me.category_scores(counted, me.universe(counted)), "precision", "recall", "f1")


@query("e20_macro_average", with_sql(
    _pairs_sql("source"), _SUPPORTED, scores_sql("kept"), select="""SELECT round(avg(precision), 6) AS precision_macro,
    round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro FROM scores"""))
def macro_average(spark, sf):
    counted = pairs(spark, sf, "source")
    kept = me.keep_true(counted, me.supported(counted, MIN_SUPPORT))
    return rounded(me.macro_average(kept), "precision_macro", "recall_macro", "f1_macro")


@query("e21_weighted_average", with_sql(
    _pairs_sql(), scores_sql(), select="""SELECT round(sum(precision * support) / sum(support), 6) AS precision_weighted,
    round(sum(recall * support) / sum(support), 6) AS recall_weighted, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM scores"""))
def weighted_average(spark, sf):
    return rounded(me.weighted_average(pairs(spark, sf)), "precision_weighted", "recall_weighted", "f1_weighted")


_CONFUSION = """names AS (SELECT category FROM valid),
confusion AS (SELECT a.category AS true_category, b.category AS predicted_category, coalesce(k.n, 0) AS n
  FROM names a CROSS JOIN names b LEFT JOIN kept k ON k.true_category = a.category AND k.predicted_category = b.category)"""


@query("e22_confusion", with_sql(_pairs_sql("source"), _SUPPORTED, _CONFUSION, select="SELECT * FROM confusion"))
def confusion(spark, sf):
    counted = pairs(spark, sf, "source")
    valid = me.supported(counted, MIN_SUPPORT)
    return me.confusion(me.keep_true(counted, valid), valid)


@query("e23_support", with_sql(_pairs_sql("source"), select="SELECT true_category AS category, CAST(sum(n) AS BIGINT) AS support FROM pairs GROUP BY 1"))
def support(spark, sf):
    return me.support(pairs(spark, sf, "source"))


def overall_sql(scores: str = "scores") -> str:
    parts = [f"round(avg({c}), 6) AS {c}_macro, round(sum({c} * support) / sum(support), 6) AS {c}_weighted" for c in ("precision", "recall", "f1")]
    return f"SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, {', '.join(parts)} FROM {scores}"


OVERALL = ["accuracy"] + [f"{c}_{kind}" for kind in ("macro", "weighted") for c in ("precision", "recall", "f1")]


@query("e24_overall_scores", with_sql(_pairs_sql("source"), _SUPPORTED, scores_sql("kept"), select=overall_sql()))
def overall_scores(spark, sf):
    found = me.classification(pairs(spark, sf, "source"), min_support=MIN_SUPPORT)
    return rounded(found["overall"], *OVERALL)


@query("e24_supported_scores", with_sql(
    _pairs_sql("source"), _SUPPORTED, scores_sql("kept"),
    select=f"SELECT {_SCORE_COLUMNS} FROM scores WHERE category IN (SELECT category FROM valid)"))
def supported_scores(spark, sf):
    found = me.classification(pairs(spark, sf, "source"), min_support=MIN_SUPPORT)
    return rounded(found["per_category"], "precision", "recall", "f1")


_TOP = """top AS (SELECT true_category AS category, sum(n) AS support FROM pairs GROUP BY 1 ORDER BY support DESC, category LIMIT 10),
top_pairs AS (SELECT * FROM pairs WHERE true_category IN (SELECT category FROM top))"""


@query("e25_top_category_scores", with_sql(
    _pairs_sql("source"), _TOP, scores_sql("top_pairs"), select=f"""SELECT {_SCORE_COLUMNS}, CAST(row_number() OVER (ORDER BY support DESC, category) AS INTEGER) AS position
    FROM scores WHERE category IN (SELECT category FROM top)"""))
def top_category_scores(spark, sf):
    counted = pairs(spark, sf, "source")
    top = me.top_categories(counted)
    scores = me.top_classification(counted)["per_category"]
    return rounded(scores.join(top.select("category", "position"), "category"), "precision", "recall", "f1")


@query("e26_topic_accuracy", with_sql(
    _pairs_sql(), """acc AS (SELECT dominant_topic, CAST(sum(CASE WHEN primary_category = predicted_category THEN n ELSE 0 END) AS BIGINT) AS correct,
    CAST(sum(n) AS BIGINT) AS total, any_value(predicted_category) AS predicted_category FROM cont JOIN predicted USING (dominant_topic) GROUP BY 1)""",
    select="""SELECT CAST(t AS INTEGER) AS topic, round(coalesce(correct / CAST(total AS DOUBLE), 0.0), 6) AS accuracy, coalesce(correct, 0) AS correct,
    coalesce(total, 0) AS total, coalesce(predicted_category, 'Unknown') AS predicted_category
    FROM range((SELECT max(dominant_topic) + 1 FROM cont)) r(t) LEFT JOIN acc ON dominant_topic = t"""))
def topic_accuracy(spark, sf):
    table = cut_lineage(contingency(spark, sf))
    return rounded(me.topic_accuracy(table, al.predicted_by_topic(table, WIDE)), "accuracy")


def _method_sql(m: str, k: int, position: int) -> str:
    """CTEs of method ``m`` from ``{m}_analysis`` to its summary ``{m}_row``."""
    return f"""{m}_cont AS (SELECT primary_category, dominant_topic, count(*) AS n FROM {m}_analysis WHERE primary_category IS NOT NULL GROUP BY ALL),
{m}_best AS (SELECT dominant_topic, primary_category AS predicted_category FROM {m}_cont
  QUALIFY row_number() OVER (PARTITION BY dominant_topic ORDER BY n DESC, primary_category) = 1),
{m}_pairs AS (SELECT primary_category AS true_category, predicted_category, CAST(sum(n) AS BIGINT) AS n
  FROM {m}_cont JOIN {m}_best USING (dominant_topic) GROUP BY ALL),
{m}_size AS (SELECT true_category, sum(n) AS support FROM {m}_pairs GROUP BY 1),
{m}_kept AS (SELECT * FROM {m}_pairs WHERE true_category IN (SELECT true_category FROM {m}_size WHERE support >= {MIN_SUPPORT})),
{scores_sql(f"{m}_kept", f"{m}_scores")},
{m}_top AS (SELECT * FROM {m}_pairs WHERE true_category IN (SELECT true_category FROM {m}_size ORDER BY support DESC, true_category LIMIT 10)),
{scores_sql(f"{m}_top", f"{m}_top_scores")},
{m}_row AS (SELECT '{m}' AS method, CAST(sum(recall * support) / sum(support) AS DOUBLE) AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted,
  avg(f1) AS f1_macro, {k} AS num_topics,
  (SELECT sum(recall * support) / sum(support) FROM {m}_top_scores) AS top_accuracy,
  (SELECT sum(f1 * support) / sum(support) FROM {m}_top_scores) AS top_f1_weighted, {position} AS position FROM {m}_scores)"""


def _methods_sql(category: str = "lang") -> str:
    """Rows of both fixed topic matrices; ``methods`` holds them."""
    first = f"fixed_analysis AS (SELECT * FROM analysis),\n{_method_sql('fixed', K, 0)}"
    second = f"""other_analysis AS MATERIALIZED (SELECT p.*, CAST(d.size % 3 AS INTEGER) AS dominant_topic FROM papers p JOIN dist d USING (id)),
{_method_sql('other', 3, 1)}"""
    return f"{analysis_sql(category)},\n{first},\n{second},\nmethods AS (SELECT * FROM fixed_row UNION ALL SELECT * FROM other_row)"


def method_rows(spark, sf, category="lang"):
    """Both fixed matrices compared; a third method without results is skipped."""
    found = {"fixed": (fixed_topics(spark, sf), K), "missing": None, "other": (other_topics(spark, sf), 3)}
    return cm.compare_methods(papers(spark, sf, category), found)


FIGURES = ("accuracy", "f1_weighted", "f1_macro", "top_accuracy", "top_f1_weighted")
_FIGURES = ", ".join(f"round({c}, 6) AS {c}" for c in FIGURES)


@query("e27_evaluate_method", with_sql(_methods_sql(), select=f"SELECT method, num_topics, {_FIGURES} FROM methods WHERE method = 'fixed'"))
def evaluate_method(spark, sf):
    found = cm.evaluate_method(papers(spark, sf), fixed_topics(spark, sf), K, "fixed")
    return rounded(found["method_summary"], *FIGURES)


@query("e28_compare_methods", with_sql(
    _methods_sql(), select=f"SELECT method, num_topics, CAST(CASE position WHEN 0 THEN 0 ELSE 2 END AS INTEGER) AS position, {_FIGURES} FROM methods"))
def compare_methods(spark, sf):
    return rounded(method_rows(spark, sf), *FIGURES)


@query("e29_comparison_summary", with_sql(_methods_sql(), select=f"SELECT method, num_topics, {_FIGURES} FROM methods"))
def comparison_summary(spark, sf):
    return rounded(cm.comparison_summary(method_rows(spark, sf)), *FIGURES)


@query("e30_best_method", with_sql(
    _methods_sql(), select="SELECT method, round(accuracy, 6) AS accuracy FROM methods WHERE methods.accuracy > 0 ORDER BY methods.accuracy DESC, position LIMIT 1"))
def best_method(spark, sf):
    return rounded(cm.best_method(method_rows(spark, sf)), "accuracy")


@query("e31_report_tables", with_sql(
    f"{analysis_sql()},\n{predicted_sql()}", f"mentions AS (SELECT id, unnest({SPLIT}) AS c FROM papers)",
    "all_m AS (SELECT dominant_topic, c FROM mentions JOIN dom USING (id))",
    select=f"""SELECT * FROM (SELECT 'analysis' AS name, count(*) AS rows FROM analysis UNION ALL SELECT 'predictions', count(*) FROM analysis
    UNION ALL SELECT 'contingency', count(*) FROM cont UNION ALL SELECT 'pairs', count(*) FROM pairs
    UNION ALL SELECT 'primary_shares', count(*) FROM cont UNION ALL SELECT 'all_shares', count(*) FROM (SELECT DISTINCT dominant_topic, c FROM all_m)
    UNION ALL SELECT 'purity', {K} UNION ALL SELECT 'primary_counts', count(DISTINCT primary_category) FROM papers
    UNION ALL SELECT 'all_counts', count(DISTINCT c) FROM mentions
    UNION ALL SELECT 'per_topic_accuracy', max(dominant_topic) + 1 FROM cont
    UNION ALL SELECT 'topic_sizes', count(DISTINCT dominant_topic) FROM cont UNION ALL SELECT 'top_words', 20)"""))
def report_tables(spark, sf):
    from topicloom.catalog.base import source_words, union_all

    found = run_report(papers(spark, sf), cut_lineage(fixed_topics(spark, sf)), source_words(spark, sf), K)
    names = ("analysis", "predictions", "contingency", "pairs", "primary_shares", "all_shares", "purity", "primary_counts",
             "all_counts", "per_topic_accuracy", "topic_sizes", "top_words")
    return union_all([found[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in names])
