"""Text normalisation (T) and corpus assembly (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    clean_sql, lemma_sql, papers, papers_sql, query, split_sql, stopwords_sql, table, tokens_sql, with_sql,
)
from topicloom.functions import text
from topicloom.operators import corpus as co, normalise as no

# -- T: each step alone, over the whole texts ---------------------------------------


def _texts(spark, sf):
    return no.spread_rows(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))


def _tokens(spark, sf):
    return _texts(spark, sf).select("id", text.tokenize(text.clean_text("text")).alias("tokens"))


@query("t01_fill_missing", """
SELECT t.doc_id AS id, coalesce(l.note, '') AS text FROM documents t
LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' END AS note FROM labels) l USING (doc_id)""")
def fill_missing(spark, sf):
    notes = table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, F.lit("toxic")).alias("note"))
    docs = table(spark, sf, "documents").select("doc_id").join(notes, "doc_id", "left")
    return docs.select(F.col("doc_id").alias("id"), text.fill_missing("note").alias("text"))


@query("t02_lowercase", "SELECT doc_id AS id, lower(text) AS text FROM documents")
def lowercase(spark, sf):
    return _texts(spark, sf).select("id", F.lower("text").alias("text"))


@query("t03_drop_urls", r"SELECT doc_id AS id, regexp_replace(text, 'http\S+|www\S+|https\S+', '', 'g') AS text FROM documents")
def drop_urls(spark, sf):
    return _texts(spark, sf).select("id", text.drop_urls("text").alias("text"))


@query("t04_drop_emails", r"SELECT doc_id AS id, regexp_replace(text, '\S+@\S+', '', 'g') AS text FROM documents")
def drop_emails(spark, sf):
    return _texts(spark, sf).select("id", text.drop_emails("text").alias("text"))


@query("t05_drop_symbols", r"SELECT doc_id AS id, regexp_replace(text, '[^a-zA-Z0-9\s]', ' ', 'g') AS text FROM documents")
def drop_symbols(spark, sf):
    return _texts(spark, sf).select("id", text.drop_symbols("text").alias("text"))


@query("t06_squeeze_spaces", r"SELECT doc_id AS id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def squeeze_spaces(spark, sf):
    return _texts(spark, sf).select("id", text.squeeze_spaces("text").alias("text"))


@query("t07_clean_text", f"SELECT doc_id AS id, {clean_sql('text')} AS text FROM documents")
def clean_text(spark, sf):
    return _texts(spark, sf).select("id", text.clean_text("text").alias("text"))


_WORDS = f"words AS (SELECT doc_id AS id, {split_sql(clean_sql('text'))} AS ws FROM documents)"


@query("t08_tokenize", with_sql(_WORDS, select="SELECT id, array_to_string(ws, ' ') AS tokens, CAST(len(ws) AS INTEGER) AS n FROM words"))
def tokenize(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


@query("t09_lemmatize", with_sql(
    _WORDS, f"lem AS (SELECT id, list_transform(ws, lambda t: {lemma_sql()}) AS ls FROM words)",
    select="SELECT id, array_to_string(ls, ' ') AS lemmas FROM lem"))
def lemmatize(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join(text.lemmatize("tokens"), " ").alias("lemmas"))


@query("t09_lemmatize_by_table", with_sql(
    _WORDS,
    "raw AS (SELECT id, unnest(ws) AS t, generate_subscripts(ws, 1) AS pos FROM words)",
    "vocab AS (SELECT DISTINCT t FROM raw)",
    """ends(old, new) AS (VALUES ('s',''),('ses','s'),('ves','f'),('xes','x'),('zes','z'),('ches','ch'),('shes','sh'),('men','man'),('ies','y'))""",
    """cand AS (SELECT t, t AS c FROM vocab UNION ALL
      SELECT t, t[1:length(t) - length(old)] || new FROM vocab JOIN ends ON suffix(t, old))""",
    """best AS (SELECT t, arg_min(c, struct_pack(n := length(c), c := c)) AS lemma FROM cand
      WHERE c <> '' AND c IN (SELECT t FROM vocab) GROUP BY t)""",
    select="""SELECT w.id, coalesce(g.lemmas, '') AS lemmas FROM words w LEFT JOIN (
      SELECT id, string_agg(coalesce(lemma, t), ' ' ORDER BY pos) AS lemmas FROM raw LEFT JOIN best USING (t) GROUP BY id) g USING (id)"""))
def lemmatize_by_table(spark, sf):
    docs = _tokens(spark, sf)
    terms = docs.select(F.explode("tokens").alias("term")).distinct()
    table_ = no.build_lemma_table(terms, terms.select(F.col("term").alias("noun")))
    return no.lemmatize_with(docs, table_).select("id", F.array_join("tokens", " ").alias("lemmas"))


def _filtered(condition: str) -> str:
    return with_sql(_WORDS, select=f"SELECT id, array_to_string(list_filter(ws, lambda t: {condition}), ' ') AS tokens FROM words")


@query("t10_length_filter", _filtered("length(t) BETWEEN 2 AND 30"))
def length_filter(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join(F.filter("tokens", lambda t: text.within_length(t)), " ").alias("tokens"))


@query("t11_stopword_filter", _filtered(f"t NOT IN ({stopwords_sql()})"))
def stopword_filter(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join(F.filter("tokens", lambda t: text.not_stopword(t)), " ").alias("tokens"))


@query("t12_letters_only", _filtered("regexp_full_match(t, '[a-z]+')"))
def letters_only(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join(F.filter("tokens", text.only_letters), " ").alias("tokens"))


@query("t13_filter_tokens", _filtered(
    f"length(t) BETWEEN 2 AND 30 AND regexp_full_match(t, '[a-z]+') AND t NOT IN ({stopwords_sql()})"))
def filter_tokens(spark, sf):
    return _tokens(spark, sf).select("id", F.array_join(text.filter_tokens("tokens"), " ").alias("tokens"))


@query("t14_join_tokens", with_sql(_WORDS, select="SELECT id, array_to_string(list_reverse(ws), ' ') AS text FROM words"))
def join_tokens(spark, sf):
    return _tokens(spark, sf).select("id", text.join_tokens(F.reverse("tokens")).alias("text"))


@query("t15_preprocess", with_sql(
    tokens_sql(), select="""SELECT p.id, coalesce(g.t, '') AS processed_text FROM papers p
    LEFT JOIN (SELECT id, string_agg(term, ' ' ORDER BY pos) AS t FROM tok GROUP BY id) g USING (id)"""))
def preprocess(spark, sf):
    return _texts(spark, sf).select("id", text.join_tokens(text.preprocess_tokens("text")).alias("processed_text"))


@query("t16_preprocess_abstracts", with_sql(
    tokens_sql(), select="SELECT id, string_agg(term, ' ' ORDER BY pos) AS processed_text FROM tok GROUP BY id"))
def preprocess_abstracts(spark, sf):
    return no.preprocess_abstracts(papers(spark, sf)).select("id", "processed_text")


@query("t16_removed_counts", with_sql(
    tokens_sql(), select="""SELECT (SELECT count(*) FROM papers) AS n_in, count(DISTINCT id) AS n_kept,
    (SELECT count(*) FROM papers) - count(DISTINCT id) AS n_removed FROM tok"""))
def removed_counts(spark, sf):
    return no.removed_counts(papers(spark, sf))


# -- C ------------------------------------------------------------------------------

#: Category order of the assembled corpus, and its limits.
ORDER = ("de", "fr", "es", "en")
LIMIT = 300
QUOTA = 150
YEAR = 2016

_LISTED = f"""{papers_sql()},
listed AS (SELECT id, published, unnest(string_split(categories, ', ')) AS category FROM papers)"""


def _list_papers(spark, sf):
    return papers(spark, sf).withColumn("categories", F.split("categories", ", "))


def _listed(spark, sf):
    return _list_papers(spark, sf).select("id", "published", F.explode("categories").alias("category"))


@query("c01_in_category", with_sql(papers_sql(), select="SELECT id FROM papers WHERE list_contains(string_split(categories, ', '), 'fr')"))
def in_category(spark, sf):
    return co.in_category(_list_papers(spark, sf), "fr").select("id")


@query("c02_newest_first", with_sql(
    papers_sql(), select="SELECT id, CAST(row_number() OVER (ORDER BY published DESC, id) AS INTEGER) AS place FROM papers"))
def newest_first(spark, sf):
    from topicloom.runtime import number_rows

    numbered = number_rows(papers(spark, sf).select("id", "published"), co.newest_first(), "n")
    return numbered.select("id", (F.col("n") + 1).alias("place"))


@query("c03_category_quota", with_sql(
    _LISTED, select=f"""SELECT id, category, CAST(row_number() OVER (PARTITION BY category ORDER BY published DESC, id) AS INTEGER) AS rank
    FROM listed WHERE category IN ('de', 'fr', 'es', 'en') QUALIFY rank <= {QUOTA}"""))
def category_quota(spark, sf):
    return co.category_candidates(_list_papers(spark, sf), ORDER, co.category_quota(LIMIT, len(ORDER))).select("id", "category", "rank")


@query("c04_publication_year", with_sql(papers_sql(), select="SELECT id, CAST(year(published) AS INTEGER) AS year FROM papers"))
def publication_year(spark, sf):
    return co.publication_year(papers(spark, sf)).select("id", "year")


@query("c05_from_year", with_sql(papers_sql(), select=f"SELECT id FROM papers WHERE year(published) >= {YEAR}"))
def from_year(spark, sf):
    return co.from_year(papers(spark, sf), YEAR).select("id")


@query("c06_first_category", with_sql(
    _LISTED, select="""SELECT id, arg_min(category, list_position(['de', 'fr', 'es', 'en'], category)) AS category
    FROM listed WHERE category IN ('de', 'fr', 'es', 'en') GROUP BY id"""))
def first_category(spark, sf):
    wanted = _listed(spark, sf).where(F.col("category").isin(*ORDER))
    return co.first_category(wanted, ORDER)


@query("c07_global_cap", with_sql(papers_sql(), select=f"SELECT id, published FROM papers ORDER BY published DESC, id LIMIT {LIMIT}"))
def global_cap(spark, sf):
    return co.cap(papers(spark, sf), LIMIT).select("id", "published")


@query("c08_keep_first", """SELECT conv_id AS id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""")
def keep_first(spark, sf):
    turns = table(spark, sf, "conversations").withColumnRenamed("conv_id", "id")
    return co.keep_first(turns, "id", [F.col("turn")]).select("id", "turn", "role", "text")


@query("c09_flatten_lists", with_sql(papers_sql(), select="SELECT id, categories FROM papers"))
def flatten_lists(spark, sf):
    return co.flatten_lists(_list_papers(spark, sf)).select("id", "categories")


@query("c10_short_id", "SELECT page_id, list_extract(string_split(url, '/'), -1) AS short_id FROM pages")
def short_id(spark, sf):
    return table(spark, sf, "pages").select("page_id", co.short_id("url").alias("short_id"))


@query("c11_ensure_categories", "SELECT doc_id AS id, lang AS primary_category, '' AS categories FROM documents")
def ensure_categories(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("primary_category"))
    return co.ensure_categories(docs)


@query("c12_collection_totals", with_sql(papers_sql(), select="""SELECT count(*) AS n_papers,
CAST(min(year(published)) AS INTEGER) AS min_year, CAST(max(year(published)) AS INTEGER) AS max_year FROM papers"""))
def collection_totals(spark, sf):
    return co.collection_totals(co.publication_year(papers(spark, sf)))


@query("c12_largest_categories", with_sql(
    papers_sql("source"), select="SELECT primary_category, count(*) AS n FROM papers GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"))
def largest_categories(spark, sf):
    return co.largest_categories(papers(spark, sf, "source"))


def _collector_sql() -> str:
    """The steps one after another: each category sees what the ones before have left."""
    parts = [papers_sql(), f"""ranked AS MATERIALIZED (SELECT id, published, unnest(string_split(categories, ', ')) AS category FROM papers)""",
             """placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY category ORDER BY published DESC, id) AS place FROM ranked)""",
             "got0 AS (SELECT CAST(NULL AS BIGINT) AS id, '' AS collected_for WHERE false)"]
    for i, name in enumerate(ORDER, 1):
        parts.append(f"""got{i} AS MATERIALIZED (SELECT * FROM got{i - 1} UNION ALL
  SELECT id, '{name}' FROM placed WHERE category = '{name}' AND year(published) >= {YEAR}
    AND place <= least({QUOTA}, {LIMIT} - (SELECT count(*) FROM got{i - 1}))
    AND id NOT IN (SELECT id FROM got{i - 1}))""")
    return with_sql(*parts, select=f"""SELECT g.id, g.collected_for, CAST(year(p.published) AS INTEGER) AS year, p.primary_category
FROM got{len(ORDER)} g JOIN papers p USING (id)""")


@query("c13_assemble_corpus", _collector_sql())
def assemble_corpus(spark, sf):
    found = co.assemble_corpus(_list_papers(spark, sf), ORDER, max_results=LIMIT, min_year=YEAR)
    return found.select("id", "collected_for", "year", "primary_category")
