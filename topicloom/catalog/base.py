"""Inputs of the registered queries, in Spark and in SQL.

The ``documents`` table stands in for papers: text as abstract, ``source`` and ``lang`` as
categories. Where a query needs topics without a fitted model, the topic matrix is fixed:
topic ``j`` of 4 weighs the share of a document's tokens whose length is ``j`` modulo 4.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from topicloom.functions.text import CONTRACTIONS, stopword_list
from topicloom.functions.words import IRREGULAR_PLURALS, NO_PLURALS, SCIENCE_ENDINGS
from topicloom.operators import features as fe
from topicloom.operators.normalise import preprocess_abstracts
from topicloom.runtime import cut_lineage, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

K = 4


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where there is one."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


# -- Spark side --------------------------------------------------------------------


def papers(spark: SparkSession, sf: str, category: str = "lang") -> DataFrame:
    """Papers with comma-separated categories; one paper a day over ten years."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("abstract"),
        F.col(category).alias("primary_category"),
        F.concat_ws(", ", "source", "lang").alias("categories"),
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("doc_id") % 3650).cast("int"))
        .cast("timestamp")
        .alias("published"),
    )


def processed(spark: SparkSession, sf: str, category: str = "lang") -> DataFrame:
    return preprocess_abstracts(papers(spark, sf, category))


def written_tokens(spark: SparkSession, sf: str, *more: str, category: str = "lang") -> DataFrame:
    """Ids, tokens and ``more`` columns of processed papers, written for what reads them repeatedly."""
    return cut_lineage(processed(spark, sf, category).select("id", *more, "tokens"))


def fixed_topics(spark: SparkSession, sf: str) -> DataFrame:
    docs = preprocess_abstracts(papers(spark, sf).select("id", "abstract"))

    def share(j: int):
        return F.size(F.filter("tokens", lambda t: F.length(t) % K == j)) / F.size("tokens")

    return docs.select("id", F.array(*[share(j) for j in range(K)]).alias("topic_dist"))


def other_topics(spark: SparkSession, sf: str) -> DataFrame:
    """A second fixed matrix with 3 topics, by the number of tokens and the text length."""
    docs = preprocess_abstracts(papers(spark, sf).select("id", "abstract"))
    pick = F.size("tokens") % 3
    dist = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda j: F.when(j == pick, 0.8).otherwise(0.1))
    return docs.select("id", dist.alias("topic_dist"))


def cluster_topics(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, topic)``: text length modulo 5, every 11th document an outlier."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(-1)).otherwise((F.col("n_chars") % 5).cast("int")).alias("topic"),
    )


def source_words(spark: SparkSession, sf: str, n: int = 20, docs: DataFrame | None = None) -> DataFrame:
    """Topic words: the ``n`` most frequent terms of every source, topics in source order.

    ``docs`` are the papers processed with their source as category, where these are at hand."""
    docs = processed(spark, sf, "source") if docs is None else docs
    counts = (
        docs.select("primary_category", F.explode("tokens").alias("word"))
        .groupBy("primary_category", "word")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    counts = cut_lineage(counts)
    numbers = Window.orderBy("primary_category")
    topics = counts.select("primary_category").distinct().withColumn("topic_id", F.row_number().over(numbers) - 1)
    order = Window.partitionBy("primary_category").orderBy(F.desc("weight"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.join(F.broadcast(topics), "primary_category").select("topic_id", "rank", "word", "weight")


VECTOR_DIMS = 64


def embedding_coords(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, coords)``: the supplied vectors."""
    vectors = table(spark, sf, "embeddings")
    return vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("coords"))


def slot_terms(slot: int, slots: int) -> list[tuple[int, str]]:
    """Positions and signs of what is summed in a slot: all positions are dealt out in turn,
    and every second one of a slot counts negative."""
    return [(i, "+-"[i // slots % 2]) for i in range(slot, VECTOR_DIMS, slots)]


def projected_coords(spark: SparkSession, sf: str, slots: int = 3) -> DataFrame:
    """``(id, coords)``: the supplied vectors, all of their dimensions summed into few slots."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    sums = [
        reduce(lambda s, t: s + F.get("x", F.lit(t[0])) if t[1] == "+" else s - F.get("x", F.lit(t[0])), slot_terms(j, slots), F.lit(0.0))
        for j in range(slots)
    ]
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), x.alias("x"))
    return vectors.select("id", F.array(*sums).alias("coords"))


def projected_sql(slot: int, slots: int = 3) -> str:
    return "0.0::DOUBLE" + "".join(f" {sign} CAST(embedding[{i + 1}] AS DOUBLE)" for i, sign in slot_terms(slot, slots))


class Fitted:
    """Processed documents, vocabulary and vectors for a query that fits a model.

    Every pass of a fit reads the vectors again. They and the tokens are checkpointed in the
    shared folder, with nothing but what a fit needs. A checkpoint is read row by row, so a task
    holds a few rows of its partition, whatever its size; a cached partition that is on disk comes
    back in batches of which a task keeps up to a hundred. (A fit by Spark ML starts from random
    numbers by partition: checkpointed rows stay in theirs.)
    """

    def __init__(self, spark: SparkSession, sf: str):
        shared_dir(spark)
        self.docs = processed(spark, sf).select("id", "tokens").checkpoint()
        self.vocab = fe.vocabulary(self.docs)
        self.lexicon = fe.Lexicon.of(self.vocab)
        self.vectors = fe.tfidf_vectors(self.docs, self.lexicon).select("id", "features").checkpoint()
        self.rows = fe.sparse_rows(self.vectors)

    def __enter__(self) -> "Fitted":
        return self

    def __exit__(self, *_) -> None:
        """Results may still read the checkpoints, so these stay, as other written tables do."""


# -- SQL side ----------------------------------------------------------------------


def papers_sql(category: str = "lang") -> str:
    return f"""papers AS (
  SELECT doc_id AS id, text AS abstract, {category} AS primary_category,
         concat_ws(', ', source, lang) AS categories,
         CAST(DATE '2015-01-01' + CAST(doc_id % 3650 AS INTEGER) AS TIMESTAMP) AS published
  FROM documents)"""


def clean_sql(column: str = "abstract") -> str:
    text = f"lower(coalesce({column}, ''))"
    for pattern, by in (
        (r"http\S+|www\S+|https\S+", ""),
        (r"\S+@\S+", ""),
        (r"[^a-zA-Z0-9\s]", " "),
        (r"\s+", " "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"trim({text})"


def split_sql(text: str) -> str:
    for head, tail in CONTRACTIONS:
        text = rf"regexp_replace({text}, '\b{head}{tail}\b', '{head} {tail}', 'g')"
    return f"list_filter(string_split({text}, ' '), lambda t: t <> '')"


def lemma_sql(t: str = "t") -> str:
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR_PLURALS.items())
    science = " OR ".join(f"{t} LIKE '%{e}'" for e in SCIENCE_ENDINGS)
    singular = ", ".join(f"'{w}'" for w in NO_PLURALS)
    return f"""CASE {t} {irregular} ELSE CASE
  WHEN {t} NOT LIKE '%s' OR length({t}) <= 3 OR {science} OR {t} IN ({singular}) THEN {t}
  WHEN {t} LIKE '%ss' OR {t} LIKE '%us' OR {t} LIKE '%is' THEN {t}
  WHEN {t} LIKE '%ies' AND length({t}) > 4 THEN {t}[:-4] || 'y'
  WHEN {t} LIKE '%ches' OR {t} LIKE '%shes' OR {t} LIKE '%xes' OR {t} LIKE '%zes' OR {t} LIKE '%sses'
    OR (length({t}) >= 7 AND regexp_matches({t}, '[ehiknprst]uses$')) THEN {t}[:-3]
  ELSE {t}[:-2] END END"""


def stopwords_sql() -> str:
    return ", ".join(f"'{w}'" for w in stopword_list())


def tokens_sql(category: str = "lang", source: str | None = None) -> str:
    """CTEs ``papers`` and ``tok (id, pos, term)`` with the tokens that are kept."""
    first = source or papers_sql(category)
    return f"""{first},
cleaned AS (SELECT id, {clean_sql()} AS body FROM papers),
words AS (SELECT id, {split_sql('body')} AS ws FROM cleaned),
raw AS (SELECT id, unnest(ws) AS t, generate_subscripts(ws, 1) AS pos FROM words),
lem AS (SELECT id, pos, {lemma_sql()} AS term FROM raw),
tok AS MATERIALIZED (SELECT id, pos, term FROM lem
  WHERE length(term) BETWEEN 2 AND 30 AND regexp_full_match(term, '[a-z]+') AND term NOT IN ({stopwords_sql()}))"""


def tf_sql() -> str:
    return """tf AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term),
n AS (SELECT count(DISTINCT id) AS n FROM tok)"""


def vocab_sql(keep_by: str = "ctf", max_terms: int = 10_000) -> str:
    return f"""freq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM tf GROUP BY term),
kept AS (SELECT freq.* FROM freq, n WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * n.n
  ORDER BY {keep_by} DESC, term LIMIT {max_terms}),
vocab AS MATERIALIZED (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, df, ctf,
  ln((1 + n.n) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM kept, n)"""


def tfidf_sql() -> str:
    return """weighted AS (SELECT tf.id, v.term_id, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)),
tfidf AS MATERIALIZED (SELECT id, term_id, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM weighted)"""


def features_sql(category: str = "lang") -> str:
    return f"{tokens_sql(category)},\n{tf_sql()},\n{vocab_sql()},\n{tfidf_sql()}"


def dist_sql() -> str:
    """CTEs ``dist (id, c0..c3, size)`` and ``dom (id, dominant_topic)``."""
    counts = ", ".join(f"count(*) FILTER (WHERE length(term) % {K} = {j}) AS c{j}" for j in range(K))
    return f"""dist AS MATERIALIZED (SELECT id, {counts}, count(*) AS size FROM tok GROUP BY id),
dom AS (SELECT id, CASE WHEN c0 >= c1 AND c0 >= c2 AND c0 >= c3 THEN 0 WHEN c1 >= c2 AND c1 >= c3 THEN 1
  WHEN c2 >= c3 THEN 2 ELSE 3 END AS dominant_topic FROM dist)"""


def analysis_sql(category: str = "lang") -> str:
    """CTEs up to ``analysis`` and the contingency table ``cont``."""
    return f"""{tokens_sql(category)},
{dist_sql()},
analysis AS MATERIALIZED (SELECT p.*, d.dominant_topic FROM papers p JOIN dom d USING (id)),
{cont_sql()}"""


def cont_sql() -> str:
    return """cont AS (SELECT primary_category, dominant_topic, count(*) AS n FROM analysis GROUP BY ALL)"""


def predicted_sql(k: int = K) -> str:
    """CTEs ``predicted`` per topic and label ``pairs``."""
    return f"""best AS (SELECT dominant_topic, primary_category FROM cont WHERE primary_category IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dominant_topic ORDER BY n DESC, primary_category) = 1),
predicted AS (SELECT CAST(r.t AS INTEGER) AS dominant_topic, coalesce(b.primary_category, 'Unknown') AS predicted_category
  FROM range({k}) r(t) LEFT JOIN best b ON b.dominant_topic = r.t),
pairs AS (SELECT c.primary_category AS true_category, p.predicted_category, CAST(sum(c.n) AS BIGINT) AS n
  FROM cont c JOIN predicted p USING (dominant_topic) WHERE c.primary_category IS NOT NULL GROUP BY ALL)"""


def scores_sql(pairs: str = "pairs", out: str = "scores") -> str:
    """CTE with precision, recall, F1 and support of every label seen."""
    return f"""{out} AS (SELECT category,
  CASE WHEN sum(p) = 0 THEN 0.0 ELSE sum(tp) / CAST(sum(p) AS DOUBLE) END AS precision,
  CASE WHEN sum(t) = 0 THEN 0.0 ELSE sum(tp) / CAST(sum(t) AS DOUBLE) END AS recall,
  CASE WHEN sum(t) + sum(p) = 0 THEN 0.0 ELSE 2 * sum(tp) / CAST(sum(t) + sum(p) AS DOUBLE) END AS f1,
  CAST(sum(t) AS BIGINT) AS support
  FROM (SELECT true_category AS category, n AS t, 0 AS p, CASE WHEN true_category = predicted_category THEN n ELSE 0 END AS tp FROM {pairs}
        UNION ALL SELECT predicted_category, 0, n, 0 FROM {pairs}) GROUP BY category)"""


def with_sql(*parts: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + select


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
