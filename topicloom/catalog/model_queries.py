"""Topic models (M) and topic quality (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.catalog.base import (
    Fitted, cluster_topics, embedding_coords, features_sql, papers, processed,
    projected_coords, projected_sql, query, rounded, source_words, table, tokens_sql,
    union_all, with_sql, written_tokens,
)
from topicloom.catalog.report_queries import source_words_sql
from topicloom.config import TopicConfig
from topicloom.functions import arrays
from topicloom.operators import clusters as cl, coherence as ch, features as fe, lda, nmf, online_lda as ol, topics as tp
from topicloom.plans import runs
from topicloom.runtime import cut_lineage, shared_path


def _counted(tables: dict, names: tuple[str, ...]):
    """Name and row count of each table."""
    return union_all([
        tables[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in names
    ])


# -- LDA ----------------------------------------------------------------------------


@query("m01_lda_fit")
def lda_fit(spark, sf):
    """Topic words of one model with the default number of passes."""
    with Fitted(spark, sf) as f:
        return lda.topic_words(lda.fit_lda(f.vectors, 5), f.lexicon)


@query("m02_lda_quality")
def lda_quality(spark, sf):
    with Fitted(spark, sf) as f:
        return lda.fit_quality(lda.fit_lda(f.vectors, 5), f.vectors)


@query("m03_lda_sweep")
def lda_sweep(spark, sf):
    with Fitted(spark, sf) as f:
        return lda.sweep(f.vectors, f.docs, f.lexicon, TopicConfig().lda_topics)[0]


@query("m04_lda_fixed_k")
def lda_fixed_k(spark, sf):
    config = TopicConfig()
    with Fitted(spark, sf) as f:
        k = config.middle(config.lda_topics)
        return lda.topic_words(lda.fit_lda(f.vectors, k), f.lexicon)


@query("m05_lda_topic_words")
def lda_topic_words(spark, sf):
    with Fitted(spark, sf) as f:
        return lda.topic_words(lda.fit_lda(f.vectors, 3), f.lexicon, 10)


@query("m06_lda_document_topics")
def lda_document_topics(spark, sf):
    with Fitted(spark, sf) as f:
        return lda.document_topics(lda.fit_lda(f.vectors, 3), f.vectors)


@query("m02_lda_trace", "SELECT CAST(k AS INTEGER) AS k, CAST(20 AS BIGINT) AS updates, true AS falls FROM (VALUES (3), (5)) t(k)")
def lda_trace(spark, sf):
    """Two models fitted in the same passes: an update a pass, and a lower perplexity at the end."""
    with Fitted(spark, sf) as f:
        trace = ol.trace_table(spark, ol.fit_many(f.rows, len(f.lexicon), [3, 5]))
        first, last = F.min_by("log_perplexity", "update"), F.max_by("log_perplexity", "update")
        return trace.groupBy("k").agg(F.count(F.lit(1)).alias("updates"), (last < first).alias("falls"))


@query("m03_lda_shared_sweep", """SELECT CAST(k AS INTEGER) AS k, true AS in_range, CAST(1 AS BIGINT) AS chosen FROM (VALUES (3), (5), (7), (10)) t(k)""")
def lda_shared_sweep(spark, sf):
    """Coherence of every default topic count lies between -1 and 1, and one count is chosen."""
    with Fitted(spark, sf) as f:
        found = cut_lineage(ol.sweep(f.rows, f.docs, f.lexicon, TopicConfig().lda_topics)[0])
        chosen = found.agg(F.count_if("is_optimal").alias("n")).scalar()
        return found.select("k", F.col("score").between(-1, 1).alias("in_range"), chosen.alias("chosen"))


@query("m05_lda_word_order", """SELECT CAST(range AS INTEGER) AS topic_id, CAST(10 AS BIGINT) AS words, true AS falling, true AS known FROM range(3)""")
def lda_word_order(spark, sf):
    """Every topic has ten different words of the vocabulary, the likeliest first."""
    with Fitted(spark, sf) as f:
        words = ol.topic_words(spark, ol.fit_many(f.rows, len(f.lexicon), [3])[3], f.lexicon, 10)
        known = words.join(f.vocab.select(F.col("term").alias("word"), F.lit(True).alias("in_vocabulary")), "word", "left")
        weights = F.transform(F.sort_array(F.collect_list(F.struct("rank", "weight"))), lambda r: r["weight"])
        return known.groupBy("topic_id").agg(
            F.count_distinct("word").alias("words"),
            (weights == F.reverse(F.sort_array(F.collect_list("weight")))).alias("falling"),
            F.bool_and(F.coalesce("in_vocabulary", F.lit(False))).alias("known"),
        )


@query("m06_lda_share_totals", with_sql(tokens_sql(), select="SELECT count(DISTINCT id) AS documents, CAST(count(DISTINCT id) AS DOUBLE) AS total, true AS positive FROM tok"))
def lda_share_totals(spark, sf):
    """The topic shares of every document sum to 1."""
    with Fitted(spark, sf) as f:
        dist = cut_lineage(ol.document_topics(f.rows, ol.fit_many(f.rows, len(f.lexicon), [3])[3]))
        total = F.aggregate("topic_dist", F.lit(0.0), lambda a, x: a + x)
        return dist.agg(
            F.count_distinct("id").alias("documents"), F.round(F.sum(total), 6).alias("total"),
            F.bool_and(F.forall("topic_dist", lambda x: x > 0)).alias("positive"),
        )


def _table_rows_sql(**rows: int) -> str:
    """Name and row count of tables whose size the parameters give, and of one row a document."""
    parts = [f"SELECT '{name}' AS name, CAST({n} AS BIGINT) AS rows" for name, n in rows.items()]
    return with_sql(tokens_sql(), select=" UNION ALL ".join([*parts, "SELECT 'document_topics', count(DISTINCT id) FROM tok"]))


@query("m07_lda_tables", _table_rows_sql(topic_words=105, fit_quality=1, topic_shares=7, term_relevance=210, term_saliency=30, topic_distances=21))
def lda_tables(spark, sf):
    """Rows of every table of a whole run without a sweep."""
    features = runs.run_features(papers(spark, sf), shared_path(spark, "m07"))
    found = runs.run_lda(features, shared_path(spark, "lda"), find_optimal=False)
    return _counted(found, ("topic_words", "document_topics", "fit_quality", "topic_shares", "term_relevance", "term_saliency", "topic_distances"))


def _topic_terms(spark, sf):
    """Term shares of five fixed topics, and the share of each topic."""
    counts = cut_lineage(cl.class_counts(processed(spark, sf), cluster_topics(spark, sf)).where("topic >= 0"))
    totals = counts.groupBy("topic").agg(F.sum("tf").alias("words"))
    total = totals.agg(F.sum("words").alias("all")).scalar()
    terms = counts.join(totals, "topic").select(
        F.col("topic").alias("topic_id"), "term", (F.col("tf") / F.col("words")).alias("p")
    )
    return terms, totals.select(F.col("topic").alias("topic_id"), (F.col("words") / total).alias("share"))


CLUSTERS_SQL = """clusters AS (SELECT doc_id AS id, CASE WHEN doc_id % 11 = 0 THEN -1 ELSE CAST(n_chars % 5 AS INTEGER) END AS topic FROM documents),
cc AS MATERIALIZED (SELECT topic, term, count(*) AS tf FROM tok JOIN clusters USING (id) GROUP BY ALL)"""

_TERMS_SQL = """terms AS MATERIALIZED (SELECT topic AS topic_id, term, tf / CAST(sum(tf) OVER (PARTITION BY topic) AS DOUBLE) AS p FROM cc WHERE topic >= 0),
shares AS (SELECT topic AS topic_id, sum(tf) / (SELECT CAST(sum(tf) AS DOUBLE) FROM cc WHERE topic >= 0) AS share FROM cc WHERE topic >= 0 GROUP BY 1),
joint AS (SELECT topic_id, term, p, share, p * share AS j, sum(p * share) OVER (PARTITION BY term) AS pt FROM terms JOIN shares USING (topic_id))"""


@query("m08_topic_shares", with_sql(
    tokens_sql(), "lens AS (SELECT id, count(*) AS size, " + ", ".join(f"count(*) FILTER (WHERE length(term) % 4 = {j}) AS c{j}" for j in range(4)) + " FROM tok GROUP BY id)",
    select=" UNION ALL ".join(f"SELECT {j} AS topic_id, round(sum(c{j}) / CAST(sum(size) AS DOUBLE), 6) AS share FROM lens" for j in range(4))))
def topic_shares(spark, sf):
    from topicloom.catalog.base import fixed_topics

    lengths = processed(spark, sf).select("id", F.size("tokens").alias("n_tokens"))
    return rounded(lda.topic_shares(fixed_topics(spark, sf), lengths), "share")


@query("m08_term_relevance", with_sql(
    tokens_sql(), CLUSTERS_SQL, _TERMS_SQL, """rel AS (SELECT topic_id, term, CAST(0.6 AS DOUBLE) * ln(p) + (1 - CAST(0.6 AS DOUBLE)) * ln(p / pt) AS r FROM joint)""",
    select="""SELECT topic_id, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY round(r, 9) DESC, term) AS INTEGER) AS rank, term, round(r, 6) AS relevance
    FROM rel QUALIFY rank <= 30"""))
def term_relevance(spark, sf):
    return rounded(lda.term_relevance(*_topic_terms(spark, sf)), "relevance")


@query("m08_term_saliency", with_sql(
    tokens_sql(), CLUSTERS_SQL, _TERMS_SQL, "sal AS (SELECT term, max(pt) * sum(j / pt * ln(j / pt / share)) AS s FROM joint GROUP BY term)",
    select="SELECT term, round(s, 9) AS saliency FROM sal ORDER BY round(s, 12) DESC, term LIMIT 30"))
def term_saliency(spark, sf):
    found = lda.term_saliency(*_topic_terms(spark, sf))
    return found.withColumn("saliency", F.round("saliency", 9))


@query("m08_topic_distances", with_sql(
    tokens_sql(), CLUSTERS_SQL, _TERMS_SQL, "g AS (SELECT DISTINCT topic_id FROM terms), v AS (SELECT DISTINCT term FROM terms)",
    """full_t AS (SELECT g.topic_id, v.term, coalesce(t.p, 0.0) AS p FROM g CROSS JOIN v LEFT JOIN terms t ON t.topic_id = g.topic_id AND t.term = v.term)""",
    select="""SELECT a.topic_id AS topic_a, b.topic_id AS topic_b, round((
      sum(CASE WHEN a.p > 0 THEN a.p * ln(a.p / ((a.p + b.p) / 2)) ELSE 0 END) + sum(CASE WHEN b.p > 0 THEN b.p * ln(b.p / ((a.p + b.p) / 2)) ELSE 0 END)) / 2, 6) AS distance
    FROM full_t a JOIN full_t b USING (term) WHERE a.topic_id < b.topic_id GROUP BY ALL"""))
def topic_distances(spark, sf):
    return rounded(lda.topic_distances(_topic_terms(spark, sf)[0]), "distance")


# -- NMF ----------------------------------------------------------------------------

TOPICS = 3


def _nmf_start(spark, sf):
    """TF-IDF rows and fixed start factors."""
    return _nmf_tables(spark, sf)[1:]


def _nmf_tables(spark, sf):
    """Vocabulary, TF-IDF rows and fixed start factors."""
    vocab, rows = fe.tfidf_features(written_tokens(spark, sf))
    x = cut_lineage(rows)
    topics = F.explode(F.array(*[F.lit(i) for i in range(TOPICS)])).alias("topic_id")
    w = x.select("id").distinct().select("id", topics)
    h = vocab.select("term_id", topics)
    w = w.withColumn("value", (1 + F.pmod(F.col("id") * (F.col("topic_id") + 1), F.lit(7))).cast("double"))
    h = h.withColumn("value", (1 + F.pmod(F.col("term_id") * (F.col("topic_id") + 2), F.lit(5))).cast("double"))
    return vocab, x, w, cut_lineage(h)


def _nmf_sql(l1: float = 0.0, l2: float = 0.0) -> str:
    tiny = "CAST(1e-10 AS DOUBLE)"
    penalty = f"{l1} + {l2} * f.value + {tiny}"
    return f"""ks AS (SELECT CAST(range AS INTEGER) AS k FROM range({TOPICS})),
w0 AS (SELECT id, k, CAST(1 + (id * (k + 1)) % 7 AS DOUBLE) AS value FROM (SELECT DISTINCT id FROM tfidf), ks),
h0 AS (SELECT term_id, k, CAST(1 + (term_id * (k + 2)) % 5 AS DOUBLE) AS value FROM vocab, ks),
hh AS (SELECT a.k AS i, b.k AS j, sum(a.value * b.value) AS g FROM h0 a JOIN h0 b USING (term_id) GROUP BY ALL),
xh AS (SELECT id, k, sum(weight * value) AS top FROM tfidf JOIN h0 USING (term_id) GROUP BY ALL),
whh AS (SELECT id, j AS k, sum(value * g) AS bottom FROM w0 JOIN hh ON i = w0.k GROUP BY ALL),
w1 AS MATERIALIZED (SELECT f.id, f.k, f.value * coalesce(top, 0) / (bottom + {penalty}) AS value
  FROM w0 f LEFT JOIN xh USING (id, k) JOIN whh USING (id, k)),
ww AS (SELECT a.k AS i, b.k AS j, sum(a.value * b.value) AS g FROM w1 a JOIN w1 b USING (id) GROUP BY ALL),
wx AS (SELECT term_id, k, sum(weight * value) AS top FROM tfidf JOIN w1 USING (id) GROUP BY ALL),
wwh AS (SELECT term_id, j AS k, sum(value * g) AS bottom FROM h0 JOIN ww ON i = h0.k GROUP BY ALL),
h1 AS MATERIALIZED (SELECT f.term_id, f.k, f.value * coalesce(top, 0) / (bottom + {penalty}) AS value
  FROM h0 f LEFT JOIN wx USING (term_id, k) JOIN wwh USING (term_id, k))"""


@query("m09_nmf_update_documents", with_sql(features_sql(), _nmf_sql(), select="SELECT id, k AS topic_id, round(value, 6) AS value FROM w1"))
def nmf_update_documents(spark, sf):
    return rounded(nmf.update_step(*_nmf_start(spark, sf))[0], "value")


@query("m09_nmf_update_terms", with_sql(features_sql(), _nmf_sql(), select="SELECT term_id, k AS topic_id, round(value, 6) AS value FROM h1"))
def nmf_update_terms(spark, sf):
    return rounded(nmf.update_step(*_nmf_start(spark, sf))[1], "value")


@query("m09_nmf_update_penalised", with_sql(features_sql(), _nmf_sql(0.05, 0.02), select="SELECT term_id, k AS topic_id, round(value, 6) AS value FROM h1"))
def nmf_update_penalised(spark, sf):
    step = nmf.update_step(*_nmf_start(spark, sf), l1_w=0.05, l2_w=0.02, l1_h=0.05, l2_h=0.02)
    return rounded(step[1], "value")


@query("m09_nmf_fit")
def nmf_fit(spark, sf):
    """Topic words of a fit with the default settings."""
    with Fitted(spark, sf) as f:
        return nmf.topic_words(spark, nmf.fit_nmf(f.rows, len(f.lexicon), 5), f.lexicon)


@query("m10_nmf_collapse_guard", "SELECT true AS collapsed, true AS refitted")
def nmf_collapse_guard(spark, sf):
    """A penalty that empties H leads to a second fit without penalties."""
    with Fitted(spark, sf) as f:
        strong = dict(alpha=0.1, scale_penalty=True)
        first = nmf.fit_many(f.rows, len(f.lexicon), [4], **strong)[4]
        final = nmf.fit_nmf(f.rows, len(f.lexicon), 4, **strong)
        row = (bool(first.h.max() <= nmf.TINY), bool(final.h.max() > 0.001))
        return spark.createDataFrame([row], "collapsed boolean, refitted boolean")


@query("m11_nmf_error", with_sql(
    features_sql(), _nmf_sql(), "ids AS (SELECT DISTINCT id FROM tfidf)",
    "wh AS (SELECT w1.id, h1.term_id, sum(w1.value * h1.value) AS v FROM w1 JOIN h1 USING (k) GROUP BY ALL)",
    select="""SELECT round(sum((coalesce(x.weight, 0) - wh.v) ** 2) / ((SELECT count(*) FROM ids) * (SELECT count(*) FROM vocab)), 9) AS error
    FROM wh LEFT JOIN tfidf x ON x.id = wh.id AND x.term_id = wh.term_id"""))
def nmf_error(spark, sf):
    x, w, h = _nmf_start(spark, sf)
    w1, h1 = (cut_lineage(t) for t in nmf.update_step(x, w, h))
    found = nmf.reconstruction_error(x, w1, h1, w1.select("id").distinct().count(), h1.select("term_id").distinct().count())
    return found.withColumn("error", F.round("error", 9))


@query("m11_nmf_sweep")
def nmf_sweep(spark, sf):
    """All topic counts of the default range, fitted in the same passes."""
    with Fitted(spark, sf) as f:
        return nmf.sweep(f.rows, len(f.lexicon), TopicConfig().nmf_topics)[0]


@query("m12_nmf_topic_words", with_sql(
    features_sql(), _nmf_sql(), select="""SELECT k AS topic_id, CAST(row_number() OVER (PARTITION BY k ORDER BY round(value, 9) DESC, term) AS INTEGER) AS rank,
    term AS word, round(value, 6) AS weight FROM h1 JOIN vocab USING (term_id) QUALIFY rank <= 15"""))
def nmf_topic_words(spark, sf):
    vocab, *start = _nmf_tables(spark, sf)
    h = nmf.update_step(*start)[1]
    named = h.join(vocab.select("term_id", F.col("term").alias("word")), "term_id")
    return rounded(tp.rank_words(named.select("topic_id", "word", F.round("value", 9).alias("weight")), 15), "weight")


@query("m13_nmf_document_topics", with_sql(
    features_sql(), _nmf_sql(), "s AS (SELECT id, sum(value) AS t FROM w1 GROUP BY id)",
    select="SELECT id, k AS topic_id, round(value / CASE WHEN t = 0 THEN 1 ELSE t END, 6) AS share FROM w1 JOIN s USING (id)"))
def nmf_document_topics(spark, sf):
    w = nmf.update_step(*_nmf_start(spark, sf))[0]
    rows = w.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("topic_id", "value"))).alias("r"))
    dist = tp.normalise_topics(rows.select("id", F.transform("r", lambda x: x["value"]).alias("topic_dist")))
    return rounded(dist.select("id", F.posexplode("topic_dist").alias("topic_id", "share")), "share")


@query("m13_nmf_fitted_topics")
def nmf_fitted_topics(spark, sf):
    with Fitted(spark, sf) as f:
        return nmf.document_topics(f.rows, nmf.fit_nmf(f.rows, len(f.lexicon), 5))


@query("m14_nmf_tables", _table_rows_sql(topic_words=180))
def nmf_tables(spark, sf):
    features = runs.run_features(papers(spark, sf), shared_path(spark, "m14"))
    found = runs.run_nmf(features, shared_path(spark, "nmf"), find_optimal=False)
    return _counted(found, ("topic_words", "document_topics"))


# -- embedding clusters -------------------------------------------------------------

DIMS = 16


@query("m15_hash_embedding", with_sql(
    features_sql(), f"""slots AS (SELECT term_id, CAST('0x' || md5(term)[1:7] AS BIGINT) % {DIMS} AS slot,
      CASE WHEN CAST('0x' || md5(term)[8:8] AS BIGINT) % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign FROM vocab)""",
    "sums AS (SELECT id, slot, sum(weight * sign) AS value FROM tfidf JOIN slots USING (term_id) GROUP BY ALL)",
    f"grid AS (SELECT id, CAST(range AS INTEGER) AS slot FROM (SELECT DISTINCT id FROM tok), range({DIMS}))",
    select="SELECT g.id, g.slot, round(coalesce(CAST(value AS DOUBLE), 0.0), 6) + 0.0 AS value FROM grid g LEFT JOIN sums s ON s.id = g.id AND s.slot = g.slot"))
def hash_embedding(spark, sf):
    docs = written_tokens(spark, sf)
    lexicon = fe.Lexicon.of(fe.vocabulary(docs))
    vectors = cl.embed(fe.tfidf_vectors(docs, lexicon), lexicon=lexicon, dims=DIMS)
    found = vectors.select("id", F.posexplode("embedding").alias("slot", "value"))
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query("m15_word_embedding")
def word_embedding(spark, sf):
    docs = written_tokens(spark, sf)
    return cl.embed(docs, fe.Lexicon.of(fe.vocabulary(docs)), dims=DIMS, trained=True)


@query("m15_given_embedding", "SELECT vec_id AS id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
def given_embedding(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return cl.embed(vectors, embedding_column="embedding").select("id", F.round(total, 4).alias("total"))


@query("m16_reduce_dimensions")
def reduce_dimensions(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    return cl.reduce_dimensions(cl.embed(vectors, embedding_column="embedding"), 5)


@query("m16_component_variances", "SELECT CAST(range AS INTEGER) AS component, true AS ordered, true AS centred FROM range(5)")
def component_variances(spark, sf):
    """Each component varies no more than the one before, and they don't go together."""
    found = cut_lineage(reduce_dimensions(spark, sf))
    x = [F.get("coords", F.lit(i)) for i in range(5)]
    stats = found.agg(F.array(*[F.var_pop(c) for c in x]).alias("v"), F.array(*[F.covar_pop(x[i], x[(i + 1) % 5]) for i in range(5)]).alias("c"))
    component = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("component")
    before = F.get("v", F.greatest(F.col("component") - 1, F.lit(0)))
    return stats.select("v", "c", component).select(
        "component", (F.get("v", "component") <= before + 1e-12).alias("ordered"), (F.abs(F.get("c", "component")) < 1e-9).alias("centred")
    )


#: Grid of the density query: wide cells, since the vectors have no structure.
WIDTH = 0.2
MIN_POINTS = 12
MIN_SIZE = 10


def _density_sql(dims: int = 3) -> str:
    cell = ", ".join(f"CAST(floor(({projected_sql(i, dims)}) / CAST({WIDTH} AS DOUBLE)) AS BIGINT) AS x{i}" for i in range(dims))
    xs = ", ".join(f"x{i}" for i in range(dims))
    near = " AND ".join(f"abs(a.x{i} - b.x{i}) <= 1" for i in range(dims))
    key = " || ':' || ".join(f"x{i}" for i in range(dims))
    return f"""WITH RECURSIVE pts AS (SELECT vec_id AS id, {cell} FROM embeddings),
cells AS MATERIALIZED (SELECT {key} AS c, {xs}, count(*) AS n FROM pts GROUP BY ALL),
near AS MATERIALIZED (SELECT a.c AS c, b.c AS o, b.n FROM cells a JOIN cells b ON {near}),
dense AS MATERIALIZED (SELECT c FROM near GROUP BY c HAVING sum(n) >= {MIN_POINTS}),
edges AS MATERIALIZED (SELECT c, o FROM near WHERE c IN (SELECT c FROM dense) AND o IN (SELECT c FROM dense)),
reach(c, o) AS (SELECT c, c FROM dense UNION SELECT r.c, e.o FROM reach r JOIN edges e ON e.c = r.o),
core AS (SELECT c, min(o) AS label FROM reach GROUP BY c),
border AS (SELECT n.c, min(k.label) AS label FROM near n JOIN core k ON k.c = n.o WHERE n.c NOT IN (SELECT c FROM dense) GROUP BY n.c),
lab AS (SELECT * FROM core UNION ALL SELECT * FROM border),
sizes AS (SELECT label, sum(n) AS size FROM lab JOIN cells USING (c) GROUP BY label HAVING sum(n) >= {MIN_SIZE}),
num AS (SELECT label, CAST(row_number() OVER (ORDER BY size DESC, label) - 1 AS INTEGER) AS topic FROM sizes),
assigned AS (SELECT p.id, coalesce(num.topic, -1) AS topic FROM pts p LEFT JOIN lab ON lab.c = {key} LEFT JOIN num USING (label))
"""


def _density(spark, sf):
    return cl.density_topics(projected_coords(spark, sf), MIN_POINTS, MIN_SIZE, widths=[WIDTH] * 3)


@query("m17_density_topics", _density_sql() + "SELECT id, topic FROM assigned")
def density_topics(spark, sf):
    return _density(spark, sf)


@query("m17_density_reduced")
def density_reduced(spark, sf):
    """Density topics of reduced vectors with cell widths taken from the data."""
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    coords = cut_lineage(cl.reduce_dimensions(cl.embed(vectors, embedding_column="embedding"), 3))
    return cl.density_topics(coords, dims=3)


@query("m17_fixed_topics")
def fixed_k_topics(spark, sf):
    return cl.fixed_topics(embedding_coords(spark, sf), 5)


def _merge_sql(k: int, start: int = 5) -> str:
    """Merge rounds written out, one set of CTEs each."""
    parts = [tokens_sql(), CLUSTERS_SQL, "c0 AS (SELECT * FROM cc)",
             "z0 AS (SELECT topic, count(*) AS size FROM clusters GROUP BY topic)", "p0 AS (SELECT topic, topic AS merged FROM z0)"]
    for i in range(start - k):
        parts.append(f"""tot{i} AS (SELECT topic, sum(tf) AS words FROM c{i} GROUP BY topic),
f{i} AS (SELECT term, sum(tf) AS f FROM c{i} GROUP BY term),
w{i} AS MATERIALIZED (SELECT c.topic, c.term, c.tf / CAST(words AS DOUBLE) * ln(1 + (SELECT floor(avg(words)) FROM tot{i}) / CAST(f AS DOUBLE)) AS weight
  FROM c{i} c JOIN tot{i} USING (topic) JOIN f{i} USING (term) WHERE c.topic <> -1),
small{i} AS (SELECT topic FROM z{i} WHERE topic <> -1 ORDER BY size, topic DESC LIMIT 1),
dot{i} AS (SELECT a.topic, sum(a.weight * b.weight) AS d FROM w{i} a JOIN w{i} b USING (term) WHERE b.topic = (SELECT topic FROM small{i}) AND a.topic <> b.topic GROUP BY a.topic),
norm{i} AS (SELECT topic, sqrt(sum(weight * weight)) AS nn FROM w{i} GROUP BY topic),
into{i} AS (SELECT topic FROM dot{i} JOIN norm{i} USING (topic) ORDER BY round(d / nn, 12) DESC, topic LIMIT 1),
c{i + 1} AS MATERIALIZED (SELECT CASE WHEN topic = (SELECT topic FROM small{i}) THEN (SELECT topic FROM into{i}) ELSE topic END AS topic, term, sum(tf) AS tf FROM c{i} GROUP BY ALL),
z{i + 1} AS (SELECT CASE WHEN topic = (SELECT topic FROM small{i}) THEN (SELECT topic FROM into{i}) ELSE topic END AS topic, sum(size) AS size FROM z{i} GROUP BY ALL),
p{i + 1} AS (SELECT topic, CASE WHEN merged = (SELECT topic FROM small{i}) THEN (SELECT topic FROM into{i}) ELSE merged END AS merged FROM p{i})""")
    return with_sql(*parts, select=f"SELECT topic, merged FROM p{start - k}")


@query("m18_merge_topics", _merge_sql(3))
def merge_topics(spark, sf):
    assigned = cluster_topics(spark, sf)
    return cl.merge_topics(cl.class_counts(processed(spark, sf), assigned), cl.topic_sizes(assigned), 3)


def _nearest_sql(k: int, start: int = 5) -> str:
    """Rounds of joining the closest pair written out, one set of CTEs each."""
    parts = [tokens_sql(), CLUSTERS_SQL, "c0 AS (SELECT * FROM cc)",
             "z0 AS (SELECT topic, count(*) AS size FROM clusters GROUP BY topic)", "p0 AS (SELECT topic, topic AS merged FROM z0)"]
    for i in range(start - k):
        parts.append(f"""tot{i} AS (SELECT topic, sum(tf) AS words FROM c{i} GROUP BY topic),
f{i} AS (SELECT term, sum(tf) AS f FROM c{i} GROUP BY term),
w{i} AS MATERIALIZED (SELECT c.topic, c.term, c.tf / CAST(words AS DOUBLE) * ln(1 + (SELECT floor(avg(words)) FROM tot{i}) / CAST(f AS DOUBLE)) AS weight
  FROM c{i} c JOIN tot{i} USING (topic) JOIN f{i} USING (term) WHERE c.topic <> -1),
norm{i} AS (SELECT topic, sqrt(sum(weight * weight)) AS nn FROM w{i} GROUP BY topic),
pair{i} AS (SELECT a.topic AS x, b.topic AS y, sum(a.weight * b.weight) AS d FROM w{i} a JOIN w{i} b USING (term) WHERE a.topic < b.topic GROUP BY ALL),
best{i} AS (SELECT x, y FROM pair{i} JOIN norm{i} n ON n.topic = x JOIN norm{i} m ON m.topic = y ORDER BY round(d / (n.nn * m.nn), 12) DESC, x, y LIMIT 1),
move{i} AS MATERIALIZED (SELECT CASE WHEN s.size >= t.size THEN y ELSE x END AS gone, CASE WHEN s.size >= t.size THEN x ELSE y END AS into_
  FROM best{i} JOIN z{i} s ON s.topic = x JOIN z{i} t ON t.topic = y),
c{i + 1} AS MATERIALIZED (SELECT coalesce(into_, topic) AS topic, term, sum(tf) AS tf FROM c{i} LEFT JOIN move{i} ON gone = topic GROUP BY ALL),
z{i + 1} AS (SELECT coalesce(into_, topic) AS topic, sum(size) AS size FROM z{i} LEFT JOIN move{i} ON gone = topic GROUP BY ALL),
p{i + 1} AS (SELECT topic, coalesce(into_, merged) AS merged FROM p{i} LEFT JOIN move{i} ON gone = merged)""")
    return with_sql(*parts, select=f"SELECT topic, merged FROM p{start - k}")


@query("m18_merge_nearest", _nearest_sql(2))
def merge_nearest(spark, sf):
    assigned = cluster_topics(spark, sf)
    return cl.merge_nearest(cl.class_counts(processed(spark, sf), assigned), cl.topic_sizes(assigned), 2)


@query("m18_reduce_topics")
def reduce_topics(spark, sf):
    return cl.reduce_topics(processed(spark, sf), cluster_topics(spark, sf), 3)


_CTFIDF = """tot AS (SELECT topic, sum(tf) AS words FROM cc GROUP BY topic),
fr AS (SELECT term, sum(tf) AS f FROM cc GROUP BY term),
cw AS (SELECT topic, term, tf / CAST(words AS DOUBLE) * ln(1 + (SELECT floor(avg(words)) FROM tot) / CAST(f AS DOUBLE)) AS weight
  FROM cc JOIN tot USING (topic) JOIN fr USING (term))"""


@query("m19_class_tfidf", with_sql(tokens_sql(), CLUSTERS_SQL, _CTFIDF, select="SELECT topic, term, round(weight, 9) AS weight FROM cw"))
def class_tfidf(spark, sf):
    counts = cut_lineage(cl.class_counts(processed(spark, sf), cluster_topics(spark, sf)))
    return cl.class_tfidf(counts).withColumn("weight", F.round("weight", 9))


@query("m19_topic_words", with_sql(
    tokens_sql(), CLUSTERS_SQL, _CTFIDF, select="""SELECT topic AS topic_id, CAST(row_number() OVER (PARTITION BY topic ORDER BY round(weight, 12) DESC, term) AS INTEGER) AS rank,
    term AS word, round(weight, 6) AS weight FROM cw WHERE topic <> -1 QUALIFY rank <= 15"""))
def cluster_topic_words(spark, sf):
    counts = cut_lineage(cl.class_counts(processed(spark, sf), cluster_topics(spark, sf)))
    weights = cl.class_tfidf(counts).withColumn("weight", F.round("weight", 12))
    return rounded(cl.topic_words(weights), "weight")


@query("m20_one_hot", """SELECT doc_id AS id, CAST(k AS INTEGER) AS topic_id,
CASE WHEN doc_id % 11 <> 0 AND n_chars % 5 = k THEN 1.0 ELSE 0.0 END::DOUBLE AS weight FROM documents, range(5) r(k)""")
def one_hot(spark, sf):
    rows = cluster_topics(spark, sf).select("id", arrays.one_hot("topic", 5).alias("d"))
    return rows.select("id", F.posexplode("d").alias("topic_id", "weight"))


_SOFT = """pts AS (SELECT vec_id AS id, CAST(label % 4 AS INTEGER) AS topic, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
cen AS (SELECT topic, i, avg(v) AS m FROM pts GROUP BY ALL),
close AS (SELECT id, cen.topic AS topic_id, 1 / (1 + sqrt(sum((v - m) ** 2))) AS s FROM pts JOIN cen USING (i) GROUP BY id, cen.topic)"""


@query("m20_soft_topics", with_sql(_SOFT, select="SELECT id, topic_id, round(s / sum(s) OVER (PARTITION BY id), 6) AS weight FROM close"))
def soft_topics(spark, sf):
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 4).cast("int").alias("topic"))
    found = cl.document_topics(embedding_coords(spark, sf), labels, 64)
    return rounded(found.select("id", F.posexplode("topic_dist").alias("topic_id", "weight")), "weight")


@query("m20_nearest_topics", with_sql(_SOFT, "shared AS (SELECT id, topic_id, s / sum(s) OVER (PARTITION BY id) AS w FROM close)",
    select="""SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY round(w, 12) DESC, topic_id) AS INTEGER) AS rank, topic_id, round(w, 6) AS weight
    FROM shared QUALIFY rank <= 2"""))
def nearest_topics(spark, sf):
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 4).cast("int").alias("topic"))
    coords = embedding_coords(spark, sf)
    found = cl.nearest_topics(coords, cl.centre_matrix(cl.centroids(coords, labels, 64)), 2)
    listed = found.select("id", F.posexplode("topics").alias("rank", "t"))
    return rounded(listed.select("id", (F.col("rank") + 1).alias("rank"), F.col("t.topic").alias("topic_id"), F.col("t.weight").alias("weight")), "weight")


@query("m21_detected_topics", with_sql(
    "c AS (SELECT CASE WHEN doc_id % 11 = 0 THEN -1 ELSE n_chars % 5 END AS topic FROM documents)",
    select="SELECT count(DISTINCT topic) FILTER (WHERE topic <> -1) AS k_detected FROM c"))
def detected_topics(spark, sf):
    return cl.detected_topics(cluster_topics(spark, sf))


@query("m22_detected_density", _density_sql() + "SELECT count(DISTINCT topic) FILTER (WHERE topic <> -1) AS k_detected FROM assigned")
def detected_density(spark, sf):
    return cl.detected_topics(_density(spark, sf))


@query("m23_cluster_tables")
def cluster_tables(spark, sf):
    features = runs.run_features(papers(spark, sf), shared_path(spark, "m23"))
    found = runs.run_clusters(features, shared_path(spark, "clusters"))
    return _counted(found, ("topic_words", "document_topics", "assigned_topic", "detected"))


@query("m24_run_methods", with_sql(tokens_sql(), select="""SELECT method, '' AS error, (SELECT count(DISTINCT id) FROM tok) AS documents
FROM (VALUES ('lda'), ('nmf'), ('clusters')) m(method) UNION ALL SELECT 'unknown', 'KeyError', 0"""))
def run_methods(spark, sf):
    """Methods run on their own; an unknown one leaves its error behind. Every other one has
    topics of all documents."""
    features = runs.run_features(papers(spark, sf), shared_path(spark, "m24"))
    found = runs.run_methods(features, shared_path(spark, "models"), methods=("lda", "nmf", "clusters", "unknown"), find_optimal=False)
    rows = [
        (m, type(t).__name__, 0) if isinstance(t, Exception) else (m, "", t["document_topics"].count()) for m, t in found.items()
    ]
    return spark.createDataFrame(rows, "method string, error string, documents long")


# -- H ------------------------------------------------------------------------------


def _window_sql(window: int) -> str:
    """Every window of every document written out, then counted."""
    return f"""seq AS (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS p, count(*) OVER (PARTITION BY id) AS len FROM tok),
total AS (SELECT CAST(sum(greatest(1, len - {window} + 1)) AS DOUBLE) AS t FROM (SELECT DISTINCT id, len FROM seq)),
hit AS (SELECT id, term, unnest(range(greatest(0, p - {window} + 1), least(p, greatest(0, len - {window})) + 1)) AS s FROM seq WHERE term IN (SELECT word FROM sw)),
win AS MATERIALIZED (SELECT DISTINCT id, term, s FROM hit),
pairs_w AS MATERIALIZED (SELECT a.term AS wa, b.term AS wb, count(*) AS n FROM win a JOIN win b USING (id, s) GROUP BY ALL),
cells AS (SELECT x.topic_id, x.rank AS i, y.rank AS j, coalesce(pi.n, 0) / t AS p_i, coalesce(pj.n, 0) / t AS p_j, coalesce(pij.n, 0) / t AS p_ij
  FROM sw x JOIN sw y USING (topic_id) CROSS JOIN total
  LEFT JOIN pairs_w pi ON pi.wa = x.word AND pi.wb = x.word LEFT JOIN pairs_w pj ON pj.wa = y.word AND pj.wb = y.word
  LEFT JOIN pairs_w pij ON pij.wa = x.word AND pij.wb = y.word),
scored AS (SELECT *, ln((p_ij + 1e-12) / (p_i * p_j)) AS pmi,
  CASE WHEN abs(ln(p_ij + 1e-12)) < 1e-12 THEN 1.0 ELSE ln((p_ij + 1e-12) / (p_i * p_j)) / -ln(p_ij + 1e-12) END AS npmi FROM cells)"""


@query("h01_coherence_c_v", with_sql(
    tokens_sql("source"), source_words_sql(), _window_sql(110),
    "tv AS (SELECT topic_id, j, sum(npmi) AS v FROM scored GROUP BY ALL)",
    """cos AS (SELECT s.topic_id, s.i, sum(s.npmi * tv.v) / (sqrt(sum(s.npmi * s.npmi)) * sqrt(sum(tv.v * tv.v))) AS c
      FROM scored s JOIN tv ON tv.topic_id = s.topic_id AND tv.j = s.j GROUP BY ALL)""",
    select="SELECT topic_id, round(avg(c), 6) AS coherence FROM cos GROUP BY 1"))
def coherence_c_v(spark, sf):
    return _coherence(spark, sf, "c_v")


def _coherence(spark, sf, measure):
    docs = written_tokens(spark, sf, "primary_category", category="source")
    words = cut_lineage(source_words(spark, sf, docs=docs))
    return rounded(ch.topic_coherence(docs, words, measure), "coherence")


@query("h02_coherence_u_mass", with_sql(
    tokens_sql("source"), source_words_sql(), "present AS MATERIALIZED (SELECT DISTINCT id, term FROM tok WHERE term IN (SELECT word FROM sw))",
    "total AS (SELECT CAST(count(DISTINCT id) AS DOUBLE) AS t FROM tok)",
    "pd AS MATERIALIZED (SELECT a.term AS wa, b.term AS wb, count(*) AS n FROM present a JOIN present b USING (id) GROUP BY ALL)",
    select="""SELECT x.topic_id, round(avg(ln((coalesce(pij.n, 0) / t + 1e-12) / (pj.n / t))), 6) AS coherence
    FROM sw x JOIN sw y ON x.topic_id = y.topic_id AND x.rank > y.rank CROSS JOIN total
    LEFT JOIN pd pij ON pij.wa = x.word AND pij.wb = y.word JOIN pd pj ON pj.wa = y.word AND pj.wb = y.word GROUP BY 1"""))
def coherence_u_mass(spark, sf):
    return _coherence(spark, sf, "u_mass")


@query("h03_coherence_c_uci", with_sql(
    tokens_sql("source"), source_words_sql(), _window_sql(10), select="SELECT topic_id, round(avg(pmi), 6) AS coherence FROM scored WHERE i < j GROUP BY 1"))
def coherence_c_uci(spark, sf):
    return _coherence(spark, sf, "c_uci")


@query("h04_coherence_c_npmi", with_sql(
    tokens_sql("source"), source_words_sql(), _window_sql(10), select="SELECT topic_id, round(avg(npmi), 6) AS coherence FROM scored WHERE i < j GROUP BY 1"))
def coherence_c_npmi(spark, sf):
    return _coherence(spark, sf, "c_npmi")


@query("h05_topic_diversity", with_sql(
    tokens_sql("source"), source_words_sql(), select="SELECT round(count(DISTINCT word) / CAST(count(DISTINCT topic_id) * 10 AS DOUBLE), 6) AS diversity FROM sw WHERE rank <= 10"))
def topic_diversity(spark, sf):
    return rounded(tp.topic_diversity(source_words(spark, sf)), "diversity")
