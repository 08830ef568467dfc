"""Whole runs: features, one run per topic model, comparison and report.

Every function takes the folder for its tables. Tables that are read more than once are
written there as parquet and read back, so a lost executor never repeats a stage, and a
second run picks up what is already complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.config import TopicConfig
from topicloom.operators import alignment, clusters, comparison, lda, metrics, nmf, report, topics
from topicloom.operators.corpus import assemble_corpus, flatten_lists, from_raw
from topicloom.operators.features import Lexicon, add_ngrams, build_features, feature_vectors, sparse_rows
from topicloom.operators.normalise import preprocess_abstracts
from topicloom.sources import models, tables

METHODS = ("lda", "nmf", "clusters")


def run_features(
    papers: DataFrame,
    base: str,
    config: TopicConfig = TopicConfig(),
    text_column: str = "abstract",
    lemma_table: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Processed documents, both vocabularies and the feature rows.

    A table is built again when the papers, the lemma table or a setting it depends on have
    changed; otherwise no job but the look at its manifest runs.
    """
    spark = papers.sparkSession
    lemmas = "" if lemma_table is None else tables.input_fingerprint(lemma_table)
    lengths = (config.min_word_length, config.max_word_length)
    made_from = tables.fingerprint("processed", tables.input_fingerprint(papers), text_column, lengths, lemmas)
    docs = tables.stage(
        spark, f"{base}/processed", lambda: preprocess_abstracts(papers, text_column, config, lemma_table), made_from
    )
    built: dict[str, DataFrame] = {}

    def feature(name: str) -> DataFrame:
        if not built:
            built.update(build_features(docs, config))
        return built[name]

    limits = (config.weighting, config.ngram_range, config.min_df, config.max_df, config.max_features, config.bow_max_terms)
    out = {"processed": docs}
    for name in ("vocabulary_bow", "bow", "vocabulary", "features"):
        out[name] = tables.stage(
            spark, f"{base}/{name}", lambda name=name: feature(name), tables.fingerprint(name, made_from, limits)
        )
    return out


def _grams(docs: DataFrame, config: TopicConfig) -> DataFrame:
    """Documents with the tokens that the vocabulary was made of."""
    return add_ngrams(docs, *config.ngram_range) if config.weighting == "tfidf" else docs


def _vectors(grams: DataFrame, lexicon: Lexicon, config: TopicConfig) -> DataFrame:
    vectors = feature_vectors(grams, lexicon, config.weighting)
    return vectors.select("id", "features").persist(StorageLevel.MEMORY_AND_DISK)


def _finish(
    base: str, words: DataFrame, doc_topics: DataFrame, k: int, sweep: DataFrame | None
) -> dict[str, DataFrame]:
    """Write topic words, document topics and the sweep in the shapes every method shares."""
    words = tables.save_table(words, f"{base}/topic_words")
    doc_topics = tables.save_table(doc_topics, f"{base}/document_topics")
    out = {"topic_words": words, "document_topics": doc_topics}
    if sweep is not None:
        out["sweep"] = tables.save_table(sweep, f"{base}/sweep")
    tables.write_topic_words_json(words, f"{base}/topic_words_json")
    tables.write_csv(tables.wide_document_topics(doc_topics, k), f"{base}/document_topics_csv")
    tables.write_csv(tables.long_topic_words(words), f"{base}/topic_words_csv")
    return out


def run_lda(
    features: dict[str, DataFrame], base: str, config: TopicConfig = TopicConfig(), find_optimal: bool = True, **fit_options
) -> dict[str, DataFrame]:
    docs, lexicon = features["processed"], Lexicon.of(features["vocabulary"])
    grams = _grams(docs, config)
    vectors = _vectors(grams, lexicon, config)
    try:
        if find_optimal:
            sweep, model = lda.sweep(vectors, grams, lexicon, config.lda_topics, config, **fit_options)
        else:
            sweep, model = None, lda.fit_lda(vectors, config.middle(config.lda_topics), config, **fit_options)
        models.save_lda(model, features["vocabulary"], f"{base}/model")
        k = model.getK()
        words = lda.topic_words(model, lexicon, config.words_per_topic)
        out = _finish(base, words, lda.document_topics(model, vectors), k, sweep)
        out["fit_quality"] = tables.save_table(lda.fit_quality(model, vectors), f"{base}/fit_quality")
        terms = tables.save_table(lda.topic_term_table(model, lexicon), f"{base}/topic_terms")
        shares = lda.topic_shares(out["document_topics"], docs.select("id", F.size("tokens").alias("n_tokens")))
        shares = tables.save_table(shares, f"{base}/topic_shares")
        explorer = {
            "topic_terms": terms,
            "topic_shares": shares,
            "term_relevance": lda.term_relevance(terms, shares),
            "term_saliency": lda.term_saliency(terms, shares),
            "topic_distances": lda.topic_distances(terms),
        }
        return {**out, **explorer}
    finally:
        vectors.unpersist()


def run_nmf(
    features: dict[str, DataFrame], base: str, config: TopicConfig = TopicConfig(), find_optimal: bool = True
) -> dict[str, DataFrame]:
    docs, lexicon = features["processed"], Lexicon.of(features["vocabulary"])
    spark = docs.sparkSession
    rows = sparse_rows(feature_vectors(_grams(docs, config), lexicon, config.weighting)).persist(StorageLevel.MEMORY_AND_DISK)
    options = dict(
        alpha=config.nmf_alpha, l1_ratio=config.nmf_l1_ratio, max_iter=config.nmf_max_iter, seed=config.seed
    )
    try:
        if find_optimal:
            sweep, model = nmf.sweep(rows, len(lexicon), config.nmf_topics, **options)
        else:
            sweep, model = None, nmf.fit_nmf(rows, len(lexicon), config.middle(config.nmf_topics), **options)
        models.save_nmf(spark, model, lexicon, f"{base}/model")
        words = nmf.topic_words(spark, model, lexicon, config.words_per_topic)
        return _finish(base, words, nmf.document_topics(rows, model), model.k, sweep)
    finally:
        rows.unpersist()


def run_clusters(
    features: dict[str, DataFrame],
    base: str,
    config: TopicConfig = TopicConfig(),
    find_optimal: bool = True,
    embeddings: DataFrame | None = None,
    min_points: int = 5,
) -> dict[str, DataFrame]:
    """Density topics; ``embeddings`` is ``(id, embedding)``, the hashed text by default.

    Without ``find_optimal`` the topics are merged down to the middle of the range.
    """
    docs, lexicon = features["processed"], Lexicon.of(features["vocabulary"])
    if embeddings is None:
        vectors = feature_vectors(_grams(docs, config), lexicon, config.weighting)
        embeddings = clusters.hash_embedding(vectors, lexicon, config.embedding_dims)
    dims = config.reduced_dims
    embeddings = tables.save_table(embeddings, f"{base}/embeddings")
    coords = tables.save_table(clusters.reduce_dimensions(embeddings, dims), f"{base}/coords")
    assigned = clusters.density_topics(coords, min_points, config.min_topic_size, dims=dims)
    assigned = tables.save_table(assigned, f"{base}/assigned")
    if not find_optimal:
        reduced = clusters.reduce_topics(docs, assigned, config.middle(config.cluster_topics))
        assigned = tables.save_table(reduced, f"{base}/assigned_reduced")
    detected = clusters.detected_topics(assigned)
    k = detected.first()["k_detected"]
    centres = models.save_clusters(clusters.centroids(coords, assigned, dims), f"{base}/model")
    weights = clusters.class_tfidf(clusters.class_counts(docs, assigned))
    words = clusters.topic_words(weights, config.words_per_topic)
    out = _finish(base, words, clusters.soft_topics(coords, clusters.centre_matrix(centres)), k, None)
    return {**out, "assigned_topic": assigned, "detected": detected}


RUNNERS: dict[str, Callable[..., dict[str, DataFrame]]] = {"lda": run_lda, "nmf": run_nmf, "clusters": run_clusters}


def run_methods(
    features: dict[str, DataFrame],
    base: str,
    config: TopicConfig = TopicConfig(),
    methods: Iterable[str] | None = None,
    find_optimal: bool = True,
) -> dict[str, dict[str, DataFrame] | Exception]:
    """Run the enabled methods; one that fails leaves its error and the others go on.

    The methods run side by side: they read the same features and don't need each other, and
    one that waits for a few tasks of small tables leaves its cores to the passes of another.
    """
    spark = SparkSession.active()

    def run(method: str) -> dict[str, DataFrame] | Exception:
        try:
            return RUNNERS[method](features, f"{base}/{method}", config, find_optimal)
        except Exception as error:
            return error

    # a name given twice is one run, as its tables stand in one folder
    once = list(dict.fromkeys(config.methods if methods is None else methods))
    if not once:
        return {}
    with ThreadPoolExecutor(len(once)) as pool:
        return dict(zip(once, pool.map(inheritable_thread_target(spark)(run), once)))


def topic_count(doc_topics: DataFrame) -> int:
    return doc_topics.select(F.max(F.size("topic_dist"))).first()[0] or 0


def run_report(
    docs: DataFrame,
    doc_topics: DataFrame,
    topic_words: DataFrame,
    k: int,
    method: str = "lda",
    config: TopicConfig = TopicConfig(),
    sweep: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables of the analysis report of one method."""
    result = comparison.evaluate_method(docs, doc_topics, k, method, config)
    table, predicted = result["contingency"], result["predicted_by_topic"]
    analysis = alignment.predict(result["analysis"], predicted)
    out = {
        **result,
        "analysis": analysis,
        "predictions": tables.predictions(analysis),
        "primary_counts": alignment.primary_category_counts(docs),
        "all_counts": alignment.all_category_counts(docs),
        "category_totals": alignment.category_totals(docs),
        "per_topic_accuracy": metrics.topic_accuracy(table, predicted),
        "confusion_shares": report.normalised_confusion(result["confusion"]),
        "best_supported": report.best_supported(result["per_category"]),
        "topic_summary": report.topic_summary(result["primary_shares"], result["purity"]),
        "topic_categories": report.topic_categories(result["primary_shares"], config.categories_per_topic),
        "best_categories": report.best_categories(result["per_category"], config.min_category_count),
        "top_words": report.top_words(topic_words),
        "topic_sizes": report.topic_sizes(analysis),
        "dashboard": report.dashboard_totals(analysis, topic_words),
    }
    if "year" in docs.columns:
        out["topic_trend"] = report.topic_trend(analysis)
    if sweep is not None:
        out["run_summary"] = report.run_summary(result["summary"], result["overall"], out["category_totals"], sweep)
        out["sweep_curve"] = report.sweep_curve(sweep)
    return out


def run_all(
    spark: SparkSession,
    papers: DataFrame,
    base: str,
    config: TopicConfig = TopicConfig(),
    find_optimal: bool = True,
    lemma_table: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Collect, prepare, model, evaluate and report; the main entry of the package.

    ``papers`` is the raw table (``sources.tables.PAPER_SCHEMA``); ``categories`` may be a list
    or comma-separated text. All tables, those of the best method's report included, stand
    below ``base`` and can be read again by ``sources.tables.load_results``.
    """
    asked = (config.categories, config.max_results, config.min_year, config.max_results_per_category)
    corpus = tables.stage(
        spark,
        f"{base}/corpus",
        lambda: flatten_lists(assemble_corpus(from_raw(papers), config=config)),
        tables.fingerprint("corpus", tables.input_fingerprint(papers), asked),
    )
    features = run_features(corpus, f"{base}/features", config, lemma_table=lemma_table)
    modelled = run_methods(features, f"{base}/models", config, find_optimal=find_optimal)
    done = {m: t for m, t in modelled.items() if not isinstance(t, Exception)}
    found = {m: (t["document_topics"], topic_count(t["document_topics"])) for m, t in done.items()}
    # a method that failed or found no topic can't be compared; the run says so
    problems = [(m, f"{type(t).__name__}: {t}") for m, t in modelled.items() if isinstance(t, Exception)]
    problems += [(m, "no topic was found") for m, (_, k) in found.items() if not k]
    found = {m: x for m, x in found.items() if x[1]}
    errors = tables.save_table(spark.createDataFrame(problems, "method string, error string"), f"{base}/errors")
    docs = features["processed"]
    rows = tables.save_table(comparison.compare_methods(docs, found, config), f"{base}/method_rows")
    out = {
        **features,
        "errors": errors,
        "method_rows": rows,
        "comparison": tables.save_table(comparison.comparison_summary(rows), f"{base}/comparison"),
        "best_method": tables.save_table(comparison.best_method(rows), f"{base}/best_method"),
    }
    best = out["best_method"].select("method").first()
    if best:
        method = best["method"]
        parts, (doc_topics, k) = done[method], found[method]
        report = run_report(docs, doc_topics, parts["topic_words"], k, method, config, parts.get("sweep"))
        for name, table in report.items():
            out[f"report.{name}"] = tables.save_table(table, f"{base}/report/{name}")
    for method, parts in done.items():
        out.update({f"{method}.{name}": table for name, table in parts.items()})
    return out
