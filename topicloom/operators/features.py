"""Vocabulary, bag-of-words and TF-IDF.

The vocabulary is bounded by its cap, so it is held on the driver and the document side
never shuffles: counting, weighting and scaling happen inside each row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.config import TopicConfig
from topicloom.functions import arrays
from topicloom.runtime import cut_lineage


def split_tokens(df: DataFrame, column: str = "processed_text") -> DataFrame:
    """Tokens of processed text; empty text has none."""
    return df.withColumn("tokens", F.filter(F.split(column, " "), lambda t: t != ""))


def add_ngrams(df: DataFrame, low: int = 1, high: int = 1) -> DataFrame:
    """Replace tokens by their n-grams for the range."""
    return df if (low, high) == (1, 1) else df.withColumn("tokens", arrays.ngrams("tokens", low, high))


def term_counts(docs: DataFrame) -> DataFrame:
    """``(id, term, tf)`` without a shuffle."""
    return docs.select("id", F.inline(arrays.run_lengths("tokens")))


def document_frequencies(docs: DataFrame, with_total: bool = False) -> DataFrame:
    """``(term, df, ctf)``: documents with the term, and occurrences in the corpus.

    Counts are combined on the map side, so a frequent term costs one row per task. With
    ``with_total`` every document also counts for the missing term, whose ``df`` is then
    the number of documents.
    """
    counts = arrays.run_lengths("tokens")
    if with_total:
        missing = F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("tf"))
        counts = F.array_append(counts, missing)
    return (
        docs.select(F.inline(counts))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))
    )


def prune(frequencies: DataFrame, n_docs: Column, min_df: int, max_df: float) -> DataFrame:
    """Terms in at least ``min_df`` documents and at most the share ``max_df`` of them."""
    return frequencies.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))


def with_term_ids(terms: DataFrame) -> DataFrame:
    """Number terms from 0 in alphabetical order. Only for capped vocabularies."""
    ordered = Window.orderBy("term")
    return terms.withColumn("term_id", F.row_number().over(ordered) - 1)


def count_terms(docs: DataFrame, min_df: int = 2) -> DataFrame:
    """Term frequencies of one pass over the texts, written out.

    ``(term, df, ctf)`` of the terms in at least ``min_df`` documents; the row without a
    term holds the number of documents. Its size follows the terms, not the texts.
    """
    found = document_frequencies(docs, with_total=True)
    return cut_lineage(found.where((F.col("df") >= min_df) | F.col("term").isNull()))


def vocabulary_of(
    counted: DataFrame, min_df: int = 2, max_df: float = 0.95, max_terms: int = 10_000, keep_by: str = "ctf"
) -> DataFrame:
    """``(term, term_id, df, ctf, idf)`` of the ``max_terms`` most frequent terms of ``count_terms``.

    ``keep_by`` is the frequency that decides: ``ctf`` (occurrences) for TF-IDF features,
    ``df`` (documents) for bag-of-words features. Ties go to the smaller term.
    """
    n_docs = counted.where(F.col("term").isNull()).select("df").scalar()
    kept = prune(counted.where(F.col("term").isNotNull()), n_docs, min_df, max_df)
    top = kept.orderBy(F.desc(keep_by), "term").limit(max_terms)
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    # at most max_terms rows, written so that the top terms are picked once
    return cut_lineage(with_term_ids(top).select("term", "term_id", "df", "ctf", idf.alias("idf")))


def vocabulary(
    docs: DataFrame, min_df: int = 2, max_df: float = 0.95, max_terms: int = 10_000, keep_by: str = "ctf"
) -> DataFrame:
    """Vocabulary of a corpus, see ``vocabulary_of``."""
    return vocabulary_of(count_terms(docs, min_df), min_df, max_df, max_terms, keep_by)


@dataclass(frozen=True)
class Lexicon:
    """A fitted vocabulary on the driver: at most the cap's number of terms."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]

    @classmethod
    def of(cls, vocab: DataFrame) -> "Lexicon":
        rows = vocab.select("term_id", "term", "idf").collect()
        rows.sort(key=lambda r: r["term_id"])
        return cls(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))

    def __len__(self) -> int:
        return len(self.terms)


def count_vectors(docs: DataFrame, lexicon: Lexicon, output: str = "features") -> DataFrame:
    """Sparse term counts per document. Terms outside the vocabulary are dropped."""
    model = CountVectorizerModel.from_vocabulary(list(lexicon.terms), "tokens", output)
    return model.transform(docs)


def tfidf_vectors(docs: DataFrame, lexicon: Lexicon, output: str = "features") -> DataFrame:
    """Sparse TF-IDF vectors of unit length; a document without known terms stays zero."""
    counted = count_vectors(docs, lexicon, "_counts")
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(lexicon.idf), inputCol="_counts", outputCol="_weights"
    )
    scale = Normalizer(p=2.0, inputCol="_weights", outputCol=output)
    return scale.transform(weigh.transform(counted)).drop("_counts", "_weights")


def feature_vectors(docs: DataFrame, lexicon: Lexicon, weighting: str = "tfidf") -> DataFrame:
    """Vectors by the chosen weighting, ``tfidf`` or ``bow``."""
    if weighting not in ("tfidf", "bow"):
        raise ValueError(f"weighting must be 'tfidf' or 'bow', not {weighting!r}")
    return (tfidf_vectors if weighting == "tfidf" else count_vectors)(docs, lexicon)


def sparse_rows(vectors: DataFrame, column: str = "features") -> DataFrame:
    """``(id, indices, weights)``: the arrays inside the sparse vectors."""
    inner = F.unwrap_udt(column)
    return vectors.select("id", inner["indices"].alias("indices"), inner["values"].alias("weights"))


def nested_rows(vectors: DataFrame, column: str = "features") -> DataFrame:
    """``(id, entries ARRAY<STRUCT<term_id, weight>>)`` in term order."""
    rows = sparse_rows(vectors, column)
    pair = F.arrays_zip(F.col("indices").alias("term_id"), F.col("weights").alias("weight"))
    return rows.select("id", pair.alias("entries"))


def long_rows(vectors: DataFrame, column: str = "features") -> DataFrame:
    """``(id, term_id, weight)``, one row per document and term."""
    rows = sparse_rows(vectors, column)
    entry = F.explode(F.arrays_zip(F.col("indices").alias("term_id"), F.col("weights").alias("weight")))
    return rows.select("id", entry.alias("e")).select("id", "e.term_id", "e.weight")


def bag_of_words(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(id, term_id, tf)``."""
    rows = long_rows(count_vectors(docs, lexicon))
    return rows.select("id", "term_id", F.col("weight").cast("long").alias("tf"))


def remap_terms(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(source_id, target_id)`` for the terms two vocabularies share."""
    return source.select("term", F.col("term_id").alias("source_id")).join(
        target.select("term", F.col("term_id").alias("target_id")), "term"
    )


def feature_totals(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row: documents, vocabulary size, mean distinct known terms per document."""
    sizes = sparse_rows(count_vectors(docs, lexicon)).select(F.size("indices").alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.lit(len(lexicon)).cast("long").alias("n_terms"),
        F.avg("n").alias("mean_terms"),
    )


def bow_features(
    docs: DataFrame, min_df: int = 2, max_df: float = 0.95, max_terms: int = 100_000
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary by document frequency and the ``(id, term_id, tf)`` rows."""
    vocab = vocabulary(docs, min_df, max_df, max_terms, keep_by="df")
    return vocab, bag_of_words(docs, Lexicon.of(vocab))


def tfidf_features(
    docs: DataFrame,
    min_df: int = 2,
    max_df: float = 0.95,
    max_terms: int = 10_000,
    ngram_range: Sequence[int] = (1, 1),
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary by corpus frequency and the ``(id, term_id, weight)`` rows."""
    grams = add_ngrams(docs, *ngram_range)
    vocab = vocabulary(grams, min_df, max_df, max_terms)
    return vocab, long_rows(tfidf_vectors(grams, Lexicon.of(vocab)))


def build_features(docs: DataFrame, config: TopicConfig = TopicConfig()) -> dict[str, DataFrame]:
    """Feature tables of a run: the chosen weighting, and bag-of-words in any case.

    With single words both vocabularies come from the same counted terms.
    """
    counted = count_terms(docs, config.min_df)
    bow_vocab = vocabulary_of(counted, config.min_df, config.max_df, config.bow_max_terms, keep_by="df")
    bow = bag_of_words(docs, Lexicon.of(bow_vocab))
    tables = {"vocabulary_bow": bow_vocab, "bow": bow}
    if config.weighting != "tfidf":
        weights = bow.select("id", "term_id", F.col("tf").cast("double").alias("weight"))
        return {**tables, "vocabulary": bow_vocab, "features": weights}
    grams = add_ngrams(docs, *config.ngram_range)
    if grams is not docs:
        counted = count_terms(grams, config.min_df)
    vocab = vocabulary_of(counted, config.min_df, config.max_df, config.max_features)
    return {**tables, "vocabulary": vocab, "features": long_rows(tfidf_vectors(grams, Lexicon.of(vocab)))}
