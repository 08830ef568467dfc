"""Corpus-wide text normalisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from topicloom.config import TopicConfig
from topicloom.functions import text
from topicloom.runtime import BROADCAST_ROWS, cut_lineage, salted_join, spread_rows


def preprocess_abstracts(
    df: DataFrame,
    text_column: str = "abstract",
    config: TopicConfig = TopicConfig(),
    lemma_table: DataFrame | None = None,
    stopwords: list[str] | None = None,
    unicode: bool = False,
) -> DataFrame:
    """Add ``tokens`` and ``processed_text``; documents left without a token are dropped.

    Without ``lemma_table`` this is one projection and one filter over the scan.
    """
    shortest, longest = config.min_word_length, config.max_word_length
    if lemma_table is None:
        source = spread_rows(df)
        tokens = text.preprocess_tokens(text_column, shortest, longest, stopwords, unicode=unicode)
    else:
        raw = df.withColumn("tokens", text.tokenize(text.clean_text(text_column, unicode)))
        source = lemmatize_with(raw, lemma_table)
        tokens = text.filter_tokens("tokens", shortest, longest, stopwords)
    # A filter on the token count would be pushed below the projection and compute the
    # tokens twice. Exploding a list of no or one token array drops the same rows once.
    some = F.filter(F.array(tokens), lambda t: F.size(t) > 0)
    carried = [c for c in source.columns if c != "tokens"]
    return source.select(*carried, F.explode(some).alias("tokens")).withColumn(
        "processed_text", text.join_tokens("tokens")
    )


def removed_counts(df: DataFrame, text_column: str = "abstract", **options) -> DataFrame:
    """One row: documents in, documents kept, documents dropped as empty."""
    tokens = text.preprocess_tokens(text_column, **options)
    counts = spread_rows(df).select((F.size(tokens) > 0).alias("kept")).agg(
        F.count(F.lit(1)).alias("n_in"), F.count_if("kept").alias("n_kept")
    )
    return counts.withColumn("n_removed", F.col("n_in") - F.col("n_kept"))


def lemmatize_with(df: DataFrame, lemma_table: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replace ``tokens`` through a ``(token, lemma)`` table; unknown tokens stay.

    A table of up to ``broadcast_rows`` rows, as the words of a language make, goes to the tasks
    as a sorted dictionary, and every batch of texts is looked up at once: one scan, no shuffle,
    and rows of any id, repeated or null, stay as they are. Beyond that the rows are numbered
    and written, and tokens are joined and put back by these numbers. Of several lemmas of a
    token the smallest counts; null tokens and null lists stay.
    """
    lemmas = lemma_table.where("token is not null and lemma is not null").groupBy("token").agg(F.min("lemma").alias("lemma"))
    lemmas = cut_lineage(lemmas)
    if lemmas.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return _looked_up(df, lemmas.orderBy("token").toArrow())
    return _joined(df, lemmas)


def _looked_up(df: DataFrame, lemmas: pa.Table) -> DataFrame:
    known, lemma = lemmas.column("token").combine_chunks(), lemmas.column("lemma").combine_chunks()

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("tokens")
            lists = batch.column(at)
            words = lists.flatten()
            # distinct words of the batch are looked up, texts only carry their numbers
            coded = words.dictionary_encode()
            found = lemma.take(pc.index_in(coded.dictionary, known))
            lemmas_ = pc.coalesce(found, coded.dictionary).take(coded.indices)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            made = pa.ListArray.from_arrays(offsets, lemmas_, mask=lists.is_null())
            yield batch.set_column(at, "tokens", made)

    plain = df.withColumn("tokens", F.col("tokens").cast("array<string>"))
    return plain.mapInArrow(replace, plain.schema)


def _joined(df: DataFrame, lemmas: DataFrame) -> DataFrame:
    # the numbers must not change when a task runs again, so they are written with their rows
    rows = cut_lineage(df.withColumn("_row", F.expr("uuid()")))
    words = rows.select("_row", F.posexplode("tokens").alias("pos", "token"))
    replaced = salted_join(words, lemmas, ["token"]).select(
        "_row", F.struct("pos", F.coalesce("lemma", "token").alias("lemma")).alias("word")
    )
    regrouped = replaced.groupBy("_row").agg(F.sort_array(F.collect_list("word")).alias("words"))
    lists = regrouped.select("_row", F.transform("words", lambda w: w["lemma"]).alias("_lemmas"))
    return rows.join(lists, "_row", "left").withColumn("tokens", F.coalesce("_lemmas", "tokens")).select(df.columns)


# Noun endings and what replaces them, as in WordNet's morphology.
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def build_lemma_table(terms: DataFrame, nouns: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(token, lemma)`` for the distinct ``term`` values that change.

    A candidate is a term with one ending replaced; it counts only when it is a known
    noun. The term itself is a candidate too. The shortest candidate wins, and the
    ``(token, lemma)`` pairs of ``exceptions`` take precedence. ``nouns`` has a column
    ``noun``: a dictionary, or the corpus vocabulary where there is none.
    """
    term = F.col("term")
    stems = [
        F.when(term.endswith(old), F.concat(F.substring(term, F.lit(1), F.length(term) - len(old)), F.lit(new)))
        for old, new in NOUN_ENDINGS
    ]
    candidates = terms.select("term").distinct().select(
        term.alias("token"), F.explode(F.array_compact(F.array(term, *stems))).alias("noun")
    )
    known = candidates.where(F.col("noun") != "").join(nouns.select("noun").distinct(), "noun", "left_semi")
    shortest = known.groupBy("token").agg(
        F.min(F.struct(F.length("noun").alias("length"), F.col("noun"))).alias("best")
    )
    by_rule = shortest.select("token", F.col("best.noun").alias("lemma"))
    if exceptions is not None:
        irregular = exceptions.select("token", "lemma").dropDuplicates(["token"])
        by_rule = by_rule.join(irregular, "token", "left_anti").unionByName(
            irregular.join(terms.select(term.alias("token")).distinct(), "token", "left_semi")
        )
    return by_rule.where(F.col("token") != F.col("lemma"))
