"""One registered query for each operator, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.llm import (
    bisector_clusters,
    factorisation,
    katz,
    licences,
    near_duplicates,
    nearest,
    packing,
    piece_encoding,
    quality_rules,
    segment_simhash,
    spelling_variants,
    toxicity,
    url_trust,
)
from topicloom.llm.common import fold, table
from topicloom.llm.sql import BISECTOR_CLUSTERS_SQL, QUALITY_RULES_SQL

BYTE_BPE = packing.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.fold_scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = factorisation.score(docs, factorisation.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Verdicts on hosts and starts of paths. Fixed values of the query.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op4_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_encoding.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *quality_rules.STATISTICS, "base_failed", "kept")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: below their source, and for two thirds of the ids also below their
    language; a text that begins with its licence line is a licence file of its directory."""
    docs = table(spark, sf_dir, "documents")
    name = F.col("doc_id").cast("string")
    path = F.when(F.col("doc_id") % 3 == 0, F.concat_ws("/", "source", name)).otherwise(
        F.concat_ws("/", "source", "lang", name)
    )
    first = F.substring_index("text", "\n", 1).rlike("(?i)licen[sc]e")
    files = docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text", first.alias("is_licence_file"))
    return licences.scanned(files).withColumnRenamed("file_id", "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("sentences").cast("long").alias("n_offending"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed_pieces(table(spark, sf_dir, "documents"), BYTE_BPE)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_segment_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bisector_clusters.clustered(table(spark, sf_dir, "embeddings"))
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        bisector_clusters.centroid_name().alias("centroid_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_katz_backoff,
        op3_factorisation_machine,
        op4_url_trust,
        op5_piece_encoding,
        op6_nearest,
        op7_quality_rules,
        op8_licences,
        op9_toxicity,
        op10_packing,
        op11_segment_simhash,
        op12_spelling_variants,
        op13_bisector_clusters,
    )
}
ORACLES = {"op7_quality_rules": QUALITY_RULES_SQL, "op13_bisector_clusters": BISECTOR_CLUSTERS_SQL}
