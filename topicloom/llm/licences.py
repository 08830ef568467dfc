"""Licences of files by TF-IDF cosine to templates, inherited from the nearest directory.

Every line of every text that mentions a licence is compared with the templates. A line
and a template are sparse vectors of terms weighted by ``tf * ln(1 + n / df)``, where n and
df count such lines over all files. A file's own licence is the template of its best line,
if the cosine reaches ``least``. Files that are licence files of their directory declare
it; a file without a licence of its own takes the one that its nearest ancestor directory
declares, by joining its ancestor paths with the declarations. Where files of one directory
declare different licences, the most frequent one counts, then the first by name.

Defined cases: null and empty texts have no own licence and may inherit; a null path is in
no directory; ties of a cosine go to the first template by name and then the first line;
repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.llm.common import LOWER, UPPER, stored
from topicloom.runtime import lookup_join

#: Statements that headers and licence files use. Fixed values.
STATEMENTS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by a BSD 2-Clause license.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD 3-Clause license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under the CC0 1.0 license.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
}

_MENTION = "(?i)licen[sc]e|copyright|public domain|spdx"
_TERM_GAP = "[^a-z0-9.]+|\\.(?![0-9])"


@dataclass(frozen=True)
class LicenceScan:
    statements: Mapping[str, str] = field(default_factory=lambda: dict(STATEMENTS))
    least: float = 0.6


def _terms(text):
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), _TERM_GAP), "")


def _frequencies(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def own_licences(files: DataFrame, how: LicenceScan = LicenceScan()) -> DataFrame:
    """``(file_id, line, licence, cosine)`` of files with a line close to a template."""
    spark: SparkSession = files.sparkSession
    texts = files.where(F.col("text").rlike(_MENTION)).select("file_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = texts.where(F.col("text").rlike(_MENTION)).select("file_id", "line", _terms("text").alias("terms"))
    # equal lines of many files are weighed once, and a line of a file is known by its terms
    lines = stored(lines.withColumn("key", F.sha2(F.concat_ws(" ", "terms"), 256)), "licence_lines")
    kinds = lines.groupBy("key").agg(F.first("terms").alias("terms"), F.count(F.lit(1)).alias("copies"))
    tf = stored(
        _frequencies(kinds, "key", "copies").select("key", "copies", "term", "tf"), "licence_terms"
    )
    total = kinds.agg(F.sum("copies")).first()[0] or 0
    df = tf.groupBy("term").agg(F.sum("copies").alias("df"))
    weighed = tf.join(df, "term").withColumn("w", F.col("tf") * F.log1p(F.lit(float(total)) / F.col("df")))
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # the templates are few and fixed by parameter; terms unseen in any line weigh most
    templates = spark.createDataFrame(sorted(how.statements.items()), "licence string, text string")
    terms = _frequencies(templates.select("licence", _terms("text").alias("terms")), "licence")
    terms = terms.join(df, "term", "left").withColumn(
        "v", F.col("tf") * F.log1p(F.lit(float(total)) / F.coalesce("df", F.lit(1)))
    )
    lengths = terms.groupBy("licence").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    vectors = stored(terms.join(lengths, "licence").select("licence", "term", F.try_divide("v", "length").alias("v")), "licence_templates")
    dots = weighed.join(F.broadcast(vectors), "term").groupBy("key", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosines = dots.join(norms, "key").select("key", "licence", F.round(F.try_divide("dot", "norm"), 9).alias("cosine"))
    best = stored(
        cosines.where(F.col("cosine") >= how.least)
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("cosine")).alias("cost"), "licence")).alias("x"))
        .select("key", F.col("x.licence").alias("licence"), (-F.col("x.cost")).alias("cosine")),
        "licence_matches",
    )
    found = lookup_join(lines.select("file_id", "line", "key"), best, "key", "inner")
    first = F.min(F.struct((-F.col("cosine")).alias("cost"), "licence", "line")).alias("x")
    return found.groupBy("file_id").agg(first).select(
        "file_id", F.col("x.line").alias("line"), F.col("x.licence").alias("licence"), (-F.col("x.cost")).alias("cosine")
    )


def scanned(files: DataFrame, how: LicenceScan = LicenceScan()) -> DataFrame:
    """``(file_id, path, own, cosine, line, licence, inherited_from)`` of every file.

    ``files`` is ``(file_id, path, text, is_licence_file)``; directories end before the
    last ``/`` of a path.
    """
    own = stored(own_licences(files, how), "own_licences")
    placed = files.select("file_id", "path", "is_licence_file").join(
        own.withColumnRenamed("licence", "own"), "file_id", "left"
    )
    placed = stored(placed, "licence_files")
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    declared = (
        placed.where("is_licence_file and own is not null and path like '%/%'")
        .groupBy(folder.alias("folder"), "own")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("n")).alias("cost"), "own")).alias("x"))
        .select("folder", F.col("x.own").alias("declared"))
    )
    declared = stored(declared, "declared_licences")
    # ancestors depend on the path's folder alone, so each folder is joined once
    folders = placed.where("own is null and path like '%/%'").select(folder.alias("folder")).distinct()
    up = folders.select("folder", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("folder", "/"))),
        lambda i: F.array_join(F.slice(F.split("folder", "/"), 1, i), "/"),
    )).alias("above"))
    nearest = stored(
        lookup_join(up, declared.withColumnRenamed("folder", "above"), "above", "inner")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "declared")).alias("x"))
        .select("folder", F.col("x.above").alias("inherited_from"), F.col("x.declared").alias("inherited")),
        "inherited_licences",
    )
    out = lookup_join(placed.withColumn("folder", folder), nearest, "folder")
    lent = F.col("own").isNull()
    return out.select(
        "file_id", "path", "own", "cosine", "line",
        F.coalesce("own", "inherited").alias("licence"),
        F.when(lent, F.col("inherited_from")).alias("inherited_from"),
    )
