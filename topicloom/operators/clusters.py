"""Embedding clusters: document vectors, density clusters on a grid, topic words.

Density clustering works on grid cells instead of document pairs. The reduced vectors
are cut into cells and counted, which folds any number of equal or close documents into
one row. With given cell widths a cell is dense when it and its neighbour cells hold enough
documents, touching dense cells form a topic, and the rest is outliers (-1); without them
topics are the branches of a density tree. The cost follows the number of occupied cells,
however unevenly the documents fall into them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.operators import density, topics
from topicloom.operators.features import Lexicon, sparse_rows
from topicloom.runtime import cut_lineage, lookup_join, number_rows, salted_join, spread_rows

#: Rounds of merging labels before the result is written out again.
ROUNDS_PER_CUT = 3


# -- document vectors --------------------------------------------------------------


def hash_slots(lexicon: Lexicon, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of every term, from the MD5 of the term."""
    from hashlib import md5

    digests = [md5(t.encode()).hexdigest() for t in lexicon.terms]
    slots = np.array([int(d[:7], 16) % dims for d in digests], dtype=np.int64)
    signs = np.array([1.0 if int(d[7], 16) % 2 == 0 else -1.0 for d in digests])
    return slots, signs


def hash_embedding(vectors: DataFrame, lexicon: Lexicon, dims: int = 64) -> DataFrame:
    """``(id, embedding)``: signed hash projection of the sparse feature vectors."""
    slots, signs = hash_slots(lexicon, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            terms = lists.flatten().to_numpy(zero_copy_only=False)
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(lengths)), lengths)
            flat = np.bincount(rows * dims + slots[terms], values * signs[terms], minlength=len(lengths) * dims)
            offsets = pa.array(np.arange(0, len(flat) + 1, dims, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["id", "embedding"]
            )

    rows = sparse_rows(vectors)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(project, f"id {kind}, embedding array<double>")


def word_embedding(docs: DataFrame, lexicon: Lexicon, dims: int = 64, seed: int = 42, parts: int = 8) -> DataFrame:
    """``(id, embedding)``: mean of word vectors trained on the corpus.

    Only words of the capped vocabulary are trained, which bounds the word vectors. The
    documents are trained in ``parts`` shares, so vectors don't depend on the cluster.
    """
    known = docs.select("id", F.filter("tokens", lambda t: t.isin(list(lexicon.terms))).alias("_known"))
    trainer = Word2Vec(
        vectorSize=dims,
        minCount=1,
        seed=seed,
        numPartitions=parts,
        inputCol="_known",
        outputCol="_v",
    )
    known.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = trainer.fit(known)
    finally:
        known.unpersist()
    return model.transform(known).select("id", vector_to_array("_v").alias("embedding"))


def embed(
    docs: DataFrame,
    lexicon: Lexicon | None = None,
    embedding_column: str | None = None,
    encoder=None,
    dims: int = 64,
    trained: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Document vectors from a supplied column, a user's encoder, or the text itself.

    ``encoder`` is a ``mapInPandas`` function that turns ``(id, text)`` frames into
    ``(id, embedding)`` frames. Otherwise ``docs`` needs a ``lexicon`` and ``features`` for
    the hashed text, or ``tokens`` for ``trained`` word vectors.
    """
    if embedding_column is not None:
        return docs.select("id", F.col(embedding_column).cast("array<double>").alias("embedding"))
    if encoder is not None:
        kind = docs.schema["id"].dataType.simpleString()
        return docs.select("id", "text").mapInPandas(encoder, f"id {kind}, embedding array<double>")
    if lexicon is None:
        raise ValueError("vectors from the text need a lexicon")
    return word_embedding(docs, lexicon, dims, seed) if trained else hash_embedding(docs, lexicon, dims)


def reduce_dimensions(embeddings: DataFrame, k: int = 5) -> DataFrame:
    """``(id, coords ARRAY<DOUBLE>)``: first ``k`` principal components."""
    vectors = embeddings.select("id", array_to_vector("embedding").alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors)
    return model.transform(vectors).select("id", vector_to_array("_p").alias("coords"))


# -- density clusters --------------------------------------------------------------


def _key(parts: Sequence[Column]) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def assign_cells(coords: DataFrame, widths: Sequence[float]) -> DataFrame:
    """Add ``cell ARRAY<BIGINT>`` and its text form ``cell_key``."""
    parts = [F.floor(F.get("coords", F.lit(i)) / w).cast("long") for i, w in enumerate(widths)]
    return coords.withColumn("cell", F.array(*parts)).withColumn("cell_key", _key(parts))


def _with_neighbours(cells: DataFrame, dims: int, *columns: str) -> DataFrame:
    """A row per cell and touching cell, itself included, with the key ``near``.

    One explode per dimension keeps the 3 ** dims rows of a cell inside generated code.
    """
    out = cells.select("cell", "cell_key", *columns)
    for i in range(dims):
        out = out.withColumn(f"_{i}", F.explode(F.array(*[F.lit(x).cast("long") for x in (-1, 0, 1)])))
    key = _key([F.get("cell", F.lit(i)) + F.col(f"_{i}") for i in range(dims)])
    return out.select("cell_key", *columns, key.alias("near"))


def dense_cells(cells: DataFrame, dims: int, min_points: int) -> DataFrame:
    """Cells whose neighbourhood holds at least ``min_points`` documents.

    ``cells`` is ``(cell, cell_key, n)``. Every cell adds its count to its neighbours, so
    the sums are combined before the shuffle.
    """
    lent = _with_neighbours(cells, dims, "n").groupBy(F.col("near").alias("cell_key"))
    density = lent.agg(F.sum("n").alias("density"))
    return cells.join(density.where(F.col("density") >= min_points), "cell_key")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node of each component.

    ``edges`` is ``(src, dst)`` in both directions. Each round takes the smallest label
    around a node and then the label of that label, which halves long chains.
    """
    labels = cut_lineage(nodes.select("node", F.col("node").alias("label")))
    edges = cut_lineage(edges)
    while True:
        before = labels
        for _ in range(ROUNDS_PER_CUT):
            around = (
                edges.join(labels.withColumnRenamed("node", "dst"), "dst")
                .groupBy(F.col("src").alias("node"))
                .agg(F.min("label").alias("near"))
            )
            lower = labels.join(around, "node", "left").select(
                "node", F.least("label", F.coalesce("near", "label")).alias("label")
            )
            jump = lower.where("node != label").select(F.col("node").alias("label"), F.col("label").alias("further"))
            # most nodes of a large component share one label, hence the salted join
            labels = salted_join(lower, jump, ["label"], "left").select(
                "node", F.coalesce("further", "label").alias("label")
            )
        labels = cut_lineage(labels)
        moved = labels.join(before.withColumnRenamed("label", "old"), "node").where("label != old")
        if moved.isEmpty():
            return labels


def cell_topics(cells: DataFrame, dims: int, min_points: int) -> DataFrame:
    """``(cell_key, label)`` of dense cells and of the cells next to one.

    A cell next to several topics goes to the neighbour with the smallest label.
    """
    dense = spread_rows(cut_lineage(dense_cells(cells, dims, min_points)))
    touch = _with_neighbours(dense, dims).where("near != cell_key")
    known = dense.select(F.col("cell_key").alias("near"))
    edges = touch.join(known, "near", "left_semi").select(F.col("cell_key").alias("src"), F.col("near").alias("dst"))
    labels = connected_components(dense.select(F.col("cell_key").alias("node")), edges)
    core = labels.select(F.col("node").alias("cell_key"), "label")
    fringe = _with_neighbours(cells.join(core, "cell_key", "left_anti"), dims)
    border = (
        fringe.join(core.withColumnRenamed("cell_key", "near"), "near")
        .groupBy("cell_key")
        .agg(F.min("label").alias("label"))
    )
    return core.unionByName(border)


def density_topics(
    coords: DataFrame,
    min_points: int = 5,
    min_topic_size: int = 10,
    widths: Sequence[float] | None = None,
    dims: int | None = None,
) -> DataFrame:
    """``(id, topic)``: topics from 0, largest first; outliers are -1.

    Topics with fewer than ``min_topic_size`` documents become outliers. Without ``widths``
    topics are the branches of a density tree (see ``operators.density``), so they may be of
    any size and density; ``dims`` is the number of coordinates, read from the data when it
    isn't given. With ``widths`` all cells are of that size, and a neighbourhood is dense from
    ``min_points`` documents on.
    """
    if widths is None:
        marked = cut_lineage(density.tree_topics(coords, min_points, min_topic_size, dims))
        large = marked.select("label", "size").distinct()
        numbered = number_rows(large, [F.desc("size"), F.asc("label")], "topic").select("label", "topic")
        named = lookup_join(marked.select("id", "label"), numbered, "label").select("id", "topic")
        return coords.select("id").join(named, "id", "left").select("id", F.coalesce("topic", F.lit(-1)).alias("topic"))
    dims = len(widths)
    placed = assign_cells(coords, widths).select("id", "cell", "cell_key")
    counted = placed.groupBy("cell_key").agg(F.first("cell").alias("cell"), F.count(F.lit(1)).alias("n"))
    # each cell turns into 3 ** dims rows, so few small partitions are spread first
    cells = spread_rows(cut_lineage(counted))
    labelled = cell_topics(cells, dims, min_points)
    sizes = labelled.join(cells, "cell_key").groupBy("label").agg(F.sum("n").alias("size"))
    large = sizes.where(F.col("size") >= min_topic_size)
    numbered = number_rows(large, [F.desc("size"), F.asc("label")], "topic").select("label", "topic")
    of_cell = cut_lineage(labelled.join(numbered, "label").select("cell_key", "topic"))
    found = lookup_join(placed.select("id", "cell_key"), of_cell, "cell_key")
    return found.select("id", F.coalesce("topic", F.lit(-1)).alias("topic"))


def fixed_topics(coords: DataFrame, k: int, seed: int = 42, bisecting: bool = False) -> DataFrame:
    """``(id, topic)`` by k-means with a given number of topics."""
    kind = BisectingKMeans if bisecting else KMeans
    vectors = coords.select("id", array_to_vector("coords").alias("features")).persist()
    try:
        model = kind(k=k, seed=seed, predictionCol="topic").fit(vectors)
    finally:
        vectors.unpersist()
    return model.transform(vectors).select("id", "topic")


def detected_topics(assigned: DataFrame) -> DataFrame:
    """One row: number of topics without the outliers."""
    return assigned.agg(F.count_distinct(F.when(F.col("topic") != -1, F.col("topic"))).alias("k_detected"))


# -- class-based TF-IDF ------------------------------------------------------------


def class_counts(docs: DataFrame, assigned: DataFrame) -> DataFrame:
    """``(topic, term, tf)``, combined before the shuffle. ``assigned`` is ``(id, topic)``."""
    tokens = docs.select("id", "tokens").join(assigned.select("id", "topic"), "id")
    counted = tokens.select("topic", F.explode("tokens").alias("term"))
    return counted.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("tf"))


def class_tfidf(counts: DataFrame) -> DataFrame:
    """``(topic, term, weight)`` over all classes, outliers included.

    The share of a term within its topic times ``ln(1 + A / f)``: ``f`` counts the term in
    all topics, ``A`` is the mean number of words per topic, rounded down.
    """
    totals = counts.groupBy("topic").agg(F.sum("tf").alias("words"))
    mean = totals.agg(F.floor(F.avg("words")).cast("double").alias("a")).scalar()
    overall = counts.groupBy("term").agg(F.sum("tf").alias("f"))
    joined = counts.join(totals, "topic").join(overall, "term")
    weight = F.col("tf") / F.col("words") * F.log(1 + mean / F.col("f"))
    return joined.select("topic", "term", weight.alias("weight"))


def topic_words(weights: DataFrame, n: int = 15) -> DataFrame:
    """First ``n`` words of each topic; outliers have none."""
    named = weights.where(F.col("topic") != -1).select(
        F.col("topic").alias("topic_id"), F.col("term").alias("word"), "weight"
    )
    return topics.rank_words(named, n)


def _smallest(sizes: DataFrame) -> DataFrame:
    return sizes.where("topic != -1").orderBy("size", F.desc("topic")).limit(1)


def merge_topics(counts: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """``(topic, merged)``: topics joined together until at most ``k`` are left.

    The smallest topic goes into the one with the most similar class TF-IDF by cosine;
    equal similarities go to the smaller number. ``counts`` is ``(topic, term, tf)``,
    ``sizes`` is ``(topic, size)``. A round compares one topic with the others, so its
    cost follows the terms of that topic. The driver reads two numbers per round.
    """
    counts, sizes = cut_lineage(counts), cut_lineage(sizes)
    mapping = sizes.select("topic", F.col("topic").alias("merged"))
    left = sizes.where("topic != -1").count()
    while left > max(k, 1):
        small = _smallest(sizes).first()["topic"]
        weights = class_tfidf(counts).where("topic != -1")
        norms = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
        own = weights.where(F.col("topic") == small).select("term", F.col("weight").alias("own"))
        dots = (
            weights.where(F.col("topic") != small)
            .join(own, "term")
            .groupBy("topic")
            .agg(F.sum(F.col("weight") * F.col("own")).alias("dot"))
        )
        others = norms.where(F.col("topic") != small).join(dots, "topic", "left")
        cosine = F.coalesce(F.col("dot") / F.nullif(F.col("norm"), F.lit(0.0)), F.lit(0.0))
        target = others.select("topic", F.round(cosine, 12).alias("s")).orderBy(F.desc("s"), "topic").first()
        if target is None:
            target = sizes.where((F.col("topic") != -1) & (F.col("topic") != small)).orderBy("topic").first()
        into = target["topic"]

        def moved(c: str) -> Column:
            return F.when(F.col(c) == small, F.lit(into)).otherwise(F.col(c))

        counts = cut_lineage(counts.groupBy(moved("topic").alias("topic"), "term").agg(F.sum("tf").alias("tf")))
        sizes = cut_lineage(sizes.groupBy(moved("topic").alias("topic")).agg(F.sum("size").alias("size")))
        mapping = cut_lineage(mapping.withColumn("merged", moved("merged")))
        left -= 1
    return mapping


#: Topics a side of a block in which similarities are computed.
BLOCK_TOPICS = 256

#: Terms whose weights are multiplied at a time.
BLOCK_TERMS = 4096


#: Rows of a pair of blocks that are multiplied in one task, about.
BLOCK_ROWS = 400_000


def _block_products(rows: pa.Table) -> pa.Table:
    """Products of the topics of two blocks over some of the terms, as a matrix with its topics.

    ``rows`` holds ``(i, j, side, topic, term, weight, norm)``. Weights are multiplied a stretch of
    terms at a time, so no table of all terms is ever dense.
    """
    terms = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    side, topic, weight, norm = (rows.column(c).to_numpy() for c in ("side", "topic", "weight", "norm"))
    names = [np.unique(topic[side == s]) for s in (0, 1)]
    norms = [norm[side == s][np.unique(topic[side == s], return_index=True)[1]] for s in (0, 1)]
    total = np.zeros((len(names[0]), len(names[1])))
    order = np.argsort(terms, kind="stable")
    cuts = np.searchsorted(terms[order], np.arange(0, terms.max(initial=-1) + 1 + BLOCK_TERMS, BLOCK_TERMS))
    for start, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        dense = []
        for s, name in enumerate(names):
            at = order[low:high][side[order[low:high]] == s]
            matrix = np.zeros((len(name), BLOCK_TERMS))
            matrix[np.searchsorted(name, topic[at]), terms[at] - start * BLOCK_TERMS] = weight[at]
            dense.append(matrix)
        total += dense[0] @ dense[1].T
    out = {c: rows.column(c).slice(0, 1).combine_chunks() for c in ("i", "j")}
    lists = {"topics": names[0], "partners": names[1], "norms": norms[0], "others": norms[1], "products": total.ravel()}
    return pa.table({**out, **{c: pa.array([x.tolist()], pa.list_(pa.from_numpy_dtype(x.dtype))) for c, x in lists.items()}})


def _block_best(parts: pa.Table) -> pa.Table:
    """The nearest partner of every topic of the first block among those of the second.

    ``parts`` holds the products of one pair of blocks over shares of the terms, with the topics
    of either side and their norms.
    """
    lists = {c: [np.asarray(x) for x in parts.column(c).to_pylist()] for c in ("topics", "partners", "norms", "others", "products")}
    names, norms = [], []
    for name, norm in (("topics", "norms"), ("partners", "others")):
        found, at = np.unique(np.concatenate(lists[name]).astype(np.int64), return_index=True)
        names.append(found)
        norms.append(np.concatenate(lists[norm]).astype(float)[at])
    total = np.zeros((len(names[0]), len(names[1])))
    for mine, other, products in zip(lists["topics"], lists["partners"], lists["products"]):
        if len(products):
            here = np.ix_(np.searchsorted(names[0], mine), np.searchsorted(names[1], other))
            total[here] += products.reshape(len(mine), -1)
    if not total.size:
        return pa.table({"topic": pa.array([], pa.int64()), "partner": pa.array([], pa.int64()), "cosine": pa.array([], pa.float64())})
    scale = norms[0][:, None] * norms[1][None]
    cosine = np.round(np.divide(total, scale, out=np.zeros_like(total), where=scale > 0), 12)
    cosine[names[0][:, None] == names[1][None]] = -2
    # of equal pairs the one with the smaller numbers, seen from either topic
    low, high = np.minimum.outer(names[0], names[1]), np.maximum.outer(names[0], names[1])
    best = [np.lexsort((high[r], low[r], -cosine[r]))[0] for r in range(len(names[0]))]
    found = cosine[np.arange(len(best)), best]
    real = found > -2
    return pa.table({"topic": names[0][real], "partner": names[1][best][real], "cosine": found[real]})


def nearest_partners(weights: DataFrame) -> DataFrame:
    """``(topic, partner, cosine)``: the most similar other topic of every topic, by class TF-IDF.

    Topics are dealt into blocks, and the terms of a pair of blocks into shares of about
    ``BLOCK_ROWS`` rows; a task multiplies one share. The products of a pair of blocks are added up
    in a task of bounded size, from which one row a topic comes back.
    """
    norms = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"), F.count(F.lit(1)).alias("n"))
    sums = norms.agg(F.count(F.lit(1)).alias("topics"), F.sum("n").alias("rows")).first()
    blocks = max(1, -(-sums["topics"] // BLOCK_TOPICS))
    shares = max(1, -(-2 * (sums["rows"] or 0) // (blocks * BLOCK_ROWS)))
    own = F.pmod(F.xxhash64("topic"), F.lit(blocks)).cast("int")
    share = F.pmod(F.xxhash64("term"), F.lit(shares)).cast("int")
    placed = weights.join(norms.drop("n"), "topic").withColumns({"own": own, "share": share})
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    columns = ["share", "topic", "term", "weight", "norm"]
    left = placed.select(F.col("own").alias("i"), others.alias("j"), F.lit(0).alias("side"), *columns)
    right = placed.select(others.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), *columns)
    schema = "i int, j int, topics array<long>, partners array<long>, norms array<double>, others array<double>, products array<double>"
    parts = left.unionByName(right).groupBy("i", "j", "share").applyInArrow(_block_products, schema)
    found = parts.groupBy("i", "j").applyInArrow(_block_best, "topic long, partner long, cosine double")
    low, high = F.least("topic", "partner"), F.greatest("topic", "partner")
    best = found.groupBy("topic").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), low.alias("low"), high.alias("high"), "partner")).alias("b"))
    return best.select("topic", "b.partner", (-F.col("b.minus")).alias("cosine"))


def merge_nearest(counts: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """``(topic, merged)``: topics joined together until at most ``k`` are left, closest first.

    In a round all pairs that are each other's most similar topic are joined at once, the
    smaller topic into the larger one, of equal ones into the smaller number; where that would
    be too many, the most similar of them. So the rounds grow with the logarithm of the number
    of topics. ``counts`` is ``(topic, term, tf)``, ``sizes`` is ``(topic, size)``; outliers
    (-1) stay out of it. Only the sums of joined topics are made anew.
    """
    counts, sizes = cut_lineage(counts), cut_lineage(sizes)
    mapping = sizes.select("topic", F.col("topic").alias("merged"))
    left = sizes.where("topic != -1").count()
    while left > max(k, 1):
        weights = class_tfidf(counts).where("topic != -1").select(F.col("topic").cast("long").alias("topic"), "term", "weight")
        best = cut_lineage(nearest_partners(weights))
        back = best.select(F.col("topic").alias("partner"), F.col("partner").alias("topic"))
        pairs = best.where("topic < partner").join(back, ["topic", "partner"], "left_semi")
        chosen = pairs.orderBy(F.desc("cosine"), "topic", "partner").limit(left - max(k, 1))
        sized = sizes.select(F.col("topic").alias("t"), "size")
        moves = cut_lineage(
            chosen.join(sized.withColumnsRenamed({"t": "topic", "size": "n"}), "topic")
            .join(sized.withColumnsRenamed({"t": "partner", "size": "m"}), "partner")
            .select(
                F.when(F.col("n") >= F.col("m"), F.col("partner")).otherwise(F.col("topic")).alias("topic"),
                F.when(F.col("n") >= F.col("m"), F.col("topic")).otherwise(F.col("partner")).alias("into"),
            )
        )
        done = moves.count()
        if not done:  # topics without any term have no partner
            break
        touched = cut_lineage(moves.select("topic", "into").unionByName(moves.select(F.col("into").alias("topic"), "into")))

        def joined(df: DataFrame, *by: str, value: str) -> DataFrame:
            same = df.join(touched, "topic", "left_anti")
            moved = df.join(touched, "topic").groupBy(F.col("into").cast(df.schema["topic"].dataType).alias("topic"), *by)
            return cut_lineage(same.unionByName(moved.agg(F.sum(value).alias(value))))

        counts, sizes = joined(counts, "term", value="tf"), joined(sizes, value="size")
        step = moves.withColumnRenamed("topic", "merged")
        kind = mapping.schema["topic"].dataType
        mapping = cut_lineage(
            mapping.join(step, "merged", "left").select("topic", F.coalesce("into", "merged").cast(kind).alias("merged"))
        )
        left -= done
    return mapping


def topic_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("topic").agg(F.count(F.lit(1)).alias("size"))


def reduce_topics(docs: DataFrame, assigned: DataFrame, k: int, rule: str = "nearest") -> DataFrame:
    """``(id, topic)`` with at most ``k`` topics, numbered from 0 by size.

    By the rule ``nearest`` the most similar topics are joined first, many in a round; by
    ``smallest`` the smallest topic goes into its most similar one, one a round.
    """
    merge = {"nearest": merge_nearest, "smallest": merge_topics}[rule]
    mapping = merge(class_counts(docs, assigned), topic_sizes(assigned), k)
    merged = lookup_join(assigned, mapping, "topic", how="inner").select("id", F.col("merged").alias("topic"))
    order = Window.orderBy(F.desc("size"), "topic")  # at most k rows
    numbers = topic_sizes(merged).where("topic != -1").select("topic", (F.row_number().over(order) - 1).alias("n"))
    return merged.join(F.broadcast(numbers), "topic", "left").select(
        "id", F.coalesce("n", F.lit(-1)).cast("int").alias("topic")
    )


# -- soft weights ------------------------------------------------------------------


def centroids(coords: DataFrame, assigned: DataFrame, dims: int) -> DataFrame:
    """``(topic, centroid)`` of every topic but the outliers."""
    means = [F.avg(F.get("coords", F.lit(i))) for i in range(dims)]
    joined = coords.join(assigned.where("topic != -1"), "id")
    return joined.groupBy("topic").agg(F.array(*means).alias("centroid"))


def _closeness(batches: Iterator[pa.RecordBatch], fixed: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and ``1 / (1 + distance)`` to every centre, so many rows at a time that a slice fits
    in about 32 MB whatever the number of centres."""
    square = (fixed**2).sum(1)[None, :]
    step = max(1, 4_000_000 // max(1, len(fixed)))
    for batch in batches:
        points = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for at in range(0, batch.num_rows, step):
            some = points[at : at + step]
            far = (some**2).sum(1)[:, None] + square - 2 * some @ fixed.T
            yield batch.column(0).slice(at, len(some)), 1.0 / (1.0 + np.sqrt(np.maximum(far, 0.0)))


def soft_topics(coords: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """``(id, topic_dist)``: closeness ``1 / (1 + distance)`` to each centre, as shares.

    ``centres`` is topics x dimensions; only that matrix is sent to the tasks. A row holds a
    weight for every topic, so with many topics ``nearest_topics`` is the better form.
    """
    k = len(centres)
    kind = coords.schema["id"].dataType.simpleString()
    if not k:  # no topic, so no weights
        return coords.select("id", F.array().cast("array<double>").alias("topic_dist"))
    fixed = np.asarray(centres, dtype=float)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, close in _closeness(batches, fixed):
            shares = close / close.sum(axis=1, keepdims=True)
            offsets = pa.array(np.arange(0, shares.size + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pa.array(shares.ravel()))], ["id", "topic_dist"])

    return coords.select("id", "coords").mapInArrow(score, f"id {kind}, topic_dist array<double>")


def nearest_topics(coords: DataFrame, centres: Sequence[Sequence[float]], m: int = 16) -> DataFrame:
    """``(id, topics)``: the ``m`` nearest topics of a document as ``(topic, weight)``, nearest first.

    Weights are shares of the closeness to all centres, so they are those of ``soft_topics``,
    which this equals where ``m`` is the number of topics. Equal ones go to the smaller number.
    """
    kind = coords.schema["id"].dataType.simpleString()
    schema = f"id {kind}, topics array<struct<topic:int,weight:double>>"
    if not len(centres):
        return coords.select("id", F.array().cast("array<struct<topic:int,weight:double>>").alias("topics"))
    fixed = np.asarray(centres, dtype=float)
    kept = min(m, len(fixed))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, close in _closeness(batches, fixed):
            # ties at the edge of the m nearest are cut by number too, so all of the same closeness come in
            edge = -np.partition(-close, kept - 1, axis=1)[:, kept - 1 : kept]
            rows, cols = np.nonzero(close >= edge)
            order = np.lexsort((cols, -close[rows, cols], rows))
            rows, cols = rows[order], cols[order]
            first = np.searchsorted(rows, rows)
            inside = np.arange(len(rows)) - first < kept
            rows, cols = rows[inside], cols[inside]
            shares = close[rows, cols] / close.sum(axis=1)[rows]
            pairs = pa.StructArray.from_arrays([pa.array(cols.astype(np.int32)), pa.array(shares)], ["topic", "weight"])
            offsets = pa.array(np.arange(0, len(rows) + 1, kept, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pairs)], ["id", "topics"])

    return coords.select("id", "coords").mapInArrow(score, schema)


def centre_matrix(centres: DataFrame) -> list[list[float]]:
    """Centroids in topic order, for the tasks: topics x dimensions numbers."""
    return [r["centroid"] for r in centres.orderBy("topic").collect()]


def document_topics(coords: DataFrame, assigned: DataFrame, dims: int) -> DataFrame:
    """Soft topic weights from the centroids of the assigned topics."""
    return soft_topics(coords, centre_matrix(centroids(coords, assigned, dims)))
