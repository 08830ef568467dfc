"""Topic coherence: c_v, c_npmi, c_uci and u_mass.

Probabilities are shares of sliding windows over the whole corpus (of documents, for
u_mass). The counting is one pass over the documents and writes no window as a row: every
occurrence of a top word covers a range of window starts, and between two ends of such
ranges the set of words in a window does not change. A stretch of windows is therefore
counted at once, so the cost follows the number of occurrences. Only positions of top words
leave the JVM. The top words of all topics are a bounded list (topics x words) and travel with
the tasks; each task returns topics x words x words sums, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.runtime import cut_lineage

EPSILON = 1e-12

#: Window sizes of the sliding-window measures.
WINDOWS = {"c_v": 110, "c_uci": 10, "c_npmi": 10}

#: Occurrences handled at a time inside a task, to bound its memory. Documents stay whole.
SLICE_HITS = 300_000


def _topic_lists(topic_words: DataFrame) -> list[tuple[int, list[str]]]:
    """Ranked words of each topic. Topics x words is bounded by the parameters."""
    rows = topic_words.select("topic_id", "rank", "word").collect()
    lists: dict[int, list[tuple[int, str]]] = {}
    for r in rows:
        lists.setdefault(r["topic_id"], []).append((r["rank"], r["word"]))
    return [(t, [w for _, w in sorted(words)]) for t, words in sorted(lists.items())]


def _starts_covered(
    token_docs: np.ndarray, positions: np.ndarray, lengths: np.ndarray, window: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last window start that sees each occurrence.

    Starts are numbered through all documents of the slice, so ranges of different
    documents never meet. Without a window a document is one single window.
    """
    last = np.zeros(len(lengths), dtype=np.int64) if window is None else np.maximum(0, lengths - window)
    base = np.cumsum(last + 1) - (last + 1)
    if window is None:
        first = base[token_docs]
        return first, first + 1
    first = base[token_docs] + np.maximum(0, positions - window + 1)
    return first, base[token_docs] + np.minimum(positions, last[token_docs]) + 1


def _windows_shared(first: np.ndarray, end: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Windows with both words, for every two of ``n`` words; ``rank`` is the word of a range."""
    edges = np.unique(np.concatenate([first, end]))
    cells = len(edges) * n
    opened = np.bincount(np.searchsorted(edges, first) * n + rank, minlength=cells)
    closed = np.bincount(np.searchsorted(edges, end) * n + rank, minlength=cells)
    inside = (np.cumsum((opened - closed).reshape(-1, n), axis=0) > 0)[:-1].astype(float)
    return inside.T @ (inside * np.diff(edges)[:, None])


def postings(docs: DataFrame, words: Sequence[str]) -> DataFrame:
    """``(n_tokens, positions, words)``: where the given words stand in each document.

    All other tokens stay in the JVM; only these short lists go on to where windows are counted.
    """
    placed = F.transform("tokens", lambda t, i: F.when(t.isin(list(words)), F.struct(i.alias("pos"), t.alias("word"))))
    hits = docs.select(F.greatest(F.size("tokens"), F.lit(0)).alias("n_tokens"), F.array_compact(placed).alias("hits"))
    return hits.select("n_tokens", F.col("hits.pos").alias("positions"), F.col("hits.word").alias("words"))


def pair_counts(docs: DataFrame, topic_words: DataFrame, window: int | None) -> DataFrame:
    """``(topic_id, rank_i, rank_j, n)``: windows with both words, zero counts left out.

    The diagonal holds the windows of a word itself. ``window=None`` counts documents.
    The row with a missing topic holds the number of all windows; a document shorter than
    the window has one.
    """
    lists = _topic_lists(topic_words)
    words = sorted({w for _, topic in lists for w in topic})
    index = {w: i for i, w in enumerate(words)}
    kinds = pa.schema([("topic_id", pa.int32()), ("rank_i", pa.int32()), ("rank_j", pa.int32()), ("n", pa.int64())])
    members = [(t, np.array([index[w] for w in ws])) for t, ws in lists]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.string())
        sums = [np.zeros((len(ws), len(ws))) for _, ws in members]
        windows = 0
        for batch in batches:
            all_lengths = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            hits = np.asarray(batch.column(1).value_lengths().fill_null(0), dtype=np.int64)
            places = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            codes = pc.index_in(batch.column(2).flatten(), value_set=known).to_numpy(zero_copy_only=False)
            ends = np.cumsum(hits)
            windows += len(all_lengths) if window is None else int(np.maximum(1, all_lengths - window + 1).sum())
            row = 0
            while row < len(all_lengths):
                offset = ends[row] - hits[row]
                stop = max(row + 1, int(np.searchsorted(ends, offset + SLICE_HITS, side="right")))
                lengths = all_lengths[row:stop]
                code, positions = codes[offset : ends[stop - 1]], places[offset : ends[stop - 1]]
                token_docs = np.repeat(np.arange(len(lengths)), hits[row:stop])
                first, end = _starts_covered(token_docs, positions, lengths, window)
                order = np.argsort(code, kind="stable")
                bounds = np.searchsorted(code[order], np.arange(len(words) + 1))
                for total, (_, ws) in zip(sums, members):
                    parts = [order[bounds[w] : bounds[w + 1]] for w in ws]
                    own = np.concatenate(parts)
                    if len(own):
                        rank = np.repeat(np.arange(len(ws)), [len(p) for p in parts])
                        total += _windows_shared(first[own], end[own], rank, len(ws))
                row = stop
        out = [(None, None, None, windows)]
        for total, (topic, _) in zip(sums, members):
            out += [(topic, i + 1, j + 1, round(total[i, j])) for i, j in zip(*np.nonzero(total))]
        yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in out], schema=kinds)

    parts = postings(docs, words).mapInArrow(count, "topic_id int, rank_i int, rank_j int, n long")
    return parts.groupBy("topic_id", "rank_i", "rank_j").agg(F.sum("n").alias("n"))


def pair_scores(docs: DataFrame, topic_words: DataFrame, window: int | None) -> DataFrame:
    """``(topic_id, rank_i, rank_j, p_i, p_j, p_ij)`` for every ordered pair of top words.

    Pairs that never meet have probability 0; so has a word that never occurs.
    """
    counts = cut_lineage(pair_counts(docs, topic_words, window))  # topics x words x words rows
    total = counts.where(F.col("topic_id").isNull()).select("n").scalar()
    ranks = topic_words.groupBy("topic_id").agg(F.collect_set("rank").alias("ranks"))
    grid = ranks.select("topic_id", "ranks", F.explode("ranks").alias("rank_i")).select(
        "topic_id", "rank_i", F.explode("ranks").alias("rank_j")
    )
    filled = grid.join(counts, ["topic_id", "rank_i", "rank_j"], "left").na.fill(0, ["n"])
    alone = F.col("rank_i") == F.col("rank_j")
    of_i = Window.partitionBy("topic_id", "rank_i")
    of_j = Window.partitionBy("topic_id", "rank_j")
    own = F.when(alone, F.col("n"))
    return filled.select(
        "topic_id",
        "rank_i",
        "rank_j",
        (F.max(own).over(of_i) / total).alias("p_i"),
        (F.max(own).over(of_j) / total).alias("p_j"),
        (F.col("n") / total).alias("p_ij"),
    )


def _pmi() -> Column:
    joint = F.col("p_ij") + EPSILON
    return F.log(joint / (F.col("p_i") * F.col("p_j")))


def _known() -> Column:
    return (F.col("p_i") > 0) & (F.col("p_j") > 0)


def _npmi() -> Column:
    bottom = -F.log(F.col("p_ij") + EPSILON)
    value = F.when(F.abs(bottom) < EPSILON, F.lit(1.0)).otherwise(_pmi() / F.nullif(bottom, F.lit(0.0)))
    return F.when(_known(), value).otherwise(F.lit(0.0))


def topic_coherence(docs: DataFrame, topic_words: DataFrame, measure: str = "c_v") -> DataFrame:
    """``(topic_id, coherence)``.

    A word that never occurs scores 0 with every other word. For c_v each word has the
    vector of its NPMI with all top words of the topic, and is compared with the sum of
    these vectors by cosine. For u_mass the higher-ranked word is the condition.
    """
    if measure == "u_mass":
        scores = pair_scores(docs, topic_words, None).where("rank_i > rank_j")
        value = F.when(_known(), F.log((F.col("p_ij") + EPSILON) / F.col("p_j"))).otherwise(F.lit(0.0))
        return scores.groupBy("topic_id").agg(F.avg(value).alias("coherence"))
    if measure not in WINDOWS:
        raise ValueError(f"unknown coherence measure {measure!r}")
    scores = pair_scores(docs, topic_words, WINDOWS[measure])
    if measure == "c_v":
        return _cosine_coherence(scores.withColumn("npmi", _npmi()))
    value = _npmi() if measure == "c_npmi" else F.when(_known(), _pmi()).otherwise(F.lit(0.0))
    return scores.where("rank_i < rank_j").groupBy("topic_id").agg(F.avg(value).alias("coherence"))


def _cosine_coherence(scores: DataFrame) -> DataFrame:
    column = F.sum("npmi").over(Window.partitionBy("topic_id", "rank_j"))
    per_word = scores.withColumn("total", column).groupBy("topic_id", "rank_i").agg(
        F.sum(F.col("npmi") * F.col("total")).alias("dot"),
        F.sqrt(F.sum(F.col("npmi") * F.col("npmi"))).alias("own"),
        F.sqrt(F.sum(F.col("total") * F.col("total"))).alias("all"),
    )
    cosine = F.coalesce(F.col("dot") / F.nullif(F.col("own") * F.col("all"), F.lit(0.0)), F.lit(0.0))
    return per_word.groupBy("topic_id").agg(F.avg(cosine).alias("coherence"))


def model_coherence(docs: DataFrame, topic_words: DataFrame, measure: str = "c_v") -> DataFrame:
    """One row: the mean over the topics."""
    return topic_coherence(docs, topic_words, measure).agg(F.avg("coherence").alias("coherence"))
