"""Non-negative matrix factorisation X ~ W H by multiplicative updates (Lee and Seung 2001).

Documents carry their sparse row ``(id, indices, weights)``. H is topics x vocabulary,
bounded by the vocabulary cap, and goes out with each pass; the weights of a document
depend on its own row and H only, so they are solved where the row lies and never
stored. A pass returns the sums W'X and W'W, from which the driver updates H and knows
the error. No state is left on the executors between passes: a lost executor costs the
rows it was working on.

Several topic counts are fitted in the same pass, so a sweep reads the rows as often as
its slowest member does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.config import TopicConfig
from topicloom.operators import topics
from topicloom.operators.features import Lexicon
from topicloom.runtime import array_sums

TINY = 1e-10

#: Sparse entries handled at a time inside a task, to bound its memory.
SLICE_ENTRIES = 200_000

#: Updates of a document's weights in each pass, and of H between passes.
ROW_STEPS = 20
FACTOR_STEPS = 4


@dataclass
class Factors:
    """A fitted model: ``h`` is topics x vocabulary."""

    h: np.ndarray
    errors: list[float] = field(default_factory=list)
    start: float = 0.1
    l1: float = 0.0
    l2: float = 0.0

    @property
    def k(self) -> int:
        return self.h.shape[0]

    @property
    def error(self) -> float:
        return self.errors[-1]


def _row_weights(
    weights: np.ndarray, columns: np.ndarray, bounds: np.ndarray, h: np.ndarray, start: float, l1: float, l2: float, steps: int
) -> np.ndarray:
    """Weights of a slice of documents for a fixed H, from a constant start."""
    n = len(bounds) - 1
    xh = np.zeros((n, h.shape[0]))
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        products = weights[:, None] * h.T[columns]
        xh[filled] = np.add.reduceat(products, bounds[:-1][filled], axis=0)
    hh = h @ h.T
    w = np.full(xh.shape, start)
    for _ in range(steps):
        w *= xh / (w @ hh + l1 + l2 * w + TINY)
    return w


def _slices(batch: pa.RecordBatch, most: int = SLICE_ENTRIES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with at most about ``most`` entries each."""
    index_list = batch.column(batch.schema.get_field_index("indices"))
    weight_list = batch.column(batch.schema.get_field_index("weights"))
    columns = index_list.flatten().to_numpy(zero_copy_only=False)
    weights = weight_list.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(index_list.value_lengths().fill_null(0))
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    row, n = 0, len(lengths)
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + most, side="right")) - 1
        end = min(max(end, row + 1), n)
        lo, hi = bounds[row], bounds[end]
        yield row, end, weights[lo:hi], columns[lo:hi], bounds[row : end + 1] - lo
        row = end


def _pass_sums(rows: DataFrame, models: dict[int, Factors], n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """W'X and W'W of every model in one pass over the rows.

    Tasks return their sums as whole arrays, topics x vocabulary of every model, bounded by the
    cap; Spark adds them up.
    """
    shared = {name: (m.h, m.start, m.l1, m.l2) for name, m in models.items()}

    def partial(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        wx = {name: np.zeros((h.shape[0], n_terms)) for name, (h, *_) in shared.items()}
        ww = {name: np.zeros((h.shape[0], h.shape[0])) for name, (h, *_) in shared.items()}
        for batch in batches:
            for _, _, weights, columns, bounds in _slices(batch):
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                for name, (h, start, l1, l2) in shared.items():
                    w = _row_weights(weights, columns, bounds, h, start, l1, l2, ROW_STEPS)
                    ww[name] += w.T @ w
                    for t in range(h.shape[0]):
                        wx[name][t] += np.bincount(columns, weights * w[owner, t], minlength=n_terms)
        return [row for name in shared for row in (*wx[name], *ww[name])]

    sums = array_sums(rows.select("indices", "weights"), partial)
    out, at = {}, 0
    for name, m in models.items():
        out[name] = np.array(sums[at : at + m.k]), np.array(sums[at + m.k : at + 2 * m.k])
        at += 2 * m.k
    return out


def squared_total(rows: DataFrame) -> DataFrame:
    """One row: number of documents, sum and sum of squares of all entries."""
    add = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    squares = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x * x)
    return rows.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(add).alias("total"), F.sum(squares).alias("squares"))


def _penalties(alpha: float, l1_ratio: float, scale: bool, n_docs: int, n_terms: int) -> tuple[float, float, float, float]:
    """L1 and L2 terms of W, then of H; scaled by the other dimension when asked."""
    for_w = alpha * (n_terms if scale else 1)
    for_h = alpha * (n_docs if scale else 1)
    return for_w * l1_ratio, for_w * (1 - l1_ratio), for_h * l1_ratio, for_h * (1 - l1_ratio)


def fit_many(
    rows: DataFrame,
    n_terms: int,
    ks: Sequence[int],
    alpha: float = 0.0,
    l1_ratio: float = 0.5,
    max_iter: int = 200,
    seed: int = 42,
    scale_penalty: bool = False,
    tolerance: float = 1e-4,
) -> dict[int, Factors]:
    """Fit a model for each topic count, from a random start of the right magnitude.

    ``rows`` should be persisted. A model stops when the error has hardly changed since
    the last pass, measured against its first error.
    """
    stats = squared_total(rows).first()
    n_docs, squares = stats["n_docs"], stats["squares"] or 0.0
    mean = (stats["total"] or 0.0) / max(1, n_docs * n_terms)
    w_l1, w_l2, h_l1, h_l2 = _penalties(alpha, l1_ratio, scale_penalty, n_docs, n_terms)
    models = {}
    for k in ks:
        size = np.sqrt(mean / k)
        start = np.abs(np.random.RandomState(seed).standard_normal((k, n_terms))) * size
        models[k] = Factors(start, start=size, l1=w_l1, l2=w_l2)

    active = dict(models)
    for step in range(max_iter + 1):
        sums = _pass_sums(rows, active, n_terms)
        for k, (wx, ww) in sums.items():
            m = active[k]
            # |X - WH|^2 without building WH
            error = squares - 2 * float((wx * m.h).sum()) + float((ww * (m.h @ m.h.T)).sum())
            m.errors.append(max(error, 0.0) / max(1, n_docs * n_terms))
            settled = len(m.errors) > 1 and m.errors[-2] - m.errors[-1] <= tolerance * m.errors[0]
            if settled or step == max_iter or not m.h.any():
                del active[k]
                continue
            for _ in range(FACTOR_STEPS):
                m.h = m.h * wx / (ww @ m.h + h_l1 + h_l2 * m.h + TINY)
        if not active:
            break
    return models


def fit_nmf(rows: DataFrame, n_terms: int, k: int, **options) -> Factors:
    """Fit one model. If all of H collapses to zero, fit again without penalties."""
    model = fit_many(rows, n_terms, [k], **options)[k]
    if model.h.max(initial=0.0) > TINY:
        return model
    again = {**options, "alpha": 0.0, "max_iter": 2 * options.get("max_iter", 200), "seed": options.get("seed", 42) + 1}
    return fit_many(rows, n_terms, [k], **again)[k]


def sweep(rows: DataFrame, n_terms: int, ks: Sequence[int], **options) -> tuple[DataFrame, Factors]:
    """Mean squared error per topic count, and the model with the lowest."""
    models = fit_many(rows, n_terms, ks, **options)
    for k in ks:
        if models[k].h.max(initial=0.0) <= TINY:
            models[k] = fit_nmf(rows, n_terms, k, **options)
    errors = [models[k].error for k in ks]
    table = topics.sweep_table(rows.sparkSession, ks, errors, largest=False)
    return table, models[topics.chosen_k(table)]


def factor_table(spark: SparkSession, model: Factors, lexicon: Lexicon) -> DataFrame:
    """H in long form: ``(topic_id, word, weight)``, topics x vocabulary rows."""
    import pandas as pd

    k, n = model.h.shape
    frame = pd.DataFrame(
        {
            "topic_id": np.repeat(np.arange(k, dtype=np.int32), n),
            "word": np.tile(np.array(lexicon.terms, dtype=object), k),
            "weight": model.h.ravel(),
        }
    )
    return spark.createDataFrame(frame, "topic_id int, word string, weight double")


def topic_words(spark: SparkSession, model: Factors, lexicon: Lexicon, n: int = 15) -> DataFrame:
    return topics.rank_words(factor_table(spark, model, lexicon), n)


def document_weights(rows: DataFrame, model: Factors, steps: int = 200) -> DataFrame:
    """``(id, topic_dist)``: the weights of each document for the fitted H."""
    h, start, l1, l2 = model.h, model.start, model.l1, model.l2

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, weights, columns, bounds in _slices(batch):
                w = _row_weights(weights, columns, bounds, h, start, l1, l2, steps)
                flat = pa.array(w.ravel())
                offsets = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32))
                ids = batch.column(batch.schema.get_field_index("id")).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, flat)], ["id", "topic_dist"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "indices", "weights").mapInArrow(solve, f"id {kind}, topic_dist array<double>")


def document_topics(rows: DataFrame, model: Factors) -> DataFrame:
    """Weights of each document as shares."""
    return topics.normalise_topics(document_weights(rows, model))


# -- the same algebra on long tables ------------------------------------------------


def update_step(
    x: DataFrame, w: DataFrame, h: DataFrame, l1_w: float = 0.0, l2_w: float = 0.0, l1_h: float = 0.0, l2_h: float = 0.0
) -> tuple[DataFrame, DataFrame]:
    """One multiplicative update of W, then of H, on long tables.

    ``x`` is ``(id, term_id, weight)``, ``w`` is ``(id, topic_id, value)`` and ``h`` is
    ``(term_id, topic_id, value)``, both with all their cells.
    """
    xh = _product(x, h, "term_id", "id")
    whh = _through(w, _gram(h, "term_id"), "id")
    new_w = _ratio_update(w, xh, whh, "id", l1_w, l2_w)
    wx = _product(x, new_w, "id", "term_id")
    wwh = _through(h, _gram(new_w, "id"), "term_id")
    return new_w, _ratio_update(h, wx, wwh, "term_id", l1_h, l2_h)


def _product(x: DataFrame, factor: DataFrame, inner: str, outer: str) -> DataFrame:
    joined = x.join(factor, inner)
    return joined.groupBy(outer, "topic_id").agg(F.sum(F.col("weight") * F.col("value")).alias("top"))


def _gram(factor: DataFrame, key: str) -> DataFrame:
    """Topics x topics products, from one array of topic values per key."""
    row = factor.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("topic_id", "value"))).alias("row"))
    left = row.select("row", F.explode("row").alias("l"))
    both = left.select("l", F.explode("row").alias("r"))
    return both.groupBy(F.col("l.topic_id").alias("topic_id"), F.col("r.topic_id").alias("other")).agg(
        F.sum(F.col("l.value") * F.col("r.value")).alias("g")
    )


def _through(factor: DataFrame, gram: DataFrame, key: str) -> DataFrame:
    """Factor times the topics x topics table, which has k * k rows."""
    joined = factor.withColumnRenamed("topic_id", "other").join(F.broadcast(gram), "other")
    return joined.groupBy(key, "topic_id").agg(F.sum(F.col("value") * F.col("g")).alias("bottom"))


def _ratio_update(factor: DataFrame, top: DataFrame, bottom: DataFrame, key: str, l1: float, l2: float) -> DataFrame:
    keys = [key, "topic_id"]
    divisor = F.col("bottom") + l1 + l2 * F.col("value") + TINY
    return (
        factor.join(top, keys, "left")
        .join(bottom, keys)
        .select(*keys, (F.col("value") * F.coalesce("top", F.lit(0.0)) / divisor).alias("value"))
    )


def reconstruction_error(x: DataFrame, w: DataFrame, h: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row: mean squared error of X - WH, without building WH."""
    squares = x.agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).scalar()
    xh = _product(x, h, "term_id", "id")
    cross = xh.join(w, ["id", "topic_id"]).agg(F.sum(F.col("top") * F.col("value")).alias("c")).scalar()
    grams = _gram(w, "id").join(_gram(h, "term_id").withColumnRenamed("g", "g2"), ["topic_id", "other"])
    return grams.agg(F.sum(F.col("g") * F.col("g2")).alias("gg")).select(
        ((squares - 2 * cross + F.col("gg")) / (n_docs * n_terms)).alias("error")
    )
