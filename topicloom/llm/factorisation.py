"""Document quality by a factorisation machine over hashed words, structure and metadata.

``y = w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. The pairwise sum is computed as
``(|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2``, so scoring is linear in the number of features.
Features are distinct hashed words scaled to unit length, statistics of the text's
structure in bins, and the length that the table states (``n_chars``) in bins.

Defined cases: null and empty texts have only structure features and get the score these
imply; a null or missing ``n_chars`` is a bin of its own; equal rows score equally. Without
labelled documents every score is 0.5. ``sample`` bounds the labelled documents used for
fitting; scoring covers all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import Spans, byte_set, column, lower_bytes, slices
from topicloom.llm.labelled import label_sample, labelled_texts, one_row

_SYMBOLS = byte_set(b"#*$%&|<>@^~=_+{}[]\\/")
_MARKS = byte_set(b"!?")
_CAPITALS = byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = byte_set(b"0123456789")

#: Upper edges of the bins of every share, and of counts as powers of two.
_EDGES = np.array([0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99])
_BINS = 24
_STATISTICS = 11


@dataclass(frozen=True)
class QualityFit:
    """``rank`` is the length of the factors, ``sample`` bounds the labelled documents."""

    buckets: int = 1 << 18
    rank: int = 8
    sample: int = 12_000
    epochs: int = 8
    batch: int = 64
    rate: float = 0.1
    penalty: float = 1e-5
    scale: float = 0.5

    @property
    def size(self) -> int:
        return self.buckets + _STATISTICS * _BINS


@dataclass(frozen=True)
class QualityModel:
    base: float
    weights: np.ndarray
    factors: np.ndarray


def document_features(text: str | None, n_chars: int | None, how: QualityFit) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of one document."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    spans = Spans(lower_bytes(text))
    words = spans.hashes()
    n, size = len(words), max(len(raw), 1)
    distinct = np.unique(words)
    lines = [x for x in text.split("\n") if x.strip()]
    if n >= 3:
        windows = words[:-2] + words[1:-1] * np.uint64(3) + words[2:] * np.uint64(5)
        repeated = 1 - len(np.unique(windows)) / len(windows)
    else:
        repeated = 0.0
    power = lambda x: min(int(np.log2(x + 1)), _BINS - 1)
    share = lambda x: int(np.searchsorted(_EDGES, x))
    bins = [
        power(n),
        power(len(lines)),
        min(int(len(raw) / n) if n else 0, _BINS - 1),
        share(len(distinct) / n if n else 0.0),
        share(repeated),
        share(float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0),
        share(_SYMBOLS[raw].sum() / size),
        share(_MARKS[raw].sum() / size),
        share(_CAPITALS[raw].sum() / size),
        share(_DIGITS[raw].sum() / size),
        _BINS - 1 if n_chars is None else min(power(max(n_chars, 0)), _BINS - 2),
    ]
    ids = np.concatenate(
        [(distinct % np.uint64(how.buckets)).astype(np.int64), how.buckets + np.arange(_STATISTICS) * _BINS + bins]
    )
    values = np.full(len(ids), how.scale)
    values[: len(distinct)] = 1 / np.sqrt(max(len(distinct), 1))
    return ids, values


def raw_scores(model: QualityModel, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The machine's value for each document, by the identity of the sum of squares."""
    ids = np.concatenate([f[0] for f in features])
    values = np.concatenate([f[1] for f in features])
    heads = np.concatenate([[0], np.cumsum([len(f[0]) for f in features])[:-1]])
    scaled = model.factors[ids] * values[:, None]
    sums = np.add.reduceat(scaled, heads, axis=0)
    squares = np.add.reduceat((scaled * scaled).sum(axis=1), heads)
    return model.base + np.add.reduceat(model.weights[ids] * values, heads) + ((sums**2).sum(axis=1) - squares) / 2


def fit(documents: list[tuple[np.ndarray, np.ndarray, int]], how: QualityFit) -> QualityModel:
    """Logistic loss by adaptive gradient steps over small batches."""
    chance = np.random.default_rng(11)
    base, weights = 0.0, np.zeros(how.size)
    factors = chance.normal(0, 0.05, (how.size, how.rank))
    total_w, total_v, total_b = np.zeros(how.size), np.zeros((how.size, how.rank)), 0.0
    for _ in range(how.epochs if documents else 0):
        order = chance.permutation(len(documents))
        for start in range(0, len(order), how.batch):
            chosen = [documents[i] for i in order[start : start + how.batch]]
            ids, values = np.concatenate([d[0] for d in chosen]), np.concatenate([d[1] for d in chosen])
            counts = np.array([len(d[0]) for d in chosen])
            heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
            scaled = factors[ids] * values[:, None]
            sums = np.add.reduceat(scaled, heads, axis=0)
            squares = np.add.reduceat((scaled * scaled).sum(axis=1), heads)
            y = base + np.add.reduceat(weights[ids] * values, heads) + ((sums**2).sum(axis=1) - squares) / 2
            slope = (1 / (1 + np.exp(-y)) - np.array([d[2] for d in chosen])) / len(chosen)
            each = np.repeat(slope, counts) * values
            touched, place = np.unique(ids, return_inverse=True)
            step = np.bincount(place, weights=each) + how.penalty * weights[touched]
            total_w[touched] += step * step
            weights[touched] -= how.rate * step / (np.sqrt(total_w[touched]) + 1e-8)
            pull = each[:, None] * (np.repeat(sums, counts, axis=0) - scaled)
            step = np.stack([np.bincount(place, weights=pull[:, f]) for f in range(how.rank)], axis=1)
            step += how.penalty * factors[touched]
            total_v[touched] += step * step
            factors[touched] -= how.rate * step / (np.sqrt(total_v[touched]) + 1e-8)
            total_b += slope.sum() ** 2
            base -= how.rate * slope.sum() / (total_b**0.5 + 1e-8)
    if not documents:
        factors[:] = 0
    return QualityModel(base, weights.astype(np.float32), factors.astype(np.float32))


def _with_length(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("long"))


def train(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2, how: QualityFit = QualityFit()):
    """Fit on the labelled documents outside the held-out fold; features are made in tasks."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            made = [document_features(t, n, how) for t, n in zip(column(batch, "text"), column(batch, "n_chars"))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column(batch, "doc_id"), pa.int64()),
                    pa.array(column(batch, "y"), pa.int32()),
                    pa.array([m[0].astype("<u4").tobytes() for m in made], pa.binary()),
                ],
                ["doc_id", "y", "features"],
            )

    sample = label_sample(labels, "quality", parts, held_out, how.sample)
    made = labelled_texts(_with_length(docs), sample, "text", "n_chars").mapInArrow(
        features, "doc_id bigint, y int, features binary"
    )
    rows = one_row(made, "features").toArrow().sort_by("doc_id")
    documents = []
    for packed, y in zip(rows.column("features").to_pylist(), rows.column("y").to_pylist()):
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        values = np.full(len(ids), how.scale)
        values[: len(ids) - _STATISTICS] = 1 / np.sqrt(max(len(ids) - _STATISTICS, 1))
        documents.append((ids, values, y))
    return fit(documents, how)


def score(docs: DataFrame, model: QualityModel, how: QualityFit = QualityFit()) -> DataFrame:
    """``(doc_id, score)`` of every row; the model's size is fixed by its parameters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            made = [document_features(t, n, how) for t, n in zip(column(batch, "text"), column(batch, "n_chars"))]
            values = 1 / (1 + np.exp(-np.clip(raw_scores(sent.value, made), -60, 60)))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(values, pa.float64())], ["doc_id", "score"])

    rows = _with_length(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chars")
    return rows.mapInArrow(rate, "doc_id bigint, score double")
