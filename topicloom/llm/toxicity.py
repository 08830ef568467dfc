"""Toxic documents by multiple-instance learning over sentences.

Only documents carry labels. A sentence has the probability ``sigmoid(b + sum w)`` over its
distinct hashed features (words and their first bytes); a document is toxic if any of its
sentences is, so its probability is the noisy-or ``1 - prod(1 - p)``. The gradient of the
document's loss reaches each sentence through that product, which is what teaches the
weights to point at the offending sentences. These are returned with the score.

Sentences end at ``.``, ``!``, ``?`` and line ends, and after 60 words.

Defined cases: null and empty texts have no sentence and score 0; equal texts score
equally; without labelled documents every score is near 0. ``sample`` bounds the labelled
documents used for fitting; scoring covers all rows and whole texts. Columns other than
id and text are no input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import Spans, byte_set, column, lower_bytes, slices
from topicloom.llm.labelled import adagrad, label_sample, labelled_texts, one_row

_LETTERS = byte_set(bytes([*b"abcdefghijklmnopqrstuvwxyz0123456789'", *range(128, 256)]))
_ENDS = byte_set(b".!?\n")


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class ToxicityFit:
    """``sample`` bounds the labelled documents. Features found in fewer than ``support`` of
    them are not learned, since a document's own rare words would explain its label; nor are
    those whose documents' log-odds rise by less than ``clear``, since common words would add
    up over a sentence and hide its signs.
    ``start`` is the first bias of a sentence."""

    buckets: int = 1 << 20
    prefixes: tuple[int, ...] = (4, 5)
    longest: int = 60
    sample: int = 12_000
    support: int = 4
    clear: float = 2.0
    epochs: int = 12
    batch: int = 64
    rate: float = 0.3
    penalty: float = 1e-6
    start: float = -6.0


def sentences(text: str | None, how: ToxicityFit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids in sentence order, features per sentence, and the sentences' byte ranges."""
    spans = Spans(lower_bytes(text), _LETTERS)
    if not len(spans):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    ends = np.cumsum(_ENDS[spans.bytes])[spans.starts]
    first = np.concatenate([[True], ends[1:] != ends[:-1]])
    index = np.arange(len(spans))
    place = index - np.maximum.accumulate(np.where(first, index, 0))
    first |= place % how.longest == 0
    number = np.cumsum(first) - 1
    found = [spans.hashes()]
    for size in how.prefixes:
        long = spans.ends - spans.starts > size
        found.append(np.where(long, spans.hashes(spans.starts, np.minimum(spans.ends, spans.starts + size)), found[0]))
    ids = np.concatenate([f % np.uint64(how.buckets) for f in found]).astype(np.int64)
    keys = np.unique(np.tile(number, len(found)) * how.buckets + ids)
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:] - 1, [len(spans) - 1]])
    return keys % how.buckets, np.bincount(keys // how.buckets), spans.starts[at], spans.ends[last]


def _first_weights(documents: list[tuple[np.ndarray, np.ndarray, int]], how: ToxicityFit):
    """Start from the shrunk log-odds of a feature's documents; and which features to learn."""
    seen, toxic = np.zeros(how.buckets + 1), np.zeros(how.buckets + 1)
    for features, _, y in documents:
        once = np.unique(features)
        seen[once] += 1
        toxic[once] += y
    share = max(sum(d[2] for d in documents), 0.5) / max(len(documents), 1)
    odds = lambda a, n: np.log(a / (n - a))
    weights = odds(toxic + 4 * share, seen + 4) - odds(share, 1) if 0 < share < 1 else np.zeros(how.buckets + 1)
    known = (seen >= how.support) & (weights > how.clear)
    return np.where(known, weights, 0.0), known


def fit(documents: list[tuple[np.ndarray, np.ndarray, int]], how: ToxicityFit) -> ToxicityModel:
    """Weights from ``(features, features per sentence, label)`` of each document."""
    documents = [d for d in documents if len(d[1])]
    weights, known = _first_weights(documents, how)
    # features that aren't learned share one slot, whose weight stays 0
    documents = [(np.where(known[f], f, how.buckets).astype(np.int32), s, y) for f, s, y in documents]
    totals, bias, total = np.zeros(how.buckets + 1), np.array([how.start]), np.zeros(1)
    order = np.random.default_rng(7)
    for _ in range(how.epochs if documents else 0):
        shuffled = order.permutation(len(documents))
        for start in range(0, len(shuffled), how.batch):
            chosen = [documents[i] for i in shuffled[start : start + how.batch]]
            features = np.concatenate([d[0] for d in chosen])
            sizes = np.concatenate([d[1] for d in chosen])
            heads = np.concatenate([[0], np.cumsum([len(d[1]) for d in chosen])[:-1]])
            z = bias[0] + np.add.reduceat(weights[features], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            none = np.add.reduceat(np.logaddexp(0, z), heads)  # minus the log that no sentence is toxic
            toxic = np.array([d[2] for d in chosen]) == 1
            slope = np.where(toxic, -1 / np.maximum(np.expm1(np.minimum(none, 50)), 1e-3), 1.0)
            gradient = np.repeat(slope, [len(d[1]) for d in chosen]) / (1 + np.exp(-z)) / len(chosen)
            touched, place = np.unique(features, return_inverse=True)
            step = np.bincount(place, weights=np.repeat(gradient, sizes)) + how.penalty * weights[touched]
            totals[touched] += step * step
            weights[touched] -= how.rate * step / (np.sqrt(totals[touched]) + 1e-8)
            weights[how.buckets] = 0
            adagrad(bias, total, np.array([gradient.sum()]), how.rate / 10)
    return ToxicityModel(weights[: how.buckets].astype(np.float32), float(bias[0]))


def train(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, how: ToxicityFit = ToxicityFit()):
    """Fit on the labelled documents outside the held-out fold; features are made in tasks."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            made = [sentences(t, how) for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column(batch, "doc_id"), pa.int64()),
                    pa.array(column(batch, "y"), pa.int32()),
                    pa.array([m[0].astype("<u4").tobytes() for m in made], pa.binary()),
                    pa.array([m[1].astype("<u4").tobytes() for m in made], pa.binary()),
                ],
                ["doc_id", "y", "features", "sizes"],
            )

    sample = label_sample(labels, "toxic", parts, held_out, how.sample)
    made = labelled_texts(docs, sample, "text").mapInArrow(
        features, "doc_id bigint, y int, features binary, sizes binary"
    )
    rows = one_row(made, "features", "sizes").toArrow().sort_by("doc_id")
    unpack = lambda x: np.frombuffer(x, "<i4")
    return fit(
        [
            (unpack(f), unpack(s), y)
            for f, s, y in zip(*(rows.column(c).to_pylist() for c in ("features", "sizes", "y")))
        ],
        how,
    )


def score(docs: DataFrame, model: ToxicityModel, how: ToxicityFit = ToxicityFit(), offending: float = 0.5) -> DataFrame:
    """``(doc_id, score, sentences)`` of every row; sentences with probability of at least
    ``offending`` come as ``(start, end, score, sentence)``, with UTF-8 byte offsets."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value.weights.astype(np.float64), sent.value.bias
        for batch in slices(batches, 128):
            scores, found = [], []
            for text in column(batch, "text"):
                features, sizes, starts, ends = sentences(text, how)
                if not len(sizes):
                    scores.append(0.0)
                    found.append([])
                    continue
                z = bias + np.add.reduceat(weights[features], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())))
                each = 1 / (1 + np.exp(-z))
                raw = text.encode("utf-8", "surrogatepass") if (each >= offending).any() else b""
                found.append(
                    [
                        {
                            "start": int(starts[i]), "end": int(ends[i]), "score": float(each[i]),
                            "sentence": raw[starts[i] : ends[i]].decode("utf-8", "replace"),
                        }
                        for i in np.flatnonzero(each >= offending)
                    ]
                )
            kind = pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("sentence", pa.string())])
            )
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "sentences"]
            )

    schema = "doc_id bigint, score double, sentences array<struct<start: bigint, end: bigint, score: double, sentence: string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rate, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, how: ToxicityFit = ToxicityFit()) -> DataFrame:
    """The rows of ``docs`` whose score lies below ``threshold``, with all their columns.

    The filter runs over the text in place, so that no text is shuffled.
    """
    model = train(docs, labels, how=how)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value.weights.astype(np.float64), sent.value.bias
        for batch in slices(batches, 128):
            kept = []
            for text in column(batch, "text"):
                features, sizes, _, _ = sentences(text, how)
                heads = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                z = bias + np.add.reduceat(weights[features], heads) if len(sizes) else np.zeros(0)
                kept.append(-np.expm1(-np.logaddexp(0, z).sum()) < threshold)
            if any(kept):
                yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
