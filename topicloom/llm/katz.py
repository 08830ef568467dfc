"""Katz backoff language model over words, counted, stored and evaluated as tables.

Counts ``r`` up to ``most`` are discounted by Good-Turing factors; what the discounts free
after a history is given to the words not seen after it, in proportion to the lower order,
with weights that make every distribution sum to 1 exactly. The lowest order leaves its
freed mass to one class of unknown words. A text is scored token by token: the pair's
discounted probability where it was seen, else the backoff weight times the next order's.

Words and pairs are known by 64-bit hashes. Documents are written once as chunks of about a
million tokens, each with its own word list, in the bytes its numbers need. A chunk asks for the
counts of its distinct words and pairs, dealt into parts by their hashes: sorted keys go out as
differences, counts come back in the same order. So a pair costs six or seven bytes of shuffle
for each chunk it occurs in, and the same exchange that counts it in training also answers for
the texts to be scored. One chunk of a part is named the owner of a pair and adds it to the sums
of its history.

Where the counts of counts don't give factors between 0 and 1, absolute discounting by
``n1 / (n1 + 2 n2)`` (or 0.5) takes their place. A history whose discounts free nothing
gives up ``1 / (c + 1)``, and so does the lowest order.

Defined cases: null and empty texts hold the end token alone; a null id is in no fold and
is used for learning; repeated rows count and score as often as they occur; an empty
training set gives every text a score of 0. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm.common import Spans, column, fold, lower_bytes, mixed, slices
from topicloom.runtime import shared_path

#: Stand-ins for the start of a text, as history only, and for its end, as token only.
START, END = 1, 2

#: Tokens of a chunk, beyond which it takes no further document.
CHUNK_TOKENS = 1 << 20

#: Parts of the keys' hashes, at least; a part holds about the keys of two chunks.
LEAST_PARTS = 24


@dataclass(frozen=True)
class KatzModel:
    """``pairs`` and ``words`` are ``(part, size, keys, counts)``, a row for each of ``parts``;
    ``histories`` is ``(h, alpha, keep)``, both in base 10. ``tokens`` and ``types`` are totals,
    ``low`` and ``high`` the factors of words and pairs, ``unknown`` the class of unseen words,
    ``share`` what a discounted count of a word is worth."""

    pairs: DataFrame | None
    words: DataFrame | None
    histories: DataFrame | None
    parts: int
    tokens: int
    types: int
    low: list[float]
    high: list[float]
    unknown: float
    share: float


#: Lets Spark delete a write's shuffle files as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the shared folder, leaving no shuffle files, and go on from the files."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


# -- numbers in few bytes ----------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs, all lowest bytes first."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    if size:
        planes = np.frombuffer(data, np.uint8).reshape(-1, size)
        out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel()


def _first_key(part: int, parts: int) -> int:
    """Smallest key of a part."""
    return -(-(part << 32) // parts) << 32


def _dealt(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted keys, and their end."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _key_bytes(keys: np.ndarray, part: int, parts: int) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(_first_key(part, parts))))


def _keys(data: bytes, size: int, part: int, parts: int) -> np.ndarray:
    return np.cumsum(unpacked(data, size)) + np.uint64(_first_key(part, parts))


# -- chunks ------------------------------------------------------------------------

_CHUNK = "chunk bigint, ids array<bigint>, learn binary, lengths binary, size int, words binary, tokens binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Tokens of ``(doc_id, text, learn)`` as numbers in their chunk's sorted word list."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 12, [], 0
        for batch in slices(batches, 128):
            for doc_id, text, learn in zip(column(batch, "doc_id"), column(batch, "text"), column(batch, "learn")):
                tokens = np.append(Spans(lower_bytes(text)).hashes(), np.uint64(END))
                held.append((doc_id, learn, tokens))
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield one(chunk, held)
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield one(chunk, held)

    def one(chunk: int, held: list) -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True)
        row = {
            "chunk": chunk, "ids": [x[0] for x in held], "learn": packed(np.array([x[1] for x in held])),
            "lengths": packed(np.array([len(x[2]) for x in held])), "size": len(words),
            "words": packed(np.diff(words, prepend=np.uint64(0))), "tokens": packed(tokens),
        }
        return pa.RecordBatch.from_pylist([row], _SCHEMA)

    found = docs.select("doc_id", "text", "learn").mapInArrow(encode, _CHUNK)
    return _written(found, "katz_chunks")


_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("learn", pa.binary()), ("lengths", pa.binary()),
     ("size", pa.int32()), ("words", pa.binary()), ("tokens", pa.binary())]
)


class _Chunk:
    """A chunk's documents, words and tokens; the end before a text stands for its start."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        docs = len(self.ids)
        self.learn = unpacked(row["learn"], docs).astype(bool)
        self.lengths = unpacked(row["lengths"], docs).astype(np.int64)
        self.words = np.cumsum(unpacked(row["words"], row["size"]))
        self.tokens = unpacked(row["tokens"], int(self.lengths.sum())).astype(np.int64)
        end = np.searchsorted(self.words, np.uint64(END))
        self.before = np.append(end, self.tokens[:-1])
        self.histories = self.words.copy()
        self.histories[end] = START

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the distinct pairs, where each is first, and the pair of every token."""
        keys = mixed(self.histories[self.before] * np.uint64(3) + self.words[self.tokens])
        return np.unique(keys, return_index=True, return_inverse=True)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# -- counts ------------------------------------------------------------------------

_ASK = "chunk bigint, part int, size int, keys binary, counts binary"
_ANSWER = "chunk bigint, part int, size int, keys binary, counts binary, tally array<bigint>"


def _asks(chunks: DataFrame, parts: int, of_pairs: bool) -> DataFrame:
    """A row for each chunk and part: its distinct words or pairs, and their counts in training."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            keys, _, at = chunk.pairs() if of_pairs else (chunk.words, None, chunk.tokens)
            learn = np.repeat(chunk.learn, chunk.lengths)
            counts = np.bincount(at[learn], minlength=len(keys))
            bounds = _dealt(keys, parts)
            out = [
                (row["chunk"], p, int(hi - lo), _key_bytes(keys[lo:hi], p, parts), packed(counts[lo:hi]))
                for p, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:]))
                if hi > lo
            ]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "size", "keys", "counts"])

    return chunks.mapInArrow(ask, _ASK)


def _answers(asks: DataFrame, parts: int, most: int, table: bool, name: str) -> DataFrame:
    """Twice the count of every key of every ask, plus 1 for one ask among those of a key.

    Each part also has a row without a chunk, with its ``tally``: distinct keys, their counts
    together, and the number of keys of each count from 1 to ``most`` + 1. With ``table`` it holds
    the part's keys and their counts. Asks without a chunk only add their counts.
    """

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        part = rows[0]["part"]
        keys = np.concatenate([_keys(r["keys"], r["size"], part, parts) for r in rows])
        counts = np.concatenate([unpacked(r["counts"], r["size"]) for r in rows])
        keys, first, at = np.unique(keys, return_index=True, return_inverse=True)
        totals = np.bincount(at, counts, len(keys)).astype(np.int64)
        reply = 2 * totals[at]
        reply[first] += 1
        out, start = [], 0
        for r in rows:
            if r["chunk"] is not None:
                values = packed(reply[start : start + r["size"]])
                out.append({"chunk": r["chunk"], "part": part, "size": r["size"], "counts": values})
            start += r["size"]
        some = totals > 0
        few = np.bincount(np.minimum(totals, most + 2), minlength=most + 3)[1 : most + 2]
        whole = {"part": part, "size": int(some.sum()), "tally": [int(some.sum()), int(totals.sum()), *few.tolist()]}
        if table:
            whole |= {"keys": _key_bytes(keys[some], part, parts), "counts": packed(totals[some])}
        return pa.Table.from_pylist([*out, whole], _ANSWER_SCHEMA)

    return _written(asks.groupBy("part").applyInArrow(answer, _ANSWER), name)


_ANSWER_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("part", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()),
     ("counts", pa.binary()), ("tally", pa.list_(pa.int64()))]
)


def _tally(answers: DataFrame, most: int) -> list[int]:
    """Distinct keys, counts together, and the numbers of keys by count."""
    sums = [F.sum(F.get("tally", F.lit(i))).alias(f"t{i}") for i in range(most + 3)]
    return [int(x or 0) for x in answers.where("chunk is null").agg(*sums).first()]


def discounts(counts_of_counts: dict[int, int], most: int) -> list[float]:
    """Factors for counts 1 to ``most``; larger counts keep theirs."""
    n = [0] + [counts_of_counts.get(r, 0) for r in range(1, most + 2)]
    if all(n[1:]):
        cut = (most + 1) * n[most + 1] / n[1]
        if cut < 1:
            factors = [((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) for r in range(1, most + 1)]
            if all(0 < d < 1 for d in factors):
                return factors
    step = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [(r - step) / r for r in range(1, most + 1)]


def _discounted(c: np.ndarray, factors: list[float]) -> np.ndarray:
    by_count = np.concatenate([[1.0], factors, [1.0]])
    return c * by_count[np.minimum(c, len(factors) + 1)]


def _model(parts: int, words: DataFrame, pairs: DataFrame, most: int) -> KatzModel:
    """Factors and totals from the answers for words and pairs."""
    types, tokens, *few = _tally(words, most)
    low = discounts(dict(enumerate(few, 1)), most)
    high = discounts(dict(enumerate(_tally(pairs, most)[2:], 1)), most)
    small = range(1, most + 1)
    kept = tokens - sum(r * few[r - 1] for r in small) + sum(r * d * few[r - 1] for r, d in zip(small, low))
    share = 1 / max(tokens, 1)
    known = kept * share
    if tokens and known > 1 - 1e-12:
        share, known = share * (tokens / (tokens + 1)), known * tokens / (tokens + 1)
    unknown = math.log10(max(1 - known, 1e-300)) if tokens else 0.0
    return KatzModel(None, None, None, parts, tokens, types, low, high, unknown, share)


# -- scores ------------------------------------------------------------------------

#: Kinds of rows of ``_sums``: of a document, a history, and a document's pairs after a history.
_DOC, _HISTORY, _REST = range(3)
_SUMS = "kind int, row bigint, doc_id bigint, h bigint, n bigint, m bigint, a double, b double"


def _sums(chunks: DataFrame, words: DataFrame, pairs: DataFrame, model: KatzModel) -> DataFrame:
    """What the chunks know by themselves, with the counts of their words and pairs.

    * A document: tokens ``n``, known ones ``m``, base score ``a`` and score ``b``, both short of
      what hangs on its histories.
    * A history: its count ``n``, and of the pairs the chunk owns the discounted counts ``a`` and
      the lower order's probabilities ``b``.
    * A document and history: tokens of pairs that were not seen ``n``, and tokens of seen ones
      ``m`` where no pair of the chunk tells that the history's discounts free something.
    """
    low, high, unknown, share = model.low, model.high, model.unknown, model.share

    def counts(answers: list[dict]) -> np.ndarray:
        parts = [unpacked(x["counts"], x["size"]) for x in answers]
        return np.concatenate(parts).astype(np.int64)

    def batch(kind: int, size: int, **columns) -> pa.RecordBatch:
        empty = {name: pa.nulls(size, k) for name, k in _SUM_KINDS.items()}
        made = {name: pa.array(x, _SUM_KINDS[name]) for name, x in columns.items()}
        return pa.RecordBatch.from_pydict(empty | made | {"kind": pa.array(np.full(size, kind, np.int32))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            of_word = counts(row["word_counts"]) >> 1
            of_pair = counts(row["pair_counts"])
            own, of_pair = (of_pair & 1).astype(bool), of_pair >> 1
            _, first, at = chunk.pairs()
            h, w, n_docs = chunk.before, chunk.tokens, len(chunk.ids)
            starts = np.cumsum(chunk.lengths) - chunk.lengths
            with np.errstate(divide="ignore", invalid="ignore"):
                lower = np.where(of_word > 0, np.log10(_discounted(of_word, low) * share), unknown)
                pair = np.log10(_discounted(of_pair, high)) - np.log10(of_word[h[first]])
            seen = of_pair > 0
            known = of_word > 0
            scores = np.where(seen, pair, lower[w[first]])[at]
            rows = (row["chunk"] << 22) + np.arange(n_docs)
            yield batch(
                _DOC, n_docs, row=rows, doc_id=chunk.ids, n=chunk.lengths,
                m=np.add.reduceat(known[w].astype(np.int64), starts),
                a=np.add.reduceat(np.log10(of_word + 0.5)[w], starts), b=np.add.reduceat(scores, starts),
            )
            mine = np.flatnonzero(own & seen)
            mine_h, kept = h[first[mine]], _discounted(of_pair[mine], high)
            mass = np.bincount(mine_h, kept, len(of_word))
            below = np.bincount(mine_h, 10.0 ** lower[w[first[mine]]], len(of_word))
            some = np.unique(mine_h)
            yield batch(_HISTORY, len(some), h=chunk.histories[some].view(np.int64), n=of_word[some], a=mass[some], b=below[some])
            # a history whose discounts free something keeps all of its seen pairs' probability
            frees = np.zeros(len(of_word), bool)
            frees[h[first[seen & (of_pair - _discounted(of_pair, high) > 1e-9 * of_word[h[first]])]]] = True
            rest = np.flatnonzero(~seen[at] | ~frees[h])
            of_doc = np.repeat(np.arange(n_docs), chunk.lengths)[rest]
            keys, where = np.unique(of_doc * len(of_word) + h[rest], return_inverse=True)
            m = np.bincount(where, seen[at[rest]], len(keys)).astype(np.int64)
            n = np.bincount(where, minlength=len(keys)) - m
            ids = chunk.histories[keys % len(of_word)].view(np.int64)
            yield batch(_REST, len(keys), row=rows[keys // len(of_word)], h=ids, n=n, m=m)

    def of_chunk(answers: DataFrame, name: str) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct("part", "size", "counts")))
        return answers.where("chunk is not null").groupBy("chunk").agg(listed.alias(name))

    whole = chunks.join(of_chunk(words, "word_counts"), "chunk").join(of_chunk(pairs, "pair_counts"), "chunk")
    return _written(whole.mapInArrow(add, _SUMS), "katz_sums")


_SUM_KINDS = {
    "kind": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "h": pa.int64(), "n": pa.int64(), "m": pa.int64(),
    "a": pa.float64(), "b": pa.float64(),
}


def _histories(sums: DataFrame) -> DataFrame:
    """``(h, alpha, keep)`` in base 10: weight of the lower order, and what seen pairs keep."""
    found = sums.where(F.col("kind") == _HISTORY).groupBy("h").agg(
        F.max("n").alias("ch"), F.sum("a").alias("mass"), F.sum("b").alias("below")
    )
    left = 1 - F.col("mass") / F.col("ch")
    found = found.withColumn("keep", F.when(left > 1e-12, F.lit(1.0)).otherwise(F.col("ch") / (F.col("ch") + 1)))
    alpha = F.log10((1 - F.col("keep") * F.col("mass") / F.col("ch")) / (1 - F.col("below")))
    return found.select("h", alpha.alias("alpha"), F.log10("keep").alias("keep"))


def _scores(sums: DataFrame, histories: DataFrame, model: KatzModel) -> DataFrame:
    rest = sums.where(F.col("kind") == _REST).select("row", "h", "n", "m").join(histories, "h", "left")
    weight = F.col("n") * F.coalesce("alpha", F.lit(0.0)) + F.col("m") * F.coalesce("keep", F.lit(0.0))
    rest = rest.groupBy("row").agg(F.sum(weight).alias("rest"))
    each = math.log10(model.tokens + 0.5 * (model.types + 1))
    docs = sums.where(F.col("kind") == _DOC).select("row", "doc_id", "n", "m", "a", "b")
    return docs.join(rest, "row", "left").select(
        "doc_id", F.col("n").alias("n_tokens"), F.col("m").alias("n_known"),
        (F.col("a") - F.col("n") * each).alias("base_score"), (F.col("b") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )


def _parts(chunks: DataFrame) -> int:
    return max(LEAST_PARTS, chunks.count() // 2)


def train(docs: DataFrame, most: int = 5) -> KatzModel:
    """Model of the texts of ``(text)``."""
    chunks = _chunks(docs.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(True).alias("learn")))
    parts = _parts(chunks)
    words = _answers(_asks(chunks, parts, False), parts, most, True, "katz_words")
    pairs = _answers(_asks(chunks, parts, True), parts, most, True, "katz_pairs")
    model = _model(parts, words, pairs, most)
    histories = _written(_histories(_sums(chunks, words, pairs, model)), "katz_histories")
    tables = [t.where("chunk is null").select("part", "size", "keys", "counts") for t in (pairs, words)]
    return KatzModel(*tables, histories, *(getattr(model, x) for x in _TOTALS))


_TOTALS = ("parts", "tokens", "types", "low", "high", "unknown", "share")


def score(docs: DataFrame, model: KatzModel) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` of every row of ``(doc_id, text)``."""
    chunks = _chunks(docs.select("doc_id", "text", F.lit(False).alias("learn")))
    most, answers = len(model.low), []
    for of_pairs, known, name in ((False, model.words, "word_counts"), (True, model.pairs, "pair_counts")):
        known = known.select(F.lit(None).cast("long").alias("chunk"), "part", "size", "keys", "counts")
        answers.append(_answers(_asks(chunks, model.parts, of_pairs).unionByName(known), model.parts, most, False, name))
    return _scores(_sums(chunks, *answers, model), model.histories, model)


def fold_scores(docs: DataFrame, parts: int = 5, held_out: int = 1) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold.

    The texts to learn from are among those to be scored, so they are counted and asked for at once.
    """
    most = 5
    learn = F.coalesce(fold("doc_id", parts) != held_out, F.lit(True))
    chunks = _chunks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", learn.alias("learn")))
    n = _parts(chunks)
    words = _answers(_asks(chunks, n, False), n, most, False, "katz_words")
    pairs = _answers(_asks(chunks, n, True), n, most, False, "katz_pairs")
    model = _model(n, words, pairs, most)
    sums = _sums(chunks, words, pairs, model)
    scored = _scores(sums, _histories(sums), model)
    return scored.withColumn("held_out", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False))).withColumn(
        "train_tokens", F.lit(model.tokens).cast("long")
    )
