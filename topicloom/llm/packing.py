"""Training sequences by power-of-two decomposition of documents.

A document's ids are cut into pieces whose lengths are powers of two: as many of the
longest as fit, then the binary digits of the rest from high to low. Every piece is a
sequence of its own, in the bucket of its length, so no sequence crosses documents and
none is padded; a batch takes equal lengths from one bucket.

Ids come from a byte-level BPE. Its merges never leave a piece of the splitting pattern. Of
white space before a word the pattern leaves the last character to a piece of its own, for
which it looks ahead. Texts are cut there beforehand, so the pattern that is left looks ahead
nowhere: it is several times as fast, and long stretches of white space need no stack. Texts
with characters whose class may differ between Unicode versions go through the tokenizer
library as they are.

Defined cases: null and empty texts hold the end id alone, which is one piece of length 1;
repeated rows are packed as often as they occur, each with sequences of their own; special
tokens written in a text are ordinary text. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import column, slices

#: The split of texts before the merges, a fixed value of the tokenizer, but for its
#: ``\s+(?!\S)`` before the last branch, which :func:`cut_runs` stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""

#: Two or more of the white space that is not unusual, and what texts with such have in them.
_RUN, _RUN_PARTS = re.compile("[\\t\\n\\r\\x20]{2,}"), ("  ", " \n", "\n ", "\n\n", "\t", "\r")

#: Anything but characters whose classes all Unicode versions in use agree on.
_UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u024f\\u0391-\\u03a1\\u03a3-\\u03ff\\u0400-\\u0481\\u048a-\\u0513\\u2010-\\u2027\\u2030-\\u205e]")


@dataclass(frozen=True)
class ByteBpe:
    """``tokenizer`` is a tokenizers JSON file, ``ranks`` the same vocabulary as ranks."""

    tokenizer: str
    ranks: str
    end_id: int = 1


def cut_runs(text: str) -> list[str]:
    """The text in parts, cut before the last character of white space that a word follows."""
    if not any(part in text for part in _RUN_PARTS):
        return [text]
    cuts = [run.end() - 1 for run in _RUN.finditer(text) if run.end() < len(text)]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=2)
def _encoder(how: ByteBpe):
    """A function from a text to its ids as bytes. Workers keep it from task to task."""
    import tiktoken

    with open(how.ranks, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(text: str) -> bytes:
        if _UNUSUAL.search(text):
            return np.array(_library(how.tokenizer).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(np.array(encode(part), "<u4").tobytes() for part in cut_runs(text))

    return ids


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """``longest`` as often as it fits, then the binary digits of the rest."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def packed_pieces(docs: DataFrame, how: ByteBpe, longest: int = 2048) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset)`` for each piece.

    ``ids`` are little-endian 32-bit integers in a binary; ``bucket`` is the logarithm of
    the length to base 2. ``longest`` must be a power of two. Pieces are numbered where
    they are made, so nothing is shuffled; numbers are unique, not gapless.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = np.array([how.end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(how)
        for batch in slices(batches, 64):
            rows = []
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                ids = (encode(text) if text else b"") + end
                tokens, start = len(ids) // 4, 0
                for length in piece_lengths(tokens, longest):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, part, tokens, length.bit_length() - 1))
                    start += length
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "bucket"],
            )

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, bucket int"
    )
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def bucket_plan(pieces: DataFrame, batch_tokens: int = 1 << 19) -> DataFrame:
    """``(bucket, sequences, tokens, per_batch, batches)``: equal-length batches of ``batch_tokens`` ids."""
    sums = pieces.groupBy("bucket").agg(F.count(F.lit(1)).alias("sequences"), F.sum("length").alias("tokens"))
    per = F.greatest(F.lit(1), F.floor(batch_tokens / F.pow(F.lit(2.0), "bucket"))).cast("long")
    return sums.withColumn("per_batch", per).withColumn("batches", F.ceil(F.col("sequences") / per).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, a folder for each bucket."""
    pieces.write.partitionBy("bucket").parquet(path)
