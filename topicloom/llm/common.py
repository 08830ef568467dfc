"""What the operators of this package share: words, word hashes and durable tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicloom.runtime import shared_path

#: Words are runs of characters other than these.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows below the cluster's shared folder and go on from the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column | str, parts: int) -> Column:
    """Fold of a document: CRC32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z in lower case; empty for null."""
    # bytes.lower() knows ASCII only, which is what the rule asks for
    return (text or "").encode("utf-8", "surrogatepass").lower()


def byte_set(inside: bytes) -> np.ndarray:
    """A table of 256 flags, true for the bytes given."""
    flags = np.zeros(256, bool)
    flags[np.frombuffer(inside, np.uint8)] = True
    return flags


#: Bytes of words, which are all but space and the five ASCII controls from tab on.
WORD_BYTES = ~byte_set(b" \t\n\x0b\x0c\r")

_RNG = np.random.default_rng(77)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2 ** 64, and their inverses."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = tuple(
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]), dtype=np.uint64)
            for x in (_BASE, pow(_BASE, -1, 2**64))
        )
    return _POWERS[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Spans:
    """Words of a byte string as ``starts`` and ``ends``, with hashes of any part of them."""

    def __init__(self, data: bytes, inside: np.ndarray = WORD_BYTES):
        self.bytes = np.frombuffer(data, np.uint8)
        flags = np.concatenate([[False], inside[self.bytes], [False]])
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        powers, self._inverse = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[self.bytes] * powers[: len(data)], out=self._sums[1:])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of every span: a polynomial of its bytes and its length, mixed."""
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        value = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mixed(value + (ends - starts).astype(np.uint64))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that long texts are taken a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
