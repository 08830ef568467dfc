"""SimHash near-dedup by a grid over segment bit counts.

1. Every text becomes a 64-bit fingerprint: a bit is set if more than half of the hashes of
   its word shingles have it. Documents with equal fingerprints are one row from here on.
2. The fingerprint is cut into 32 segments of two bits, and each segment is replaced by its
   number of set bits. The Manhattan distance of two such vectors is never larger than the
   number of bits in which the fingerprints differ. Counts are written as unary digits (0: 00,
   1: 01, 2: 11), so the vector is one 64-bit number and the Manhattan distance of two vectors
   is the population count of their XOR.
3. Grid range-join. Where the distance over both halves of the vector is at most 3, it is at
   most 1 in one of them. So each half is a grid of its own, of 16 dimensions and cell width 1.
   A vector lies in its own cell; if its counts in that half have an odd sum, it also visits
   the cells one step away. (Vectors one step apart have sums of different parity, so visits
   from one side are enough.) Inside a cell the Manhattan bound is tested first, then the
   fingerprints themselves.
4. Only what connects a cell leaves its task: one link a member at most, whatever the number
   of pairs (cells of a few members give all their links). Links give components.

Cells of more than ``cell_rows`` members are dealt again by 16 of the 64 bits at a time: of
four such parts at least one is equal where at most 3 bits differ. What is still larger is
joined without comparing pairs, by the fingerprints at one or two bits' distance: two
fingerprints of different parity are at most 3 bits apart exactly if one bit flipped in the odd
one and at most two in the even one can give the same number, and two of equal parity are at
most 2 bits apart exactly if a flipped bit in each can. That is a fixed number of rows a
member, so no group is compared all against all at any size.

Defined cases: texts that are null, empty or without words have the fingerprint zero, which
is linked like any other; texts with fewer words than a shingle have one shingle. A bit set in
just half of the hashes is 0. Rows that repeat an id with different texts link what these texts
are linked with, as the id is the same. A row without an id gets its fingerprint, but is in no
component (null) and links nothing. Texts of any length are taken whole, a few at a time. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import column, lower_bytes, slices, stored
from topicloom.llm.components import components
from topicloom.runtime import salted_join

#: Fingerprints link at up to this many differing bits; the grid is laid out for it.
MOST = 3
_LOW = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)
_HALF = np.uint64(0xFFFFFFFF)
#: Cells of up to so many members give all their links, many cells at once.
SMALL_CELL = 16


@dataclass(frozen=True)
class SegmentSimHash:
    """``width`` words a shingle; cells of up to ``cell_rows`` members are compared in one task."""

    width: int = 3
    seed: int = 42
    cell_rows: int = 16_384


def fingerprint(text: str | None, how: SegmentSimHash) -> int:
    # bytes.split() knows just the six ASCII separators that end a word
    words = lower_bytes(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    take = min(how.width, len(words))
    digest, seed = xxhash.xxh64_intdigest, how.seed
    spans = zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_in > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, how: SegmentSimHash) -> DataFrame:
    """``(doc_id, print)``, the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            made = np.array([fingerprint(t, how) for t in column(batch, "text")], np.uint64)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(made.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, "doc_id bigint, print bigint")


def segment_counts(prints: np.ndarray) -> np.ndarray:
    """Set bits of every pair of bits, as unary digits of two bits."""
    high = prints >> _ONE
    return ((prints & high & _LOW) << _ONE) | ((prints | high) & _LOW)


def half_cells(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(member, half, cell)`` of all cells that the rows lie in or visit."""
    member, halves, cells = [], [], []
    everyone = np.arange(len(counts))
    for half in (0, 1):
        home = (counts >> np.uint64(32 * half)) & _HALF
        member.append(everyone)
        cells.append(home)
        odd = np.flatnonzero(np.bitwise_count(home) & 1)
        for segment in range(16):
            at = np.uint64(2 * segment)
            digit = (home[odd] >> at) & np.uint64(3)
            # 0 and 2 have one neighbour, 1 has two
            for flip, may in ((1, digit != 3), (2, digit != 0)):
                member.append(odd[may])
                cells.append(home[odd[may]] ^ (np.uint64(flip) << at))
        halves.append(np.full(sum(map(len, member)) - sum(map(len, halves)), half))
    return np.concatenate(member), np.concatenate(halves), np.concatenate(cells)


def grid_cells(prints: DataFrame) -> DataFrame:
    """``(cell, print)`` of the distinct fingerprints; ``cell`` holds the half in its top bits."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            own = batch.column(0).to_numpy()
            member, half, cell = half_cells(segment_counts(own.view(np.uint64)))
            cell = cell.view(np.int64) | (half << 32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(own[member])], ["cell", "print"])

    return prints.select("print").mapInArrow(deal, "cell bigint, print bigint")


def connected(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(a, b)`` that join what is at most ``MOST`` bits apart, one a member at most.

    A search from the first member on: whoever is reached leaves the rest, so that a group
    around one fingerprint is done after a few steps.
    """
    totals = np.bitwise_count(prints).astype(np.int64)
    order = np.argsort(totals, kind="stable")
    rest, totals = prints[order], totals[order]
    counts = segment_counts(rest)
    found = [[], []]
    waiting = []
    while len(rest):
        if not waiting:
            waiting.append(rest[0])
            rest, totals, counts = rest[1:], totals[1:], counts[1:]
            continue
        x = waiting.pop()
        # the total is the coarsest of the bounds, and the rows are sorted by it
        size = int(np.bitwise_count(x))
        a, b = np.searchsorted(totals, [size - MOST, size + MOST + 1])
        may = np.bitwise_count(counts[a:b] ^ segment_counts(x)) <= MOST
        near = a + np.flatnonzero(may)
        near = near[np.bitwise_count(rest[near] ^ x) <= MOST]
        if len(near):
            reached = rest[near]
            found[0].append(np.full(len(near), x))
            found[1].append(reached)
            waiting += list(reached)
            rest, totals, counts = (np.delete(values, near) for values in (rest, totals, counts))
    if not found[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side).view(np.int64) for side in found)


def whole_cells(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(prints, starts)`` of stretches of whole cells, from rows sorted by ``key``."""
    kept = None
    for batch in batches:
        values = [batch.column(i).to_numpy() for i in range(len(key) + 1)]
        if kept is not None:
            values = [np.concatenate(pair) for pair in zip(kept, values)]
        changed = np.logical_or.reduce([v[1:] != v[:-1] for v in values[:-1]])
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
        last = starts[-1]
        if last:
            yield values[-1][:last].view(np.uint64), starts[:-1]
        kept = [v[last:] for v in values]
    if kept is not None and len(kept[-1]):
        yield kept[-1].view(np.uint64), np.zeros(1, np.int64)


def cell_links(cells: DataFrame, key: list[str]) -> DataFrame:
    """Links ``(a, b)`` between the fingerprints of every cell."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints, starts in whole_cells((b for b in batches if b.num_rows), key):
            sizes = np.diff(np.append(starts, len(prints)))
            found = [connected(prints[at : at + n]) for at, n in zip(starts, sizes) if n > SMALL_CELL]
            small = np.repeat(sizes <= SMALL_CELL, sizes)
            # how many members of its own cell follow a row
            after = np.repeat(starts + sizes, sizes) - np.arange(len(prints)) - 1
            counts = segment_counts(prints)
            rows = np.flatnonzero(small & (after > 0))
            step = 1
            while len(rows):
                near = rows[np.bitwise_count(counts[rows] ^ counts[rows + step]) <= MOST]
                near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= MOST]
                found.append((prints[near].view(np.int64), prints[near + step].view(np.int64)))
                step += 1
                rows = rows[after[rows] >= step]
            a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return cells.select(*key, "print").repartition(*key).sortWithinPartitions(*key).mapInArrow(meet, "a bigint, b bigint")


def _by_size(cells: DataFrame, key: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the cells with two to ``most`` members, and of those with more."""
    sizes = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    large = stored(sizes.where(F.col("members") > most).select(*key), "large_cells")
    if large.isEmpty():
        return cells, large.limit(0).withColumn("print", F.lit(0).cast("long"))
    # a large cell's rows spread over the salts
    marked = salted_join(cells, large.withColumn("large", F.lit(True)), key)
    return marked.where("large is null").drop("large"), marked.where("large").drop("large")


def flipped_links(prints: DataFrame) -> DataFrame:
    """Links between all fingerprints at most ``MOST`` bits apart, without comparing any.

    Everyone gives the numbers at up to one flipped bit (``near``), and those with an even
    number of set bits also the ones at two. Who meets at a number of the first kind is at
    most 2 apart; an odd and an even one that meet at any number are at most 3 apart.
    """
    flips = np.array([0, *(1 << i for i in range(64))], np.uint64)
    pairs = np.array([(1 << i) | (1 << j) for i in range(64) for j in range(i)], np.uint64)

    def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            own = batch.column(0).to_numpy()
            odd = (np.bitwise_count(own.view(np.uint64)) & 1).astype(bool)
            for masks, near, rows in ((flips, True, own), (pairs, False, own[~odd])):
                at = (rows.view(np.uint64)[:, None] ^ masks[None]).ravel().view(np.int64)
                who = np.repeat(rows, len(masks))
                is_odd = np.repeat(odd, len(masks)) if near else np.zeros(len(who), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(who), pa.array(is_odd), pa.array(np.full(len(who), near))],
                    ["at", "print", "odd", "near"],
                )

    spots = prints.select("print").mapInArrow(flip, "at bigint, print bigint, odd boolean, near boolean")
    # a star round the least fingerprint with one flipped bit, and one round the least odd one
    first = F.min(F.when(F.col("near"), F.col("print")))
    first_odd = F.min(F.when(F.col("odd"), F.col("print")))
    stars = spots.groupBy("at").agg(
        first.alias("first"), first_odd.alias("first_odd"), F.min("print").alias("least"), F.max("print").alias("last")
    )
    met = spots.join(stars.where("least < last").drop("least", "last"), "at")
    one = met.where("near and print != first").select(F.col("first").alias("a"), F.col("print").alias("b"))
    two = met.where("not odd and first_odd is not null").select(F.col("first_odd").alias("a"), F.col("print").alias("b"))
    return one.unionByName(two).distinct()


def print_links(prints: DataFrame, how: SegmentSimHash) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints at most ``MOST`` bits apart."""
    cells, large = _by_size(stored(grid_cells(prints), "grid_cells"), ["cell"], how.cell_rows)
    links = cell_links(cells, ["cell"])
    if large.isEmpty():
        return links
    # each part takes 8 bits from either half, as the half of the cell tells few members apart
    part = lambda i: F.shiftrightunsigned("print", 8 * i).bitwiseAND(255) * 256 + F.shiftrightunsigned(
        "print", 8 * (i + 4)
    ).bitwiseAND(255)
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), part(i).alias("bits")) for i in range(4)))).alias("part")
    finer = stored(large.select("cell", "print", parts).select("cell", "part.i", "part.bits", "print"), "finer_cells")
    key = ["cell", "i", "bits"]
    cells, large = _by_size(finer, key, how.cell_rows)
    return links.unionByName(cell_links(cells, key)).unionByName(flipped_links(large.select("print").distinct()))


def near_duplicates(docs: DataFrame, how: SegmentSimHash = SegmentSimHash()) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``(doc_id, text)``."""
    signed = stored(fingerprints(docs, how), "fingerprints")
    named = signed.where("doc_id is not null")
    classes = stored(
        named.groupBy("print").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")), "print_classes"
    )
    links = stored(print_links(classes, how), "print_links")
    # nodes are documents: the smallest one of a fingerprint stands for it, and an id with
    # several texts joins their fingerprints by itself
    reps = classes.select("print", "rep")
    ends = links.join(reps.select(F.col("print").alias("a"), F.col("rep").alias("rep_a")), "a").join(
        reps.select(F.col("print").alias("b"), F.col("rep").alias("rep_b")), "b"
    )
    twice = named.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high")
    same = (
        named.join(twice.select("doc_id"), "doc_id", "left_semi")
        .join(reps, "print")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    comps = components(
        ends.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).unionByName(same).where("a != b")
    )
    special = (
        classes.join(comps.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .where("root is not null or rep < last")
        .select("print", F.coalesce("root", "rep").alias("component_id"))
    )
    return salted_join(signed, special, ["print"]).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
