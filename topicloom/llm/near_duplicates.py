"""Near-duplicate documents by banded MinHash with odd sketches, confirmed on full sets.

1. Every text becomes its set of word shingles, MinHash samples of the set, band keys over
   groups of samples, and an odd sketch: a bitmap in which every (position, sample) flips
   one bit. The population count of the XOR of two sketches estimates how many samples
   differ, and is most precise where the similarity is high.
2. Documents with equal sets form a class, stood for by its smallest id.
3. In every band bucket the smallest class is compared with the others (a star, not all
   pairs). Pairs that the sketches don't rule out are confirmed on the full sets.
4. Links give components. Only pairs of one bucket that are still in different components
   are left. Buckets of more than ``whole`` members are first dealt again by bands over further
   samples, ``again`` copies a member, for ``levels`` levels with stars of their own. This only
   adds links early, so that less is left: it decides nothing. All pairs of every bucket that
   are left, whatever its size, are then compared by sketch in blocks of ``whole`` a side.
   Every member's closest pair is confirmed first; at last all members with a partner that may
   be similar are compared on their full sets. Pairs inside one component can't change it, so no
   link between components is lost. A bucket is one block up to ``whole`` members, for which no
   row is copied; of ``n`` members whose pairs no link joins, each is copied ``n / whole`` times.

A pair at the threshold ``t`` shares no band with probability ``(1 - t ** rows) ** bands``,
about 1e-6 for the defaults, and a link beyond it still less; the sketch cut lies five
standard deviations below the threshold. Nothing else depends on chance or on sizes.

Defined cases: null and empty texts have an empty set, which is linked with nothing; texts
with fewer words than a shingle have one shingle; very long texts are taken whole; of equal
sets the smallest id stands for all; no rows give no rows. Rows that repeat an id get the same
component. A row without an id is in no component (null) and is kept. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import Spans, column, lower_bytes, mixed, slices, stored
from topicloom.llm.components import components, with_links
from topicloom.runtime import salted_join

_ODD = np.random.default_rng(20240501).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class NearDuplicates:
    """``width`` words a shingle; linked at ``100 * intersection >= percent * union``."""

    width: int = 3
    percent: int = 85
    bands: int = 36
    rows: int = 7
    bits: int = 1024
    block: int = 256
    whole: int = 4096
    again: int = 4
    again_rows: int = 3
    levels: int = 3

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def most_bits(self) -> int:
        """Largest XOR population count of a pair that may reach the threshold."""
        t = self.percent / 100
        least = t - 5 * (t * (1 - t) / self.samples) ** 0.5
        odd = lambda s: self.bits / 2 * (1 - (1 - 2 / self.bits) ** (2 * self.samples * (1 - s)))
        return int(odd(least) + 3 * (odd(least) / 2) ** 0.5)


#: Five words and a similarity of 0.8.
FIVE_WORDS = NearDuplicates(width=5, percent=80, bands=42, rows=6)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    h = Spans(lower_bytes(text)).hashes()
    if not len(h):
        return h
    take = min(width, len(h))
    total = np.full(len(h) - take + 1, take, np.uint64)
    for i in range(take):
        total += h[i : len(h) - take + 1 + i] * _ODD[4000 + i]
    return np.unique(mixed(total))


def min_hashes(sets: list[np.ndarray], samples: int, skip: int = 0) -> np.ndarray:
    """``samples`` minima for each non-empty set, over runs that stay in the CPU's cache.

    The first ``skip`` samples are left out."""
    out = np.empty((len(sets), samples), np.uint64)
    start = 0
    while start < len(sets):
        stop, n = start, 0
        while stop < len(sets) and (n == 0 or n + len(sets[stop]) <= 16_384):
            n += len(sets[stop])
            stop += 1
        flat = np.concatenate(sets[start:stop])
        offsets = np.cumsum([0, *map(len, sets[start : stop - 1])])
        work = np.empty_like(flat)
        for i in range(samples):
            np.multiply(flat, _ODD[skip + i], out=work)
            work += _ODD[skip + i + 2000]
            out[start:stop, i] = np.minimum.reduceat(work, offsets)
        start = stop
    return out


def odd_sketches(signature: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps ``(documents, bits / 64)`` of the samples, as signed longs."""
    n, samples = signature.shape
    at = mixed(signature + np.arange(samples, dtype=np.uint64) * _M1) % np.uint64(bits)
    flat = (np.arange(n)[:, None] * bits + at.astype(np.int64)).ravel()
    parity = (np.bincount(flat, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(parity, axis=1).view(np.int64)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    x = signature.reshape(len(signature), bands, rows) * _ODD[3000 : 3000 + rows]
    return mixed(x.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _M2).view(np.int64)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), matrix.shape[1]).cast(pa.list_(pa.int64()))


def signatures(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """``(doc_id, n_shingles, set_key, bands, sketch)``; the last three are null for empty sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sets = [shingle_set(t, how.width) for t in column(batch, "text")]
            full = np.array([len(s) > 0 for s in sets])
            sizes = pa.array([len(s) for s in sets], pa.int64())
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signature = min_hashes([s for s in sets if len(s)], how.samples)
            # rows without a set point nowhere, which take() turns into nulls
            at = pa.array(np.where(full, np.cumsum(full) - 1, 0), pa.int64(), mask=~full)
            if full.any():
                bands = _lists(band_keys(signature, how.bands, how.rows)).take(at)
                sketch = _lists(odd_sketches(signature, how.bits)).take(at)
            else:
                bands = sketch = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, sizes, pa.array(keys, pa.binary()), bands, sketch],
                ["doc_id", "n_shingles", "set_key", "bands", "sketch"],
            )

    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, schema)


def _close(a: str, b: str, most: int):
    """The sketches don't rule the pair out."""
    differ = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda s, x: s + x) <= most


def confirmed(pairs: DataFrame, texts: DataFrame, how: NearDuplicates) -> DataFrame:
    """Those pairs ``(a, b)`` whose full shingle sets reach the threshold."""
    side = texts.select("doc_id", "text")
    joined = pairs.join(side.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        side.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in slices(batches, 256):
            linked = []
            for x, y in zip(column(batch, "text_a"), column(batch, "text_b")):
                if x != last or known is None:
                    last, known = x, shingle_set(x, how.width)
                other = shingle_set(y, how.width)
                both = len(np.intersect1d(known, other, assume_unique=True))
                linked.append(both > 0 and 100 * both >= how.percent * (len(known) + len(other) - both))
            kept = batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
            if kept.num_rows:
                yield kept

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint")


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Stretches of rows with equal keys, from sorted batches."""
    pending = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([pending, rows]).combine_chunks() if pending is not None else rows
        if not rows.num_rows:
            continue
        values = [rows.column(k).to_numpy() for k in keys]
        changed = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
        starts = [0, *(np.flatnonzero(changed) + 1)]
        for a, b in zip(starts, starts[1:]):
            yield rows.slice(a, b - a)
        pending = rows.slice(starts[-1])
    if pending is not None:
        yield pending


def _dealt(members: DataFrame, payload: str, block: int) -> DataFrame:
    """Blocks of about ``block`` rows a side: members ``apart`` from their bucket's first
    class (side 0) against all members of the bucket (side 1), as sorted runs of
    ``(band, i, j)``. ``n`` and ``n_apart`` are the numbers of these in the bucket."""
    ni, nj = (F.ceil(F.col(c) / block).cast("int") for c in ("n_apart", "n"))
    placed = members.withColumns({"ni": ni, "nj": nj})
    cell = F.xxhash64("rep")
    left = placed.where("apart").select(
        "band", F.pmod(cell, "ni").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"),
        F.lit(0).alias("side"), "rep", "comp", payload,
    )
    right = placed.select(
        "band", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), F.pmod(cell, "nj").cast("int").alias("j"),
        F.lit(1).alias("side"), "rep", "comp", payload,
    )
    return left.unionByName(right).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")


def _blocks(batches: Iterator[pa.RecordBatch], how: NearDuplicates):
    """Pairs of row numbers for both sides of every block, with the block's rows."""
    for rows in runs_of(batches, ["band", "i", "j"]):
        side = rows.column("side").to_numpy()
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for one in np.array_split(x, max(1, len(x) // how.block)):
            for two in np.array_split(y, max(1, len(y) // how.block)):
                if len(one) and len(two):
                    yield rows, one, two


def close_members(members: DataFrame, how: NearDuplicates) -> DataFrame:
    """``(band, rep, other, bits)``: what the sketches leave to be confirmed.

    Every member with a partner of its block in another component that may be similar, with the
    closest of these. ``members`` is ``(band, rep, comp, sketch, apart, n, n_apart)``.
    """
    most, words = how.most_bits(), how.bits // 64

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, one, two in _blocks(batches, how):
            rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
            band = rows.column("band").to_numpy()
            sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, words)
            bits = np.bitwise_count(sketch[one][:, None] ^ sketch[two][None]).sum(axis=2).astype(np.int32)
            bits = np.where(comp[one][:, None] != comp[two][None], bits, most + 1)
            for own, others, near in ((one, two, bits), (two, one, bits.T)):
                best = near.argmin(axis=1)
                least = near[np.arange(len(own)), best]
                p = np.flatnonzero(least <= most)
                if len(p):
                    found = [band[own[p]], rep[own[p]], rep[others[best[p]]], least[p]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["band", "rep", "other", "bits"])

    return _dealt(members, "sketch", how.whole).mapInArrow(meet, "band bigint, rep bigint, other bigint, bits int")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, as matrix products
    over stretches of the shingles that occur on both sides."""
    sides = [(np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate(s)) for s in (left, right)]
    names = np.intersect1d(sides[0][1], sides[1][1])
    total = np.zeros((len(left), len(right)), np.float32)
    placed = []
    for row, shingle in sides:
        at = np.searchsorted(names, shingle)
        hit = (at < len(names)) & (names[np.minimum(at, max(len(names) - 1, 0))] == shingle) if len(names) else at < 0
        order = np.argsort(at[hit], kind="stable")
        placed.append((row[hit][order], at[hit][order]))
    for start in range(0, len(names), width):
        part = []
        for (row, at), n in zip(placed, total.shape):
            a, b = np.searchsorted(at, [start, start + width])
            dense = np.zeros((n, width), np.float32)
            dense[row[a:b], at[a:b] - start] = 1
            part.append(dense)
        total += part[0] @ part[1].T
    return total


def block_links(members: DataFrame, how: NearDuplicates) -> DataFrame:
    """Links between components among ``(band, rep, comp, shingles, apart, n, n_apart)``, on full sets.

    Whole blocks are compared by matrix products, so no pair but a link leaves its task.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, one, two in _blocks(batches, how):
            rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
            lists = rows.column("shingles").combine_chunks()
            sides = [[lists[int(i)].values.to_numpy() for i in side] for side in (one, two)]
            sizes = [np.array([len(x) for x in side]) for side in sides]
            both = shared_shingles(*sides)
            linked = 100 * both >= how.percent * (sizes[0][:, None] + sizes[1][None] - both)
            p, q = np.nonzero(linked & (both > 0) & (comp[one][:, None] != comp[two][None]))
            if len(p):
                a, b = rep[one[p]], rep[two[q]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return _dealt(members, "shingles", how.block).mapInArrow(meet, "a bigint, b bigint").distinct()


def shingle_sets(texts: DataFrame, how: NearDuplicates) -> DataFrame:
    """``(rep, shingles)`` of ``(doc_id, text)``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [shingle_set(t, how.width).view(np.int64) for t in column(batch, "text")]
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.list_(pa.int64()))], ["rep", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(make, "rep bigint, shingles array<bigint>")


def _components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``(rep, comp)`` of every class with a link, but for the first of its component.

    ``before`` are the components without these ``links``, which are written rows then."""
    if before is not None and links.isEmpty():
        return before
    if before is not None:
        roots = with_links(before.select(F.col("rep").alias("node"), F.col("comp").alias("root")), links)
    else:
        roots = components(links)
    return roots.select(F.col("node").alias("rep"), F.col("root").alias("comp"))


def _shared(banded: DataFrame, name: str) -> DataFrame:
    """``(rep, band, first)`` of the members of every bucket but its smallest, ``first``."""
    buckets = banded.groupBy("band").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    shared = buckets.where("first < last").select("band", "first")
    return stored(banded.join(shared, "band").where("rep > first"), name)


def _open_members(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``(band, rep, first, comp, apart, n, n_apart)`` of the buckets that don't lie in the
    component of their first class as a whole; ``n`` is the number of members, ``n_apart`` that
    of the members in other components."""
    apart = (
        members.select("band", "rep", "first")
        .join(comps, "rep", "left")
        .join(comps.select(F.col("rep").alias("first"), F.col("comp").alias("first_comp")), "first", "left")
        .select(
            "band", "rep", "first", F.coalesce("comp", "rep").alias("comp"),
            (F.coalesce("comp", "rep") != F.coalesce("first_comp", "first")).alias("apart"),
        )
    )
    sizes = apart.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if("apart").alias("n_apart"))
    return apart.join(sizes.where("n_apart > 0 and n > 1"), "band")


def dealt_again(members: DataFrame, texts: DataFrame, how: NearDuplicates, level: int) -> DataFrame:
    """The members ``(band, rep)`` of large buckets, in buckets that also agree in a band of
    further samples: ``(rep, band, first)`` as before, ``how.again`` copies a member."""
    samples = how.again * how.again_rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [shingle_set(t, how.width) for t in column(batch, "text")]
            signature = min_hashes(sets, samples, how.samples + level * samples)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            keys = _lists(band_keys(signature, how.again, how.again_rows))
            yield pa.RecordBatch.from_arrays([ids, keys], ["rep", "keys"])

    asked = texts.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    keys = asked.select("doc_id", "text").mapInArrow(sign, "rep bigint, keys array<bigint>")
    banded = members.select("band", "rep").join(keys, "rep").select(
        "rep", F.explode(F.transform("keys", lambda k: F.xxhash64("band", k))).alias("band")
    )
    return _shared(banded, "dealt_again")


def star_links(members: DataFrame, sketches: DataFrame, texts: DataFrame, how: NearDuplicates) -> DataFrame:
    """Links ``(a, b)`` of every bucket's first class with its members."""
    stars = members.select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    stars = stars.join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    near = stars.where(_close("sketch_a", "sketch_b", how.most_bits())).select("a", "b")
    return stored(confirmed(near, texts, how), "star_links")


def _same_ids(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of ids that are repeated with different sets to the classes of these."""
    twice = found.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high")
    keys = found.join(twice.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), "set_key")
    return keys.join(classes.select("set_key", F.col("rep").alias("b")), "set_key").where("a != b").select("a", "b")


def near_duplicates(docs: DataFrame, how: NearDuplicates = NearDuplicates()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``(doc_id, text)``."""
    signed = stored(signatures(docs, how), "signatures")
    found = signed.where("set_key is not null and doc_id is not null")
    classes = stored(
        found.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "set_classes"
    )
    reps = found.join(
        classes.select("set_key", F.col("rep").alias("doc_id")), ["doc_id", "set_key"], "left_semi"
    ).select(F.col("doc_id").alias("rep"), "bands", "sketch")
    members = _shared(reps.select("rep", F.explode("bands").alias("band")), "band_members")
    sketches = stored(
        reps.join(
            members.select("rep").unionByName(members.select(F.col("first").alias("rep"))).distinct(), "rep", "left_semi"
        ).select("rep", "sketch"),
        "sketches",
    )
    texts = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
            sketches.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"
        ),
        "compared_texts",
    )
    links = star_links(members, sketches, texts, how).unionByName(_same_ids(found, classes))
    comps = _components(links)
    left = stored(_open_members(members, comps), "open_buckets")
    large, level = left.where(F.col("n") > how.whole), 0
    while level < how.levels and not large.isEmpty():
        # only for more links before all pairs of the buckets are compared
        again, level = dealt_again(large, texts, how, level), level + 1
        comps = _components(star_links(again, sketches, texts, how), comps)
        large = stored(_open_members(again, comps), "open_again").where(F.col("n") > how.whole)
    if level:
        left = stored(_open_members(left, comps), "open_buckets")

    # the closest pairs first: these join most of what belongs together before all that is left
    # is compared
    close = stored(close_members(left.drop("first").join(sketches, "rep"), how), "close_members")
    best = close.groupBy("rep").agg(F.min(F.struct("bits", "other")).alias("x")).select("rep", "x.other")
    pairs = best.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
    comps = _components(stored(confirmed(pairs, texts, how), "closest_links"), comps)
    near = close.select("band", "rep").distinct()
    compared = stored(_open_members(left.join(near, ["band", "rep"], "left_semi"), comps), "still_open")
    asked = texts.join(compared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    compared = compared.drop("first").join(shingle_sets(asked, how), "rep")
    comps = _components(stored(block_links(compared, how), "block_links"), comps)

    # rows whose component isn't their own id by default: copies of a class, and linked classes
    special = (
        classes.join(comps, "rep", "left")
        .select("set_key", F.coalesce("comp", "rep").alias("component_id"), ((F.col("copies") > 1) | F.col("comp").isNotNull()).alias("special"))
        .where("special")
        .drop("special")
    )
    own = signed.select("doc_id", "n_shingles", "set_key")
    return salted_join(own, special, ["set_key"]).select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, how: NearDuplicates = FIVE_WORDS) -> DataFrame:
    """One row of every group of near duplicates, with all columns of ``docs``.

    Of rows that repeat a kept id, one stays; rows without an id all stay.
    """
    verdicts = near_duplicates(docs, how).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(verdicts, "doc_id", "left_semi").select(docs.columns)
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))
