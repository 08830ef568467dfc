"""Nearest vectors by multiprobe p-stable hashing with exact reranking.

Vectors are parted into ranges of norms, so that a few long ones don't squeeze the others
together. In each range they are scaled by its largest norm and get one more component that
makes them unit vectors; queries are scaled to unit length with 0 there. Euclidean distance
then orders like the inner product. Every query looks into every range. Each table hashes ``floor((a . x + b) / width)`` for a few normal
vectors ``a``, and the codes together name a bucket. A query visits its own bucket and
perturbed ones (each code one lower, equal or one higher) in the order of their estimated
success: the sum of squared distances from the query to the borders that are crossed.
Members of visited buckets are ranked by the exact inner product in double precision, and
the best of all tables are merged.

Buckets are dealt out in groups of about ``group_rows`` index rows, and a group that is
larger, for one hot bucket say, is split by the vectors' ids; queries go to every part, so
nothing is capped. Queries for which fewer than ``k`` neighbours with a product above 0 were found are
compared with all rows, in blocks. With the defaults recall on
64 dimensions without much structure is about 0.99, and 0.97 where norms are lognormal.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components,
and those of another length than the most frequent one, take no part. Rows that repeat an
id count once for a query, with the best of their scores, and a query's own id never, also
where members are pruned. Equal scores are ranked by id. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import mixed, stored
from topicloom.llm.near_duplicates import runs_of
from topicloom.runtime import lookup_join


@dataclass(frozen=True)
class Probing:
    """``tables`` hash tables of ``codes`` codes each, of which a query visits ``probes`` buckets.

    Norms of a range differ by a factor of up to 2 ** (``span`` / 8). Where all rows are compared
    with queries, that is with ``asked`` of these in a task."""

    tables: int = 8
    codes: int = 6
    width: float = 1.5
    probes: int = 240
    group_rows: int = 65_536
    seed: int = 5
    span: int = 4
    asked: int = 2048


@dataclass(frozen=True)
class _Range:
    """Vectors whose norm is at least ``low``, dealt out in ``groups``, or in none if they are
    to be compared with every query."""

    low: float
    longest: float
    groups: int


def usable(vectors: DataFrame, is_query: Column, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``(id, vec, asks)`` of the vectors that take part, as doubles; ``asks`` marks the queries."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0) & F.col(id).isNotNull())
    size = (
        rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n").scalar()
    )
    return rows.where(F.size(v) == size).select(
        F.col(id).cast("long").alias("id"), v.cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("vec")).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


class _Tables:
    """The hash functions, drawn from the seed alone, so that every task has the same."""

    def __init__(self, how: Probing, dims: int):
        chance = np.random.default_rng(how.seed)
        self.how = how
        self.a = chance.normal(size=(how.tables, dims + 1, how.codes))
        self.b = chance.uniform(0, how.width, size=(how.tables, how.codes))
        self.steps = np.array(list(itertools.product((-1, 0, 1), repeat=how.codes)))
        self.weights = chance.integers(1, 2**62, how.codes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def places(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.a[t] + self.b[t]) / self.how.width

    def buckets(self, codes: np.ndarray) -> np.ndarray:
        return mixed((codes.astype(np.int64).view(np.uint64) * self.weights).sum(axis=-1, dtype=np.uint64)).view(np.int64)

    def group(self, buckets: np.ndarray, groups: int) -> np.ndarray:
        return ((buckets.view(np.uint64) >> np.uint64(8)) % np.uint64(groups)).astype(np.int32)


_KEYS = ["t", "g", "part"]
_SCHEMA = "t int, g int, side int, id bigint, vec array<double>, buckets array<bigint>"


def _batch(t: int, g, side: int, ids, vectors: np.ndarray, buckets: list) -> pa.RecordBatch:
    n = len(ids)
    vec = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(vectors).ravel()), vectors.shape[1])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, t, np.int32)), pa.array(g), pa.array(np.full(n, side, np.int32)), pa.array(ids),
            vec.cast(pa.list_(pa.float64())), pa.array(buckets, pa.list_(pa.int64())),
        ],
        ["t", "g", "side", "id", "vec", "buckets"],
    )


#: Table number and bucket of what is compared with every query.
_EXACT, _ALL = -1, 0


def _ranges(rows: DataFrame, how: Probing) -> list[_Range]:
    """Ranges of norms from the lowest, each starting at the longest vector that is left."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    # norms beyond what doubles can hold, on either side, have bins of their own
    bin = F.least(F.greatest(F.floor(F.coalesce(F.log2("norm"), F.lit(-1125.0)) * 8), F.lit(-9000)), F.lit(9000))
    counted = rows.select(norm.alias("norm")).groupBy(bin.cast("int").alias("bin")).agg(
        F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n")
    )
    found = []
    for r in counted.orderBy(F.desc("bin")).collect():  # bins are eighths of an octave
        if found and found[-1][0] - r["bin"] < how.span:
            found[-1][1:] = [r["bin"], found[-1][2], found[-1][3] + r["n"]]
        else:
            found.append([r["bin"], r["bin"], r["longest"], r["n"]])
    return [
        _Range(
            float(np.exp2(low / 8)),
            longest * (1 + 1e-12),
            -(-n // how.group_rows) if 0 < longest < float("inf") else 0,
        )
        for _, low, longest, n in reversed(found)
    ]


def _indexed(rows: DataFrame, how: Probing, ranges: list[_Range], chunks: int) -> DataFrame:
    """A row of every vector for each table of its range, with its bucket, or one for each
    chunk of queries that all are compared with it."""
    lows, hashed = np.array([r.low for r in ranges]), np.array([r.groups > 0 for r in ranges], bool)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy()
            own = np.maximum(np.searchsorted(lows, np.sqrt((x * x).sum(axis=1)), side="right") - 1, 0)
            exact = np.flatnonzero(~hashed[own])
            for c in range(chunks if len(exact) else 0):
                yield _batch(_EXACT, np.full(len(exact), c, np.int32), 0, ids[exact], x[exact], [[_ALL]] * len(exact))
            tables = _Tables(how, x.shape[1])
            for n in np.unique(own[hashed[own]]).tolist():
                at = np.flatnonzero(own == n)
                unit = x[at] / ranges[n].longest
                unit = np.hstack([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))[:, None]])
                for t in range(how.tables):
                    found = tables.buckets(np.floor(tables.places(unit, t)))
                    group = tables.group(found, ranges[n].groups)
                    yield _batch(n * how.tables + t, group, 0, ids[at], x[at], found[:, None].tolist())

    return rows.mapInArrow(place, _SCHEMA)


def _probed(rows: DataFrame, how: Probing, ranges: list[_Range], chunks: int) -> DataFrame:
    """A row of every query for each table and group of buckets, with the buckets to visit there."""
    hashed = [(n, r.groups) for n, r in enumerate(ranges) if r.groups]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy()
            if len(hashed) < len(ranges):
                chunk = (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(chunks)).astype(np.int32)
                yield _batch(_EXACT, chunk, 1, ids, x, [[_ALL]] * len(ids))
            if not hashed:
                continue
            tables = _Tables(how, x.shape[1])
            unit = np.hstack([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros((len(x), 1))])
            for t in range(how.tables):
                places = tables.places(unit, t)
                codes = np.floor(places)
                inside = places - codes
                cost = np.stack([inside**2, np.zeros_like(inside), (1 - inside) ** 2], axis=-1)
                for i in range(len(x)):
                    total = cost[i][np.arange(how.codes), tables.steps + 1].sum(axis=1)
                    best = np.argsort(total, kind="stable")[: how.probes]
                    found = tables.buckets(codes[i] + tables.steps[best])
                    for n, groups in hashed:
                        group = tables.group(found, groups)
                        for g in np.unique(group):
                            yield _batch(
                                n * how.tables + t, np.array([g], np.int32), 1, ids[i : i + 1], x[i : i + 1], [found[group == g].tolist()]
                            )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for batch in probe(batches):
            waiting.append(batch)
            if len(waiting) >= 2000:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting = []
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return rows.mapInArrow(gathered, _SCHEMA)


def _best(query: np.ndarray, id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of every query by score and id."""
    order = np.lexsort((id, -score, query))
    q = query[order]
    first = np.concatenate([[True], q[1:] != q[:-1]])
    index = np.arange(len(q))
    return order[index - np.maximum.accumulate(np.where(first, index, 0)) < k]


def _repeated(ids: np.ndarray, vectors: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """True for the second and further rows of the same id, vector and bucket."""
    again = np.zeros(len(ids), bool)
    same = np.zeros(len(ids) + 1, bool)
    same[1:-1] = (ids[1:] == ids[:-1]) & (buckets[1:] == buckets[:-1])
    some = np.flatnonzero(same[:-1] | same[1:])
    if len(some):
        names = np.ascontiguousarray(np.column_stack([vectors[some].view(np.int64), ids[some], buckets[some]]))
        first = np.unique(names.view(f"V{names.shape[1] * 8}").ravel(), return_index=True)[1]
        again[some] = True
        again[some[first]] = False
    return again


def _kth(product: np.ndarray, ids: np.ndarray, asked: np.ndarray, k: int) -> np.ndarray | None:
    """The ``k``-th best product of every query over distinct ids (adjacent here) other than its own."""
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    names = ids[starts]
    if len(names) <= k:
        return None
    best = product.copy() if len(names) == len(ids) else np.maximum.reduceat(product, starts, axis=1)
    own = np.minimum(np.searchsorted(names, asked), len(names) - 1)
    mine = np.flatnonzero(names[own] == asked)
    best[mine, own[mine]] = -np.inf
    return -np.partition(-best, k - 1, axis=1)[:, k - 1]


def _rank(queries: pa.Table, members: pa.Table, k: int):
    """The ``k`` best members of the visited buckets for every query, ``(query, id, score)``."""
    ids = members.column("id").to_numpy()
    vectors = members.column("vec").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    buckets = members.column("buckets").combine_chunks().flatten().to_numpy()
    order = np.lexsort((ids, buckets))
    ids, vectors, buckets = ids[order], vectors[order], buckets[order]
    again = _repeated(ids, vectors, buckets)
    if again.any():
        ids, vectors, buckets = ids[~again], vectors[~again], buckets[~again]
    names, starts = np.unique(buckets, return_index=True)
    ends = np.append(starts[1:], len(buckets))
    for begin in range(0, queries.num_rows, 1024):
        some = queries.slice(begin, 1024)
        asked = some.column("id").to_numpy()
        q = some.column("vec").combine_chunks().flatten().to_numpy().reshape(len(asked), -1)
        lists = some.column("buckets").combine_chunks()
        wanted, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(asked)), lists.value_lengths().to_numpy())
        spot = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        hit = names[spot] == wanted
        spot, owner = spot[hit], owner[hit]
        by = np.argsort(spot, kind="stable")
        spot, owner = spot[by], owner[by]
        edges = np.flatnonzero(np.diff(spot, prepend=-1, append=-1))
        floor = np.full(len(asked), -np.inf)
        rows, cols = [], []
        for a, b in zip(edges, edges[1:]):
            low, high, who = starts[spot[a]], ends[spot[a]], owner[a:b]
            for left in range(low, high, 4096):
                product = q[who] @ vectors[left : min(left + 4096, high)].T
                kth = _kth(product, ids[left : left + product.shape[1]], asked[who], k)
                if kth is not None:
                    floor[who] = np.maximum(floor[who], kth)
                # products of the same pair may differ in the last bits, so ties keep a margin
                r, c = np.nonzero(product >= floor[who][:, None] - 1e-9 * np.abs(floor[who])[:, None].clip(1, 1e300))
                rows.append(who[r])
                cols.append(c + left)
        if not rows:
            continue
        r, c = np.concatenate(rows), np.concatenate(cols)
        # one order of summation for every pair, so that equal vectors score equally
        score = np.concatenate(
            [(q[r[i : i + 65536]] * vectors[c[i : i + 65536]]).sum(axis=1) for i in range(0, len(r), 65536)]
        )
        other = ids[c] != asked[r]
        r, c, score = r[other], c[other], score[other]
        if not len(r):
            continue
        by = np.lexsort((-score, ids[c], r))  # an id counts once, with its best row
        single = np.concatenate([[True], (r[by][1:] != r[by][:-1]) | (ids[c[by]][1:] != ids[c[by]][:-1])])
        r, c, score = r[by[single]], c[by[single]], score[by[single]]
        top = _best(r, ids[c], score, k)
        yield asked[r[top]], ids[c[top]], score[top]


def _searched(rows: DataFrame, asking: DataFrame, ranges: list[_Range], k: int, how: Probing) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best of ``rows`` in what ``asking`` visits."""
    exact = any(not r.groups for r in ranges)
    chunks = max(1, -(-asking.count() // how.asked)) if exact else 1
    index = _indexed(rows, how, ranges, chunks)
    parts = stored(
        index.groupBy("t", "g").agg(F.ceil(F.count(F.lit(1)) / (2.0 * how.group_rows)).cast("int").alias("parts")), "index_groups"
    )
    members = lookup_join(index, parts, ["t", "g"], "inner").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    queries = lookup_join(_probed(asking, how, ranges, chunks), parts, ["t", "g"], "inner").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for run in runs_of(batches, [*_KEYS, "side"]):
            key = tuple(run.column(c)[0].as_py() for c in _KEYS)
            if run.column("side")[0].as_py() == 0:
                held = (key, run)
            elif held is not None and held[0] == key:
                for found in _rank(run, held[1], k):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    dealt = members.unionByName(queries).drop("parts").repartition(*_KEYS).sortWithinPartitions(*_KEYS, "side")
    found = dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, how: Probing = Probing()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best found for the rows of ``is_query``.

    ``vectors`` is ``(vec_id, embedding)``; ``is_query`` looks at these columns.
    """
    found = usable(vectors, is_query)
    rows, asking = found.drop("asks"), found.where("asks").drop("asks")
    ranges = _ranges(rows, how)
    found = _searched(rows, asking, ranges, k, how)
    if not any(r.groups for r in ranges):
        return found  # everything was compared
    found = stored(found, "nearest_found")
    # buckets serve neighbours nearer than a right angle; lists that reach beyond it are not trusted
    done = found.where((F.col("rank") == k) & (F.col("score") > 0)).select(F.col("query_id").alias("id"))
    short = stored(asking.join(done, "id", "left_anti"), "short_queries")
    if short.isEmpty():
        return found
    whole = _searched(rows, short, [_Range(0.0, 1.0, 0)], k, how)
    return found.join(done.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(whole)
