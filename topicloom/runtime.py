"""Durable intermediates and lookup joins whose small side has a checked size."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

#: A lookup side with at most this many rows is broadcast.
BROADCAST_ROWS = 200_000

#: Copies of the lookup side when it is too large to broadcast.
LOOKUP_SALTS = 16


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, which the session names in ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may do without: a temporary
    folder is then shared by all. Anywhere else its absence is an error.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="topicloom-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from the written table.

    A table knows its true size. A checkpoint instead passes on the size estimated for the plan
    it stands for, which a join multiplies: after some rounds of joins that is a number of
    thousands of digits, and no join is ever seen to be small enough to broadcast.
    """
    path = shared_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_total(df: DataFrame):
    """Number of rows as a scalar subquery, so that no join is needed to use it."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def array_sums(rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], Iterable[np.ndarray]]) -> list[np.ndarray]:
    """Sums over all tasks of the arrays of doubles that ``partial`` returns in each.

    Every task returns as many arrays, of the same lengths. They are added up as a whole, each
    in one task, so no row is moved for a number and the driver gets one array of each.
    """

    def rowed(arrays: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = pa.array([a.tobytes() for a in arrays.values()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(arrays), pa.int32()), values], ["slot", "values"])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield rowed({i: np.ascontiguousarray(a, float) for i, a in enumerate(partial(batches))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                array = np.frombuffer(value.as_buffer())
                if slot in sums:
                    sums[slot] += array
                else:
                    sums[slot] = array.copy()
        yield rowed(sums)

    kinds = "slot int, values binary"
    found = rows.mapInArrow(give, kinds).repartition("slot").mapInArrow(add, kinds).toArrow()
    if not found.num_rows:  # there was no partition
        return [np.ascontiguousarray(a, float) for a in partial(iter(()))]
    return [np.frombuffer(v) for _, v in sorted(zip(found.column("slot").to_pylist(), found.column("values").to_pylist()))]


def spread_rows(df: DataFrame) -> DataFrame:
    """Use every core on inputs that come in fewer pieces than there are cores.

    Inputs with enough splits, that is all large ones, are returned as they are. So are
    plans with a shuffle, whose partitions are decided when they run.
    """
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = LOOKUP_SALTS,
) -> DataFrame:
    """Join facts to a lookup table with unique keys.

    The lookup is counted up to ``broadcast_rows`` + 1. Up to the bound it is
    broadcast; beyond it every lookup row is repeated once per salt and the facts
    spread over the salts, so that a hot key is shared by several tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if lookup.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return facts.join(F.broadcast(lookup), keys, how)
    return salted_join(facts, lookup, keys, how, salts)


def salted_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left", salts: int = LOOKUP_SALTS
) -> DataFrame:
    """Equi-join in which the rows of a hot key are shared by several tasks."""
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_facts.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")


def top_per_group(df: DataFrame, group: list[str], order: list, n: int, spread: str, salts: int = 256) -> DataFrame:
    """First ``n`` rows of every group with their ``rank``, a hot group being split first.

    Each group is cut to ``n`` rows within every salt of the ``spread`` column, so the
    final window sees at most ``n * salts`` rows of a group, whatever its size.
    """
    part = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    first = Window.partitionBy(*group, "_salt").orderBy(*order)
    last = Window.partitionBy(*group).orderBy(*order)
    return (
        part.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= n)
        .drop("_rank", "_salt")
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= n)
    )


def number_rows(df: DataFrame, order: list, name: str) -> DataFrame:
    """Consecutive numbers from 0 in the given total order, without one global window.

    The rows are range-sorted and written; each sorted partition is numbered on its own
    and shifted by the sizes of the partitions before it (one row per partition).
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, (F.col("_shift") + F.row_number().over(inside) - 1).cast("int"))
        .drop("_part", "_shift")
    )
