"""Density topics from a tree over counted grid cells.

The vectors are cut into cells and counted; the density of a cell is the number of documents in
it and the cells around it. Every cell leads to its densest neighbour, which cuts the cells into
hills with one peak each. Hills meet at saddles: the density at which a path from one to the
other has its lowest cell, at best. The saddles are the edges of a graph over peaks, much
smaller than the cells, and rounds of joining along everybody's highest saddle (a maximum
spanning forest, as by Boruvka) give the density tree.

A branch of the tree is a topic of its own if its peak is too high to be chance at the density
of its saddle, whatever its size: the deviance of a Poisson count, against the logarithm of the
number of cells. Otherwise it belongs to the hill across the saddle. So large and small topics,
dense and thin ones, come out of one pass, and the rule doesn't change with the number of
documents. The background is what the documents would give if they were spread evenly.

Every topic found is looked at again with cells that follow its own spread, and is replaced by
its branches if there are two or more. What rises above the background in no way is looked at
again with cells of half the width, and so on, until no neighbourhood holds enough documents: a
tight group of a few documents is found in whatever noise, since the noise gets thinner with
every level and the group doesn't. All groups of a level share its passes.

All tables are keyed by cells or peaks; the driver gets a count or two a round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from topicloom.runtime import cut_lineage, lookup_join

#: Chance of taking any bump of an even density for a topic.
CHANCE = 0.01

#: The group of what is in no topic yet.
REST = ""

#: A cell turns into 3 ** dims rows for its neighbours.
MAX_DIMS = 8


def spreads(coords: DataFrame, dims: int) -> tuple[list[float], int]:
    """Standard deviation of each coordinate, and the number of documents."""
    columns = [F.stddev_pop(F.get("coords", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    row = coords.agg(F.count(F.lit(1)).alias("n"), *columns).first()
    return [float(row[f"s{i}"] or 0.0) for i in range(dims)], row["n"]


def cell_name(parts: Sequence[Column]) -> Column:
    """One number for a cell. Two of a million cells share one with a chance of 3e-8."""
    return F.xxhash64(*parts)


def around(cells: DataFrame, dims: int, *columns: str) -> DataFrame:
    """``(cell, columns, near)``: a row for each cell and cell around it, itself included.

    ``cells`` holds the cell's group in ``grp`` and its numbers in ``at``. One explode for each
    dimension keeps all 3 ** dims rows inside generated code.
    """
    out = cells.select("cell", "grp", "at", *columns)
    for i in range(dims):
        out = out.withColumn(f"_{i}", F.explode(F.array(*[F.lit(x).cast("long") for x in (-1, 0, 1)])))
    near = cell_name([F.col("grp"), *(F.get("at", F.lit(i)) + F.col(f"_{i}") for i in range(dims))])
    return out.select("cell", *columns, near.alias("near"))


def ends_of(ways: DataFrame) -> DataFrame:
    """``(node, end)`` of ``(node, next)``: ways followed to where they end.

    Two jumps a round, so the steps a round covers grow fourfold each time. A node whose
    ``next`` is itself, or that leads to a node without a row, is an end.
    """
    now = ways.select("node", F.col("next").alias("end"))
    while True:
        for _ in range(2):
            step = now.where("node != end").select(F.col("node").alias("end"), F.col("end").alias("further"))
            jumped = now.select("node", "end").join(step, "end", "left")
            now = jumped.select("node", F.coalesce("further", "end").alias("end"), F.col("further").isNotNull().alias("moved"))
        now = cut_lineage(now)
        if now.where("moved").isEmpty():
            return now.select("node", "end")
        now = now.select("node", "end")


def deviance(count: str | Column, expected: Column) -> Column:
    """How unlikely so high a Poisson count is: minus the logarithm of Chernoff's bound; 0 below."""
    c = (F.col(count) if isinstance(count, str) else count).cast("double")
    return F.when(c > expected, c * F.log(c / expected) - c + expected).otherwise(F.lit(0.0))


def join_hills(peaks: DataFrame, saddles: DataFrame, least: float) -> DataFrame:
    """``(peak, top)``: the hills whose peaks stand out, for every hill.

    ``peaks`` is ``(peak, height, background)``, ``saddles`` is ``(a, b, low)`` in both directions.
    A hill that doesn't stand out over its highest saddle to a higher hill joins that hill. One
    that stands out over all its saddles is settled, as what joins it later comes by lower ones.
    Others wait for the lower hills around them: these may join and bring further saddles. All
    hills of a round decide together; the lowest always can, so there is an end.
    """
    owners = peaks.select("peak", F.col("peak").alias("top"))
    heights = cut_lineage(peaks.select("peak", "height", "background", F.lit(False).alias("settled")))
    while True:
        one = heights.select(
            F.col("peak").alias("a"), F.struct("height", "peak").alias("ha"), F.col("settled").alias("sa"), "background"
        )
        two = heights.select(F.col("peak").alias("b"), F.struct("height", "peak").alias("hb"), F.col("settled").alias("sb"))
        open_saddles = cut_lineage(
            saddles.join(one, "a").join(two, "b").where("not ((sa and hb > ha) or (sb and ha > hb))")
        )
        higher = F.when(F.col("hb") > F.col("ha"), F.struct("low", "hb", "b"))
        best = open_saddles.groupBy("a").agg(
            F.max(higher).alias("best"), F.max("low").alias("highest"), F.first("ha").alias("ha"),
            F.first("background").alias("background"),
        )
        stands = lambda low: deviance("ha.height", F.greatest(F.col(low).cast("double"), "background")) >= least
        choice = F.when(~stands("best.low"), F.lit(False)).when(stands("highest"), F.lit(True))
        decided = best.where("best is not null").select("a", F.col("best.b").alias("b"), choice.alias("stands"))
        decided = cut_lineage(decided.where("stands is not null"))
        if decided.isEmpty():
            return owners
        joined = ends_of(decided.where("not stands").select(F.col("a").alias("node"), F.col("b").alias("next")))
        settled = decided.where("stands").select(F.col("a").alias("peak"), F.lit(True).alias("now"))
        to = joined.select(F.col("node").alias("peak"), F.col("end").alias("to"))
        heights = cut_lineage(
            heights.join(to, "peak", "left_anti")
            .join(settled, "peak", "left")
            .select("peak", "height", "background", (F.col("settled") | F.coalesce("now", F.lit(False))).alias("settled"))
        )
        owners = owners.join(to.withColumnRenamed("peak", "top"), "top", "left").select(
            "peak", F.coalesce("to", "top").alias("top")
        )
        moved = open_saddles.select("a", "b", "low")
        for side in ("a", "b"):
            moved = moved.join(to.withColumnRenamed("peak", side), side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
        saddles = moved.where("a != b").groupBy("a", "b").agg(F.max("low").alias("low"))


def cell_tops(cells: DataFrame, dims: int, min_points: int) -> DataFrame | None:
    """``(grp, cell, n, top, above)`` of the cells whose neighbourhood holds ``min_points``
    documents, by the hill they belong to; ``above`` tells whether the cell rises above the
    background of its group.

    ``cells`` is ``(grp, cell, at, n, background)``. None if there is no such cell.
    """
    lent = around(cells, dims, "n").groupBy(F.col("near").alias("cell")).agg(F.sum("n").alias("density"))
    # estimates of sizes don't see that an explode multiplies rows, so nothing exploded may be broadcast
    core = cut_lineage(cells.join(lent.where(F.col("density") >= min_points).hint("merge"), "cell"))
    total = core.count()
    if not total:
        return None
    least = math.log(total / CHANCE)
    other = core.select(F.col("cell").alias("near"), F.col("density").alias("near_density"))
    touch = cut_lineage(around(core, dims, "density").where("near != cell").hint("merge").join(other, "near"))
    steepest = touch.groupBy("cell").agg(F.max(F.struct("near_density", "near")).alias("up"))
    here = F.struct(F.col("density").alias("near_density"), F.col("cell").alias("near"))
    ways = core.join(steepest, "cell", "left").select(
        F.col("cell").alias("node"), F.greatest(here, "up")["near"].alias("next")
    )
    hills = ends_of(ways).select(F.col("node").alias("cell"), F.col("end").alias("peak"))
    sides = touch.join(hills.withColumnRenamed("peak", "a"), "cell").join(
        hills.select(F.col("cell").alias("near"), F.col("peak").alias("b")), "near"
    )
    saddles = sides.where("a != b").groupBy("a", "b").agg(F.max(F.least("density", "near_density")).alias("low"))
    peaks = core.join(hills.where("cell = peak"), "cell").select("peak", F.col("density").alias("height"), "background")
    tops = join_hills(peaks, saddles, least)
    above = deviance("density", F.col("background")) >= least
    return core.join(hills, "cell").join(tops, "peak").select("grp", "cell", "n", "top", above.alias("above"))


def _grids(docs: DataFrame, dims: int, rest_widths: Sequence[float]) -> DataFrame:
    """``(grp, widths, background)``: cell widths of every group, by Scott's rule from its own
    spreads for topics, and the documents of a neighbourhood if the group were spread evenly."""
    each = [F.stddev_pop(F.get("coords", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    stats = docs.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *each)
    widths, share = [], F.lit(1.0)
    for i, rest_width in enumerate(rest_widths):
        spread = F.col(f"s{i}")
        own = spread * F.pow("n", F.lit(-1.0 / (dims + 4)))
        width = F.when(F.col("grp") == REST, F.lit(rest_width)).otherwise(own)
        # a coordinate without spread lies in one cell; an even one of spread s is sqrt(12) s wide
        widths.append(F.when(spread > 0, width).otherwise(1.0))
        share = share * F.when(spread > 0, F.least(3 * width / (spread * math.sqrt(12)), F.lit(1.0))).otherwise(1.0)
    return stats.select("grp", F.array(*widths).alias("widths"), F.greatest(F.col("n") * share, F.lit(1e-9)).alias("background"))


def _level(
    docs: DataFrame, dims: int, rest_widths: Sequence[float], min_points: int, min_topic_size: int, level: int
) -> tuple[DataFrame, DataFrame | None]:
    """``(id, grp)`` of the topics that have no branches, and ``(id, coords, grp)`` of what the
    next level has to look at, if there is anything."""
    grids = cut_lineage(_grids(docs, dims, rest_widths))
    parts = [F.floor(F.get("coords", F.lit(i)) / F.get("widths", F.lit(i))).cast("long") for i in range(dims)]
    placed = lookup_join(docs, grids, "grp", "inner").withColumn("at", F.array(*parts))
    placed = placed.withColumn("cell", cell_name([F.col("grp"), *parts])).drop("widths")
    counted = placed.groupBy("cell").agg(
        *(F.first(c).alias(c) for c in ("grp", "at", "background")), F.count(F.lit(1)).alias("n")
    )
    tops = cell_tops(cut_lineage(counted), dims, min_points)
    if tops is None:
        return cut_lineage(docs.where(F.col("grp") != REST).select("id", "grp")), None
    tops = cut_lineage(tops)
    sizes = tops.groupBy("grp", "top").agg(
        F.sum("n").alias("whole"), F.sum(F.when(F.col("above"), F.col("n"))).alias("size")
    )
    branches = sizes.where(F.col("size") >= min_topic_size).select("grp", "top")
    split = branches.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | (F.col("grp") == REST))
    split = split.select("grp", F.lit(True).alias("split"))
    named = F.concat_ws("/", "grp", F.concat_ws(":", F.lit(str(level)), F.col("top").cast("string")))
    # a part of a topic takes its whole hill along, what is nowhere yet only what rises above
    children = tops.where(F.col("above") | (F.col("grp") != REST)).join(branches.join(split, "grp", "left_semi"), ["grp", "top"])
    of_cell = children.select("cell", named.alias("child"))
    marked = lookup_join(placed.select("id", "coords", "grp", "cell"), of_cell, "cell")
    marked = cut_lineage(lookup_join(marked, split, "grp"))
    done = marked.where((F.col("grp") != REST) & F.col("split").isNull()).select("id", "grp")
    after = marked.where("child is not null").select("id", "coords", F.col("child").alias("grp"))
    # smaller cells only take hills apart, so without a hill of the size there never will be one
    hills = sizes.where(F.col("whole") >= min_topic_size)
    if not hills.where(F.col("grp") == REST).unionByName(hills.join(split.select("grp"), "grp", "left_semi")).isEmpty():
        left = marked.where("child is null and (split or grp = '')")
        after = after.unionByName(left.select("id", "coords", F.lit(REST).alias("grp")))
    return done, None if after.isEmpty() else after


def tree_topics(
    coords: DataFrame, min_points: int = 5, min_topic_size: int = 10, dims: int | None = None
) -> DataFrame:
    """``(id, label, size)`` of the documents in topics, one label a topic.

    Cells start at Scott's width, the spread of a coordinate times n ** (-1 / (d + 4)).
    Documents whose ``coords`` are null are in no topic.
    """
    if dims is None:
        dims = coords.select(F.max(F.size("coords"))).first()[0] or 0
    if not 0 < dims <= MAX_DIMS:
        raise ValueError(f"density topics need 1 to {MAX_DIMS} coordinates, not {dims}; reduce the vectors first")
    docs = cut_lineage(coords.where("coords is not null").select("id", "coords", F.lit(REST).alias("grp")))
    spread, total = spreads(docs, dims)
    widths = [s * max(1, total) ** (-1.0 / (dims + 4)) or 1.0 for s in spread]
    found, level = [], 0
    while docs is not None:
        done, docs = _level(docs, dims, [w / 2**level for w in widths], min_points, min_topic_size, level)
        found.append(done)
        level += 1
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    sizes = out.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    return lookup_join(out, sizes, "grp").select("id", F.col("grp").alias("label"), "size")
