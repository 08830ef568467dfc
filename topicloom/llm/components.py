"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node around ``node``.

    ``edges`` is ``(node, low)`` with ``low < node``. The large star moves the higher
    neighbours of every node, the small star the lower ones and the node itself.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    else:
        around = edges
    least = around.groupBy("node").agg(F.min("low").alias("least"))
    met = around.join(least, "node").select("node", F.col("low").alias("other"), "least")
    if large:
        met = met.where("other > node").select(F.col("other").alias("node"), F.least("node", "least").alias("low"))
    else:
        # the node itself comes in once with its smallest neighbour
        met = met.select(
            F.when(F.col("other") == F.col("least"), F.col("node")).otherwise(F.col("other")).alias("node"),
            F.col("least").alias("low"),
        )
    return met.distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Every node hangs on one other, and none that others hang on hangs itself."""
    ends = edges.select(F.col("node").alias("x"), F.lit(1).alias("lows"), F.lit(False).alias("holds")).unionByName(
        edges.select(F.col("low").alias("x"), F.lit(0).alias("lows"), F.lit(True).alias("holds"))
    )
    met = ends.groupBy("x").agg(F.sum("lows").alias("lows"), F.bool_or("holds").alias("holds"))
    return not met.agg(F.bool_or((F.col("lows") > 1) | ((F.col("lows") > 0) & F.col("holds")))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of all but the smallest node of every component; root is the smallest.

    ``links`` is ``(a, b)`` with ``a != b``. The number of rounds grows with the logarithm
    of the longest path; every round is written to the shared folder. Links that are stars
    already take none.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct(), "links"
    )
    while not _are_stars(edges):
        edges = stored(_stars(_stars(edges, large=True), large=False), "star_round")
    return edges.select("node", F.col("low").alias("root"))


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The ``(node, root)`` of :func:`components` after more links: components are joined as a whole,
    so a round takes no more rows than there are links between different ones."""
    for side in ("a", "b"):
        of_side = roots.select(F.col("node").alias(side), F.col("root").alias("to"))
        links = links.join(of_side, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    joined = components(links.where("a != b"))
    to = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return stored(moved.unionByName(joined), "joined_components")
