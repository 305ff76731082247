"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import attach
from saleswright.storage import materialize


def _mark(edges: DataFrame) -> tuple:
    """A value that stays the same only if the set of edges does."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node each linked node can reach.

    ``edges`` has columns ``u`` and ``v`` (long). Alternates large-star and
    small-star steps, each of which links nodes to smaller ones without ever
    adding edges beyond the nodes' number; rounds grow with the logarithm of
    the size. Every step is written to the shared folder, so a lost executor
    costs one step. Returns ``node`` and ``root`` for nodes that have an edge;
    self-loops and repeated edges do no harm, no edges give no rows.
    """
    pairs = materialize(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _mark(pairs)
    while before[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = _star(both, before[0] * 2, larger_only=True)
        pairs = _star(pairs, 0, larger_only=False)
        after = _mark(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _star(pairs: DataFrame, total: int, larger_only: bool) -> DataFrame:
    """One star step: every neighbour of a node is linked to the least among them."""
    least = materialize(
        pairs.groupBy("u").agg(
            F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("size")
        ),
        "least",
    )
    met = attach(pairs, least, ["u"], "size", total or pairs.count())
    if larger_only:
        linked = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = met.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return materialize(linked.filter("u <> v").distinct(), "star")
