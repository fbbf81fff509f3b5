"""Connected components of an undirected graph, labelled with the least node.

Alternating large-star and small-star steps: every node hands its larger (then
smaller) neighbours to its least neighbour, until the edges form one star per
component. Each round is a table in the shared folder, so a lost executor repeats a
round at most. Only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import with_group_min
from plumbline.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = with_group_min(both, "a", "b", "m", ["b"])
    return (
        least.filter("b > a")
        .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        .filter("a != b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = with_group_min(down, "a", "b", "m", ["b"])
    return (
        least.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .filter("a != b")
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` but the roots themselves.

    ``root`` is the least node of the component. Self loops and repeated edges are
    allowed; rows with a null end are ignored; no edge gives no row.
    """
    now = materialise(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = _mark(now)
    while seen[0]:
        now = materialise(_small_star(materialise(_large_star(now), "large")), "small")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
