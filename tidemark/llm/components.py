"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import left_lookup
from tidemark.session import scratch_path


def _both_ways(links: DataFrame) -> DataFrame:
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select(F.inline(F.array(F.struct("a", "b"), back)))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest node around it.

    Large: only the neighbours above the node. Small: those below it, and the
    node itself. The smallest neighbour is an aggregate that combines before the
    exchange, and the join back lets AQE split a node with very many links.
    """
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    ways = _both_ways(links) if large else down
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    met = left_lookup(ways, least, ["a"], "inner")
    if large:
        linked = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        ends = F.array(*[F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")])
        linked = met.select(F.inline(ends))
    return linked.filter("a != b").distinct()


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root``: smallest node reachable, for every node of the links ``a, b``.

    Nodes are whole numbers; links may repeat and come in either direction, null
    ends and loops are left out, and no links give no rows. The number of rounds
    grows with the logarithm of the longest path. Each is written to the shared
    folder, which cuts the lineage; it ends when a round changes no link.
    """
    spark = links.sparkSession
    folder = scratch_path(spark, label)

    def fixed(frame: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        path = f"{folder}/{number}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        mark = frame.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return frame, tuple(mark)

    current, mark = fixed(links.filter("a != b").select("a", "b").distinct(), 0)
    number = 0
    while mark[0]:
        number += 1
        following, new_mark = fixed(_star(_star(current, large=True), large=False), number)
        if new_mark == mark:
            break
        current, mark = following, new_mark
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
