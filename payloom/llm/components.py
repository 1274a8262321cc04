"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with the least neighbour of u (itself included).

    The least neighbours are dealt anew before the join, so that both sides of
    it are plain exchanges and Spark can split the part of a node with very
    many neighbours.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.join(least.repartition(parts), "u")


def _both(rows: DataFrame, *edges: tuple[str, str]) -> DataFrame:
    """Edges (u, v), one per row and pair of columns; rows are read once."""
    return rows.select(F.inline(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in edges))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; a component is named by its least node.

    Every round links each node's larger neighbours to the least one, then its
    smaller ones; rounds grow with the logarithm of the longest path. Each
    round's edges are written to the shared folder.
    """
    rows = edges.toDF("u", "v").filter("u <> v")
    now = written(rows.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        # Two short plans a round: neither reads what the other has shuffled, and the driver keeps few exchanges.
        large = _with_least(_both(now, ("u", "v"), ("v", "u"))).filter("v > u")
        large = written(large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "stars")
        now = written(_both(_with_least(large), ("v", "least"), ("u", "least")).filter("u <> v").distinct(), "edges")
        found = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if found == state:
            ends = _both(now, ("u", "v"), ("v", "v"))
            return written(ends.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct(), "components")
        state = found
