"""Connected components of a link table, by contraction, with DataFrame operations only.

Each round hooks every node onto its smallest neighbour, follows these pointers to their ends
by doubling, and replaces the links by links between the ends.  At least half of the nodes that
still have links vanish each round.  Minima are combined before the shuffle, and the joins read
written tables on both sides, so that Spark can split the partition of a node with very many
links.  Every round's tables are written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.broadcast import known_rows, materialize


def _write(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    out = materialize(df, name)
    return out, known_rows(out) or 0


def _ends(pointers: DataFrame) -> DataFrame:
    """``pointers`` (node, to) with every pointer followed to its end, two doublings a step."""
    while True:
        onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
        once = pointers.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
        step = once.join(onward, "to", "left").select(
            "node", F.coalesce("further", "to").alias("to"), (F.coalesce("further", "to") != F.col("to")).alias("moved"))
        step, _ = _write(step, "pointers")
        pointers = step.select("node", "to")
        if step.where("moved").isEmpty():
            return pointers


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``links``; a component is named by its smallest node.

    Links are undirected; repeated links and links of a node to itself do no harm (a node that
    only links to itself is left out, as are links with a null end).
    """
    links, n = _write(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                      .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))).distinct(), "links")
    ends = None
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        pointers, _ = _write(both.groupBy("node").agg(F.min("other").alias("to")).select("node", F.least("node", "to").alias("to")), "pointers")
        pointers = _ends(pointers)
        if ends is None:
            ends = pointers
        elif n:
            again = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
            ends, _ = _write(ends.join(again, "to", "left").select("node", F.coalesce("further", "to").alias("to")), "ends")
        if not n:
            return ends.select("node", F.col("to").alias("component"))
        to_a = pointers.select(F.col("node").alias("a"), F.col("to").alias("end_a"))
        to_b = pointers.select(F.col("node").alias("b"), F.col("to").alias("end_b"))
        links, n = _write(links.join(to_a, "a").join(to_b, "b").where("end_a != end_b")
                          .select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b")).distinct(), "links")
        if not n:
            return ends.select("node", F.col("to").alias("component"))
