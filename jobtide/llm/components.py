"""Connected components of a graph given as edges, in DataFrame functions only.

Large-star and small-star steps in turn: each node's larger, then its smaller neighbours are tied
to the smallest node it knows, until nothing changes.  The number of rounds grows with the
logarithm of the number of nodes.  Every step is a minimum by key (pre-aggregated where the rows
are) and a join of two written tables, which Spark can split if one node has very many edges.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import settle


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (``a``, ``b``, any orderable type).

    The label is the smallest node of the component.  Loops only make their node known; edges
    with a null end are left out.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null")
    # One row per edge, the larger end first.
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    start = settle(both, folder, "edges-0")
    alone = start.where("u = v").select(F.col("u").alias("node"))
    stars = start.where("u <> v")
    seen = None
    number = 0
    while True:
        state = stars.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)
        ).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        number += 1
        ways = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(
            ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
            folder,
            f"large-{number}",
        )
        # Both ends of the larger direction only: v > u keeps every edge once.
        large = settle(
            stars.select(F.col("v").alias("u"), F.col("u").alias("v"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            folder,
            f"larger-{number}",
        )
        least = settle(
            large.groupBy("u").agg(F.min("v").alias("m")), folder, f"small-{number}"
        )
        tied = large.join(least, "u")
        stars = settle(
            tied.select(
                F.explode(
                    F.array(
                        F.struct("u", F.col("m").alias("v")),
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.*")
            .where("u <> v")
            .distinct(),
            folder,
            f"edges-{number}",
        )
    roots = stars.select(F.col("v").alias("node")).distinct()
    return (
        stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
        .unionByName(roots.select("node", F.col("node").alias("label")))
        .unionByName(
            alone.join(stars.select(F.col("u").alias("node")), "node", "left_anti")
            .join(roots, "node", "left_anti")
            .select("node", F.col("node").alias("label"))
        )
    )
