"""Connected components of a table of links, by contraction.

Each round every node takes the first node of its closed neighbourhood as its
new name, links are renamed and loops and repeats go.  Rounds alternate between
the order of the ids, in which a star collapses at once, and a hashed order, in
which a chain shrinks by a constant factor, so the number of rounds grows with
the logarithm of the longest path.  Links are only ever grouped by node with a
minimum and joined with one row per node, so a node with very many links is
split like any frequent key.  Every round's links and names are stored tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotativa.llm.common import sized, small
from rotativa.session import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its smallest node.

    Loops make a component of one node; NULL ends and repeated links are ignored.
    """
    links = stored(links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    names = []
    turn = 0
    while turn == 0 or not links.isEmpty():
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.unionByName(both.select("a", F.col("a").alias("b")))
        order = F.col("b") if turn % 2 == 0 else F.xxhash64(F.lit(turn), "b")
        name, count = sized(both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", order).alias("name")), "names")
        names.append((name, count))
        renamed = reduce(
            lambda rows, end: rows.join(small(name, count), rows[end] == name["node"]).drop(end, "node").withColumnRenamed("name", end),
            ("a", "b"),
            links,
        )
        shorter = stored(
            renamed.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
        )
        discard(links)
        links = shorter
        turn += 1
    discard(links)
    rows = names[0][0]
    for name, count in names[1:]:
        following = small(name.select(F.col("node").alias("_node"), F.col("name").alias("_name")), count)
        rows = rows.join(following, F.col("name") == F.col("_node"), "left").select(
            "node", F.coalesce("_name", "name").alias("name")
        )
    rows = stored(rows, "named")
    discard(*(name for name, _ in names))
    # a name is a node of its component, and the smallest only by chance
    least, count = sized(rows.groupBy("name").agg(F.min("node").alias("component")), "components")
    return rows.join(small(least, count), "name").select("node", "component")
