"""Connected components of a large graph, as joins and aggregations.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step keeps the components
and pulls links towards the smallest node, until each component is one star.
Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import looked_up, saved


def _pull(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over links (u, v), each given from both of its ends.

    The smallest neighbour of each node is an aggregate, and the join gives it
    to the node's links; no node's neighbours are gathered in one row or task,
    and no table of nodes in the driver.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = looked_up(links, least, "u")
    if larger:  # neighbours above the node go to its smallest neighbour
        return met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    # neighbours below the node, and the node itself, go to the smallest of them
    below = met.filter(F.col("v") < F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v")))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (u, v); component: its smallest node.

    ``links``: two non-null bigint columns; repeats, loops and either
    direction are allowed.  No links give no rows.  Each round is written to
    the shared scratch folder; the driver sees two numbers of it.
    """
    links = saved(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .filter("u <> v").distinct(), "components")
    mark = None
    while True:
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        large = _pull(_both_ways(links), larger=True).filter("u <> v").distinct()
        links = saved(_pull(_both_ways(large), larger=False).filter("u <> v").distinct(), "components")
    own = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
