"""Connected components of a link table, as DataFrame rounds.

Alternating large-star and small-star contraction (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round replaces the links of
each node by links to the smallest neighbour. Each round is a grouped minimum
(combined map-side) and one equi-join on the node, both of which AQE can split
when a node is hot; the link table is written to the shared folder after each
round, so a lost executor costs one round. Links never reach the driver, only
one row of totals does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(a.alias("a"), b.alias("b"))


def _least(edges: DataFrame) -> DataFrame:
    """Smallest of each node's neighbours and itself."""
    return edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low")).select(
        "n", F.least("n", "low").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) long -> (node, component): the smallest node id reachable.

    Nulls and self links are dropped; repeated links are harmless; an empty
    table gives an empty result. Nodes without links do not appear.
    """
    spark = links.sparkSession
    e = links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).where("a <> b").distinct()
    e = persist_cut(e, spark, "cc")
    before = None
    while True:
        # Large star: every node tells its larger neighbours its smallest one.
        both = e.unionByName(_pairs(e, F.col("b"), F.col("a")))
        low = _least(both)
        up = both.where("b > a").join(low, F.col("a") == F.col("n"))
        e = _pairs(up, F.col("b"), F.col("low")).where("a <> b").distinct()
        # Small star: every node tells its smaller neighbours the smallest one.
        low = _least(e)
        down = e.join(low, F.col("a") == F.col("n"))
        e = _pairs(down, F.col("b"), F.col("low")).unionByName(
            _pairs(low, F.col("n"), F.col("low"))).where("a <> b").distinct()
        e = persist_cut(e, spark, "cc")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                    F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
