"""Connected components of a table of links, by alternating large-star and small-star steps.

Nothing is gathered on the driver: each step is a join and an aggregation
over the links, and is written to the shared folder.  The number of steps
grows with the logarithm of the longest path, and links that the join already
contracted to stars need two or three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm._bitmaps import join_groups
from weftline.llm._text import written


#: With no more links than this, the neighbours of one centre are few enough for a task, however many of them it has.
FEW = 1 << 20


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """One step over `n` or fewer distinct (u, v), u != v: hang neighbours on the least neighbour.

    With more than FEW links the neighbours of a centre with very many are not
    gathered: its least neighbour is broadcast to them.
    """
    join = join_groups if n > FEW else lambda rows, groups, keys, _: rows.join(groups, keys)
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("_size"))
        out = join(both.filter("v > u"), least, ["u"], 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.filter("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_size"))
        out = join(down, least, ["u"], 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, limit: int = 60) -> DataFrame:
    """(node, root) of every node of (src, dst) that is not its own root; the root is the least node reachable.

    Self links and repeated links change nothing; an empty table gives none.
    """
    edges = links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "links")
    was, n = None, edges.count()
    for _ in range(limit):
        hung = _star(edges, True, n)
        edges = written(_star(written(hung, "links") if n > FEW else hung, False, n), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if now == was or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        was, n = now, now[0]
    raise RuntimeError(f"components did not settle in {limit} steps")
