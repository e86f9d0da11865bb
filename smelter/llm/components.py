"""Connected components of a link table, as Spark jobs.

Each round has a large-star and a small-star step: every node points its
larger neighbours, then its smaller ones, at the least node it knows.  A round
costs two shuffles of the links; chains shorten geometrically.  Links are
grouped by minimum, which combines before the shuffle, so a hub of any degree
is no large group.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.common import small_or_not, stored

MAX_ROUNDS, LINKS_PER_TASK = 60, 200_000


def _star(links: DataFrame, large: bool, parts: int) -> DataFrame:
    """One star step over links (u > v): large joins each node's greater
    neighbours to its least one, small its lesser neighbours and itself."""
    if large:
        near = links.select(F.col("u").alias("node"), F.col("v").alias("other")).union(
            links.select(F.col("v"), F.col("u")))
    else:
        near = links.select(F.col("u").alias("node"), F.col("v").alias("other"))
    least = near.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node"))
    # stored, so that a small one is known to be small, and else both sides of
    # the join are dealt anew and a hub's rows can be split
    least = small_or_not(stored(least.coalesce(parts), "least"))
    joined = near.join(least, "node")
    if large:
        out = joined.where("other > node").select(F.col("other").alias("u"), F.col("least").alias("v"))
    else:
        out = joined.select(F.col("other").alias("u"), F.col("least").alias("v")).union(
            least.select(F.col("node").alias("u"), F.col("least").alias("v")))
    return out.where("u <> v").distinct().coalesce(parts)


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link; the component is named by
    its least node.  Links to itself and null ends are ignored."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stored(now.where("u > v").distinct(), "links")
    # few rows need few tasks: no round has more links than twice the first
    parts, state = 1 + 2 * now.count() // LINKS_PER_TASK, None
    for _ in range(MAX_ROUNDS):
        now = stored(_star(_star(now, True, parts), False, parts), "links")
        # settled when every node points at one node that points nowhere
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v"), F.col("v"))).distinct()
        state = tuple(found)
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
