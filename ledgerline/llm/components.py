"""Connected components of a graph by alternating large-star and small-star steps."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.llm.shared import broadcast_if_small, written

# Where a node has as many edges, its least neighbour goes to where its edges are.
HUB = 1000
FEW_HUBS = 1_000_000


def _with_least(edges, hubs):
    """``edges`` with the least neighbour ``m`` of ``u``; the edges of a hub meet in no task.

    ``hubs`` says that there may be any. Without, a window reads ``edges`` once: the plan of
    a join holds them twice, and so four times what went before two steps, which the driver
    plans anew after each of its stages.
    """
    if not hubs:
        return edges.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
    known = edges.join(
        broadcast_if_small(least.where(F.col("n") >= HUB).drop("n"), FEW_HUBS), "u", "left"
    )
    return known.where("m is not null").unionByName(
        known.where("m is null").drop("m").join(least.where(F.col("n") < HUB).drop("n"), "u")
    )


def _large_star(edges, hubs):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both, hubs).where("v > u")
    return moved.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges, hubs):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # The edge to the least neighbour stays, the others go on from theirs to it.
    moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return _with_least(down, hubs).select(moved.alias("u"), F.col("m").alias("v")).distinct()


def _mark(edges):
    """(ends of edges, sum of their hashes, most edges of a node)."""
    ends = edges.select(
        F.explode(F.array("u", "v")).alias("node"), F.xxhash64("u", "v").alias("hash")
    )
    each = ends.groupBy("node").agg(
        F.count("*").alias("n"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("hashes")
    )
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.sum("hashes"), F.coalesce(F.max("n"), F.lit(0))
    ).first()


def connected_components(edges):
    """(node, component) for every node of ``edges`` (u, v): the least node it reaches.

    Each round writes its edges, which never grow in number beyond those it got; rounds
    grow with the logarithm of the longest path. Nodes of no edge, and loops, have no row.
    """
    now = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        # Hubs grow from round to round: they are looked for before they are large.
        hubs = mark[2] >= HUB // 4
        now = written(_small_star(_large_star(now, hubs), hubs), "edges")
        before, mark = mark, _mark(now)
        if mark[:2] == before[:2]:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
