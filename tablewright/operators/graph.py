"""Edge tables: degrees, neighbourhoods, PageRank, hops and components.

The iterative operators write their state to the shared folder between rounds,
which keeps plans short and lets a lost executor recompute one round only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import settle


def vertices_of(edges: DataFrame) -> DataFrame:
    both = F.explode(F.array("src", "dst"))
    return edges.select(both.alias("id")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, from one scan."""
    ends = F.array(
        F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    return edges.select(F.inline(ends))


def degrees(edges: DataFrame) -> DataFrame:
    """In, out and total degree of every vertex, from one scan of the edges."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("id"), F.lit(0).alias("into"), F.lit(1).alias("out")),
            F.struct(F.col("dst").alias("id"), F.lit(1).alias("into"), F.lit(0).alias("out")),
        )
    )
    return (
        edges.select(ends.alias("e"))
        .groupBy(F.col("e.id").alias("id"))
        .agg(
            F.sum("e.into").alias("in_degree"),
            F.sum("e.out").alias("out_degree"),
            F.count(F.lit(1)).alias("degree"),
        )
    )


def neighbour_aggregate(
    edges: DataFrame, vertices: DataFrame, measures: Sequence[Column]
) -> DataFrame:
    """Aggregates over the source vertices of the edges that reach a vertex."""
    sent = edges.join(vertices.withColumnRenamed("id", "src"), "src")
    return sent.groupBy(F.col("dst").alias("id")).agg(*measures)


def pagerank(
    edges: DataFrame, rounds: int, damping: float = 0.85, tol: float | None = None
) -> DataFrame:
    """PageRank with ranks that add up to the number of vertices.

    Repeated edges count once. A vertex without out-edges spreads its rank over
    all. With ``tol`` it stops when no rank moves further than that.
    """
    links = settle(edges.select("src", "dst").distinct())
    out = links.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    nodes = settle(vertices_of(links).join(out, "id", "left"))
    count = nodes.count()
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for _ in range(rounds):
        stuck = ranks.agg(
            F.coalesce(F.sum(F.when(F.col("out").isNull(), F.col("rank"))), F.lit(0.0))
        )
        shares = ranks.select(F.col("id").alias("src"), (F.col("rank") / F.col("out")).alias("share"))
        got = links.join(shares, "src").groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("got"))
        base = F.lit(1 - damping) + damping * stuck.scalar() / count
        after = nodes.join(got, "id", "left").select(
            "id", "out", (base + damping * F.coalesce("got", F.lit(0.0))).alias("rank")
        )
        # Two later expressions read the ranks; settled, they are computed once.
        after = settle(after)
        before = ranks.select("id", F.col("rank").alias("old"))
        ranks = after
        if tol is not None:
            moved = after.join(before, "id").agg(F.max(F.abs(F.col("rank") - F.col("old"))))
            if (moved.first()[0] or 0.0) <= tol:
                break
    return ranks.select("id", "rank")


def hops(
    edges: DataFrame, sources: DataFrame, max_hops: int | None = None, directed: bool = True
) -> DataFrame:
    """Fewest edges from any source to each vertex it reaches (breadth first)."""
    steps = settle((edges if directed else both_ways(edges)).select("src", "dst").distinct())
    seen = settle(sources.select("id").distinct().withColumn("hops", F.lit(0)))
    frontier, level = seen, 0
    while max_hops is None or level < max_hops:
        level += 1
        reached = (
            steps.join(frontier.select(F.col("id").alias("src")), "src", "left_semi")
            .select(F.col("dst").alias("id"))
            .distinct()
            .join(seen, "id", "left_anti")
        )
        frontier = settle(reached.withColumn("hops", F.lit(level)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if level % 8 == 0:
            seen = settle(seen)
    return seen


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest vertex id of each vertex's component.

    Alternates two star steps (Kiveris et al., 2014): each vertex links its larger,
    then its smaller neighbours to the least of them, until nothing moves. The number
    of rounds grows with the logarithm of the graph, not with its diameter. Only the
    least neighbour per vertex is aggregated; no neighbour list is built.
    """
    vertices = vertices_of(edges)
    larger = F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    pairs = settle(edges.select(*larger).filter("u <> v").distinct())
    mark = None
    while True:
        around = both_ways(pairs.toDF("src", "dst")).toDF("u", "v")
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        star = (
            around.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        below = star.groupBy("u").agg(F.min("v").alias("m"))
        linked = star.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settle(
            linked.unionByName(below.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        now = pairs.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            break
        mark = now
    labels = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return vertices.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
