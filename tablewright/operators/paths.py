"""Weighted paths, spanning forests, messages along edges with attributes, and PageRank by residuals.

All work in rounds of joins. State is written to the shared folder after each round, so a plan never
grows and a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.graph import connected_components, vertices_of
from tablewright.operators.slices import large_groups, number_of_tasks
from tablewright.session import settle

LIST = 10_000  # targets that a row of a vertex's edges may hold


def shortest_paths(edges: DataFrame, sources: DataFrame, width: float | None = None) -> DataFrame:
    """(id, distance): the least sum of weights on a way from any source, for every vertex that has one.

    ``edges`` has ``src``, ``dst`` and ``weight``, which may not be negative (the job fails). Distances are
    looked at in buckets of ``width``, the mean weight unless given: a round sends on what the vertices of
    the lowest open bucket have gained, so far vertices are not touched until near ones are settled.
    Only open vertices of that bucket are joined with edges.
    """
    bad = F.raise_error(F.lit("a weight is negative or missing"))
    weight = F.when(F.col("weight") >= 0, F.col("weight")).otherwise(bad)
    steps = settle(edges.groupBy("src", "dst").agg(F.min(weight).alias("weight")))
    if width is None:
        width = float(steps.agg(F.avg("weight")).first()[0] or 1.0)
    width = width or 1.0
    zero = F.lit(0).cast(dict(edges.dtypes)["weight"])
    state = settle(sources.select("id").distinct().select("id", zero.alias("distance"), F.lit(True).alias("open")))
    while True:
        nearest = state.filter("open").agg(F.min("distance")).first()[0]
        if nearest is None:
            return state.select("id", "distance")
        bound = (int(float(nearest) // width) + 1) * width
        now = F.col("open") & (F.col("distance") < F.lit(bound))
        sent = state.filter(now).select(F.col("id").alias("src"), "distance").join(steps, "src")
        found = sent.groupBy(F.col("dst").alias("id")).agg(F.min(F.col("distance") + F.col("weight")).alias("__new"))
        better = F.col("__new").isNotNull() & (F.col("distance").isNull() | (F.col("__new") < F.col("distance")))
        still = F.coalesce(F.col("open") & ~now, F.lit(False))
        state = settle(
            state.join(found, "id", "full").select(
                "id",
                F.when(better, F.col("__new")).otherwise(F.col("distance")).alias("distance"),
                (better | still).alias("open"),
            )
        )


def spanning_forest(edges: DataFrame) -> DataFrame:
    """The edges (``src`` < ``dst``, ``weight``) of the minimum spanning forest, directions left aside.

    Boruvka: every component takes its lightest edge to another one, the components so joined are
    numbered anew, and edges inside a component go. Components at least halve each round. Of equal
    weights the smaller ``src``, then ``dst`` counts as lighter, which makes the forest one.
    """
    ends = F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    links = edges.filter("src <> dst").select(*ends, "weight").groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    left = settle(links.select("src", "dst", "weight", F.col("src").alias("a"), F.col("dst").alias("b")))
    forest = None
    while not left.isEmpty():
        edge = F.struct("weight", "src", "dst", "a", "b")
        either = left.select(F.explode(F.array("a", "b")).alias("part"), edge.alias("edge"))
        chosen = settle(either.groupBy("part").agg(F.min("edge").alias("edge")).select("edge.*").distinct())
        taken = chosen.select("src", "dst", "weight")
        forest = taken if forest is None else forest.unionByName(taken)
        parts = connected_components(chosen.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        for side in ("a", "b"):
            new = parts.select(F.col("id").alias(side), F.col("component").alias("__new"))
            left = left.join(new, side, "left").withColumn(side, F.coalesce("__new", side)).drop("__new")
        left = settle(left.filter("a <> b"))
    return edges.select(*ends, "weight").limit(0) if forest is None else settle(forest)


def with_cells(edges: DataFrame, end: str, cells: int, share: float) -> tuple[DataFrame, Column]:
    """Edges with a ``cell``, and the cells that a vertex's row must go to.

    Vertices on that end of more than ``share`` of the edges are hubs: their edges are dealt to ``cells``
    cells by the other end, a grid of source and target. All other edges are in cell 0.
    """
    other = "dst" if end == "src" else "src"
    _, hubs = large_groups(edges, [end], share)
    hub = F.xxhash64(end).isin(hubs) if hubs else F.lit(False)
    cell = F.when(hub, F.pmod(F.xxhash64(other), F.lit(cells)).cast("int")).otherwise(F.lit(0))
    every = F.sequence(F.lit(0), F.lit(cells - 1))
    there = F.when(F.xxhash64("id").isin(hubs) if hubs else F.lit(False), every).otherwise(F.array(F.lit(0)))
    return edges.withColumn("cell", cell), there


def aggregate_messages(
    edges: DataFrame,
    vertices: DataFrame,
    measures: Sequence[Column],
    to_dst: Column | None = None,
    to_src: Column | None = None,
    cells: int = 16,
    share: float = 0.001,
) -> DataFrame:
    """Aggregates of the messages that reach a vertex, over edges and vertices with attributes.

    A message is an expression over the columns of ``edges``, and ``source`` and ``target``, structs of the two vertices'
    columns; the measures aggregate ``message``. A NULL message is not sent. A hub's edges lie in several tasks
    (``with_cells``), and messages are added up there before they meet at their vertex.
    """
    rows = edges
    for end, name in (("src", "source"), ("dst", "target")):
        rows, there = with_cells(rows, end, cells, share)
        side = vertices.select(F.col("id").alias(end), F.struct(*vertices.columns).alias(name), F.explode(there).alias("cell"))
        rows = rows.join(side, [end, "cell"]).drop("cell")
    sent = []
    for end, message in (("dst", to_dst), ("src", to_src)):
        if message is not None:
            sent.append(F.struct(F.col(end).alias("id"), message.alias("message")))
    made = rows.select(F.inline(F.array(*sent))).filter("message IS NOT NULL")
    return made.groupBy("id").agg(*measures)


def pagerank_by_residuals(
    edges: DataFrame, tol: float, damping: float = 0.85, cells: int = 16, share: float = 0.001
) -> DataFrame:
    """PageRank with ranks that add up to about the number of vertices; only vertices that still change move.

    Every vertex has a rank and a residual that it has not passed on. A round takes the vertices whose
    residual is above ``tol``, adds it to their rank and sends it along their edges, damped. What is left
    unsent is at most ``tol`` a vertex. Repeated edges count once; a vertex without out-edges
    spreads what it sends over all, which is kept as one number for the whole table.

    Edges are kept as lists of about ``LIST`` targets at the most, dealt once, so that a round moves vertices and
    not edges. A vertex on more than ``share`` of the edges has ``cells`` lists at the least.
    """
    links = settle(edges.select("src", "dst").distinct())
    out = links.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    nodes = vertices_of(links).join(out, "id", "left")
    state = settle(nodes.select("id", "out", F.lit(0.0).alias("rank"), F.lit(1.0 - damping).alias("residual")))
    count, rows = state.agg(F.count(F.lit(1)), F.sum("out")).first()
    hub = F.when(F.col("out") > share * (rows or 0), cells).otherwise(1)
    parts = F.greatest(F.ceil(F.col("out") / LIST).cast("int"), hub)
    sized = links.join(state.select(F.col("id").alias("src"), parts.alias("parts")), "src")
    dealt = sized.select("src", F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("cell"), "dst")
    # the number of partitions is named so that a round's join finds the lists where they are
    placed = dealt.repartition(number_of_tasks(links), "src", "cell")
    lists = placed.groupBy("src", "cell").agg(F.collect_list("dst").alias("to")).persist(StorageLevel.MEMORY_AND_DISK)
    spread = 0.0  # that every vertex has got since the state was written
    moves = F.col("residual") > tol
    try:
        while True:
            state = state.withColumn("residual", F.col("residual") + F.lit(spread))
            stuck, active = state.filter(moves).agg(
                F.sum(F.when(F.col("out").isNull(), F.col("residual"))), F.count(F.lit(1))
            ).first()
            if not active:
                return state.select("id", (F.col("rank") + F.col("residual")).alias("rank"))
            spread = damping * float(stuck or 0.0) / count
            shares = state.filter(moves & F.col("out").isNotNull()).select(
                F.col("id").alias("src"),
                (F.col("residual") * damping / F.col("out")).alias("share"),
                F.explode(F.sequence(F.lit(0), parts - 1)).alias("cell"),
            )
            sent = lists.join(shares, ["src", "cell"]).select(F.explode("to").alias("id"), "share")
            got = sent.groupBy("id").agg(F.sum("share").alias("got"))
            state = settle(
                state.join(got, "id", "left").select(
                    "id",
                    "out",
                    F.when(moves, F.col("rank") + F.col("residual")).otherwise(F.col("rank")).alias("rank"),
                    (F.when(moves, 0.0).otherwise(F.col("residual")) + F.coalesce("got", F.lit(0.0))).alias("residual"),
                )
            )
    finally:
        lists.unpersist()
