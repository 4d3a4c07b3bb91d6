"""Weighted paths, forests, messages and residual PageRank against small plain versions."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import graph, paths
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def links(spark):
    rng = random.Random(9)
    made = [(rng.randrange(60), rng.randrange(60), rng.choice([0, 1, 1, 2, 5, 30])) for _ in range(160)]
    made += [(7, k, 40 + k % 3) for k in range(60)] + [(100, 101, 3), (101, 100, 3), (102, 102, 1)]
    return made


def frame(spark, data):
    return spark.createDataFrame(data, "src int, dst int, weight int")


@pytest.mark.parametrize("width", [None, 0.5, 1000.0])
def test_shortest_paths(spark, links, width):
    best, queue = {}, [(0, 3), (0, 100)]
    while queue:
        d, v = heapq.heappop(queue)
        if v not in best:
            best[v] = d
            for a, b, w in links:
                if a == v:
                    heapq.heappush(queue, (d + w, b))
    sources = spark.createDataFrame([(3,), (100,), (3,)], "id int")
    got = paths.shortest_paths(frame(spark, links), sources, width)
    assert {tuple(r) for r in got.collect()} == set(best.items())


def test_paths_need_weights_and_sources(spark):
    one = spark.createDataFrame([(1,)], "id int")
    for weight in (-1, None):
        with pytest.raises(Exception, match="negative or missing"):
            paths.shortest_paths(frame(spark, [(1, 2, weight)]), one)
    assert paths.shortest_paths(frame(spark, [(1, 2, 1)]), one.limit(0)).isEmpty()
    assert rows(paths.shortest_paths(frame(spark, []), one)) == [(1, 0)]


def test_spanning_forest(spark, links):
    lightest = {}
    for a, b, w in links:
        if a != b:
            key = min(a, b), max(a, b)
            lightest[key] = min(w, lightest.get(key, w))
    top = {v: v for key in lightest for v in key}

    def root(v):
        while top[v] != v:
            v = top[v]
        return v

    want = set()
    for w, a, b in sorted((w, a, b) for (a, b), w in lightest.items()):
        if root(a) != root(b):
            top[root(a)] = root(b)
            want.add((a, b, w))
    assert {tuple(r) for r in paths.spanning_forest(frame(spark, links)).collect()} == want
    assert paths.spanning_forest(frame(spark, [(1, 1, 1)])).isEmpty()


@pytest.mark.parametrize("share", [0.02, 1.0])
def test_messages_along_edges(spark, links, share):
    vertices = spark.createDataFrame([(v, v * 10) for v in range(110) if v != 5], "id int, size int")
    got = paths.aggregate_messages(
        frame(spark, links), vertices, [F.sum("message").alias("s"), F.count(F.lit(1)).alias("n")],
        to_dst=F.when(F.col("weight") > 0, F.col("source.size") * F.col("weight")), to_src=F.col("target.size") + 1,
        cells=3, share=share,
    )
    want = {}
    for a, b, w in links:
        if 5 not in (a, b):
            for v, m in ((b, a * 10 * w if w > 0 else None), (a, b * 10 + 1)):
                if m is not None:
                    s, n = want.get(v, (0, 0))
                    want[v] = s + m, n + 1
    assert {tuple(r) for r in got.collect()} == {(v, *x) for v, x in want.items()}


def test_residual_pagerank_agrees_with_rounds(spark, links):
    """Also with vertices that have no way out."""
    edges = frame(spark, links)
    want = {r["id"]: r["rank"] for r in graph.pagerank(edges, 60).collect()}
    got = {r["id"]: r["rank"] for r in paths.pagerank_by_residuals(edges, 1e-4, share=0.05, cells=3).collect()}
    assert got.keys() == want.keys() and max(abs(got[v] - want[v]) for v in want) < 0.02


def test_rounds_of_residual_pagerank_move_vertices_not_edges(spark, monkeypatch):
    """Lists of targets are bounded, and a round joins those that were dealt once."""
    monkeypatch.setattr(paths, "LIST", 4)
    links = {(0, k) for k in range(1, 20)} | {(k, 0) for k in range(1, 20, 2)} | {(k, k + 1) for k in range(1, 20)}
    plans, settle = [], paths.settle
    monkeypatch.setattr(paths, "settle", lambda df: plans.append(plan(df)) or settle(df))
    df = spark.createDataFrame([*links, (0, 1)], "src long, dst long")
    got = {r["id"]: r["rank"] for r in paths.pagerank_by_residuals(df, 0.01).collect()}
    rank = dict.fromkeys(range(21), 1.0)
    for _ in range(100):
        sent = dict.fromkeys(rank, 0.15 + 0.85 * rank[20] / len(rank))
        for a, b in links:
            sent[b] += 0.85 * rank[a] / sum(1 for x, _ in links if x == a)
        rank = sent
    assert got.keys() == rank.keys() and max(abs(got[v] - rank[v]) for v in rank) < 0.2
    assert len(plans) > 2 and all("InMemoryTableScan" in p and "collect_list" in p for p in plans[2:])
