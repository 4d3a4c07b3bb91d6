import pytest
from pyspark.sql import functions as F

from tablewright.operators import aggregates, graph, joins, reshape, skew
from tablewright.operators.common import total
from tests.helpers import day, plan, rows


def test_plots_never_sown(spark):
    plots = spark.createDataFrame([("p1", "clay"), ("p2", "sand"), ("p3", "loam")], "plot string, soil string")
    sown = spark.createDataFrame([(7, "p2"), (8, "p2"), (9, None)], "crop int, plot string")
    missing = joins.missing_from(plots, sown, ["plot"])
    assert rows(missing.select("soil")) == [("clay",), ("loam",)]
    by_left = plots.join(sown, "plot", "left").filter("crop IS NULL").select("plot", "soil")
    assert rows(missing) == rows(by_left)


@pytest.mark.parametrize("listed", [[1, 2], [1, None], []])
def test_not_in_equals_sql(spark, listed):
    left = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    right = spark.createDataFrame([(v,) for v in listed], "y int")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert rows(joins.not_in(left, "x", right, "y")) == rows(spark.sql("SELECT x FROM l WHERE x NOT IN (SELECT y FROM r)"))


def test_points_of_teams(spark):
    teams = spark.createDataFrame([(1, "Otters"), (2, "Herons"), (3, "Newts")], "team_id int, team_name string")
    matches = spark.createDataFrame(
        [(1, 1, 2, 2, 2), (2, 2, 3, 0, 4), (3, 3, 1, 1, 1), (4, 2, 1, 3, 1)],
        "match_id int, host_team int, guest_team int, host_goal int, guest_goal int",
    )
    got = reshape.league_table(matches, teams).select("team_name", "points")
    assert dict(got.collect()) == {"Otters": 2, "Herons": 4, "Newts": 4}


def test_fixtures_on_sundays(spark):
    teams = spark.createDataFrame([(1, "Otters"), (2, "Herons"), (3, "Newts")], "id int, name string")
    got = joins.round_robin(teams, "id", "name", "2024-02-27").orderBy("match_no").collect()
    assert [r["match_no"] for r in got] == [1, 2, 3]
    assert got[0]["fixture"] == "Otters  vs  Herons" and got[0]["match_date"] == day("2024-03-03")
    assert got[2]["fixture"] == "Herons  vs  Newts" and got[2]["match_date"] == day("2024-03-17")


def test_managers_and_roots(spark):
    org = spark.createDataFrame(
        [(10, "Uma", ""), (11, "Vic", "10"), (12, "Wim", "11"), (13, "Xia", "11"), (14, "Yan", "")],
        "empId int, name string, manager string",
    )
    assert rows(joins.managers(org, "empId", "manager", "name")) == [
        (10, "Uma", None, None), (11, "Vic", "Uma", None), (12, "Wim", "Vic", "Uma"),
        (13, "Xia", "Vic", "Uma"), (14, "Yan", None, None),
    ]
    assert rows(joins.hierarchy(org, "empId", "manager")) == [
        (10, 10, 0), (11, 10, 1), (12, 10, 2), (13, 10, 2), (14, 14, 0),
    ]


def test_hierarchy_with_long_chain_and_cycle(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)] + [(100, 101), (101, 100)]
    got = {r["id"]: (r["root"], r["depth"]) for r in
           joins.hierarchy(spark.createDataFrame(chain, "id int, up int"), "id", "up").collect()}
    assert got[39] == (0, 39) and got[0] == (0, 0)
    assert got[100][0] is None and got[101][0] is None


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_join(spark, how):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 17 != 0, F.col("id") % 50)
    big = spark.range(2000).select(key.alias("k"), "id")
    small = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert rows(joins.salted_join(big, small, ["k"], 4, share=0.2, how=how)) == rows(big.join(small, "k", how))


def test_salted_aggregate_equals_aggregate(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 11).alias("k"), "id")
    aggs = {"n": ("count", "id"), "s": ("sum", "id"), "lo": ("min", "id"), "hi": ("max", "id"), "m": ("avg", "id")}
    plain = df.groupBy("k").agg(
        F.count("id").alias("n"), F.sum("id").alias("s"), F.min("id").alias("lo"), F.max("id").alias("hi"),
        F.avg("id").alias("m"),
    )
    assert rows(skew.salted_aggregate(df, ["k"], aggs, 5, ["id"])) == rows(plain)


def test_counts_of_a_hot_value(spark):
    ids = spark.range(300033)
    value = F.when(F.col("id") < 300000, 0).when(F.col("id") < 300025, 1).when(F.col("id") < 300030, 2).otherwise(3)
    made = skew.salted_aggregate(ids.select(value.alias("value"), "id"), ["value"], {"n": ("count", "id")}, 3, ["id"])
    assert rows(made) == [(0, 300000), (1, 25), (2, 5), (3, 3)]


def test_count_of_joined_ranges(spark):
    a = spark.range(0, 90, 3).toDF("id1").repartition(3)
    b = spark.range(0, 90, 5).toDF("id2").repartition(2)
    assert joins.equi_join(a, b, {"id1": "id2"}).count() == 6


def test_broadcast_only_when_small(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.broadcast_join(big, small, ["k"]))
        assert "BroadcastHashJoin" not in plan(joins.broadcast_join(big, small, ["k"], max_rows=10))
        assert "BroadcastHashJoin" not in plan(joins.broadcast_join(big, small, ["k"], max_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_groups_whose_members_hold_several_things(spark):
    data = [
        ("crew", "ann", "rope"), ("crew", "ann", "axe"), ("crew", "ben", "axe"), ("crew", "ben", "rope"),
        ("team", "cy", "axe"), ("team", "cy", "rope"), ("team", "dot", "axe"), ("gang", "eve", "rope"),
    ]
    df = spark.createDataFrame(data, "party string, who string, tool string")
    got = aggregates.groups_with_members_holding(df, "party", "who", "tool", k=2, min_members=2)
    assert rows(got) == [("crew", 2)]


def test_categories_by_bounds(spark):
    labels = ["low", "middle", "high"]
    df = spark.createDataFrame([("a", 9), ("b", 10), ("c", 74), ("d", 75), ("e", None)], "id string, score int")
    got = aggregates.category_counts(df, "score", [10, 75], labels)
    assert dict(got.collect()) == {"low": 1, "middle": 2, "high": 1}
    few = spark.createDataFrame([("a", 80)], "id string, score int")
    assert dict(aggregates.category_counts(few, "score", [10, 75], labels).collect()) == {"low": 0, "middle": 0, "high": 1}


def test_median(spark):
    data = [("a", v) for v in (5, 1, 1, 9)] + [("b", v) for v in (7, 3, 3)] + [("c", None)]
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(aggregates.median_by(df, ["k"], "v")) == [("a", 3.0), ("b", 3.0), ("c", None)]
    assert rows(aggregates.median_by(df, [], "v")) == [(3.0,)]
    amounts = df.select("k", F.col("v").cast("decimal(10,2)").alias("v"))
    assert aggregates.median_by(amounts, ["k"], "v").schema["median"].dataType.simpleString() == "double"


def test_total_beyond_the_doubles(spark):
    parts = spark.createDataFrame([(1e16,)] * 40 + [(0.25,), (0.5,)], "v double")
    assert parts.agg(total("v")).first()[0] == 4e17
    small = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert small.agg(total("v")).first()[0] == 1.0


def test_components_equal_search(spark):
    pairs = [(1, 2), (2, 3), (4, 5), (6, 6), (9, 8), (8, 7), (7, 3)] + [(i, i + 1) for i in range(20, 45)]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    got = dict(graph.connected_components(edges).collect())
    assert {got[i] for i in (1, 2, 3, 7, 8, 9)} == {1}
    assert got[4] == got[5] == 4 and got[6] == 6
    assert {got[i] for i in range(20, 46)} == {20}


def test_hops_and_rank(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 3), (9, 1)], "src bigint, dst bigint")
    start = spark.createDataFrame([(1,)], "id bigint")
    assert rows(graph.hops(edges, start)) == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert rows(graph.hops(edges, start, max_hops=1, directed=False)) == [(1, 0), (2, 1), (3, 1), (9, 1)]
    ranks = dict(graph.pagerank(edges, 60, tol=1e-9).collect())
    assert sum(ranks.values()) == pytest.approx(5.0, abs=1e-6)
    assert ranks[4] > ranks[3] > ranks[9]
