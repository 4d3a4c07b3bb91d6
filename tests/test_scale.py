"""Range joins, refreshed joins, summaries and placement on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.operators import ranges, refresh, slices, summaries
from tablewright.session import settings
from tablewright.sinks import layout
from tests.helpers import plan, rows


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the points share one value; bands overlap, are empty, are the wrong way round, have NULLs."""
    rng = random.Random(3)
    points = [(i, "ab"[i % 2], 50.0 if i % 3 == 0 else rng.choice([None, rng.uniform(0, 100)])) for i in range(300)]
    bands = [(j, "ab"[j % 2], low, low + rng.choice([0, 1, 20, -5])) for j, low in enumerate(rng.uniform(-10, 110) for _ in range(60))]
    bands += [(90, "a", None, 5.0), (91, "b", 5.0, None), (92, "a", 50.0, 50.0), (93, "b", float("-inf"), float("inf"))]
    return (
        spark.createDataFrame(points, "i int, g string, x double").cache(),
        spark.createDataFrame(bands, "j int, g string, low double, high double").cache(),
    )


@pytest.mark.parametrize("grid", [10**9, 50])
@pytest.mark.parametrize("on", [[], ["g"]])
def test_band_join_equals_all_pairs(sides, on, grid):
    points, bands = sides
    right = bands if on else bands.drop("g")
    made = ranges.band_join(points, "x", right, "low", "high", 10**6, on=on, slices=9, task_pairs=grid)
    assert "CartesianProduct" not in plan(made) and "NestedLoop" not in plan(made)
    want = {
        (p["i"], b["j"]) for p in points.collect() for b in bands.collect()
        if None not in (p["x"], b["low"], b["high"]) and b["low"] <= p["x"] <= b["high"] and (not on or p["g"] == b["g"])
    }
    got = [(r["i"], r["j"]) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_band_join_is_checked_before_pairs_are_made(sides):
    points, bands = sides
    with pytest.raises(ranges.TooManyPairs):
        ranges.band_join(points, "x", bands.drop("g"), "low", "high", 1000, slices=9)
    assert ranges.band_join(points.limit(0), "x", bands.drop("g"), "low", "high", 0).isEmpty()


def test_a_grid_of_many_heavy_ranges_is_no_part_of_the_plan(spark):
    """The sizes of the blocks come by a join: as nested conditions they grew past what can be compiled."""
    points = spark.range(1000).select("id", (F.col("id") % 250).cast("double").alias("x"))
    bands = spark.range(200).select(F.col("id").alias("j"), F.col("id").cast("double").alias("low"), (F.col("id") + 3.0).alias("high"))
    made = ranges.band_join(points, "x", bands, "low", "high", 10**6, slices=64, task_pairs=4)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("__range") < 100
    assert made.count() == 200 * 4 * 4 == made.select("id", "j").distinct().count()


def test_blocks_grow_where_pairs_outgrow_the_rows(spark):
    """All points lie in all bands: with blocks of one size a row would be copied about 20 times."""
    points = spark.range(600).select("id", (F.col("id") % 7).cast("double").alias("x"))
    bands = spark.range(300).select(F.col("id").alias("j"), F.lit(0.0).alias("low"), F.lit(9.0).alias("high"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        made = ranges.band_join(points, "x", bands, "low", "high", 10**6, slices=2, task_pairs=50)
        assert len({(r["id"], r["j"]) for r in made.collect()}) == 600 * 300
        stages = made._jdf.queryExecution().executedPlan().executedPlan().plan().collectLeaves()
        sent = [stages.apply(k).plan().metrics().apply("shuffleRecordsWritten").value() for k in range(stages.size())]
    # a band is in each of the cells it meets, a point in one
    assert len(sent) == 2 and sum(sent) <= 1.5 * (600 + 300 * 7)


def test_stretches_follow_the_order(spark):
    df = spark.createDataFrame([(None, 1), (1, 2), (1, 3), (1, 4), (2, 5), (7, 6)], "a int, b int")
    for order, want in ((["a", "b"], [0, 1, 2, 3, 4, 5]), ([F.col("a").desc(), "b"], [5, 2, 3, 4, 1, 0])):
        placed = slices.places(df, order)
        cuts = slices.cut_points(df, placed, 6, 6)
        got = {r["b"]: r["s"] for r in df.withColumn("s", slices.stretch(placed, cuts)).collect()}
        assert [got[k] for k in range(1, 7)] == want


def test_totals_follow_changes_of_both_tables(spark, tmp_path):
    orders = spark.createDataFrame([(1, "x", 5), (1, "y", 7), (2, "z", None), (3, "w", 2), (None, "n", 1)], "c int, o string, v bigint")
    people = spark.createDataFrame([(1, "red"), (2, "red"), (3, None), (4, "blue")], "c int, team string")
    sides = []
    for name, df in (("orders", orders), ("people", people)):
        side = refresh.PiecedTable(spark, str(tmp_path / name), df.schema, ["c"], 4)
        side.write(df)
        sides.append(side)
    keys, sums = ["team"], {"v": "v"}
    saved = refresh.joined_totals(sides[0].read(), sides[1].read(), ["c"], keys, sums)
    assert rows(saved.select("team", "rows", "v")) == [(None, 1, 2), ("red", 3, 12)]

    def frame(data, like):
        return spark.createDataFrame(data, like.schema)

    came, went = frame([(4, "q", 9), (3, "u", 30)], orders), frame([(1, "x", 5), (1, "y", 7)], orders)
    moved = refresh.signed(frame([(3, "blue"), (5, "red")], people), frame([(3, None)], people))
    made = refresh.refresh_joined_totals(
        saved, sides[0], refresh.signed(came, went), sides[1], moved, ["c"], keys, sums
    )
    # red keeps an order without a value; the team without a name is gone
    assert rows(made.select("team", "rows", "v")) == [("blue", 3, 41), ("red", 1, None)]
    none = refresh.signed(came.limit(0)), refresh.signed(moved.limit(0).drop("weight"))
    same = refresh.refresh_joined_totals(saved, sides[0], none[0], sides[1], none[1], ["c"], keys, sums)
    assert rows(same) == rows(saved)


def test_only_pieces_with_changed_keys_are_read(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("c"))
    side = refresh.PiecedTable(spark, str(tmp_path / "t"), df.schema, ["c"], 50)
    side.write(df)
    near = side.near(spark.range(2).toDF("c"))
    assert 2 <= near.count() < 100 and len(near.inputFiles()) <= 50 and "PartitionFilters: [__piece" in plan(near)


def test_merged_summaries(spark):
    df = spark.range(20_000).select(
        F.col("id"), (F.col("id") % 7).alias("day"), F.when(F.col("id") % 10 > 0, F.col("id") % 1000).alias("v"), (F.col("id") % 300).alias("u")
    )
    daily = summaries.summarise(df, ["day"], "v", "u")
    whole = summaries.merge_summaries(daily, []).select("rows", summaries.quantile(0.5).alias("m"), summaries.distinct_count().alias("d"))
    row = whole.first()
    assert row["rows"] == 20_000 and abs(row["m"] - 500) < 40 and abs(row["d"] - 300) < 24
    empty = summaries.summarise(df.filter("v IS NULL"), ["day"], "v", "u").select(summaries.quantile(0.5).alias("m"))
    assert {r["m"] for r in empty.collect()} == {None}


def test_largest_group_goes_into_the_emptiest_bin():
    assert layout.packed_bins([(1, 50), (2, 30), (3, 25), (4, 10)], [0, 0]) == {1: 0, 2: 1, 3: 1, 4: 0}
    assert layout.packed_bins([(1, 5), (2, 5)], [10, 7, 0]) == {1: 2, 2: 2} and layout.packed_bins([], [1]) == {}


def test_groups_are_placed_whole_and_even(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 60).alias("g"))
    placed = layout.partition_numbers(layout.spread_by_size(df, ["g"], 3), "p")
    assert placed.groupBy("g").agg(F.count_distinct("p").alias("n")).filter("n > 1").isEmpty()
    sizes = sorted(r["count"] for r in placed.groupBy("p").count().collect())
    assert len(sizes) == 3 and sizes[-1] <= 3300
