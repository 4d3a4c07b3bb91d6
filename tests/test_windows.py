"""Hand-worked window fixtures, and the sliced operators against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.functions.strings import month_number
from tablewright.operators import islands, joins, ordered, ranking, skew
from tests.helpers import day, rows


def test_running_totals_by_month_name(spark):
    data = [
        ("north mill", "March", 40), ("north mill", "oct", 15), ("north mill", "August", 25),
        ("south mill", "June", 7), ("south mill", "january", 70),
    ]
    df = spark.createDataFrame(data, "mill string, month string, tons int")
    numbered = df.withColumn("no", month_number("month"))
    made = ordered.running_sum(numbered, ["mill"], ["no"], {"running": "tons"})
    made = ordered.with_neighbours(
        made, ["mill"], ["no"], lambda w: {"diff": F.coalesce(F.col("tons") - F.lag("tons").over(w), F.lit(0))},
        before=1,
    )
    got = [tuple(r) for r in made.filter("mill = 'north mill'").orderBy("no").select("month", "running", "diff").collect()]
    assert got == [("March", 40, 0), ("August", 65, -15), ("oct", 80, -10)]


def test_mean_of_a_row_and_the_one_before(spark):
    df = spark.createDataFrame(
        [(1, day("2023-05-02"), 8), (2, day("2023-05-09"), 2), (3, day("2023-06-01"), 5)], "id int, date date, value int"
    )
    made = ordered.with_neighbours(
        df, [], ["date"], lambda w: {"avg": F.avg("value").over(w.rowsBetween(-1, 0))}, before=1
    )
    assert [r["avg"] for r in made.orderBy("id").collect()] == [8.0, 5.0, 3.5]


@pytest.mark.parametrize("bounded", [True, False])
def test_last_crate_within_capacity(spark, bounded):
    crates = [("pears", 30, 3), ("plums", 45, 1), ("figs", 20, 2), ("dates", 25, 4)]
    df = spark.createDataFrame(crates, "crate string, weight int, place int")
    last = ordered.capacity_cutoff(df, ["place"], "weight", 100, bounded=bounded)
    assert [(r["crate"], r["running"]) for r in last.collect()] == [("pears", 95)]
    assert ordered.capacity_cutoff(df, ["place"], "weight", 44, bounded=bounded).count() == 0


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame(
        [
            ("ana", "canoe", day("2022-03-09")), ("ana", "tent", day("2022-01-30")),
            ("bo", "rope", day("2021-12-24")), ("bo", "lamp", day("2021-12-24")), ("bo", "axe", day("2021-11-01")),
        ],
        "who string, what string, at date",
    )
    latest = ranking.top_with_ties(df, ["who"], "at", 1)
    assert rows(latest.select("what")) == [("canoe",), ("lamp",), ("rope",)]
    one = ranking.first_rows(df, ["who"], [F.col("at").desc(), "what"])
    assert rows(one.select("what")) == [("canoe",), ("lamp",)]


def test_second_highest_or_only(spark):
    df = spark.createDataFrame(
        [("a", "red", 12), ("b", "red", 19), ("c", "blue", 4), ("d", "green", 6), ("e", "green", 6), ("f", "green", 3)],
        "id string, team string, score int",
    )
    got = ranking.nth_value_rows(df, ["team"], "score", 2, or_last=True)
    assert rows(got.select("id")) == [("a",), ("c",), ("f",)]
    assert rows(ranking.nth_value_rows(df, ["team"], "score", 2).select("id")) == [("a",), ("f",)]
    assert rows(ranking.nth_value_rows(df, [], "score", 3).select("id")) == [("d",), ("e",)]


def test_four_kinds_of_rank(spark):
    df = spark.createDataFrame([(1, 7), (2, 7), (3, 9), (4, 9), (5, 9), (6, 2)], "id int, v int")
    for bounded in (True, False):
        got = ordered.rank_rows(
            df, [], "v", tie_break=["id"], descending=False,
            rank="r", dense="d", unique="u", modified="m", bounded=bounded,
        )
        assert rows(got) == [
            (1, 7, 2, 2, 2, 3), (2, 7, 2, 2, 3, 3), (3, 9, 4, 3, 4, 6),
            (4, 9, 4, 3, 5, 6), (5, 9, 4, 3, 6, 6), (6, 2, 1, 1, 1, 1),
        ]


def test_islands_of_days_with_a_mark(spark):
    data = [
        ("pump", day("2023-07-30"), "off"), ("pump", day("2023-07-31"), "off"), ("pump", day("2023-08-01"), "off"),
        ("pump", day("2023-08-02"), "on"), ("pump", day("2023-08-04"), "off"), ("pump", day("2023-08-04"), "off"),
        ("fan", day("2023-08-01"), "on"),
    ]
    df = spark.createDataFrame(data, "device string, at date, state string")
    got = islands.islands(df, ["device"], "at", where="state = 'off'")
    assert rows(got.select("device", "start", "end", "n")) == [
        ("pump", day("2023-07-30"), day("2023-08-01"), 3),
        ("pump", day("2023-08-04"), day("2023-08-04"), 1),
    ]


def test_mean_time_between_paired_events(spark):
    data = [
        ("oven", 1, "open", "10.5"), ("oven", 1, "shut", "14.0"), ("oven", 2, "shut", "31.5"), ("oven", 2, "open", "30"),
        ("kiln", 1, "open", "2.25"), ("kiln", 1, "shut", "4.75"), ("kiln", 2, "open", "broken"), ("kiln", 2, "shut", "9"),
    ]
    df = spark.createDataFrame(data, "machine string, run int, kind string, at string")
    pairs = islands.pair_events(df, ["machine", "run"], "kind", "at", "open", "shut")
    assert rows(islands.mean_duration(pairs, ["machine"])) == [("kiln", 2.5), ("oven", 2.5)]


def test_difference_to_the_group_mean(spark):
    df = spark.createDataFrame(
        [("a", "x", 30), ("b", "x", 50), ("c", "y", 8), ("d", "z", 0), ("e", "z", 0)], "id string, team string, pay int"
    )
    got = joins.compare_to_group(df, ["team"], "pay").select("id", "difference", "difference_pct")
    assert rows(got) == [
        ("a", 10.0, 33.33), ("b", -10.0, -20.0), ("c", 0.0, 0.0), ("d", 0.0, None), ("e", 0.0, None),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; keys and values may be NULL, order has ties."""
    rng = random.Random(7)
    data = [
        (
            0 if i % 3 == 0 else rng.choice([None, *range(1, 30)]),
            rng.randrange(40),
            i,
            rng.choice([None, *range(-5, 20)]),
        )
        for i in range(900)
    ]
    return spark.createDataFrame(data, "k int, o int, i int, v int").repartition(5).cache()


@pytest.mark.parametrize("keys", [["k"], []])
def test_sliced_running_sum_equals_window(skewed, keys):
    w = Window.partitionBy(*keys).orderBy("o", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"s": F.sum("v").over(w), "n": F.sum(F.lit(1)).over(w)})
    got = ordered.running_sum(skewed, keys, ["o", "i"], {"s": "v", "n": F.lit(1)}, slices=7)
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want)


@pytest.mark.parametrize("bounded", [True, False])
def test_peers_share_a_total(skewed, bounded):
    w = Window.partitionBy("k").orderBy("o")
    want = skewed.withColumn("s", F.sum("v").over(w))
    got = ordered.running_sum_with_peers(skewed, ["k"], ["o"], {"s": "v"}, bounded=bounded)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("slices", [3, 7, 300])
@pytest.mark.parametrize("keys", [["k"], []])
def test_sliced_neighbours_equal_window(skewed, keys, slices):
    def columns(w):
        return {
            "back": F.lag("v", 2).over(w),
            "ahead": F.lead("i").over(w),
            "mean": F.avg("v").over(w.rowsBetween(-2, 1)),
        }

    want = skewed.withColumns(columns(Window.partitionBy(*keys).orderBy("o", "i")))
    got = ordered.with_neighbours(
        skewed, keys, ["o", "i"], columns, before=2, after=1, slices=slices
    )
    assert rows(got) == rows(want)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("keys, slices", [(["k"], 4), (["k"], 40), ([], 5), ([], 300)])
def test_sliced_ranks_equal_windows(skewed, keys, slices, descending):
    """Ties of NULLs and values go over many cuts."""
    names = {"rank": "r", "dense": "d", "unique": "u", "modified": "m"}
    how = {"tie_break": ["i"], "descending": descending}
    want = ordered.rank_rows(skewed, keys, "v", bounded=True, **how, **names)
    got = ordered.rank_rows(skewed, keys, "v", slices=slices, **how, **names)
    assert rows(got) == rows(want)


def test_top_with_ties_equals_ranks(skewed):
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    for kind, made in (("rank", F.rank()), ("dense_rank", F.dense_rank())):
        want = skewed.withColumn("p", made.over(w).cast("bigint")).filter("p <= 3")
        got = ranking.top_with_ties(skewed, ["k"], "v", 3, kind=kind, into="p")
        assert rows(got) == rows(want)


def test_islands_equal_distinct_days(skewed):
    dated = skewed.withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i") % 61))
    made = islands.islands(dated, ["k"], "at")
    held = dated.select("k", "at").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert rows(made.groupBy("k").agg(F.sum("n").alias("n"))) == rows(held)


@pytest.mark.parametrize("slices", [3, 30])
@pytest.mark.parametrize("gap", [1, 3])
def test_runs_over_cuts_equal_runs_in_one_window(skewed, slices, gap):
    dated = skewed.withColumn("at", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("i") * 7) % 1500))
    want = islands.islands(dated, ["k"], "at", gap=gap, slices=1)
    assert rows(islands.islands(dated, ["k"], "at", gap=gap, slices=slices)) == rows(want)
    seconds = dated.withColumn("at", F.col("at").cast("timestamp_ntz"))
    want = islands.islands(seconds, [], "at", gap=gap * 86400, slices=1)
    assert rows(islands.islands(seconds, [], "at", gap=gap * 86400, slices=slices)) == rows(want)


@pytest.mark.parametrize("order", ["o i", "-v i", "v+ -i", "-v- o i"])
def test_deep_pages_equal_sorted_rows(skewed, order):
    """Pages that lie in one stretch, go over cuts, or run past the end; then the page behind."""
    ways = {
        "-v": F.col("v").desc(), "v+": F.col("v").asc_nulls_last(), "-i": F.col("i").desc(), "-v-": F.col("v").desc_nulls_first(),
    }
    order = [ways.get(c, c) for c in order.split()]
    want = [tuple(r) for r in skewed.orderBy(*order).collect()]
    names = [c if isinstance(c, str) else str(c).split("'")[1].split()[0] for c in order]
    for offset, n in ((0, 5), (299, 3), (440, 60), (893, 20), (2000, 5)):
        page = ranking.page(skewed, order, offset, n, shallow=1, cuts=9)
        assert [tuple(r) for r in page.collect()] == want[offset : offset + n]
        if offset < 890:
            last = [page.collect()[-1][c] for c in names]
            assert [tuple(r) for r in ranking.page_after(skewed, order, last, 4).collect()] == want[offset + n : offset + n + 4]


def test_frequent_keys(skewed):
    got = skew.frequent_keys(skewed, ["k"], 0.2)
    assert rows(got) == [(0, 300, 0.333333)]
    every = skewed.groupBy("k").count().filter("count > 18")
    assert rows(skew.frequent_keys(skewed, ["k"], 0.02).select("k", "rows")) == rows(every)
    assert skew.frequent_keys(skewed.limit(0), ["k"], 0.1).isEmpty()


def test_running_sums_of_decimals_and_doubles(skewed):
    kinds = {"d": (F.col("i") / 8).cast("decimal(12,3)"), "f": F.col("i") / 3}
    df = skewed.select("k", "i", *(v.alias(n) for n, v in kinds.items()))
    sums = {f"s_{n}": n for n in kinds}
    want = {r["i"]: r for r in ordered.running_sum(df, ["k"], ["i"], sums, bounded=True).collect()}
    for r in ordered.running_sum(df, ["k"], ["i"], sums, slices=5).collect():
        assert r["s_d"] == want[r["i"]]["s_d"]
        assert r["s_f"] == pytest.approx(want[r["i"]]["s_f"], rel=1e-12)
