import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.functions.strings import row_hash
from tablewright.operators import constraints, history
from tests.helpers import day, rows

CUSTOMER = "customer_id int, name string, email string, city string"


def test_customer_changes(spark):
    before = spark.createDataFrame(
        [(10, "Odd", "odd@a.example", "Oslo"), (20, "Pia", None, "Pisa"), (30, "Rex", "rex@a.example", "Riga")], CUSTOMER
    )
    after = spark.createDataFrame(
        [(20, "Pia", "pia@a.example", "Paris"), (30, "Rex", "rex@a.example", "Riga"), (40, "Sol", "sol@a.example", "Split")],
        CUSTOMER,
    )
    got = history.snapshot_diff(before, after, ["customer_id"])
    assert rows(got.select("customer_id", "email", "change_type", "changed_columns")) == [
        (10, "odd@a.example", "Deleted", None),
        (20, "pia@a.example", "Modified", "email,city"),
        (40, "sol@a.example", "Added", None),
    ]
    same = history.snapshot_diff(before, after, ["customer_id"], include_unchanged=True)
    assert same.count() == 4


TRACKED = ["name", "city"]


@pytest.fixture
def versions(spark):
    made = spark.createDataFrame(
        [
            (5, "Ivo", "Bern", day("2020-02-01"), day("2021-06-30"), False),
            (5, "Ivo", "Basel", day("2021-06-30"), None, True),
            (6, "Jane", "Ghent", day("2021-01-15"), None, True),
            (7, "Kim", "Turin", day("2022-10-01"), None, True),
        ],
        "customer_id int, name string, city string, start_date date, end_date date, is_current boolean",
    )
    return made.withColumn("hash", row_hash(TRACKED))


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(5, "Ivo", "Bern"), (7, "Kim", "Turin"), (8, "Lou", "Lille")], "customer_id int, name string, city string"
    )


def test_type_2_history(versions, batch):
    got = history.scd2_merge(versions, batch, ["customer_id"], TRACKED, "2024-11-05")
    kept = got.select("customer_id", "city", F.col("start_date").cast("string"), F.col("end_date").cast("string"), "is_current")
    assert rows(kept) == [
        (5, "Basel", "2021-06-30", "2024-11-05", False),
        (5, "Bern", "2020-02-01", "2021-06-30", False),
        (5, "Bern", "2024-11-05", None, True),
        (6, "Ghent", "2021-01-15", None, True),
        (7, "Turin", "2022-10-01", None, True),
        (8, "Lille", "2024-11-05", None, True),
    ]
    assert got.filter("city = 'Turin'").first()["hash"] == hashlib.md5(b"Kim|Turin").hexdigest()


def test_type_2_history_twice_is_once(versions, batch):
    once = history.scd2_merge(versions, batch, ["customer_id"], TRACKED, "2024-11-05")
    twice = history.scd2_merge(once, batch, ["customer_id"], TRACKED, "2024-11-06")
    assert rows(once) == rows(twice)
    current = once.filter("is_current").groupBy("customer_id").count()
    assert current.filter("count <> 1").isEmpty()


def test_type_2_history_closes_missing(versions, batch):
    got = history.scd2_merge(versions, batch, ["customer_id"], TRACKED, "2024-11-05", close_missing=True)
    missing = got.filter("customer_id = 6").first()
    assert (missing["is_current"], missing["end_date"]) == (False, day("2024-11-05"))


def test_type_2_history_refuses_a_repeated_key(versions, batch):
    twice = history.scd2_merge(versions, batch.unionByName(batch.limit(1)), ["customer_id"], TRACKED, "2024-11-05")
    with pytest.raises(PySparkException, match="more than once"):
        twice.collect()


def test_upsert_takes_a_null_key_for_a_key(spark):
    base = spark.createDataFrame([(None, "old"), (3, "three"), (4, "four")], "k int, v string")
    changes = spark.createDataFrame([(None, "new"), (4, "4")], "k int, v string")
    once = history.upsert(base, changes, ["k"])
    assert rows(once) == rows(history.upsert(once, changes, ["k"]))
    assert sorted(r.v for r in once.collect()) == ["4", "new", "three"]


def test_rows_at_the_mark_come_again(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30), (5, None)], "k int, at int")
    assert [r.k for r in history.incremental(df, "at", 20).collect()] == [4]
    assert sorted(r.k for r in history.incremental(df, "at", 20, inclusive=True).collect()) == [2, 3, 4]


def test_null_is_not_the_absent_mark(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 3


def test_diff_accounts_for_every_key(spark):
    rng = random.Random(3)

    def side():
        keys = rng.sample(range(60), 40)
        return spark.createDataFrame([(k, rng.choice([None, 1, 2])) for k in keys], "k int, v int")

    a, b = side(), side()
    made = history.snapshot_diff(a, b, ["k"], include_unchanged=True)
    assert made.count() == a.select("k").union(b.select("k")).distinct().count()
    counts = dict(made.groupBy("change_type").count().collect())
    assert counts["Deleted"] == a.join(b, "k", "left_anti").count()
    assert counts["Added"] == b.join(a, "k", "left_anti").count()


def test_incremental_totals_equal_full(spark):
    df = spark.createDataFrame([(i % 4, i, i * 1.5) for i in range(50)], "k int, at int, v double")

    def totals(rows_):
        return rows_.groupBy("k").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))

    mark = history.high_water_mark(df.filter("at < 30"), "at")
    merged = history.merge_totals(
        totals(df.filter("at < 30")), totals(history.incremental(df, "at", mark)), ["k"], ["v", "n"]
    )
    assert rows(merged) == rows(totals(df))


def test_constraint_report(spark):
    df = spark.createDataFrame(
        [(1, 10, 5), (1, 11, -1), (None, 10, None), (2, 99, 3)], "id int, parent int, amount int"
    )
    rules = constraints.Rules(
        not_null=["amount"], primary_key=["id"], foreign={"parent": ("parents", "id")},
        check={"positive": F.col("amount") > 0},
    )
    parents = spark.createDataFrame([(10,), (11,)], "id int")
    assert dict(constraints.check_constraints(df, rules, {"parents": parents}).collect()) == {
        "not null amount": 1,
        "primary key not null id": 1,
        "check positive": 1,
        "primary key unique id": 2,
        "foreign key parent -> parents.id": 1,
    }
    assert rows(constraints.violating_rows(df, rules).select("id", "rule")) == [
        (None, "not null amount"), (1, "check positive"),
    ]
