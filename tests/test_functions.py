from pyspark.sql import functions as F

from tablewright.functions import arrays, dates, numbers, strings
from tablewright.operators import conform, partitions, reshape, text
from tablewright.operators.common import read_as
from tests.helpers import day, rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_strings(spark):
    assert one(spark, strings.month_number(F.lit("April"))) == 4
    assert one(spark, strings.month_number(F.lit(" sep"))) == 9
    assert [one(spark, strings.month_number(F.lit(x))) for x in ("Smarch", "marble", "decade")] == [None] * 3
    assert one(spark, strings.nth_index(F.lit("a.b.c"), ".", 2)) == 4
    assert one(spark, strings.nth_index(F.lit("a.b.c"), ".", 3)) == 0
    assert one(spark, strings.codes_in(F.lit("5CUP 2TSP-PT"), ["CUP", "TSP", "PT"])) == ["CUP", "TSP", "PT"]
    assert one(spark, strings.letter_signature(F.lit("listen"))) == one(spark, strings.letter_signature(F.lit("silent")))


def test_dates(spark):
    born = F.lit("1971-03-06").cast("date")
    assert one(spark, F.date_format(born, "EEEE")) == "Saturday"
    assert one(spark, F.date_add(born, 30)) == day("1971-04-05")
    assert one(spark, dates.age_years(born, "2022-03-05")) == 50
    assert one(spark, dates.age_years(born, "2022-03-06")) == 51
    assert one(spark, dates.age_years_by_days(born, "2022-03-06")) == 51
    assert one(spark, dates.next_sunday("2025-06-01")) == day("2025-06-01")
    assert one(spark, dates.next_sunday("2025-06-02")) == day("2025-06-08")
    assert one(spark, dates.date_key(F.lit("20/04/1963"))) == 19630420
    assert one(spark, dates.parse_date(F.lit("no date"))) is None
    assert [one(spark, dates.is_leap_year(F.lit(y))) for y in (1900, 2000, 2023, 2024)] == [False, True, False, True]
    a, b = F.lit("2025-01-01 10:00:00").cast("timestamp"), F.lit("2025-01-02 11:02:03").cast("timestamp")
    assert one(spark, dates.hours_minutes_seconds(a, b)) == "25:02:03"
    assert one(spark, dates.hours_minutes_seconds(b, a)) == "-25:02:03"


def test_numbers(spark):
    assert [one(spark, numbers.digital_root(F.lit(n))) for n in (0, 9, 10, 123456)] == [0, 9, 1, 3]
    assert one(spark, numbers.percent_of(F.lit(5.0), F.lit(0.0))) is None
    assert one(spark, conform.made_negative(F.lit(5))) == one(spark, conform.made_negative(F.lit(-5))) == -5


def test_one_line_to_records(spark):
    line = "oak|tree|40|bark|fern|herb|1|frond|moss|mat|0|spore|pine|tree|35|cone"
    df = spark.createDataFrame([(line,), ("",), (None,)], "raw string")
    got = reshape.flatten_delimited(df, "raw", r"\|", ["plant", "form", "metres", "part"]).filter("form IS NOT NULL")
    assert rows(got.drop("record")) == [
        ("fern", "herb", "1", "frond"), ("moss", "mat", "0", "spore"), ("oak", "tree", "40", "bark"),
        ("pine", "tree", "35", "cone"),
    ]


def test_windows_over_an_array(spark):
    items = F.array(*[F.lit(c) for c in "abcd"])
    assert one(spark, arrays.ngrams(items, 2)) == ["a b", "b c", "c d"]
    assert one(spark, arrays.ngrams(items, 5)) == []
    assert [tuple(r) for r in one(spark, arrays.shifted_windows(items, ["x", "y"]))] == [
        ("a", "b"), ("b", "c"), ("c", "d"), ("d", None),
    ]
    assert one(spark, arrays.merged_lines(F.lit("a\nb\nc"), 2, "+")) == ["a+b", "c"]
    assert one(spark, arrays.continued_lines(F.lit("a\\\nb\nc"), "\\")) == ["ab", "c"]


def test_words_and_anagrams(spark):
    df = spark.createDataFrame([("listen silent hello",), ("elloh hello",), ("",)], "t string")
    assert rows(text.top_words(df, "t", 1)) == [("hello", 2)]
    assert dict(text.word_count(df, "t").collect())[""] == 1
    groups = text.anagram_groups(text.words_of(df, "t", drop_empty=True), "word")
    assert rows(groups.select("word", "group_size")) == [("elloh", 2), ("hello", 2), ("listen", 2), ("silent", 2)]


def test_rescued_columns(spark):
    df = spark.createDataFrame(
        [(1, "oak", "40", "hill", None, None), (2, "fern", None, None, "shade", "wet"), (3, "moss", None, None, None, None)],
        "id int, name string, metres string, place string, light string, soil string",
    )
    got = {r["id"]: r["_rescued_data"] for r in conform.rescue_columns(df, "id int, name string").collect()}
    assert got == {1: {"metres": "40", "place": "hill"}, 2: {"light": "shade", "soil": "wet"}, 3: None}
    bare = conform.rescue_columns(df.select("id", "name"), "id int, name string")
    assert bare.columns == ["id", "name", "_rescued_data"] and bare.filter("_rescued_data IS NOT NULL").isEmpty()


def test_cleaned_table(spark):
    df = spark.createDataFrame([(None, "NULL", "x"), (3, "", "NA"), (4, "US", "y")], "age int, country string, s string")
    assert rows(conform.clean_table(df, {"age": 0, "country": "unknown"})) == [
        (0, "unknown", "x"), (3, "unknown", None), (4, "US", "y"),
    ]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    assert rows(conform.delete_where(df, F.col("v") > 3)) == [(None,), (1,)]


def test_session_events(spark):
    schema = "id string, events array<struct<event_type: string, timestamp: bigint>>"
    df = spark.createDataFrame(
        [("s1", [("start", 1000), ("end", 2000)]), ("s2", [("end", 1500), ("start", 3000)]), ("s3", []), ("s4", None)], schema
    )
    got = reshape.session_event_checks(df, "events").drop("events")
    assert rows(got) == [("s1", 1000, "ok"), ("s2", -1500, "out of order"), ("s3", None, "no events"), ("s4", None, "no events")]


def test_partition_functions(spark, tmp_path):
    df = spark.range(0, 100, 1, 4)
    made = partitions.map_partitions(
        df, lambda number, batches: (b.assign(part=number) for b in batches), "id bigint, part int"
    )
    assert made.groupBy("part").count().filter("count <> 25").isEmpty() and made.count() == 100
    assert rows(partitions.summaries(df, "id")) == [(0, 25, 0, 24), (1, 25, 25, 49), (2, 25, 50, 74), (3, 25, 75, 99)]

    folder = str(tmp_path)

    def save(rows_):
        import uuid
        from pathlib import Path

        Path(folder, uuid.uuid4().hex).write_text(str(sum(r["id"] for r in rows_)))

    partitions.each_partition(df, save)
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == sum(range(100))


def test_read_as_equals_try_cast(spark):
    texts = [
        "1", " 2 ", "+3", "-4", "5.5", "1e3", "x", "", "NaN", "inf", "-Infinity", "99999999999", "12a", "\t7\n",
        "2024-01-02", "2024-01-02 03:04:05", "20240102", "true", None, "0x1F", "1_000", "٣",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for kind in ("int", "bigint", "double", "decimal(10,2)", "date", "timestamp", "boolean", "string"):
        made = df.select("i", read_as(F.col("t"), kind).cast("string").alias("a"), F.col("t").try_cast(kind).cast("string").alias("b"))
        assert made.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == [], kind


def test_array_functions_take_time_in_proportion(spark):
    words = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20000)), lambda i: i.cast("string")), " ").alias("t"))
    pairs = words.select(F.size(arrays.ngrams(F.split("t", " "), 2)).alias("n"))
    assert pairs.first()["n"] == 19999
    cells = words.select(arrays.blocks(F.split("t", " "), ["a", "b", "c"]).alias("b"))
    assert tuple(cells.select(F.element_at("b", -1).alias("x")).first()["x"]) == ("19999", "20000", None)


def test_words_keep_their_accents(spark):
    df = spark.createDataFrame([("Élan, élan! Äpfel",)], "t string")
    got = dict(text.word_count(df, "t", lower=True, pattern=r"[^\p{L}]+", drop_empty=True).collect())
    assert got == {"élan": 2, "äpfel": 1}


def test_parity_of_null(spark):
    df = spark.createDataFrame([(3,), (-2,), (None,)], "v int")
    assert dict(conform.parity_counts(df, "v").collect()) == {"odd": 1, "even": 1, None: 1}
