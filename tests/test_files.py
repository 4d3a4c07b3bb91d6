import gzip
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright.operators import aggregates, conform, reshape
from tablewright.plans import batch_job, layers
from tablewright.session import read_conf, run_folder, settings
from tablewright.sinks import layout, writers
from tablewright.sources import quality, readers
from tests.helpers import plan, rows

TRANSACTIONS = """id,customer,amount
7,Ines,12.5
8,Jost,3
nine,Kaja,8.25
10,,41.75
,Lars,6.5
12,Mona,--
"""
SCHEMA = "id int, customer string, amount double"


@pytest.fixture
def transactions(tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(TRANSACTIONS)
    return str(path)


def test_read_modes(spark, transactions):
    report = quality.read_mode_report(spark, transactions, "csv", SCHEMA, header=True)
    assert rows(report) == [
        ("DROPMALFORMED", "corrupt", 0), ("DROPMALFORMED", "total", 4), ("DROPMALFORMED", "valid", 4),
        ("FAILFAST", "load_failed", 0),
        ("PERMISSIVE", "corrupt", 2), ("PERMISSIVE", "total", 6), ("PERMISSIVE", "valid", 4),
    ]
    assert quality.strict_load(spark, transactions, "csv", SCHEMA, header=True) == "load_failed"
    assert quality.strict_load(spark, transactions, "csv", "id string, customer string, amount string", header=True) == "success"


def test_valid_and_corrupt_apart(spark, transactions):
    valid, corrupt, report = quality.read_with_quality(spark, transactions, "csv", SCHEMA, header=True)
    assert valid.count() == 4 and valid.columns == ["id", "customer", "amount"]
    assert sorted(r["_corrupt_record"] for r in corrupt.collect()) == ["12,Mona,--", "nine,Kaja,8.25"]
    assert dict(report.collect()) == {"valid": 4, "corrupt": 2, "total": 6}


def test_reject_limit(spark, transactions):
    with pytest.raises(quality.TooManyRejects):
        quality.load_with_limits(spark, transactions, SCHEMA)
    loaded = quality.load_with_limits(spark, transactions, SCHEMA, max_rejects=2, widths={"customer": 3})
    assert {r["customer"] for r in loaded.collect()} == {"Ine", None, "Jos", "Lar"}


def test_invalid_characters_and_gzip(spark, tmp_path):
    path = tmp_path / "names.csv.gz"
    path.write_bytes(gzip.compress(b"n\nab\xffc\n"))
    loaded = quality.load_with_limits(spark, str(path), "n string", replace_invalid="?")
    assert rows(loaded) == [("ab?c",)]


SURVEY = [(19, "Chad"), (64, "Peru"), (39, "Chad"), (40, "Chad"), (22, "Peru"), (51, "Fiji")]


def test_survey_counts(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text('"Age","Country"\n' + "".join(f'{a},"{c}"\n' for a, c in SURVEY))
    df = readers.read_csv(spark, str(path), "Age int, Country string")
    assert df.count() == 6
    got = aggregates.count_by(df, ["Country"], "Age < 40")
    assert dict(got.collect()) == {"Chad": 2, "Peru": 1}


def test_nested_document(spark, tmp_path):
    def person(i, name, skills, city):
        return {"id": i, "name": name, "department": {"name": "D"}, "skills": skills, "address": {"city": city}}

    path = tmp_path / "nested.json"
    people = [person(4, "Rui", ["welding", "plumbing"], "Porto"), person(5, "Sanna", ["law", "chess"], "Turku"),
              person(6, "Tove", [], "Malmö")]
    path.write_text(json.dumps({"employees": people}, indent=2))
    schema = """employees array<struct<id: int, name: string, department: struct<name: string>,
                skills: array<string>, address: struct<city: string>>>"""
    df = readers.read_json(spark, str(path), schema, document=True)
    fields = {"city": "emp.address.city", "name": "emp.name", "skill": "skill"}
    paths = [("employees", "emp"), ("emp.skills", "skill")]
    assert reshape.flatten_nested(df, paths, fields, outer=False).count() == 4
    assert rows(reshape.flatten_nested(df, paths, fields).filter("skill IS NULL")) == [("Malmö", "Tove", None)]


def test_session_log_defects(spark, tmp_path):
    lines = [
        '{"user_id": "u7", "session": {"start": "2024-02-28T23:59:00Z", "end": "2024-02-29T00:00:30Z"}, "device": "tv"}',
        '{"user_id": "u8", "session": {"start": "2024-02-28T08:00:00Z", "end": "2024-02-27T08:00:00Z"}, "device": "tv"}',
        '{"user_id": "u9", "session": {"end": "2024-02-28T08:00:00Z"}, "device": "pad"}',
        '{"user_id": "v1", "session": 17, "device": "pad"}',
        '{"user_id": "v2", "session": {"start": "2024-02-28T08:00:00Z", "end": "noon"}, "device": "pad"}',
    ]
    path = tmp_path / "log.json"
    path.write_text("\n".join(lines))
    schema = "user_id string, session struct<start: string, end: string>, device string"
    df = quality.read_marked(spark, str(path), "json", schema)
    got = reshape.validate_sessions(df, "session.start", "session.end", "_corrupt_record")
    assert rows(got.select("user_id", "defect", "seconds")) == [
        ("u7", None, 90), ("u8", "negative duration", None), ("u9", "missing time", None),
        ("v1", "corrupt record", None), ("v2", "unparsable time", None),
    ]


def test_json_leaves_nulls_out(spark, tmp_path):
    people = readers.inline(spark, [{"name": "A", "age": 4}, {"name": "B"}], "name string, age int")
    writers.write_files(people, str(tmp_path / "out"), "json")
    text = sorted(r["value"] for r in readers.read_text(spark, str(tmp_path / "out")).collect())
    assert text == ['{"name":"A","age":4}', '{"name":"B"}']


def test_partition_pruning_and_file_cap(spark, tmp_path):
    flights = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "K1").otherwise("K2").alias("carrier"), (F.col("id") % 3).alias("origin"), "id"
    )
    path = str(tmp_path / "flights")
    writers.export_partitioned(flights, path, "json", ["carrier", "origin"], 5)
    back = readers.read_json(spark, path, "id bigint, carrier string, origin int")
    assert back.count() == 100
    picked = back.filter("carrier = 'K1' AND origin = 1")
    assert "PartitionFilters: [isnotnull(carrier" in plan(picked)
    sizes = picked.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 5


def test_single_file(spark, tmp_path):
    writers.write_single_file(spark.range(10), str(tmp_path / "one"), header=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1


def test_catalog_life(spark, tmp_path):
    writers.ensure_database(spark, "shop")
    try:
        df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kind string")
        writers.save_table(df, "items", partition_by=["kind"])
        assert "items" in writers.table_names(spark, "shop")
        assert writers.has_partition(spark, "items", kind="x") and not writers.has_partition(spark, "items", kind="z")
        writers.table_like(df, "empty_items")
        writers.insert_rows(df.select("kind", "name", "id"), "empty_items")
        assert rows(spark.table("empty_items")) == rows(df)
        writers.analyze(spark, "empty_items")
        assert "2 rows" in str(spark.sql("DESCRIBE EXTENDED empty_items").filter("col_name = 'Statistics'").first())
        writers.replace_rows(spark.table("empty_items").filter("id = 1"), "empty_items", run_folder(spark, "t"))
        assert spark.table("empty_items").count() == 1
        writers.truncate(spark, "empty_items")
        assert spark.table("empty_items").isEmpty()
        spark.sql("CREATE VIEW named AS SELECT name FROM items")
        assert spark.table("named").count() == 2
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE shop CASCADE")


def test_bucketed_join_has_no_exchange(spark):
    names = []
    for n in ("left_b", "right_b"):
        writers.save_table(spark.range(100).withColumnRenamed("id", "k"), n, bucket_by=["k"], buckets=4)
        names.append(n)
    a, b = (spark.table(n) for n in names)
    joined = a.join(b.hint("merge"), "k")
    assert joined.count() == 100
    assert "Exchange" not in plan(joined)


def test_manifest_and_compaction(spark, tmp_path):
    path = str(tmp_path / "many")
    listed = writers.write_with_manifest(spark.range(100).repartition(10), path, "id bigint")
    assert listed.count() == 10 and listed.agg(F.sum("rows")).first()[0] == 100
    writers.compact(spark, path, str(tmp_path / "few"), "parquet", "id bigint")
    assert len(list((tmp_path / "few").glob("part-*"))) == 1
    assert spark.read.parquet(str(tmp_path / "few")).count() == 100


def test_refresh(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "k int, v bigint")
    writers.refresh("mv", df)
    more = spark.createDataFrame([(2, 4), (3, 1)], "k int, v bigint")
    writers.refresh("mv", more, "incremental", ["k"], ["v"], scratch=run_folder(spark, "mv"))
    assert rows(spark.table("mv")) == [(1, 2), (2, 7), (3, 1)]
    writers.refresh("mv", more)
    assert rows(spark.table("mv")) == [(2, 4), (3, 1)]


def test_batch_job(spark, tmp_path):
    schema = "lot int, grade string, litres double, dock string"
    data = [(1, "a", 55.0, "w1"), (2, "b", 4.0, "w1"), (3, "c", 90.0, None), (4, "d", 61.0, "w2")]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    job = batch_job.BatchJob(
        str(tmp_path / "in"), str(tmp_path / "out"), schema, "litres > 50 AND dock IS NOT NULL",
        ("lot", "litres", "dock"), ("dock",), settings={"spark.sql.shuffle.partitions": "3"},
    )
    assert batch_job.run_batch(spark, job) == 2
    assert batch_job.run_batch(spark, job) == 2
    assert (tmp_path / "out" / "dock=w2").is_dir()
    scanned = plan(batch_job.transform(batch_job.read(spark, job), job))
    pushed = scanned.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThan(litres,50.0)" in pushed and "IsNotNull(dock)" in pushed
    assert "ReadSchema: struct<lot:int,litres:double,dock:string>" in scanned


def test_batch_job_retries(spark, monkeypatch):
    job = batch_job.BatchJob("in", "out", "x int", attempts=3, delay_seconds=0)
    calls = []

    def failing(kind, until):
        def read(spark_, job_):
            calls.append(1)
            if len(calls) < until:
                raise kind("no")
            return None

        return read

    monkeypatch.setattr(batch_job, "transform", lambda df, job_: df)
    monkeypatch.setattr(batch_job, "write", lambda df, job_: 7)
    monkeypatch.setattr(batch_job, "read", failing(RuntimeError, 3))
    assert batch_job.run_batch(spark, job) == 7 and len(calls) == 3
    calls.clear()
    monkeypatch.setattr(batch_job, "read", failing(RuntimeError, 9))
    with pytest.raises(RuntimeError):
        batch_job.run_batch(spark, job)
    assert len(calls) == 3
    calls.clear()
    monkeypatch.setattr(batch_job, "read", failing(AnalysisException, 9))
    with pytest.raises(AnalysisException):
        batch_job.run_batch(spark, job)
    assert len(calls) == 1


def test_batch_job_arguments():
    job = batch_job.parse(["--input-path", "a", "--output-path", "b", "--schema", "x int", "--target-mb", "64"])
    assert (job.input_path, job.output_path, job.target_mb, job.output_format) == ("a", "b", 64, "parquet")


def test_layers_keep_unreadable_rows(spark, transactions, tmp_path):
    raw = layers.bronze(spark, transactions, str(tmp_path / "bronze"))
    clean, bad = layers.silver(raw, SCHEMA, {"customer": "unknown"})
    assert clean.count() == 4 and bad.count() == 2
    assert clean.filter("id = 10").first()["customer"] == "unknown"


def test_layout(spark):
    assert layout.partition_count(layout.spread(spark.range(100), 5)) == 5
    ranged = layout.partition_numbers(layout.spread(spark.range(100), 4, ["id"], ranged=True))
    spans = ranged.groupBy("partition").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))
    assert "RebalancePartitions" in layout.balanced(spark.range(9), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    inside = layout.sorted_inside(spark.range(50).select((F.col("id") % 7).alias("k"), (-F.col("id")).alias("v")), ["k"], ["k", "v"], 3)
    parts = inside.rdd.glom().map(lambda part: [tuple(r) for r in part]).collect()
    assert all(part == sorted(part) for part in parts) and sum(map(len, parts)) == 50
    kept = layout.held(spark.range(5))
    assert kept.count() == 5 and kept.is_cached
    kept.unpersist()


def test_small_sources(spark, tmp_path):
    assert rows(readers.number_range(spark, 2, 8, 2, "n")) == [(2,), (4,), (6,)]
    assert readers.empty_like(spark.range(5)).schema == spark.range(5).schema
    holes = spark.createDataFrame([(1, None), (2, "b")], "id int, s string")
    assert rows(readers.without_nulls(holes)) == [(2, "b")]
    (tmp_path / "a.txt").write_text("one\ntwo")
    assert readers.read_text(spark, str(tmp_path / "a.txt"), "raw", whole=True).first()["raw"] == "one\ntwo"
    altered = conform.change_columns(holes, cast={"id": "bigint"}, add={"x": F.lit(1)}, drop=["s"], rename={"x": "y"})
    assert altered.dtypes == [("id", "bigint"), ("y", "int")]


def test_settings_file(tmp_path):
    path = tmp_path / "spark.conf"
    path.write_text("[SPARK_APP_CONFIGS]\nspark.app.name = Hello\nspark.sql.shuffle.partitions = 2\n")
    assert read_conf(str(path)) == {"spark.app.name": "Hello", "spark.sql.shuffle.partitions": "2"}
    with pytest.raises(FileNotFoundError):
        read_conf(str(tmp_path / "none.conf"))


def test_skipped_lines_of_long_and_short_files(spark, tmp_path):
    """Files over many splits, a file of headings only, and a file shorter than its headings."""
    (tmp_path / "long.csv").write_text("title\nid,word\n" + "".join(f"{i},w{i}\n" for i in range(5000)))
    (tmp_path / "bare.csv").write_text("title\nid,word\n")
    (tmp_path / "short.csv").write_text("title\n")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}):
        got = readers.read_csv_below(spark, str(tmp_path), "id int, word string", skip=2)
        assert got.rdd.getNumPartitions() > 3
        assert rows(got) == rows(spark.range(5000).selectExpr("id", "'w' || id"))
    assert readers.read_csv_below(spark, str(tmp_path), "id int, word string", skip=0).count() == 5005


def test_gathered_and_ruled_layout(spark):
    df = layout.spread(spark.range(1000), 12)
    assert layout.partition_count(layout.gathered(df, 3)) == 3
    ruled = layout.partition_numbers(layout.spread_by_rule(df, F.col("id") % 5, 4))
    spread = ruled.groupBy(F.col("id") % 5).agg(F.count_distinct("partition").alias("n"))
    assert spread.filter("n <> 1").isEmpty()


def test_only_touched_partitions_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 5), (3, "b", 5), (4, None, 5), (5, "c'", 5)], "id int, k string, v int")
    folder = tmp_path / "t"
    writers.save_table(df.select("id", "v", "k"), "touched", path=str(folder), partition_by=["k"])

    def files():
        return {str(f) for f in folder.rglob("*.parquet")}

    before = files()
    gone = F.col("v") < 5
    assert writers.change_partitions(spark, "touched", ["k"], gone, lambda rows: rows.filter(~gone)) == 1
    kept = files()
    assert {f for f in before if "/k=a/" not in f} == {f for f in kept if "/k=a/" not in f}
    assert rows(spark.table("touched").select("id", "k")) == [(2, "a"), (3, "b"), (4, None), (5, "c'")]
    # a partition that loses all rows is dropped, also that of NULL
    last = F.col("id") >= 3
    assert writers.change_partitions(spark, "touched", ["k"], last, lambda rows: rows.filter(~last)) == 3
    assert rows(spark.table("touched").select("id", "k")) == [(2, "a")]
    assert writers.change_partitions(spark, "touched", ["k"], F.lit(False), lambda rows: rows) == 0
    spark.sql("DROP TABLE touched")


def test_rows_are_counted_without_being_written(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,a\nno,b\n3,c\n")
    got = quality.counted_rows(spark, str(tmp_path / "x.csv"), "csv", "id int, name string")
    assert got == {"valid": 2, "corrupt": 1, "total": 3}
    (tmp_path / "none.csv").write_text("")
    valid, corrupt, report = quality.read_with_quality(spark, str(tmp_path / "none.csv"), "csv", "id int, name string")
    assert valid.isEmpty() and corrupt.isEmpty()
    assert rows(report) == [("corrupt", 0), ("total", 0), ("valid", 0)]
