import datetime as dt

from pyspark.sql import functions as F

from tablewright.functions.strings import row_hash
from tablewright.operators import aggregates
from tablewright.operators.history import upsert
from tablewright.streaming import running, stateful, windows
from tests.helpers import rows

SCHEMA = "id bigint, k string, ts timestamp_ntz, v bigint"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def put(spark, folder, name, data):
    df = spark.createDataFrame([(i, k, at(m), v) for i, k, m, v in data], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return running.file_stream(spark, f"{folder}/*", SCHEMA)


def counts(df):
    timed = windows.event_time(df, "ts", "10 minutes")
    return windows.windowed(timed, "ts", ["k"], {"n": F.count(F.lit(1)), "s": F.sum("v")}, "10 minutes")


def test_windows_restart_and_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, "a", [(1, "x", 1, 10), (2, "x", 2, 20), (3, "y", 3, 5), (4, "x", 45, 1)])
    running.finished(running.run_to_files(counts(stream(spark, source)), out))
    first = spark.read.parquet(f"{out}/rows")
    assert rows(first.select("k", "n", "s")) == [("x", 2, 30), ("y", 1, 5)]

    # The checkpoint remembers the watermark: minute 4 is late, minute 46 is not.
    put(spark, source, "b", [(5, "x", 4, 100), (6, "x", 46, 2), (7, "z", 200, 0)])
    done = running.finished(running.run_to_files(counts(stream(spark, source)), out))
    assert running.late_rows(done) == 1
    again = spark.read.parquet(f"{out}/rows")
    assert rows(again.select("k", "n", "s")) == [("x", 2, 3), ("x", 2, 30), ("y", 1, 5)]

    running.finished(running.run_to_files(counts(stream(spark, source)), out))
    assert rows(spark.read.parquet(f"{out}/rows")) == rows(again)


def test_stream_equals_table(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(i, "ab"[i % 2], i * 7 % 300, i) for i in range(200)] + [(999, "end", 100000, 0)]
    put(spark, source, "a", data)
    running.finished(running.run_to_files(counts(stream(spark, source)), out))
    table = spark.read.schema(SCHEMA).parquet(f"{source}/*")
    assert rows(spark.read.parquet(f"{out}/rows")) == rows(counts(table).filter("k <> 'end'"))


def test_upsert_over_several_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    saved = running.VersionedTable(spark, str(tmp_path / "table"), "k string, ts timestamp_ntz, id bigint, v bigint")

    def latest(df):
        return aggregates.row_with_max(df, ["k"], "ts", "id")

    def run():
        rows_ = stream(spark, source).select("k", "ts", "id", "v")
        return running.finished(running.upsert_stream(rows_, saved, str(tmp_path / "cp"), ["k"], latest))

    put(spark, source, "a", [(1, "x", 5, 10), (2, "y", 5, 20)])
    run()
    put(spark, source, "b", [(3, "x", 1, 99), (4, "y", 9, 21), (5, "z", 0, 1)])
    run()
    assert rows(saved.last().select("k", "v")) == [("x", 10), ("y", 21), ("z", 1)]


def test_only_touched_pieces_are_written_and_a_batch_can_run_again(spark, tmp_path):
    saved = running.VersionedTable(spark, str(tmp_path / "table"), "k int, v string", pieces=8)

    def fold(number, changes):
        df = spark.createDataFrame(changes, "k int, v string")
        pieces = saved.touched(df, ["k"])
        saved.put(number, upsert(saved.at(number - 1, pieces), df, ["k"]), ["k"], pieces)
        return pieces

    def files():
        return {str(f) for f in (tmp_path / "table/rows").rglob("*.parquet")}

    fold(0, [(k, "a") for k in range(100)])
    before = files()
    pieces = fold(1, [(7, "b")])
    again = fold(1, [(7, "c")])
    new = files() - before
    assert pieces == again and len(new) == 1 and f"__piece={pieces[0]}" in next(iter(new))
    assert before <= files()
    fold(2, [])
    fold(3, [(7, "d"), (None, "none"), (200, "e")])
    want = {(k, "a") for k in range(100) if k != 7} | {(7, "d"), (None, "none"), (200, "e")}
    assert {tuple(r) for r in saved.last().collect()} == want and saved.last().count() == 102


def test_history_over_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "k string, v bigint, start_date date, end_date date, is_current boolean, hash string"
    saved = running.VersionedTable(spark, str(tmp_path / "table"), schema)

    def run():
        return running.finished(
            running.history_stream(
                stream(spark, source), saved, str(tmp_path / "cp"), ["k"], ["v"],
                day_of=lambda batch: str(batch.agg(F.max(F.to_date("ts"))).first()[0]),
                latest=lambda batch: aggregates.row_with_max(batch, ["k"], "ts", "id"),
            )
        )

    put(spark, source, "a", [(1, "x", 5, 10), (2, "y", 5, 20)])
    run()
    put(spark, source, "b", [(3, "x", 60 * 24, 11), (4, "y", 60 * 24, 20)])
    run()
    final = saved.last()
    assert rows(final.select("k", "v", "is_current")) == [("x", 10, False), ("x", 11, True), ("y", 20, True)]
    assert final.filter(F.col("hash") != row_hash(["v"])).isEmpty()


def test_own_state_over_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    saved = running.VersionedTable(spark, str(tmp_path / "table"), "k string, salt int, events bigint, total bigint")

    def run():
        parts = stateful.running_totals(stream(spark, source), "k", "v", ["id"], salts=2)
        return running.finished(
            running.upsert_stream(parts, saved, str(tmp_path / "cp"), ["k", "salt"], mode="update")
        )

    put(spark, source, "a", [(1, "x", 5, 10), (2, "x", 5, 20), (3, "y", 1, 1)])
    run()
    put(spark, source, "b", [(4, "x", 5, 5), (5, "z", 5, 2)])
    run()
    final = stateful.totals_of(saved.last(), "k")
    assert rows(final) == [("x", 3, 35), ("y", 1, 1), ("z", 1, 2)]


def test_duplicates_and_bursts(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, "a", [(1, "x", 1, 10), (1, "x", 1, 10), (2, "x", 2, 500), (3, "y", 3, 1), (4, "z", 5000, 0)])
    timed = windows.event_time(stream(spark, source), "ts", "10 minutes")
    out = str(tmp_path / "once")
    running.finished(running.run_to_files(windows.first_seen(timed, ["id"]).select("id"), out))
    assert rows(spark.read.parquet(f"{out}/rows")) == [(1,), (2,), (3,), (4,)]
    out = str(tmp_path / "salted")
    running.finished(running.run_to_files(windows.first_seen(timed, ["k"], ["id"], 2).select("k"), out))
    assert rows(spark.read.parquet(f"{out}/rows")) == [("x",), ("y",), ("z",)]
    out = str(tmp_path / "bursts")
    flagged = windows.flag_bursts(timed, "ts", ["k"], F.col("v"), "1 hour", 10, 400)
    running.finished(running.run_to_files(flagged, out))
    assert rows(spark.read.parquet(f"{out}/rows").select("k", "events", "amount")) == [("x", 3, 520)]


def test_once_a_day_over_three_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = 24 * 60
    batches = {"a": [(1, "x", 60, 0)], "b": [(2, "x", 1200, 0), (3, "x", day + 90, 0)], "c": [(4, "x", 1410, 0), (5, "x", day + 95, 0), (6, "y", 1430, 0)]}
    for name, data in batches.items():
        put(spark, source, name, data)
        made = windows.first_per_day(stream(spark, source), "ts", ["k"], "1 hour", ["id"], 2)
        running.finished(running.run_to_files(made.select("k", F.dayofyear("day_start").alias("d")), out))
    got = rows(spark.read.parquet(f"{out}/rows"))
    assert [k for k, _ in got] == ["x", "x", "y"] and got[0] != got[1]
