"""Streams over several batches: time-outs, deletions, late rows. Results worked by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tablewright.session import settings
from tablewright.streaming import changes, late, pairing, running, windows
from tests.helpers import rows

EVENTS = "id bigint, who bigint, kind string, ts timestamp_ntz"


def at(hour, minute=0):
    return dt.datetime(2024, 3, 1) + dt.timedelta(hours=hour, minutes=minute)


def drop(spark, place, name, data, schema=EVENTS):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{place}/in/{name}")


def test_starts_wait_for_their_end(spark, tmp_path):
    place = str(tmp_path)

    def run():
        stream = windows.event_time(running.file_stream(spark, f"{place}/in/*", EVENTS), "ts", "30 minutes")
        made = pairing.answered_starts(
            stream, "who", "id", "ts", F.col("kind") == "on", F.col("kind") == "off", dt.timedelta(hours=2)
        )
        running.finished(running.run_to_files(made, f"{place}/out"))
        got = spark.read.schema("who bigint, id bigint, start_at bigint, end_at bigint").parquet(f"{place}/out/rows")
        minute = 60_000_000
        first = int(at(0).replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
        return {(r["id"], r["end_at"] if r["end_at"] is None else (r["end_at"] - first) // minute) for r in got.collect()}

    with settings(spark, pairing.STORE):
        # 1 and 2 are answered by the same end at 1:50, 3 belongs to another key, 4 is not over yet
        drop(spark, place, "a", [(1, 7, "on", at(0, 10)), (2, 7, "on", at(1, 50)), (3, 8, "on", at(0, 20)), (4, 7, "on", at(5))])
        assert run() == {(3, None)} | {(1, None), (2, None)} or run() == set()
        done = run()
        # the slots up to 4:00 need the watermark at 4:00 and 6:00
        drop(spark, place, "b", [(5, 7, "off", at(6, 30)), (6, 7, "off", at(6, 10)), (7, 9, "other", at(6)), (8, 9, "on", None)])
        run()
        drop(spark, place, "c", [(9, 9, "on", at(20))])
        got = run()
        assert done <= got and {(i, e) for i, e in got if i == 4} == {(4, 370)}
        left = pairing.state_rows(spark, f"{place}/out/checkpoint", "starts")
        assert left.count() == 1  # only the start of 20:00 waits; all else is gone


def test_deletions_and_compaction(spark, tmp_path):
    table = changes.ChangedTable(spark, str(tmp_path / "t"), "k bigint, v string", ["k"], piece_rows=3)

    def put(batch, data):
        df = spark.createDataFrame(data, "k bigint, v string, n int, gone boolean")
        table.append(batch, df, F.col("n"), F.col("gone"))

    assert table.read().isEmpty() and table.compact() == []
    put(0, [(1, "a", 1, False), (2, "b", 1, False), (3, "c", 1, None), (1, "a2", 2, False)])
    assert rows(table.read()) == [(1, "a2"), (2, "b"), (3, "c")]
    put(1, [(2, None, 3, True), (None, "none", 1, False)])
    put(1, [(2, None, 3, True), (None, "none", 1, False)])  # a batch that is run again
    assert rows(table.read()) == [(None, "none"), (1, "a2"), (3, "c")]
    assert table.compact() and rows(table.read()) == [(None, "none"), (1, "a2"), (3, "c")]
    # an older change of a deleted key comes late; folded-in deletions are no longer known, so order is per log
    put(2, [(2, "late", 2, False), (3, None, 4, True), (1, "old", 1, False)])
    assert rows(table.read()) == [(None, "none"), (1, "a2"), (2, "late")]
    _, pieces, places = table.manifest()
    put(3, [(k, "x", 9, False) for k in range(10, 30)])
    table.compact()
    assert table.manifest()[1] > pieces and table.read().count() == 23
    before = table.manifest()[2]
    put(4, [(10, None, 10, True)])
    touched = table.compact()
    after = table.manifest()[2]
    assert len(touched) == 1 and {p: w for p, w in before.items() if p not in touched} == {
        p: w for p, w in after.items() if p not in touched
    }
    assert table.read().filter("k = 10").isEmpty() and table.read().count() == 22


def test_files_of_a_changed_table_follow_rows_not_pieces(spark, tmp_path):
    """Hundreds of pieces share files; a compaction that touches one of them leaves the others where they are."""
    table = changes.ChangedTable(spark, str(tmp_path / "t"), "k bigint, v string", ["k"], piece_rows=4)
    table.append(0, spark.range(1500).selectExpr("id AS k", "'a' AS v"), F.lit(1), F.lit(False))
    table.compact()
    _, pieces, places = table.manifest()
    assert pieces == 512 and len(list((tmp_path / "t" / "pieces").rglob("*.parquet"))) <= 8
    table.append(1, spark.createDataFrame([(7, "b"), (9, None)], "k bigint, v string"), F.lit(2), F.col("k") == 9)
    assert len(table.compact()) <= 2
    now = table.manifest()[2]
    assert sum(now.get(piece) != place for piece, place in places.items()) <= 2
    got = dict(table.read().collect())
    assert got == {k: "b" if k == 7 else "a" for k in range(1500) if k != 9}


def test_state_is_kept_per_share_of_the_keys(spark, tmp_path, monkeypatch):
    """As many states and timers as shares and slots, however many keys there are; no key takes another's end."""
    monkeypatch.setattr(pairing, "SHARES", 2)
    place = str(tmp_path)
    data = [(who, who, "on", at(0, 10 + who)) for who in range(40)]
    data += [(100 + who, who, "off", at(1, who)) for who in range(0, 40, 2)]
    drop(spark, place, "a", data)

    def run():
        stream = windows.event_time(running.file_stream(spark, f"{place}/in/*", EVENTS), "ts", "0 minutes")
        made = pairing.answered_starts(
            stream, "who", "id", "ts", F.col("kind") == "on", F.col("kind") == "off", dt.timedelta(hours=2)
        )
        running.finished(running.run_to_files(made, f"{place}/out"))

    with settings(spark, pairing.STORE):
        run()
        assert pairing.state_rows(spark, f"{place}/out/checkpoint", "due").count() == 4
        drop(spark, place, "b", [(200, 1, "on", at(9))])
        run()
    got = spark.read.schema("who bigint, id bigint, start_at bigint, end_at bigint").parquet(f"{place}/out/rows").collect()
    minutes = {r["who"]: r["end_at"] and (r["end_at"] - r["start_at"]) // 60_000_000 for r in got}
    assert len(got) == 40 and minutes == {who: None if who % 2 else 50 for who in range(40)}


def test_a_compaction_that_was_cut_short_changes_nothing(spark, tmp_path, monkeypatch):
    table = changes.ChangedTable(spark, str(tmp_path / "t"), "k bigint, v string", ["k"])
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    table.append(0, df, F.lit(1), F.lit(False))

    def stop(*args):
        raise OSError("lost")

    monkeypatch.setattr(table, "_publish", stop)
    try:
        table.compact()
    except OSError:
        pass
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    table.compact()
    assert rows(table.read()) == [(1, "a"), (2, "b")] and table.manifest()[0] == 0


def test_late_rows_correct_closed_windows(spark, tmp_path):
    schema = "ts timestamp_ntz, k string, v bigint"
    kept = late.CorrectedWindows(
        spark, str(tmp_path), schema, "ts", ["k"], ["v"], dt.timedelta(hours=1), dt.timedelta(minutes=15)
    )

    def fold(batch, data):
        kept.fold(spark.createDataFrame(data, schema), batch)

    fold(0, [(at(0, 5), "a", 1), (at(0, 50), "a", 2), (at(1, 10), "a", 4), (at(1, 20), None, 8)])  # mark 1:05
    assert kept.mark(1) == at(1, 5)
    assert rows(kept.read("closed").select("start", "k", "rows", "v")) == [(at(0), "a", 2, 3)]
    for _ in range(2):  # the second time stands for a batch that is run again
        fold(1, [(at(0, 59), "a", 16), (at(0, 1), "b", None), (at(2, 30), "a", 32), (None, "a", 99)])  # mark 2:15
    assert rows(kept.read("late")) == [(at(0, 1), "b", None, 1), (at(0, 59), "a", 16, 1)]
    assert rows(kept.read("corrections")) == [(at(0), "a", 2, 3, 3, 19, 1), (at(0), "b", 0, 1, None, None, 1)]
    assert rows(kept.read("closed").filter("batch = 1")) == [(at(1), None, 1, 8, 1), (at(1), "a", 1, 4, 1)]
    fold(2, [(at(0), "a", 64), (at(1), "a", 128)])
    want = [(at(0), "a", 4, 83), (at(0), "b", 1, None), (at(1), None, 1, 8), (at(1), "a", 2, 132)]
    assert rows(kept.totals()) == want
