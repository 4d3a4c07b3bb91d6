"""Streaming queries over several batches: time-outs, deletes, late rows and corrections.

Files are dropped one batch after another and the query is started again for each, from its
checkpoint, as a daily job would be. The drops are cut out of the given tables by rules that the
SQL states as well.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablewright.operators.common import cents
from tablewright.plans.registry import query, table
from tablewright.session import run_folder, settings
from tablewright.streaming import changes, late, pairing, running, windows

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_DROPS = ("2024-01-08", "2024-01-16", "2024-01-23")
_SLOT = "CASE " + " ".join(f"WHEN ts < TIMESTAMP '{day} 00:00:00' THEN {k}" for k, day in enumerate(_DROPS)) + f" ELSE {len(_DROPS)} END"


def _slot():
    made = F.lit(len(_DROPS))
    for k, day in reversed(list(enumerate(_DROPS))):
        made = F.when(F.col("ts") < F.lit(f"{day} 00:00:00").cast("timestamp_ntz"), k).otherwise(made)
    return made


def _run_drops(rows, place, batches, start):
    """Drop the rows of each batch (column ``batch``) and run the query that ``start`` begins to its end."""
    for k in range(batches):
        rows.filter(F.col("batch") == k).drop("batch").write.parquet(f"{place}/in/drop-{k}")
        running.finished(start())


@query(
    """
    WITH s AS (SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE event_type = 'view'),
         e AS (SELECT user_id, epoch_us(ts) AS at FROM events WHERE event_type = 'purchase'),
         m AS (SELECT max(epoch_us(ts)) - 3600000000 AS mark FROM events WHERE event_type IN ('view', 'purchase'))
    SELECT s.user_id, s.event_id, s.at AS start_at, min(e.at) AS end_at
    FROM s LEFT JOIN e ON e.user_id = s.user_id AND e.at BETWEEN s.at AND s.at + 43200000000
    WHERE (s.at // 43200000000 + 2) * 43200000000 <= (SELECT mark FROM m)
    GROUP BY 1, 2, 3
    """
)
def stream_starts_with_timeouts(spark, folder):
    """Views and the first purchase within twelve hours, or none; own state with timers, over four batches."""
    place = run_folder(spark, "waiting")
    events = table(spark, folder, "events").filter(F.col("event_type").isin("view", "purchase"))

    def start():
        stream = windows.event_time(running.file_stream(spark, f"{place}/in/*", _EVENTS), "ts", "1 hour")
        made = pairing.answered_starts(
            stream, "user_id", "event_id", "ts", F.col("event_type") == "view", F.col("event_type") == "purchase",
            dt.timedelta(hours=12),
        )
        return running.run_to_files(made, f"{place}/out")

    with settings(spark, pairing.STORE):
        _run_drops(events.withColumn("batch", _slot()), place, 4, start)
    schema = "user_id bigint, event_id bigint, start_at bigint, end_at bigint"
    return spark.read.schema(schema).parquet(f"{place}/out/rows")


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 10 = 0 THEN 3 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS turn
    FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 10 = 0
    """
)
def stream_changes_with_deletes(spark, folder):
    """Orders after updates, deletions, returns and changes that arrive out of order, partly folded in."""
    place = run_folder(spark, "changes")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    # Turn 0 brings all, 1 changes a third, 2 takes a fifth out, 3 brings half of these back. Of turn 1 a
    # part comes with the batch after the deletions: its rows are older than these.
    turns = F.array_compact(
        F.array(
            F.lit(0), F.when(key % 3 == 0, F.lit(1)), F.when(key % 5 == 0, F.lit(2)), F.when(key % 10 == 0, F.lit(3)),
        )
    )
    rows = orders.withColumn("turn", F.explode(turns)).withColumn(
        "batch", F.when((F.col("turn") == 1) & (key % 2 == 0), 3).otherwise(F.col("turn"))
    )
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, turn int"
    kept = changes.ChangedTable(spark, f"{place}/table", schema, ["o_orderkey"], piece_rows=4_000)

    def start():
        stream = running.file_stream(spark, f"{place}/in/*", schema)
        return changes.change_stream(
            stream, kept, f"{place}/checkpoint", F.col("turn"), F.col("turn") == 2, compact_every=2
        )

    _run_drops(rows.select(*orders.columns, "turn", "batch"), place, 4, start)
    return kept.read()


_LATE = f"""
    WITH w AS (SELECT date_trunc('day', ts) AS s, event_type, ts, CAST(round(value * 100) AS BIGINT) AS cents,
                      {_SLOT} + CASE WHEN event_id % 25 = 0 THEN 1 ELSE 0 END AS b FROM events),
         m AS (SELECT b, max(max(ts)) OVER (ORDER BY b) - INTERVAL 1 HOUR AS mark FROM w GROUP BY b),
         p AS (SELECT s, event_type, b, count(*) AS n, sum(cents)::BIGINT AS cents FROM w GROUP BY ALL)
"""


def _corrected(spark, folder):
    place = run_folder(spark, "late")
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", cents("value").alias("cents"))
    schema = "event_id bigint, ts timestamp_ntz, event_type string, cents bigint"
    kept = late.CorrectedWindows(
        spark, f"{place}/windows", schema, "ts", ["event_type"], ["cents"], dt.timedelta(days=1), dt.timedelta(hours=1)
    )

    def start():
        return late.corrected_stream(running.file_stream(spark, f"{place}/in/*", schema), kept, f"{place}/checkpoint")

    delayed = F.when(F.col("event_id") % 25 == 0, 1).otherwise(0)
    _run_drops(events.withColumn("batch", _slot() + delayed), place, 5, start)
    return kept


@query(
    _LATE
    + """
    SELECT strftime(x.s, '%Y-%m-%d') AS day, x.event_type, x.b AS batch, coalesce(sum(y.n), 0)::BIGINT AS old_rows,
           (coalesce(sum(y.n), 0) + x.n)::BIGINT AS new_rows, sum(y.cents)::BIGINT AS old_cents,
           (coalesce(sum(y.cents), 0) + x.cents)::BIGINT AS new_cents
    FROM p x JOIN m ON m.b = x.b - 1 LEFT JOIN p y ON y.s = x.s AND y.event_type = x.event_type AND y.b < x.b
    WHERE x.s + INTERVAL 1 DAY <= m.mark GROUP BY x.s, x.event_type, x.b, x.n, x.cents
    """
)
def stream_late_corrections(spark, folder):
    """Old and new totals of closed days that late rows changed."""
    made = _corrected(spark, folder).read("corrections")
    return made.select(
        F.date_format("start", "yyyy-MM-dd").alias("day"),
        "event_type", "batch", "old_rows", "new_rows", "old_cents", "new_cents",
    )


@query(
    _LATE
    + """
    SELECT strftime(s, '%Y-%m-%d') AS day, event_type, sum(n)::BIGINT AS "rows", sum(cents)::BIGINT AS cents
    FROM p WHERE s + INTERVAL 1 DAY <= (SELECT max(mark) FROM m) GROUP BY 1, 2
    """
)
def stream_corrected_totals(spark, folder):
    """Totals of all closed days, with what came late."""
    made = _corrected(spark, folder).totals()
    return made.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "rows", "cents")


@query(
    """
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """
)
def stream_latest_over_batches(spark, folder):
    """The latest event of every user over four batches: appended, compacted twice, and merged on reading."""
    place = run_folder(spark, "latest")
    schema = "user_id bigint, event_id bigint, event_type string"
    kept = changes.ChangedTable(spark, f"{place}/table", schema, ["user_id"], piece_rows=1_000)
    rows = table(spark, folder, "events").select(*schema.replace(",", "").split()[::2], "ts")

    def start():
        stream = running.file_stream(spark, f"{place}/in/*", f"{schema}, ts timestamp_ntz")
        moment = F.unix_micros(F.col("ts").cast("timestamp"))
        return changes.change_stream(stream, kept, f"{place}/checkpoint", moment, F.lit(False), compact_every=2)

    _run_drops(rows.withColumn("batch", _slot()), place, 4, start)
    return kept.read()


@query(
    """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS events
    FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2
    """
)
def stream_tumbling_over_batches(spark, folder):
    """Hourly counts over four batches: windows that go over a batch's end are in state until they are passed."""
    place = run_folder(spark, "tumbling")

    def start():
        stream = windows.event_time(running.file_stream(spark, f"{place}/in/*", _EVENTS), "ts", "1 hour")
        made = windows.windowed(stream, "ts", ["event_type"], {"events": F.count(F.lit(1))}, "1 hour")
        stamped = made.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")).drop("end")
        return running.run_to_files(stamped, f"{place}/out")

    _run_drops(table(spark, folder, "events").withColumn("batch", _slot()), place, 4, start)
    return spark.read.schema("start string, event_type string, events bigint").parquet(f"{place}/out/rows")
