"""Streaming queries over the event table, run to the end of what is there.

Append mode gives only windows the watermark has passed; the SQL states that bound.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates, islands
from tablewright.operators.common import cents, money, total
from tablewright.plans.registry import query, table
from tablewright.session import run_folder, settings
from tablewright.streaming import running, stateful, windows

_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_DELAY = "1 hour"
_STAMP = "yyyy-MM-dd HH:mm:ss"


def _stream(spark, folder):
    return running.file_stream(spark, f"{folder}/events.parquet", _SCHEMA)


def _stamped(df):
    return df.withColumns({c: F.date_format(c, _STAMP) for c in ("start", "end")})


def _run(df, label):
    spark = df.sparkSession
    place = run_folder(spark, label)
    running.finished(running.run_to_files(df, place))
    return spark.read.schema(df.schema).parquet(f"{place}/rows")


_TUMBLING = """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start,
           strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS "end", event_type,
           count(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events {where} GROUP BY 1, 2, 3
"""


def _measures():
    return {"events": F.count(F.lit(1)), "total": total("value")}


@query(_TUMBLING.format(where=""))
def windowed_event_counts(spark, folder):
    events = windows.event_time(table(spark, folder, "events"), "ts", _DELAY)
    return _stamped(windows.windowed(events, "ts", ["event_type"], _measures(), "1 hour"))


_SLIDING = """
    WITH s AS (SELECT unnest([time_bucket(INTERVAL 12 HOURS, ts), time_bucket(INTERVAL 12 HOURS, ts) - INTERVAL 12 HOURS]) AS s,
                      event_type, value FROM events)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 24 HOURS, '%Y-%m-%d %H:%M:%S') AS "end",
           event_type, count(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM s {where} GROUP BY 1, 2, 3
"""


@query(_SLIDING.format(where=""))
def sliding_event_counts(spark, folder):
    events = windows.event_time(table(spark, folder, "events"), "ts", _DELAY)
    return _stamped(windows.windowed(events, "ts", ["event_type"], _measures(), "24 hours", "12 hours"))


@query(
    _TUMBLING.format(
        where="WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"
    )
)
def stream_tumbling_counts(spark, folder):
    events = windows.event_time(_stream(spark, folder), "ts", _DELAY)
    return _run(_stamped(windows.windowed(events, "ts", ["event_type"], _measures(), "1 hour")), "tumbling")


@query(
    _SLIDING.format(where="WHERE s + INTERVAL 24 HOURS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
)
def stream_sliding_counts(spark, folder):
    events = windows.event_time(_stream(spark, folder), "ts", _DELAY)
    made = windows.windowed(events, "ts", ["event_type"], _measures(), "24 hours", "12 hours")
    return _run(_stamped(made), "sliding")


@query(
    """
    WITH f AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= 10800000000
                                   THEN 0 ELSE 1 END AS opens FROM events),
         g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM f)
    SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts) + INTERVAL 3 HOURS, '%Y-%m-%d %H:%M:%S') AS "end",
           user_id, count(*) AS events FROM g GROUP BY user_id, n
    HAVING max(ts) + INTERVAL 3 HOURS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """
)
def stream_sessions(spark, folder):
    events = windows.event_time(_stream(spark, folder), "ts", _DELAY)
    made = windows.sessions(events, "ts", ["user_id"], {"events": F.count(F.lit(1))}, "3 hours")
    with settings(spark, windows.MERGE_FIRST):
        return _run(_stamped(made), "sessions")


@query(
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start,
           strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS "end", user_id, count(*) AS events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    GROUP BY 1, 2, 3 HAVING count(*) > 5 OR SUM(CAST(value AS DECIMAL(18,2))) > 200
    """
)
def stream_burst_flags(spark, folder):
    events = windows.event_time(_stream(spark, folder), "ts", _DELAY)
    flagged = windows.flag_bursts(events, "ts", ["user_id"], money("value"), "1 day", 5, 200)
    return _run(_stamped(flagged.withColumn("amount", F.col("amount").cast("double"))), "bursts")


@query(
    """
    SELECT event_id, user_id, upper(event_type) AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE event_type <> 'error'
    """
)
def stream_map_filter(spark, folder):
    made = _stream(spark, folder).filter("event_type <> 'error'").select(
        "event_id", "user_id", F.upper("event_type").alias("kind"), F.from_json("props", "k int")["k"].alias("k")
    )
    return _run(made, "mapped")


@query(
    """
    SELECT event_id, event_type, c_mktsegment AS segment, c_nationkey AS nation FROM events JOIN customer ON c_custkey = user_id
    """
)
def stream_static_join(spark, folder):
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id", "c_mktsegment AS segment", "c_nationkey AS nation"
    )
    joined = windows.enrich(_stream(spark, folder), customer, ["user_id"])
    return _run(joined.select("event_id", "event_type", "segment", "nation"), "joined")


@query("SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def stream_deduplicated(spark, folder):
    """A user's first event of a kind and day."""
    keys = ["user_id", "event_type"]
    made = windows.first_per_day(_stream(spark, folder), "ts", keys, _DELAY, ["event_id"], salts=4)
    day = F.date_format("day_start", "yyyy-MM-dd").alias("day")
    return _run(made.select("user_id", "event_type", day), "deduplicated")


def _saved(query_, saved):
    running.finished(query_)
    return saved.last()


@query(
    """
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """
)
def stream_latest_per_user(spark, folder):
    """Upsert per batch: the latest event of every user."""
    place = run_folder(spark, "latest")
    saved = running.VersionedTable(
        spark, f"{place}/table", "user_id bigint, ts timestamp_ntz, event_id bigint, event_type string"
    )

    def pick(rows):
        return aggregates.row_with_max(rows, ["user_id"], "ts", "event_id")

    rows = _stream(spark, folder).select("user_id", "ts", "event_id", "event_type")
    done = running.upsert_stream(rows, saved, f"{place}/checkpoint", ["user_id"], pick)
    return _saved(done, saved).drop("ts")


@query(
    """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
           max(CASE WHEN event_type = 'view' THEN epoch_us(ts) END) AS start_at,
           min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS end_at,
           min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END)
             - max(CASE WHEN event_type = 'view' THEN epoch_us(ts) END) AS duration
    FROM events GROUP BY 1, 2
    """
)
def stream_event_pairs(spark, folder):
    """Start and end events matched across batches by a stateful aggregation."""
    place = run_folder(spark, "pairs")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    rows = _stream(spark, folder).select(
        "user_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "event_type",
        F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("at"),
    )
    pairs = islands.pair_events(rows, ["user_id", "day"], "event_type", "at", "view", "purchase")
    saved = running.VersionedTable(
        spark, f"{place}/table", "user_id bigint, day string, start_at bigint, end_at bigint, duration bigint"
    )
    done = running.upsert_stream(pairs, saved, f"{place}/checkpoint", ["user_id", "day"], mode="update")
    return _saved(done, saved)


@query(
    """
    SELECT user_id, count(*) AS events, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS total FROM events GROUP BY 1
    """
)
def stream_running_totals(spark, folder):
    """Totals kept in state of our own."""
    place = run_folder(spark, "totals")
    rows = _stream(spark, folder).select("user_id", "event_id", cents("value").alias("cents"))
    parts = stateful.running_totals(rows, "user_id", "cents", ["event_id"], salts=4)
    saved = running.VersionedTable(
        spark, f"{place}/table", "user_id bigint, salt int, events bigint, total bigint"
    )
    done = running.upsert_stream(parts, saved, f"{place}/checkpoint", ["user_id", "salt"], mode="update")
    return stateful.totals_of(_saved(done, saved), "user_id")
