"""Running, moving and ranking window queries.

Rows are added up to the grain of the window first wherever that bounds a group
(days or months of one key). Queries on raw rows go through the operators that
split large groups.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.operators import aggregates, islands, ordered, ranking
from tablewright.operators.common import cents, day_text, join_null_safe
from tablewright.plans.registry import query, table

_ORDER = ["o_orderdate", "o_orderkey"]


def monthly_sales_by_nation(spark, folder):
    """Revenue per nation and month: the flagship's input."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    # In ten-thousandths: whole numbers within an order, decimals above.
    revenue = cents("l_extendedprice") * (100 - cents("l_discount"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum(revenue).alias("revenue"))
    per_month = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg(F.sum(F.col("revenue").cast("decimal(18,0)")).alias("sales"))
    )
    return per_month.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("nation", "month", "sales")


_SALES = """
    SELECT n_name AS nation, strftime(o_orderdate, '%Y-%m') AS month,
           SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS sales
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
"""


@query(
    f"""
    WITH s AS ({_SALES})
    SELECT nation, month, CAST(sales AS DOUBLE) AS sales,
           CAST(sum(sales) OVER w AS DOUBLE) AS running, dense_rank() OVER w AS rank,
           CAST(lag(sales) OVER w AS DOUBLE) AS previous,
           CAST(coalesce(sales - lag(sales) OVER w, 0) AS DOUBLE) AS difference
    FROM s WINDOW w AS (PARTITION BY nation ORDER BY month)
    """
)
def running_sales_report(spark, folder):
    """Running sum, previous month, difference and rank; a nation has few months."""
    w = Window.partitionBy("nation").orderBy("month")
    previous = F.lag("sales").over(w)

    def units(column):
        return column.cast("double") / 10000

    return monthly_sales_by_nation(spark, folder).select(
        "nation",
        "month",
        units(F.col("sales")).alias("sales"),
        units(F.sum("sales").over(w)).alias("running"),
        F.dense_rank().over(w).cast("bigint").alias("rank"),
        units(previous).alias("previous"),
        units(F.coalesce(F.col("sales") - previous, F.lit(0))).alias("difference"),
    )


@query(
    """
    SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders
    """
)
def running_total_by_row(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER, "o_custkey", "o_totalprice")
    made = ordered.running_sum(orders, ["o_custkey"], _ORDER, {"running": cents("o_totalprice")})
    return made.select("o_orderkey", "o_custkey", (F.col("running") / 100).alias("running"))


@query(
    """
    SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS running
    FROM orders
    """
)
def running_total_with_ties(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER, "o_custkey", "o_totalprice")
    made = ordered.running_sum_with_peers(
        orders, ["o_custkey"], ["o_orderdate"], {"running": cents("o_totalprice")}
    )
    return made.select("o_orderkey", "o_custkey", (F.col("running") / 100).alias("running"))


@query(
    """
    SELECT o_orderkey, row_number() OVER w AS position,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running
    FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
    """
)
def prefix_sum_of_table(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER, "o_totalprice")
    sums = {"position": F.lit(1), "running": cents("o_totalprice")}
    made = ordered.running_sum(orders, [], _ORDER, sums)
    return made.select("o_orderkey", "position", (F.col("running") / 100).alias("running"))


@query(
    """
    SELECT o_orderkey, row_number() OVER w AS position,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running
    FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
    """
)
def prefix_sum_in_slices(spark, folder):
    """The same with the rows cut into slices, however few there are."""
    orders = table(spark, folder, "orders").select(*_ORDER, "o_totalprice")
    sums = {"position": F.lit(1), "running": cents("o_totalprice")}
    made = ordered.running_sum(orders, [], _ORDER, sums)
    return made.select("o_orderkey", "position", (F.col("running") / 100).alias("running"))


@query(
    """
    SELECT o_orderkey, o_custkey, lag(o_totalprice) OVER w AS previous, lead(o_totalprice) OVER w AS next,
           CAST(coalesce(CAST(o_totalprice AS DECIMAL(18,2)) - lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w, 0) AS DOUBLE) AS difference
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """
)
def lag_lead_difference(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER, "o_custkey", "o_totalprice")
    exact = cents("o_totalprice")

    def columns(w):
        return {
            "previous": F.lag("o_totalprice").over(w),
            "next": F.lead("o_totalprice").over(w),
            "difference": F.coalesce(exact - F.lag(exact).over(w), F.lit(0)) / 100,
        }

    made = ordered.with_neighbours(orders, ["o_custkey"], _ORDER, columns, before=1, after=1)
    return made.select("o_orderkey", "o_custkey", "previous", "next", "difference")


_DAILY = """
    SELECT event_type, CAST(ts AS DATE) AS day, SUM(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2
"""


def _daily(spark, folder):
    return (
        table(spark, folder, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.sum(cents("value")).alias("total"))
    )


@query(
    f"""
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CAST(total AS DOUBLE) AS total,
           round(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 4) AS moving_avg
    FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """
)
def moving_avg_3_rows(spark, folder):
    def columns(w):
        last = w.rowsBetween(-2, 0)
        return {"moving_avg": F.round(F.sum("total").over(last) / 100 / F.count("total").over(last), 4)}

    made = ordered.with_neighbours(
        _daily(spark, folder), ["event_type"], ["day"], columns, before=2, bounded=True
    )
    return made.select("event_type", day_text("day").alias("day"), (F.col("total") / 100).alias("total"), "moving_avg")


@query(
    f"""
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
           round(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 4) AS moving_avg
    FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY day
                                 RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
    """
)
def moving_avg_7_days(spark, folder):
    """By calendar days, so missing days do not widen the frame."""
    w = Window.partitionBy("event_type").orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    mean = F.sum("total").over(w) / 100 / F.count("total").over(w)
    return _daily(spark, folder).select("event_type", day_text("day").alias("day"), F.round(mean, 4).alias("moving_avg"))


@query(
    """
    SELECT event_id, user_id, round(CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w, 4) AS moving_avg
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """
)
def moving_avg_of_raw_events(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")

    def columns(w):
        last = w.rowsBetween(-2, 0)
        return {"moving_avg": F.round(F.sum(cents("value")).over(last) / 100 / F.count("value").over(last), 4)}

    made = ordered.with_neighbours(events, ["user_id"], ["ts", "event_id"], columns, before=2)
    return made.select("event_id", "user_id", "moving_avg")


@query(
    """
    SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """
)
def latest_order_row_number(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    latest = ranking.first_rows(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", day_text("o_orderdate").alias("order_day"))


@query(
    """
    SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
    QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1
    """
)
def latest_order_dense_rank(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    latest = ranking.top_with_ties(orders, ["o_custkey"], "o_orderdate", 1)
    return latest.select("o_custkey", "o_orderkey", day_text("o_orderdate").alias("order_day"))


@query(
    """
    SELECT c_custkey, c_nationkey, c_acctbal,
           rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal / 1000) DESC) AS place
    FROM customer QUALIFY place <= 3
    """
)
def top3_by_rank_with_gaps(spark, folder):
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", F.floor(F.col("c_acctbal") / 1000).alias("level")
    )
    return ranking.top_with_ties(customer, ["c_nationkey"], "level", 3, kind="rank", into="place").drop("level")


@query(
    """
    SELECT c_custkey, c_mktsegment, c_acctbal,
           dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS place
    FROM customer QUALIFY place <= 3
    """
)
def top3_per_group(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return ranking.top_with_ties(customer, ["c_mktsegment"], "c_acctbal", 3, into="place")


@query(
    """
    WITH r AS (SELECT l_suppkey, l_quantity, l_orderkey, l_linenumber, l_partkey,
                      dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS r FROM lineitem)
    SELECT l_suppkey, l_quantity, l_orderkey, l_linenumber, l_partkey FROM r
    QUALIFY r = max(least(r, 2)) OVER (PARTITION BY l_suppkey)
    """
)
def second_highest_or_highest(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_quantity", "l_orderkey", "l_linenumber", "l_partkey"
    )
    return ranking.nth_value_rows(lines, ["l_suppkey"], "l_quantity", 2, or_last=True)


@query(
    """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    QUALIFY dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) = 2
    """
)
def second_highest(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return ranking.nth_value_rows(customer, ["c_mktsegment"], "c_acctbal", 2)


_RANKS = """
    SELECT o_orderkey, o_orderpriority, rank() OVER w AS rank, dense_rank() OVER w AS dense,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS "unique",
           count(*) OVER w AS modified
    FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC)
"""


def _rank_kinds(spark, folder, **how):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.rank_rows(
        orders, ["o_orderpriority"], "o_orderdate", tie_break=["o_orderkey"],
        rank="rank", dense="dense", unique="unique", modified="modified", **how,
    ).drop("o_orderdate")


@query(_RANKS)
def rank_kinds(spark, folder):
    return _rank_kinds(spark, folder)


@query(_RANKS)
def rank_kinds_in_slices(spark, folder):
    return _rank_kinds(spark, folder)


@query(
    """
    WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type IN ('view', 'click')),
         f AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY user_id ORDER BY day) <= 1 THEN 0 ELSE 1 END AS opens FROM d),
         g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY day) AS island FROM f)
    SELECT user_id, island::BIGINT AS island, strftime(min(day), '%Y-%m-%d') AS first_day,
           strftime(max(day), '%Y-%m-%d') AS last_day, count(*) AS n
    FROM g GROUP BY user_id, g.island
    """
)
def islands_of_active_days(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    runs = islands.islands(events, ["user_id"], "day", where=F.col("event_type").isin("view", "click"))
    return runs.select("user_id", "island", day_text("start").alias("first_day"), day_text("end").alias("last_day"), "n")


@query(
    """
    WITH d AS (SELECT DISTINCT user_id, ts FROM events),
         f AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= 10800000000
                              THEN 0 ELSE 1 END AS opens FROM d),
         g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM f)
    SELECT user_id, island::BIGINT AS island, epoch_us(max(ts)) - epoch_us(min(ts)) AS micros, count(*) AS n
    FROM g GROUP BY user_id, g.island
    """
)
def sessions_by_gap(spark, folder):
    """Runs of events less than three hours apart."""
    runs = islands.islands(table(spark, folder, "events"), ["user_id"], "ts", gap=3 * 3600)
    micros = F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end"))
    return runs.select("user_id", "island", micros.alias("micros"), "n")


_CUT = """
    WITH r AS (SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
                      (PARTITION BY {by} ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
               FROM orders)
    SELECT o_orderkey, o_custkey, running FROM r WHERE running <= {limit}
    QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY running DESC, o_orderkey DESC) = 1
"""


def _cutoff(spark, folder, keys, limit):
    orders = table(spark, folder, "orders").select(*_ORDER, "o_custkey", cents("o_totalprice").alias("price"))
    made = ordered.capacity_cutoff(orders, _ORDER, "price", limit * 100, keys)
    return made.select("o_orderkey", "o_custkey", (F.col("running") / 100).alias("running"))


@query(_CUT.format(by="o_custkey", limit=1000000))
def capacity_cutoff(spark, folder):
    return _cutoff(spark, folder, ["o_custkey"], 1000000)


@query(_CUT.format(by="1", limit=100000000))
def capacity_cutoff_of_table(spark, folder):
    return _cutoff(spark, folder, [], 100000000)


@query(
    """
    WITH d AS (SELECT l_suppkey AS merchant, CAST(l_shipdate AS DATE) AS day,
                      SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY 1, 2)
    SELECT merchant, strftime(day, '%Y-%m-%d') AS day, CAST(amount AS DOUBLE) AS amount,
           CAST(sum(amount) OVER (PARTITION BY merchant ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
    FROM d
    """
)
def daily_balance_per_merchant(spark, folder):
    daily = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("merchant"), F.to_date("l_shipdate").alias("day"))
        .agg(F.sum(cents("l_extendedprice")).alias("amount"))
    )
    made = ordered.running_sum(daily, ["merchant"], ["day"], {"balance": "amount"}, bounded=True)
    return made.select(
        "merchant",
        day_text("day").alias("day"),
        (F.col("amount") / 100).alias("amount"),
        (F.col("balance") / 100).alias("balance"),
    )


@query(
    """
    SELECT c_custkey, c_mktsegment, round(c_acctbal - m, 4) AS above_median FROM customer
    JOIN (SELECT c_mktsegment, median(c_acctbal) AS m FROM customer GROUP BY 1) USING (c_mktsegment)
    """
)
def distance_to_segment_median(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    middle = aggregates.median_by(customer, ["c_mktsegment"], "c_acctbal")
    joined = join_null_safe(customer, middle, ["c_mktsegment"])
    return joined.select("c_custkey", "c_mktsegment", F.round(F.col("c_acctbal") - F.col("median"), 4).alias("above_median"))
