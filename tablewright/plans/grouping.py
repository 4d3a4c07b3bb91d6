"""Grouped aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates, islands, skew
from tablewright.operators.common import as_column, cents, total
from tablewright.plans.registry import query, table
from tablewright.sinks.layout import spread


def _mean(column, places=4):
    """Mean of an exact sum, so that it does not depend on the order of adding."""
    return F.round(total(column) / F.count(as_column(column)), places)


@query(
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS orders, min(o_totalprice) AS smallest,
           max(o_totalprice) AS largest, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
           round(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice), 4) AS mean,
           count(DISTINCT o_custkey) AS customers
    FROM orders GROUP BY 1, 2
    """
)
def standard_aggregates(spark, folder):
    price = "o_totalprice"
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.min(price).alias("smallest"),
            F.max(price).alias("largest"),
            total(price).alias("amount"),
            _mean(price).alias("mean"),
            F.count_distinct("o_custkey").alias("customers"),
        )
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_base,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS sum_disc,
           round(CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_disc, count(*) AS lines
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-06-30 00:00:00' GROUP BY 1, 2
    """
)
def pricing_summary(spark, folder):
    kept = table(spark, folder, "lineitem").filter("l_shipdate <= timestamp_ntz'2001-06-30 00:00:00'")
    # Ten-thousandths, summed as decimals: four groups share all rows.
    discounted = (cents("l_extendedprice") * (100 - cents("l_discount"))).cast("decimal(18,0)")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        total("l_quantity").alias("sum_qty"),
        total("l_extendedprice").alias("sum_base"),
        (F.sum(discounted).cast("double") / 10000).alias("sum_disc"),
        _mean("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("lines"),
    )


@query(
    """
    SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
    """
)
def monthly_order_totals(spark, folder):
    totals = aggregates.period_totals(table(spark, folder, "orders"), "o_orderdate", cents("o_totalprice"))
    return totals.withColumn("total", F.col("total") / 100).orderBy("year", "month")


@query("SELECT count(*) AS rows FROM lineitem")
def whole_table_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query(
    """
    SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS events FROM events
    GROUP BY 1 HAVING count(*) > 1.0 * (SELECT count(*) FROM events) / 20
    """
)
def distinct_users_having(spark, folder):
    events = table(spark, folder, "events")
    made = events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events")
    )
    return made.filter(F.col("events") > events.agg(F.count(F.lit(1))).scalar() / 20)


@query(
    """
    WITH u AS (SELECT user_id % 20 AS team, user_id, count(DISTINCT event_type) AS held FROM events GROUP BY 1, 2)
    SELECT team, count(*) AS members FROM u WHERE held = 5 GROUP BY 1 HAVING count(*) >= 2
    """
)
def multi_event_teams(spark, folder):
    events = table(spark, folder, "events").withColumn("team", F.col("user_id") % 20)
    return aggregates.groups_with_members_holding(events, "team", "user_id", "event_type", k=5, min_members=2)


@query(
    """
    WITH u AS (SELECT o_custkey, o_custkey % 25 AS club, count(DISTINCT o_orderpriority) AS held FROM orders
               WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2)
    SELECT club, count(*) AS members FROM u WHERE held = 2 GROUP BY 1 HAVING count(*) >= 3
    """
)
def members_holding_listed_values(spark, folder):
    orders = table(spark, folder, "orders").withColumn("club", F.col("o_custkey") % 25)
    return aggregates.groups_with_members_holding(
        orders, "club", "o_custkey", "o_orderpriority", values=["1-URGENT", "5-LOW"], min_members=3
    )


@query(
    """
    WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d,
                      max(CASE WHEN event_type = 'view' THEN epoch_us(ts) END) AS a,
                      min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS b
               FROM events GROUP BY 1, 2)
    SELECT user_id, strftime(d, '%Y-%m-%d') AS day, a AS start_at, b AS end_at, b - a AS duration FROM p
    """
)
def event_pairs(spark, folder):
    pairs = islands.pair_events(_timed_events(spark, folder), ["user_id", "day"], "event_type", "at", "view", "purchase")
    return pairs


def _timed_events(spark, folder):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        "user_id",
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("at"),
    )


@query(
    """
    WITH p AS (SELECT user_id, CAST(ts AS DATE) AS d,
                      max(CASE WHEN event_type = 'view' THEN epoch_us(ts) END) AS a,
                      min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS b
               FROM events GROUP BY 1, 2)
    SELECT user_id, round(CAST(sum(b - a) AS DOUBLE) / count(b - a) / 1000000, 3) AS mean_duration
    FROM p GROUP BY 1
    """
)
def event_pair_durations(spark, folder):
    """Mean seconds from the last view to the first purchase of a user's day."""
    pairs = event_pairs(spark, folder).groupBy("user_id")
    mean = F.sum("duration").cast("double") / F.nullif(F.count("duration"), F.lit(0).cast("bigint"))
    return pairs.agg(F.round(mean / 1000000, 3).alias("mean_duration"))


_LEVELS = """
    SELECT CASE WHEN c_acctbal < 0 THEN 'Debt' WHEN c_acctbal < 4000 THEN 'Low' WHEN c_acctbal < 9000 THEN 'Average'
                WHEN c_acctbal < 20000 THEN 'High' ELSE 'Extreme' END AS category FROM customer
"""


@query(
    f"""
    SELECT l.category, count(c.category) AS count
    FROM (VALUES ('Debt'), ('Low'), ('Average'), ('High'), ('Extreme')) l(category)
    LEFT JOIN ({_LEVELS}) c ON c.category = l.category GROUP BY 1
    """
)
def acctbal_categories_zero_filled(spark, folder):
    labels = ["Debt", "Low", "Average", "High", "Extreme"]
    return aggregates.category_counts(table(spark, folder, "customer"), "c_acctbal", [0, 4000, 9000, 20000], labels)


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def duplicate_keys(spark, folder):
    return aggregates.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT text, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_texts(spark, folder):
    return aggregates.duplicates(table(spark, folder, "documents"), ["text"])


@query(
    """
    SELECT c_mktsegment, round(median(c_acctbal), 6) AS median FROM customer GROUP BY 1
    """
)
def median_by_segment(spark, folder):
    made = aggregates.median_by(table(spark, folder, "customer"), ["c_mktsegment"], "c_acctbal")
    return made.withColumn("median", F.round("median", 6))


@query("SELECT round(median(l_extendedprice), 6) AS median FROM lineitem")
def median_of_table(spark, folder):
    made = aggregates.median_by(table(spark, folder, "lineitem"), [], "l_extendedprice")
    return made.withColumn("median", F.round("median", 6))


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
      (SELECT o_custkey FROM orders GROUP BY 1 HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000)
    """
)
def big_spender_set(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    spent = total("o_totalprice")
    chosen = aggregates.members_where_total(orders, "o_custkey", spent, F.col("total") > 3000000)
    return chosen.select("o_orderkey", "o_custkey")


@query(
    """
    SELECT n_name AS nation, customers FROM nation JOIN
      (SELECT c_nationkey, count(DISTINCT c_custkey) AS customers FROM customer GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 3) ON c_nationkey = n_nationkey
    """
)
def top3_nations_by_customers(spark, folder):
    customer = table(spark, folder, "customer")
    best = aggregates.top_groups(customer, "c_nationkey", F.count_distinct("c_custkey"), 3, "customers")
    nation = table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS nation")
    return best.join(nation, "c_nationkey").select("nation", "customers")


@query(
    """
    SELECT l_suppkey AS merchant, count(*) AS transactions,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS volume FROM lineitem GROUP BY 1
    """
)
def merchant_volume(spark, folder):
    return table(spark, folder, "lineitem").groupBy(F.col("l_suppkey").alias("merchant")).agg(
        F.count(F.lit(1)).alias("transactions"), total("l_extendedprice").alias("volume")
    )


@query(
    """
    SELECT p_brand, max(l_quantity) AS largest FROM part LEFT JOIN lineitem
      ON l_partkey = p_partkey AND l_quantity > 45 AND l_discount > 0.09 GROUP BY 1
    """
)
def max_with_empty_groups(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    large = table(spark, folder, "lineitem").filter("l_quantity > 45 AND l_discount > 0.09")
    best = large.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").alias("best"))
    return part.join(best, "p_partkey", "left").groupBy("p_brand").agg(F.max("best").alias("largest"))


@query(
    """
    SELECT c_nationkey, arg_max(c_custkey, (c_acctbal, c_custkey)) AS c_custkey, max(c_acctbal) AS c_acctbal
    FROM customer GROUP BY 1
    """
)
def richest_customer_per_nation(spark, folder):
    customer = table(spark, folder, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return aggregates.row_with_max(customer, ["c_nationkey"], "c_acctbal", "c_custkey")


@query(
    """
    SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS "F",
           count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS "O",
           count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS "P"
    FROM orders GROUP BY 1
    """
)
def status_pivot(spark, folder):
    return aggregates.pivot_totals(
        table(spark, folder, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1))
    ).fillna(0)


@query(
    """
    SELECT 'negative' AS status, count(*) FILTER (c_acctbal < 0) AS count FROM customer
    UNION ALL SELECT 'rich', count(*) FILTER (c_acctbal > 9000) FROM customer
    UNION ALL SELECT 'total', count(*) FROM customer
    """
)
def status_counters(spark, folder):
    balance = F.col("c_acctbal")
    return aggregates.status_counts(
        table(spark, folder, "customer"), {"negative": balance < 0, "rich": balance > 9000}
    )


@query(
    """
    SELECT CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_suppkey END AS supplier, count(*) AS lines,
           CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, min(l_quantity) AS least, max(l_quantity) AS most,
           round(CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean
    FROM lineitem GROUP BY 1
    """
)
def salted_counts(spark, folder):
    """Supplier 0 is made a hot key."""
    supplier = F.when(F.col("l_linenumber") <= 3, F.lit(0).cast("bigint")).otherwise(F.col("l_suppkey"))
    lines = table(spark, folder, "lineitem").select(
        supplier.alias("supplier"), "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        cents("l_quantity").alias("exact"),
    )
    aggs = {
        "lines": ("count", "l_quantity"),
        "quantity": ("sum", "exact"),
        "least": ("min", "l_quantity"),
        "most": ("max", "l_quantity"),
        "mean": ("avg", "exact"),
    }
    made = skew.salted_aggregate(lines, ["supplier"], aggs, 8, ["l_orderkey", "l_partkey", "l_linenumber"])
    return made.withColumns(
        {"quantity": F.col("quantity") / 100, "mean": F.round(F.col("mean") / 100, 4)}
    )


_HOT = "SELECT CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_partkey END AS part FROM lineitem"


@query(
    f"""
    WITH c AS (SELECT part, count(*) AS rows FROM ({_HOT}) GROUP BY 1)
    SELECT part, rows, round(1.0::DOUBLE * rows / (SELECT sum(rows) FROM c), 6) AS share,
           round(1.0::DOUBLE * rows / (SELECT avg(rows) FROM c), 4) AS ratio_to_mean FROM c
    """
)
def skew_report(spark, folder):
    part = F.when(F.col("l_linenumber") <= 3, F.lit(0).cast("bigint")).otherwise(F.col("l_partkey"))
    return skew.skew_report(table(spark, folder, "lineitem").select(part.alias("part")), ["part"])


@query(
    """
    WITH n AS (SELECT greatest(4, count(*) // 1000000) AS n FROM lineitem),
         p AS (SELECT l_orderkey % n AS partition, count(*) AS rows FROM lineitem, n GROUP BY 1)
    SELECT partition::INTEGER AS partition, rows, round(rows / (SELECT avg(rows) FROM p), 4) AS ratio_to_mean FROM p
    """
)
def partition_layout(spark, folder):
    """Rows of every partition, placed by a number of ours; as many partitions as the rows ask for."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    n = max(4, lines.count() // 1_000_000)
    return skew.partition_report(lines.repartitionById(n, (F.col("l_orderkey") % n).cast("int")))


@query(
    """
    SELECT a.o_orderkey AS id1, count(*) AS rows, (a.o_orderkey + l_orderkey) AS sum_col
    FROM orders a JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 3
    """
)
def join_sum_count(spark, folder):
    orders = spread(table(spark, folder, "orders").select(F.col("o_orderkey").alias("id1")), by=["id1"])
    lines = spread(table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id2")), by=["id2"])
    joined = orders.join(lines, orders.id1 == lines.id2).withColumn("sum_col", F.col("id1") + F.col("id2"))
    return joined.groupBy("id1", "sum_col").agg(F.count(F.lit(1)).alias("rows"))


@query(
    """
    SELECT round(sum(ln(1 + p_size)), 6) AS log_product, max(p_size) AS largest, bit_xor(p_partkey) AS mixed FROM part
    """
)
def global_reduce(spark, folder):
    return table(spark, folder, "part").agg(
        F.round(F.sum(F.log(1 + F.col("p_size"))), 6).alias("log_product"),
        F.max("p_size").alias("largest"),
        F.bit_xor("p_partkey").alias("mixed"),
    )
