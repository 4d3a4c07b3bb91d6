"""Snapshot comparison, type-2 history, incremental load and constraint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import constraints, history
from tablewright.operators.common import cents, day_text
from tablewright.plans.registry import query, table
from tablewright.session import run_folder
from tablewright.sinks.writers import refresh


def _snapshots(spark, folder):
    """The customer table and a later state: keys dropped, changed, set to NULL and added."""
    key = F.col("c_custkey")
    before = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.when(key % 9 != 0, F.col("c_mktsegment")).alias("segment"), "c_nationkey"
    )
    kept = before.filter(key % 10 != 3).select(
        "c_custkey",
        "c_name",
        F.when(key % 10 == 5, "MOVED").when(key % 10 == 6, F.lit(None)).otherwise(F.col("segment")).alias("segment"),
        F.when(key % 10 == 7, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
    )
    added = before.filter(key % 10 == 1).select(
        (-key - 1).alias("c_custkey"), "c_name", F.lit("NEW").alias("segment"), "c_nationkey"
    )
    return before, kept.unionByName(added)


_BEFORE = """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS segment, c_nationkey FROM customer
"""
_AFTER = f"""
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 5 THEN 'MOVED' WHEN c_custkey % 10 = 6 THEN NULL ELSE segment END AS segment,
           CASE WHEN c_custkey % 10 = 7 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey
    FROM ({_BEFORE}) WHERE c_custkey % 10 <> 3
    UNION ALL SELECT -c_custkey - 1, c_name, 'NEW', c_nationkey FROM ({_BEFORE}) WHERE c_custkey % 10 = 1
"""


@query(
    f"""
    WITH a AS ({_BEFORE}), b AS ({_AFTER})
    SELECT b.c_custkey, b.c_name, b.segment, b.c_nationkey, 'Added' AS change_type, NULL AS changed_columns
    FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.c_custkey = b.c_custkey)
    UNION ALL
    SELECT a.*, 'Deleted', NULL FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.c_custkey = b.c_custkey)
    UNION ALL
    SELECT b.*, 'Modified', concat_ws(',', CASE WHEN a.segment IS DISTINCT FROM b.segment THEN 'segment' END,
                                           CASE WHEN a.c_nationkey IS DISTINCT FROM b.c_nationkey THEN 'c_nationkey' END)
    FROM a JOIN b ON a.c_custkey = b.c_custkey
    WHERE a.segment IS DISTINCT FROM b.segment OR a.c_nationkey IS DISTINCT FROM b.c_nationkey
    """
)
def snapshot_diff(spark, folder):
    return history.snapshot_diff(*_snapshots(spark, folder), ["c_custkey"])


def _merged(spark, folder, close_missing=False):
    before, after = _snapshots(spark, folder)
    tracked = ["segment", "c_nationkey"]
    opened = history.open_history(before.drop("c_name"), ["c_custkey"], tracked, "2024-01-01")
    merged = history.scd2_merge(
        opened, after.drop("c_name"), ["c_custkey"], tracked, "2025-05-24", close_missing
    )
    return merged.withColumns({c: day_text(c) for c in ("start_date", "end_date")})


def _history_sql(close_missing):
    missing = "b.c_custkey IS NULL" if close_missing else "false"
    return f"""
    WITH a AS ({_BEFORE}), b AS ({_AFTER}),
         j AS (SELECT a.c_custkey AS k, a.segment AS s, a.c_nationkey AS n, b.c_custkey IS NULL AS gone,
                      b.segment AS s2, b.c_nationkey AS n2, ({missing}) AS closes,
                      b.c_custkey IS NOT NULL AND (a.segment IS DISTINCT FROM b.segment
                        OR a.c_nationkey IS DISTINCT FROM b.c_nationkey) AS changed
               FROM a LEFT JOIN b ON a.c_custkey = b.c_custkey),
         v AS (SELECT k AS c_custkey, s AS segment, n AS c_nationkey, '2024-01-01' AS start_date,
                      CASE WHEN changed OR closes THEN '2025-05-24' END AS end_date, NOT (changed OR closes) AS is_current FROM j
               UNION ALL SELECT k, s2, n2, '2025-05-24', NULL, true FROM j WHERE changed
               UNION ALL SELECT c_custkey, segment, c_nationkey, '2025-05-24', NULL, true FROM b
               WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.c_custkey = b.c_custkey))
    SELECT *, md5(coalesce(segment, '∅') || '|' || c_nationkey) AS hash FROM v
    """


@query(_history_sql(False))
def scd2_merge(spark, folder):
    return _merged(spark, folder)


@query(_history_sql(True))
def scd2_merge_closing_missing(spark, folder):
    return _merged(spark, folder, close_missing=True)


@query(_AFTER + f" UNION ALL SELECT * FROM ({_BEFORE}) WHERE c_custkey % 10 = 3")
def upserted_customers(spark, folder):
    return history.upsert(*_snapshots(spark, folder), ["c_custkey"])


@query(
    """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
    WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'
    """
)
def incremental_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    since = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    fresh = history.incremental(orders, "o_orderdate", since)
    return fresh.select("o_orderkey", "o_custkey", day_text("o_orderdate").alias("order_day"))


@query(
    """
    SELECT o_custkey, count(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
    FROM orders GROUP BY 1
    """
)
def incremental_refresh(spark, folder):
    """Totals saved up to a date, then brought forward with the later orders only."""
    place = run_folder(spark, "refresh")
    name = "spent_" + place.rsplit("-", 1)[1]
    orders = table(spark, folder, "orders")
    mark = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")

    def totals(rows):
        return rows.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("orders"), F.sum(cents("o_totalprice")).alias("spent")
        )

    refresh(name, totals(orders.filter(F.col("o_orderdate") <= mark)), path=f"{place}/table")
    fresh = totals(history.incremental(orders, "o_orderdate", mark))
    refresh(name, fresh, "incremental", ["o_custkey"], ["orders", "spent"], scratch=f"{place}/next")
    return spark.table(name).withColumn("spent", F.col("spent") / 100)


def _rules():
    return constraints.Rules(
        not_null=["orderkey", "suppkey"],
        unique=[["orderkey", "linenumber"]],
        foreign={"orderkey": ("orders", "o_orderkey"), "partkey": ("part", "p_partkey")},
        check={"positive quantity": F.col("quantity") > 0, "discount at most 5%": F.col("discount") <= 0.05},
    )


def _checked_lines(spark, folder):
    """Lines with some keys missing and some pointing nowhere."""
    key = F.col("l_partkey")
    return table(spark, folder, "lineitem").select(
        F.when(key % 50 != 0, F.col("l_orderkey")).alias("orderkey"),
        F.when(key % 40 == 1, key + 1000000000).otherwise(key).alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
    )


_LINES = """
    SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_orderkey END AS orderkey,
           CASE WHEN l_partkey % 40 = 1 THEN l_partkey + 1000000000 ELSE l_partkey END AS partkey,
           l_suppkey AS suppkey, l_linenumber AS linenumber, l_quantity AS quantity, l_discount AS discount FROM lineitem
"""


@query(
    f"""
    WITH l AS ({_LINES})
    SELECT 'not null orderkey' AS rule, count(*) AS violations FROM l WHERE orderkey IS NULL
    UNION ALL SELECT 'not null suppkey', count(*) FROM l WHERE suppkey IS NULL
    UNION ALL SELECT 'check positive quantity', count(*) FROM l WHERE quantity <= 0
    UNION ALL SELECT 'check discount at most 5%', count(*) FROM l WHERE discount > 0.05
    UNION ALL SELECT 'unique orderkey,linenumber', coalesce(sum(n), 0)::BIGINT FROM
      (SELECT count(*) AS n FROM l WHERE orderkey IS NOT NULL GROUP BY orderkey, linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'foreign key orderkey -> orders.o_orderkey', count(*) FROM l
      WHERE orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = orderkey)
    UNION ALL SELECT 'foreign key partkey -> part.p_partkey', count(*) FROM l
      WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = partkey)
    """
)
def constraint_report(spark, folder):
    refs = {"orders": table(spark, folder, "orders"), "part": table(spark, folder, "part")}
    return constraints.check_constraints(_checked_lines(spark, folder), _rules(), refs)


@query(
    f"""
    WITH l AS ({_LINES})
    SELECT rule, count(*) AS rows FROM (
      SELECT 'not null orderkey' AS rule FROM l WHERE orderkey IS NULL
      UNION ALL SELECT 'check discount at most 5%' FROM l WHERE discount > 0.05) GROUP BY 1
    """
)
def rows_breaking_rules(spark, folder):
    broken = constraints.violating_rows(_checked_lines(spark, folder), _rules())
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT coalesce(orderkey, -1) AS orderkey, count(*) AS rows FROM ({_LINES}) GROUP BY 1")
def default_values(spark, folder):
    filled = constraints.with_defaults(_checked_lines(spark, folder), {"orderkey": -1})
    return filled.groupBy("orderkey").agg(F.count(F.lit(1)).alias("rows"))
