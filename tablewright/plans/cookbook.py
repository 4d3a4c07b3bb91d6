"""Queries a user writes as SQL text over tables and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators.common import cents
from tablewright.plans.registry import query, table
from tablewright.session import run_folder
from tablewright.sinks.writers import save_table

_WEEKS = """
    SELECT n_name AS country, CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 7) AS BIGINT) AS week,
           SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS invoice
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
"""


@query(
    f"""
    SELECT country, week, CAST(invoice AS DOUBLE) AS invoice,
           CAST(sum(invoice) OVER (PARTITION BY country ORDER BY week ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running,
           CAST(lag(invoice) OVER (PARTITION BY country ORDER BY week) AS DOUBLE) AS previous,
           CAST(coalesce(invoice - lag(invoice) OVER (PARTITION BY country ORDER BY week), 0) AS DOUBLE) AS difference
    FROM ({_WEEKS})
    """
)
def weekly_invoices_by_sql(spark, folder):
    """A view of weekly totals, then running sum and lag over a country's weeks."""
    names = ("orders", "customer", "nation")
    weeks = spark.sql(
        """
        SELECT n_name AS country, floor(datediff(o_orderdate, DATE '1995-01-01') / 7) AS week, sum(units) AS invoice
        FROM (SELECT c_nationkey, o_orderdate, CAST(rint(o_totalprice * 100) AS BIGINT) AS units
              FROM {orders} JOIN {customer} ON o_custkey = c_custkey)
        JOIN {nation} ON c_nationkey = n_nationkey
        GROUP BY 1, 2
        """,
        **{n: table(spark, folder, n) for n in names},
    )
    weeks.createOrReplaceTempView("weekly_invoices")
    return spark.sql(
        """
        SELECT country, week, invoice / 100 AS invoice,
               sum(invoice) OVER (PARTITION BY country ORDER BY week ROWS UNBOUNDED PRECEDING) / 100 AS running,
               lag(invoice) OVER w / 100 AS previous,
               coalesce(invoice - lag(invoice) OVER w, 0) / 100 AS difference
        FROM weekly_invoices WINDOW w AS (PARTITION BY country ORDER BY week)
        """
    )


@query(
    """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
      AND c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
    """
)
def exists_and_in_by_sql(spark, folder):
    return spark.sql(
        """
        SELECT c_custkey, c_name FROM {customer}
        WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
          AND c_nationkey IN (SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 9000)
        """,
        **{n: table(spark, folder, n) for n in ("customer", "orders", "supplier")},
    )


@query(
    """
    SELECT o_custkey, o_orderdate::DATE::VARCHAR AS order_day, count(*) AS copies FROM orders GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def duplicates_by_sql(spark, folder):
    return spark.sql(
        """
        SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_day, count(*) AS copies
        FROM {orders} GROUP BY 1, 2 HAVING count(*) > 1
        """,
        orders=table(spark, folder, "orders"),
    )


@query(
    """
    WITH s AS (SELECT c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC) AS n FROM (SELECT DISTINCT c_acctbal FROM customer))
    SELECT c_custkey, c_acctbal, n AS place FROM customer JOIN s USING (c_acctbal) WHERE n <= 5
    """
)
def highest_balances_by_sql(spark, folder):
    """Distinct values first; LIMIT keeps five of them before they are numbered."""
    return spark.sql(
        """
        WITH best AS (SELECT DISTINCT c_acctbal FROM {customer} ORDER BY c_acctbal DESC LIMIT 5),
             placed AS (SELECT c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC) AS place FROM best)
        SELECT c_custkey, c.c_acctbal, CAST(place AS BIGINT) AS place FROM {customer} c JOIN placed p ON c.c_acctbal = p.c_acctbal
        """,
        customer=table(spark, folder, "customer"),
    )


@query(
    """
    SELECT o_orderpriority, strftime(o_orderdate, '%Y') || 'Q' || quarter(o_orderdate) AS period,
           count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) AS orders
    FROM orders GROUP BY 1, 2
    """
)
def quarters_by_sql(spark, folder):
    return spark.sql(
        """
        SELECT o_orderpriority, concat(year(o_orderdate), 'Q', quarter(o_orderdate)) AS period,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) AS orders
        FROM {orders} GROUP BY 1, 2
        """,
        orders=table(spark, folder, "orders"),
    )


@query(
    """
    SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS lines
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
    """
)
def table_from_query(spark, folder):
    """CREATE TABLE AS, then a view over the table."""
    place = run_folder(spark, "ctas")
    name = "returns_" + place.rsplit("-", 1)[1]
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    totals = returned.groupBy("l_suppkey").agg(
        F.sum(cents("l_extendedprice")).alias("units"), F.count(F.lit(1)).alias("lines")
    )
    save_table(totals, name, path=place)
    spark.sql(f"SELECT l_suppkey, units / 100 AS amount, lines FROM {name}").createOrReplaceTempView("returned_amounts")
    return spark.table("returned_amounts")
