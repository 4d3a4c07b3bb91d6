"""Weighted paths, a spanning forest, messages along edges and PageRank by residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import graph, paths
from tablewright.operators.common import cents
from tablewright.plans.registry import query, table
from tablewright.session import settle

_FAR = 1_000_000_000_000  # moves the ids of the second and third kind of vertex out of the way


@query(
    f"""
    WITH s AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 4 = 1),
         o AS (SELECT l_orderkey AS k, min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS d
               FROM lineitem JOIN s ON l_suppkey = id GROUP BY 1),
         c AS (SELECT o_custkey AS k, min(d + CAST(round(o_totalprice * 100) AS BIGINT)) AS d
               FROM o JOIN orders ON o_orderkey = k GROUP BY 1)
    SELECT id, 0::BIGINT AS distance FROM s UNION ALL SELECT k + {_FAR}, d FROM o UNION ALL SELECT k + 2 * {_FAR}, d FROM c
    """
)
def cheapest_paths(spark, folder):
    """Cheapest way from some suppliers over the lines of an order to its customer."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("src"), (F.col("l_orderkey") + _FAR).alias("dst"), cents("l_extendedprice").alias("weight")
    )
    orders = table(spark, folder, "orders").select(
        (F.col("o_orderkey") + _FAR).alias("src"), (F.col("o_custkey") + 2 * _FAR).alias("dst"), cents("o_totalprice").alias("weight")
    )
    sources = table(spark, folder, "supplier").filter("s_suppkey % 4 = 1").select(F.col("s_suppkey").alias("id"))
    return paths.shortest_paths(lines.unionByName(orders), sources)


# Every customer is tied to its nation and to the next one, so the nations lie on a ring: the forest has
# each customer's lighter edge and, for two nations, the heavier edge of the customer that ties them best,
# but for the heaviest of these if the ring is closed.
@query(
    f"""
    WITH n AS (SELECT count(*) AS c FROM nation),
         e AS (SELECT c_custkey AS src, c_nationkey + {_FAR} AS dst, CAST(round(c_acctbal * 100) AS BIGINT) AS weight, c_nationkey AS k FROM customer
               UNION ALL SELECT c_custkey, (c_nationkey + 1) % (SELECT c FROM n) + {_FAR}, c_custkey * 7919 % 1000003, c_nationkey FROM customer),
         r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight, dst) AS place FROM e),
         ring AS (SELECT *, row_number() OVER (ORDER BY weight DESC, src DESC, dst DESC) AS h, count(*) OVER () AS ties
                  FROM (SELECT * FROM r WHERE place = 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY weight, src, dst) = 1))
    SELECT src, dst, weight FROM r WHERE place = 1
    UNION ALL SELECT src, dst, weight FROM ring WHERE h > 1 OR ties < (SELECT c FROM n)
    """
)
def spanning_forest(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = table(spark, folder, "nation").count()
    here = F.struct(F.col("c_nationkey").cast("bigint").alias("to"), cents("c_acctbal").alias("weight"))
    there = F.struct(
        ((F.col("c_nationkey") + 1) % nations).cast("bigint").alias("to"), (F.col("c_custkey") * 7919 % 1000003).alias("weight")
    )
    edges = customer.select(F.col("c_custkey").alias("src"), F.inline(F.array(here, there)))
    return paths.spanning_forest(edges.select("src", (F.col("to") + _FAR).alias("dst"), "weight"))


@query(
    f"""
    WITH m AS (
      SELECT l_partkey + {_FAR} AS id, CAST(l_quantity AS BIGINT) * CAST(round(s_acctbal * 100) AS BIGINT) AS m FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
      UNION ALL SELECT l_suppkey, CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT) FROM lineitem JOIN part ON p_partkey = l_partkey
        WHERE l_returnflag <> 'R')
    SELECT id, count(*) AS messages, sum(m)::BIGINT AS total FROM m GROUP BY 1
    """
)
def messages_along_lines(spark, folder):
    """Quantities times the other end's amount, sent both ways; returned lines send nothing to the supplier."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("src"),
        (F.col("l_partkey") + _FAR).alias("dst"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_returnflag",
    )
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), cents("s_acctbal").alias("amount"))
    parts = table(spark, folder, "part").select((F.col("p_partkey") + _FAR).alias("id"), cents("p_retailprice").alias("amount"))
    return paths.aggregate_messages(
        lines,
        suppliers.unionByName(parts),
        [F.count(F.lit(1)).alias("messages"), F.sum("message").alias("total")],
        to_dst=F.col("quantity") * F.col("source.amount"),
        to_src=F.when(F.col("l_returnflag") != "R", F.col("quantity") * F.col("target.amount")),
    )


@query(
    """
    SELECT (SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
           + (SELECT count(DISTINCT l_suppkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS vertices,
           TRUE AS adds_up, TRUE AS ordered
    """
)
def pagerank_of_changing_vertices(spark, folder):
    """PageRank over who bought from whom: the ranks add up, and suppliers with more customers rank higher in the mean."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    trade = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("src"), (F.col("l_suppkey") + _FAR).alias("dst")
    )
    # a customer is never a supplier, so both ways of distinct pairs are distinct too
    edges = settle(graph.both_ways(trade.distinct()))
    tol = 0.02
    ranks = paths.pagerank_by_residuals(edges, tol)
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    suppliers = F.when(F.col("id") >= _FAR, 1)
    facts = ranks.join(degrees, "id").agg(
        F.count(F.lit(1)).alias("vertices"),
        F.sum("rank").alias("total"),
        F.corr(suppliers * F.col("rank"), suppliers * F.col("degree")).alias("alike"),
    )
    # unsent residuals, and what they would have brought to others
    lost = F.col("vertices") * tol / 0.15
    return facts.select(
        "vertices",
        F.col("total").between(F.col("vertices") - lost, F.col("vertices") + 0.001).alias("adds_up"),
        (F.col("alike") > 0.9).alias("ordered"),
    )
