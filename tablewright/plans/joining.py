"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import joins, ranking, reshape
from tablewright.operators.common import day_text, total
from tablewright.plans.registry import query, table
from tablewright.session import run_folder
from tablewright.sinks.writers import save_table

BUCKET_ROWS = 4_000_000  # a bucket holds up to about so many; powers of two keep tables alike


def _renamed(df, prefix):
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in df.columns})


@query(
    """
    SELECT n_name AS nation, r_name AS region, count(*) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2
    """
)
def inner_join_on_shared_name(spark, folder):
    customer = _renamed(table(spark, folder, "customer"), "c_").select("nationkey")
    nation = table(spark, folder, "nation").toDF("nationkey", "nation", "regionkey")
    region = table(spark, folder, "region").toDF("regionkey", "region")
    counted = customer.groupBy("nationkey").agg(F.count(F.lit(1)).alias("customers"))
    joined = joins.equi_join(joins.equi_join(counted, nation, ["nationkey"]), region, ["regionkey"])
    return joined.groupBy("nation", "region").agg(F.sum("customers").alias("customers"))


@query(
    """
    SELECT o_orderpriority, count(*) AS lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def inner_join_on_two_names(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    joined = joins.equi_join(lines, orders, {"l_orderkey": "o_orderkey"})
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"), total("l_extendedprice").alias("amount")
    )


def _by_strategy(spark, folder, strategy):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_quantity")
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    joined = joins.equi_join(lines, part, {"l_partkey": "p_partkey"}, strategy=strategy)
    return joined.groupBy("p_brand").agg(total("l_quantity").alias("quantity"))


_BRANDS = """
    SELECT p_brand, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
"""


@query(_BRANDS)
def join_by_sort_merge(spark, folder):
    return _by_strategy(spark, folder, "merge")


@query(_BRANDS)
def join_by_shuffled_hash(spark, folder):
    return _by_strategy(spark, folder, "shuffle_hash")


@query(
    """
    SELECT n_name AS nation, count(*) AS suppliers, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
    """
)
def broadcast_join(spark, folder):
    supplier = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    nation = table(spark, folder, "nation").toDF("nationkey", "nation", "regionkey")
    joined = joins.broadcast_join(supplier, nation, ["nationkey"])
    return joined.groupBy("nation").agg(
        F.count(F.lit(1)).alias("suppliers"), total("s_acctbal").alias("balance")
    )


@query(
    """
    SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
    """
)
def left_join_line_counts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return joins.equi_join(orders, lines, ["o_orderkey"], "left").fillna(0, ["lines"])


@query(
    """
    SELECT n_name AS nation, count(s_suppkey) AS rich_suppliers
    FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1
    """
)
def right_join_keeps_nations(spark, folder):
    rich = table(spark, folder, "supplier").filter("s_acctbal > 5000")
    counts = rich.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("rich_suppliers"))
    nation = table(spark, folder, "nation").toDF("nationkey", "nation", "regionkey")
    kept = joins.equi_join(counts, nation, ["nationkey"], "right")
    return kept.select("nation", F.coalesce("rich_suppliers", F.lit(0)).alias("rich_suppliers"))


@query(
    """
    WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
         s AS (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
    SELECT coalesce(c.nationkey, s.nationkey) AS nationkey, customers, suppliers
    FROM c FULL OUTER JOIN s ON c.nationkey = s.nationkey
    """
)
def full_outer_side_by_side(spark, folder):
    rich = table(spark, folder, "customer").filter("c_acctbal > 9000")
    supplier = table(spark, folder, "supplier").filter("s_acctbal > 5000")
    return joins.side_by_side(
        rich.withColumnRenamed("c_nationkey", "nationkey"),
        supplier.withColumnRenamed("s_nationkey", "nationkey"),
        ["nationkey"],
        {"customers": F.count(F.lit(1))},
        {"suppliers": F.count(F.lit(1))},
    )


_NO_LINES = """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
"""


@query(_NO_LINES)
def orders_without_lines(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.missing_from(orders, lines, ["o_orderkey"])


@query(_NO_LINES)
def orders_without_lines_by_left_join(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .filter(F.col("l_orderkey").isNull())
        .drop("l_orderkey")
    )


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)
    """
)
def parts_never_sold_in_bulk(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    bulk = table(spark, folder, "lineitem").filter("l_quantity >= 49")
    return joins.missing_from(part, bulk.withColumnRenamed("l_partkey", "p_partkey"), ["p_partkey"])


@query(
    """
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_acctbal NOT IN (SELECT max(c_acctbal) FROM customer GROUP BY c_nationkey)
    """
)
def not_in_subquery(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    best = customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("best"))
    return joins.not_in(customer.drop("c_nationkey"), "c_acctbal", best, "best")


@query(
    """
    SELECT c_custkey, 'holds NULL' AS list FROM customer
    WHERE c_nationkey NOT IN (SELECT CASE WHEN s_acctbal > 0 THEN s_nationkey END FROM supplier)
    UNION ALL SELECT c_custkey, 'empty' FROM customer
    WHERE CASE WHEN c_acctbal > 0 THEN c_nationkey END NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 0)
    UNION ALL SELECT c_custkey, 'plain' FROM customer
    WHERE CASE WHEN c_acctbal > 0 THEN c_nationkey END NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey < 5)
    """
)
def not_in_list_with_null(spark, folder):
    """NOT IN a list with a NULL (nothing passes), an empty one (a NULL passes too) and a plain one (it does not)."""
    listed = table(spark, folder, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("nation")
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    some = customer.withColumn("c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")))
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    parts = [
        joins.not_in(rows, "c_nationkey", other, "nation").select("c_custkey", F.lit(name).alias("list"))
        for name, rows, other in (
            ("holds NULL", customer, listed),
            ("empty", some, supplier.filter("s_suppkey < 0")),
            ("plain", some, supplier.filter("s_suppkey < 5")),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <> (SELECT max(c_acctbal) FROM customer)
      AND c_acctbal > (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM customer)
    """
)
def scalar_subquery(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    best = customer.agg(F.max("c_acctbal")).scalar()
    mean = customer.agg(total("c_acctbal") / F.count(F.lit(1))).scalar()
    return customer.filter((F.col("c_acctbal") != best) & (F.col("c_acctbal") > mean))


@query(
    """
    SELECT c_custkey, c_acctbal FROM customer a
    WHERE 2 = (SELECT count(DISTINCT b.c_acctbal) FROM customer b WHERE b.c_acctbal > a.c_acctbal)
    """
)
def nth_highest(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return ranking.nth_value_rows(customer, [], "c_acctbal", 3).select("c_custkey", "c_acctbal")


@query(
    """
    WITH t AS (SELECT n_regionkey AS region, n_nationkey AS id, n_name AS name
               FROM nation WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey)),
         m AS (SELECT a.region, row_number() OVER (PARTITION BY a.region ORDER BY a.id, b.id) AS match_no,
                      a.name || '  vs  ' || b.name AS fixture
               FROM t a JOIN t b ON a.region = b.region AND a.id < b.id)
    SELECT region, match_no, fixture,
           strftime(DATE '2025-06-01' + CAST((match_no - 1) * 7 AS INTEGER), '%Y-%m-%d') AS match_day
    FROM m
    """
)
def fixture_list(spark, folder):
    """Nations that have customers, each against each of its region."""
    active = table(spark, folder, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    teams = table(spark, folder, "nation").join(active, "n_nationkey", "left_semi")
    teams = teams.withColumnRenamed("n_regionkey", "region")
    matches = joins.round_robin(teams, "n_nationkey", "n_name", "2025-05-28", keys=["region"])
    return matches.select("region", "match_no", "fixture", day_text("match_date").alias("match_day"))


_ORG = "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey >= 10 THEN c_custkey // 10 END AS boss FROM customer"


def _org(spark, folder):
    """Every customer reports to the one with its key less the last digit, as text."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.when(key >= 10, F.floor(key / 10).cast("string")).otherwise("").alias("boss"),
    )


@query(
    f"""
    WITH e AS ({_ORG})
    SELECT e.id, e.name, m.name AS manager_1, s.name AS manager_2
    FROM e LEFT JOIN e m ON m.id = e.boss LEFT JOIN e s ON s.id = m.boss
    """
)
def two_manager_levels(spark, folder):
    return joins.managers(_org(spark, folder), "id", "boss", "name", levels=2)


@query(
    f"""
    WITH RECURSIVE e AS ({_ORG}),
      walk AS (SELECT id, id AS root, CAST(0 AS BIGINT) AS depth FROM e WHERE boss IS NULL
               UNION ALL SELECT e.id, walk.root, walk.depth + 1 FROM e JOIN walk ON e.boss = walk.id)
    SELECT id, root, depth FROM walk
    """
)
def whole_hierarchy(spark, folder):
    return joins.hierarchy(_org(spark, folder), "id", "boss")


@query(
    """
    SELECT p_type, count(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem JOIN part ON p_partkey = CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_partkey END
    GROUP BY 1
    """
)
def salted_join(spark, folder):
    """Part 0 is made a hot key that holds three lines in seven."""
    hot = F.when(F.col("l_linenumber") <= 3, F.lit(0).cast("bigint")).otherwise(F.col("l_partkey"))
    lines = table(spark, folder, "lineitem").select(
        hot.alias("partkey"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("partkey"), "p_type")
    joined = joins.salted_join(lines, part, ["partkey"], salts=8)
    return joined.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("lines"), total("l_quantity").alias("quantity")
    )


@query(
    """
    SELECT o_orderstatus, count(*) AS lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def bucketed_join(spark, folder):
    """Both tables bucketed on the order key, so the join itself shuffles nothing."""
    place = run_folder(spark, "bucketed")
    tag = place.rsplit("-", 1)[1]
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    buckets = 1 << (lines.count() // BUCKET_ROWS).bit_length()
    saved = [
        save_table(
            df.repartition(buckets, "orderkey"),
            f"{name}_{tag}",
            path=f"{place}/{name}",
            bucket_by=["orderkey"],
            buckets=buckets,
        )
        for name, df in (("lines", lines), ("orders", orders))
    ]
    joined = joins.equi_join(*saved, ["orderkey"], strategy="merge")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("lines"), total("l_extendedprice").alias("amount")
    )


@query(
    """
    WITH m AS (SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
               FROM customer GROUP BY 1)
    SELECT c_custkey, c_mktsegment, c_acctbal, mean AS group_mean, mean - c_acctbal AS difference,
           round((mean - c_acctbal) / nullif(c_acctbal, 0) * 100, 2) AS difference_pct
    FROM customer JOIN m USING (c_mktsegment)
    """
)
def balance_vs_segment_mean(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    mean = total("c_acctbal") / F.count("c_acctbal")
    return joins.compare_to_group(customer, ["c_mktsegment"], "c_acctbal", mean=mean)


@query(
    """
    SELECT c_custkey, c_nationkey, richest, customers FROM customer
    JOIN (SELECT c_nationkey, max(c_acctbal) AS richest, count(*) AS customers FROM customer GROUP BY 1)
    USING (c_nationkey)
    """
)
def value_at_other_grain(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    measures = {"richest": F.max("c_acctbal"), "customers": F.count(F.lit(1))}
    return joins.at_grain(customer, ["c_nationkey"], measures).drop("c_acctbal")


@query(
    """
    SELECT p_partkey, p_brand, lines, quantity FROM part LEFT JOIN
      (SELECT l_partkey, count(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
       FROM lineitem WHERE l_quantity > 40 GROUP BY 1) ON l_partkey = p_partkey
    """
)
def blended_sources(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    large = table(spark, folder, "lineitem").filter("l_quantity > 40")
    measures = {"lines": F.count(F.lit(1)), "quantity": total("l_quantity")}
    return joins.blend(part, large.withColumnRenamed("l_partkey", "p_partkey"), ["p_partkey"], measures)


@query(
    """
    WITH m AS (SELECT l_suppkey AS host, l_partkey % (SELECT count(*) FROM supplier) AS guest,
                      CAST(l_quantity AS BIGINT) % 5 AS hg, l_linenumber % 5 AS gg FROM lineitem),
         p AS (SELECT host AS id, CASE WHEN hg > gg THEN 3 WHEN hg = gg THEN 1 ELSE 0 END AS points FROM m
               UNION ALL
               SELECT guest, CASE WHEN gg > hg THEN 3 WHEN hg = gg THEN 1 ELSE 0 END FROM m)
    SELECT s_suppkey AS team_id, s_name AS team_name, coalesce(sum(points), 0)::BIGINT AS points
    FROM supplier LEFT JOIN p ON id = s_suppkey GROUP BY 1, 2
    """
)
def league_table(spark, folder):
    """Each line is read as a match between two suppliers."""
    supplier = table(spark, folder, "supplier")
    size = supplier.agg(F.count(F.lit(1))).scalar()
    matches = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("host_team"),
        (F.col("l_partkey") % size).alias("guest_team"),
        (F.col("l_quantity").cast("bigint") % 5).alias("host_goal"),
        (F.col("l_linenumber") % 5).alias("guest_goal"),
    )
    teams = supplier.select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"))
    return reshape.league_table(matches, teams)
