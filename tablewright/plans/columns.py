"""Queries on single rows: projection, filters, NULLs, schemas, sets and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import conform, ranking, sets
from tablewright.operators.common import day_text, money, read_as, total
from tablewright.operators.ordered import number_rows
from tablewright.plans.registry import query, table


@query(
    """
    SELECT c_mktsegment AS segment, count(*) AS customers
    FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment
    """
)
def segment_counts(spark, folder):
    rows = table(spark, folder, "customer").filter("c_acctbal > 0")
    return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )


@query(
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name, 'active' AS tag,
           CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * CAST(0.15 AS DECIMAL(3,2)), 3) AS DOUBLE) AS bonus
    FROM customer
    """
)
def bonus_column(spark, folder):
    df = table(spark, folder, "customer").withColumn("tag", F.lit("active"))
    bonus = F.round(money("c_acctbal") * F.lit(0.15).cast("decimal(3,2)"), 3).cast("double")
    return df.withColumn("bonus", bonus).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), "tag", "bonus"
    )


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
    WHERE (o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 100000 AND 200000)
       OR (o_orderpriority LIKE '1-%' AND NOT o_orderstatus IN ('F', 'O'))
       OR (lower(o_orderpriority) LIKE '%low%' AND regexp_matches(o_orderpriority, '^[5-9]') AND o_totalprice < 20000)
    """
)
def predicate_mix(spark, folder):
    listed = F.col("o_orderstatus").isin("F", "O")
    priority = F.col("o_orderpriority")
    return (
        table(spark, folder, "orders")
        .filter(
            (listed & F.col("o_totalprice").between(100000, 200000))
            | (priority.like("1-%") & ~listed)
            | (priority.ilike("%low%") & priority.rlike("^[5-9]") & (F.col("o_totalprice") < 20000))
        )
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    )


def _holed_customers(spark, folder):
    """Customers with missing values and placeholder texts worked in."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 7 == 0, "NA").when(key % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 5 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(key % 3 != 0, F.col("c_nationkey")).alias("nation"),
    )


_HOLED = """
    SELECT c_custkey,
           CASE WHEN c_custkey % 7 = 0 THEN 'NA' WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS balance,
           CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS nation
    FROM customer
"""


@query(
    f"""
    SELECT c_custkey, CASE WHEN segment IN ('NA', '') THEN 'unknown' ELSE segment END AS segment,
           coalesce(balance, 0.0) AS balance, coalesce(nation, -1) AS nation
    FROM ({_HOLED})
    """
)
def filled_nulls(spark, folder):
    fills = {"segment": "unknown", "balance": 0.0, "nation": -1}
    return conform.clean_table(_holed_customers(spark, folder), fills)


@query(
    f"""
    SELECT c_custkey, segment, balance, nation FROM ({_HOLED})
    WHERE segment NOT IN ('NA', '') AND balance IS NOT NULL AND nation IS NOT NULL
    """
)
def rows_without_nulls(spark, folder):
    return conform.nulls_from_tokens(_holed_customers(spark, folder)).dropna(how="any")


@query(
    f"""
    SELECT count(*) AS total, count(balance) AS with_balance, count(*) - count(nation) AS without_nation,
           count(CASE WHEN balance IS NOT DISTINCT FROM NULL THEN 1 END) AS null_equal
    FROM ({_HOLED})
    """
)
def null_tests(spark, folder):
    return _holed_customers(spark, folder).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("balance").isNotNull()).alias("with_balance"),
        F.count_if(F.col("nation").isNull()).alias("without_nation"),
        F.count_if(F.col("balance").eqNullSafe(F.lit(None))).alias("null_equal"),
    )


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS VARCHAR) AS email,
           TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment
    FROM customer
    """
)
def conformed_schema(spark, folder):
    wanted = "c_custkey string, c_name string, email string, c_mktsegment int"
    return conform.conform_schema(table(spark, folder, "customer"), wanted)


@query(
    """
    SELECT p_partkey, p_name,
           CASE WHEN p_size > 25 THEN '' ELSE 'p_size=' || p_size || ';' END
             || 'p_brand=' || p_brand || ';p_type=' || p_type AS rescued
    FROM part
    """
)
def rescued_columns(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_size") <= 25, F.col("p_size")).alias("p_size"),
        "p_brand",
        "p_type",
    )
    kept = conform.rescue_columns(part, "p_partkey bigint, p_name string")
    entries = F.transform(
        F.map_entries("_rescued_data"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return kept.select("p_partkey", "p_name", F.array_join(entries, ";").alias("rescued"))


@query("SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, folder):
    return table(spark, folder, "documents").select("lang", "source").distinct()


@query(
    """
    SELECT l_returnflag, count(*) AS n, count(TRY_CAST(l_returnflag AS INTEGER)) AS numeric_flags,
           sum(CAST(l_quantity AS BIGINT))::BIGINT AS whole_quantity
    FROM lineitem GROUP BY l_returnflag
    """
)
def casts(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(read_as(F.col("l_returnflag"), "int")).alias("numeric_flags"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("whole_quantity"),
        )
    )


@query("SELECT c_custkey, -abs(c_acctbal) AS balance FROM customer")
def negated_balances(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", conform.made_negative("c_acctbal").alias("balance")
    )


@query(
    """
    SELECT s_suppkey, s_name, n AS row_no FROM (
      SELECT *, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS n FROM supplier
    ) WHERE n % 2 = 1
    """
)
def every_other_row(spark, folder):
    order = [F.col("s_acctbal").desc(), "s_suppkey"]
    numbered = number_rows(table(spark, folder, "supplier"), [], order, "row_no")
    return numbered.filter("row_no % 2 = 1").select("s_suppkey", "s_name", "row_no")


@query(
    """
    SELECT CASE WHEN abs(o_orderkey) % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, count(*) AS count
    FROM orders GROUP BY 1
    """
)
def parity_counts(spark, folder):
    return conform.parity_counts(table(spark, folder, "orders"), "o_orderkey")


@query(
    """
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast'
                WHEN o_orderpriority IN ('3-MEDIUM') THEN 'normal' ELSE 'slow' END AS lane,
           count(*) AS orders
    FROM orders GROUP BY 1
    """
)
def value_groups(spark, folder):
    groups = {"fast": ["1-URGENT", "2-HIGH"], "normal": ["3-MEDIUM"]}
    lane = conform.value_group("o_orderpriority", groups, "slow").alias("lane")
    return table(spark, folder, "orders").groupBy(lane).agg(F.count(F.lit(1)).alias("orders"))


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 8 = 3
    """
)
def sample_bucket(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return conform.sample_bucket(orders, ["o_orderkey"], 8, 3)


@query(
    """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS nation_id, c_acctbal > 0 AS in_credit
    FROM customer
    """
)
def altered_columns(spark, folder):
    return conform.change_columns(
        table(spark, folder, "customer"),
        cast={"c_nationkey": "bigint"},
        add={"in_credit": F.col("c_acctbal") > 0},
        drop=["c_acctbal", "c_mktsegment"],
        rename={"c_nationkey": "nation_id"},
    )


@query(f"SELECT c_custkey, segment, balance FROM ({_HOLED}) WHERE NOT coalesce(balance < 0, false)")
def rows_left_by_delete(spark, folder):
    rows = _holed_customers(spark, folder).select("c_custkey", "segment", "balance")
    return conform.delete_where(rows, F.col("balance") < 0)


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN '2-HIGH' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def rows_after_update(spark, folder):
    changes = {"o_orderpriority": F.lit("2-HIGH"), "o_orderstatus": F.lit("O")}
    orders = table(spark, folder, "orders")
    updated = conform.update_where(orders, F.col("o_orderstatus") == "P", changes)
    return updated.select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _nations(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = (
        table(spark, folder, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    )
    return customers, suppliers


@query(
    """
    SELECT c_nationkey AS nation FROM customer
    UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
    """
)
def set_union_distinct(spark, folder):
    return sets.union_distinct(*_nations(spark, folder))


@query(
    """
    SELECT c_nationkey AS nation FROM customer
    EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
    """
)
def set_difference(spark, folder):
    return sets.difference(*_nations(spark, folder))


@query(
    """
    SELECT c_nationkey AS nation FROM customer
    EXCEPT ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
    """
)
def set_difference_all(spark, folder):
    return sets.difference(*_nations(spark, folder), keep_copies=True)


@query(
    """
    SELECT c_nationkey AS nation FROM customer
    INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
    """
)
def set_intersection(spark, folder):
    return sets.intersection(*_nations(spark, folder))


@query(
    """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
    UNION ALL SELECT p_name, p_retailprice, p_type FROM part
    """
)
def stacked_tables(spark, folder):
    customer = table(spark, folder, "customer").selectExpr(
        "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    supplier = table(spark, folder, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name")
    part = table(spark, folder, "part").toDF("key", "name", "brand", "segment", "size", "balance")
    return sets.stack_all([customer, supplier, part.drop("key", "brand", "size")], fill_missing=True)


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def top_orders(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER_COLUMNS)
    return ranking.first_rows(orders, [], [F.col("o_totalprice").desc(), "o_orderkey"], 10)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 25
    """
)
def limit_offset(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER_COLUMNS)
    return ranking.page(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 25, 100)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, (SELECT count(*) FROM orders) AS total_rows
    FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 40
    """
)
def page_with_total(spark, folder):
    orders = table(spark, folder, "orders").select(*_ORDER_COLUMNS)
    return ranking.page_with_total(orders, ["o_orderkey"], 40, 20)


@query("SELECT DISTINCT p_size FROM part ORDER BY p_size DESC LIMIT 3")
def largest_distinct(spark, folder):
    return ranking.largest_distinct(table(spark, folder, "part"), "p_size", 3)


@query(
    """
    WITH t AS (SELECT o_custkey AS custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
               FROM orders GROUP BY o_custkey)
    (SELECT custkey, spent, 'top' AS "end" FROM t ORDER BY spent DESC, custkey DESC LIMIT 5)
    UNION ALL (SELECT custkey, spent, 'bottom' FROM t ORDER BY spent, custkey LIMIT 5)
    """
)
def top5_bottom5(spark, folder):
    spent = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(total("o_totalprice").alias("spent"))
    )
    return ranking.ends(spent, ["spent", "custkey"], 5)


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderstatus, count(*) AS orders
    FROM orders GROUP BY 1, 2 ORDER BY order_day, o_orderstatus DESC
    """
)
def sorted_day_status(spark, folder):
    return (
        table(spark, folder, "orders")
        .groupBy(day_text("o_orderdate").alias("order_day"), "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("order_day", F.col("o_orderstatus").desc())
    )
