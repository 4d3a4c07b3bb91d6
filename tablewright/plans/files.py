"""Queries that write a table to files or the catalog and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import conform, reshape
from tablewright.operators.common import money, total
from tablewright.plans import batch_job, layers
from tablewright.plans.registry import query, table
from tablewright.session import run_folder
from tablewright.sinks import writers
from tablewright.sources import quality, readers

_ORDERS = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), total("o_totalprice").alias("amount")
    )


_BY_STATUS = """
    SELECT o_orderstatus, count(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM orders GROUP BY 1
"""


@query(_BY_STATUS)
def csv_with_schema(spark, folder):
    place = run_folder(spark, "csv")
    writers.write_files(_orders(spark, folder), place, "csv", header=True)
    return _by_status(readers.read_csv(spark, place, _ORDERS))


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 100")
def csv_all_text(spark, folder):
    place = run_folder(spark, "text-csv")
    writers.write_files(_orders(spark, folder).drop("o_totalprice"), place, "csv", header=True)
    return readers.read_csv(spark, place).filter(F.col("o_orderkey").try_cast("bigint") > 100)


@query(_BY_STATUS)
def tab_separated(spark, folder):
    place = run_folder(spark, "tsv")
    writers.write_files(_orders(spark, folder), place, "csv", header=True, sep="\t", compression="gzip")
    return _by_status(readers.read_csv(spark, place, _ORDERS, separator="\t"))


@query(_BY_STATUS)
def orc_files(spark, folder):
    place = run_folder(spark, "orc")
    writers.write_files(_orders(spark, folder), place, "orc")
    return _by_status(readers.read_columnar(spark, place, "orc", _ORDERS))


@query(_BY_STATUS)
def xml_files(spark, folder):
    place = run_folder(spark, "xml")
    writers.write_files(_orders(spark, folder), place, "xml", rowTag="order")
    return _by_status(readers.read_xml(spark, place, "order", _ORDERS))


@query(
    """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer
    """
)
def json_lines_with_schema(spark, folder):
    """Missing fields come back as NULL and fields outside the schema are left out."""
    place = run_folder(spark, "json")
    customer = table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    )
    writers.write_files(customer, place, "json")
    return readers.read_json(spark, place, "c_custkey bigint, c_name string, c_mktsegment string")


def _dirty_lines(spark, folder):
    """Orders as CSV lines, some with a price that is no number."""
    key = F.col("o_orderkey")
    price = F.when(key % 10 == 4, "invalid_amount").otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", key.cast("string"), F.when(key % 7 == 0, "").otherwise(F.col("o_orderstatus")), price)
    return table(spark, folder, "orders").select(line.alias("value"))


def _dirty_folder(spark, folder):
    place = run_folder(spark, "dirty")
    writers.write_files(_dirty_lines(spark, folder), place, "text")
    return place


_DIRTY = "id int, status string, amount double"


@query(
    """
    SELECT mode, status, count::BIGINT AS count FROM (
      SELECT 'PERMISSIVE' AS mode, 'valid' AS status, count(*) FILTER (o_orderkey % 10 <> 4) AS count FROM orders
      UNION ALL SELECT 'PERMISSIVE', 'corrupt', count(*) FILTER (o_orderkey % 10 = 4) FROM orders
      UNION ALL SELECT 'PERMISSIVE', 'total', count(*) FROM orders
      UNION ALL SELECT 'DROPMALFORMED', 'valid', count(*) FILTER (o_orderkey % 10 <> 4) FROM orders
      UNION ALL SELECT 'DROPMALFORMED', 'corrupt', 0
      UNION ALL SELECT 'DROPMALFORMED', 'total', count(*) FILTER (o_orderkey % 10 <> 4) FROM orders
      UNION ALL SELECT 'FAILFAST', 'load_failed', 0)
    """
)
def read_mode_report(spark, folder):
    return quality.read_mode_report(spark, _dirty_folder(spark, folder), "csv", _DIRTY)


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status, o_totalprice AS amount
    FROM orders WHERE o_orderkey % 10 <> 4
    """
)
def valid_rows_of_dirty_file(spark, folder):
    return quality.read_with_quality(spark, _dirty_folder(spark, folder), "csv", _DIRTY)[0]


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderkey || ',' || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END
             || ',invalid_amount' AS source
    FROM orders WHERE o_orderkey % 10 = 4
    """
)
def corrupt_rows_of_dirty_file(spark, folder):
    _, corrupt, _ = quality.read_with_quality(spark, _dirty_folder(spark, folder), "csv", _DIRTY)
    return corrupt.select("id", F.col("_corrupt_record").alias("source"))


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS id, substr(o_orderpriority, 1, 4) AS priority FROM orders WHERE o_orderkey % 1000 <> 4
    """
)
def load_with_limits(spark, folder):
    """A load that tolerates a stated number of rejects and cuts long texts."""
    place = run_folder(spark, "limits")
    key = F.col("o_orderkey")
    line = F.concat_ws(
        ",", F.when(key % 1000 == 4, "none").otherwise(key.cast("string")), F.col("o_orderpriority")
    )
    writers.write_files(table(spark, folder, "orders").select(line.alias("value")), place, "text", compression="gzip")
    return quality.load_with_limits(
        spark, place, "id int, priority string", max_rejects=10**9, widths={"priority": 4}, header=False
    )


@query(
    """
    SELECT value, count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY 1
    """
)
def text_lines(spark, folder):
    place = run_folder(spark, "lines")
    lines = table(spark, folder, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    writers.write_files(lines, place, "text", lineSep="\n")
    back = spark.read.text(place, lineSep="\n")
    return back.groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
def partitioned_export(spark, folder):
    """JSON in key=value folders with a cap per file; the read prunes folders."""
    place = run_folder(spark, "partitioned")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    writers.export_partitioned(orders, place, "json", ["o_orderstatus", "o_orderpriority"], 10000)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"
    back = readers.read_json(spark, place, schema)
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    return back.filter(wanted).select("o_orderkey", "o_custkey")


@query(
    """
    SELECT o_orderstatus, count(*) AS orders,
           CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM orders GROUP BY 1
    """
)
def partition_overwrite(spark, folder):
    """Only the partitions that occur in the second write are replaced."""
    place = run_folder(spark, "overwrite")
    orders = _orders(spark, folder)
    writers.write_files(orders, place, partition_by=["o_orderstatus"])
    turned = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", -F.col("o_totalprice"))
    writers.write_files(turned, place, partition_by=["o_orderstatus"], only_touched=True)
    return _by_status(readers.read_columnar(spark, place, schema=_ORDERS))


@query(
    """
    SELECT count(*) AS rows, count(*) FILTER (o_orderkey < 0) AS inserted, count(*) FILTER (o_orderstatus = 'P') AS pending FROM
      (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders
         WHERE NOT o_totalprice < 1000
       UNION ALL SELECT -o_orderkey - 1, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)
    """
)
def table_changes(spark, folder):
    """Create like, insert, delete and update on a catalog table."""
    place = run_folder(spark, "changes")
    name = "orders_" + place.rsplit("-", 1)[1]
    orders = _orders(spark, folder)
    writers.table_like(orders, name, path=f"{place}/table")
    writers.insert_rows(orders, name)
    kept = conform.delete_where(spark.table(name), F.col("o_totalprice") < 1000)
    done = conform.update_where(kept, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("O")})
    writers.replace_rows(done, name, f"{place}/next")
    mirrored = orders.filter("o_orderkey % 2 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    writers.insert_rows(mirrored, name)
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("o_orderkey") < 0).alias("inserted"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pending"),
    )


@query(
    """
    SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '2-HIGH' AND o_totalprice < 50000)
    """
)
def changed_partitions(spark, folder):
    """Rows deleted and updated, and a whole partition emptied: only the touched partitions are written."""
    place = run_folder(spark, "partitions")
    name = "parts_" + place.rsplit("-", 1)[1]
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    by = ["o_orderpriority"]
    writers.save_table(rows.hint("rebalance", *by), name, path=f"{place}/table", partition_by=by)
    kind, price = F.col("o_orderpriority"), F.col("o_totalprice")
    gone = (kind == "5-LOW") | ((kind == "2-HIGH") & (price < 50000))
    writers.change_partitions(spark, name, by, gone, lambda df: conform.delete_where(df, gone))
    dear = (kind == "1-URGENT") & (price > 400000)
    writers.change_partitions(
        spark, name, by, dear, lambda df: conform.update_where(df, dear, {"o_orderstatus": F.lit("X")})
    )
    return spark.table(name).drop("o_totalprice")


@query("SELECT count(*) AS rows FROM orders")
def manifest_rows(spark, folder):
    listed = writers.write_with_manifest(_orders(spark, folder), run_folder(spark, "manifest"), _ORDERS)
    return listed.agg(F.sum("rows").alias("rows"))


@query(_BY_STATUS)
def compacted_files(spark, folder):
    """Many small files rewritten as few, then read."""
    place = run_folder(spark, "compact")
    writers.write_files(_orders(spark, folder), f"{place}/small", max_records=1000)
    writers.compact(spark, f"{place}/small", f"{place}/large", "parquet", _ORDERS)
    return _by_status(readers.read_columnar(spark, f"{place}/large", schema=_ORDERS))


@query(_BY_STATUS)
def folder_tree(spark, folder):
    """Files found below nested folders, by a name pattern."""
    place = run_folder(spark, "tree")
    orders = _orders(spark, folder)
    for label, condition in (("a/x", "o_orderkey % 2 = 0"), ("b", "o_orderkey % 2 = 1")):
        writers.write_files(orders.filter(condition), f"{place}/{label}")
    return _by_status(readers.read_tree(spark, place, "parquet", _ORDERS, pattern="*.parquet"))


@query(
    """
    SELECT CAST(p_partkey AS INTEGER) AS id, p_brand AS department, word AS skill
    FROM (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM part)
    """
)
def nested_json_files(spark, folder):
    place = run_folder(spark, "nested")
    packed = table(spark, folder, "part").select(
        F.array(
            F.struct(
                F.col("p_partkey").alias("id"),
                F.struct(F.col("p_brand").alias("name")).alias("department"),
                F.split("p_name", " ").alias("skills"),
            )
        ).alias("employees")
    )
    writers.write_files(packed, place, "json")
    schema = "employees array<struct<id: int, department: struct<name: string>, skills: array<string>>>"
    back = readers.read_json(spark, place, schema)
    fields = {"id": "emp.id", "department": "emp.department.name", "skill": "skill"}
    return reshape.flatten_nested(back, [("employees", "emp"), ("emp.skills", "skill")], fields)


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS date, count(*) AS rows,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)) - 200000) AS DOUBLE) AS amount
    FROM orders WHERE o_totalprice > 200000 AND o_orderkey % 6 <> 0 GROUP BY 1
    """
)
def batch_job_output(spark, folder):
    place = run_folder(spark, "job")
    key = F.col("o_orderkey")
    source = table(spark, folder, "orders").select(
        key.cast("int").alias("id"),
        F.col("o_orderpriority").alias("name"),
        (money("o_totalprice") - 200000).cast("double").alias("amount"),
        F.when(key % 6 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("date"),
    )
    writers.write_files(source, f"{place}/in")
    job = batch_job.BatchJob(
        f"{place}/in",
        f"{place}/out",
        schema="id int, name string, amount double, date string",
        condition="amount > 0 AND date IS NOT NULL",
        columns=("id", "amount", "date"),
        partition_by=("date",),
    )
    batch_job.run_batch(spark, job)
    back = readers.read_columnar(spark, f"{place}/out", schema="id int, amount double, date string")
    return back.groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), total("amount").alias("amount")
    )


@query(
    """
    SELECT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
           CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE o_orderstatus END AS status,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE o_orderkey % 10 <> 4 GROUP BY 1, 2, 3
    """
)
def layered_tables(spark, folder):
    """Raw text to typed rows to monthly totals; unreadable prices stay behind."""
    place = run_folder(spark, "layers")
    key = F.col("o_orderkey")
    source = table(spark, folder, "orders").select(
        key.alias("id"),
        F.when(key % 9 == 0, "NA").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(key % 10 == 4, "invalid_amount").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    writers.write_files(source, f"{place}/source", "csv", header=True)
    raw = layers.bronze(spark, f"{place}/source", f"{place}/bronze")
    clean, _ = layers.silver(raw, "id bigint, status string, amount double, day date", {"status": "unknown"})
    totals = layers.gold(clean, "day", "amount", ("status",))
    return totals.withColumn("total", F.col("total").cast("double"))
