"""Small everyday operations: trimming, element access, table functions, load limits, views, layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import history
from tablewright.plans.registry import query, table
from tablewright.session import run_folder
from tablewright.sinks import layout, writers
from tablewright.sources import quality, readers


def _name(place: str, label: str) -> str:
    return f"{label}_{place.rsplit('-', 1)[1]}"


@query(
    """
    SELECT p_partkey, p_name || '  |' AS left_cut, '|  ' || p_name AS right_cut, p_name AS both_cut,
           upper(p_brand) AS large, lower(p_brand) AS small, length(p_name)::INTEGER AS size,
           substr(p_name, 2, 3) AS middle, replace(p_name, ' ', '_') AS joined FROM part
    """
)
def trimmed_texts(spark, folder):
    padded = F.concat(F.lit("  "), "p_name", F.lit("  "))
    return table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.ltrim(padded), F.lit("|")).alias("left_cut"),
        F.concat(F.lit("|"), F.rtrim(padded)).alias("right_cut"),
        F.trim(padded).alias("both_cut"),
        F.upper("p_brand").alias("large"),
        F.lower("p_brand").alias("small"),
        F.char_length("p_name").alias("size"),
        F.substring("p_name", 2, 3).alias("middle"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("joined"),
    )


@query(
    """
    SELECT event_id, floor(epoch_us(ts) / 1000000)::BIGINT AS seconds,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS written FROM events
    """
)
def time_from_unix(spark, folder):
    """Unix seconds and back, without a time zone in between."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", epoch, F.col("ts"))
    back = F.timestamp_add("SECOND", F.col("seconds"), epoch)
    return (
        table(spark, folder, "events")
        .select("event_id", seconds.alias("seconds"))
        .withColumn("written", F.date_format(back, "yyyy-MM-dd HH:mm:ss"))
    )


@query(
    """
    SELECT p_partkey, p_brand AS by_key, NULL::VARCHAR AS no_key, string_split(p_name, ' ')[1] AS first_word,
           string_split(p_name, ' ')[9] AS ninth_word, p_type AS field FROM part
    """
)
def element_access(spark, folder):
    """A map by key, an array by place, a struct by field; what is not there is NULL."""
    packed = table(spark, folder, "part").select(
        "p_partkey",
        F.create_map(F.lit("brand"), "p_brand", F.lit("name"), "p_name").alias("m"),
        F.split("p_name", " ").alias("a"),
        F.struct(F.col("p_type").alias("kind")).alias("s"),
    )
    return packed.select(
        "p_partkey",
        F.col("m")["brand"].alias("by_key"),
        F.col("m")["colour"].alias("no_key"),
        F.get("a", F.lit(0)).alias("first_word"),
        F.get("a", F.lit(8)).alias("ninth_word"),
        F.col("s.kind").alias("field"),
    )


@query(
    """
    SELECT p_partkey, word, 'brand' AS field, p_brand AS value
    FROM (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM part)
    UNION ALL
    SELECT p_partkey, word, 'type', p_type FROM (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM part)
    """
)
def built_in_table_functions(spark, folder):
    """``explode`` and ``stack`` as lateral table functions in SQL."""
    return spark.sql(
        """
        SELECT p_partkey, word, field, value FROM {part}
        LATERAL VIEW explode(split(p_name, ' ')) AS word
        LATERAL VIEW stack(2, 'brand', p_brand, 'type', p_type) AS field, value
        """,
        part=table(spark, folder, "part"),
    )


@query("SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey::BIGINT AS c_nationkey FROM customer")
def json_lines_inferred(spark, folder):
    place = run_folder(spark, "json")
    writers.write_files(table(spark, folder, "customer"), place, "json")
    return readers.read_json(spark, place)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def json_documents(spark, folder):
    """Files of one document each, of many lines: the orders of a stretch of keys with their lines.

    An order has few lines and a stretch two hundred keys, so a document is bounded.
    """
    place = run_folder(spark, "documents")
    line = F.struct("l_linenumber", "l_partkey", "l_quantity")
    orders = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    stretch = F.floor(F.col("l_orderkey") / 200).alias("stretch")
    held = orders.groupBy(stretch).agg(F.collect_list(F.struct("l_orderkey", "lines")).alias("orders"))
    pretty = F.to_json(F.struct("stretch", "orders"), {"pretty": "true"}).alias("value")
    writers.write_files(held.select(pretty), place, "text", max_records=1)
    schema = (
        "stretch bigint, orders array<struct<l_orderkey: bigint, "
        "lines: array<struct<l_linenumber: int, l_partkey: bigint, l_quantity: double>>>>"
    )
    read = readers.read_json(spark, place, schema, document=True).select(F.inline("orders"))
    return read.select("l_orderkey", F.inline("lines"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def skipped_header_lines(spark, folder):
    """Every file begins with three lines that hold no data; as many files as the rows ask for."""
    place = run_folder(spark, "headers")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    n = max(4, orders.count() // 1_000_000)
    file = (F.col("o_orderkey") % n).cast("int").alias("file")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value")
    tops = F.array(*map(F.lit, ("made by", "-1,X", "o_orderkey,o_orderstatus")))
    top = spark.range(n).select(F.col("id").cast("int").alias("file"), F.posexplode(tops).alias("place", "value"))
    body = orders.select(file, F.lit(3).alias("place"), line)
    # a partition is a file, and the heading has to be at its top
    files = top.unionByName(body).repartitionById(n, F.col("file")).sortWithinPartitions("place").select("value")
    writers.write_files(files, place, "text")
    return readers.read_csv_below(spark, place, "o_orderkey bigint, o_orderstatus string", skip=3)


@query(
    """
    SELECT 'clean' AS source, 'success' AS strict, count(*) AS loaded FROM orders WHERE o_orderkey % 10 <> 4
    UNION ALL SELECT 'dirty', 'load_failed', NULL FROM orders HAVING count(*) FILTER (o_orderkey % 10 = 4) > 0
    """
)
def strict_loads(spark, folder):
    """A strict read of a clean and of a dirty file, and a load that allows no reject."""
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    line = F.concat_ws(",", F.when(key % 10 == 4, "none").otherwise(key.cast("string")), "o_orderstatus")
    schema = "id bigint, status string"
    found = []
    for source, rows in (("clean", orders.filter(key % 10 != 4)), ("dirty", orders)):
        place = run_folder(spark, source)
        writers.write_files(rows.select(line.alias("value")), place, "text")
        status = quality.strict_load(spark, place, "csv", schema)
        try:
            loaded = quality.load_with_limits(spark, place, schema, max_rejects=0, header=False).count()
        except quality.TooManyRejects:
            loaded = None
        found.append((source, status, loaded))
    return readers.inline(spark, found, "source string, strict string, loaded bigint")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0")
def complete_rows_of_file(spark, folder):
    """Empty fields of a file are NULL; such rows stay behind."""
    place = run_folder(spark, "nulls")
    status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus")
    writers.write_files(table(spark, folder, "orders").select("o_orderkey", status), place, "csv", header=True)
    return readers.without_nulls(readers.read_csv(spark, place, "o_orderkey bigint, o_orderstatus string"))


@query(
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers,
           true AS within_cap FROM orders GROUP BY 1, 2
    """
)
def exported_folders(spark, folder):
    """Every folder of a partitioned export, read back, and the cap on the rows of a file."""
    place = run_folder(spark, "exported")
    parts = ["o_orderstatus", "o_orderpriority"]
    cap = 1000
    writers.export_partitioned(table(spark, folder, "orders").select("o_custkey", *parts), place, "json", parts, cap)
    back = readers.read_json(spark, place, "o_custkey bigint, o_orderstatus string, o_orderpriority string")
    files = back.groupBy(*parts, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_custkey").alias("keys")
    )
    return files.groupBy(*parts).agg(
        F.sum("rows").alias("orders"), F.sum("keys").alias("customers"), (F.max("rows") <= cap).alias("within_cap")
    )


@query("SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition FROM orders")
def listed_partitions(spark, folder):
    place = run_folder(spark, "listed")
    name = _name(place, "listed")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    writers.save_table(orders, name, path=f"{place}/table", partition_by=["o_orderstatus"])
    return writers.partition_list(spark, name)


@query("SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def view_of_renamed_table(spark, folder):
    """A table saved, renamed, and read through a view kept in the catalog."""
    place = run_folder(spark, "view")
    old, new = _name(place, "before"), _name(place, "after")
    writers.save_table(table(spark, folder, "customer").select("c_mktsegment", "c_acctbal"), old, path=f"{place}/table")
    writers.rename_table(spark, old, new)
    view = writers.make_view(spark, _name(place, "rich"), f"SELECT * FROM {new} WHERE c_acctbal > 0")
    return view.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "SELECT o_custkey, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, 1::BIGINT AS partitions"
    " FROM orders GROUP BY 1"
)
def sorted_inside_partitions(spark, folder):
    """A customer's orders lie in one partition, in order of their key."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    placed = layout.sorted_inside(orders, ["o_custkey"], ["o_custkey", "o_orderkey"]).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    return placed.groupBy("o_custkey").agg(
        F.min_by("o_orderkey", "place").alias("first_key"),
        F.max_by("o_orderkey", "place").alias("last_key"),
        F.count_distinct("part").alias("partitions"),
    )


@query("SELECT l_partkey % 97 AS rest, count(*) AS lines, 1::BIGINT AS partitions FROM lineitem GROUP BY 1")
def spread_by_own_rule(spark, folder):
    """Rows dealt by a rule of one's own: equal values share a partition."""
    rest = F.col("l_partkey") % 97
    dealt = layout.spread_by_rule(table(spark, folder, "lineitem").select("l_partkey"), rest)
    return dealt.select(rest.alias("rest"), F.spark_partition_id().alias("part")).groupBy("rest").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("part").alias("partitions")
    )


@query("SELECT count(*) AS rows, true AS gathered FROM lineitem")
def gathered_partitions(spark, folder):
    """Many partitions put together without a shuffle; no row is lost."""
    lines = table(spark, folder, "lineitem").select("l_orderkey")
    n = max(16, lines.count() // 250_000)
    few = layout.gathered(layout.spread(lines, n, ranged=True, by=["l_orderkey"]), n // 4)
    parts = few.select(F.spark_partition_id().alias("part"))
    return parts.agg(F.count(F.lit(1)).alias("rows"), (F.count_distinct("part") <= n // 4).alias("gathered"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def late_rows_at_the_mark(spark, folder):
    """Orders that came on the mark's own day after it was taken are folded in, not lost."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    mark = F.lit("1999-06-15 00:00:00").cast("timestamp_ntz")
    early = F.col("o_orderdate") < mark
    saved = orders.filter(early | ((F.col("o_orderdate") == mark) & (F.col("o_orderkey") % 2 == 0)))
    fresh = history.incremental(orders, "o_orderdate", mark, inclusive=True)
    return history.upsert(saved, fresh, ["o_orderkey"]).drop("o_orderdate")
