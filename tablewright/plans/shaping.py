"""Queries on strings, dates, arrays, nested fields, texts and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import arrays, dates, numbers, strings, udfs
from tablewright.operators import graph, partitions, reshape, text
from tablewright.operators.common import day_text
from tablewright.plans.registry import query, table


@query(
    """
    SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type, length(p_name) AS chars,
           strlen(p_name || 'é') AS bytes, substr(p_name, 2, 3) AS middle, replace(p_name, ' ', '_') AS joined,
           concat_ws('-', p_brand, p_type) AS label, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded,
           rpad(p_type, 12, '.') AS right_padded, trim('  ' || p_name || ' ') AS trimmed, instr(p_name, 'r') AS first_r,
           split_part(p_name, ' ', 1) AS first_word, md5(p_name || '|' || p_brand) AS hash
    FROM part
    """
)
def string_parts(spark, folder):
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.upper(name).alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.char_length(name).cast("bigint").alias("chars"),
        F.octet_length(F.concat(name, F.lit("é"))).cast("bigint").alias("bytes"),
        F.substring(name, 2, 3).alias("middle"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("joined"),
        F.concat_ws("-", "p_brand", "p_type").alias("label"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.rpad("p_type", 12, ".").alias("right_padded"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.instr(name, "r").cast("bigint").alias("first_r"),
        F.split(name, " ")[0].alias("first_word"),
        strings.row_hash(["p_name", "p_brand"]).alias("hash"),
    )


@query(
    """
    WITH t AS (SELECT doc_id, text, string_split(text, ' ') AS w FROM documents)
    SELECT doc_id, CASE WHEN len(w) > 3 THEN length(w[1]) + length(w[2]) + length(w[3]) + 3 ELSE 0 END::BIGINT AS third_space,
           len(regexp_extract_all(text, '(the|th|en)'))::BIGINT AS codes
    FROM t
    """
)
def places_and_codes(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        strings.nth_index("text", " ", 3).cast("bigint").alias("third_space"),
        F.size(strings.codes_in("text", ["en", "th", "the"])).cast("bigint").alias("codes"),
    )


@query(
    """
    SELECT monthname(o_orderdate) AS name, month(o_orderdate)::INTEGER AS number, count(*) AS orders
    FROM orders GROUP BY 1, 2
    """
)
def month_names(spark, folder):
    """Month names written out and read back as numbers."""
    name = F.date_format("o_orderdate", "MMMM")
    return (
        table(spark, folder, "orders")
        .groupBy(name.alias("name"), strings.month_number(name).alias("number"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    """
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, quarter(o_orderdate)::INTEGER AS quarter,
           month(o_orderdate)::INTEGER AS month, dayname(o_orderdate) AS day_name,
           (dayofweek(o_orderdate) + 1)::INTEGER AS day_of_week,
           strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS plus_30, strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS minus_1,
           date_diff('day', CAST(o_orderdate AS DATE), DATE '2025-05-24')::INTEGER AS days,
           date_diff('year', CAST(o_orderdate AS DATE), DATE '2025-05-24')::INTEGER
             - CASE WHEN strftime(o_orderdate, '%m%d') > '0524' THEN 1 ELSE 0 END AS age,
           floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2025-05-24') / 365.25)::INTEGER AS age_by_days,
           (year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0) OR year(o_orderdate) % 400 = 0 AS leap,
           strftime(CAST(o_orderdate AS DATE) + CAST((7 - dayofweek(o_orderdate)) % 7 AS INTEGER), '%Y-%m-%d') AS sunday,
           strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key
    FROM orders
    """
)
def date_parts(spark, folder):
    at = F.col("o_orderdate")
    day = at.cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.year(at).alias("year"),
        F.quarter(at).alias("quarter"),
        F.month(at).alias("month"),
        F.date_format(at, "EEEE").alias("day_name"),
        F.dayofweek(at).alias("day_of_week"),
        day_text(F.date_add(day, 30)).alias("plus_30"),
        day_text(F.date_sub(day, 1)).alias("minus_1"),
        F.datediff(F.lit("2025-05-24").cast("date"), day).alias("days"),
        dates.age_years(day, "2025-05-24").alias("age"),
        dates.age_years_by_days(day, "2025-05-24").alias("age_by_days"),
        dates.is_leap_year(F.year(at)).alias("leap"),
        day_text(dates.next_sunday(day)).alias("sunday"),
        dates.date_key(F.date_format(at, "dd/MM/yyyy")).alias("date_key"),
    )


@query(
    """
    SELECT event_id, strftime(ts, '%d.%m.%Y %H:%M') AS written, strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS later,
           floor(epoch_us(ts) / 1000000)::BIGINT AS seconds,
           CAST((date_part('hour', ts)) AS VARCHAR) || strftime(ts, ':%M:%S') AS since_midnight,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS parsed
    FROM events
    """
)
def time_arithmetic(spark, folder):
    pattern = "yyyy-MM-dd HH:mm:ss"
    at = F.col("ts")
    parsed = F.try_to_timestamp(F.date_format(at, pattern), F.lit(pattern))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format(at, "dd.MM.yyyy HH:mm").alias("written"),
        F.date_format(at + F.expr("INTERVAL 90 MINUTES"), pattern).alias("later"),
        F.timestamp_diff("SECOND", epoch, at).alias("seconds"),
        dates.hours_minutes_seconds(F.date_trunc("day", at).cast("timestamp_ntz"), at).alias("since_midnight"),
        F.date_format(parsed, pattern).alias("parsed"),
    )


@query(
    """
    SELECT o_orderkey, floor(o_totalprice / 1000)::BIGINT AS thousands, o_orderkey % 7 AS rest,
           CASE WHEN o_orderkey = 0 THEN 0 ELSE 1 + (o_orderkey - 1) % 9 END::INTEGER AS root,
           round(CAST(o_custkey AS DOUBLE) / nullif(o_orderkey % 3, 0) * 100, 2) AS percent,
           CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 250000 THEN 'middle' ELSE 'high' END AS level
    FROM orders
    """
)
def number_parts(spark, folder):
    price = F.col("o_totalprice")
    level = F.when(price < 50000, "low").when(price < 250000, "middle").otherwise("high")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.floor(price / 1000).alias("thousands"),
        (F.col("o_orderkey") % 7).alias("rest"),
        numbers.digital_root("o_orderkey").alias("root"),
        numbers.percent_of("o_custkey", F.col("o_orderkey") % 3).alias("percent"),
        level.alias("level"),
    )


@query(
    """
    SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS events,
           count(DISTINCT user_id) AS users FROM events GROUP BY 1
    """
)
def props_from_json(spark, folder):
    parsed = F.from_json("props", "k int")["k"].alias("k")
    return table(spark, folder, "events").groupBy(parsed).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users")
    )


@query(
    """
    SELECT json_extract_string(props, '$.k') AS k, count(*) AS events FROM events GROUP BY 1
    """
)
def props_by_json_tuple(spark, folder):
    parsed = table(spark, folder, "events").select(F.json_tuple("props", "k").alias("k"))
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("events"))


@query(
    """
    SELECT p_partkey, p_brand AS department, word AS skill, p_type AS city FROM
      (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM part)
    """
)
def nested_struct_fields(spark, folder):
    """Parts packed into nested documents, then flattened again."""
    employee = F.struct(
        F.col("p_partkey").alias("id"),
        F.struct(F.col("p_brand").alias("name")).alias("department"),
        F.split("p_name", " ").alias("skills"),
        F.struct(F.col("p_type").alias("city")).alias("address"),
    )
    documents = table(spark, folder, "part").select(F.array(employee).alias("employees"))
    fields = {"p_partkey": "emp.id", "department": "emp.department.name", "skill": "skill", "city": "emp.address.city"}
    return reshape.flatten_nested(documents, [("employees", "emp"), ("emp.skills", "skill")], fields)


@query(
    """
    SELECT p_partkey, 'brand' AS field, p_brand AS value FROM part
    UNION ALL SELECT p_partkey, 'type', p_type FROM part UNION ALL SELECT p_partkey, 'name', p_name FROM part
    """
)
def map_and_stack(spark, folder):
    """A map built from columns, read by key, and exploded to rows."""
    made = F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type", F.lit("name"), "p_name")
    return table(spark, folder, "part").select("p_partkey", F.explode(made).alias("field", "value"))


@query(
    """
    SELECT s_suppkey, 'balance' AS measure, s_acctbal AS value FROM supplier
    UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier
    """
)
def columns_to_rows(spark, folder):
    wide = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation")
    )
    return reshape.long_from_wide(wide, ["s_suppkey"], ["balance", "nation"], "measure", "value")


_ITEMS = "SELECT *, string_split(p_name || '|' || p_brand || '|' || p_type || '|' || p_size || '|' || p_name, '|') AS w FROM part"


@query(
    f"""
    SELECT p_partkey, 0 AS record, w[1] AS a, w[2] AS b FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, 1, w[3], w[4] FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, 2, w[5], NULL FROM ({_ITEMS})
    """
)
def flatten_delimited(spark, folder):
    line = F.concat_ws("|", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"), "p_name")
    lines = table(spark, folder, "part").select("p_partkey", line.alias("raw"))
    return reshape.flatten_delimited(lines, "raw", r"\|", ["a", "b"], keep=["p_partkey"])


@query(
    f"""
    SELECT p_partkey, w[1] AS a, w[2] AS b, w[3] AS c FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, w[2], w[3], w[4] FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, w[3], w[4], w[5] FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, w[4], w[5], NULL FROM ({_ITEMS})
    UNION ALL SELECT p_partkey, w[5], NULL, NULL FROM ({_ITEMS})
    """
)
def shifted_slices(spark, folder):
    line = F.concat_ws("|", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"), "p_name")
    zipped = arrays.shifted_windows(F.split(line, r"\|"), ["a", "b", "c"])
    rows = table(spark, folder, "part").select("p_partkey", F.explode(zipped).alias("row"))
    return rows.select("p_partkey", "row.*")


@query(
    """
    SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1
    """
)
def word_count(spark, folder):
    return text.word_count(table(spark, folder, "documents"), "text")


@query(
    """
    SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
    """
)
def word_count_top(spark, folder):
    return text.top_words(table(spark, folder, "documents"), "text", 1)


@query(
    r"""
    SELECT word, count(*) AS count FROM
      (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM conversations) WHERE word <> '' GROUP BY 1
    """
)
def lower_case_word_count(spark, folder):
    return text.word_count(
        table(spark, folder, "conversations"), "text", lower=True, pattern=r"[^\p{L}]+", drop_empty=True
    )


@query(
    """
    WITH w AS (SELECT string_split(text, ' ') AS w FROM conversations),
         g AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS ngram FROM w)
    SELECT ngram, count(*) AS count FROM g GROUP BY 1
    """
)
def ngram_counts(spark, folder):
    return text.ngram_count(table(spark, folder, "conversations"), "text", 2)


@query(
    r"""
    WITH w AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM documents),
         s AS (SELECT word, array_to_string(list_sort(string_split(word, '')), '') AS signature FROM w WHERE word <> ''),
         n AS (SELECT signature, count(*) AS group_size FROM s GROUP BY 1 HAVING count(*) >= 2)
    SELECT word, signature, group_size FROM s JOIN n USING (signature)
    """
)
def anagram_groups(spark, folder):
    words = text.words_of(
        table(spark, folder, "documents"), "text", lower=True, pattern=r"[^\p{L}]+", drop_empty=True
    )
    return text.anagram_groups(words, "word")


@query(
    r"""
    WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
         r AS (SELECT doc_id, unnest(list_transform(range(0, CAST(ceil(len(l) / 3.0) AS BIGINT)),
                        lambda b: array_to_string(l[b * 3 + 1 : b * 3 + 3], ' '))) AS record FROM t)
    SELECT doc_id, count(*) AS records, sum(length(record))::BIGINT AS chars FROM r GROUP BY 1
    """
)
def merged_lines(spark, folder):
    """Every three lines of a document put into one record."""
    rows = table(spark, folder, "documents").select(
        "doc_id", F.explode(arrays.merged_lines("text", 3, " ")).alias("record")
    )
    return _record_sizes(rows)


@query(
    r"""
    WITH r AS (SELECT doc_id, unnest(string_split(replace(text, '.' || chr(10), ''), chr(10))) AS record FROM documents)
    SELECT doc_id, count(*) AS records, sum(length(record))::BIGINT AS chars FROM r GROUP BY 1
    """
)
def continued_lines(spark, folder):
    """Lines that end in a full stop run on into the next one."""
    rows = table(spark, folder, "documents").select(
        "doc_id", F.explode(arrays.continued_lines("text", ".")).alias("record")
    )
    return _record_sizes(rows)


def _record_sizes(rows):
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.char_length("record")).alias("chars")
    )


_SESSIONS = """
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'invalid_date'
                             ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS a,
           CASE WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
                ELSE strftime(o_orderdate + to_seconds(o_custkey), '%Y-%m-%d %H:%M:%S') END AS b,
           o_orderkey % 19 = 0 AS bad FROM orders
"""


@query(
    f"""
    SELECT id, CASE WHEN bad THEN 'corrupt record' WHEN a IS NULL THEN 'missing time'
                    WHEN a = 'invalid_date' THEN 'unparsable time' WHEN b < a THEN 'negative duration' END AS defect,
           CASE WHEN NOT bad AND b >= a AND a <> 'invalid_date'
                THEN date_diff('second', TRY_CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP)) END AS seconds
    FROM ({_SESSIONS})
    """
)
def validated_sessions(spark, folder):
    key, at, pattern = F.col("o_orderkey"), F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss"
    start = F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, "invalid_date").otherwise(F.date_format(at, pattern))
    later = at + F.make_dt_interval(secs=F.col("o_custkey"))
    earlier = at - F.expr("INTERVAL 1 HOUR")
    end = F.date_format(F.when(key % 17 == 0, earlier).otherwise(later), pattern)
    rows = table(spark, folder, "orders").select(
        key.alias("id"),
        F.struct(start.alias("start"), end.alias("end")).alias("session"),
        F.when(key % 19 == 0, "{").alias("_corrupt_record"),
    )
    checked = reshape.validate_sessions(rows, "session.start", "session.end", "_corrupt_record")
    return checked.select("id", "defect", "seconds")


@query(
    """
    WITH s AS (SELECT o_orderkey AS id, o_orderkey % 5 AS kind, epoch_us(o_orderdate) AS a,
                      epoch_us(o_orderdate) + o_custkey AS b FROM orders)
    SELECT id, CASE WHEN kind < 3 THEN b - a END AS duration,
           CASE kind WHEN 0 THEN 'out of order' WHEN 3 THEN 'incomplete' WHEN 4 THEN 'no events' ELSE 'ok' END AS state FROM s
    """
)
def session_event_checks(spark, folder):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = F.timestamp_diff("MICROSECOND", epoch, F.col("o_orderdate"))

    def event(kind, moment):
        return F.struct(F.lit(kind).alias("event_type"), moment.alias("timestamp"))

    start, end = event("start", at), event("end", at + F.col("o_custkey"))
    kind = F.col("o_orderkey") % 5
    events = (
        F.when(kind == 0, F.array(end, start))
        .when(kind == 3, F.array(start))
        .when(kind == 4, F.filter(F.array(start), lambda e: F.lit(False)))
        .otherwise(F.array(start, end))
    )
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), events.alias("events"))
    return reshape.session_event_checks(rows, "events").drop("events")


def _edges(spark, folder):
    """Suppliers point at the parts they deliver; part ids are moved out of the way."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("src"), (F.col("l_partkey") + 1000000000000).alias("dst")
    )


@query(
    """
    SELECT id, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, count(*) AS degree FROM
      (SELECT l_suppkey AS id, 0 AS i, 1 AS o FROM lineitem UNION ALL SELECT l_partkey + 1000000000000 , 1, 0 FROM lineitem) GROUP BY 1
    """
)
def supplier_part_degrees(spark, folder):
    return graph.degrees(_edges(spark, folder))


@query(
    """
    SELECT l_partkey + 1000000000000 AS id, count(*) AS deliveries, max(s_acctbal) AS richest
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1
    """
)
def neighbourhood_aggregate(spark, folder):
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS balance")
    measures = [F.count(F.lit(1)).alias("deliveries"), F.max("balance").alias("richest")]
    return graph.neighbour_aggregate(_edges(spark, folder), suppliers, measures)


def _trade(spark, folder):
    """Customers point at the suppliers they bought from."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("src"), (F.col("l_suppkey") + 1000000000000).alias("dst"))
        .distinct()
    )


_TRADE = """
    SELECT DISTINCT o_custkey AS src, l_suppkey + 1000000000000 AS dst
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


@query(
    f"""
    WITH e AS ({_TRADE}), f AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
         o AS (SELECT src, count(*) AS n FROM f GROUP BY 1),
         v AS (SELECT src AS id FROM o),
         r0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v),
         r1 AS (SELECT dst AS id, 0.15 + 0.85 * sum(rank / n) AS rank FROM f JOIN o USING (src) JOIN r0 ON r0.id = f.src GROUP BY 1),
         r2 AS (SELECT dst AS id, 0.15 + 0.85 * sum(rank / n) AS rank FROM f JOIN o USING (src) JOIN r1 ON r1.id = f.src GROUP BY 1),
         r3 AS (SELECT dst AS id, 0.15 + 0.85 * sum(rank / n) AS rank FROM f JOIN o USING (src) JOIN r2 ON r2.id = f.src GROUP BY 1)
    SELECT id, round(rank, 6) AS rank FROM r3
    """
)
def pagerank(spark, folder):
    """Three rounds over who bought from whom, taken both ways."""
    ranks = graph.pagerank(graph.both_ways(_trade(spark, folder)), 3)
    return ranks.withColumn("rank", F.round("rank", 6))


@query(
    f"""
    WITH RECURSIVE e AS ({_TRADE}), f AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
         walk AS (SELECT (SELECT min(src) FROM e) AS id, 0 AS hops
                  UNION SELECT dst, hops + 1 FROM walk JOIN f ON src = id WHERE hops < (SELECT count(*) FROM nation))
    SELECT id, min(hops) AS hops FROM walk GROUP BY 1
    """
)
def hop_distance(spark, folder):
    trade = _trade(spark, folder)
    start = trade.agg(F.min("src").alias("id"))
    return graph.hops(trade, start, directed=False)


_LINKS = """
    SELECT DISTINCT c_custkey AS src, c_custkey - c_custkey % 97 AS dst FROM customer
    UNION SELECT c_custkey, c_custkey + 97 FROM customer WHERE c_custkey % 97 = 5 AND c_nationkey < 12
"""


@query(
    f"""
    WITH RECURSIVE e AS ({_LINKS}), f AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
         v AS (SELECT DISTINCT src AS id FROM f),
         walk AS (SELECT id, id AS component FROM v UNION SELECT f.dst, w.component FROM walk w JOIN f ON f.src = w.id)
    SELECT id, min(component) AS component FROM walk GROUP BY 1
    """
)
def connected_components(spark, folder):
    """Customers linked to the first of their block, some blocks linked on."""
    key = F.col("c_custkey")
    link = F.when((key % 97 == 5) & (F.col("c_nationkey") < 12), key + 97)
    ends = F.array_compact(F.array(key - key % 97, link))
    edges = table(spark, folder, "customer").select(key.alias("src"), F.explode(ends).alias("dst"))
    return graph.connected_components(edges)



@query(
    """
    SELECT month(o_orderdate)::INTEGER AS month, count(*) AS orders FROM orders GROUP BY 1
    """
)
def month_by_registered_function(spark, folder):
    """A vectorized function called from SQL."""
    numbers_of = dict(zip(strings.MONTHS, range(1, 13)))
    udfs.register_vectorized(spark, "month_no", lambda names: names.str.lower().map(numbers_of), "int")
    orders = table(spark, folder, "orders")
    return spark.sql(
        """
        SELECT month_no(date_format(o_orderdate, 'MMMM')) AS month, count(*) AS orders
        FROM {orders} GROUP BY 1
        """,
        orders=orders,
    )


@query(
    """
    SELECT place::INTEGER AS place, count(*) AS words FROM
      (SELECT unnest(range(1, len(string_split(text, ' ')) + 1)) AS place FROM conversations) GROUP BY 1
    """
)
def words_by_table_function(spark, folder):
    """A table function of our own, called from SQL."""
    udfs.register_word_places(spark)
    conversations = table(spark, folder, "conversations")
    return spark.sql(
        """
        SELECT place, count(*) AS words FROM {texts}, LATERAL word_places(text) GROUP BY place
        """,
        texts=conversations,
    )


@query("SELECT count(*) AS rows, min(l_partkey) AS low, max(l_partkey) AS high FROM lineitem")
def partition_summaries(spark, folder):
    """Each partition summarised where it lies, then put together."""
    parts = partitions.summaries(table(spark, folder, "lineitem"), "l_partkey")
    return parts.agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
