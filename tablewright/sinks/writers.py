"""Writing files and tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.common import all_of, any_of
from tablewright.operators.history import merge_totals
from tablewright.session import settings

def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records: int | None = None,
    only_touched: bool = False,
    **options,
) -> None:
    """Files in any installed format, optionally in key=value folders.

    ``max_records`` limits a file, ``only_touched`` replaces just the partitions
    that occur in ``df``.
    """
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def export_partitioned(
    df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], max_records: int
) -> None:
    """Partitioned export with a cap on the rows of a file.

    Rows are first gathered by partition; the rebalance lets a heavy partition be
    written by several tasks and light ones share a task.
    """
    gathered = df.hint("rebalance", *partition_by)
    write_files(gathered, path, fmt, partition_by=partition_by, max_records=max_records)


def write_single_file(df: DataFrame, path: str, fmt: str = "csv", **options) -> None:
    """One file, which one task writes: for results that the caller knows to be small."""
    write_files(df.coalesce(1), path, fmt, **options)


def write_with_manifest(df: DataFrame, path: str, schema: str, fmt: str = "parquet", **options) -> DataFrame:
    """Write, then list the files with their rows and bytes."""
    write_files(df, path, fmt, **options)
    back = df.sparkSession.read.format(fmt).schema(schema).load(path)
    return back.groupBy(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))


def compact(spark: SparkSession, source: str, target: str, fmt: str, schema, file_mb: int = 256) -> None:
    """Rewrite many small files as few of about ``file_mb`` megabytes each.

    The split size of the read decides the tasks, and so the files; no shuffle. Neither the
    cost of opening a file nor the number of cores may make the splits smaller.
    """
    size = {
        "spark.sql.files.maxPartitionBytes": f"{file_mb}m",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    with settings(spark, size):
        write_files(spark.read.format(fmt).schema(schema).load(source), target, fmt)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    spark.catalog.setCurrentDatabase(name)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A catalog table, optionally bucketed and sorted on the bucket columns."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def table_like(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """An empty table with the columns of ``df``."""
    return save_table(df.limit(0), name, path=path)


def insert_rows(df: DataFrame, name: str) -> None:
    """Append by column name."""
    target = df.sparkSession.table(name)
    df.select(*target.columns).write.insertInto(name)


def replace_rows(df: DataFrame, name: str, scratch: str) -> None:
    """Put ``df``, which may read the table itself, in the place of its rows."""
    spark = df.sparkSession
    df.write.parquet(scratch)
    spark.read.schema(df.schema).parquet(scratch).write.insertInto(name, overwrite=True)


def change_partitions(
    spark: SparkSession, name: str, partition_by: Sequence[str], touched: Column, change: Callable[[DataFrame], DataFrame]
) -> int:
    """Change rows of a partitioned table by rewriting only the partitions that hold a ``touched`` row.

    ``change`` gets the rows of these partitions and returns what shall be there; it leaves the
    partition columns as they are. They are written once, to the side, and moved into place when the
    write is done. A partition without rows left is dropped. Returns how many were touched.
    """
    held = spark.table(name)
    hit = held.filter(touched).select(*partition_by).distinct().collect()
    if not hit:
        return 0
    same = any_of([all_of([F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by]) for row in hit])
    rows = change(held.filter(same)).select(*held.columns)
    left = {tuple(row) for row in rows.select(*partition_by).distinct().collect()}
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows.write.insertInto(name, overwrite=True)
    for row in hit:
        if tuple(row) not in left:
            spec = ", ".join(f"{c} = {'NULL' if row[c] is None else repr(row[c])}" for c in partition_by)
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")
    return len(hit)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def analyze(spark: SparkSession, name: str) -> None:
    """Row and column statistics, which join planning uses."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def has_partition(spark: SparkSession, name: str, **values) -> bool:
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    return not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").isEmpty()


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def make_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A view kept in the catalog; it may read catalog tables, not temporary views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def rename_table(spark: SparkSession, name: str, new: str) -> DataFrame:
    spark.sql(f"ALTER TABLE {name} RENAME TO {new}")
    return spark.table(new)


def partition_list(spark: SparkSession, name: str) -> DataFrame:
    """``key=value`` of every partition."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def refresh(
    name: str,
    query_df: DataFrame,
    mode: str = "complete",
    keys: Sequence[str] = (),
    sums: Sequence[str] = (),
    scratch: str | None = None,
    path: str | None = None,
) -> None:
    """Rebuild a materialised result, or add the totals of new rows to it."""
    spark = query_df.sparkSession
    if mode == "complete" or not spark.catalog.tableExists(name):
        save_table(query_df, name, path=path)
    elif mode == "incremental":
        if scratch is None:
            raise ValueError("an incremental refresh needs a scratch folder")
        saved = spark.table(name)
        replace_rows(merge_totals(saved, query_df, keys, sums).select(*saved.columns), name, scratch)
    else:
        raise ValueError("mode is complete or incremental")
