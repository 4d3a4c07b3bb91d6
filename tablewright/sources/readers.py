"""Reading files and tables. Only JSON without a schema is scanned once to infer it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def inline(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A small table typed out in code; missing dict keys become NULL."""
    typed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    ready = [tuple(r.get(n) for n in typed.names) if isinstance(r, Mapping) else r for r in rows]
    return spark.createDataFrame(ready, typed)


def empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)


def number_range(spark: SparkSession, start: int, end: int, step: int = 1, name: str = "id") -> DataFrame:
    return spark.range(start, end, step).toDF(name)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    separator: str = ",",
    mode: str = "PERMISSIVE",
    **options,
) -> DataFrame:
    """CSV or TSV; without a schema every column is text."""
    reader = spark.read.options(header=header, sep=separator, mode=mode, **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    document: bool = False,
    mode: str = "PERMISSIVE",
    **options,
) -> DataFrame:
    """JSON lines, or one document per file (which a single task must read).

    Fields outside the schema are dropped. Without a schema one more pass over the text infers it
    (columns in order of name, whole numbers as bigint).
    """
    reader = spark.read.options(multiLine=document, mode=mode, **options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_csv_below(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, skip: int, **options
) -> DataFrame:
    """CSV without the first ``skip`` lines of every file.

    The skipped lines lie in a file's first split, whose lines are numbered in order; only ``skip``
    rows per file are kept to find where the data begins. A record is one line.
    """
    parts = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__line"),
    )
    first = Window.partitionBy("__file").orderBy("__line")
    heads = parts.filter("__block = 0").select("__file", "__line", F.row_number().over(first).alias("__n"))
    heads = heads.filter(F.col("__n") <= skip).groupBy("__file").agg(F.max("__line").alias("__last"))
    below = parts.join(heads, "__file", "left").filter("__block > 0 OR __last IS NULL OR __line > __last")
    ddl = schema.simpleString() if isinstance(schema, StructType) else schema
    return below.select(F.from_csv("value", ddl, dict(options)).alias("__row")).select("__row.*")


def read_text(spark: SparkSession, path: str | Sequence[str], name: str = "value", whole: bool = False) -> DataFrame:
    """Lines of text, or whole files."""
    return spark.read.text(path, wholetext=whole).toDF(name)


def read_columnar(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet or ORC. An imposed schema must fit the stored types."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return df.select(*columns) if columns else df


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("rowTag", row_tag).xml(path)


def read_tree(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, pattern: str | None = None
) -> DataFrame:
    """All files below a folder, optionally only those whose name fits ``pattern``."""
    reader = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def read_database(
    spark: SparkSession,
    url: str,
    query_table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A JDBC table read in ranges of a numeric column; filters are pushed down."""
    return spark.read.jdbc(
        url,
        query_table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def without_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every listed column (all columns by default)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)
