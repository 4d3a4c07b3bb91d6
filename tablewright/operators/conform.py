"""Null handling, schema conformance, column changes and value rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from tablewright.functions.numbers import parity
from tablewright.operators.common import ColumnOrName, as_column, read_as

# Texts that stand for a missing value in the survey files.
NULL_TOKENS = ("", "NA", "NULL")


def as_schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def nulls_from_tokens(
    df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn placeholder texts of the string columns into NULL."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    picked = texts if columns is None else [c for c in texts if c in columns]
    return df.withColumns(
        {c: F.when(~F.trim(c).isin(list(tokens)), F.col(c)) for c in picked}
    )


def clean_table(
    df: DataFrame, fills: Mapping[str, object], null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """Placeholder texts become NULL, then NULLs are filled column by column."""
    return nulls_from_tokens(df, null_tokens).fillna(dict(fills))


def conform_schema(df: DataFrame, expected: StructType | str) -> DataFrame:
    """Exactly the expected columns, in order and type; a missing one is NULL."""
    kinds = dict(df.dtypes)

    def column(field: StructField) -> Column:
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType)
        if kinds[field.name] == field.dataType.simpleString():
            return F.col(field.name)
        return read_as(F.col(field.name), field.dataType, kinds[field.name])

    return df.select(*[column(f).alias(f.name) for f in as_schema(expected)])


def rescue_columns(
    df: DataFrame, expected: StructType | str, into: str = "_rescued_data"
) -> DataFrame:
    """Expected columns plus a map of the unexpected ones that hold a value."""
    schema = as_schema(expected)
    known = set(schema.names)
    extra = [c for c in df.columns if c not in known]
    if extra:
        pairs = [part for c in extra for part in (F.lit(c), F.col(c).cast("string"))]
        filled = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
        rescued = F.when(F.size(filled) > 0, filled)
    else:
        rescued = F.lit(None).cast("map<string,string>")
    texts = MapType(StringType(), StringType())
    return conform_schema(df.withColumn(into, rescued), StructType([*schema.fields]).add(into, texts))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def change_columns(
    df: DataFrame,
    *,
    add: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """The DataFrame form of ALTER TABLE: cast, add, drop, then rename columns."""
    changed = df.withColumns({c: F.col(c).cast(t) for c, t in (cast or {}).items()})
    changed = changed.withColumns(dict(add or {})).drop(*drop)
    return changed.withColumnsRenamed(dict(rename or {}))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that DELETE leaves: those for which the condition is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(
        {c: F.when(condition, new).otherwise(F.col(c)) for c, new in changes.items()}
    )


def made_negative(value: ColumnOrName) -> Column:
    """Positive values with their sign turned; negative ones as they are."""
    return -F.abs(as_column(value))


def value_group(value: ColumnOrName, groups: Mapping[str, Sequence], other: str) -> Column:
    """Map many values to the name of their group."""
    column = as_column(value)
    chosen = F.when(column.isNull(), F.lit(None).cast("string"))
    for name, members in groups.items():
        chosen = chosen.when(column.isin(list(members)), name)
    return chosen.otherwise(other)


def sample_bucket(df: DataFrame, keys: Sequence[str], buckets: int, bucket: int) -> DataFrame:
    """A repeatable sample: the rows whose key hashes to one of ``buckets``."""
    digits = F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8)
    return df.filter(F.conv(digits, 16, 10).cast("bigint") % buckets == bucket)


def parity_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(parity(column).alias("parity")).agg(F.count(F.lit(1)).alias("count"))
