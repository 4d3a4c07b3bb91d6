"""Bronze, silver and gold tables: raw text, typed and clean rows, and totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.aggregates import period_totals
from tablewright.operators.common import any_of, read_as
from tablewright.operators.conform import as_schema, nulls_from_tokens
from tablewright.sinks.writers import write_files
from tablewright.sources.readers import read_csv


def bronze(spark: SparkSession, source: str, target: str) -> DataFrame:
    """The source files as they are, every column text."""
    raw = read_csv(spark, source)
    write_files(raw, target)
    return spark.read.schema(raw.schema).parquet(target)


def silver(
    raw: DataFrame, schema: str, fills: Mapping[str, object]
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the raw rows in which a value could not be read."""
    known = nulls_from_tokens(raw)
    types = as_schema(schema)
    typed = {f.name: read_as(F.col(f.name), f.dataType) for f in types}
    bad = any_of([F.col(name).isNotNull() & value.isNull() for name, value in typed.items()])
    good = known.filter(~bad).select(*[value.alias(name) for name, value in typed.items()])
    return good.fillna(dict(fills)), known.filter(bad)


def gold(clean: DataFrame, at: str, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Monthly totals."""
    return period_totals(clean, at, F.col(value).cast("decimal(18,2)"), keys=keys)
