"""Reading text formats with bad rows kept apart and counted."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.sets import stack_all
from tablewright.session import run_folder
from tablewright.sources.readers import CORRUPT

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_marked(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options
) -> DataFrame:
    """All rows, with the source text of a bad one in ``_corrupt_record``."""
    typed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if CORRUPT not in typed.names:
        typed = StructType([*typed.fields]).add(CORRUPT, "string")
    return (
        spark.read.format(fmt)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
        .schema(typed)
        .load(path)
    )


def _counted(marked: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows that are counted, valid, corrupt and all, by the write that they go through."""
    seen, bad = Observation(), F.col(CORRUPT).isNotNull()
    counts = F.count_if(~bad).alias("valid"), F.count_if(bad).alias("corrupt"), F.count(F.lit(1)).alias("total")
    return marked.observe(seen, *counts), seen


def counted_rows(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options
) -> dict[str, int]:
    """Valid, corrupt and all rows of a source, from one parse of whole rows; nothing is written.

    Reading with fewer columns would parse less and find fewer bad rows.
    """
    rows, seen = _counted(read_marked(spark, path, fmt, schema, **options))
    rows.write.format("noop").mode("overwrite").save()
    return dict(seen.get)


def read_with_quality(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid rows, corrupt rows and a report (status, count) of both.

    The source is parsed once: valid and corrupt rows are written to folders of their own in the shared folder and
    counted on the way, so the report reads nothing and valid rows are read without the others.
    """
    place = run_folder(spark, "parsed")
    marked = read_marked(spark, path, fmt, schema, **options)
    rows, seen = _counted(marked)
    rows.withColumn("__bad", F.col(CORRUPT).isNotNull()).write.partitionBy("__bad").parquet(place)
    kept = spark.read.schema(StructType([*marked.schema.fields]).add("__bad", "boolean")).parquet(place)
    valid = kept.filter(~F.col("__bad")).drop(CORRUPT, "__bad")
    return valid, kept.filter("__bad").drop("__bad"), quality_report(spark, seen.get)


def quality_report(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """(status, count) of valid, corrupt and all rows."""
    return spark.createDataFrame([(k, counts[k]) for k in ("valid", "corrupt", "total")], "status string, count bigint")


def strict_load(spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options) -> str:
    """``success`` or ``load_failed`` for a FAILFAST read of every row and column.

    Only a malformed row counts as a failed load; any other error is raised.
    """
    strict = spark.read.format(fmt).options(mode="FAILFAST", **options).schema(schema).load(path)
    try:
        strict.write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError) as error:
        if "MALFORMED_RECORD" not in str(error):
            raise
        return "load_failed"
    return "success"


def read_mode_report(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options
) -> DataFrame:
    """What each read mode gives: (mode, status, count).

    One permissive parse tells the rows DROPMALFORMED keeps and whether FAILFAST
    gets through, so the text is not read again for either.
    """
    counts = counted_rows(spark, path, fmt, schema, **options)
    valid, corrupt, total = counts["valid"], counts["corrupt"], counts["total"]
    lines = []
    for mode, whole in (("PERMISSIVE", (valid, corrupt, total)), ("DROPMALFORMED", (valid, 0, valid)), ("FAILFAST", (valid, 0, valid))):
        if mode == "FAILFAST" and corrupt:
            lines.append((mode, "load_failed", 0))
        else:
            lines += [(mode, status, n) for status, n in zip(("valid", "corrupt", "total"), whole)]
    return spark.createDataFrame(lines, "mode string, status string, count bigint")


class TooManyRejects(RuntimeError):
    """A load had more bad rows than allowed."""


def load_with_limits(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    max_rejects: int = 0,
    widths: Mapping[str, int] | None = None,
    replace_invalid: str | None = None,
    header: bool = True,
    **options,
) -> DataFrame:
    """CSV load that stops above ``max_rejects`` bad rows.

    ``widths`` cuts long texts, ``replace_invalid`` takes the place of characters
    that were not valid in the file's encoding. Compression follows the file name.
    """
    valid, _, report = read_with_quality(spark, path, "csv", schema, header=header, **options)
    rejects = report.filter("status = 'corrupt'").first()["count"]
    if rejects > max_rejects:
        raise TooManyRejects(f"{rejects} rows rejected, {max_rejects} allowed")
    texts = [f.name for f in valid.schema if f.dataType.simpleString() == "string"]
    if replace_invalid is not None:
        valid = valid.withColumns({c: F.replace(c, F.lit("�"), F.lit(replace_invalid)) for c in texts})
    return valid.withColumns({c: F.substring(c, 1, n) for c, n in (widths or {}).items()})


def combined_report(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Reports of several sources in one table, marked with the source."""
    return stack_all([r.withColumn("source", F.lit(name)) for name, r in reports.items()])
