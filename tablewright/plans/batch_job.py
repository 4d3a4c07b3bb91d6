"""A parameterised batch job: read, filter, lay out, write, with bounded retries.

    python -m tablewright.plans.batch_job --input-path IN --output-path OUT
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.session import build_session, settings
from tablewright.sinks.layout import balanced
from tablewright.sinks.writers import write_files
from tablewright.sources.readers import read_columnar

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchJob:
    input_path: str
    output_path: str
    schema: str
    condition: str = "true"
    columns: tuple[str, ...] = ("*",)
    partition_by: tuple[str, ...] = ()
    output_format: str = "parquet"
    target_mb: int = 256
    attempts: int = 3
    delay_seconds: float = 10
    settings: dict[str, str] = field(default_factory=dict)


def read(spark: SparkSession, job: BatchJob) -> DataFrame:
    return read_columnar(spark, job.input_path, schema=job.schema)


def transform(df: DataFrame, job: BatchJob) -> DataFrame:
    """The job's rows and columns; simple conditions reach the file scan."""
    return df.filter(job.condition).select(*job.columns)


def write(df: DataFrame, job: BatchJob) -> int:
    """Write the rows and return how many; they are counted on the way.

    The rebalance aims at ``target_mb`` per task from the shuffle's real sizes, so
    no counting pass is needed and a heavy date is split over several tasks.
    """
    counted = Observation("written")
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    size = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{job.target_mb}m"}
    with settings(df.sparkSession, size):
        write_files(
            balanced(rows, job.partition_by),
            job.output_path,
            job.output_format,
            partition_by=job.partition_by,
        )
    return counted.get["rows"]


def run_batch(spark: SparkSession, job: BatchJob) -> int:
    """Run the job; a failing run is tried again, a wrong plan or schema is not."""
    for attempt in range(1, job.attempts + 1):
        try:
            with settings(spark, job.settings):
                rows = write(transform(read(spark, job), job), job)
            logger.info("wrote %d rows to %s", rows, job.output_path)
            return rows
        except AnalysisException:
            raise
        except Exception:
            if attempt == job.attempts:
                raise
            logger.warning("attempt %d of %d failed", attempt, job.attempts, exc_info=True)
            time.sleep(job.delay_seconds)
    raise ValueError("attempts must be at least 1")


def parse(arguments: Sequence[str] | None = None) -> BatchJob:
    parser = argparse.ArgumentParser(description="Filter and partition one table")
    parser.add_argument("--input-path", required=True)
    parser.add_argument("--output-path", required=True)
    parser.add_argument("--schema", required=True)
    parser.add_argument("--condition", default="true")
    parser.add_argument("--columns", nargs="+", default=["*"])
    parser.add_argument("--partition-by", nargs="*", default=[])
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--target-mb", type=int, default=256)
    given = vars(parser.parse_args(arguments))
    lists = {name: tuple(given.pop(name)) for name in ("columns", "partition_by")}
    return BatchJob(**given, **lists)


def main(arguments: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    job = parse(arguments)
    spark = build_session("batch job", job.settings)
    try:
        run_batch(spark, job)
    except Exception:
        logger.exception("the job failed")
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
