"""Window totals that late rows correct.

Spark drops rows that come behind the watermark. Here the watermark is kept beside the batches, and a row behind it goes to
a side table and into its window's total all the same: every window that was closed before and gets
late rows gives a correction, its old and its new total.

All output is written under the batch's number: sums of the batch per window, late rows, windows that
the batch closes, corrections, and the watermark after it. A batch that is run again replaces its own folders
and reads only those of earlier ones. Sums lie under the day of their window, so a batch reads
no more days than its rows, and the windows it closes, are in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tablewright.operators.common import join_null_safe
from tablewright.sinks.writers import write_files
from tablewright.streaming.running import run_each_batch

_MARK = "mark timestamp_ntz"
_ORIGIN = "1970-01-01 00:00:00"


def _moment(value: dt.datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


class CorrectedWindows:
    """Totals per tumbling window and keys, with late rows kept and corrected.

    ``sums`` names whole-number columns; ``rows`` counts. ``width`` divides a day. Times are taken
    without a zone. NULL is a key; rows without a time are left out.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schema: StructType | str, at: str,
        keys: Sequence[str], sums: Sequence[str], width: dt.timedelta, delay: dt.timedelta,
    ):
        self.spark, self.folder, self.at = spark, folder, at
        self.keys, self.sums, self.width, self.delay = list(keys), list(sums), width, delay
        made = spark.createDataFrame([], schema).withColumn(at, F.col(at).cast("timestamp_ntz"))
        self.schema = made.schema
        self.measures = ["rows", *self.sums]
        start = [StructField("start", self.schema[at].dataType), *[self.schema[k] for k in self.keys]]
        self.counted = StructType([*start, *[StructField(c, LongType()) for c in self.measures]])
        self.corrected = StructType(
            [*start, *[StructField(f"{when}_{c}", LongType()) for c in self.measures for when in ("old", "new")]]
        )

    def start(self) -> Column:
        """The start of a row's window."""
        seconds = int(self.width.total_seconds())
        origin = F.lit(_ORIGIN).cast("timestamp_ntz")
        since = F.timestamp_diff("SECOND", origin, F.col(self.at))
        return F.timestamp_add("SECOND", F.floor(since / seconds) * seconds, origin)

    def _end(self) -> Column:
        return F.timestamp_add("SECOND", F.lit(int(self.width.total_seconds())), F.col("start"))

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """``sums``, ``late``, ``closed`` or ``corrections`` of all batches, or those below a number."""
        kinds = {"sums": self.counted, "late": self.schema, "closed": self.counted, "corrections": self.corrected}
        schema = StructType(list(kinds[name].fields)).add("batch", "integer")
        if name == "sums":
            schema = schema.add("day", "date")
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        return rows if before is None else rows.filter(F.col("batch") < before)

    def mark(self, before: int) -> dt.datetime | None:
        """The watermark that the batches below a number leave; None if there is none yet."""
        if before == 0:
            return None
        marks = self.spark.read.schema(f"{_MARK}, batch int").parquet(f"{self.folder}/marks")
        return marks.filter(F.col("batch") < before).agg(F.max("mark")).first()[0]

    def _totals(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("start", *self.keys).agg(*[F.sum(c).alias(c) for c in self.measures])

    def fold(self, rows: DataFrame, batch: int) -> None:
        """Take in a batch of rows, which the caller keeps while it is used."""
        mark = self.mark(batch)
        rows = rows.withColumn(self.at, F.col(self.at).cast("timestamp_ntz")).filter(F.col(self.at).isNotNull())
        timed = rows.withColumn("start", self.start())
        behind = F.lit(False) if mark is None else self._end() <= _moment(mark)
        write_files(timed.filter(behind).select(*self.schema.names), f"{self.folder}/late/batch={batch}")
        fresh = timed.groupBy("start", *self.keys).agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(c).cast("bigint").alias(c) for c in self.sums]
        )
        fresh = fresh.withColumn("day", F.to_date("start"))
        write_files(fresh, f"{self.folder}/sums/batch={batch}", partition_by=["day"])
        self._correct(batch, behind)
        newest = rows.agg(F.max(self.at)).first()[0]
        after = mark if newest is None else max(mark or newest - self.delay, newest - self.delay)
        self._close(batch, mark, after)
        frame = self.spark.createDataFrame([(after,)], _MARK)
        write_files(frame, f"{self.folder}/marks/batch={batch}")

    def _correct(self, batch: int, behind: Column) -> None:
        """Old and new totals of the windows that were closed before the batch and have rows in it."""
        every = self.read("sums")
        changed = every.filter((F.col("batch") == batch) & behind)
        days = [r[0] for r in changed.select("day").distinct().collect()]
        old = self._totals(every.filter((F.col("batch") < batch) & F.col("day").isin(days)) if days else every.limit(0))
        named = old.withColumnsRenamed({c: f"old_{c}" for c in self.measures})
        both = join_null_safe(changed.select(*self.counted.names), named, ["start", *self.keys], "left")
        pairs = []
        for name in self.measures:
            old_, more = F.col(f"old_{name}"), F.col(name)
            old_ = F.coalesce(old_, F.lit(0).cast("bigint")) if name == "rows" else old_
            new = F.when(old_.isNull(), more).when(more.isNull(), old_).otherwise(old_ + more)
            pairs += [old_.alias(f"old_{name}"), new.alias(f"new_{name}")]
        write_files(both.select("start", *self.keys, *pairs), f"{self.folder}/corrections/batch={batch}")

    def _close(self, batch: int, mark: dt.datetime | None, after: dt.datetime | None) -> None:
        """The totals of the windows that the batch's watermark passes; only their days are read."""
        known = self.read("sums").filter(F.col("batch") <= batch)
        if after is None:
            known = known.limit(0)
        else:
            known = known.filter((F.col("day") <= F.lit(after.date())) & (self._end() <= _moment(after)))
        if mark is not None:
            first = (mark - self.width).date()
            known = known.filter((F.col("day") >= F.lit(first)) & (self._end() > _moment(mark)))
        write_files(self._totals(known).select(*self.counted.names), f"{self.folder}/closed/batch={batch}")

    def totals(self) -> DataFrame:
        """The totals of all closed windows, as they were at the close and with all corrections put in."""
        keys = ["start", *self.keys]
        closed = self.read("closed").select(*keys, "batch", F.struct(*self.measures).alias("total"))
        news = F.struct(*[F.col(f"new_{c}").alias(c) for c in self.measures])
        corrected = self.read("corrections").select(*keys, "batch", news.alias("total"))
        latest = closed.unionByName(corrected).groupBy(*keys).agg(F.max_by("total", "batch").alias("total"))
        return latest.select(*keys, "total.*")


def corrected_stream(df: DataFrame, windows: CorrectedWindows, checkpoint: str) -> StreamingQuery:
    """Fold every micro-batch into corrected windows."""
    return run_each_batch(df, checkpoint, windows.fold)
