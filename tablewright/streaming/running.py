"""Sources, sinks and restartable runs of streaming queries."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablewright.operators.common import any_of
from tablewright.operators.history import scd2_merge, upsert
from tablewright.sinks.layout import held
from tablewright.sinks.writers import write_files


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files below a folder, or one named file or folder, as a stream."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern that fits just this name lets a single file be a source too.
    return reader.load(f"{parent}/{{{name}}}" if re.search(r"\.\w+$", name) else path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Messages of a Kafka topic; needs Spark's Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting})
        .load()
    )


def run_to_files(
    df: DataFrame, folder: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append finished rows to files; what is there is processed once, or ``every`` so often.

    The checkpoint lies beside the output, so a new start goes on where the last stopped.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .start(f"{folder}/rows")
    )


def finished(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, over the kept progress."""
    return sum(
        int(op["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


class VersionedTable:
    """A table of which each micro-batch rewrites the pieces it touches, in two folders by turns.

    Rows are dealt to ``pieces`` pieces by a hash of their key. Batch n reads what batch n - 1 left
    of its pieces and writes them to the folder of the other turn; all other pieces stay as they
    are. A list of the turn of every piece is kept for the last two batches, so a batch that is run
    again starts from the same rows and a restart neither loses nor doubles changes. A one-row
    marker names the last whole version. A key, once there, must keep a row.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType | str, pieces: int = 64):
        self.spark = spark
        self.folder = folder
        self.schema = schema
        self.pieces = pieces

    def _piece(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.pieces)).cast("int")

    def touched(self, changes: DataFrame, keys: Sequence[str]) -> list[int]:
        """The pieces that hold the keys of ``changes``: ``pieces`` numbers at the most."""
        return sorted(row[0] for row in changes.select(self._piece(keys)).distinct().collect())

    def _turns(self, version: int) -> dict[int, int]:
        if version < 0:
            return {}
        kept = self.spark.read.schema("piece int, turn int").parquet(f"{self.folder}/turns/{version % 2}")
        return dict(kept.collect())

    def at(self, version: int, pieces: Sequence[int] | None = None) -> DataFrame:
        """Version ``version``, the last or the one before it, or some pieces of it."""
        turns = self._turns(version)
        wanted = [piece for piece in turns if pieces is None or piece in set(pieces)]
        empty = self.spark.createDataFrame([], self.schema)
        if not wanted:
            return empty
        here = [
            (F.col("__turn") == turn) & F.col("__piece").isin([p for p in wanted if turns[p] == turn])
            for turn in sorted({turns[p] for p in wanted})
        ]
        rows = self.spark.read.schema(empty.schema).parquet(f"{self.folder}/rows")
        return rows.filter(any_of(here)).select(*empty.columns)

    def put(self, version: int, df: DataFrame, keys: Sequence[str], pieces: Sequence[int]) -> None:
        """``df`` in the place of the listed pieces; it holds all their rows and no others."""
        turns = self._turns(version - 1)
        fresh = {piece: 1 - turns.get(piece, 1) for piece in pieces}
        ones = [piece for piece, turn in fresh.items() if turn]
        turn = self._piece(keys).isin(ones).cast("int") if ones else F.lit(0)
        placed = df.withColumns({"__turn": turn, "__piece": self._piece(keys)}).hint("rebalance", "__piece")
        if pieces:
            write_files(placed, f"{self.folder}/rows", partition_by=["__turn", "__piece"], only_touched=True)
        kept = self.spark.createDataFrame(list((turns | fresh).items()), "piece int, turn int")
        write_files(kept, f"{self.folder}/turns/{version % 2}")
        write_files(self.spark.range(version, version + 1).toDF("version"), f"{self.folder}/last")

    def last(self) -> DataFrame:
        mark = self.spark.read.schema("version bigint").parquet(f"{self.folder}/last")
        return self.at(mark.first()["version"])


def run_each_batch(
    df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch, kept in memory while it is used, to ``handle``."""

    def once(batch: DataFrame, number: int) -> None:
        kept = held(batch)
        try:
            handle(kept, number)
        finally:
            kept.unpersist()

    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(once)
        .start()
    )


def upsert_stream(
    df: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    keys: Sequence[str],
    pick: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Fold micro-batches into a table, one row per key.

    ``pick`` chooses one row per key among the saved and the new rows, for example
    the latest; without it new rows replace saved ones.
    """

    def handle(batch: DataFrame, number: int) -> None:
        pieces = table.touched(batch, keys)
        saved = table.at(number - 1, pieces)
        if pick is None:
            merged = upsert(saved, batch, keys)
        else:
            merged = pick(saved.unionByName(batch.select(*saved.columns)))
        table.put(number, merged, keys, pieces)

    return run_each_batch(df, checkpoint, handle, mode)


def history_stream(
    df: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    day_of: Callable[[DataFrame], str],
    latest: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Fold micro-batches into a type-2 history; ``day_of`` dates a batch."""

    def handle(batch: DataFrame, number: int) -> None:
        incoming = latest(batch).select(*keys, *tracked)
        pieces = table.touched(batch, keys)
        merged = scd2_merge(table.at(number - 1, pieces), incoming, keys, tracked, day_of(batch))
        table.put(number, merged, keys, pieces)

    return run_each_batch(df, checkpoint, handle)

