"""A keyed table fed by change rows, deletes included.

A batch only appends its change rows, the latest of each key, under the batch's number, so a batch that is
run again replaces what it wrote before. Readers put the appended changes over the table and take the
row with the highest sequence per key; a key whose latest row is a deletion is gone. Compaction folds
the appended changes into the table: it rewrites only the pieces (by key hash) that hold a changed
key, into a folder of its own, and a manifest then names the folder of every piece. A folder's files hold many
pieces each, in their order, so there are as many files as the rows fill and a reader skips by the pieces'
bounds what it does not want. Files are never changed once written, and the manifest is written last, so a compaction that is cut short leaves the
table as it was. How many pieces there are follows from the rows of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablewright.operators.common import any_of
from tablewright.sinks.writers import write_files
from tablewright.streaming.running import run_each_batch

PIECE_ROWS = 1_000_000
SEQUENCE, DELETED = "__sequence", "__deleted"


def _one_of(name: str, numbers: Sequence[int]) -> Column:
    """True for the listed whole numbers; many of them are handed over as one text."""
    low, high = min(numbers), max(numbers)
    if high - low + 1 == len(set(numbers)):
        return F.col(name).between(low, high)
    return F.expr(f"{name} IN ({', '.join(map(str, sorted(numbers)))})")


class ChangedTable:
    """Rows by key in ``folder``: ``changes`` (appended batches), ``pieces`` (compacted) and manifests."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: StructType | str, keys: Sequence[str], piece_rows: int = PIECE_ROWS
    ):
        self.spark = spark
        self.folder = folder
        self.keys = list(keys)
        self.columns = spark.createDataFrame([], schema).schema
        self.piece_rows = piece_rows
        self.stored = StructType(list(self.columns.fields)).add(SEQUENCE, "long").add(DELETED, "boolean")

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row per key: that of the highest sequence. Combined inside tasks before the shuffle."""
        rest = [c for c in self.stored.names if c not in self.keys]
        newest = F.max_by(F.struct(*rest), F.struct(SEQUENCE, F.xxhash64(*rest))).alias("__row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "__row.*").select(*self.stored.names)

    def append(self, batch: int, rows: DataFrame, sequence: Column, deleted: Column) -> None:
        """Add a batch of changes; ``sequence`` orders the changes of a key, ``deleted`` marks tombstones.

        Of changes with one sequence any one is taken, always the same.
        """
        made = rows.withColumns({SEQUENCE: sequence.cast("bigint"), DELETED: F.coalesce(deleted, F.lit(False))})
        write_files(self.latest(made.select(*self.stored.names)), f"{self.folder}/changes/batch={batch}")

    def manifest(self) -> tuple[int, int, dict[int, str]]:
        """(last batch that is folded in, number of pieces, folder of every piece that has rows)."""
        version = self._version()
        if version is None:
            return -1, 1, {}
        rows = (
            self.spark.read.schema("upto bigint, pieces int, piece int, place string")
            .parquet(f"{self.folder}/manifests/version={version}")
            .collect()
        )
        return rows[0]["upto"], rows[0]["pieces"], {r["piece"]: r["place"] for r in rows if r["place"]}

    def _version(self) -> int | None:
        if not self._exists("versions"):
            return None
        kept = self.spark.read.schema("version bigint").parquet(f"{self.folder}/versions")
        return kept.agg(F.max("version")).first()[0]

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _changes(self, after: int) -> DataFrame:
        """Changes of the batches after number ``after``; the folder's name is read as a column."""
        if not self._exists("changes"):
            return self.spark.createDataFrame([], StructType(list(self.stored.fields)).add("batch", "integer"))
        rows = self.spark.read.schema(StructType(list(self.stored.fields)).add("batch", "integer")).parquet(f"{self.folder}/changes")
        return rows.filter(F.col("batch") > after)

    def _pieces(self, places: dict[int, str], wanted: Sequence[int] | None = None) -> DataFrame:
        """The compacted rows of some or all pieces, with their piece."""
        schema = StructType(list(self.stored.fields)).add("place", "string").add("piece", "integer")
        by_place: dict[str, list[int]] = {}
        chosen = set(places if wanted is None else wanted)
        for piece, place in places.items():
            if piece in chosen:
                by_place.setdefault(place, []).append(piece)
        if not by_place:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/pieces")
        return rows.filter(any_of([(F.col("place") == p) & _one_of("piece", n) for p, n in by_place.items()]))

    def _piece(self, pieces: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(pieces)).cast("int")

    def read(self, before: int | None = None) -> DataFrame:
        """The rows of the table, with all appended changes or those of batches below ``before``."""
        upto, _, places = self.manifest()
        if before is not None and before <= upto:
            raise ValueError("batches from that one on are folded in")
        changes = self._changes(upto)
        if before is not None:
            changes = changes.filter(F.col("batch") < before)
        names = self.stored.names
        rows = self._pieces(places).select(*names).unionByName(changes.select(*names))
        return self.latest(rows).filter(~F.col(DELETED)).select(*self.columns.names)

    def compact(self) -> list[int]:
        """Fold appended changes in; the pieces that were rewritten."""
        upto, pieces, places = self.manifest()
        changes = self._changes(upto)
        last = changes.agg(F.max("batch")).first()[0]
        if last is None:
            return []
        changes = changes.filter(F.col("batch") <= last).select(*self.stored.names)
        kept = self._pieces(places)
        # Grow by powers of two, so that a piece splits into whole pieces; all are written anew then.
        size, more = kept.count() + changes.count(), pieces
        while more * self.piece_rows < size:
            more *= 2
        if more != pieces:
            touched = list(range(more))
            old = kept
        else:
            touched = sorted(r[0] for r in changes.select(self._piece(pieces)).distinct().collect())
            old = self._pieces(places, touched)
        folded = self.latest(old.select(*self.stored.names).unionByName(changes)).filter(~F.col(DELETED))
        place = uuid.uuid4().hex
        placed = folded.withColumn("piece", self._piece(more)).hint("rebalance", "piece")
        write_files(placed.sortWithinPartitions("piece"), f"{self.folder}/pieces/place={place}")
        there = {r[0] for r in self._pieces(dict.fromkeys(touched, place)).select("piece").distinct().collect()}
        gone = set(touched)
        now = {piece: where for piece, where in places.items() if piece not in gone}
        now |= {piece: place for piece in touched if piece in there}
        self._publish(last, more, now)
        return touched

    def _publish(self, upto: int, pieces: int, places: dict[int, str]) -> None:
        last = self._version()
        version = 0 if last is None else last + 1
        rows = [(upto, pieces, piece, place) for piece, place in places.items()] or [(upto, pieces, None, None)]
        frame = self.spark.createDataFrame(rows, "upto bigint, pieces int, piece int, place string")
        write_files(frame.coalesce(1), f"{self.folder}/manifests/version={version}")
        self.spark.range(version, version + 1).toDF("version").write.mode("append").parquet(f"{self.folder}/versions")


def change_stream(
    df: DataFrame, table: ChangedTable, checkpoint: str, sequence: Column, deleted: Column, compact_every: int = 10
) -> StreamingQuery:
    """Append every micro-batch to a table, and compact it after each ``compact_every`` of them."""

    def handle(batch: DataFrame, number: int) -> None:
        upto, _, _ = table.manifest()
        if number <= upto:
            return  # folded in already: the batch is run again after a stop behind its compaction
        table.append(number, batch, sequence, deleted)
        if (number + 1) % compact_every == 0:
            table.compact()

    return run_each_batch(df, checkpoint, handle)
