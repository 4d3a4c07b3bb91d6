"""Totals over a join, kept up to date from the changes of its tables.

Changed rows carry a ``weight``: 1 for a row that came, -1 for one that went; an update is one of each. For a
join L x R the change is dL x R + L x dR + dL x dR with the old tables, weights multiplied, and
totals per group change by the weighted sums. Each group keeps how many joined rows it stands for, and how many
of them have a value, so a group that loses its last row goes, and a sum without values is NULL.

The old tables lie in pieces by a hash of the join key. A change reads only the pieces that its
own keys are in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.common import ColumnOrName, as_column
from tablewright.sinks.writers import write_files

WEIGHT, ROWS, PIECE = "weight", "rows", "__piece"


class PiecedTable:
    """A table in folders by a hash of its join key."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, on: Sequence[str], pieces: int):
        self.spark, self.folder, self.on, self.pieces = spark, folder, list(on), pieces
        self.schema = schema

    def _piece(self) -> Column:
        return F.pmod(F.xxhash64(*self.on), F.lit(self.pieces)).cast("int")

    def write(self, df: DataFrame) -> None:
        placed = df.select(*self.schema.names).withColumn(PIECE, self._piece())
        write_files(placed.hint("rebalance", PIECE), self.folder, partition_by=[PIECE])

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(StructType(list(self.schema.fields)).add(PIECE, "integer")).parquet(self.folder)
        return rows.select(*self.schema.names)

    def near(self, changes: DataFrame) -> DataFrame:
        """The rows of the pieces that hold a key of ``changes``: never more numbers than there are pieces."""
        wanted = [r[0] for r in changes.select(self._piece()).distinct().collect()]
        rows = self.spark.read.schema(StructType(list(self.schema.fields)).add(PIECE, "integer")).parquet(self.folder)
        return rows.filter(F.col(PIECE).isin(wanted) if wanted else F.lit(False)).select(*self.schema.names)


def signed(came: DataFrame, went: DataFrame | None = None) -> DataFrame:
    """Changes of a table: rows that came, and rows that went."""
    made = came.withColumn(WEIGHT, F.lit(1).cast("bigint"))
    return made if went is None else made.unionByName(went.withColumn(WEIGHT, F.lit(-1).cast("bigint")))


def _weighted(joined: DataFrame, keys: Sequence[str], sums: Mapping[str, ColumnOrName], weight: Column) -> DataFrame:
    measures = [F.sum(weight).alias(ROWS)]
    for name, value in sums.items():
        value = as_column(value)
        measures += [
            F.sum(value * weight).alias(name), F.sum(F.when(value.isNotNull(), weight).otherwise(F.lit(0))).alias(f"{name}_n"),
        ]
    return joined.groupBy(*keys).agg(*measures)


def joined_totals(
    left: DataFrame, right: DataFrame, on: Sequence[str], keys: Sequence[str], sums: Mapping[str, ColumnOrName]
) -> DataFrame:
    """The totals from the whole tables: ``keys``, ``rows``, and each sum with its number of values (``_n``)."""
    return _weighted(left.join(right, list(on)), keys, sums, F.lit(1).cast("bigint"))


def refresh_joined_totals(
    saved: DataFrame,
    left: PiecedTable,
    left_changes: DataFrame,
    right: PiecedTable,
    right_changes: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    sums: Mapping[str, ColumnOrName],
) -> DataFrame:
    """``saved`` totals after changes of either table or both; the tables are as they were before.

    Sums are exact for whole numbers and decimals. A row that went must have been there: weights
    are added up, not looked up.
    """
    a = left_changes.withColumnRenamed(WEIGHT, "__a")
    b = right_changes.withColumnRenamed(WEIGHT, "__b")
    once = F.lit(1).cast("bigint")
    parts = [
        a.join(right.near(a), list(on)).withColumn("__b", once),
        left.near(b).join(b, list(on)).withColumn("__a", once),
        a.join(b, list(on)),
    ]
    weight = F.col("__a") * F.col("__b")
    changes = None
    for part in parts:
        made = _weighted(part, keys, sums, weight)
        changes = made if changes is None else changes.unionByName(made)
    names = [c for c in saved.columns if c not in keys]
    both = saved.unionByName(changes.select(*saved.columns))
    merged = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names]).filter(F.col(ROWS) > 0)
    fixed = {n: F.when(F.col(f"{n}_n") > 0, F.col(n)).cast(dict(saved.dtypes)[n]) for n in sums}
    return merged.withColumns(fixed).select(*saved.columns)
