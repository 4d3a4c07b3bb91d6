"""Small pieces shared by the operators: Arrow texts in chunks, word places and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import run_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def id_part(column: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts, F.lit(0))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives executors."""
    spark = df.sparkSession
    folder = run_folder(spark, label)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df``, quoted, but for those named, whatever their case."""
    taken = {name.lower() for name in names}
    return [f"`{c}`" for c in df.columns if c.lower() not in taken]


def schema_of(df: DataFrame) -> list[str]:
    """Name and type of every column, as a schema text lists them."""
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 16 MB, so that long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; null becomes empty."""
    return pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()


def chunks(
    column: pa.Array, size: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) of pieces of about ``size`` bytes.

    A row is never cut; one longer than ``size`` is a piece of its own. Null becomes empty.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    rows = len(column)
    if not rows:
        return
    _, bounds, values = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ascii_space() -> np.ndarray:
    """True for the bytes 0x20 and 0x09-0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, 9, 10, 11, 12, 13]] = True
    return table


class WordHasher:
    """Finds words in UTF-8 bytes and hashes each to 64 bits, A-Z taken as a-z.

    A hash is the difference of two prefix sums over (byte code * base ** place), moved to
    place 0 with the inverse of the base, so a whole chunk is hashed by array operations.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, word_bytes: np.ndarray, seed: int = 1):
        self.word_bytes = word_bytes
        codes = np.arange(256, dtype=np.uint64)
        codes[65:91] = codes[97:123]
        self.codes = mix(codes + np.uint64(seed) * np.uint64(1000003))
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) <= size:
            base = np.full(size + 1, self.BASE, np.uint64)
            back = np.full(size + 1, pow(self.BASE, -1, 1 << 64), np.uint64)
            base[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(base), np.cumprod(back)

    def places(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end (exclusive) of every word; no word crosses a row."""
        inside = self.word_bytes[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        return np.flatnonzero(begins), np.flatnonzero(ends) + 1

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, index of each row's first word, closed by the number of words)."""
        starts, ends = self.places(data, offsets)
        rows = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.uint64), rows
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64)), rows
