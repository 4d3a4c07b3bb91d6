"""Array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def shifted_windows(values: Column | str, names: Sequence[str]) -> Column:
    """One struct per element holding it and its followers; the tail has NULLs."""
    items = _col(values)
    slices = [F.slice(items, k + 1, F.size(items)).alias(n) for k, n in enumerate(names)]
    return F.arrays_zip(*slices)


def ngrams(values: Column | str, n: int, joiner: str = " ") -> Column:
    """All runs of ``n`` neighbouring elements, joined; none if there are fewer."""
    items = _col(values)
    names = [f"k{k}" for k in range(n)]
    runs = F.slice(shifted_windows(items, names), 1, F.greatest(F.size(items) - (n - 1), F.lit(0)))
    return F.transform(runs, lambda run: F.array_join(F.array(*[run[k] for k in names]), joiner))


def _every(items: Column, step: int, first: int) -> Column:
    """The elements at ``first``, ``first + step``, ..."""
    return F.filter(items, lambda _, place: place % step == first)


def blocks(values: Column | str, fields: Sequence[str]) -> Column:
    """The elements in rows of ``len(fields)``: an array of structs."""
    items, k = _col(values), len(fields)
    return F.arrays_zip(*[_every(items, k, i).alias(f) for i, f in enumerate(fields)])


def merged_lines(text: Column | str, per_record: int, joiner: str = "") -> Column:
    """Every ``per_record`` lines of a text put together into one record."""
    lines = F.split(_col(text), "\n")
    names = [f"k{k}" for k in range(per_record)]
    return F.transform(
        blocks(lines, names), lambda b: F.array_join(F.array(*[b[k] for k in names]), joiner)
    )


def continued_lines(text: Column | str, mark: str) -> Column:
    """Records of a text in which a line ending in ``mark`` goes on in the next."""
    return F.split(F.replace(_col(text), F.lit(mark + "\n"), F.lit("")), "\n")
