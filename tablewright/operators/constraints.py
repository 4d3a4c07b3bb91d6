"""Table constraints as reports of the rows that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.common import any_of
from tablewright.operators.sets import stack_all


@dataclass(frozen=True)
class Rules:
    """What a table must satisfy. ``foreign`` maps a column to (table name, column)."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    primary_key: Sequence[str] = ()
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    check: Mapping[str, Column] = field(default_factory=dict)


def check_constraints(
    df: DataFrame, rules: Rules, refs: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows per rule that break it.

    Rules on single rows share one pass, each key rule costs one shuffle. As in
    SQL, a NULL breaks neither UNIQUE, FOREIGN KEY nor CHECK.
    """
    refs = refs or {}
    row_rules = {f"not null {c}": F.col(c).isNull() for c in rules.not_null}
    if rules.primary_key:
        name = f"primary key not null {','.join(rules.primary_key)}"
        row_rules[name] = any_of([F.col(c).isNull() for c in rules.primary_key])
    row_rules |= {f"check {n}": ~F.coalesce(ok, F.lit(True)) for n, ok in rules.check.items()}

    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(bad).alias(n) for n, bad in row_rules.items()])
        parts.append(counts.unpivot([], [f"`{n}`" for n in row_rules], "rule", "violations"))
    keys = [("unique", k) for k in rules.unique]
    if rules.primary_key:
        keys.append(("primary key unique", rules.primary_key))
    for label, key in keys:
        copies = df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        surplus = copies.filter("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        parts.append(surplus.select(F.lit(f"{label} {','.join(key)}").alias("rule"), "violations"))
    for column, (ref, ref_column) in rules.foreign.items():
        parents = refs[ref].select(F.col(ref_column).alias(column))
        orphans = df.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")
        parts.append(
            orphans.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(f"foreign key {column} -> {ref}.{ref_column}").alias("rule"), "violations"
            )
        )
    return stack_all(parts)


def violating_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a NOT NULL or CHECK rule, one per rule broken."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"not null {c}")) for c in rules.not_null]
    broken += [
        F.when(~F.coalesce(ok, F.lit(True)), F.lit(f"check {n}")) for n, ok in rules.check.items()
    ]
    return df.withColumn("rule", F.explode(F.array_compact(F.array(*broken))))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})

