"""Joins: equi, anti, theta, skewed, hierarchical and blended."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.common import any_of, join_null_safe, read_as
from tablewright.operators.ordered import number_rows
from tablewright.operators.skew import frequent_keys
from tablewright.session import settle

STRATEGIES = ("merge", "shuffle_hash")


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    how: str = "inner",
    strategy: str | None = None,
) -> DataFrame:
    """Join on shared names, or on ``{left name: right name}``.

    Without a strategy Spark chooses, and broadcasts only below its size limit.
    """
    if strategy is not None:
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        right = right.hint(strategy)
    if isinstance(on, Mapping):
        condition = [left[a] == right[b] for a, b in on.items()]
        return left.join(right, condition, how)
    return left.join(right, list(on), how)


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Measure at most ``max_rows`` + 1 rows of ``df``."""
    head = df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
    rows, size = head.agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = 100_000,
    max_bytes: int = 32 * 1024 * 1024,
) -> DataFrame:
    """Broadcast ``small`` when its measured size allows, else join by shuffle."""
    if is_small(small, max_rows, max_bytes):
        small = F.broadcast(small)
    return big.join(small, list(on), how)


def missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``."""
    return left.join(right.select(*on), list(on), "left_anti")


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """SQL ``NOT IN``: nothing passes when the list holds a NULL, and a NULL on the
    left passes only an empty list. The list itself is never broadcast whole."""
    facts = right.agg(
        F.struct(F.count(F.lit(1)).alias("size"), F.count_if(F.col(other).isNull()).alias("nulls"))
    ).scalar()
    kept = left.filter(
        (facts["size"] == 0) | ((facts["nulls"] == 0) & F.col(column).isNotNull())
    )
    listed = right.select(F.col(other).alias(column))
    return kept.join(listed, column, "left_anti")


def hot_keys(df: DataFrame, on: Sequence[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: fewer than 1 / share keys."""
    return frequent_keys(df, on, share).select(*on)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salts: int,
    *,
    share: float = 0.01,
    how: str = "inner",
) -> DataFrame:
    """Join whose hot keys are spread over ``salts`` tasks.

    Rows of ``big`` under a hot key get a salt from a hash of the whole row, so a
    repeated task gives the same salt; the matching rows of ``small`` are copied to
    every salt. Other keys keep salt 0 and are not copied. NULL keys match nothing
    and are spread as well. Adaptive skew splitting stays on below this, for whole
    rows that repeat.
    """
    if not 1e-4 <= share <= 1:
        raise ValueError("share must lie between 1e-4 and 1: the hot keys are broadcast")
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep the big side can be salted")
    # Few rows by definition; written out once, as both sides read them.
    hot = F.broadcast(settle(hot_keys(big, on, share)).withColumn("__hot", F.lit(True)))
    is_hot = F.coalesce(F.col("__hot"), F.lit(False))
    no_key = any_of([F.col(k).isNull() for k in on])
    row_salt = F.pmod(F.xxhash64(*big.columns), F.lit(salts))
    left = (
        big.join(hot, list(on), "left")
        .withColumn("__salt", F.when(is_hot | no_key, row_salt).otherwise(F.lit(0)))
        .drop("__hot")
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    right = (
        small.join(hot, list(on), "left")
        .withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("bigint")))))
        .drop("__hot")
    )
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def compare_to_group(
    df: DataFrame, keys: Sequence[str], value: str, places: int = 2, mean: Column | None = None
) -> DataFrame:
    """Each row beside its group mean, the difference and the difference in percent.

    The means are joined back (one row per group) rather than computed over a
    window, so rows of a hot group stay where they are. ``mean`` replaces the plain
    average, for instance by one of exact sums.
    """
    average = F.avg(value) if mean is None else mean
    means = df.groupBy(*keys).agg(average.alias("group_mean"))
    joined = join_null_safe(df, means, keys)
    difference = F.col("group_mean") - F.col(value)
    return joined.withColumns(
        {
            "difference": difference,
            "difference_pct": F.round(difference / F.nullif(F.col(value), F.lit(0)) * 100, places),
        }
    )


def at_grain(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregates at a coarser grain next to every detail row."""
    made = df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    return join_null_safe(df, made, keys)


def blend(
    primary: DataFrame, secondary: DataFrame, on: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Left join of a secondary source brought to the primary's grain first."""
    made = secondary.groupBy(*on).agg(*[m.alias(name) for name, m in measures.items()])
    return primary.join(made, list(on), "left")


def side_by_side(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_measures: Mapping[str, Column],
    right_measures: Mapping[str, Column],
) -> DataFrame:
    """Both sides grouped on the same keys and put in one row (a cogroup)."""
    a = left.groupBy(*on).agg(*[m.alias(n) for n, m in left_measures.items()])
    b = right.groupBy(*on).agg(*[m.alias(n) for n, m in right_measures.items()])
    return a.join(b, list(on), "full")


def round_robin(
    teams: DataFrame,
    id_col: str,
    name_col: str,
    first_date: str,
    every_days: int = 7,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Every team against every other once, one match per date, numbered in order.

    Teams are numbered, each looks up its later numbers by an equi-join, and the
    match number follows in closed form from the two places.
    """
    numbered = number_rows(teams, keys, [id_col], "__place")
    if keys:
        sizes = teams.groupBy(*keys).agg(F.count(F.lit(1)).alias("__teams"))
        numbered = join_null_safe(numbered, sizes, keys)
    else:
        numbered = numbered.withColumn("__teams", teams.agg(F.count(F.lit(1))).scalar())
    home = numbered.filter(F.col("__place") < F.col("__teams")).select(
        *keys,
        F.col(name_col).alias("home"),
        F.col("__place").alias("__home"),
        "__teams",
        F.explode(F.sequence(F.col("__place") + 1, F.col("__teams"))).alias("__place"),
    )
    away = numbered.select(*keys, "__place", F.col(name_col).alias("away"))
    pairs = join_null_safe(home, away, [*keys, "__place"])
    i, j, n = F.col("__home"), F.col("__place"), F.col("__teams")
    before = F.floor(((i - 1) * (2 * n - i)) / 2)
    number = (before + j - i).cast("bigint")
    sunday = F.next_day(F.date_sub(F.lit(first_date).cast("date"), 1), "Sun")
    return pairs.select(
        *keys,
        number.alias("match_no"),
        F.concat("home", F.lit("  vs  "), "away").alias("fixture"),
        F.date_add(sunday, ((number - 1) * every_days).cast("int")).alias("match_date"),
    )


def managers(
    df: DataFrame, id_col: str, parent_col: str, name_col: str, levels: int = 2
) -> DataFrame:
    """Names of the next ``levels`` parents; a parent that is no number is none."""
    kinds = dict(df.dtypes)
    nodes = df.select(
        F.col(id_col),
        F.col(name_col).alias("name"),
        read_as(F.col(parent_col), kinds[id_col], kinds[parent_col]).alias("__parent"),
    )
    found = nodes
    for level in range(1, levels + 1):
        above = nodes.select(
            F.col(id_col).alias("__id"),
            F.col("name").alias(f"manager_{level}"),
            F.col("__parent").alias("__next"),
        )
        found = (
            found.join(above, F.col("__parent") == F.col("__id"), "left")
            .drop("__id", "__parent")
            .withColumnRenamed("__next", "__parent")
        )
    return found.drop("__parent")


def hierarchy(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """Root and depth of every node, by pointer doubling: log2(depth) joins.

    Nodes on a cycle never reach a root; they come out with a NULL root.
    """
    kinds = dict(df.dtypes)
    state = df.select(
        F.col(id_col), read_as(F.col(parent_col), kinds[id_col], kinds[parent_col]).alias("__up")
    )
    known = state.select(F.col(id_col).alias("__known"))
    state = state.join(known, F.col("__up") == F.col("__known"), "left").select(
        id_col,
        F.col("__known").alias("__up"),
        F.when(F.col("__known").isNotNull(), 1).otherwise(0).cast("bigint").alias("depth"),
        F.when(F.col("__known").isNull(), F.col(id_col)).alias("root"),
    )
    state = settle(state)
    limit, reach = state.count(), 1
    while reach <= limit and not state.filter(F.col("root").isNull()).isEmpty():
        above = state.select(
            F.col(id_col).alias("__id"),
            F.col("__up").alias("__up2"),
            F.col("depth").alias("__depth2"),
            F.col("root").alias("__root2"),
        )
        moved = (
            state.filter(F.col("root").isNull())
            .join(above, F.col("__up") == F.col("__id"))
            .select(
                id_col,
                F.col("__up2").alias("__up"),
                (F.col("depth") + F.col("__depth2")).alias("depth"),
                F.col("__root2").alias("root"),
            )
        )
        state = settle(state.filter(F.col("root").isNotNull()).unionByName(moved))
        reach *= 2
    return state.select(id_col, "root", "depth")
