"""Nested and delimited data to rows and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import blocks
from tablewright.operators.common import any_of, read_as


def flatten_delimited(
    df: DataFrame, column: str, separator: str, fields: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One delimited text to rows of ``len(fields)`` values.

    The place in the split array gives row and field, so nothing is shuffled. The
    separator is a regular expression.
    """
    rows = F.posexplode(blocks(F.split(F.col(column), separator), fields))
    return df.select(*keep, rows.alias("record", "__row")).select(*keep, "record", "__row.*")


def flatten_nested(
    df: DataFrame, array_paths: Sequence[tuple[str, str]], fields: Mapping[str, str], outer: bool = True
) -> DataFrame:
    """Explode nested arrays one after another and pick fields by dotted path.

    ``array_paths`` holds (path, name) pairs; a later path may start at an earlier
    name. With ``outer`` a row without elements stays, with NULLs.
    """
    explode = F.explode_outer if outer else F.explode
    rows = df
    for path, name in array_paths:
        rows = rows.withColumn(name, explode(F.col(path)))
    return rows.select(*[F.col(path).alias(name) for name, path in fields.items()])


def long_from_wide(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def league_table(
    matches: DataFrame, teams: DataFrame, win: int = 3, draw: int = 1
) -> DataFrame:
    """Points of every team, zero for one without a match.

    ``matches`` has host_team, guest_team, host_goal and guest_goal, ``teams`` has
    team_id and team_name. Both sides of a match come from one scan.
    """

    def side(team: str, scored: str, against: str) -> Column:
        points = (
            F.when(F.col(scored) > F.col(against), win)
            .when(F.col(scored) == F.col(against), draw)
            .otherwise(0)
        )
        return F.struct(F.col(team).alias("team_id"), points.alias("points"))

    sides = F.explode(
        F.array(side("host_team", "host_goal", "guest_goal"), side("guest_team", "guest_goal", "host_goal"))
    )
    totals = (
        matches.select(sides.alias("s"))
        .groupBy(F.col("s.team_id").alias("team_id"))
        .agg(F.sum("s.points").alias("points"))
    )
    return totals.join(teams, "team_id", "right").select(
        "team_id", "team_name", F.coalesce("points", F.lit(0)).alias("points")
    )


def validate_sessions(df: DataFrame, start: str, end: str, corrupt: str | None = None) -> DataFrame:
    """Rows with a ``defect``: corrupt, missing, unparsable or negative, else NULL.

    ``start`` and ``end`` are paths of timestamp texts.
    """
    a, b = (read_as(F.col(path), "timestamp") for path in (start, end))
    broken = F.col(corrupt).isNotNull() if corrupt else F.lit(False)
    defect = (
        F.when(broken, "corrupt record")
        .when(any_of([F.col(start).isNull(), F.col(end).isNull()]), "missing time")
        .when(a.isNull() | b.isNull(), "unparsable time")
        .when(b < a, "negative duration")
    )
    return df.withColumns(
        {
            "defect": defect,
            "seconds": F.when(defect.isNull(), F.timestamp_diff("SECOND", a, b)),
        }
    )


def session_event_checks(
    df: DataFrame, events: str, kind: str = "event_type", at: str = "timestamp"
) -> DataFrame:
    """Duration and order of the start and end events kept in an array per row."""

    def moment(which: str, pick) -> Column:
        chosen = F.filter(F.col(events), lambda e: e[kind] == which)
        return pick(F.transform(chosen, lambda e: e[at]))

    start, end = moment("start", F.array_min), moment("end", F.array_max)
    state = (
        F.when(F.col(events).isNull() | (F.size(events) == 0), "no events")
        .when(start.isNull() | end.isNull(), "incomplete")
        .when(
            F.array_position(F.transform(F.col(events), lambda e: e[kind]), "end")
            < F.array_position(F.transform(F.col(events), lambda e: e[kind]), "start"),
            "out of order",
        )
        .otherwise("ok")
    )
    return df.withColumns({"duration": end - start, "state": state})

