"""Row comparison and small fixtures."""

from __future__ import annotations

import datetime as dt


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def day(text):
    return dt.date.fromisoformat(text)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
