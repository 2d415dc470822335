"""Zone-free datetime arithmetic on TIMESTAMP_NTZ columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_literal(as_of: dt.datetime | str) -> Column:
    """The job's single "now", as a TIMESTAMP_NTZ literal.

    The source job read the clock separately in every statement; one explicit
    value makes a run repeatable and keeps all metrics consistent.
    """
    at = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(as_of)
    if at.tzinfo is not None:
        raise ValueError(f"as_of must be a wall-clock time without a zone: {as_of}")
    as_of = at.isoformat(sep=" ")
    # From text, so neither the Python process's nor the session's time zone
    # can shift the value.
    return F.lit(as_of).cast("timestamp_ntz")


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of clock-hour boundaries crossed from ``start`` to ``end``.

    This is how the source database counts a difference in hours: 00:59 to
    01:01 is one hour, 01:00 to 01:59 is none.  Calendar arithmetic on the
    date and the hour field needs no time zone and stays in codegen.
    """
    days = F.datediff(end.cast("date"), start.cast("date"))
    return days * F.lit(24) + F.hour(end) - F.hour(start)


def whole_days(hours: Column) -> Column:
    """Integer division by 24, truncating toward zero like the source SQL."""
    return (hours / F.lit(24)).cast("bigint")


def sla_broken(start: Column, done: Column, as_of: Column, days: int) -> Column:
    """1 when a step took more than ``days`` whole days, else NULL.

    Still open (``done`` is NULL) and older than ``days`` days at ``as_of``
    counts as broken, as does finishing more than ``days`` days after
    ``start``.  NULL ``start`` gives NULL.
    """
    return (
        F.when((whole_days(hour_boundaries(start, as_of)) > days) & done.isNull(), F.lit(1))
        .when(whole_days(hour_boundaries(start, done)) > days, F.lit(1))
        .otherwise(F.lit(None).cast("int"))
    )


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(days=F.lit(days))


def minus_days(ts: Column, days: int) -> Column:
    return ts - F.make_dt_interval(days=F.lit(days))
