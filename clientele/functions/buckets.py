"""Calendar buckets for the "when does this customer usually order" metrics."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    name: str
    part: Callable[[Column], Column]
    values: tuple[int, ...]
    column: str
    count_column: str
    ratio_column: str


# Day of week counts Sunday as 1, as the source database does by default.
BUCKETS = {
    "hour": Bucket(
        "hour", F.hour, tuple(range(0, 24)),
        "hour_of_day_most_order", "order_count_hod_most_order", "ratio_hod_most_order",
    ),
    "weekday": Bucket(
        "weekday", F.dayofweek, tuple(range(1, 8)),
        "day_of_week_most_order", "order_count_dow_most_order", "ratio_dow_most_order",
    ),
    "monthday": Bucket(
        "monthday", F.dayofmonth, tuple(range(1, 32)),
        "day_of_month_most_order", "order_count_dom_most_order", "ratio_dom_most_order",
    ),
    "month": Bucket(
        "month", F.month, tuple(range(1, 13)),
        "month_of_year_most_order", "order_count_moy_most_order", "ratio_moy_most_order",
    ),
}


def bucket(kind: str) -> Bucket:
    try:
        return BUCKETS[kind]
    except KeyError:
        raise ValueError(f"unknown bucket {kind!r}; expected one of {sorted(BUCKETS)}") from None
