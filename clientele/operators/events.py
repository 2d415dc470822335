"""Latest event per customer: last cancellation, return, order status."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.reasons import is_listed


def last_event(
    facts: DataFrame,
    ts: str,
    value: str,
    *,
    key: str = "customer_id",
    only: Iterable[str] | None = None,
    match: str = "exact",
    require_ts: bool = True,
    ts_alias: str | None = None,
    value_alias: str | None = None,
) -> DataFrame:
    """Per ``key``: the latest ``ts`` and, at that instant, the largest ``value``.

    ``max(struct(ts, value))`` orders by time first and breaks a tie between
    several values at the same instant by the larger value (NULL below any
    text), which is what grouping by the timestamp, taking ``MAX(value)``
    and keeping rank 1 of ``ROW_NUMBER() ... ORDER BY ts DESC`` gives.  Being
    an ordinary aggregate it combines map-side, so a customer with a third of
    all events never lands on one reducer whole.

    ``only`` keeps just the events whose value is listed (the "bad" reasons);
    customers without such an event get no row.  With ``require_ts=False``
    rows with a NULL time stay in and lose to any real time.
    """
    rows = facts
    if require_ts:
        rows = rows.filter(F.col(ts).isNotNull())
    if only is not None:
        rows = rows.filter(is_listed(F.col(value), only, match))
    latest = rows.groupBy(key).agg(F.max(F.struct(F.col(ts).alias("at"), F.col(value).alias("value"))).alias("e"))
    return latest.select(
        key,
        F.col("e.at").alias(ts_alias or ts),
        F.col("e.value").alias(value_alias or value),
    )
