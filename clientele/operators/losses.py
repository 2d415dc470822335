"""Counts of the rows that a run leaves out or can't complete, taken while it runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clientele.functions.reasons import BAD_CANCEL_REASONS, BAD_RETURN_REASONS, is_listed


class Losses:
    """Named counters on the frames of a run, filled by the jobs that evaluate these frames anyway.

    A counter is a Spark ``Observation``: no job and no pass of its own.  A
    frame's counts are those of its first evaluation.  Where a lost executor
    makes Spark repeat tasks before a shuffle, the rows of these tasks count twice.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, tuple[str, ...]]] = []

    def watch(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """``df``, with the number of rows that meet each condition counted under its name."""
        observation = Observation()
        self._watched.append((observation, tuple(conditions)))
        return df.observe(observation, *(F.count_if(c).alias(name) for name, c in conditions.items()))

    def counts(self) -> dict[str, int]:
        """All counters; call it once the watched frames were evaluated.  Frames without a row count 0."""
        out = {}
        for observation, names in self._watched:
            # the Java map: Python's ``get`` fails where Catalyst found a frame empty and left the counters out
            found = observation._jo.getAsJava()
            out.update({name: int(found.get(name) or 0) for name in names})
        return out


def source_conditions(
    bad_cancel_reasons: Iterable[str] | DataFrame = BAD_CANCEL_REASONS,
    bad_return_reasons: Iterable[str] | DataFrame = BAD_RETURN_REASONS,
    match: str = "exact",
) -> dict[str, dict[str, Column]]:
    """What to count in each source: rows that the run drops, and verified items with a reason no list names.

    Reasons given as a table have no counter of unlisted reasons: it would need a join.
    """
    verified = F.col("finance_verified_at").isNotNull()
    items = {"unverified_items": ~verified}
    for column, reasons in (("cancel_reason", bad_cancel_reasons), ("return_reason", bad_return_reasons)):
        if not isinstance(reasons, DataFrame):
            listed = is_listed(F.col(column), reasons, match)
            items[f"unlisted_{column}s"] = verified & F.col(column).isNotNull() & ~listed
    return {"orders": {"orders_without_customer": F.col("customer_id").isNull()}, "items": items}
