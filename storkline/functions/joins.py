"""Joins against tables that are usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def join_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join that broadcasts ``lookup`` only when a count shows it to be small.

    A larger one is left to the planner: a sort-merge join, with hot keys split by adaptive
    execution.
    """
    if lookup.limit(max_rows + 1).count() <= max_rows:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, on, "left")
