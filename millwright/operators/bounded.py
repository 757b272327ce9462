"""Joining a per-key summary back onto the rows it was computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import materialize

BROADCAST_ROWS = 200_000


def join_summary(
    rows: DataFrame, summary: DataFrame, keys: list[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Joins a summary without shuffling the rows, if the summary is small enough.

    The summary is written once to the shared folder, so its size is known
    rather than guessed. Up to ``max_rows`` rows it is broadcast and the big
    side stays where it was read. Above that the rows are joined by shuffle,
    with adaptive execution splitting keys that are too large for one task.
    """
    stored = materialize(summary)
    if stored.limit(max_rows + 1).count() <= max_rows:
        return rows.join(F.broadcast(stored), keys)
    return rows.join(stored.hint("shuffle_merge"), keys)
