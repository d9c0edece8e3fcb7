"""Choices that depend on a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of at most so many rows of a few numbers is sent to every executor.
BROADCAST_ROWS = 200_000


def sized(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` marked for broadcast if a count shows it small, else as it is (a shuffled join).

    Give it a checkpointed or written table of narrow rows, so that the count is cheap.
    """
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side
