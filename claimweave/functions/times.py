"""Times as sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nulls_last(time: str | Column) -> Column:
    """The time, or the end of the year 9999 where there is none: ``min_by`` passes over null keys, and a record that has no other row must not be lost."""
    return F.coalesce(F.col(time) if isinstance(time, str) else time, F.timestamp_seconds(F.lit(253402300799)))
