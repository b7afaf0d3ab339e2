"""Rounding and ranks with one meaning in every engine."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def half_up(value: Column, digits: int = 2) -> Column:
    """Rounded half up on the decimal value; a double rounded as such differs between engines on ties."""
    return F.round(value.cast("decimal(24,8)"), digits).cast("double")


@F.pandas_udf(DoubleType())
def half_even(value: pd.Series) -> pd.Series:
    """Two digits as Python rounds a float (ties by its binary value)."""
    return value.map(lambda v: v if v != v else round(v, 2))


def rank_in(value: Column, order: tuple[str, ...]) -> Column:
    """1-based rank of a word in an ordered vocabulary, null outside of it."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), value), F.lit(0)).cast("int")


def word_at(rank: Column, order: tuple[str, ...]) -> Column:
    return F.try_element_at(F.array(*[F.lit(v) for v in order]), rank)


def known(value: Column) -> Column:
    """The value unless it is null, empty or the word ``unknown``."""
    return F.when(~value.isin("", "unknown"), value)


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def bin_of(value: Column, n_bins: int) -> Column:
    """Equal-width bin of a value in [0, 1], counted over the literal edges (0.3 of 10 bins is bin 2 or 3 as the edge says)."""
    edges = [i / n_bins for i in range(1, n_bins)]
    passed = sum((F.when(value >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return passed.cast("int")
