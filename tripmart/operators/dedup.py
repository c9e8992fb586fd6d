"""Deterministic de-duplication.

``keep_first`` keeps, per key, the first row of a total order. It is a
``row_number() = 1`` filter, which Spark plans with a partial ``WindowGroupLimit``
before the shuffle: every task forwards at most one row per key, so a key that
holds a large share of all rows costs at most one row per task in the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (which should make the choice total)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def ascending(columns: Sequence[str]) -> list[Column]:
    """Ascending, NULLs first: the tie-break order used by every de-duplication."""
    return [F.col(c).asc_nulls_first() for c in columns]
