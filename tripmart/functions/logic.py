"""Boolean combinators with SQL three-valued semantics."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def and_all(preds: Iterable[Column]) -> Column:
    """AND of all predicates; TRUE when there are none.

    NULL is kept: ``TRUE AND NULL`` is NULL, ``FALSE AND NULL`` is FALSE.
    """
    preds = list(preds)
    if not preds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, preds)


def count_true(pred: Column) -> Column:
    """Aggregate: rows where the predicate is TRUE (NULL is not counted)."""
    return F.count_if(pred)

