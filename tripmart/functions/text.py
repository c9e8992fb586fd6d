"""Text normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Trim a text value; an empty result becomes NULL, NULL stays NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for NULL or for text that is empty after trimming."""
    return c.isNull() | (F.length(F.trim(c)) == 0)
