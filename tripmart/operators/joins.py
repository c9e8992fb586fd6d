"""Dimension joins: a broadcast only behind a check of the dimension's bytes, a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension up to this many bytes in memory is shipped to every task; beyond it the join is a
# shuffle join (with AQE skew handling). Both give the same rows.
MAX_BROADCAST_BYTES = 64 << 20
_ROW_BYTES, _FIELD_BYTES = 64, 8


def size_in_bytes(dim: DataFrame) -> int:
    """Bytes of ``dim`` in Spark's row format: a fixed part per row and field, and all text.
    One aggregate over the dimension; the driver gets one number."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in dim.schema.fields
             if f.dataType.typeName() in ("string", "binary")]
    row = F.lit(_ROW_BYTES + _FIELD_BYTES * len(dim.columns))
    for t in texts:
        row = row + t
    return dim.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def broadcast_if_small(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(dim)`` when it has at most ``max_bytes``, else ``dim`` unchanged."""
    return F.broadcast(dim) if size_in_bytes(dim) <= max_bytes else dim


def lookup(facts: DataFrame, dim: DataFrame, key: str, prefix: str,
           dim_key: str = "location_id", how: str = "left") -> DataFrame:
    """Join ``dim`` on ``facts[key] = dim[dim_key]``, naming dim columns ``<prefix>_<col>``.

    The dimension enters the join unchanged and is renamed after it, so two lookups
    into the same dimension (pick-up and drop-off) share one broadcast exchange.
    """
    d = dim.alias(prefix)
    joined = facts.alias("facts").join(d, F.col(f"facts.{key}") == F.col(f"{prefix}.{dim_key}"), how)
    return joined.select(
        "facts.*",
        *[F.col(f"{prefix}.{c}").alias(f"{prefix}_{c}") for c in dim.columns if c != dim_key])


def orphans(facts: DataFrame, dim: DataFrame, key: str,
            dim_key: str = "location_id") -> DataFrame:
    """Fact rows whose ``key`` has no row in ``dim`` (NULL keys included)."""
    return facts.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")
