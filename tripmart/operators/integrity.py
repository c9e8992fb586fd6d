"""Referential integrity of trips against the zone lookup (opt-in bronze flags).

``chk_PULocationID_ref_ok`` / ``chk_DOLocationID_ref_ok`` are TRUE when the id has a
zone, FALSE when it has none and NULL when the id is NULL. Each is a left join with
the distinct integer zone ids (broadcast only behind the size check), so no trip row
is multiplied or lost. After adding them, ``dq_pass`` is recomputed over every flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators.bronze import with_dq_pass
from tripmart.operators.joins import MAX_BROADCAST_BYTES, broadcast_if_small
from tripmart.operators.silver import zone_dimension

REF_CHECKS = [("PULocationID", "chk_PULocationID_ref_ok"),
              ("DOLocationID", "chk_DOLocationID_ref_ok")]


def add_zone_ref_checks(trips: DataFrame, zones: DataFrame,
                        max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add the two referential flags; recompute ``dq_pass`` when the frame has one."""
    ids = broadcast_if_small(zone_dimension(zones).select("location_id"), max_broadcast_bytes)
    out = trips
    for col, chk in REF_CHECKS:
        if col not in trips.columns:
            out = out.withColumn(chk, F.lit(True))
            continue
        key = f"__{chk}"
        found = ids.select(F.col("location_id").alias(key))
        out = (out.join(found, F.col(col).try_cast("int") == F.col(key), "left")
               .withColumn(chk, F.when(F.col(col).isNull(), F.lit(None).cast("boolean"))
                           .otherwise(F.col(key).isNotNull()))
               .drop(key))
    return with_dq_pass(out.drop(S.DQ_PASS)) if S.DQ_PASS in trips.columns else out
