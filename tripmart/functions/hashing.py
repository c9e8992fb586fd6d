"""Ride identity hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def ride_id(vendor_id: Column, pickup: Column, week_id: Column,
            pu_location_id: Column, do_location_id: Column, total_amount: Column) -> Column:
    """SHA-256 (hex) of the ``::``-joined identity parts.

    NULL parts become empty text, except the pick-up time, which ``concat_ws``
    skips when NULL. Drop-off, distance and fare are not part of the identity.
    """
    empty = F.lit("")
    parts = [
        F.coalesce(vendor_id.cast("string"), empty),
        F.date_format(pickup, S.RIDE_ID_TIME_FORMAT),
        F.coalesce(week_id, empty),
        F.coalesce(pu_location_id.cast("string"), empty),
        F.coalesce(do_location_id.cast("string"), empty),
        F.coalesce(total_amount.cast("string"), empty),
    ]
    return F.sha2(F.concat_ws(S.RIDE_ID_SEPARATOR, *parts), 256)
