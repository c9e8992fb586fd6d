"""Silver layer: conform trips, attach pick-up / drop-off zones, derive columns,
de-duplicate by ``ride_id`` and enforce the 42-column curated order.

The step functions follow the layer's logical order. ``curate`` composes them in the
order that is cheapest at scale and gives the same rows: ``conform`` keys and de-duplicates
the 20 conformed columns *before* the zone joins and the derived columns, so the one
shuffle of the layer moves narrow rows; ``enrich`` adds joins and derivations, which are narrow
(broadcast) and fuse into the same whole-stage-codegen pipeline. Reports that need no zone take
``add_derived_columns(conform(...))``, and the KPIs join the pick-up zone only. All calendar
columns need a session in UTC; another zone is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.checks import quoted
from tripmart.functions.hashing import ride_id
from tripmart.functions.temporal import in_hour_ranges, minutes_between, week_id, week_start
from tripmart.operators.dedup import ascending, keep_first
from tripmart.operators.bronze import one_airport_fee
from tripmart.operators.joins import MAX_BROADCAST_BYTES, broadcast_if_small, lookup
from tripmart.operators.metrics import _ts
from tripmart.session import ensure_utc

SILVER_NAMES = [n for n, _ in S.SILVER_TYPES]

# Types of the derived curated columns (used to fill absent ones with typed NULLs).
DERIVED_TYPES: dict[str, str] = {
    "ride_id": "string", "pickup_date": "date", "pickup_hour": "int",
    "pickup_day_of_week": "string", "pickup_year": "int", "pickup_week_of_year": "int",
    "pickup_week_start": "date", "pickup_week_id": "string", "trip_minutes": "double",
    "trip_hours": "double", "pu_borough": "string", "pu_zone": "string",
    "pu_service_zone": "string", "do_borough": "string", "do_zone": "string",
    "do_service_zone": "string", "revenue_per_mile": "double",
    "revenue_per_minute": "double", "trip_mph": "double", "is_peak_hour": "boolean",
    "is_night": "boolean", "is_weekend": "boolean",
}
CURATED_TYPES: dict[str, str] = {**{n: t.lower() for n, t in S.SILVER_TYPES}, **DERIVED_TYPES}


def standardize_trips(df: DataFrame) -> DataFrame:
    """Rename to silver names, fill absent columns with typed NULLs, enforce types.

    Casts are ``try_cast``: a value that does not fit (e.g. a BIGINT id above the INT
    range) becomes NULL instead of failing the job. The flag is upper-cased and
    trimmed. Columns outside the silver set pass through after the 20 silver ones.
    """
    df = one_airport_fee(df)
    renames = {src: dst for src, dst in S.SILVER_RENAMES.items()
               if src in df.columns and src != dst}
    if renames:
        df = df.withColumnsRenamed(renames)
    cols = []
    for name, sql_type in S.SILVER_TYPES:
        if name not in df.columns:
            c = F.lit(None).cast(sql_type)
        else:
            c = F.col(quoted(name)).try_cast(sql_type)
            if name == "store_and_fwd_flag":
                c = F.upper(F.trim(c))
        cols.append(c.alias(name))
    extras = [F.col(quoted(c)) for c in df.columns if c not in SILVER_NAMES]
    return df.select(*cols, *extras)


def zone_dimension(zones: DataFrame) -> DataFrame:
    """Zone lookup -> one row per integer ``location_id`` (J1, D2).

    Ids that are not integers are dropped (``try_cast``); repeated ids keep the first
    row in (LocationID, Borough, Zone, service_zone) order.
    """
    dim = (zones
           .withColumn("location_id", F.col("LocationID").try_cast("int"))
           .filter(F.col("location_id").isNotNull()))
    dim = keep_first(dim, ["location_id"], ascending(S.ZONE_COLUMNS))
    return dim.select(
        "location_id",
        F.trim("Borough").alias("borough"),
        F.trim("Zone").alias("zone"),
        F.trim("service_zone").alias("service_zone"),
    )


def join_zones(trips: DataFrame, zones: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
               sides: tuple[str, ...] = ("pu", "do")) -> DataFrame:
    """Left-join the zone lookup: pick-up -> ``pu_*``, drop-off -> ``do_*``. One size check for all sides."""
    dim = broadcast_if_small(zone_dimension(zones), max_broadcast_bytes)
    for side in sides:
        trips = lookup(trips, dim, f"{side}_location_id", side)
    return trips


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Calendar, duration, flag and ratio columns of a conformed trip."""
    ensure_utc(df.sparkSession)
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    hour = F.col("pickup_hour")
    minutes = F.col("trip_minutes")
    return (df
            .withColumns({"pickup_datetime": pickup.cast("timestamp"),
                          "dropoff_datetime": dropoff.cast("timestamp")})
            .withColumns({
                "pickup_date": F.to_date(pickup),
                "pickup_year": F.year(pickup),
                "pickup_week_of_year": F.weekofyear(pickup),
                "pickup_week_start": week_start(pickup),
                "pickup_week_id": week_id(pickup),
                "pickup_hour": F.hour(pickup),
                "pickup_day_of_week": F.date_format(pickup, "E"),
                "trip_minutes": minutes_between(pickup, dropoff),
            })
            .withColumns({
                "trip_hours": minutes / 60.0,
                "is_peak_hour": in_hour_ranges(hour, S.PEAK_HOUR_RANGES),
                "is_night": (hour >= S.SILVER_NIGHT_FROM_HOUR) | (hour < S.SILVER_NIGHT_BEFORE_HOUR),
                "is_weekend": F.dayofweek(pickup).isin(1, 7),
                "revenue_per_mile": F.when(F.col("trip_distance") > 0,
                                           F.col("total_amount") / F.col("trip_distance")),
                "revenue_per_minute": F.when(minutes > 0, F.col("total_amount") / minutes),
                "trip_mph": F.when(minutes > 0, F.col("trip_distance") / (minutes / 60.0)),
            }))


def fill_missing(df: DataFrame, names: list[str]) -> DataFrame:
    """Add typed NULL columns for the absent ones among ``names``."""
    missing = {n: F.lit(None).cast(CURATED_TYPES.get(n, "string"))
               for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def with_ride_id(df: DataFrame) -> DataFrame:
    """``ride_id`` = SHA-256 of vendor, pick-up time, week id, locations and total."""
    ensure_utc(df.sparkSession)
    if "pickup_week_id" not in df.columns:
        df = df.withColumn("pickup_week_id", week_id(F.col("pickup_datetime")))
    return df.withColumn("ride_id", ride_id(
        F.col("vendor_id"), F.col("pickup_datetime"), F.col("pickup_week_id"),
        F.col("pu_location_id"), F.col("do_location_id"), F.col("total_amount")))


def dedup_rides(df: DataFrame, key: str = "ride_id") -> DataFrame:
    """One row per ``key``: the first by the 20 conformed columns (a total order
    on distinct trips, so re-runs and task retries keep the same row)."""
    return keep_first(df, [key], ascending(SILVER_NAMES))


def finalize(df: DataFrame) -> DataFrame:
    """Fill absent columns (typed), add ``ride_id``, de-duplicate, order 42 columns."""
    df = fill_missing(df, SILVER_NAMES)
    deduped = dedup_rides(with_ride_id(df))
    return fill_missing(deduped, S.SILVER_ORDER).select(*S.SILVER_ORDER)


#: The pick-up second and whether a total is minus zero: with vendor, locations and total what the ride id is made of.
RIDE_KEY, MINUS_ZERO = "__ride_key", "__minus_zero"
IDENTITY = [RIDE_KEY, "vendor_id", "pu_location_id", "do_location_id", "total_amount", MINUS_ZERO]


def keyed(pass_trips: DataFrame, columns: Sequence[str] = SILVER_NAMES) -> DataFrame:
    """The conformed columns that :func:`first_rides` needs to give ``columns``, and the ride's identity.

    Two trips have the same ride id exactly when the identity is equal: the id's text holds the time to the second, and the
    week follows from it; minus zero and zero are equal numbers with different texts. The digest itself
    is made after the exchange, for the rides that are kept, and only where it is asked for.
    """
    ensure_utc(pass_trips.sparkSession)
    conformed = standardize_trips(pass_trips).select(*SILVER_NAMES)
    total = F.col("total_amount")
    return conformed.select(*_carried(columns), F.col("pickup_datetime").cast("long").alias(RIDE_KEY),
                            ((total == 0) & total.cast("string").startswith("-")).alias(MINUS_ZERO))


def _ties(columns: Sequence[str]) -> list[str]:
    """The conformed columns that choose among the copies of a ride, up to the last of ``columns``: among rows that
    are equal in these, the later ones change nothing that is asked for. The identity is equal in a group (the pick-up time isn't)."""
    free = [n for n in SILVER_NAMES if n not in IDENTITY]
    return free[:max((free.index(c) for c in columns if c in free), default=0) + 1]


def _carried(columns: Sequence[str]) -> list[str]:
    ties = _ties(columns)
    return [n for n in SILVER_NAMES if n in IDENTITY or n in ties]


def first_rides(rides: DataFrame, columns: Sequence[str] = SILVER_NAMES) -> DataFrame:
    """One row per ride, the first by the conformed columns: ``columns`` of it and those it is chosen by."""
    return keep_first(rides, IDENTITY, ascending(_ties(columns))).drop(RIDE_KEY, MINUS_ZERO)


def named_rides(rides: DataFrame) -> DataFrame:
    """Conformed rides with their ``ride_id`` as text."""
    return rides.withColumn("ride_id", ride_id(
        F.col("vendor_id"), F.col("pickup_datetime"), week_id(F.col("pickup_datetime")),
        F.col("pu_location_id"), F.col("do_location_id"), F.col("total_amount")))


def conform(pass_trips: DataFrame, columns: Sequence[str] = SILVER_NAMES) -> DataFrame:
    """Bronze pass trips -> one row per ``ride_id`` with the 20 conformed columns. A report that names the ``columns`` it reads
    gets the same rows with fewer columns to shuffle and sort."""
    return named_rides(first_rides(keyed(pass_trips, columns), columns))


def enrich(conformed: DataFrame, zones: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
           sides: tuple[str, ...] = ("pu", "do")) -> DataFrame:
    """Conformed trips with the zones of the given sides and all derived columns."""
    return add_derived_columns(join_zones(conformed, zones, max_broadcast_bytes, sides))


def curate(pass_trips: DataFrame, zones: DataFrame,
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Bronze pass trips + bronze zones -> curated silver trips (42 columns)."""
    return enrich(conform(pass_trips), zones, max_broadcast_bytes).select(*S.SILVER_ORDER)


#: Year and ISO week as a number, in the order of the week ids.
WEEK_NUMBER = "__week"


def _week_number() -> Column:
    return F.year("pickup_datetime") * 100 + F.weekofyear("pickup_datetime")


def by_week(rides: DataFrame) -> DataFrame:
    """Conformed trips in ranges of (week, pick-up time, identity): each task holds few weeks, a large week takes several."""
    return rides.repartitionByRange(_week_number(), "pickup_datetime", "vendor_id", "pu_location_id",
                                    "do_location_id", "total_amount")


def curate_by_week(pass_trips: DataFrame, zones: DataFrame,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The rows of :func:`curate`, laid out for a write that readers can prune by week.

    The narrow conformed rows are dealt out by ranges before the zones are attached (broadcast lookups keep that
    layout), and each task is sorted by week and pick-up time: its row groups hold few weeks, and so do their pages. A zone
    dimension too large to broadcast shuffles the rows by location; the sort inside the tasks remains. The ride ids and the
    derived columns are made of the sorted rows, so the sort doesn't hold them.
    """
    rides = join_zones(by_week(first_rides(keyed(pass_trips))), zones, max_broadcast_bytes)
    ordered = rides.withColumn(WEEK_NUMBER, _week_number()).sortWithinPartitions(WEEK_NUMBER, "pickup_datetime")
    return add_derived_columns(named_rides(ordered)).select(*S.SILVER_ORDER)


def weekly_summary(curated: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Rows, revenue and miles per (week id, week start)."""
    return (curated.groupBy("pickup_week_id", "pickup_week_start")
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.sum("total_amount").alias("total_revenue"),
                 F.sum("trip_distance").alias("total_miles"))
            .withColumn("run_ts", _ts(run_ts)))
