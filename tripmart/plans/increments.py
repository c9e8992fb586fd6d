"""Increments: a run that brings some trips in, and replaces only the weeks it touches.

* **silver** - curated trips by week (``pickup_week_id`` is the partition column). A ride's key holds its pick-up time, so all
  copies of a ride lie in one week: the run finds its weeks, reads only those partitions of what is
  already curated, keeps the first of every ride over old and new together (one exchange for both), and
  overwrites those partitions. The result of several overlapping runs, in any order, is that of one run over all
  their input. A repeated run changes nothing, so a run that was cut off is simply started again.
* **gold** - KPIs and weekly summary of the touched weeks, from the curated partitions of those weeks.

Weeks are few (some 53 a year, whatever the trips), so a run's weeks are held by the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.temporal import week_id
from tripmart.operators import gold, silver
from tripmart.plans import jobs
from tripmart.session import ensure_utc
from tripmart.sources import readers, sinks

WEEK = "pickup_week_id"
CURATED_WEEKS_DIR = "curated_by_week"
WEEKLY_WEEKS_DIR = "_weekly_by_week"


def read_curated(spark: SparkSession, silver_base: str, weeks: list[str] | None = None) -> DataFrame | None:
    """Curated trips in column order; with ``weeks`` only those partitions are read. None if there are none yet."""
    path = f"{silver_base}/{CURATED_WEEKS_DIR}"
    if not sinks.exists(spark, path):
        return None
    df = spark.read.schema(jobs.curated_schema()).parquet(path).select(*S.SILVER_ORDER)
    return df if weeks is None else df.where(F.col(WEEK).isin(weeks))


def touched_weeks(passed: DataFrame) -> list[str]:
    """The week ids of a run's passing trips."""
    pickup = silver.standardize_trips(passed).select(week_id(F.col("pickup_datetime")).alias("w"))
    return sorted(r.w for r in pickup.distinct().collect())


def merged_rides(passed: DataFrame, old: DataFrame | None) -> DataFrame:
    """One row per ride over new passing trips and old curated ones, with the 20 conformed columns."""
    keyed = silver.keyed(passed)
    if old is not None:
        keyed = keyed.unionByName(silver.keyed(old))
    return silver.named_rides(silver.first_rides(keyed))


def run_silver(spark: SparkSession, bronze_base: str, zones_path: str, silver_base: str) -> list[str]:
    """Merges one bronze output into the curated weeks; returns the weeks it touched."""
    ensure_utc(spark)
    passed = jobs.read_bronze(spark, bronze_base, "pass")
    if passed is None:
        return []
    weeks = touched_weeks(passed)
    if weeks:
        zones = readers.read_nonempty(spark, zones_path)
        if zones is None:
            zones = spark.createDataFrame([], S.ZONE_SCHEMA)
        rides = merged_rides(passed, read_curated(spark, silver_base, weeks))
        # the narrow rides are dealt out, not the 42 columns derived from them: broadcast lookups keep that layout
        pickup = F.col("pickup_datetime")
        narrow = rides.drop("ride_id").withColumn("__week", F.year(pickup) * 100 + F.weekofyear(pickup))
        dealt = silver.named_rides(sinks.weeks_by_size(narrow, "__week").drop("__week"))
        sinks.write_dealt_weeks(silver.enrich(dealt, zones).select(*S.SILVER_ORDER), f"{silver_base}/{CURATED_WEEKS_DIR}")
    return weeks


def run_gold(spark: SparkSession, silver_base: str, gold_path: str, weeks: list[str],
             run_ts: datetime | None = None) -> None:
    """KPIs and weekly summary of the given weeks replace those weeks' partitions."""
    ensure_utc(spark)
    curated = read_curated(spark, silver_base, weeks) if weeks else None
    if curated is not None:
        sinks.write_weeks(gold.weekly_kpis(curated, ordered=False), gold_path)
        sinks.write_weeks(silver.weekly_summary(curated, run_ts), f"{silver_base}/{WEEKLY_WEEKS_DIR}")


def run(spark: SparkSession, raw_trips: DataFrame, raw_zones: DataFrame, out_base: str, run_id: str,
        run_ts: datetime | None = None) -> list[str]:
    """One increment through all layers; bronze keeps a folder per run. Returns the weeks it touched."""
    bronze_base, zones_base = f"{out_base}/bronze/{run_id}", f"{out_base}/bronze_zones/{run_id}"
    jobs.run_bronze_zones(raw_zones, zones_base, run_ts)
    jobs.run_bronze_trips(raw_trips, bronze_base, run_ts, run_id=run_id)
    weeks = run_silver(spark, bronze_base, f"{zones_base}/{S.ZONES_DIR}", f"{out_base}/silver")
    run_gold(spark, f"{out_base}/silver", f"{out_base}/gold", weeks, run_ts)
    return weeks
