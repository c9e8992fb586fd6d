"""Layer jobs: read a layer, transform it, write the next one.

Scan economy at scale:

* **bronze trips** - one job. The flagged trips are written once, partitioned by
  ``dq_status`` (``pass`` / ``reject`` / ``indeterminate``), and every metric (counts,
  NULL shares, per-check pass/fail) is collected *during that write* with
  ``DataFrame.observe``. Observed metrics of a result stage are merged once per
  partition, so a retried task does not count twice. The metric tables are then
  formatted from that one row.
* **silver** - reads only the pass partition and the columns it needs, two shuffles of
  narrow rows (de-duplication, then ranges of weeks, so that readers can skip row groups); the weekly
  summary reads the *written* curated table (four columns) instead of recomputing the lineage.
* **gold** - aggregates the curated table (partial aggregation) once, keeps the small
  KPI table (weeks x boroughs) in memory, writes it partitioned by week and derives the
  previews and the run summary from it.

Every hand-over is a written table, which also cuts the lineage: a lost executor
costs a re-run of its tasks in the current job only.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.operators import bronze, gold, metrics, silver
from tripmart.session import ensure_utc
from tripmart.sources import readers, sinks, versions
from tripmart.sources.sinks import write_if_rows, write_if_schema

TRIPS_DIR = "trips"


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------

def run_bronze_zones(raw_zones: DataFrame, out_base: str,
                     run_ts: datetime | None = None) -> dict[str, bool]:
    """Zone lookup -> ``full_dq_checked`` (all rows, flagged) + two metric tables."""
    run_ts = run_ts or metrics.now_utc()
    checked = bronze.bronze_zones(raw_zones)
    summary, nulls = metrics.zone_metrics(checked, run_ts)
    return {
        S.ZONES_DIR: write_if_rows(checked, f"{out_base}/{S.ZONES_DIR}"),
        S.ZONE_SUMMARY_DIR: write_if_schema(summary, f"{out_base}/{S.ZONE_SUMMARY_DIR}"),
        S.ZONE_NULLS_DIR: write_if_schema(nulls, f"{out_base}/{S.ZONE_NULLS_DIR}"),
    }


def run_bronze_trips(raw: DataFrame, out_base: str, run_ts: datetime | None = None,
                     split_folders: bool = False, run_id: str | None = None, versioned: bool = False,
                     balanced: bool = False) -> DataFrame:
    """Raw trips -> ``trips/dq_status=*`` + ``_run_summary_*`` tables, one scan.

    Returns the unified metric table (``METRIC_SCHEMA``). With ``split_folders`` the splits are also
    written as folders of their own: ``pass`` (without flags), ``_rejects`` and ``_indeterminate``.
    Without a raw row no trips are written, and those of an older run are emptied. The counts are kept as
    ``_metric_state`` rows of ``run_id`` (the run's time if not given), which :func:`metrics.merged_metrics` adds up over runs.
    With ``versioned`` the trips are a new version (:mod:`tripmart.sources.versions`) that is published once it is whole.

    Each task writes up to three files. With ``balanced`` the flagged trips are first dealt out by status and size, so the
    number of files follows from the bytes and not from the number of input splits, at the price of one shuffle
    of all trips; the counts are then taken behind that exchange, still in the stage that writes.
    """
    spark = raw.sparkSession
    ensure_utc(spark)
    run_ts = run_ts or metrics.now_utc()
    flagged = bronze.flag_trips(raw)
    aggs = metrics.trip_metric_aggregates(flagged)
    labelled = flagged.withColumn(S.DQ_STATUS, bronze.dq_status())
    if balanced:
        labelled = labelled.hint("rebalance", F.col(S.DQ_STATUS))
    obs = Observation("bronze_trip_metrics")
    path = f"{out_base}/{TRIPS_DIR}"
    if raw.isEmpty():  # cheaper than asking the flagged rows
        if versioned:
            versions.write(spark.createDataFrame([], labelled.schema), path, (S.DQ_STATUS,))
        else:
            sinks.replace_by_empty(spark, path, labelled.schema)
        values = {}
    else:
        target = versions.stage(path) if versioned else path
        with sinks.few_partition_values(spark):  # three statuses: no sort of the trips by status
            labelled.observe(obs, *metrics.named(aggs)).write.mode("overwrite").partitionBy(S.DQ_STATUS).parquet(
                target, compression=sinks.FACT_CODEC)
        values = obs.get
        if versioned:
            versions.publish(spark, path, target, labelled.schema)
    if split_folders:
        for status, folder in S.SPLIT_DIRS.items():
            part = read_bronze(spark, out_base, status)
            if part is not None:
                write_if_rows(part, f"{out_base}/{folder}")
    state = metrics.state_of(spark, run_id or run_ts.isoformat(), aggs, values)
    write_if_schema(state, f"{out_base}/{S.METRIC_STATE_DIR}")
    totals = _totals_frame(spark, aggs, values)
    all_rows = None
    for name, part in S.RUN_SUMMARY_DIRS.items():
        frame = metrics.trip_metric_rows(totals, flagged.columns, (part,), run_ts)
        write_if_schema(frame, f"{out_base}/{name}")
        all_rows = frame if all_rows is None else all_rows.unionByName(frame)
    write_if_schema(all_rows, f"{out_base}/{S.RUN_SUMMARY_ALL_DIR}")
    return spark.read.parquet(f"{out_base}/{S.RUN_SUMMARY_ALL_DIR}")


def bronze_outcomes(raw: DataFrame, split_folders: bool = True, base: str | None = None) -> DataFrame:
    """Run the bronze trip job into the shared folder (``base``, if given) and report what it wrote: (output, written,
    rows) per split folder. ``written`` is looked up in the file system, rows are read back."""
    from tripmart.session import scratch_path

    spark = raw.sparkSession
    base = base or scratch_path(spark, "bronze-job")
    run_bronze_trips(raw, base, split_folders=split_folders)
    out = None
    for folder in S.SPLIT_DIRS.values():
        there = sinks.exists(spark, f"{base}/{folder}")
        rows = spark.read.parquet(f"{base}/{folder}") if there else spark.range(0)
        part = rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(folder).alias("output"), F.lit(there).alias("written"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def _totals_frame(spark: SparkSession, aggs: dict, values: dict) -> DataFrame:
    """The observed aggregate values as a one-row frame (one column per aggregate)."""
    names = list(aggs)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    row = tuple(int(values.get(n, 0) or 0) for n in names)
    return spark.createDataFrame([row], schema)


def read_bronze(spark: SparkSession, base: str, status: str = "pass") -> DataFrame | None:
    """One bronze split (partition pruning), or None if no trips were ever written. The pass split
    comes without the flags."""
    if not sinks.exists(spark, f"{base}/{TRIPS_DIR}"):
        return None
    df = versions.read(spark, f"{base}/{TRIPS_DIR}")
    if df is None:
        if sinks.exists(spark, f"{base}/{TRIPS_DIR}/{versions.VERSIONS_DIR}"):  # a first run that was never published
            return None
        df = spark.read.parquet(f"{base}/{TRIPS_DIR}")
    df = df.where(F.col(S.DQ_STATUS) == status)
    if status == "pass":
        drop = [c for c in df.columns if c.startswith(S.CHECK_PREFIX)] + [S.DQ_PASS, S.DQ_STATUS]
        return df.drop(*drop)
    return df.drop(S.DQ_STATUS)


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

def curated_schema() -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(silver.CURATED_TYPES[n])) for n in S.SILVER_ORDER])


def run_silver(spark: SparkSession, bronze_base: str, zones_path: str, out_base: str,
               run_ts: datetime | None = None, versioned: bool = False) -> dict[str, bool]:
    """Bronze pass + bronze zones -> ``curated`` + ``_run_summary_weekly``.

    Without a passing trip nothing is written, and an older run's tables are emptied. With ``versioned`` the
    curated trips are a new version that is published once it is whole (an empty one without a passing trip).
    """
    ensure_utc(spark)
    run_ts = run_ts or metrics.now_utc()
    curated_path, weekly_path = f"{out_base}/{S.CURATED_DIR}", f"{out_base}/{S.WEEKLY_DIR}"
    passed = read_bronze(spark, bronze_base, "pass")
    if passed is None or passed.isEmpty():  # curated is empty exactly when its input is
        empty = spark.createDataFrame([], curated_schema())
        if versioned:
            versions.write(empty, curated_path)
        else:
            sinks.replace_by_empty(spark, curated_path, curated_schema())
        sinks.replace_by_empty(spark, weekly_path, silver.weekly_summary(empty, run_ts).schema)
        return {S.CURATED_DIR: False, S.WEEKLY_DIR: False}
    zones = readers.read_nonempty(spark, zones_path)
    if zones is None:  # no zone at all: every lookup finds nothing
        zones = spark.createDataFrame([], S.ZONE_SCHEMA)
    curated = silver.curate_by_week(passed, zones)
    if versioned:
        versions.write(curated, curated_path)
    else:
        curated.write.mode("overwrite").parquet(curated_path, compression=sinks.FACT_CODEC)
    # A non-empty curated table has at least one week: no emptiness probe needed.
    written = spark.read.parquet(versions.resolve(spark, curated_path) if versioned else curated_path)
    sinks.single_file(silver.weekly_summary(written, run_ts)).write.mode(
        "overwrite").parquet(weekly_path)
    return {S.CURATED_DIR: True, S.WEEKLY_DIR: True}


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

def run_gold(spark: SparkSession, silver_curated: str, gold_path: str, preview_base: str,
             run_id: str | None = None, run_ts: datetime | None = None, versioned: bool = False) -> DataFrame | None:
    """Curated silver -> gold KPIs (partitioned by week), 6 CSV previews, JSON summary.

    Returns the run summary as written, or None when silver is missing or holds no row; then an older
    run's outputs are emptied. With ``versioned`` the KPIs are a new version that is published once it is whole.
    """
    ensure_utc(spark)
    run_id = run_id or datetime.now().strftime("%Y%m%d_%H%M%S")
    previews = {S.FULL_PREVIEW: gold.kpi_preview} | {
        c: (lambda kpis, c=c: gold.kpi_slice(kpis, c)) for c in S.KPI_SLICES}
    stamp = (run_ts or metrics.now_utc()).isoformat().replace("+00:00", "Z")  # ISO instant
    summary_path = f"{preview_base}/run_summary"
    silver_df = readers.read_nonempty(spark, silver_curated)
    if silver_df is None:
        none = gold.weekly_kpis(spark.createDataFrame([], curated_schema()), ordered=False)
        if not versioned:
            sinks.replace_by_empty(spark, gold_path, none.schema)
        elif versions.current(spark, gold_path):
            versions.write(none, gold_path, ("pickup_week_id",))
        for name, make in previews.items():
            sinks.replace_by_empty(spark, f"{preview_base}/{name}", make(none).schema, "csv")
        sinks.replace_by_empty(spark, summary_path, gold.run_summary(none, "", "", "", "").schema, "json")
        return None
    # The KPI table is small (weeks x boroughs): aggregate once, keep it for the gold
    # write and the seven small outputs instead of re-listing every week partition.
    kpis = gold.weekly_kpis(silver_df, ordered=False).persist()
    try:
        if versioned:
            versions.write(kpis.repartition("pickup_week_id"), gold_path, ("pickup_week_id",))
        else:
            sinks.write_gold(kpis, gold_path)
        for name, make in previews.items():
            sinks.write_csv_preview(make(kpis), f"{preview_base}/{name}")
        sinks.write_json(gold.run_summary(kpis, run_id, stamp, silver_curated, gold_path), summary_path)
    finally:
        kpis.unpersist()
    return spark.read.json(summary_path)


# ---------------------------------------------------------------------------
# All layers
# ---------------------------------------------------------------------------

def run_all(spark: SparkSession, raw_trips: DataFrame, raw_zones: DataFrame, out_base: str,
            trips_name: str = "trips", zones_name: str = "zones") -> dict[str, str]:
    """Bronze (zones, trips) -> silver -> gold under ``out_base``; returns the paths.

    A layer without rows is skipped, and so are those above it; none of them leaves an older run's
    table readable as current.
    """
    run_ts = metrics.now_utc()
    p = {
        "bronze_zones": f"{out_base}/bronze/{zones_name}",
        "bronze_trips": f"{out_base}/bronze/{trips_name}",
        "silver": f"{out_base}/silver/{trips_name}",
        "gold": f"{out_base}/gold/{trips_name}",
        "gold_preview": f"{out_base}/gold_preview/{trips_name}",
    }
    run_bronze_zones(raw_zones, p["bronze_zones"], run_ts)
    run_bronze_trips(raw_trips, p["bronze_trips"], run_ts)
    run_silver(spark, p["bronze_trips"], f"{p['bronze_zones']}/{S.ZONES_DIR}", p["silver"], run_ts)
    run_gold(spark, f"{p['silver']}/{S.CURATED_DIR}", p["gold"], p["gold_preview"])
    return p
