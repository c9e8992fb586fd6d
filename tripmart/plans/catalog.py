"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the whole tables (``lineitem``, ``nation``, ``region``) through the
fixture mapping and runs a layer of the pipeline on all of it. Timestamps leave as
``timestamp_ntz`` and run-time stamps are left out, so results can be compared with
the SQL oracle row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.operators import bronze, gold, inspect, integrity, metrics, silver
from tripmart.operators.joins import broadcast_if_small, orphans
from tripmart.plans import increments, jobs, previews
from tripmart.session import COMPILED_METHOD_BYTES, scratch_path
from tripmart.sources import fixtures as fx
from tripmart.sources import drift, readers, sinks, versions

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# Layer builders
# ---------------------------------------------------------------------------

def trips_raw(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_trips(spark, sf, deal=True)


def zones_raw(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_zones(spark, sf)


def zones_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.bronze_zones(zones_raw(spark, sf))


def trips_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.flag_trips(trips_raw(spark, sf))


def trips_pass(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.split_flagged(trips_flagged(spark, sf)).passed


#: The conformed columns that calendar, duration and ratio columns are derived from.
REPORTED = ("pickup_datetime", "dropoff_datetime", "trip_distance", "total_amount")
#: ... and those the KPIs read.
KPI_READ = (*REPORTED, "pu_location_id")


def trips_conformed(spark: SparkSession, sf: str, columns: Sequence[str]) -> DataFrame:
    """De-duplicated conformed trips with the columns of a report: what every report without zones starts from."""
    return silver.conform(trips_pass(spark, sf), columns)


def trips_reported(spark: SparkSession, sf: str) -> DataFrame:
    return silver.add_derived_columns(trips_conformed(spark, sf, REPORTED))


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return silver.curate(trips_pass(spark, sf), zones_bronze(spark, sf))


def kpi_input(spark: SparkSession, sf: str) -> DataFrame:
    """The KPIs need the pick-up zone only."""
    return silver.enrich(trips_conformed(spark, sf, KPI_READ), zones_bronze(spark, sf), sides=("pu",))


def kpis(spark: SparkSession, sf: str, ordered: bool = False) -> DataFrame:
    return gold.weekly_kpis(kpi_input(spark, sf), ordered=ordered)


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return silver.weekly_summary(trips_reported(spark, sf)).drop("run_ts")


def text_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.flag_trips(fx.raw_trips_text(spark, sf))


# ---------------------------------------------------------------------------
# Output shaping
# ---------------------------------------------------------------------------

def for_compare(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> ``timestamp_ntz`` (UTC wall clock); drop ``run_ts``."""
    cols = []
    for f in df.schema.fields:
        if f.name == "run_ts":
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _metric(part: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return metrics.trip_metrics(trips_flagged(spark, sf), parts=(part,))
    return q


def _slice(column: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return gold.kpi_slice(kpis(spark, sf), column)
    return q


def _orphans(key: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        dim = broadcast_if_small(silver.zone_dimension(zones_bronze(spark, sf)).select("location_id"))
        return orphans(trips_conformed(spark, sf, (key,)), dim, key).groupBy(key).agg(F.count(F.lit(1)).alias("orphan_trips"))
    return q


def _kpis_derived_flags(spark: SparkSession, sf: str, *also: str) -> DataFrame:
    return gold.weekly_kpis(kpi_input(spark, sf).drop("is_peak_hour", "is_night", *also), ordered=False)


def _layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    # counted over the columns of the KPIs, so that both share one exchange
    return inspect.layer_row_counts({
        "raw": trips_raw(spark, sf), "bronze_pass": trips_pass(spark, sf),
        "silver_curated": trips_conformed(spark, sf, KPI_READ), "gold_kpis": kpis(spark, sf)})


def _without(*columns: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return metrics.trip_metrics(bronze.flag_trips(fx.raw_trips_text(spark, sf).drop(*columns)))
    return q


def _all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Zone and trip metrics in one table (P23, U1)."""
    summary, nulls = metrics.zone_metrics(zones_bronze(spark, sf))
    return (metrics.unify(summary, "zone_counts").unionByName(metrics.unify(nulls, "zone_nulls"))
            .unionByName(metrics.unify(_summary_all(spark, sf), "trips")))


# -- queries over what the jobs wrote -----------------------------------------

def _zone_job(folder: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        base = scratch_path(spark, "zone-job")
        jobs.run_bronze_zones(zones_raw(spark, sf), base)
        return spark.read.parquet(f"{base}/{folder}")
    return q


def _trip_job(spark: SparkSession, sf: str) -> DataFrame:
    """All five metric tables of one run of the trip job."""
    base = scratch_path(spark, "trip-job")
    jobs.run_bronze_trips(trips_raw(spark, sf), base)
    out = None
    for name in (*S.RUN_SUMMARY_DIRS, S.RUN_SUMMARY_ALL_DIR):
        part = spark.read.parquet(f"{base}/{name}").withColumn("output", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def _silver_job(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "silver-job")
    jobs.run_bronze_zones(zones_raw(spark, sf), f"{base}/zones")
    jobs.run_bronze_trips(trips_raw(spark, sf), f"{base}/trips")
    jobs.run_silver(spark, f"{base}/trips", f"{base}/zones/{S.ZONES_DIR}", f"{base}/silver")
    return f"{base}/silver"


def _silver_report(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return previews.silver_preview(spark, _silver_job(spark, sf))[name]
    return q


def _gold_report(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "gold-report")
        sinks.write_gold(kpis(spark, sf), path)
        return _rounded_means(previews.gold_preview(spark, path)[name])
    return q


def _empty_writes(spark: SparkSession, sf: str) -> DataFrame:
    """What the trip job writes for all trips, for passing ones only and for rejected ones only."""
    raw, base = trips_raw(spark, sf), scratch_path(spark, "bronze-job")
    out = jobs.bronze_outcomes(raw, base=base).withColumn("input", F.lit("all"))
    # the flagged trips as that run wrote them: the raw rows are made and flagged once for the inputs that follow
    path = f"{base}/{jobs.TRIPS_DIR}"  # not there without a trip
    flagged = spark.read.parquet(path).drop(S.DQ_STATUS) if sinks.exists(spark, path) else trips_flagged(spark, sf)
    parts = bronze.split_flagged(flagged)
    for name, rows in (("passing", parts.passed), ("rejected", parts.rejects)):
        part = jobs.bronze_outcomes(rows.select(*raw.columns)).withColumn("input", F.lit(name))
        out = out.unionByName(part)
    return out


# -- inputs that drift, increments, metrics across runs -----------------------

def _drifted(spark: SparkSession, sf: str) -> DataFrame:
    paths = fx.write_drifted_trips(trips_raw(spark, sf), scratch_path(spark, "drifted"))
    return drift.read_parquet(spark, *paths)


def _zones_reordered(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "zones-reordered")
    fx.write_drifted_zones(zones_raw(spark, sf), path)
    return readers.read_zones_csv(spark, path, corrupt="bad_line")


def _two_inputs(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two inputs that share trips: the second touches every other week only."""
    day, week = F.dayofmonth("tpep_pickup_datetime"), F.weekofyear("tpep_pickup_datetime")
    trips = trips_raw(spark, sf)
    return [trips.where(day <= 20), trips.where((day >= 15) & (week % 2 == 1))]


def _increments(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "increments")
    for i, trips in enumerate(_two_inputs(spark, sf)):
        increments.run(spark, trips, zones_raw(spark, sf), base, f"run{i}")
    return base


def _merged_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of three runs over parts of the trips, added up."""
    base = scratch_path(spark, "metric-runs")
    hour = F.hour("tpep_pickup_datetime")
    for i in range(3):
        jobs.run_bronze_trips(trips_raw(spark, sf).where(hour % 3 == i), f"{base}/run{i}", run_id=f"run{i}")
    return metrics.merged_metrics(spark.read.parquet(*[f"{base}/run{i}/{S.METRIC_STATE_DIR}" for i in range(3)]))


def _written_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of written layers, from their files' footers."""
    base = scratch_path(spark, "counted-layers")
    jobs.run_all(spark, trips_raw(spark, sf), zones_raw(spark, sf), base)
    return readers.written_row_counts(spark, {
        "bronze_trips": f"{base}/bronze/trips/{jobs.TRIPS_DIR}", "silver_curated": f"{base}/silver/trips/{S.CURATED_DIR}",
        "gold_kpis": f"{base}/gold/trips", "missing": f"{base}/nothing"})


# -- layers that change in one step ---------------------------------------------

def _versioned(spark: SparkSession, sf: str, gold_too: bool = False) -> str:
    """Layers in versions: a run over the trips of even hours, one over all trips, and then one whose write of odd
    weeks was cut off before it was published, in every layer."""
    base, trips, zones = scratch_path(spark, "versions"), trips_raw(spark, sf), zones_raw(spark, sf)
    for part in (trips.where(F.hour("tpep_pickup_datetime") % 2 == 0), trips):
        jobs.run_bronze_zones(zones, f"{base}/zones")
        jobs.run_bronze_trips(part, f"{base}/bronze", versioned=True)
        jobs.run_silver(spark, f"{base}/bronze", f"{base}/zones/{S.ZONES_DIR}", f"{base}/silver", versioned=True)
        if gold_too:
            jobs.run_gold(spark, f"{base}/silver/{S.CURATED_DIR}", f"{base}/gold", f"{base}/preview", versioned=True)
    for layer in (f"bronze/{jobs.TRIPS_DIR}", f"silver/{S.CURATED_DIR}", *["gold"] * gold_too):
        rows = versions.read(spark, f"{base}/{layer}")
        week = "tpep_pickup_datetime" if layer.startswith("bronze") else "pickup_week_start"
        rows.where(F.weekofyear(week) % 2 == 1).write.parquet(
            versions.stage(f"{base}/{layer}"), compression=sinks.FACT_CODEC)
    return base


# -- the whole gold job --------------------------------------------------------

STAMP = datetime(2025, 2, 3, 4, 5, 6, tzinfo=timezone.utc)


def _gold_job(spark: SparkSession, silver_df: DataFrame | None) -> tuple[str, DataFrame | None]:
    base = scratch_path(spark, "gold-job")
    if silver_df is not None:
        silver_df.write.parquet(f"{base}/curated")
    return base, jobs.run_gold(spark, f"{base}/curated", f"{base}/gold", f"{base}/preview", "run-7", STAMP)


def _gold_job_previews(spark: SparkSession, sf: str) -> DataFrame:
    """All six preview files of one gold job, read back and put as (preview, week, borough, column, value)."""
    base, _ = _gold_job(spark, curated(spark, sf))
    out = None
    for name in (S.FULL_PREVIEW, *S.KPI_SLICES):
        rows = readers.read_preview_csv(spark, f"{base}/preview/{name}")
        values = [c for c in rows.columns if c not in ("pickup_week_id", "pickup_week_start", "pu_borough")]
        part = rows.select(F.lit(name).alias("preview"), "pickup_week_id", "pu_borough", F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in values])))
        out = part if out is None else out.unionByName(part)
    return out


def _gold_job_summary(spark: SparkSession, sf: str) -> DataFrame:
    base, summary = _gold_job(spark, curated(spark, sf))
    return summary.withColumns({c: F.replace(c, F.lit(base), F.lit("")) for c in ("silver_path", "gold_path")}).withColumnRenamed(
        "run_ts", "stamp")


def _gold_job_empty(spark: SparkSession, sf: str) -> DataFrame:
    """What a gold job over no silver trip, and over no silver layer, gives back and writes."""
    out = None
    for name, silver_df in (("empty", curated(spark, sf).limit(0)), ("missing", None)):
        base, summary = _gold_job(spark, silver_df)
        written = [sinks.exists(spark, f"{base}/{p}") for p in ("gold", "preview")]
        part = kpis(spark, sf).agg(F.count(F.lit(1)).alias("full_kpis")).select(
            F.lit(name).alias("case"), F.lit(summary is not None).alias("summary"), F.lit(any(written)).alias("written"), "full_kpis")
        out = part if out is None else out.unionByName(part)
    return out


def _summary_all(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.trip_metrics(trips_flagged(spark, sf))


def _rounded_means(df: DataFrame) -> DataFrame:
    """Means of ratios depend on the summation order in the last bits: compare at 1e-6."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("mean_")})


def _split(part: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return getattr(bronze.split_flagged(trips_flagged(spark, sf)), part)
    return q


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

_QUERIES: dict[str, Query] = {
    # fixture mapping, S1
    "trips_raw": trips_raw,
    "zones_raw": zones_raw,
    # bronze zones: P1-P7, A2, A4
    "zone_normalized": lambda s, sf: bronze.normalize_zones(zones_raw(s, sf)),
    "zone_checks": zones_bronze,
    "zone_summary": lambda s, sf: metrics.check_summary(zones_bronze(s, sf)),
    "zone_null_pct": lambda s, sf: metrics.null_percentages(zones_bronze(s, sf), S.ZONE_COLUMNS),
    # bronze trips: P8-P22
    "trip_normalized": lambda s, sf: bronze.clean_trips(trips_raw(s, sf)),
    "trip_type_checks": lambda s, sf: bronze.add_type_checks(bronze.clean_trips(trips_raw(s, sf))),
    "trip_domain_checks": lambda s, sf: bronze.add_domain_checks(bronze.clean_trips(trips_raw(s, sf))),
    "trip_flagged": trips_flagged,
    "trip_pass": _split("passed"),
    "trip_rejects": _split("rejects"),
    "trip_indeterminate": _split("indeterminate"),
    # bronze metrics: A1, A3, A6, A7, P23, U1
    "trip_totals": _metric("counts"),
    "trip_null_pct": _metric("nulls"),
    "trip_check_metrics": _metric("checks"),
    "domain_range_all": _metric("domain_range"),
    "summary_all": _summary_all,
    "all_metrics": _all_metrics,
    # all-text input, with junk in every column and NaN distances; columns missing
    "trip_type_checks_text": lambda s, sf: bronze.add_type_checks(bronze.clean_trips(fx.raw_trips_text(s, sf))),
    "trip_domain_checks_text": lambda s, sf: bronze.add_domain_checks(bronze.clean_trips(fx.raw_trips_text(s, sf))),
    "summary_all_text": _without(),
    "summary_all_missing_columns": _without("VendorID", "cbd_congestion_fee"),
    # silver: P25-P41, J1-J3, D1, D2
    "trips_standardized": lambda s, sf: silver.standardize_trips(trips_pass(s, sf)),
    "zone_dimension": lambda s, sf: silver.zone_dimension(zones_bronze(s, sf)),
    "trips_with_zones": lambda s, sf: silver.join_zones(
        silver.standardize_trips(trips_pass(s, sf)), zones_bronze(s, sf)),
    "trips_derived": lambda s, sf: silver.add_derived_columns(silver.join_zones(
        silver.standardize_trips(trips_pass(s, sf)), zones_bronze(s, sf))),
    "ride_ids": lambda s, sf: silver.with_ride_id(
        silver.standardize_trips(trips_pass(s, sf))).select(
            "ride_id", "vendor_id", "pickup_datetime", "pickup_week_id",
            "pu_location_id", "do_location_id", "total_amount"),
    "curated": curated,
    # J4
    "trip_zone_ref_checks": lambda s, sf: integrity.add_zone_ref_checks(
        trips_flagged(s, sf), zones_bronze(s, sf)),
    "orphan_pickup_zones": _orphans("pu_location_id"),
    "orphan_dropoff_zones": _orphans("do_location_id"),
    # silver weekly summary and gold KPIs: A8, A9, P42-P47, O1
    "weekly_summary": weekly,
    "weekly_kpis": lambda s, sf: kpis(s, sf, ordered=True),
    "weekly_kpis_derived_flags": _kpis_derived_flags,
    "weekly_kpis_derived_hour": lambda s, sf: _kpis_derived_flags(s, sf, "pickup_hour"),
    # previews: P48, O2, O3
    **{f"slice_{c}": _slice(c) for c in S.KPI_SLICES},
    "full_kpis_500": lambda s, sf: gold.kpi_preview(kpis(s, sf)),
    # A10, D3
    "run_summary": lambda s, sf: gold.run_totals(kpis(s, sf)),
    # A11, A12, O4-O7
    "silver_kpi_overview": lambda s, sf: inspect.silver_overview(trips_reported(s, sf)),
    "gold_kpi_overview": lambda s, sf: _rounded_means(gold.kpi_overview(kpis(s, sf))),
    "top_week_boroughs": lambda s, sf: gold.top_week_boroughs(kpis(s, sf)),
    "silver_sample": lambda s, sf: inspect.silver_sample(curated(s, sf)),
    "gold_sample": lambda s, sf: gold.kpi_sample(kpis(s, sf)),
    "weekly_summary_sorted": lambda s, sf: inspect.weekly_summary_sorted(weekly(s, sf)),
    # layer comparison: N1-N5
    "layer_row_counts": _layer_counts,
    "layer_row_delta": lambda s, sf: inspect.layer_row_delta(
        trips_pass(s, sf), trips_conformed(s, sf, ()), "bronze_pass", "silver_curated"),
    "layer_column_diff": lambda s, sf: inspect.layer_column_diff(
        trips_pass(s, sf), curated(s, sf)),
    "layer_schema": lambda s, sf: inspect.layer_schema(curated(s, sf)),
    "layer_sample": lambda s, sf: inspect.layer_sample(curated(s, sf), ["ride_id"]),
    # sources and sinks: K1-K9, S2-S7, O8, A5
    "parquet_roundtrip": lambda s, sf: readers.roundtrip_parquet(trips_pass(s, sf)),
    "partitioned_gold_roundtrip": lambda s, sf: readers.roundtrip_gold(kpis(s, sf)),
    "csv_preview_roundtrip": lambda s, sf: readers.roundtrip_preview(
        gold.kpi_slice(kpis(s, sf), "weekly_trips")),
    "json_summary_roundtrip": lambda s, sf: readers.roundtrip_run_summary(kpis(s, sf)),
    "zones_csv_scan": lambda s, sf: readers.roundtrip_zones_csv(zones_raw(s, sf)),
    "first_available_source": lambda s, sf: readers.first_available_zones(zones_raw(s, sf)),
    "write_outcomes": lambda s, sf: jobs.bronze_outcomes(trips_raw(s, sf)),
    "empty_write_skipped": _empty_writes,
    # written layers: K2, K7-K9, S4, and the reports over them
    "zone_job_checked": _zone_job(S.ZONES_DIR),
    "zone_job_summary": _zone_job(S.ZONE_SUMMARY_DIR),
    "zone_job_nulls": _zone_job(S.ZONE_NULLS_DIR),
    "trip_job_metrics": _trip_job,
    "silver_job_curated": lambda s, sf: s.read.parquet(f"{_silver_job(s, sf)}/{S.CURATED_DIR}"),
    "layer_row_counts_written": _written_counts,
    "silver_job_weekly": _silver_report("weekly"),
    "silver_job_overview": _silver_report("overview"),
    "silver_job_sample": _silver_report("sample"),
    "gold_job_overview": _gold_report("overview"),
    "gold_job_top": _gold_report("top"),
    "gold_job_sample": _gold_report("sample"),
    # S1 and S2 over files that differ
    "trips_raw_drifted": _drifted,
    "trip_flagged_drifted": lambda s, sf: bronze.flag_trips(_drifted(s, sf)),
    "zones_csv_reordered": _zones_reordered,
    # K4, K9, A8, A9, D1 over two overlapping runs
    "increment_curated": lambda s, sf: increments.read_curated(s, f"{_increments(s, sf)}/silver"),
    "increment_gold": lambda s, sf: readers.read_gold(s, f"{_increments(s, sf)}/gold"),
    # K1, K4, K7, K9: versions, the last of them never published
    "versioned_curated": lambda s, sf: versions.read(s, f"{_versioned(s, sf)}/silver/{S.CURATED_DIR}"),
    "versioned_gold": lambda s, sf: readers.read_gold(s, f"{_versioned(s, sf, True)}/gold").select(*S.KPI_ORDER),
    # A1, A3, A6, A7 over three runs
    "trip_metrics_merged": _merged_metrics,
    # K5, K6, S5: the whole gold job; A5; P24
    "gold_job_previews": _gold_job_previews,
    "gold_job_summary": _gold_job_summary,
    "gold_job_empty": _gold_job_empty,
    "null_pct_no_columns": lambda s, sf: metrics.null_percentages(zones_bronze(s, sf), ["no_such_column"]),
    "trip_totals_stamped": lambda s, sf: metrics.trip_metrics(trips_flagged(s, sf), ("counts",), STAMP).withColumnRenamed("run_ts", "stamp"),
}


def _wrap(q: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The registered queries put the session in UTC, which the pipeline asks for, and let Spark generate no
        method that the JVM leaves uncompiled."""
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)
        return for_compare(q(spark, sf_dir))
    run.__name__ = getattr(q, "__name__", "query")
    return run


def queries() -> dict[str, Query]:
    return {name: _wrap(q) for name, q in _QUERIES.items()}
