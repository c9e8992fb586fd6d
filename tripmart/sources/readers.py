"""Readers of raw inputs and layers, and write-then-read round trips."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripmart import schemas as S
from tripmart.operators import gold
from tripmart.session import scratch_path
from tripmart.sources import drift, sinks, versions


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly when an input has fewer splits than there are cores (one file of one row
    group is one split), so that the checks that follow don't run in a few tasks. An input
    with enough splits, that is any large one, is left as it is: no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_zones_csv(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Raw zone lookup: CSV files with a header, four text columns taken by name (no inference).

    ``corrupt`` names a fifth column with the text of lines of another length than the header.
    """
    return drift.read_csv(spark, path, S.ZONE_COLUMNS, corrupt)


def first_available(spark: SparkSession, candidates: Sequence[str],
                    read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Read the first candidate path that exists (on any Hadoop file system)."""
    for path in candidates:
        try:
            return read(spark, path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    raise FileNotFoundError("none of these inputs exists: " + ", ".join(candidates))


def read_nonempty(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet layer (its current version, if it has versions), or None when it is missing or holds no
    row (callers stop early)."""
    if not sinks.exists(spark, path):
        return None
    df = versions.read(spark, path)
    if df is None:
        if sinks.exists(spark, f"{path}/{versions.VERSIONS_DIR}"):  # a first run that was never published
            return None
        df = spark.read.parquet(path)
    return None if df.isEmpty() else df


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Inside, Parquet is read by Spark's v2 source, which answers counts of rows (also by partition column)
    and least and greatest values from the files' footers. Plans made inside must also be run inside."""
    settings = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    """(rows) of a written Parquet table or its current version; inside :func:`footer_counts` no page is read."""
    return spark.read.parquet(versions.resolve(spark, path)).groupBy().count().withColumnRenamed("count", "rows")


def written_row_counts(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """(layer, rows) of written layers, from their footers; a missing layer has 0 rows. The counts are one
    number a layer, so they are taken at once."""
    with footer_counts(spark):
        # files without a row give no count at all, so the sum of counts is null
        rows = [(name, (sinks.exists(spark, path) and count_rows(spark, path).first()[0]) or 0) for name, path in layers.items()]
    return spark.createDataFrame(rows, "layer string, rows bigint")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold KPIs; the week-id partition column comes back last, as text."""
    df = versions.read(spark, path)
    return spark.read.parquet(path) if df is None else df


def read_preview_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """A preview CSV (header, all text), or None when it is absent."""
    try:
        return spark.read.option("header", "true").csv(path)
    except AnalysisException:
        return None


# ---------------------------------------------------------------------------
# Round trips through the shared folder (used by the query catalog and tests)
# ---------------------------------------------------------------------------

def roundtrip_parquet(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "parquet")
    if not sinks.write_if_rows(df, path):
        return df.limit(0)
    return spark.read.parquet(path)


def roundtrip_gold(kpis: DataFrame) -> DataFrame:
    spark = kpis.sparkSession
    path = scratch_path(spark, "gold")
    sinks.write_gold(kpis, path)
    return read_gold(spark, path)


def roundtrip_preview(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "preview")
    sinks.write_csv_preview(df, path)
    return read_preview_csv(spark, path)


def roundtrip_run_summary(kpis: DataFrame) -> DataFrame:
    spark = kpis.sparkSession
    path = scratch_path(spark, "run-summary")
    summary = gold.run_summary(kpis, "roundtrip", "", "", "")
    sinks.write_json(summary, path)
    return spark.read.json(path).select("weeks_covered", "total_weekly_trips")


def roundtrip_zones_csv(zones: DataFrame) -> DataFrame:
    spark = zones.sparkSession
    path = scratch_path(spark, "zones-csv")
    sinks.write_zones_csv(zones, path)
    return read_zones_csv(spark, path)


def first_available_zones(zones: DataFrame) -> DataFrame:
    """Zones read through ``first_available``: the first candidate does not exist."""
    spark = zones.sparkSession
    path = scratch_path(spark, "zones-csv")
    sinks.write_zones_csv(zones, path)
    return first_available(spark, [path + "-missing", path], read_zones_csv)
