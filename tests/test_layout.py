"""How layers lie on disk: weeks in few row groups, files by size, counts from footers."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import silver
from tripmart.plans import catalog, jobs
from tripmart.sources import fixtures as fx, readers, versions

SMALL = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB"}


@pytest.fixture
def small_partitions(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def row_groups(path, column):
    """(least, greatest) of ``column`` in every row group below ``path``."""
    ranges = []
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        file = pq.ParquetFile(name)
        at = file.schema_arrow.names.index(column)
        for i in range(file.metadata.num_row_groups):
            stats = file.metadata.row_group(i).column(at).statistics
            ranges.append((stats.min, stats.max))
    return ranges


def read_share(ranges, weeks):
    """Share of the row groups that a reader of one week can't skip, on average over the weeks."""
    return sum(low <= w <= high for w in weeks for low, high in ranges) / len(weeks) / len(ranges)


def test_curated_by_week_can_be_pruned(spark, sf_small, tmp_path, small_partitions):
    passed, zones = catalog.trips_pass(spark, sf_small), catalog.zones_bronze(spark, sf_small)
    plain, clustered = silver.curate(passed, zones), silver.curate_by_week(passed, zones)
    plain.repartition(8, "ride_id").write.parquet(f"{tmp_path}/plain")
    clustered.write.parquet(f"{tmp_path}/clustered")
    one, two = spark.read.parquet(f"{tmp_path}/plain"), spark.read.parquet(f"{tmp_path}/clustered")
    assert one.count() == two.count() and one.exceptAll(two).isEmpty()
    weeks = [r[0] for r in one.select("pickup_week_id").distinct().collect()]
    assert read_share(row_groups(f"{tmp_path}/plain", "pickup_week_id"), weeks) > 0.9
    ranges = row_groups(f"{tmp_path}/clustered", "pickup_week_id")
    assert len(ranges) > 3 and read_share(ranges, weeks) < 1.5 / len(ranges)  # one row group, or two where a week is cut
    assert "EqualTo(pickup_week_id," in two.where(F.col("pickup_week_id") == weeks[0])._jdf.queryExecution().toString().split("PushedFilters:")[1]
    where = two.select(F.input_file_name().alias("f"), "pickup_week_id", F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    for f in {r.f for r in where}:
        weeks_of_file = [r.pickup_week_id for r in where if r.f == f]
        assert weeks_of_file == sorted(weeks_of_file, key=lambda w: (w is not None, w))


def test_balanced_bronze_files_follow_bytes(spark, sf_small, tmp_path):
    raw = fx.raw_trips(spark, sf_small).repartition(24)
    plain = jobs.run_bronze_trips(raw, f"{tmp_path}/plain", fixed_time())
    balanced = jobs.run_bronze_trips(raw, f"{tmp_path}/balanced", fixed_time(), balanced=True)
    assert sorted(plain.collect(), key=str) == sorted(balanced.collect(), key=str)

    def files(name):
        return glob.glob(f"{tmp_path}/{name}/{jobs.TRIPS_DIR}/**/*.parquet", recursive=True)

    bytes_written = sum(os.path.getsize(f) for f in files("balanced"))
    assert len(files("plain")) > 24
    assert len(files("balanced")) <= 2 * 3 + bytes_written // (1 << 20)
    one, two = (spark.read.parquet(f"{tmp_path}/{n}/{jobs.TRIPS_DIR}") for n in ("plain", "balanced"))
    assert one.count() == two.count() and one.exceptAll(two).isEmpty()


def fixed_time():
    from datetime import datetime, timezone

    return datetime(2025, 1, 2, tzinfo=timezone.utc)


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(f"{tmp_path}/t")
    versions.write(spark.range(7), f"{tmp_path}/v")
    versions.write(spark.range(5), f"{tmp_path}/v")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with readers.footer_counts(spark):
        plan = readers.count_rows(spark, f"{tmp_path}/t")._jdf.queryExecution().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan
        by_part = spark.read.parquet(f"{tmp_path}/t").groupBy("p").count()
        assert "PushedGroupBy: [p]" in by_part._jdf.queryExecution().toString()
        assert sorted(map(tuple, by_part.collect())) == [(0, 334), (1, 333), (2, 333)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    got = readers.written_row_counts(spark, {n: f"{tmp_path}/{n}" for n in ("t", "v", "none", "absent")})
    assert [tuple(r) for r in got.collect()] == [("t", 1000), ("v", 5), ("none", 0), ("absent", 0)]


def test_curated_sort_holds_no_ride_ids_nor_derived_columns(spark, sf_small):
    rows = silver.curate_by_week(catalog.trips_pass(spark, sf_small), catalog.zones_bronze(spark, sf_small))
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    try:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    sort = next(line for line in plan.splitlines() if "Sort [" in line and "false" in line)
    assert "sha2(" in plan.split(sort)[0] and "sha2(" not in plan.split(sort)[1]
    assert "revenue_per_mile" not in plan.split(sort)[1]
