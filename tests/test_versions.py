"""Versioned layers: what a run that fails half-way leaves, and what readers see."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import good_trip, trips
from tripmart import schemas as S
from tripmart.plans import jobs
from tripmart.sources import readers, versions


def _rows(df):
    return sorted(map(str, df.collect()))


def _trips(spark, n):
    up = datetime(2025, 3, 3, 8, 0)
    return trips(spark, [good_trip(tpep_pickup_datetime=up + timedelta(minutes=i), tpep_dropoff_datetime=up + timedelta(minutes=i + 9))
                         for i in range(n)])


def _failing(df, at):
    """The frame, whose write fails in the middle: rows before ``at`` are written by other tasks."""
    return df.repartition(4, "id").withColumn("id", F.when(F.col("id") == at, F.raise_error(F.lit("cut off")).cast("bigint"))
                                              .otherwise(F.col("id")))


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read(spark, path) is None and versions.current(spark, path) is None
    assert versions.resolve(spark, path) == path and versions.history(spark, path).count() == 0
    assert versions.write(spark.range(5), path) == 1
    assert versions.write(spark.range(7).withColumn("more", F.lit("x")), path) == 2
    assert versions.read(spark, path).columns == ["id", "more"] and versions.read(spark, path).count() == 7
    assert versions.write(spark.range(3).withColumn("p", F.col("id") % 2).limit(0), path, ("p",)) == 3
    assert versions.read(spark, path).count() == 0 and versions.read(spark, path).columns == ["id", "p"]
    assert versions.write(spark.range(3).withColumn("p", F.col("id") % 2), path, ("p",)) == 4
    assert _rows(versions.read(spark, path).where("p = 0").select("id")) == ["Row(id=0)", "Row(id=2)"]
    assert sorted(r.version for r in versions.history(spark, path).collect()) == [1, 2, 3, 4]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="cut off"):
        versions.write(_failing(spark.range(100), 50), path)
    assert versions.read(spark, path) is None
    assert readers.read_nonempty(spark, path) is None  # nor are the pieces of a first run taken for a layer
    versions.write(spark.range(10), path)
    before = versions.current(spark, path)
    with pytest.raises(Exception, match="cut off"):
        versions.write(_failing(spark.range(100), 50), path)
    spark.range(100).write.parquet(versions.stage(path))  # written, and cut off before it was published
    (tmp_path / "t/_published/half/_temporary").mkdir(parents=True)  # cut off while the marker was written
    (tmp_path / "t/_published/half/_temporary/part-0.json").write_text('{"version":99,"folder":"half"}')
    assert versions.current(spark, path) == before and readers.read_nonempty(spark, path).count() == 10
    assert versions.write(spark.range(11), path) == 2
    assert versions.read(spark, path).count() == 11


def test_an_open_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(spark.range(10), path)
    old = versions.read(spark, path)
    versions.write(old.where("id > 3"), path)  # a table may be computed from its older version
    assert old.count() == 10 and versions.read(spark, path).count() == 6
    for n in (1, 2, 3):
        versions.write(spark.range(n), path)
    staged = versions.stage(path)
    spark.range(1).write.parquet(staged)
    assert versions.prune(spark, path, keep=2) == 3 and versions.prune(spark, path, keep=2) == 0
    assert sorted(r.version for r in versions.history(spark, path).collect()) == [4, 5]
    assert versions.read(spark, path).count() == 3 and spark.read.parquet(staged).count() == 1


def test_layer_jobs_in_versions(spark, tmp_path):
    base, zones = str(tmp_path), spark.createDataFrame([("1", "A", "Z1", "S"), ("2", "B", "Z2", "S")], S.ZONE_SCHEMA)
    jobs.run_bronze_zones(zones, f"{base}/zones")

    def run(raw):
        jobs.run_bronze_trips(raw, f"{base}/bronze", versioned=True)
        jobs.run_silver(spark, f"{base}/bronze", f"{base}/zones/{S.ZONES_DIR}", f"{base}/silver", versioned=True)
        return jobs.run_gold(spark, f"{base}/silver/{S.CURATED_DIR}", f"{base}/gold", f"{base}/preview", versioned=True)

    assert jobs.read_bronze(spark, f"{base}/bronze") is None
    assert run(_trips(spark, 4)).first().total_weekly_trips == 4
    broken = _trips(spark, 9).withColumn("VendorID", F.when(F.minute("tpep_pickup_datetime") == 8, F.raise_error(
        F.lit("cut off")).cast("int")).otherwise(F.col("VendorID")))
    with pytest.raises(Exception, match="cut off"):
        jobs.run_bronze_trips(broken, f"{base}/bronze", versioned=True)
    assert jobs.read_bronze(spark, f"{base}/bronze").count() == 4
    assert run(_trips(spark, 6)).first().total_weekly_trips == 6
    plain = f"{base}/plain"
    jobs.run_bronze_trips(_trips(spark, 6), plain)
    assert _rows(jobs.read_bronze(spark, plain)) == _rows(jobs.read_bronze(spark, f"{base}/bronze"))
    assert run(_trips(spark, 0)) is None  # no trips: empty versions, nothing stale
    assert jobs.read_bronze(spark, f"{base}/bronze").count() == 0
    assert versions.read(spark, f"{base}/silver/{S.CURATED_DIR}").count() == 0
    gold = readers.read_gold(spark, f"{base}/gold")
    assert gold.count() == 0 and "pickup_week_id" in gold.columns
