"""Weekly increments, and metrics that add up over runs."""

import re
from datetime import datetime, timedelta


from tests.helpers import good_trip, trips
from tripmart import schemas as S
from tripmart.operators import bronze, gold, metrics, silver
from tripmart.plans import increments, jobs

MONDAY = datetime(2025, 3, 3, 8, 0)


def _trip(week, i, **more):
    up = MONDAY + timedelta(days=7 * week, minutes=i)
    return good_trip(**{"tpep_pickup_datetime": up, "tpep_dropoff_datetime": up + timedelta(minutes=20), "total_amount": 10.0 + i} | more)


def _zones(spark):
    return spark.createDataFrame([("1", "A", "Z1", "S"), ("2", "B", "Z2", "S")], S.ZONE_SCHEMA)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_overlapping_runs_equal_one_run(spark, tmp_path):
    first = [_trip(0, i) for i in range(4)] + [_trip(1, i, trip_distance=5.0) for i in range(4)]
    # the same rides again: one comes later in the order, one earlier; new rides; a rejected trip of a third week
    second = [_trip(1, 0, trip_distance=9.0), _trip(1, 1, trip_distance=1.0), _trip(1, 8), _trip(2, 0), _trip(3, 0, VendorID=3)]
    base = str(tmp_path / "base")
    assert increments.run(spark, trips(spark, first), _zones(spark), base, "r1") == ["2025-W10", "2025-W11"]
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "base/silver/curated_by_week/pickup_week_id=2025-W10").iterdir()}
    gold_before = _rows(spark.read.parquet(f"{base}/gold").where("pickup_week_id = '2025-W10'"))
    assert increments.run(spark, trips(spark, second), _zones(spark), base, "r2") == ["2025-W11", "2025-W12"]
    # weeks that the second run did not bring are the same files
    assert files == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "base/silver/curated_by_week/pickup_week_id=2025-W10").iterdir()}
    assert gold_before == _rows(spark.read.parquet(f"{base}/gold").where("pickup_week_id = '2025-W10'"))
    whole = silver.curate(bronze.split_flagged(bronze.flag_trips(trips(spark, first + second))).passed, bronze.bronze_zones(_zones(spark)))
    curated = increments.read_curated(spark, f"{base}/silver")
    assert curated.columns == S.SILVER_ORDER and _rows(curated) == _rows(whole)
    kpis = spark.read.parquet(f"{base}/gold").select(*S.KPI_ORDER)
    assert _rows(kpis) == _rows(gold.weekly_kpis(whole, ordered=False))
    weekly = spark.read.parquet(f"{base}/silver/{increments.WEEKLY_WEEKS_DIR}").drop("run_ts")
    assert _rows(weekly.select("pickup_week_id", "row_count")) == _rows(silver.weekly_summary(whole).select("pickup_week_id", "row_count"))
    # the same run once more changes nothing
    increments.run(spark, trips(spark, second), _zones(spark), base, "r2")
    assert _rows(increments.read_curated(spark, f"{base}/silver")) == _rows(whole)


def test_plan_reads_touched_weeks_once(spark, tmp_path):
    base = str(tmp_path / "base")
    increments.run(spark, trips(spark, [_trip(w, i) for w in range(5) for i in range(3)]), _zones(spark), base, "r1")
    old = increments.read_curated(spark, f"{base}/silver", ["2025-W11", "2025-W12"])
    new = jobs.read_bronze(spark, f"{base}/bronze/r1")
    rides = increments.merged_rides(new, old)
    rides.collect()
    plan = rides._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert re.search(r"PartitionFilters: \[.*pickup_week_id#\d+ IN \(2025-W11,2025-W12\)", final)
    assert final.count("Exchange hashpartitioning(__ride_key") == 1  # old and new meet in one exchange
    assert old.count() == 6 and len(old.inputFiles()) <= len(spark.read.parquet(f"{base}/silver/curated_by_week").inputFiles())


def test_nothing_to_add(spark, tmp_path):
    base = str(tmp_path / "base")
    assert increments.run(spark, trips(spark, []), _zones(spark), base, "r0") == []
    assert increments.read_curated(spark, f"{base}/silver") is None
    assert increments.run(spark, trips(spark, [_trip(0, 0)]), _zones(spark), base, "r1") == ["2025-W10"]
    assert increments.run(spark, trips(spark, [_trip(0, 1, VendorID=3)]), _zones(spark), base, "r2") == []
    assert increments.read_curated(spark, f"{base}/silver").count() == 1


def test_metrics_add_up_over_runs(spark, tmp_path):
    runs = [[_trip(0, i) for i in range(3)] + [_trip(0, 4, VendorID=3)], [_trip(1, 0, passenger_count=None)], []]
    for i, rows in enumerate(runs):
        jobs.run_bronze_trips(trips(spark, rows), str(tmp_path / f"r{i}"), run_id=f"r{i}")
    state = spark.read.parquet(*[str(tmp_path / f"r{i}" / S.METRIC_STATE_DIR) for i in range(3)])
    cols = ["metric", "value", "pass_count", "fail_count", "pass_rate", "category"]
    want = metrics.trip_metrics(bronze.flag_trips(trips(spark, sum(runs, [])))).select(*cols)
    assert _rows(metrics.merged_metrics(state).select(*cols)) == _rows(want)
    twice = state.unionByName(state.where("run_id = 'r0'"))  # a replayed run counts once
    assert _rows(metrics.merged_metrics(twice).select(*cols)) == _rows(want)
    assert metrics.merged_metrics(state.limit(0)).count() == 0


def test_stream_metrics_equal_batch(spark, tmp_path):
    from tripmart.streaming.bronze_stream import start_bronze_stream, stream_metrics

    raw = trips(spark, [_trip(0, i) for i in range(6)] + [_trip(1, 0, VendorID=3)])
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    q = start_bronze_stream(spark, str(tmp_path / "in"), raw.schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    cols = ["metric", "value", "pass_count", "fail_count", "pass_rate", "category"]
    assert spark.read.parquet(str(tmp_path / "out" / S.METRIC_STATE_DIR)).select("run_id").distinct().count() > 1
    assert _rows(stream_metrics(spark, str(tmp_path / "out")).select(*cols)) == _rows(metrics.trip_metrics(bronze.flag_trips(raw)).select(*cols))

