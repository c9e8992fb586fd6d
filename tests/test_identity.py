"""One row per ride without carrying the digest: the same rides as by the text of the ride id, and narrower exchanges."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.helpers import good_trip, trips
from tripmart import schemas as S
from tripmart.operators import bronze, silver
from tripmart.plans import catalog
from tripmart.session import COMPILED_METHOD_BYTES

UP = datetime(2024, 12, 30, 21, 5)


def _odd_trips():
    """Copies that differ in what the id holds (zero against minus zero, nulls, NaN, seconds) and in what it doesn't."""
    totals = [0.0, -0.0, 1.5, float("nan"), None]
    ups = [UP, UP + timedelta(microseconds=250000), UP + timedelta(seconds=1), UP - timedelta(days=24000), None]
    return [good_trip(total_amount=t, tpep_pickup_datetime=up, tpep_dropoff_datetime=UP + timedelta(minutes=m), PULocationID=pu,
                      VendorID=vendor, trip_distance=d, fare_amount=f)
            for t in totals for up in ups for pu, vendor in ((1, 2), (2, 1), (None, 2), (2, None))
            for m, d, f in ((9, 2.0, 1.0), (9, 1.0, 4.0), (9, 1.0, 3.0), (8, 5.0, 2.0))]


def test_identity_equals_the_text_of_the_ride_id(spark):
    df = trips(spark, _odd_trips()).repartition(5)
    by_text = silver.dedup_rides(silver.with_ride_id(silver.standardize_trips(df))).select("ride_id", *silver.SILVER_NAMES)
    want = sorted(map(str, by_text.collect()))
    assert sorted(map(str, silver.conform(df).select("ride_id", *silver.SILVER_NAMES).collect())) == want
    assert len(want) == 5 * 4 * 4  # the two pick-up times of one second are one ride
    for columns in ((), ("dropoff_datetime",), catalog.KPI_READ, ("pickup_datetime", "fare_amount"), ("cbd_congestion_fee",)):
        read = ["ride_id", *columns]
        assert sorted(map(str, silver.conform(df, columns).select(*read).collect())) == sorted(map(str, by_text.select(*read).collect()))


def test_reports_carry_neither_digest_nor_unread_columns(spark, sf_small):
    zones = catalog.zones_bronze(spark, sf_small)
    passed = bronze.split_flagged(bronze.flag_trips(catalog.trips_raw(spark, sf_small))).passed

    def sorts(df):  # the columns that enter the exchange of trips
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(__ride_key") == 1
        return plan, plan[plan.index("Exchange hashpartitioning(__ride_key"):]

    plan, below = sorts(catalog.kpi_input(spark, sf_small).groupBy("pickup_week_id").agg(F.sum("trip_minutes")))
    assert "sha2(" not in plan and "tolls_amount" not in below.split("WindowGroupLimit")[0]
    plan, below = sorts(silver.curate(passed, zones))
    assert "sha2(" in plan and "sha2(" not in below


def test_queries_leave_no_method_uncompiled(spark, sf_small):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    catalog.queries()["weekly_kpis"](spark, sf_small)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == str(COMPILED_METHOD_BYTES) == "8000"


def test_ranges_of_weeks_are_dealt_without_the_digest(spark, sf_small):
    rows = silver.curate_by_week(catalog.trips_pass(spark, sf_small), catalog.zones_bronze(spark, sf_small))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "sha2(" in plan and "sha2(" not in plan[plan.index("Exchange rangepartitioning("):]
    assert rows.columns == S.SILVER_ORDER


def test_increments_deal_out_narrow_rides(spark, tmp_path, monkeypatch):
    from tests.test_increments import _trip, _zones
    from tripmart.plans import increments
    from tripmart.sources import sinks

    plans, write = [], sinks.write_dealt_weeks

    def seen(df, path):
        if path.endswith(increments.CURATED_WEEKS_DIR):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path)

    monkeypatch.setattr(sinks, "write_dealt_weeks", seen)
    increments.run(spark, trips(spark, [_trip(w, i) for w in range(3) for i in range(4)]), _zones(spark), str(tmp_path), "r")
    above, below = plans[0].split("RebalancePartitions", 1)
    assert "sha2(" in above and "pu_borough" in above and "sha2(" not in below and "pu_borough" not in below
    assert spark.read.parquet(f"{tmp_path}/silver/{increments.CURATED_WEEKS_DIR}").count() == 12
