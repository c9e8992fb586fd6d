from datetime import date, datetime

from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import silver
from tests.helpers import DROPOFF, PICKUP, good_trip, trips


def test_standardize_renames_and_types(spark):
    df = trips(spark, [good_trip(store_and_fwd_flag="y", VendorID=1, passenger_count=2,
                                 PULocationID=40, DOLocationID=41)])
    out = silver.standardize_trips(df)
    assert out.columns[:20] == [n for n, _ in S.SILVER_TYPES]
    types = dict(out.dtypes)
    assert types["pickup_datetime"] == "timestamp"
    assert types["trip_distance"] == "double"
    assert types["vendor_id"] == "int" and types["passenger_count"] == "int"
    assert out.collect()[0].store_and_fwd_flag == "Y"


def test_standardize_fills_missing_and_tolerates_overflow(spark):
    df = trips(spark, [good_trip(passenger_count=2**40)]).drop("cbd_congestion_fee")
    row = silver.standardize_trips(df).collect()[0]
    assert row.cbd_congestion_fee is None and row.passenger_count is None


def test_standardize_capitalised_and_both_airport_spellings(spark):
    df = trips(spark, [good_trip(airport_fee=1.25)])
    up = silver.standardize_trips(df.withColumnRenamed("airport_fee", "Airport_fee"))
    assert up.collect()[0].airport_fee == 1.25
    both = df.withColumn("airport_fee", F.lit(None).cast("double")).select("*", F.lit(3.0).alias("Airport_fee"))
    assert silver.standardize_trips(both).collect()[0].airport_fee == 3.0


def test_join_zones_adds_boroughs_and_drops_bad_ids(spark):
    t = spark.createDataFrame([(40, 41, PICKUP, DROPOFF, 1.0), (77, 40, PICKUP, DROPOFF, 1.0)],
                              "pu_location_id int, do_location_id int, pickup_datetime timestamp_ntz, "
                              "dropoff_datetime timestamp_ntz, trip_distance double")
    z = spark.createDataFrame([("40", "North", "Mill", "Outer"), ("41", "South", "Quay", "Inner"),
                               ("4O", "East", "Typo", "Outer")], S.ZONE_SCHEMA)
    rows = {r.pu_location_id: r for r in silver.join_zones(t, z).collect()}
    assert rows[40].pu_borough == "North" and rows[40].do_borough == "South"
    assert rows[40].pu_zone == "Mill" and rows[40].do_zone == "Quay"
    assert rows[77].pu_borough is None and rows[77].do_zone == "Mill"


def test_zone_dimension_one_row_per_id(spark):
    z = spark.createDataFrame([("1", "B", "Zb", "S"), ("1", "A", "Za", "S"), ("01", "C", "Zc", "S")],
                              S.ZONE_SCHEMA)
    rows = silver.zone_dimension(z).collect()
    assert [(r.location_id, r.borough) for r in rows] == [(1, "C")]  # "01" sorts first


def test_derived_columns(spark):
    t = spark.createDataFrame([("ride", PICKUP, DROPOFF, 9.0, 54.0)],
                              "ride_id string, pickup_datetime timestamp, dropoff_datetime timestamp, "
                              "trip_distance double, total_amount double")
    r = silver.add_derived_columns(t).collect()[0]
    assert r.pickup_week_id == "2025-W11"
    assert abs(r.trip_minutes - 36.0) < 1e-9 and abs(r.revenue_per_mile - 6.0) < 1e-9
    assert r.is_peak_hour is True and r.is_night is False and r.is_weekend is False
    assert r.pickup_day_of_week == "Wed" and r.pickup_week_start == date(2025, 3, 10)
    assert abs(r.trip_mph - 15.0) < 1e-9 and abs(r.revenue_per_minute - 1.5) < 1e-9


def test_week_id_year_boundaries_and_zero_minutes(spark):
    t = spark.createDataFrame(
        [(datetime(2024, 12, 30, 21), datetime(2024, 12, 30, 21)),
         (datetime(2025, 1, 1, 3), datetime(2025, 1, 1, 3, 10)),
         (datetime(2027, 1, 1, 12), datetime(2027, 1, 1, 11))],
        "pickup_datetime timestamp, dropoff_datetime timestamp").withColumns(
            {"trip_distance": F.lit(1.0), "total_amount": F.lit(5.0)})
    rows = silver.add_derived_columns(t).orderBy("pickup_datetime").collect()
    assert [r.pickup_week_id for r in rows] == ["2024-W01", "2025-W01", "2027-W53"]
    assert rows[0].pickup_week_start == rows[1].pickup_week_start == date(2024, 12, 30)
    assert rows[0].trip_minutes == 0.0 and rows[0].revenue_per_minute is None
    assert rows[0].is_night is True and rows[1].is_night is True
    assert rows[2].trip_minutes is None  # negative span


def test_finalize_dedups_without_vendor_column(spark):
    df = spark.createDataFrame([(PICKUP, DROPOFF, 8, 9, 3.5, 19.25)] * 3,
                               "pickup_datetime timestamp, dropoff_datetime timestamp, "
                               "pu_location_id int, do_location_id int, trip_distance double, "
                               "total_amount double")
    out = silver.finalize(silver.add_derived_columns(df))
    assert out.columns[0] == "ride_id" and out.columns == S.SILVER_ORDER
    assert out.count() == 1


def test_dedup_keeps_first_by_conformed_columns(spark):
    rows = [good_trip(tpep_dropoff_datetime=datetime(2025, 3, 12, 18, 0), trip_distance=9.0),
            good_trip(tpep_dropoff_datetime=datetime(2025, 3, 12, 17, 30), trip_distance=1.0)]
    z = spark.createDataFrame([("1", "A", "Z1", "S"), ("2", "B", "Z2", "S")], S.ZONE_SCHEMA)
    out = silver.curate(trips(spark, rows), z).collect()
    assert len(out) == 1 and out[0].trip_distance == 1.0  # earlier drop-off wins
    assert out[0].pu_borough == "A" and out[0].do_borough == "B"


def test_weekly_summary(spark):
    t = spark.createDataFrame([("2025-W02", date(2025, 1, 6), 10.0, 1.0)] * 3,
                              "pickup_week_id string, pickup_week_start date, total_amount double, "
                              "trip_distance double")
    r = silver.weekly_summary(t).collect()[0]
    assert (r.row_count, r.total_revenue, r.total_miles) == (3, 30.0, 3.0)


def test_zone_reference_flags(spark):
    from tripmart.operators import bronze, integrity
    rows = [good_trip(PULocationID=1, DOLocationID=2), good_trip(PULocationID=7, DOLocationID=2),
            good_trip(PULocationID=None, DOLocationID=2)]
    z = spark.createDataFrame([("1", "A", "Z1", "S"), ("2", "B", "Z2", "S"), ("x", "C", "Z", "S")],
                              S.ZONE_SCHEMA)
    flagged = integrity.add_zone_ref_checks(bronze.flag_trips(trips(spark, rows)), z)
    got = sorted((r.PULocationID or 0, r.chk_PULocationID_ref_ok, r.chk_DOLocationID_ref_ok, r.dq_pass)
                 for r in flagged.collect())
    assert got == [(0, None, True, None), (1, True, True, True), (7, False, True, False)]
    assert flagged.count() == 3


def test_null_pickup_week_id_text_and_ride_id(spark):
    t = spark.createDataFrame([(None, None, 1.0, 5.0)],
                              "pickup_datetime timestamp, dropoff_datetime timestamp, "
                              "trip_distance double, total_amount double")
    r = silver.add_derived_columns(t).collect()[0]
    assert r.pickup_week_id == "null-Wnull" and r.trip_minutes is None
    out = silver.finalize(silver.add_derived_columns(t)).collect()[0]
    assert out.ride_id is not None and len(out.ride_id) == 64
