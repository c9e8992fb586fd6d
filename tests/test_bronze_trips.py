from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import bronze
from tests.helpers import PICKUP, good_trip, trips

RAW_NAMES = [c if c != "airport_fee" else "airport_fee" for c, _ in S.TRIP_SPEC]


def status(df):
    return [r.dq_pass for r in bronze.flag_trips(df).collect()]


def test_flag_normalization(spark):
    df = spark.createDataFrame([("Y ",), (" ",), (None,)], "store_and_fwd_flag string")
    vals = [r[0] for r in bronze.clean_trips(df).collect()]
    assert vals == ["Y", None, None]


def test_good_typed_trip_passes_every_check(spark):
    flagged = bronze.flag_trips(trips(spark, [good_trip()]))
    checks = bronze.check_columns(flagged)
    assert len(checks) == 31
    row = flagged.collect()[0]
    assert all(row[c] is True for c in checks) and row.dq_pass is True


def test_junk_strings_fail_type_checks_without_ansi_error(spark):
    names = [c for c, _ in S.TRIP_SPEC]
    junk = dict.fromkeys(names, "n/a") | {"trip_distance": "-7.25", "PULocationID": "-40", "store_and_fwd_flag": "maybe"}
    df = spark.createDataFrame([tuple(junk[n] for n in names)], names)
    flagged = bronze.flag_trips(df)
    row = flagged.collect()[0]  # an action: must not raise
    assert row.chk_VendorID_type_ok is False
    assert row.chk_tpep_pickup_datetime_type_ok is False
    assert row.chk_trip_distance_type_ok is True  # "-7.25" is a double
    assert row.chk_trip_distance_ge0 is False
    assert row.chk_PULocationID_pos is False
    assert row.chk_store_and_fwd_flag_domain_ok is False
    assert row.dq_pass is False


def test_null_only_is_indeterminate_null_plus_failure_is_reject(spark):
    rows = [good_trip(passenger_count=None),
            good_trip(passenger_count=None, VendorID=3),
            good_trip()]
    split = bronze.split_flagged(bronze.flag_trips(trips(spark, rows)))
    assert split.passed.count() == 1
    assert split.rejects.count() == 1
    assert split.indeterminate.count() == 1
    assert not any(c.startswith("chk_") for c in split.passed.columns)
    assert "dq_pass" in split.rejects.columns


def test_nan_distance_passes_sign_check(spark):
    assert status(trips(spark, [good_trip(trip_distance=float("nan"))])) == [True]


def test_time_order_and_duration(spark):
    rows = [good_trip(tpep_dropoff_datetime=PICKUP - timedelta(minutes=1)),
            good_trip(tpep_dropoff_datetime=PICKUP + timedelta(hours=24)),
            good_trip(tpep_dropoff_datetime=PICKUP + timedelta(hours=24) - timedelta(seconds=1)),
            good_trip(tpep_dropoff_datetime=PICKUP)]
    assert status(trips(spark, rows)) == [False, False, True, True]


def test_domain_enumerations(spark):
    rows = [good_trip(VendorID=6), good_trip(VendorID=3), good_trip(RatecodeID=99),
            good_trip(RatecodeID=50), good_trip(payment_type=0), good_trip(payment_type=9),
            good_trip(store_and_fwd_flag="n"), good_trip(store_and_fwd_flag="X"),
            good_trip(store_and_fwd_flag=None), good_trip(PULocationID=0),
            good_trip(DOLocationID=-1), good_trip(fare_amount=-2.5)]
    assert status(trips(spark, rows)) == [True, False, True, False, True, False,
                                          True, False, True, False, False, False]


def test_missing_columns_are_neutral(spark):
    base = trips(spark, [good_trip()])
    for c, _ in S.TRIP_SPEC:
        flagged = bronze.flag_trips(base.drop(c))
        assert len(bronze.check_columns(flagged)) == 31
        assert flagged.collect()[0].dq_pass is True, c


def test_capitalised_airport_fee_is_checked_as_amount(spark):
    df = trips(spark, [good_trip(airport_fee=-1.0)]).withColumnRenamed("airport_fee", "Airport_fee")
    row = bronze.flag_trips(df).collect()[0]
    assert row.chk_airport_fee_type_ok is True  # lower-case spelling absent: neutral
    assert row.chk_amounts_nonneg_ok is False


def test_both_airport_spellings(spark):
    df = trips(spark, [good_trip(airport_fee=1.0)])
    both = df.select("*", F.lit(-1.0).alias("Airport_fee"))
    flagged = bronze.flag_trips(both)
    assert flagged.columns[:20] == df.columns and "Airport_fee" not in flagged.columns
    row = flagged.collect()[0]
    assert row.chk_amounts_nonneg_ok is False and row.chk_airport_fee_type_ok is True
    assert row.airport_fee == 1.0
    only_capital = df.withColumn("airport_fee", F.lit(None).cast("double")).select("*", F.lit(2.0).alias("Airport_fee"))
    assert bronze.flag_trips(only_capital).first().airport_fee == 2.0


def test_extra_columns_with_odd_names_pass_through(spark):
    odd = trips(spark, [good_trip()]).selectExpr("*", "7 AS `fare.code`", "'t' AS `it``s`", "1 AS `a b`")
    row = bronze.flag_trips(odd).first()
    assert row["fare.code"] == 7 and row["it`s"] == "t" and row["a b"] == 1 and row.dq_pass is True


def test_empty_table(spark):
    flagged = bronze.flag_trips(trips(spark, []))
    split = bronze.split_flagged(flagged)
    assert split.passed.count() == 0 and split.rejects.count() == 0


def test_pass_keeps_raw_types(spark):
    split = bronze.split_flagged(bronze.flag_trips(trips(spark, [good_trip()])))
    assert dict(split.passed.dtypes)["passenger_count"] == "bigint"
    assert dict(split.passed.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
