"""Behaviour under skew and beyond the broadcast bound."""

from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import silver
from tripmart.operators.joins import broadcast_if_small, size_in_bytes
from tests.helpers import good_trip, trips


def _zones(spark):
    return spark.createDataFrame([(str(i), f"B{i % 3}", f"Z{i}", "S") for i in range(1, 30)],
                                 S.ZONE_SCHEMA)


def test_hot_ride_id_keeps_one_row(spark):
    # a third of all rows share one ride identity (drop-off and distance differ)
    hot = [good_trip(tpep_dropoff_datetime=good_trip()["tpep_dropoff_datetime"].replace(minute=m % 60),
                     trip_distance=float(m)) for m in range(300)]
    cold = [good_trip(PULocationID=1 + i % 20, total_amount=10.0 + i) for i in range(600)]
    df = trips(spark, hot + cold).repartition(8)
    out = silver.curate(df, _zones(spark))
    assert out.count() == 1 + 600
    kept = out.filter(F.col("total_amount") == 47.75).collect()
    assert len(kept) == 1 and kept[0].trip_distance == 0.0  # earliest drop-off, then distance


def test_zone_lookup_without_broadcast_gives_same_rows(spark):
    df = trips(spark, [good_trip(PULocationID=1 + i % 40, DOLocationID=2 + i % 7, total_amount=1.0 + i)
                       for i in range(200)])
    zones = _zones(spark)
    dim = silver.zone_dimension(zones)
    assert size_in_bytes(dim) > 29 * 64
    assert "broadcast" in broadcast_if_small(dim)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_small(dim, 100) is dim
    small = silver.curate(df, zones)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = silver.curate(df, zones, max_broadcast_bytes=100)  # dimension "too large"
        big.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = big._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
