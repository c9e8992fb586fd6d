import pytest
from pyspark.sql import functions as F

from tripmart.operators import bronze, metrics
from tripmart.sources import fixtures as fx
from tripmart.streaming.bronze_stream import start_bronze_stream, stream_totals


def test_incremental_bronze_equals_batch(spark, sf_small, tmp_path):
    raw = fx.raw_trips(spark, sf_small)
    inp = str(tmp_path / "in")
    # two arrivals of raw files
    raw.filter(F.dayofmonth("tpep_pickup_datetime") <= 15).write.parquet(f"{inp}/part=a")
    raw.filter(F.dayofmonth("tpep_pickup_datetime") > 15).write.parquet(f"{inp}/part=b")
    out = str(tmp_path / "out")
    q = start_bronze_stream(spark, f"{inp}/*", raw.schema, out, str(tmp_path / "ckpt"),
                            max_files_per_trigger=1)
    q.awaitTermination(300)
    got = {r.dq_status: r.rows for r in stream_totals(spark, out).collect()}
    split = bronze.split_flagged(bronze.flag_trips(raw))
    assert got == {"pass": split.passed.count(), "reject": split.rejects.count(),
                   "indeterminate": split.indeterminate.count()}
    per_batch = spark.read.parquet(f"{out}/_run_summary_batches")
    assert per_batch.select("batch_id").distinct().count() >= 2
    total = per_batch.filter(F.col("metric") == "row_count_total").agg(
        F.sum(F.col("value").cast("long"))).first()[0]
    assert total == raw.count()
    batch = {r.metric: r.pass_count for r in metrics.trip_metrics(bronze.flag_trips(raw), ("checks",)).collect()}
    streamed = {r.metric: r.s for r in per_batch.filter(F.col("category").isin("type", "domain_range"))
                .filter(F.col("metric") != "domain_range_all")
                .groupBy("metric").agg(F.sum("pass_count").alias("s")).collect()}
    assert streamed == batch


def test_restart_counts_nothing_twice(spark, tmp_path):
    """Two files of different size; the second run has no new file and other batch sizes."""
    from tests.helpers import good_trip, trips

    inp, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    a = trips(spark, [good_trip(total_amount=float(i)) for i in range(100)])
    a.coalesce(1).write.parquet(f"{inp}/part=a")
    trips(spark, [good_trip(VendorID=3)] * 50).coalesce(1).write.parquet(f"{inp}/part=b")
    start_bronze_stream(spark, f"{inp}/*", a.schema, out, ckpt, max_files_per_trigger=1).awaitTermination(300)
    once = {r.dq_status: r.rows for r in stream_totals(spark, out).collect()}
    assert once == {"pass": 100, "reject": 50}
    start_bronze_stream(spark, f"{inp}/*", a.schema, out, ckpt).awaitTermination(300)
    assert {r.dq_status: r.rows for r in stream_totals(spark, out).collect()} == once
    trips(spark, [good_trip(passenger_count=None)] * 7).coalesce(1).write.parquet(f"{inp}/part=c")
    start_bronze_stream(spark, f"{inp}/*", a.schema, out, ckpt).awaitTermination(300)
    assert {r.dq_status: r.rows for r in stream_totals(spark, out).collect()} == once | {"indeterminate": 7}


def test_checkpoint_is_required(spark, tmp_path):
    with pytest.raises(TypeError):
        start_bronze_stream(spark, str(tmp_path), None, str(tmp_path))
    with pytest.raises(ValueError, match="checkpoint"):
        start_bronze_stream(spark, str(tmp_path), None, str(tmp_path), "")
