"""The step that all trip queries share: emitting trips, week starts."""

from pyspark.sql import functions as F

from tripmart.functions.temporal import week_start
from tripmart.sources import fixtures as fx


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_generator_repeats_a_struct_that_a_projection_made(spark, sf_small):
    for trips in (fx.raw_trips(spark, sf_small), fx.raw_trips_text(spark, sf_small)):
        generator = [line for line in optimized(trips).splitlines() if "Generate inline" in line]
        assert len(generator) == 1 and "struct(" not in generator[0]
        assert "timestampadd" not in generator[0]


def test_week_start_is_the_monday(spark):
    times = spark.range(-1_200_000, 1_200_000, 97).select(  # days around 1970 at odd seconds, back to Julian dates
        F.timestamp_seconds(F.col("id") * 86_399).alias("t")).union(spark.sql("SELECT CAST(NULL AS TIMESTAMP)"))
    wrong = times.where(~week_start(F.col("t")).eqNullSafe(F.date_trunc("week", "t").cast("date")))
    assert times.count() > 20_000 and wrong.isEmpty()
    assert "date_trunc" not in optimized(times.select(week_start(F.col("t")).alias("w")))
