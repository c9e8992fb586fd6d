from datetime import datetime

from tripmart.operators import inspect


def test_layer_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, keep string")
    b = spark.createDataFrame([("x", 1.0)], "keep string, extra double")
    counts = {r.layer: r.rows for r in inspect.layer_row_counts({"a": a, "b": b}).collect()}
    assert counts == {"a": 3, "b": 1}
    d = inspect.layer_row_delta(a, b, "a", "b").first()
    assert (d.rows_before, d.rows_after, d.row_delta) == (3, 1, -2)
    diff = {(r.change, r.column, r.filled) for r in inspect.layer_column_diff(a, b).collect()}
    assert diff == {("added", "extra", 1), ("removed", "id", 3)}
    assert inspect.layer_column_diff(a, a).count() == 0
    gaps = spark.createDataFrame([("x", None), (None, None), ("y", 2.0)], "keep string, `ex.tra` double")
    schema = [tuple(r) for r in inspect.layer_schema(gaps).collect()]
    assert schema == [(0, "keep", "string", 2), (1, "ex.tra", "double", 1)]
    assert inspect.layer_sample(a, ["id"], 2, ["keep"]).columns == ["keep"]
    assert [r.id for r in inspect.layer_sample(a.orderBy("keep", ascending=False), ["id"], 2).collect()] == [1, 2]


def test_silver_overview_and_sample(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 2), "b", 10.0, 2.0, 4.0, True, None),
         (datetime(2025, 1, 1), "a", 20.0, 4.0, 8.0, False, True)],
        "pickup_datetime timestamp, ride_id string, total_amount double, trip_distance double, "
        "trip_minutes double, is_peak_hour boolean, is_night boolean")
    o = inspect.silver_overview(df).first()
    assert (o.row_count, o.total_revenue, o.total_miles) == (2, 30.0, 6.0)
    assert (o.avg_trip_distance, o.avg_trip_minutes) == (3.0, 6.0)
    assert (o.peak_hour_pct, o.night_trip_pct) == (0.5, 0.5)  # NULL flag counts as 0
    assert [r.ride_id for r in inspect.silver_sample(df, 1).collect()] == ["a"]
