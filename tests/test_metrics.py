from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import bronze, metrics
from tripmart.sources import fixtures as fx
from tests.helpers import good_trip, trips


def test_one_pass_metrics_equal_per_check_counts(spark, sf_small):
    flagged = bronze.flag_trips(fx.raw_trips(spark, sf_small)).cache()
    got = {r.metric: r for r in metrics.trip_metrics(flagged).collect()}
    total = flagged.count()
    checks = bronze.check_columns(flagged)
    passed = flagged.filter(F.col("dq_pass")).count()
    undecided = flagged.filter(F.col("dq_pass").isNull()).count()
    assert got["row_count_total"].value == str(total)
    assert got["row_count_pass"].value == str(passed)
    assert got["row_count_reject"].value == str(total - passed)
    assert got["row_count_indeterminate"].value == str(undecided)
    for c in checks:  # brute force: two counts per check
        p = flagged.filter(F.col(c)).count()
        f = flagged.filter(~F.col(c)).count()
        assert (got[c].pass_count, got[c].fail_count) == (p, f), c
        rate = 1.0 if p + f == 0 else p / (p + f)
        assert abs(float(got[c].pass_rate) - rate) <= 5e-7
    dom = [c for c in checks if not c.endswith("_type_ok")]
    cond = dom[0]
    dr = flagged.filter(" AND ".join(dom)).count()
    assert got["domain_range_all"].pass_count == dr
    assert got["domain_range_all"].fail_count == total - dr
    n_null = flagged.filter(F.col("passenger_count").isNull()).count()
    assert float(got["null_pct_passenger_count"].value) == n_null / total
    assert cond  # keep flake8 quiet
    flagged.unpersist()


def test_metric_schema_and_categories(spark):
    out = metrics.trip_metrics(bronze.flag_trips(trips(spark, [good_trip()])))
    assert [(f.name, f.dataType) for f in out.schema.fields] == \
        [(f.name, f.dataType) for f in S.METRIC_SCHEMA.fields]
    cats = {r.metric: r.category for r in out.collect()}
    assert cats["row_count_total"] == "counts"
    assert cats["null_pct_VendorID"] == "nulls"
    assert cats["chk_VendorID_type_ok"] == "type"
    assert cats["chk_VendorID_domain_ok"] == "domain_range"
    assert cats["domain_range_all"] == "domain_range"
    assert len({r.run_ts for r in out.collect()}) == 1  # one literal per run


def test_empty_table_rates_and_nulls(spark):
    out = {r.metric: r for r in metrics.trip_metrics(bronze.flag_trips(trips(spark, []))).collect()}
    assert out["row_count_total"].value == "0"
    assert out["chk_VendorID_type_ok"].pass_rate == "1.000000"
    assert out["domain_range_all"].pass_rate == "1.000000"
    assert out["null_pct_VendorID"].value is None


def test_nan_counts_as_null_and_blank_text_too(spark):
    df = trips(spark, [good_trip(trip_distance=float("nan")), good_trip(store_and_fwd_flag=" "),
                       good_trip(), good_trip()])
    out = {r.metric: r.value for r in metrics.trip_metrics(bronze.flag_trips(df), ("nulls",)).collect()}
    assert out["null_pct_trip_distance"] == "0.25"
    assert out["null_pct_store_and_fwd_flag"] == "0.25"


def test_unify_fills_types_and_default_category(spark):
    df = spark.createDataFrame([("m", "1", None), ("n", "2", " ")], "metric string, value string, category string")
    out = metrics.unify(df, "counts")
    assert [f.name for f in out.schema.fields] == [f.name for f in S.METRIC_SCHEMA.fields]
    assert {r.category for r in out.collect()} == {"counts"}
