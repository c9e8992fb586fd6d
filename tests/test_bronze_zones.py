from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import bronze, metrics

ZONES = [("11", "North", "Mill", "Outer"), ("12", "South", "Quay", "Inner"),
         ("13", "South", "Hill/Dale", "Inner"), ("14", "East", "Port", "Outer")]


def zones(spark, rows):
    return spark.createDataFrame(rows, S.ZONE_SCHEMA)


def test_normalize_trims_and_blanks_become_null(spark):
    df = zones(spark, [(" 11", "North  ", "  Mill", "Outer "), ("12", "", None, "   ")])
    assert [tuple(r) for r in bronze.normalize_zones(df).orderBy("LocationID").collect()] == [
        ("11", "North", "Mill", "Outer"), ("12", None, None, None)]


def test_non_numeric_and_null_location_fail(spark):
    df = zones(spark, ZONES + [("1I", "North", "Typo", "Outer"), (None, "Q", "Z", "S")])
    checked = bronze.bronze_zones(df)
    assert any(c.startswith("chk_") for c in checked.columns)
    flags = {r.LocationID: r.chk_LocationID_numeric for r in checked.collect()}
    assert flags["1I"] is False and flags[None] is False and flags["11"] is True
    assert checked.count() == 6  # failing rows are kept


def test_missing_column_is_neutral(spark):
    df = zones(spark, ZONES).drop("Zone")
    checked = bronze.bronze_zones(df)
    assert checked.filter(~F.col("chk_Zone_not_null")).count() == 0


def test_summary_and_null_percentages(spark):
    df = zones(spark, ZONES + [("5", " ", "X", "Y")])
    checked = bronze.bronze_zones(df)
    summary, nulls = metrics.zone_metrics(checked)
    got = {r.metric: r.value for r in summary.collect()}
    assert got == {"row_count_total": "5", "row_count_pass": "4", "row_count_reject": "1"}
    null_got = {r.metric: r.value for r in nulls.collect()}
    assert set(null_got) == {f"null_pct_{c}" for c in S.ZONE_COLUMNS}
    assert null_got["null_pct_Borough"] == "0.2"
    assert summary.columns == ["metric", "value", "run_ts"]


def test_summary_without_checks_has_only_total(spark):
    got = metrics.check_summary(zones(spark, ZONES)).collect()
    assert [(r.metric, r.value) for r in got] == [("row_count_total", "4")]


def test_null_percentages_of_no_column_is_empty_and_typed(spark):
    out = metrics.null_percentages(zones(spark, ZONES), ["absent"])
    assert out.count() == 0 and out.columns == ["metric", "value", "run_ts"]


def test_null_percentage_of_empty_table_is_null(spark):
    out = metrics.null_percentages(zones(spark, []), S.ZONE_COLUMNS).collect()
    assert len(out) == 4 and all(r.value is None for r in out)
