"""Plan shape at scale and the SQL oracle on the small driver tables."""

import os
import re
import sys

import duckdb
import pytest

from tripmart.plans import catalog, oracle

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def formatted(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def nodes(text, name):
    """Number of plan nodes called ``name`` (detail headers ``(n) name``)."""
    return len(re.findall(rf"^\(\d+\) {name}\b", text, flags=re.M))


def test_curated_plan_has_one_fact_shuffle_with_partial_dedup(spark, sf_small, capsys):
    df = catalog.queries()["curated"](spark, sf_small)
    df.collect()  # the same execution: explain then shows the final adaptive plan
    text = formatted(df, capsys)
    final = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    # lineitem is read once and only its needed columns are read
    li = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert li and all("l_discount" not in x and "l_returnflag" not in x for x in li)
    assert final.count("lineitem") <= 1 and final.count("Scan parquet") == 4
    # partial de-duplication before the only exchange of trip rows, final after it
    assert final.count("WindowGroupLimit") == 4  # 2 for trips, 2 for the zone dimension
    assert final.count("BroadcastHashJoin LeftOuter") == 2
    # pick-up and drop-off lookups share one broadcast of the zone dimension
    assert "ReusedExchange" in final


def test_kpi_plan_aggregates_partially(spark, sf_small, capsys):
    text = formatted(catalog.queries()["weekly_kpis"](spark, sf_small), capsys)
    assert "partial_count" in text and "partial_sum" in text and "partial_avg" in text


def test_metrics_are_one_aggregate(spark, sf_small, capsys):
    text = formatted(catalog.queries()["summary_all"](spark, sf_small), capsys)
    assert nodes(text, "HashAggregate") == 2  # partial + final, one pass
    assert nodes(text, "Scan parquet") == 1


KEYS = ["trips_raw", "zone_summary", "zone_null_pct", "summary_all", "curated", "weekly_kpis",
        "weekly_kpis_derived_flags", "slice_peak_hour_pct", "run_summary", "gold_kpi_overview",
        "top_week_boroughs", "orphan_pickup_zones", "layer_row_delta"]


@pytest.mark.parametrize("name", KEYS)
def test_oracle_matches(spark, sf_small, name):
    import compare_oracle as C

    con = duckdb.connect()
    for t in ["lineitem", "nation", "region"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = catalog.queries()[name](spark, sf_small)
    rel = con.sql(oracle.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    srows = [tuple(r) for r in df.collect()]
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert C.digest(df.columns, srows)[0] == C.digest(rel.columns, drows)[0]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name, joins", [("weekly_summary", 0), ("silver_kpi_overview", 0), ("layer_row_delta", 0),
                                         ("orphan_pickup_zones", 1), ("orphan_dropoff_zones", 1), ("weekly_kpis", 1)])
def test_no_dead_zone_joins(spark, sf_small, name, joins):
    """Joins to the zone dimension only where its columns are used; the dimension's own join of nations
    and regions is not counted."""
    plan = final_plan(catalog.queries()[name](spark, sf_small))
    zone_joins = [x for x in plan.splitlines() if "Join" in x and "LocationID" not in x and "_location_id" in x]
    assert len(zone_joins) == joins


def test_weekly_write_aggregates_below_the_single_partition(spark, sf_small):
    from tripmart.operators import silver
    from tripmart.sources import sinks

    frame = sinks.single_file(silver.weekly_summary(catalog.curated(spark, sf_small)))
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.index("RoundRobinPartitioning(1)" if "RoundRobinPartitioning(1)" in plan else "SinglePartition") < plan.index("HashAggregate")
    assert "Coalesce 1" not in plan


def test_bronze_write_has_no_sort(spark, sf_small, tmp_path):
    """The plan of a write into a table partitioned by status sorts by it, but not inside ``few_partition_values``."""
    from tripmart.operators import bronze
    from tripmart.sources import fixtures as fx, sinks

    flagged = bronze.flag_trips(fx.raw_trips(spark, sf_small)).withColumn("dq_status", bronze.dq_status())
    flagged.createOrReplaceTempView("flagged_for_write")
    columns = ", ".join(f"`{n}` {t}" for n, t in flagged.dtypes)
    spark.sql(f"CREATE TABLE flagged_target ({columns}) USING parquet PARTITIONED BY (dq_status) LOCATION '{tmp_path}/x'")
    try:
        def write_plan():
            return spark.sql("EXPLAIN INSERT OVERWRITE TABLE flagged_target SELECT * FROM flagged_for_write").first()[0]

        assert "Sort [dq_status" in write_plan()
        with sinks.few_partition_values(spark):
            assert "Sort [" not in write_plan()
            flagged.write.mode("overwrite").partitionBy("dq_status").parquet(f"{tmp_path}/y")
    finally:
        spark.sql("DROP TABLE flagged_target")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
    assert spark.read.parquet(f"{tmp_path}/y").count() == flagged.count()


def test_ordered_results(spark, sf_small):
    """NULLs first, as Spark sorts ascending; the oracle's hash ignores order."""
    def key(*values):
        return tuple((v is not None, v) for v in values)

    rows = catalog.queries()["weekly_kpis"](spark, sf_small).collect()
    keys = [key(r.pickup_week_start, r.pu_borough, r.pickup_week_id) for r in rows]
    assert len(keys) > 100 and keys == sorted(keys)
    rows = catalog.queries()["weekly_summary_sorted"](spark, sf_small).collect()
    keys = [key(r.pickup_week_start, r.pickup_week_id) for r in rows]
    assert len(keys) > 100 and keys == sorted(keys)


def test_kpi_order_puts_null_weeks_first(spark):
    from datetime import date

    from tripmart.operators import gold

    df = spark.createDataFrame(
        [("w2", date(2025, 3, 10), "b"), ("w2", date(2025, 3, 10), "a"), (None, None, "z"), ("w1", date(2025, 3, 3), "c")],
        "pickup_week_id string, pickup_week_start date, pu_borough string").selectExpr(
        "*", "current_timestamp() AS pickup_datetime", "1D AS trip_minutes", "1D AS trip_distance", "1D AS total_amount",
        "true AS is_peak_hour", "false AS is_night")
    assert [(r.pickup_week_id, r.pu_borough) for r in gold.weekly_kpis(df).collect()] == [
        (None, "z"), ("w1", "c"), ("w2", "a"), ("w2", "b")]
