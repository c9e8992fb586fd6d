import os

import pytest
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.operators import bronze, gold, silver
from tripmart.plans import catalog, jobs
from tripmart.session import scratch_path, shared_dir
from tripmart.sources import fixtures as fx
from tripmart.sources import readers, sinks


def test_write_if_rows_skips_empty(spark, tmp_path):
    df = spark.range(3)
    assert sinks.write_if_rows(df.filter("id < 0"), str(tmp_path / "empty")) is False
    assert not os.path.exists(tmp_path / "empty")
    assert sinks.write_if_rows(df, str(tmp_path / "full")) is True
    assert spark.read.parquet(str(tmp_path / "full")).count() == 3


def test_first_available_and_missing_preview(spark, tmp_path):
    z = spark.createDataFrame([("1", " A", "Z", "S"), ("2", " ", "Y", "S")], S.ZONE_SCHEMA)
    path = str(tmp_path / "zones")
    sinks.write_zones_csv(z, path)
    got = readers.first_available(spark, [str(tmp_path / "nope"), path], readers.read_zones_csv)
    assert sorted(got.collect()) == sorted(z.collect())  # blanks survive the CSV round trip
    with pytest.raises(FileNotFoundError, match="none of these inputs"):
        readers.first_available(spark, [str(tmp_path / "nope")], readers.read_zones_csv)
    assert readers.read_preview_csv(spark, str(tmp_path / "absent")) is None


def test_shared_dir_is_registered(spark):
    d = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d)


def test_gold_partition_roundtrip(spark, tmp_path):
    k = spark.createDataFrame([("2025-W02", 3, "A"), ("2025-W03", 4, "B")],
                              "pickup_week_id string, weekly_trips long, pu_borough string")
    sinks.write_gold(k, str(tmp_path / "gold"))
    back = readers.read_gold(spark, str(tmp_path / "gold"))
    assert back.columns[-1] == "pickup_week_id" and dict(back.dtypes)["pickup_week_id"] == "string"
    assert back.filter(F.col("pickup_week_id") == "2025-W03").count() == 1


def test_jobs_end_to_end_invariants(spark, sf_small, tmp_path):
    out = str(tmp_path / "run")
    p = jobs.run_all(spark, fx.raw_trips(spark, sf_small), fx.raw_zones(spark, sf_small), out)
    summary = {r.metric: r for r in spark.read.parquet(f"{p['bronze_trips']}/_run_summary_all").collect()}
    split = {r.dq_status: r["count"] for r in
             spark.read.parquet(f"{p['bronze_trips']}/trips").groupBy("dq_status").count().collect()}
    total = int(summary["row_count_total"].value)
    assert split["pass"] + split["reject"] + split["indeterminate"] == total
    assert int(summary["row_count_pass"].value) == split["pass"]
    assert int(summary["row_count_indeterminate"].value) == split["indeterminate"]
    assert int(summary["row_count_reject"].value) == split["reject"] + split["indeterminate"]
    # same numbers as the in-memory metric query
    from tripmart.operators import metrics
    direct = {r.metric: r for r in metrics.trip_metrics(bronze.flag_trips(fx.raw_trips(spark, sf_small))).collect()}
    assert {(k, v.value, v.pass_count, v.fail_count, v.pass_rate) for k, v in direct.items()} == \
           {(k, v.value, v.pass_count, v.fail_count, v.pass_rate) for k, v in summary.items()}
    curated = spark.read.parquet(f"{p['silver']}/curated")
    weekly = spark.read.parquet(f"{p['silver']}/_run_summary_weekly")
    kpis = spark.read.parquet(p["gold"])
    n = curated.count()
    assert n == weekly.agg(F.sum("row_count")).first()[0] == kpis.agg(F.sum("weekly_trips")).first()[0]
    assert curated.select("ride_id").distinct().count() == n
    assert curated.columns == S.SILVER_ORDER
    run = spark.read.json(f"{p['gold_preview']}/run_summary").first()
    assert run.total_weekly_trips == n
    assert run.weeks_covered == kpis.select("pickup_week_id").distinct().count()
    for name in ["full_kpis", *S.KPI_SLICES]:
        prev = readers.read_preview_csv(spark, f"{p['gold_preview']}/{name}")
        assert prev is not None and 0 < prev.count() <= S.PREVIEW_ROWS
    zones = spark.read.parquet(f"{p['bronze_zones']}/full_dq_checked")
    assert zones.count() == 27 and zones.filter(~F.col("chk_LocationID_numeric")).count() == 1


def test_silver_job_skips_empty_bronze(spark, tmp_path):
    from tests.helpers import good_trip, trips
    base = str(tmp_path / "b")
    jobs.run_bronze_trips(trips(spark, [good_trip(VendorID=3)]), base)
    z = spark.createDataFrame([("1", "A", "Z", "S")], S.ZONE_SCHEMA)
    jobs.run_bronze_zones(z, str(tmp_path / "z"))
    res = jobs.run_silver(spark, base, str(tmp_path / "z/full_dq_checked"), str(tmp_path / "s"))
    assert res == {"curated": False, "_run_summary_weekly": False}


def test_read_bronze_splits(spark, tmp_path):
    from tests.helpers import good_trip, trips
    rows = [good_trip(), good_trip(VendorID=3), good_trip(passenger_count=None)]
    base = str(tmp_path / "b")
    jobs.run_bronze_trips(trips(spark, rows), base)
    passed = jobs.read_bronze(spark, base, "pass")
    rejects = jobs.read_bronze(spark, base, "reject")
    undecided = jobs.read_bronze(spark, base, "indeterminate")
    assert (passed.count(), rejects.count(), undecided.count()) == (1, 1, 1)
    assert not any(c.startswith("chk_") or c in ("dq_pass", "dq_status") for c in passed.columns)
    assert "dq_pass" in rejects.columns and len(bronze.check_columns(rejects)) == 31
    assert undecided.first().dq_pass is None


# -- runs that find nothing, on a fresh base and over an older run ----------------

def _zones(spark):
    return spark.createDataFrame([("1", "A", "Z1", "S"), ("2", "B", "Z2", "S")], S.ZONE_SCHEMA)


def _rows_left(spark, p):
    """Rows that a reader would take for the run's, per output; 0 for a missing one."""
    paths = {"pass": None, "curated": f"{p['silver']}/curated", "weekly": f"{p['silver']}/_run_summary_weekly",
             "gold": p["gold"], "preview": f"{p['gold_preview']}/full_kpis", "summary": f"{p['gold_preview']}/run_summary"}
    out = {}
    for name, path in paths.items():
        if name == "pass":
            df = jobs.read_bronze(spark, p["bronze_trips"], "pass")
        elif not sinks.exists(spark, path):
            df = None
        elif name == "preview":
            df = spark.read.option("header", "true").schema("a string").csv(path)
        elif name == "summary":
            df = spark.read.schema("run_id string").json(path)
        else:
            df = spark.read.parquet(path)
        out[name] = 0 if df is None else df.count()
    return out


@pytest.mark.parametrize("case", ["rejected", "empty"])
@pytest.mark.parametrize("older", [False, True])
def test_run_without_a_passing_trip(spark, tmp_path, case, older):
    from tests.helpers import good_trip, trips

    base = str(tmp_path / "base")
    if older:
        p = jobs.run_all(spark, trips(spark, [good_trip(), good_trip(total_amount=5.0)]), _zones(spark), base)
        assert _rows_left(spark, p) == {"pass": 2, "curated": 2, "weekly": 1, "gold": 1, "preview": 1, "summary": 1}
    bad = trips(spark, [good_trip(VendorID=3)] * 3 if case == "rejected" else [])
    p = jobs.run_all(spark, bad, _zones(spark), base)
    assert set(_rows_left(spark, p).values()) == {0}
    summary = {r.metric: r.value for r in spark.read.parquet(f"{p['bronze_trips']}/_run_summary_all").collect()}
    assert summary["row_count_total"] == ("3" if case == "rejected" else "0") and summary["row_count_pass"] == "0"
    # and the next good run is complete again
    p = jobs.run_all(spark, trips(spark, [good_trip()]), _zones(spark), base)
    assert _rows_left(spark, p) == {"pass": 1, "curated": 1, "weekly": 1, "gold": 1, "preview": 1, "summary": 1}


def test_drifted_columns_through_all_layers(spark, tmp_path):
    """Both airport spellings, a dotted and a quoted extra column."""
    from tests.helpers import good_trip, trips

    raw = trips(spark, [good_trip(), good_trip(total_amount=9.0, airport_fee=1.0), good_trip(airport_fee=None)]).selectExpr(
        "*", "2.5D AS Airport_fee", "'x' AS `fare.code`", "1 AS `it``s`")
    p = jobs.run_all(spark, raw, _zones(spark), str(tmp_path / "base"))
    passed = jobs.read_bronze(spark, p["bronze_trips"], "pass")
    assert "Airport_fee" not in passed.columns and {"fare.code", "it`s"} <= set(passed.columns)
    fees = sorted(r.airport_fee for r in spark.read.parquet(f"{p['silver']}/curated").collect())
    assert fees == [1.0, 1.75]  # a NULL amount leaves the third trip undecided
    undecided = jobs.read_bronze(spark, p["bronze_trips"], "indeterminate").collect()
    assert [r.airport_fee for r in undecided] == [2.5]
    metrics_ = {r.metric: r.value for r in spark.read.parquet(f"{p['bronze_trips']}/_run_summary_all").collect()}
    assert metrics_["row_count_pass"] == "2" and metrics_["row_count_indeterminate"] == "1"


def test_split_folders(spark, tmp_path):
    from tests.helpers import good_trip, trips

    base = str(tmp_path / "b")
    jobs.run_bronze_trips(trips(spark, [good_trip(), good_trip(VendorID=3)]), base, split_folders=True)
    passed = spark.read.parquet(f"{base}/pass")
    assert passed.count() == 1 and passed.columns == [c for c, _ in S.TRIP_SPEC]
    assert spark.read.parquet(f"{base}/_rejects").count() == 1
    assert not sinks.exists(spark, f"{base}/_indeterminate")  # no row, nothing written


def test_missing_layers_are_none(spark, tmp_path):
    from tripmart.plans import previews

    assert readers.read_nonempty(spark, str(tmp_path / "no")) is None
    assert jobs.read_bronze(spark, str(tmp_path / "no")) is None
    assert jobs.run_gold(spark, str(tmp_path / "no"), str(tmp_path / "g"), str(tmp_path / "p")) is None
    assert previews.silver_preview(spark, str(tmp_path / "no")) == {} == previews.gold_preview(spark, str(tmp_path / "no"))


def test_session_rules(spark):
    from tripmart.session import clear_scratch, ensure_utc

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ensure_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"  # left as it was
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    assert sinks.exists(spark, path) and clear_scratch(spark) and not sinks.exists(spark, path)


def test_fixed_values_are_pinned():
    """The oracle takes names and types from ``schemas``; these are written out once more here."""
    assert [c for c, _ in S.TRIP_SPEC] == (
        "VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance RatecodeID "
        "store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra mta_tax tip_amount tolls_amount "
        "improvement_surcharge total_amount congestion_surcharge airport_fee cbd_congestion_fee").split()
    assert [t for _, t in S.TRIP_SPEC] == ("INT TIMESTAMP TIMESTAMP BIGINT DOUBLE BIGINT STRING INT INT BIGINT".split()
                                           + ["DOUBLE"] * 10)
    assert [t for _, t in S.SILVER_TYPES] == ("INT TIMESTAMP TIMESTAMP INT DOUBLE INT STRING INT INT INT".split()
                                              + ["DOUBLE"] * 10)
    assert (S.VALID_VENDORS, S.VALID_RATE_CODES) == ((1, 2, 6, 7), (1, 2, 3, 4, 5, 6, 99))
    assert (S.VALID_PAYMENT_TYPES, S.VALID_STORE_FLAGS) == ((0, 1, 2, 3, 4, 5, 6), ("Y", "N"))
    assert len(S.AMOUNT_COLUMNS) == 11 and S.MAX_TRIP_SECONDS == 86400
    assert len(S.SILVER_ORDER) == 42 and len(set(S.SILVER_ORDER)) == 42 and len(S.KPI_ORDER) == 13
    assert (S.PREVIEW_ROWS, S.SAMPLE_ROWS, S.TOP_ROWS, S.LAYER_SAMPLE_ROWS) == (500, 20, 10, 5000)


def test_empty_writes_read_the_source_once(spark, sf_small, monkeypatch):
    """The jobs over passing and over rejected trips read the trips that the first job flagged and wrote."""
    inputs, outcomes = [], jobs.bronze_outcomes
    monkeypatch.setattr(jobs, "bronze_outcomes", lambda raw, *a, **b: inputs.append(raw) or outcomes(raw, *a, **b))
    got = {(r["input"], r.output): (r.written, r.rows) for r in catalog._empty_writes(spark, sf_small).collect()}
    assert [any("lineitem" in f for f in raw.inputFiles()) for raw in inputs] == [True, False, False]
    assert {raw.schema.simpleString() for raw in inputs} == {inputs[0].schema.simpleString()}
    parts = bronze.split_flagged(catalog.trips_flagged(spark, sf_small))
    for name, rows, folder in (("passing", parts.passed, "pass"), ("rejected", parts.rejects, "_rejects")):
        n = rows.count()
        own = [k for k, (written, _) in got.items() if k[0] == name and written]
        assert own == [(name, k[1]) for k in own if k[1].endswith(folder)] and got[own[0]] == (True, n)
