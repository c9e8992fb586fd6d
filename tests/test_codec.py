"""Trip tables are written with Zstandard: the hex of ride ids takes half of what Snappy leaves."""

import glob
import os

from pyspark.sql import functions as F

from tests.test_increments import _trip, _zones
from tests.helpers import trips
from tripmart import schemas as S
from tripmart.plans import increments, jobs
from tripmart.sources import sinks, versions


def test_layers_are_written_with_zstd(spark, tmp_path):
    raw, zones = trips(spark, [_trip(w, i) for w in range(2) for i in range(5)]), _zones(spark)
    for versioned, base in ((False, f"{tmp_path}/plain"), (True, f"{tmp_path}/versions")):
        jobs.run_bronze_zones(zones, f"{base}/zones")
        jobs.run_bronze_trips(raw, f"{base}/bronze", versioned=versioned)
        jobs.run_silver(spark, f"{base}/bronze", f"{base}/zones/{S.ZONES_DIR}", f"{base}/silver", versioned=versioned)
        jobs.run_gold(spark, f"{base}/silver/{S.CURATED_DIR}", f"{base}/gold", f"{base}/preview", versioned=versioned)
        for layer in (f"bronze/{jobs.TRIPS_DIR}", f"silver/{S.CURATED_DIR}"):
            files = glob.glob(f"{base}/{layer}/**/*.parquet", recursive=True)
            assert files and all(f.endswith(".zstd.parquet") for f in files)
    increments.run(spark, raw, zones, f"{tmp_path}/inc", "r")
    files = glob.glob(f"{tmp_path}/inc/silver/{increments.CURATED_WEEKS_DIR}/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_ride_ids_take_half(spark, tmp_path):
    ids = spark.range(20000, numPartitions=1).select(F.sha2(F.col("id").cast("string"), 256).alias("ride_id"))
    ids.write.parquet(f"{tmp_path}/snappy", compression="snappy")
    versions.write(ids, f"{tmp_path}/t")
    size = {n: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/{n}/**/*.parquet", recursive=True)) for n in ("snappy", "t")}
    assert sinks.FACT_CODEC == "zstd" and size["t"] < 0.6 * size["snappy"]
