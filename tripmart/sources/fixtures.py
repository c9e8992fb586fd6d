"""Driver tables -> raw trip and zone-lookup shape.

``lineitem`` becomes raw yellow-taxi trips and ``nation`` x ``region`` becomes the zone
lookup, with the defects the checks look for mixed in by fixed residue rules of a
per-row hash ``h``. One row in 50 is emitted twice (an exact duplicate trip) by a
generator over a one- or two-element array, so the fact table is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.readers import spread

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_shipdate"]


def _case(*pairs: tuple[Column, object], default: object) -> Column:
    out = None
    for cond, val in pairs:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d)


# The mapping as SQL expressions (the same text as FIXTURES.md, Spark dialect).
_HASH = "l_orderkey*31 + l_partkey*17 + l_linenumber*7 AS h"
_BASE = [
    "h", "l_shipdate", "l_quantity", "l_suppkey",
    "floor(l_extendedprice/1000)*0.25E0 + 2.5E0 AS base",
    "(h*37) % 86400 AS off_s",
    "CASE WHEN h%97=0 THEN -300 WHEN h%89=0 THEN 90000 "
    "ELSE CAST(l_quantity AS BIGINT)*60 + (h%4)*15 END AS dur_s",
]
_TRIP = [
    "h",
    "CAST(CASE WHEN h%61=0 THEN 3 WHEN h%4=0 THEN 1 WHEN h%4=1 THEN 2 WHEN h%4=2 THEN 6 "
    "ELSE 7 END AS INT) AS VendorID",
    "timestampadd(SECOND, CAST(off_s AS INT), l_shipdate) AS tpep_pickup_datetime",
    "timestampadd(SECOND, CAST(off_s+dur_s AS INT), l_shipdate) AS tpep_dropoff_datetime",
    "CAST(CASE WHEN h%13=0 THEN NULL WHEN h%29=0 THEN 0 ELSE h%6+1 END AS BIGINT) "
    "AS passenger_count",
    "CASE WHEN h%83=0 THEN -1.0E0 WHEN h%71=0 THEN 0.0E0 ELSE l_quantity*0.25E0 END "
    "AS trip_distance",
    "CAST(CASE WHEN h%13=0 THEN NULL WHEN h%101=0 THEN 50 WHEN h%23=0 THEN 99 "
    "ELSE h%6+1 END AS BIGINT) AS RatecodeID",
    "CASE WHEN h%13=0 THEN NULL WHEN h%211=0 THEN 'X' WHEN h%11=0 THEN ' ' "
    "WHEN h%11=1 THEN 'y ' ELSE 'N' END AS store_and_fwd_flag",
    "CAST(CASE WHEN h%109=0 THEN 0 ELSE h%26+1 END AS INT) AS PULocationID",
    "CAST(CASE WHEN h%113=0 THEN -1 ELSE (h*3+l_suppkey)%26+1 END AS INT) AS DOLocationID",
    "CAST(CASE WHEN h%103=0 THEN 9 ELSE h%7 END AS BIGINT) AS payment_type",
    "CASE WHEN h%107=0 THEN -base ELSE base END AS fare_amount",
    "(h%3)*0.5E0 AS extra",
    "0.5E0 AS mta_tax",
    "(h%9)*0.25E0 AS tip_amount",
    "CASE WHEN h%19=0 THEN 6.5E0 ELSE 0.0E0 END AS tolls_amount",
    "1.0E0 AS improvement_surcharge",
    "base + (h%3)*0.5E0 + (h%9)*0.25E0 + 1.5E0 AS total_amount",
    "CASE WHEN h%13=0 THEN NULL ELSE 2.5E0 END AS congestion_surcharge",
    "CASE WHEN h%17=0 THEN 1.75E0 ELSE 0.0E0 END AS Airport_fee",
    "0.75E0 AS cbd_congestion_fee",
]
TRIP_COLUMNS = [e.rsplit(" AS ", 1)[1] for e in _TRIP[1:]]


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trips (20 columns, the ``Airport_fee`` spelling) from line items.

    Each trip is emitted as a struct, once or twice (``h % 50 = 0``). Predicates of
    later layers refer to the generated columns, so they stay above the generator and
    every trip value is computed once per line item instead of being inlined into a
    filter pushed down to the scan.
    """
    return _emitted(lineitem.select(*LINEITEM_COLUMNS)
                    .selectExpr("*", _HASH).selectExpr(*_BASE).selectExpr(*_TRIP))


def _emitted(trips: DataFrame) -> DataFrame:
    """Trips with ``h``, each once or twice. The struct is made by a projection, which is always compiled; inside the
    generator, which isn't where the fused method is too large, its 20 fields would be interpreted one by one."""
    trips = trips.selectExpr(f"struct({', '.join(TRIP_COLUMNS)}) AS trip", "CASE WHEN h%50=0 THEN 2 ELSE 1 END AS copies")
    return trips.selectExpr("inline(array_repeat(trip, copies))")


# Text trips: column i holds the junk text 'x' where h % 101 = i; a distance is NaN where h % 103 = 5.
TEXT_JUNK = 101


def _as_text(i: int, name: str) -> str:
    nan = "WHEN h%103=5 THEN 'NaN' " if name == "trip_distance" else ""
    return f"CASE WHEN h%{TEXT_JUNK}={i} THEN 'x' {nan}ELSE CAST({name} AS STRING) END AS {name}"


def text_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The same raw trips with all 20 columns as text, with junk in every column."""
    return _emitted(lineitem.select(*LINEITEM_COLUMNS)
                    .selectExpr("*", _HASH).selectExpr(*_BASE).selectExpr(*_TRIP)
                    .selectExpr("h", *[_as_text(i, c) for i, c in enumerate(TRIP_COLUMNS)]))


def zones_from_nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup (four text columns) from nations and regions.

    Borough is the region name with a leading blank (nation 24: blank only); a
    non-numeric id and a repeated id 1 are appended.
    """
    n = F.col("n_nationkey")
    spark = nation.sparkSession
    zones = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (n + 1).cast("string").alias("LocationID"),
        F.when(n == 24, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.col("r_name"))).alias("Borough"),
        F.col("n_name").alias("Zone"),
        _case((n % 3 == 0, "Yellow Zone"), (n % 3 == 1, "Boro Zone"), default="Green Zone")
        .alias("service_zone"),
    )
    bad = spark.range(1).select(F.lit("xyz").alias("LocationID"), F.lit("Nowhere").alias("Borough"),
                                F.lit("Bad Row").alias("Zone"), F.lit("Boro Zone").alias("service_zone"))
    repeated = region.filter(F.col("r_regionkey") == 0).select(
        F.lit("1").alias("LocationID"), F.col("r_name").alias("Borough"),
        F.lit("NATION_0").alias("Zone"), F.lit("Yellow Zone").alias("service_zone"))
    return zones.unionByName(bad).unionByName(repeated)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str, deal: bool = False) -> DataFrame:
    """Raw trips; with ``deal`` the line items are dealt out first if their file has few splits (worth
    it for a query that computes much per row, not for a job that scans several times)."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    return trips_from_lineitem(spread(lineitem.select(*LINEITEM_COLUMNS)) if deal else lineitem)


def raw_trips_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_trips_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from_nation_region(read_table(spark, sf_dir, "nation"),
                                    read_table(spark, sf_dir, "region"))


# -- inputs that drift ------------------------------------------------------------

def write_drifted_trips(trips: DataFrame, path: str) -> list[str]:
    """The trips as three generations of files by pick-up year: the first has wider ids, a fractional
    passenger count, the other airport spelling and no congestion fee; the last has one more column."""
    generation = F.year("tpep_pickup_datetime") % 3
    first = trips.where(generation == 0).withColumnsRenamed({"Airport_fee": "airport_fee"}).drop("cbd_congestion_fee").withColumns({
        "VendorID": F.col("VendorID").cast("bigint"), "PULocationID": F.col("PULocationID").cast("bigint"),
        "passenger_count": F.col("passenger_count").cast("double")})
    last = trips.where(generation == 2).withColumn("trip_type", F.col("VendorID") + 1)
    paths = []
    for name, part in (("a", first), ("b", trips.where(generation == 1)), ("c", last)):
        part.write.mode("overwrite").parquet(f"{path}/{name}")
        paths.append(f"{path}/{name}")
    return paths


def write_drifted_zones(zones: DataFrame, path: str) -> None:
    """The zones as two CSV files: ids that 5 divides under the usual header, cut off after the borough; the others
    under another order of names, other case and one more column."""
    n = F.col("LocationID").try_cast("int")
    short = F.coalesce(n % 5 == 0, F.lit(False))
    parts = (("a", "LocationID,Borough,Zone,service_zone", ["LocationID", "Borough"], short),
             ("b", "Borough, zone,note,SERVICE_ZONE,LocationID", ["Borough", "Zone", "Borough", "service_zone", "LocationID"], ~short))
    for name, header, columns, kept in parts:
        lines = zones.where(kept).select(F.lit(1).alias("at"), F.concat_ws(",", *columns).alias("line"))
        head = zones.sparkSession.range(1).select(F.lit(0).alias("at"), F.lit(header).alias("line"))
        head.unionByName(lines).coalesce(1).sortWithinPartitions("at").select("line").write.mode("append").text(path)
