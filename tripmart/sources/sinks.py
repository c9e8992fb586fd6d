"""Writers of the three layers.

Fact and dimension tables keep their parallelism (one file per task); only the small metric
and preview tables are written as a single file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The codec of trip tables: ride ids are hex text, which Snappy stores as it is and Zstandard halves.
FACT_CODEC = "zstd"


def single_file(df: DataFrame) -> DataFrame:
    """One output file: only for tables whose size does not grow with the facts.

    The rows meet behind an exchange, so whatever computes them keeps its own parallelism
    (``coalesce(1)`` would pull the whole stage into one task).
    """
    return df.repartition(1)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a folder or file at ``path`` (on any Hadoop file system)?"""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def replace_by_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """An older run's output becomes an empty table of the same schema; nothing is made anew."""
    if exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").option("header", "true").format(fmt).save(path)


@contextmanager
def few_partition_values(spark: SparkSession, most: int = 8) -> Iterator[None]:
    """Inside, a partitioned write keeps a file per value open instead of sorting all rows by value."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_if_rows(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Overwrite ``path`` with ``df`` when it has at least one row; report whether it did.

    Without rows nothing is written on a fresh path, and an older run's table is emptied, so it
    can't be taken for this run's.
    """
    if df.isEmpty():
        replace_by_empty(df.sparkSession, path, df.schema, fmt)
        return False
    df.write.mode("overwrite").format(fmt).save(path)
    return True


def write_if_schema(df: DataFrame, path: str) -> bool:
    """Overwrite ``path`` when the frame has at least one column (metric tables)."""
    if not df.columns:
        return False
    single_file(df).write.mode("overwrite").parquet(path)
    return True


def write_gold(kpis: DataFrame, path: str) -> None:
    """Gold KPIs as Parquet partitioned by week id (readers prune by week).

    The KPI table holds one row per week and borough, so clustering it by week first
    is a cheap shuffle that leaves one file per week instead of one per task and week.
    """
    (kpis.repartition("pickup_week_id")
     .write.mode("overwrite").partitionBy("pickup_week_id").parquet(path))


def weeks_by_size(df: DataFrame, week: str) -> DataFrame:
    """Rows dealt out by week and size (``rebalance``: small weeks share a task, a large one takes several), so no
    task holds a week that outgrows it and no week is many small files."""
    return df.hint("rebalance", F.col(week))


def write_dealt_weeks(df: DataFrame, path: str) -> None:
    """Replaces only the weeks that ``df`` holds; all other weeks stay as they are. The rows are dealt out by week already,
    so a task keeps a file open for each of its weeks; only one of many weeks sorts its rows."""
    with few_partition_values(df.sparkSession):
        (df.write.mode("overwrite").option("compression", FACT_CODEC)
         .option("partitionOverwriteMode", "dynamic").partitionBy("pickup_week_id").parquet(path))


def write_weeks(df: DataFrame, path: str) -> None:
    """Deals ``df`` out by week and size and replaces the weeks it holds."""
    write_dealt_weeks(weeks_by_size(df, "pickup_week_id"), path)


def write_csv_preview(df: DataFrame, path: str) -> None:
    """A small preview as one CSV file with a header."""
    single_file(df).write.mode("overwrite").option("header", "true").csv(path)


def write_zones_csv(zones: DataFrame, path: str) -> None:
    """Zone lookup as CSV with a header, keeping leading and trailing blanks."""
    (zones.write.mode("overwrite")
     .option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def write_json(df: DataFrame, path: str) -> None:
    single_file(df).write.mode("overwrite").json(path)
