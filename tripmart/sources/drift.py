"""Raw inputs whose files differ: Parquet with drifting types and columns, CSV with moving headers.

Parquet: Spark merges the footers of all files in one job when their types agree. Where they don't, the
sorted list of files is halved until each part does (a few footer jobs per change of type, not one per
file); parts of equal schema become one scan, every scan casts to one common type set, and the scans are united
by name. Filters and column selections still reach each scan.

CSV: the first line of every file is read in one job; files of equal headers are one scan with the columns in
their own order, and columns are taken by name. Lines with too few or too many values are kept, with
their text in a column of its own if one is asked for.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.checks import quoted

_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_NUMERIC = (*_INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """One type for all: the widest whole number, else double for numbers, the most exact time for
    dates and times (a local time meets an instant as an instant in the session's zone), else text."""
    kinds = [t for t in types if not isinstance(t, T.NullType)]
    if not kinds:
        return T.StringType()
    if all(t == kinds[0] for t in kinds):
        return kinds[0]
    if all(type(t) in _INTEGRAL for t in kinds):
        return max(kinds, key=lambda t: _INTEGRAL.index(type(t)))
    if all(isinstance(t, _NUMERIC) for t in kinds):
        return T.DoubleType()
    if all(isinstance(t, _TIMES) for t in kinds):
        return max(kinds, key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def parquet_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """(files, schema) of as few scans as there are schemas that don't merge."""
    def parts(some: list[str]) -> list[tuple[list[str], T.StructType]]:
        try:
            return [(some, spark.read.option("mergeSchema", "true").parquet(*some).schema)]
        except Exception as e:  # its class depends on the kind of session
            if len(some) == 1 or "CANNOT_MERGE" not in str(e):
                raise
        half = len(some) // 2
        return parts(some[:half]) + parts(some[half:])

    groups: dict[str, tuple[list[str], T.StructType]] = {}
    for own, schema in parts(sorted(files)):
        groups.setdefault(schema.json(), ([], schema))[0].extend(own)
    return list(groups.values())


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns, in the order of their first appearance, under the name they first had (names that
    differ only by case are one column), each of the common type."""
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            names.setdefault(f.name.lower(), f.name)
            types.setdefault(f.name.lower(), []).append(f.dataType)
    return T.StructType([T.StructField(name, common_type(types[low])) for low, name in names.items()])


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    own = {c.lower(): c for c in df.columns}

    def column(f: T.StructField) -> Column:
        held = own.get(f.name.lower())
        return (F.lit(None) if held is None else F.col(quoted(held))).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """All files under the paths as one table; a column that a file lacks is NULL in its rows.

    Whole numbers beyond 2^53 lose digits where another file holds the column as a fraction.
    """
    files = spark.read.parquet(*paths).inputFiles()
    groups = parquet_groups(spark, files)
    schema = common_schema([s for _, s in groups])
    out = None
    for own, _ in groups:
        part = _as(spark.read.option("mergeSchema", "true").parquet(*own), schema)
        out = part if out is None else out.union(part)
    return out


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """header -> files that start with it, from one job over the files' first blocks."""
    at = F.monotonically_increasing_id()  # lines of a block are numbered upwards
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value", at.alias("at"),
                                         F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line").collect():
        header = tuple(h.strip().lstrip("﻿").lower() for h in next(csv.reader([r.line]), []))
        out.setdefault(header, []).extend(r.files)
    return out


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], corrupt: str | None = None) -> DataFrame:
    """Text columns taken by header name (case and blanks around it don't count), in the order asked for.

    A column that a file's header lacks is NULL; of a repeated name the first counts. ``corrupt`` names a further column with the
    text of lines that have too few or too many values (their other columns hold what could be read).
    """
    text = T.StringType()
    wanted = T.StructType([T.StructField(c, text) for c in [*columns, *([corrupt] if corrupt else [])]])
    out = spark.createDataFrame([], wanted)
    for header, files in csv_headers(spark, path).items():
        schema = T.StructType([T.StructField(f"_{i}", text) for i in range(len(header))] + [T.StructField("_bad", text)])
        # Without pruning a line is judged by all its values, not only by those that a query selects.
        lines = (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").option("columnPruning", "false")
                 .option("columnNameOfCorruptRecord", "_bad").csv(files))
        picked = [(F.col(f"_{header.index(c.lower())}") if c.lower() in header else F.lit(None).cast(text)).alias(c) for c in columns]
        # Spark refuses queries of that column alone (counting bad lines), so it takes nothing of the first value along.
        bad = F.concat("_bad", F.substring(F.coalesce(F.col("_0"), F.lit("")), 1, 0)) if header else F.col("_bad")
        out = out.union(lines.select(*picked, *([bad.alias(corrupt)] if corrupt else [])))
    return out
