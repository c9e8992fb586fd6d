"""Tables that change in one step: every run writes a folder of its own, and a marker file names the current one.

A table at ``path`` holds ``path/_versions/<folder>`` with the rows of each run and ``path/_published/<folder>`` with one
small JSON line (number, folder, schema). Spark commits that line's file as the last thing a run does, so readers see the
older version whole until then, and the new one whole afterwards. A run that fails half-way, at any
point, leaves a folder that no marker names. Nothing is renamed, so object stores are fine.

Cases: a table that was never published reads as None; an empty frame is a version like any other (its
schema is in the marker, as a partitioned write of no rows leaves no file); two runs at once get folders of
their own, and the larger folder name wins among equal numbers; versions stay until :func:`prune`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import delete_path
from tripmart.sources import sinks

VERSIONS_DIR, PUBLISHED_DIR = "_versions", "_published"
MARKER = "version bigint, folder string, schema string"


def history(spark: SparkSession, path: str) -> DataFrame:
    """``version, folder, schema`` of all published versions (a row per run)."""
    if not sinks.exists(spark, f"{path}/{PUBLISHED_DIR}"):
        return spark.createDataFrame([], MARKER)
    return spark.read.schema(MARKER).option("recursiveFileLookup", "true").json(f"{path}/{PUBLISHED_DIR}")


def _latest(spark: SparkSession, path: str) -> T.Row | None:
    return history(spark, path).orderBy(F.desc("version"), F.desc("folder")).first()


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version; None if none was published."""
    row = _latest(spark, path)
    return f"{path}/{VERSIONS_DIR}/{row.folder}" if row else None


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version's, or ``path`` itself for a table without versions."""
    return current(spark, path) or path


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version's rows; None if none was published."""
    row = _latest(spark, path)
    if row is None:
        return None
    schema = T.StructType.fromJson(json.loads(row.schema))
    return spark.read.schema(schema).parquet(f"{path}/{VERSIONS_DIR}/{row.folder}")


def stage(path: str) -> str:
    """A new folder under ``path`` for a run to write to; readers don't see it before :func:`publish`."""
    return f"{path}/{VERSIONS_DIR}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, staged: str, schema: T.StructType) -> int:
    """Makes a written folder of :func:`stage` the current version; returns its number."""
    row = _latest(spark, path)
    number, folder = (row.version if row else 0) + 1, staged.rsplit("/", 1)[1]
    marker = spark.createDataFrame([(number, folder, schema.json())], MARKER)
    sinks.single_file(marker).write.json(f"{path}/{PUBLISHED_DIR}/{folder}")
    return number


def write(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Writes ``df`` as a new version and publishes it; returns its number."""
    staged = stage(path)
    df.write.partitionBy(*partition_by).parquet(staged, compression=sinks.FACT_CODEC)
    return publish(df.sparkSession, path, staged, df.schema)


def prune(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes published versions but the last ``keep`` (at least one), markers first; returns how many went.
    Folders that were never published are left alone: a run may still be writing to them."""
    rows = history(spark, path).orderBy(F.desc("version"), F.desc("folder")).select("folder").collect()
    old = rows[max(1, keep):]
    for row in old:
        delete_path(spark, f"{path}/{PUBLISHED_DIR}/{row.folder}")
        delete_path(spark, f"{path}/{VERSIONS_DIR}/{row.folder}")
    return len(old)
