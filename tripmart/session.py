"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# Fused whole-stage-codegen stages over wide rows (31 checks, 42 curated columns)
# produce generated methods above HotSpot's 8 KB JIT limit; without this option such
# a method stays interpreted and runs several times slower. Set it on executors too.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"

# Where that option can't be given (it is read when a JVM starts), this limit of spark.sql.codegen.hugeMethodLimit makes Spark
# run a stage with a larger method operator by operator, in small methods that do get compiled.
COMPILED_METHOD_BYTES = 8000


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "tripmart", driver_memory: str = "8g",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session as used by the tests and ``bench.py`` (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", driver_memory)
         .config("spark.driver.extraJavaOptions", JVM_OPTIONS)
         .config("spark.executor.extraJavaOptions", JVM_OPTIONS)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All calendar logic of the pipeline is defined in UTC: another session zone is an error.

    The caller's session is never changed; set ``spark.sql.session.timeZone`` to ``UTC`` first.
    """
    zone = spark.conf.get("spark.sql.session.timeZone", None)
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"this pipeline needs spark.sql.session.timeZone=UTC, the session has {zone}")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session that names none gets a temporary folder, which goes when Python ends; on
    any other master executors would not see each other's files, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one output.

    Results that are read lazily need their files until they are used, so nothing is removed here;
    a long-lived session calls :func:`clear_scratch` when it is done with earlier results.
    """
    return os.path.join(shared_dir(spark), "tripmart", f"{name}-{uuid.uuid4().hex[:12]}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a folder on any Hadoop file system; False when there was none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True))


def clear_scratch(spark: SparkSession) -> bool:
    """Deletes every scratch output of this session."""
    return delete_path(spark, os.path.join(shared_dir(spark), "tripmart"))
