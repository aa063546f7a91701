"""Session settings used by the tests, the bench and local runs.

A cluster brings its own session; nothing in the package depends on the values
set here except the UTC time zone.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[tempfile.TemporaryDirectory] = []
_METHOD_LIMIT, _METHOD_DEFAULT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"
# Of the intermediate tables, which are written once and read a few times.
COMPRESSION = "zstd"


def build_session(app: str = "carespan", cpus: int | None = None) -> SparkSession:
    cores = str(cpus) if cpus else "*"
    partitions = cpus or os.cpu_count() or 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARESPAN_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def small_methods(spark: SparkSession) -> SparkSession:
    """Leave generated methods of wide rows split where the JVM would not compile them, unless the session has a limit of its own.

    The JVM interprets methods of more than METHOD_BYTES; Spark's default lets a stage be one method several times that.
    """
    if spark.conf.get(_METHOD_LIMIT, _METHOD_DEFAULT) == _METHOD_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, METHOD_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session with local threads (tests, trials) that names none gets a temporary one for the
    life of the process; on a cluster the name is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
        if not _LOCAL:
            _LOCAL.append(tempfile.TemporaryDirectory(prefix="carespan-", ignore_cleanup_errors=True))
        folder = _LOCAL[0].name
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier write has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame from a table in the shared folder: worked out once, whatever reads it."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.option("compression", COMPRESSION).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def written_dealt(frame: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """As ``written``, in buckets by a column: a frame that lies so already is not shuffled, and what reads the table needs no shuffle by it."""
    path = fresh_path(frame.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = frame.write.bucketBy(buckets, by).option("compression", COMPRESSION).option("path", path)
    dealt.saveAsTable(table, format="parquet")
    return frame.sparkSession.table(table)
