"""Intermediate tables in the shared folder, so that lost executors lose no finished work."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

import carespan
from carespan.session import fresh_path

BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = "67108864b"
_SHIPPED: set[str] = set()


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the place in it."""
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, over the shared folder, once per application."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        root = Path(carespan.__file__).resolve().parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, str(file.relative_to(root.parent)))
        folder = fresh_path(spark, "llm-code")
        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        with system.open_output_stream(f"{place}/carespan.zip") as out:
            out.write(packed.getvalue())
        spark.sparkContext.addPyFile(f"{folder}/carespan.zip")
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches sent to workers by BATCH_BYTES, unless the session has a bound of its own.

    A batch of texts stands in a task several times over: in buffers of the JVM that grow by doubling, in the worker,
    and as what is made of it. How rows fall into batches changes no result.
    """
    if spark.conf.get(_BATCH_LIMIT, None) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)
    return spark


def trimmed(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow; at its end the worker, which lives on for other tasks, gives freed memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim is not None:
                trim(0)

    return run


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: its lineage ends there."""
    spark = frame.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
