"""Incremental landing of extract folders.

The batch workload needs no streaming operators. The fixed-width parse is a
stateless projection, so the same function can pick up new extract files
through a file stream; each file is taken once, tracked by the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from carespan.sources.fixed_width import fixed_width_scan
from carespan.sources.layouts import Layout
from carespan.sources.releases import stamp_release


def land_new_extracts(
    spark: SparkSession, folder: str, layout: Layout, target: str, checkpoint: str, source: str, release: int
) -> StreamingQuery:
    """Parse files not seen before and append them to ``target``; stops when none are left."""
    lines = spark.readStream.format("text").load(folder)
    rows = stamp_release(fixed_width_scan(lines, layout), source, release)
    return (
        rows.writeStream.format("parquet")
        .partitionBy("DataSource", "ReleaseNum")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
