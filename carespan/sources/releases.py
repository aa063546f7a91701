"""Release stamping, auditing and gating of monthly loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cumulative_release(release: Column) -> Column:
    """Release number from its third character on."""
    text = F.trim(release.cast("string"))
    return F.substring(text, 3, 20).cast("int")


def stamp_release(df: DataFrame, source: str, release: int) -> DataFrame:
    return df.withColumns(
        {
            "DataSource": F.lit(source),
            "ReleaseNum": F.lit(release).cast("int"),
            "CumReleaseNum": cumulative_release(F.lit(release)),
        }
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def load_audit(tables: dict[str, DataFrame], load_date: date) -> DataFrame:
    """Rows per table and release for any number of stamped tables."""
    counts = [
        df.groupBy("ReleaseNum", F.col("CumReleaseNum").alias("Cumulative_ReleaseNum"))
        .agg(F.count(F.lit(1)).alias("Count"))
        .select(
            F.lit(name).alias("Table_Name"),
            "ReleaseNum",
            "Cumulative_ReleaseNum",
            F.lit(load_date).alias("Load_Date"),
            "Count",
        )
        for name, df in tables.items()
    ]
    return _union(counts)


def row_counts(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """One row per table with its row count; an empty table counts zero."""
    return _union(
        [df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("Table_Name"), column) for name, df in tables.items()]
    )


def reconcile_counts(source_lines: DataFrame, loaded_rows: DataFrame) -> DataFrame:
    """Compare file lines with loaded rows per table.

    ``Action`` tells what happens to the table's rows of this release; the audit
    is published only when every table matched.
    """
    lines, rows = F.coalesce("Lines", F.lit(0)), F.coalesce("Rows", F.lit(0))
    compared = source_lines.join(loaded_rows, "Table_Name", "left").select(
        "Table_Name", lines.alias("Lines"), rows.alias("Rows"), (lines == rows).alias("Matched")
    )
    return compared.select(
        "*",
        F.when(F.col("Matched"), "keep").otherwise("delete").alias("Action"),
        compared.agg(F.bool_and("Matched").alias("m")).scalar().alias("Publish_Audit"),
    )


def of_release(source: str, release: int) -> Column:
    return F.col("DataSource").eqNullSafe(F.lit(source)) & F.col("ReleaseNum").eqNullSafe(F.lit(release))


def delete_release(df: DataFrame, source: str, release: int) -> DataFrame:
    return df.where(~of_release(source, release))


def delete_audit(audit: DataFrame, release: int) -> DataFrame:
    return audit.where(~F.col("ReleaseNum").eqNullSafe(F.lit(release)))


def release_gate(releases: DataFrame, requested: int) -> DataFrame:
    """One row telling whether ``requested`` is the release that must come next."""
    last = F.col("Last_Release")
    wanted = F.lit(requested)
    return releases.agg(F.max("ReleaseNum").alias("Last_Release")).select(
        wanted.cast("int").alias("Requested_Release"),
        last,
        (last + 1).alias("Expected_Release"),
        F.when(last >= wanted, "already present")
        .when(last + 1 != wanted, F.concat(F.lit("expected "), (last + 1).cast("string")))
        .otherwise("accepted")
        .alias("Status"),
    )


def release_row(spark: SparkSession, release: int, release_date: date, load_date: date) -> DataFrame:
    return spark.range(1).select(
        F.lit(release).cast("int").alias("ReleaseNum"),
        F.right(F.lit(str(release)), F.lit(2)).alias("Cumulative_ReleaseNum"),
        F.lit(release_date).alias("HFS_Release_Date"),
        F.lit(load_date).alias("Load_Date"),
    )


def release_info_append(releases: DataFrame, release: int, release_date: date, load_date: date) -> DataFrame:
    row = release_row(releases.sparkSession, release, release_date, load_date)
    return releases.select(*row.columns).unionByName(row)
