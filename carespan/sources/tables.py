"""Reading and writing published tables."""

from __future__ import annotations

import re
from datetime import date
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType


def table_query(spark: SparkSession, sql: str, date_columns: Sequence[str] = (), **frames: DataFrame) -> DataFrame:
    """Run a SELECT; listed columns are parsed to dates."""
    out = spark.sql(sql, **frames)
    return out.withColumns({c: F.to_date(F.col(c)) for c in date_columns}) if date_columns else out


# The only delta tables that may be asked for by name.
DELTA_TABLES = ("membership", "participant")


def _checked_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){0,2}", name):
        raise ValueError(f"not a table name: {name}")
    return name


def save_named_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Replace a table of the session's catalogue and analyse it, so that joins with it are planned by its size.

    With ``path`` the catalogue only refers to the files there.
    """
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(_checked_name(name))
    columns = [c for c in df.columns if isinstance(df.schema[c].dataType, AtomicType)]
    quoted = ", ".join(f"`{c}`" for c in columns)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (f" FOR COLUMNS {quoted}" if columns else ""))


def catalog_scan(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    casts: dict[str, str] | None = None,
    allowed: Sequence[str] | None = None,
) -> DataFrame:
    """A table of the session's catalogue by its name: optional filter, projection and type changes.

    ``allowed`` lists the only names that may be asked for.
    """
    if allowed is not None and name not in allowed:
        raise ValueError(f"not a table that may be read: {name}")
    return scan(spark.table(_checked_name(name)), columns, where, casts)


def scan(
    source: DataFrame,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    casts: dict[str, str] | None = None,
) -> DataFrame:
    """Pass-through of a frame: optional filter, projection and type changes."""
    out = source.where(where) if where else source
    out = out.select(*columns) if columns else out
    return out.withColumns({c: F.col(c).cast(t) for c, t in casts.items()}) if casts else out


def delta_table_name(kind: str) -> str:
    if kind not in DELTA_TABLES:
        raise ValueError(f"not a valid delta table: {kind}")
    return f"cps_{kind}_delta"


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace all rows. ``path`` must not be one that ``df`` itself reads from."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def bulk_csv_reload(spark: SparkSession, csv_path: str, schema: str, table_path: str) -> None:
    """Empty a table and load a headed CSV into it."""
    replace_table(read_csv(spark, csv_path, schema), table_path)


def csv_to_parquet(spark: SparkSession, csv_path: str | list[str], schema: str, parquet_path: str) -> DataFrame:
    replace_table(read_csv(spark, csv_path, schema), parquet_path)
    return spark.read.parquet(parquet_path)


def patient_level_load(spark: SparkSession, csv_paths: list[str], schema: str, table_path: str) -> None:
    """Append every patient-level CSV part to one table in a single job."""
    append_table(read_csv(spark, csv_paths, schema), table_path)


def report_sink(df: DataFrame, base: str, name: str, as_of: date, fmt: str = "csv") -> str:
    """Write a report under a folder named by its date; returns the path."""
    path = f"{base.rstrip('/')}/{as_of:%Y-%m-%d}/{name}_{as_of:%Y-%m-%d}"
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
    return path
