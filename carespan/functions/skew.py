"""Joining a per-key summary back onto its rows when one key may be hot.

A window function would put every row of a key into one task. A grouped
summary does not (it combines map-side), but joining it back by shuffle would
again gather the hot key's rows. The summary is written, so rows are read once for it and once for the
join, however often the summary itself is used. A key with HOT_ROWS rows or more counts as hot, so long as
there are at most MOST_HOT such keys (beyond, the limit rises to total / MOST_HOT rows); their summary
rows are broadcast, which that number bounds. The rows of a hot key are dealt over as many salts as
it has HOT_ROWS, so the shuffle join that serves all other keys stays even. No row is dropped or capped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.session import written

HOT_ROWS = 1_000_000
MOST_HOT = 100_000


def summarize(rows: DataFrame, keys: Sequence[str], *aggregates) -> DataFrame:
    """Group summary carrying the row count that ``attach_summary`` needs."""
    return rows.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias("_rows"))


def attach_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``summary`` (one row per key, with ``_rows``) onto ``rows``.

    Rows with a NULL in a key get NULLs, as in any left join.
    """
    values = [c for c in summary.columns if c not in keys and c != "_rows"]
    summary = written(summary, "summary")
    total = summary.agg(F.sum("_rows").alias("n")).first().n or 0
    hot_from = max(HOT_ROWS, total / MOST_HOT)
    salts = F.ceil(F.col("_rows") / HOT_ROWS).alias("_salts")
    hot = summary.where(F.col("_rows") >= hot_from).select(
        *keys, *[F.col(c).alias(f"_hot_{c}") for c in values], F.lit(True).alias("_hot"), salts
    )
    rest = summary.where(F.col("_rows") < hot_from).select(
        *keys, F.lit(0).alias("_salt"), *[F.col(c).alias(f"_rest_{c}") for c in values]
    )
    salt = F.when(F.col("_hot"), 1 + F.pmod(F.xxhash64(*rows.columns), F.col("_salts")).cast("int"))
    return (
        rows.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .join(rest, [*keys, "_salt"], "left")
        .select(
            *rows.columns,
            *[
                F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_rest_{c}")).alias(c)
                for c in values
            ],
        )
    )
