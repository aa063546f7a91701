"""Claim keys, the joins on them and the filters that many steps share."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIM_KEY = ["DCN", "ServiceLineNbr", "RejectionStatusCd", "RecipientID", "AdjudicatedDt"]
DOCUMENT_KEY = ["RecipientID", "DCN"]


def record_type_split(claims: DataFrame, record_type: str) -> DataFrame:
    """I inpatient, O outpatient, N non-institutional professional."""
    return claims.where(F.col("RecordIDCd") == record_type)


def accepted_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("RejectionStatusCd") == "N")


def claim_key_inner(claims: DataFrame, detail: DataFrame) -> DataFrame:
    return claims.join(detail, CLAIM_KEY, "inner")


def claim_key_left(claims: DataFrame, detail: DataFrame) -> DataFrame:
    return claims.join(detail, CLAIM_KEY, "left")


def inclusive_between(df: DataFrame, column: str, low: str | Column, high: str | Column) -> DataFrame:
    low = F.col(low) if isinstance(low, str) else low
    high = F.col(high) if isinstance(high, str) else high
    return df.where(F.col(column).between(low, high))


def half_open_release_window(df: DataFrame, after: Column, until: Column, column: str = "ServiceFromDt") -> DataFrame:
    return df.where((F.col(column) > after) & (F.col(column) <= until))


def in_list(df: DataFrame, column: str, values: Sequence | DataFrame, negate: bool = False) -> DataFrame:
    """Membership in constants, or in the first column of another frame (semi or anti join).

    A NULL value is never a member, so the negation keeps it.
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(keys, column, "left_anti" if negate else "left_semi")
    member = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return df.where(~member if negate else member)


def discharged_home(institutional: DataFrame) -> DataFrame:
    return institutional.where((F.col("PatientStatusCd") == "01") & F.col("DischargeDt").isNotNull())


def min_duration_filter(windows: DataFrame, months: int, release: int) -> DataFrame:
    return windows.where(
        (F.col("Negative_Duration") >= months)
        & (F.col("Positive_Duration") >= months)
        & (F.col("ReleaseNum") == release)
    )


def of_latest_release(df: DataFrame) -> DataFrame:
    """Rows of the highest release number, by scalar subquery."""
    return df.where(F.col("ReleaseNum") == df.agg(F.max("ReleaseNum")).scalar())
