"""Utilization of one release window and since programme entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.dates import avg_months_between

# Summary categories that get their own visit column.
VISIT_COLUMNS = ["ED", "INPATIENT", "OTHER", "OUTPATIENT"]


def util_daily(claims: DataFrame) -> DataFrame:
    """Per patient, day and summary category; the grain all utilization sums start from."""
    return claims.groupBy("RecipientID", "ServiceFromDt", "Summary_Category").agg(
        F.sum("Visit").alias("Visit"),
        F.count(F.lit(1)).alias("Encounters"),
        F.sum("AdjustedPriceAmt").alias("AdjustedPriceAmt"),
    )


def in_window(daily: DataFrame, after: Column, until: Column) -> DataFrame:
    return daily.where((F.col("ServiceFromDt") > after) & (F.col("ServiceFromDt") <= until))


def util_pivot(daily: DataFrame) -> DataFrame:
    """Visits per category and totals; lines without a summary category are left out."""
    return (
        daily.where(F.col("Summary_Category").isNotNull())
        .groupBy("RecipientID")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("Summary_Category") == c, F.col("Visit"))), F.lit(0)).alias(f"{c}_Visit")
                for c in VISIT_COLUMNS
            ],
            F.sum("Visit").alias("Release_Visit"),
            F.sum("Encounters").alias("Release_Encounters"),
            F.sum("AdjustedPriceAmt").alias("Release_AdjustedPriceAmt"),
        )
    )


def util_min_max(daily: DataFrame) -> DataFrame:
    first, last = F.min("ServiceFromDt"), F.max("ServiceFromDt")
    return daily.groupBy("RecipientID").agg(
        first.alias("Min_ServiceFromDt"),
        last.alias("Max_ServiceFromDt"),
        (F.datediff(last, first) + 1).alias("Total_Duration_Days"),
    )


def claims_patient_join(daily: DataFrame, patients: DataFrame, until: Column) -> DataFrame:
    """Patient days on or after programme entry and up to ``until``."""
    since_entry = (F.col("d.RecipientID") == F.col("p.RecipientID")) & (
        F.col("d.ServiceFromDt") >= F.col("p.Program_Date")
    )
    return (
        daily.where(F.col("ServiceFromDt") <= until)
        .alias("d")
        .join(patients.select("RecipientID", "Program_Date").alias("p"), since_entry)
        .select("d.*", "p.Program_Date")
    )


def util_cumulative(daily: DataFrame, patients: DataFrame, until: Column) -> DataFrame:
    return (
        claims_patient_join(daily.where(F.col("Summary_Category").isNotNull()), patients, until)
        .groupBy("RecipientID")
        .agg(
            F.sum("Visit").alias("Cumulative_Visit"),
            F.sum("Encounters").alias("Cumulative_Encounters"),
            F.sum("AdjustedPriceAmt").alias("Cumulative_AdjustedPriceAmt"),
        )
    )


def months_in_program(release_date: Column, program_date: Column) -> Column:
    return avg_months_between(release_date, program_date).cast("int")
