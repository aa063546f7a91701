"""Utilization risk tiers over a twelve-month lookback."""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.dates import add_calendar_months
from carespan.functions.lookups import first_match

# Admission categories, tier names and per-release tier codes.
IP_CATEGORIES = ["INPATIENT_IP", "EMERGENCY_IP"]
ED_CATEGORIES = ["EMERGENCY_OP"]
TIERS = ("Low", "Medium", "High")
RELEASE_TIERS = ("2", "5", "7")
LOOKBACK_MONTHS = 12


def ip_ed_daily(categorized: DataFrame) -> DataFrame:
    """Accepted inpatient and emergency claim lines per patient and day, in one pass."""
    wanted = categorized.where(
        (F.col("RejectionStatusCd") == "N") & F.col("Category3").isin(IP_CATEGORIES + ED_CATEGORIES)
    )
    return wanted.groupBy("RecipientID", "ServiceFromDt").agg(
        F.count_if(F.col("Category3").isin(IP_CATEGORIES)).alias("IP"),
        F.count_if(F.col("Category3").isin(ED_CATEGORIES)).alias("ED"),
    )


def lookback_12(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn("Low_Window_Date", add_calendar_months(F.col(date_column), -LOOKBACK_MONTHS))


def risk_tier(ed: Column, ip: Column, tiers: Sequence[str] = TIERS) -> Column:
    """Low is decided first, then Medium, so one admission makes Medium however many ED visits."""
    low, medium, high = tiers
    return first_match(
        [
            ((ed == 0) & (ip == 0), low),
            (ed.between(1, 3) | (ip == 1), medium),
            ((ed > 3) | (ip > 1), high),
        ]
    )


def window_sums(patients: DataFrame, daily: DataFrame, date_column: str) -> DataFrame:
    """ED and IP lines per patient in the twelve months up to ``date_column``, 0 when none.

    ``daily`` has at most one row per patient and day, so even the busiest
    patient brings few rows to the join, and the range sits in the join condition.
    """
    dated = lookback_12(patients.select("RecipientID", date_column), date_column).alias("p")
    in_window = (F.col("p.RecipientID") == F.col("d.RecipientID")) & F.col("d.ServiceFromDt").between(
        F.col("p.Low_Window_Date"), F.col(f"p.{date_column}")
    )
    return (
        dated.join(daily.alias("d"), in_window, "left")
        .groupBy(F.col("p.RecipientID").alias("RecipientID"))
        .agg(
            F.coalesce(F.sum("d.ED"), F.lit(0)).alias("ED"),
            F.coalesce(F.sum("d.IP"), F.lit(0)).alias("IP"),
        )
    )


def risk_at(patients: DataFrame, daily: DataFrame, date_column: str, name: str) -> DataFrame:
    return window_sums(patients, daily, date_column).withColumn(name, risk_tier(F.col("ED"), F.col("IP")))


def enrollment_dates(patients: DataFrame) -> DataFrame:
    filled = F.coalesce("Initial_Enrollment_Date", "Program_Date")
    return patients.select("RecipientID", filled.alias("Initial_Enrollment_Date"))


def risk_enrollment(patients: DataFrame, daily: DataFrame) -> DataFrame:
    return risk_at(enrollment_dates(patients), daily, "Initial_Enrollment_Date", "Enrollment_Risk")


def risk_current(patients: DataFrame, daily: DataFrame, as_of: date | Column) -> DataFrame:
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    dated = patients.select("RecipientID", as_of.alias("Current_Date"))
    return risk_at(dated, daily, "Current_Date", "Current_Risk")


def risk_engagement(patients: DataFrame, daily: DataFrame) -> DataFrame:
    engaged = patients.where(F.col("Engagement_Date").isNotNull())
    return risk_at(engaged, daily, "Engagement_Date", "Engagement_Risk")


def risk_assembly(patients: DataFrame, daily: DataFrame, as_of: date | Column, cdps: DataFrame | None = None) -> DataFrame:
    """Enrollment, engagement and current tier per patient, plus the score when given.

    The three dates are one exploded relation, so the daily counts are joined and aggregated once.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    kinds = {
        "Enrollment_Risk": F.coalesce("Initial_Enrollment_Date", "Program_Date"),
        "Engagement_Risk": F.col("Engagement_Date"),
        "Current_Risk": as_of,
    }
    points = F.array(*[F.struct(F.lit(k).alias("kind"), d.alias("at")) for k, d in kinds.items()])
    dated = patients.select("RecipientID", F.inline(points))
    dated = dated.withColumn("low", add_calendar_months(F.col("at"), -LOOKBACK_MONTHS)).alias("p")
    in_window = (F.col("p.RecipientID") == F.col("d.RecipientID")) & F.col("d.ServiceFromDt").between(
        F.col("p.low"), F.col("p.at")
    )
    sums = (
        dated.join(daily.alias("d"), in_window, "left")
        .groupBy(F.col("p.RecipientID").alias("RecipientID"))
        .agg(
            *[
                F.sum(F.when(F.col("p.kind") == k, F.coalesce(F.col(f"d.{m}"), F.lit(0)))).alias(f"{k}_{m}")
                for k in kinds
                for m in ("ED", "IP")
            ],
            F.max("p.at").alias("_any"),
            F.max(F.when(F.col("p.kind") == "Engagement_Risk", F.col("p.at"))).alias("_engaged"),
        )
    )
    tier = {k: risk_tier(F.col(f"{k}_ED"), F.col(f"{k}_IP")) for k in kinds}
    tier["Engagement_Risk"] = F.when(F.col("_engaged").isNotNull(), tier["Engagement_Risk"])
    out = sums.select("RecipientID", *[c.alias(k) for k, c in tier.items()])
    return out.join(cdps, "RecipientID", "left") if cdps is not None else out


def risk_all_releases(patients: DataFrame, daily: DataFrame, releases: DataFrame) -> DataFrame:
    """A row per patient and release of the release table: tier code, the patient's total, and
    the code pattern in release order without the latest release.

    A tier is 0 where the patient has no inpatient or emergency line in that
    release's lookback. Release dates reach the daily rows as one scalar array (a release a month).
    The releases whose lookback holds a day are neighbours in order of their dates, so a day is two
    events, in at the first of them and out after the last, however many they are; sums of a patient's events up to a
    release are the sums of its lookback. A release without a date has an empty lookback.
    """
    dates = releases.agg(
        F.array_sort(F.collect_list(F.struct("ReleaseNum", F.col("HFS_Release_Date").alias("at"))))
    ).scalar()
    by_date = F.array_sort(
        F.transform(
            F.filter("releases", lambda r: r["at"].isNotNull()),
            lambda r: F.struct(r["at"].alias("at"), add_calendar_months(r["at"], -LOOKBACK_MONTHS).alias("low"), r["ReleaseNum"].alias("ReleaseNum")),
        )
    )
    day = F.col("ServiceFromDt")
    first = F.size(F.filter("by_date", lambda r: r["at"] < day))
    behind = F.size(F.filter("by_date", lambda r: r["low"] <= day))
    measures = ("ED", "IP", "days")
    ends = [F.struct(place.alias("place"), *[(F.col(m) * sign).alias(m) for m in measures]) for place, sign in ((first, 1), (behind, -1))]
    events = (
        daily.withColumns({"days": F.lit(1), "releases": dates})
        .withColumn("by_date", by_date)
        .where(first < behind)
        .select("RecipientID", F.inline(F.array(*ends)))
        .groupBy("RecipientID", "place")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    by_patient = events.groupBy("RecipientID").agg(F.collect_list(F.struct("place", *measures)).alias("events"))

    def tier_at(place: Column) -> Column:
        until = F.filter("events", lambda e: e["place"] <= place)
        ed, ip, days = (F.aggregate(F.transform(until, lambda e: e[m]), F.lit(0).cast("long"), lambda a, b: a + b) for m in measures)
        return F.when(days > 0, risk_tier(ed, ip, RELEASE_TIERS).cast("int")).otherwise(0)

    tiers = by_patient.withColumn("releases", dates).withColumn("by_date", by_date).select(
        "RecipientID",
        F.map_from_entries(F.transform("by_date", lambda r, k: F.struct(r["ReleaseNum"], tier_at(k)))).alias("tiers"),
    )
    rows = patients.select("RecipientID").join(tiers, "RecipientID", "left").withColumn("releases", dates)
    tier = F.transform("releases", lambda r: F.coalesce(F.try_element_at("tiers", r["ReleaseNum"]), F.lit(0)))
    rows = rows.withColumn("codes", tier)
    return rows.select(
        "RecipientID",
        F.inline(F.arrays_zip(F.col("releases.ReleaseNum").alias("ReleaseNum"), F.col("codes").alias("Tier"))),
        F.aggregate("codes", F.lit(0), lambda acc, c: acc + c).alias("Total"),
        F.array_join(F.slice("codes", F.lit(1), F.greatest(F.size("codes") - 1, F.lit(0))).cast("array<string>"), "").alias("Pattern"),
    )
