"""First outpatient event after a discharge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.operators.keys import CLAIM_KEY, accepted_only, discharged_home

# Categories that count as an outpatient event.
OUTPATIENT_EVENTS = [
    "OUTPATIENT_OP", "OTHER_OUTPATIENT_VISIT", "RURAL_HEALTH_CLINIC_VISIT", "HOSPITAL_OUTPATIENT_VISIT",
    "PREVENTIVE_VISIT", "OFFICE_VISIT", "TELEPHONE_VISIT", "HOME_VISIT", "OUTPATIENT_CONSULT",
]
FLAGS = ["Asthma", "Diabetes", "SCD", "Prematurity", "Epilepsy", "Brain_Injury"]
PATIENT_COLUMNS = ["RecipientID", "MRN", "PatientID", "Engagement_Date", *FLAGS]
STAY_COLUMNS = [
    "Report", *CLAIM_KEY, "ProviderNPI", "AdmissionDt", "DischargeDt", "CatgofServiceCd", "AdjustedPriceAmt",
    "AdmissionDiagCd", "ICDVersion",
]


def admission_join(categorized: DataFrame, institutional: DataFrame) -> DataFrame:
    """Inpatient stays that ended at home: report IP, and EDIP too when they began in the emergency room."""
    stays = accepted_only(categorized).where(
        (F.col("RecordIDCd") == "I")
        & (F.col("Category1") == "INPATIENT")
        & F.col("Category3").isin("INPATIENT_IP", "EMERGENCY_IP")
    )
    detail = discharged_home(accepted_only(institutional)).select(
        *CLAIM_KEY, "AdmissionDt", "DischargeDt", "AdmissionDiagCd", "ICDVersion"
    )
    reports = F.when(F.col("Category3") == "EMERGENCY_IP", F.array(F.lit("IP"), F.lit("EDIP"))).otherwise(
        F.array(F.lit("IP"))
    )
    return stays.join(detail, CLAIM_KEY).withColumn("Report", F.explode(reports)).select(*STAY_COLUMNS)


def emergency_visits(categorized: DataFrame) -> DataFrame:
    """Outpatient emergency lines, the service dates standing for admission and discharge."""
    visits = accepted_only(categorized).where(
        (F.col("RecordIDCd") == "O") & (F.col("Category1") == "OUTPATIENT") & (F.col("Category3") == "EMERGENCY_OP")
    )
    return visits.withColumns(
        {
            "Report": F.lit("EDOP"),
            "AdmissionDt": F.col("ServiceFromDt"),
            "DischargeDt": F.col("ServiceThruDt"),
            "AdmissionDiagCd": F.lit(None).cast("string"),
            "ICDVersion": F.lit(None).cast("string"),
        }
    ).select(*STAY_COLUMNS)


def first_stay(stays: DataFrame) -> DataFrame:
    """Earliest discharge per report and patient, ties by claim key.

    The earliest later event of a patient is the earliest event after the
    earliest discharge, so one stay per patient is all the follow-up needs, and
    it is found by a combining minimum.
    """
    order = ["DischargeDt", "AdmissionDt", *CLAIM_KEY]
    payload = [c for c in STAY_COLUMNS if c not in order and c != "Report"]
    return (
        stays.where(F.col("DischargeDt").isNotNull())
        .groupBy("Report", "RecipientID")
        .agg(F.min(F.struct(*order, *payload)).alias("s"))
        .select("Report", "s.*")
    )


def outpatient_events(categorized: DataFrame) -> DataFrame:
    """One outpatient event per patient and day, ties by category, provider and claim key."""
    order = ["Category3", "ProviderNPI", "CatgofServiceCd", "AdjustedPriceAmt", *[k for k in CLAIM_KEY if k != "RecipientID"]]
    return (
        categorized.where(F.col("Category3").isin(OUTPATIENT_EVENTS))
        .groupBy("RecipientID", "ServiceFromDt")
        .agg(F.min(F.struct(*order)).alias("e"))
        .select(
            "RecipientID",
            F.col("ServiceFromDt").alias("EarliestServiceFromDt"),
            F.col("e.Category3").alias("OPCategory"),
            F.col("e.ProviderNPI").alias("OPProviderNPI"),
            F.col("e.CatgofServiceCd").alias("OPCatgofServiceCd"),
            F.col("e.AdjustedPriceAmt").alias("OPAdjustedPriceAmt"),
        )
    )


def first_event_after(stays: DataFrame, events: DataFrame) -> DataFrame:
    """Earliest event strictly after the discharge of each stay row; stays without one drop out."""
    picked = ["EarliestServiceFromDt", "OPCategory", "OPProviderNPI", "OPCatgofServiceCd", "OPAdjustedPriceAmt"]
    later = (F.col("s.RecipientID") == F.col("e.RecipientID")) & (
        F.col("e.EarliestServiceFromDt") > F.col("s.DischargeDt")
    )
    joined = stays.alias("s").join(events.alias("e"), later)
    return (
        joined.groupBy(*[F.col(f"s.{c}").alias(c) for c in stays.columns])
        .agg(F.min(F.struct(*[F.col(f"e.{c}").alias(c) for c in picked])).alias("f"))
        .select(*stays.columns, "f.*")
    )


def first_followup(categorized: DataFrame, institutional: DataFrame, patients: DataFrame) -> DataFrame:
    """One row per report and engaged patient: the first stay and the first event after it."""
    engaged = patients.where(F.col("Engagement_Date").isNotNull()).select(*PATIENT_COLUMNS)
    stays = admission_join(categorized, institutional).unionByName(emergency_visits(categorized))
    first = first_stay(stays).join(engaged, "RecipientID")
    followed = first_event_after(first, outpatient_events(categorized))
    status = F.when(F.col("Engagement_Date") > F.col("DischargeDt"), "PreEngagement").when(
        F.col("Engagement_Date") < F.col("DischargeDt"), "PostEngagement"
    )
    return followed.withColumns(
        {"EngagementStatus": status, "DaysDiff": F.datediff("EarliestServiceFromDt", "DischargeDt")}
    )


def describe_codes(followed: DataFrame, code_descriptions: DataFrame) -> DataFrame:
    """Adds the descriptions of both category-of-service codes."""
    codes = code_descriptions.where(F.col("DomainName") == "CatgofServiceCd")
    own = codes.select(F.col("CodeValue").alias("CatgofServiceCd"), "CodeDescription")
    later = codes.select(F.col("CodeValue").alias("OPCatgofServiceCd"), F.col("CodeDescription").alias("OPCodeDescription"))
    return followed.join(own, "CatgofServiceCd").join(later, "OPCatgofServiceCd")
