"""Monthly and programme reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.operators.contacts import recent_contact_pivot
from carespan.operators.followup import describe_codes, first_followup
from carespan.operators.keys import inclusive_between
from carespan.operators.utilization import (
    in_window,
    months_in_program,
    util_cumulative,
    util_daily,
    util_min_max,
    util_pivot,
)

# Status, groups, payer and placeholder of the monthly reports.
ACTIVE = "Active"
ENGAGED = "Engaged"
ENROLLED = "Enrolled"
DEFAULT_PAYER = "Blue Cross Blue Shield"
UNASSIGNED = "Unassigned"
FOLLOWUP_COLUMNS = [
    "Category", "EngagementStatus", "RecipientID", "MRN", "PatientID", "Engagement_Date", "AdmissionDt",
    "DischargeDt", "ProviderNPI", "CodeDescription", "AdjustedPriceAmt", "AdmissionDiagCd", "ICDVersion",
    "OPCategory", "OPProviderNPI", "OPCodeDescription", "OPAdjustedPriceAmt", "EarliestServiceFromDt", "DaysDiff",
    "Asthma", "Diabetes", "SCD", "Prematurity", "Epilepsy", "Brain_Injury", "Release_Number",
]
UTILIZER_COLUMNS = [
    "RecipientID", "PatientID", "MRN", "Asthma", "Diabetes", "SCD", "Prematurity", "Brain_Injury", "Epilepsy",
    "Program_Date", "Current_Risk", "HC", "E2", "E4", "HE2", "HE4",
]


def report_cohorts(demographics: DataFrame, group: str | None = None, payer: str | None = None) -> DataFrame:
    """Active patients, optionally of one group and one payer."""
    out = demographics.where(F.col("Current_Enrollment_Status") == ACTIVE)
    out = out.where(F.col("Group") == group) if group else out
    return out.where(F.col("MCO_Name") == payer) if payer else out


def labelled_cohorts(demographics: DataFrame, payer: str = DEFAULT_PAYER) -> DataFrame:
    """Active patients once for each cohort they are in: active, enrolled, engaged payer."""
    member = {
        "active": F.lit(True),
        "enrolled": F.col("Group") == ENROLLED,
        "engaged payer": (F.col("Group") == ENGAGED) & (F.col("MCO_Name") == payer),
    }
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in member.items()]))
    return report_cohorts(demographics).withColumn("Cohort", F.explode(names))


def rpt_act(act_scores: DataFrame, care_team: DataFrame, start: date, end: date) -> DataFrame:
    picked = inclusive_between(act_scores, "StartDate", F.lit(start), F.lit(end))
    return picked.select("PatientID", "StartDate", "Assessment_Count", "ACT_Total_Score", "ACT_Result").join(
        care_team, "PatientID", "left"
    )


def rpt_active_engaged_payer(demographics: DataFrame, payer: str = DEFAULT_PAYER) -> DataFrame:
    return report_cohorts(demographics, ENGAGED, payer).select(
        "PatientID", "RecipientID", "First_Name", "Last_Name", "Gender", "DOB", "Current_Enrollment_Status"
    )


def rpt_enrolled_not_engaged(demographics: DataFrame, care_team: DataFrame) -> DataFrame:
    return (
        report_cohorts(demographics, ENROLLED)
        .join(care_team, "PatientID", "left")
        .select("PatientID", "RecipientID", F.coalesce("AssignedTo", F.lit(UNASSIGNED)).alias("AssignedTo"), "Initial_Enrollment_Date")
    )


def careplan_assembly(
    demographics: DataFrame,
    contacts: DataFrame,
    contact_patients: DataFrame,
    careplans: DataFrame,
    worker_mapping: DataFrame,
    workers: DataFrame,
) -> DataFrame:
    """Active patients with latest contacts, care plan and worker."""
    recent = recent_contact_pivot(contacts, contact_patients).drop("MedicaidNum")
    mapped = worker_mapping.select("PatientID", "NetID").join(
        workers.select("NetID", "ConsensusUsername", "FirstName"), "NetID", "left"
    )
    active = report_cohorts(demographics).select(
        "PatientID", "RecipientID", "Group", "Engagement_Date", F.col("Consensus_Risk").alias("Risk")
    )
    return (
        active.join(recent, "PatientID", "left")
        .join(careplans.select("PatientID", "StartDate"), "PatientID", "left")
        .join(mapped, "PatientID", "left")
    )


def rpt_careplan_with(assembled: DataFrame, care_team: DataFrame) -> DataFrame:
    planned = assembled.where(F.col("StartDate").isNotNull() & (F.col("Group") == ENGAGED))
    return planned.join(care_team, "PatientID", "left")


def rpt_careplan_without(assembled: DataFrame, care_team: DataFrame) -> DataFrame:
    unplanned = assembled.where(F.col("StartDate").isNull() & (F.col("Group") == ENGAGED))
    return unplanned.join(care_team, "PatientID", "left").select(
        "PatientID", "RecipientID", "Group", "Engagement_Date", "Risk", "NetID", "ConsensusUsername", "FirstName",
        F.coalesce("AssignedTo", F.lit(UNASSIGNED)).alias("AssignedTo"),
    )


def rpt_payer_worker(demographics: DataFrame, care_team: DataFrame) -> DataFrame:
    return (
        report_cohorts(demographics)
        .join(care_team, "PatientID", "left")
        .select("PatientID", "Current_Enrollment_Status", "MCO_Name")
    )


def rpt_high_utilizers(
    claims: DataFrame, patients: DataFrame, after: Column, release_date: Column, release: Column
) -> DataFrame:
    """Utilization of the release window and since programme entry, with demographics.

    Everything is summed from one patient-day table.
    """
    daily = util_daily(claims.where(F.col("ServiceFromDt") <= release_date))
    window = in_window(daily, after, release_date)
    in_release = window.select("RecipientID").distinct()
    cumulative = util_cumulative(daily.join(in_release, "RecipientID", "left_semi"), patients, release_date)
    return (
        util_pivot(window)
        .join(util_min_max(window), "RecipientID")
        .join(cumulative, "RecipientID")
        .join(patients.select(*UTILIZER_COLUMNS), "RecipientID", "left")
        .withColumns(
            {
                "Months_In_Program": months_in_program(release_date, F.col("Program_Date")),
                "Release_Number": release,
            }
        )
    )


def rpt_followup(
    categorized: DataFrame, institutional: DataFrame, patients: DataFrame, code_descriptions: DataFrame, release: int
) -> DataFrame:
    """First follow-up after inpatient, emergency-inpatient and emergency-outpatient care in one job."""
    followed = first_followup(categorized, institutional, patients)
    return (
        describe_codes(followed, code_descriptions)
        .withColumns({"Category": F.col("Report"), "Release_Number": F.lit(release)})
        .select(*FOLLOWUP_COLUMNS)
    )
