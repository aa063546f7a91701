"""Contact outcomes, reasons and per-patient contact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.lookups import first_match, map_value
from carespan.functions.text import reason_clean

# Outcome texts, contact parties and types, service categories of cleaned reasons.
OUTCOMES = {
    "Wrong Number or Number Disconnected/Out of Service": ("Unsuccessful", "Phone Contact"),
    "Unable to reach": ("Unsuccessful", "Phone Contact"),
    "Successful": ("Successful", "Phone Contact"),
    "Declined/Opted Out of Program": ("Successful", "Phone Contact"),
    "Face to face visit successful": ("Successful", "Home Visit"),
    "Left Message": ("Unsuccessful", "Phone Contact"),
    "Face to face visit not successful": ("Unsuccessful", "Home Visit"),
}
OUTCOME_TYPES = [
    "Successful Home Visit",
    "Successful Phone Contact",
    "Unsuccessful Home Visit",
    "Unsuccessful Phone Contact",
]
PATIENT_PARTIES = ["Caregiver", "Patient", "Home"]
PATIENT_CONTACT_TYPES = ["Phone - Outbound", "Visit", "Home", "Phone - Inbound"]
SERVICE_CATEGORIES = {
    "A.S.C.": [
        "Tier 1 Assessment", "Tier 2 Assessment", "Tier 2 Follow Up Assessment", "Tier 3 Assessment",
        "Tier 3 Follow Up Assessment", "Clinical Interview", "Developmental Screening/Services",
        "Discharge Planning", "Ed Follow Up", "Ed/Hospitalization Follow Up", "Initial Patient Contact",
        "Notice Of Hospital Admission", "Notification Hospital Admit/Discharge", "Patient Visit",
        "Review Of Care Plan", "Review/Modification Of Care Plan",
    ],
    "Consultations": [
        "Care Coordination Consultation With Pcp", "Care Coordination Consultation With Physician",
        "Care Coordination Consultation With Specialist", "Case Consultation", "Clinical Rounds", "Complaint",
        "Coordinate With Pcp/Specialist", "Coordination/Information",
    ],
    "Health Promotion/Education": [
        "Address Medical/Clinical Concern Or Issue", "Appointment Coordination", "Appointment Follow Up",
        "Appointment Reminder", "Appointment Scheduling", "Care Coordination", "Care Coordination Follow Up",
        "Care Coordination Plan", "Child Skills Group", "Dental Concern", "Dental Concern Or Issue",
        "Dvd Follow Up", "Education Session", "In Person Intervention", "Medication /Prescription Concerns",
        "Parenting Skills Group", "Portal", "Portal Information", "Skill Building Intervention",
        "Suicide Protocol/Crisis Intervention", "The Happiest Baby Intervention",
    ],
    "Maintenance": [
        "Address Enrollment Questions", "Birthday", "Enrollment", "Incentive", "Information Received",
        "Medical Records", "Medical/Clinical Concern Or Issue", "Other See Notes", "Response To Utr Letter",
        "Return Call", "Returned Mail", "Satisfaction Survey", "Unable To Reach Letter",
        "Unable To Reach Via Phone",
    ],
    # 'Change of PCP or Specialist' is not title case, so no cleaned reason ever equals it.
    "Referrals": [
        "Change of PCP or Specialist", "Community Resource Coordination/Information",
        "Community Resource Information", "Community Resources", "Dental Appointment Coordination",
        "Insurance Information", "Insurance Question", "Mail From Social Service Agency",
        "Mental Health Concern Or Follow Up", "Mental Health Concern Or Issue", "Pharmacy Concern",
        "Pharmacy Concern Or Issue", "Pharmacy Insurance Concerns", "Referral", "Referral Follow Up",
        "Transportation", "Transportation Concern", "Transportation Coordination",
    ],
}
NO_SERVICE_CATEGORY = "Nothing"


def patient_contact_only(contacts: DataFrame) -> DataFrame:
    return contacts.where(
        F.col("ContactPartyGBLCode").isin(PATIENT_PARTIES) & F.col("ContactTypeGBLcode").isin(PATIENT_CONTACT_TYPES)
    )


def contact_outcome(outcome: Column, precise: bool) -> Column:
    """Successful or Unsuccessful, with the kind of contact when ``precise``; NULL for other texts."""
    names = {text: f"{success} {kind}" if precise else success for text, (success, kind) in OUTCOMES.items()}
    return map_value(names, outcome)


def contact_patient_left(contacts: DataFrame, patients: DataFrame) -> DataFrame:
    return contacts.join(patients.select(F.col("ID").alias("PatientID"), "MedicaidNum"), "PatientID", "left")


def contact_report(contacts: DataFrame, patients: DataFrame, patients_only: bool = False) -> DataFrame:
    chosen = patient_contact_only(contacts) if patients_only else contacts
    return contact_patient_left(chosen, patients).withColumns(
        {
            "ContactTypeSuccess": contact_outcome(F.col("OutcomeStatusGBLCode"), True),
            "ContactSuccess": contact_outcome(F.col("OutcomeStatusGBLCode"), False),
        }
    )


def _column(kind: str) -> str:
    return kind.replace(" ", "_")


def _per_patient(contacts: DataFrame, patients: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregate by patient first, so that only one row of each patient meets the patient table."""
    ids = patients.where(F.col("MedicaidNum").isNotNull()).select(F.col("ID").alias("PatientID"), "MedicaidNum")
    return contacts.groupBy("PatientID").agg(*aggregates).join(ids, "PatientID")


def _typed(contacts: DataFrame) -> DataFrame:
    kind = contact_outcome(F.col("OutcomeStatusGBLCode"), True)
    return contacts.withColumn("ContactTypeSuccess", kind).where(F.col("ContactTypeSuccess").isNotNull())


def recent_contact_pivot(contacts: DataFrame, patients: DataFrame) -> DataFrame:
    """Date of the latest outcome of each type per patient; patients without any outcome time drop out."""
    latest = [
        F.to_date(F.max(F.when(F.col("ContactTypeSuccess") == k, F.col("OutcomeDateTime")))).alias(_column(k))
        for k in OUTCOME_TYPES
    ]
    dated = _typed(contacts).where(F.col("OutcomeDateTime").isNotNull())
    return _per_patient(dated, patients, *latest)


def contact_counts(contacts: DataFrame, patients: DataFrame) -> DataFrame:
    """Contacts of each outcome type per patient, 0 filled."""
    counts = [
        F.count(F.when(F.col("ContactTypeSuccess") == k, F.col("ContactTS"))).alias(f"Count_of_{_column(k)}")
        for k in OUTCOME_TYPES
    ]
    return _per_patient(_typed(contacts), patients, *counts)


def service_category(reason: Column) -> Column:
    """Category of a cleaned reason; the first list that holds it wins."""
    return first_match([(reason.isin(r), name) for name, r in SERVICE_CATEGORIES.items()], NO_SERVICE_CATEGORY)


def contact_services(contacts: DataFrame) -> DataFrame:
    cleaned = contacts.withColumn("Reason", reason_clean(F.col("ContactReasonGBLCode")))
    return cleaned.withColumn("Service_Category", service_category(F.col("Reason")))


def phone_patient_left(phones: DataFrame, patients: DataFrame) -> DataFrame:
    """Phone numbers with patient numbers in the fixed export layout."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    number = F.concat(
        "PhoneNumberAC", F.lit("-"), "PhoneNumberPrefix", F.lit("-"), "PhoneNumberLineNumber"
    )
    joined = phones.join(patients.select(F.col("ID").alias("PatientID"), "MedicaidNum"), "PatientID", "left")
    return joined.select(
        F.col("PatientID").alias("Patient_ID"),
        "MedicaidNum",
        *[F.lit("Phone").alias(c) for c in ("Record_Type", "Party_Name", "Party_Relationship", "Party_Type")],
        F.col("Description").alias("Phone_Type"),
        number.alias("Phone_Number"),
        F.col("PrimaryFlag").alias("Primary_Flag"),
        day("StartDate").alias("Phone_Number_StartDate"),
        day("EndDate").alias("Phone_Number_EndDate"),
        day("CTS").alias("Phone_Number_Created"),
        day("MTS").alias("Phone_Number_Updated"),
    )
