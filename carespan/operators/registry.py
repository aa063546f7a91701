"""Registry diagnoses, school deltas, demographics and small converters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.dates import whole_years_between
from carespan.functions.lookups import first_match
from carespan.functions.text import diagnosis_text_clean, non_empty_flag, strip_leading_zeros

# Flags, renames and the participant export layout (name and type of its empty columns).
BINARY_FLAGS = ["asthma", "diabetes", "scd", "prematurity", "newborn", "epilepsy"]
COLUMN_NAMES = {
    "EngagementDate": "Engagement_Date",
    "FaerDiagnosis": "Faer_Diagnosis",
    "STUDENT_ID": "Student_ID",
    "PatientID": "Patient_ID",
    "Medicaid Rin": "RIN",
    "scd": "SCD",
    "dob": "DOB",
}
PARTICIPANT_LAYOUT = [
    "PARTICIPANT_SYSTEM_ID", "PARTICIPANT_CPS_ID", "PARTICIPANT_CHA_ID", "PARTICIPANT_STATE_ID",
    "PARTICIPANT_LOCAL_ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "BIRTH_DATE", "BIRTH_MONTH", "BIRTH_DAY",
    "BIRTH_YEAR", "PARTICIPANT_GENDER", "PARTICIPANT_RACE", "DISTRICT_CODE", "CURRENT_GRADE_LEVEL",
    "CURRENT_SCHOOL", "MOTHER_MAIDEN_NAME", "STREET_NUMBER", "STREET_DIRECTION", "STREET_NAME", "STREET_TYPE",
    "UNIT", "CITY", "STATE_CODE", "POSTAL_CODE", "COUNTY_CODE", "COUNTY", "PHONE_NUMBER", "EMAIL_ADDRESS",
    "UPDATE_DATE", "age",
]
MEMBERSHIP_EMPTY = {
    "DROP_DATE": "date",
    "MEMBERSHIP_ENTRY_REASONS": "string",
    "MEMBERSHIP_EXIT_REASONS": "string",
    "MEMBERSHIP_REFERENCE": "string",
}


def _title_words(name: str) -> str:
    return name.title()


def rename_columns(df: DataFrame) -> DataFrame:
    """Fixed renames, every other column in title case around underscores."""
    return df.withColumnsRenamed({c: COLUMN_NAMES.get(c, _title_words(c)) for c in df.columns})


def constant_columns(df: DataFrame, values: dict[str, Column], layout: list[str], null_types: dict[str, str]) -> DataFrame:
    """Project onto a fixed layout; columns without a value are typed NULLs."""
    return df.select(
        *[
            (values[c] if c in values else F.lit(None).cast(null_types.get(c, "string"))).alias(c)
            for c in layout
        ]
    )


def age_group(age: Column) -> Column:
    return first_match([(age <= 1, "THB"), (age <= 5, "THT"), (age.between(13, 19), "Teen")], "")


def registry_diagnosis(registry: DataFrame) -> DataFrame:
    """Flags to a listed and a single diagnosis; epilepsy and newborns count as other diagnoses."""
    flags = {f: F.coalesce(F.col(f), F.lit(0)).cast("int") for f in BINARY_FLAGS}
    df = registry.withColumns({**flags, "_stated": non_empty_flag(F.col("other_diag"))})
    other = F.when((F.col("epilepsy") + F.col("newborn")) > 0, 1).otherwise(F.col("_stated"))
    df = df.withColumn("_other", other)
    count = F.col("asthma") + F.col("diabetes") + F.col("scd") + F.col("prematurity") + F.col("_other")
    df = df.withColumn("SumDiagnosis", count)
    df = df.withColumn(
        "other_diag",
        F.when((F.col("SumDiagnosis") == 0) | (F.col("epilepsy") == 1) | (F.col("newborn") == 1), 1).otherwise(
            F.col("_other")
        ),
    )
    listed = [("other_diag", "Other_Diagnosis"), ("diabetes", "Diabetes"), ("asthma", "Asthma"), ("scd", "SCD"), ("prematurity", "Prematurity")]
    text = F.concat_ws(" ", *[F.when(F.col(c) == 1, F.lit(f'"{name}"')) for c, name in listed])
    only = lambda c: (F.col(c) == 1) & (F.col("SumDiagnosis") == 1)
    single = first_match(
        [
            (only("prematurity"), "Prematurity"),
            (only("scd"), "SCD"),
            (only("asthma"), "Asthma"),
            (only("diabetes"), "Diabetes"),
            (F.col("SumDiagnosis") == 0, "Other Diagnosis"),
            (F.col("SumDiagnosis") > 1, "Multiple Diagnoses"),
            ((F.col("prematurity") == 1) | (F.col("newborn") == 1) | (F.col("epilepsy") == 1), "Other Diagnosis"),
        ]
    )
    return df.withColumns({"FaerDiagnosis": diagnosis_text_clean(text), "Diagnosis": single}).drop("_stated", "_other")


def icd_translate(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace codes by the dictionary's text; unknown codes stay."""
    names = dictionary.select(F.col("Code").alias(column), F.col("Text").alias("_text"))
    joined = df.join(names, column, "left")
    return joined.withColumn(column, F.coalesce("_text", column)).select(*df.columns)


def semi_anti_delta(registry: DataFrame, already_sent: DataFrame, enrolled: DataFrame) -> DataFrame:
    """Registry rows not sent before that have an enrolment, by normalized identifier."""
    return registry.join(already_sent.select("RIN"), "RIN", "left_anti").join(enrolled.select("RIN"), "RIN", "left_semi")


def membership_delta(new_rows: DataFrame, enrolled: DataFrame) -> DataFrame:
    dates = enrolled.select(
        "RIN",
        F.to_date("First_Enrollment_Date").alias("BEGIN_DATE"),
        F.to_date("DisEnrollment_Date").alias("END_DATE"),
    )
    joined = new_rows.select("RIN").join(dates, "RIN", "left")
    values = {
        "PARTICIPANT_SYSTEM_ID": strip_leading_zeros(F.col("RIN")),
        "BEGIN_DATE": F.col("BEGIN_DATE"),
        "END_DATE": F.col("END_DATE"),
    }
    return constant_columns(joined, values, [*values, *MEMBERSHIP_EMPTY], MEMBERSHIP_EMPTY)


def participant_delta(new_rows: DataFrame, as_of: date) -> DataFrame:
    """The 32-column participant layout; age in whole average years at ``as_of``."""
    number = strip_leading_zeros(F.col("RIN"))
    born = F.to_date("dob")
    values = {
        "PARTICIPANT_SYSTEM_ID": number,
        "PARTICIPANT_LOCAL_ID": number,
        "FIRST_NAME": F.col("fn"),
        "LAST_NAME": F.col("ln"),
        "BIRTH_DATE": born,
        "PARTICIPANT_GENDER": F.col("gender"),
        "POSTAL_CODE": F.col("zip_code"),
        "age": whole_years_between(F.lit(as_of), born),
    }
    return constant_columns(new_rows, values, PARTICIPANT_LAYOUT, {"UPDATE_DATE": "date"})


def demo_assembly(enrollment: DataFrame, status: DataFrame, grouping: DataFrame, risk: DataFrame) -> DataFrame:
    """Enrolment with current status and grouping; patients without a risk row drop out."""
    return (
        enrollment.join(status, "RecipientID", "left")
        .join(grouping, "RecipientID", "left")
        .join(risk, "PatientID", "inner")
    )
