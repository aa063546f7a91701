"""Diagnosis classification from inclusion and exclusion codes."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.lookups import first_match

# Required share of inclusion codes; every other group needs all of them.
INCLUSION_RATIO = {"SCD": 0.75}
DEFAULT_RATIO = 1.0
PRIMARY_GROUPS = ["SCD", "Prematurity", "Epilepsy", "Brain_Injury", "Diabetes", "Asthma"]
PREGNANCY_GROUPS = ["Antenatal_care", "Delivery", "Abortive"]
NO_CODES = "0"


def dx_code_counts(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.groupBy("RecipientID", "DiagCd").agg(F.count(F.lit(1)).alias("ICD_Count"))


def icd_list(patients: DataFrame, code_counts: DataFrame) -> DataFrame:
    """Distinct codes per patient as a sorted array; patients without any keep an empty one.

    Works from one row per (patient, code), so a set holds distinct codes only.
    """
    codes = code_counts.groupBy("RecipientID").agg(F.array_sort(F.collect_set("DiagCd")).alias("ICD_Codes"))
    joined = patients.join(codes, "RecipientID", "left")
    filled = F.coalesce("ICD_Codes", F.array().cast("array<string>"))
    text = F.when(F.size(filled) == 0, NO_CODES).otherwise(F.concat_ws(",", filled))
    return joined.withColumns({"ICD_Codes": filled, "ICD_List": text})


def code_table_inner(code_counts: DataFrame, code_table: DataFrame) -> DataFrame:
    return code_counts.join(code_table, code_counts["DiagCd"] == code_table["Dx_Code"], "inner")


UNLISTED = "Unlisted_Groups"


def required_ratio(group: Column) -> Column:
    return first_match([(group == name, ratio) for name, ratio in INCLUSION_RATIO.items()], DEFAULT_RATIO)


def dx_inclusion_exclusion(code_counts: DataFrame, code_table: DataFrame) -> DataFrame:
    """(patient, group) pairs that meet the group's inclusion share with at least one inclusion code."""
    included = F.sum(F.when(F.col("Incl_Excl") == "I", F.col("ICD_Count")).otherwise(0))
    excluded = F.sum(F.when(F.col("Incl_Excl") == "E", F.col("ICD_Count")).otherwise(0))
    return (
        code_table_inner(code_counts, code_table)
        .groupBy("RecipientID", "Group_Name")
        .agg(included.alias("Included"), excluded.alias("Excluded"))
        .where(F.col("Included") >= 1)
        .where(F.col("Included") >= required_ratio(F.col("Group_Name")) * (F.col("Included") + F.col("Excluded")))
    )


def dx_flags(patients: DataFrame, code_counts: DataFrame, code_table: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One 0/1 column per group for every patient, and the names of groups that ``groups`` doesn't list."""
    qualified = dx_inclusion_exclusion(code_counts, code_table)
    flags = [F.max(F.when(F.col("Group_Name") == g, 1).otherwise(0)).alias(g) for g in groups]
    unlisted = F.collect_set(F.when(~F.col("Group_Name").isin(list(groups)), F.col("Group_Name")))
    per_patient = qualified.groupBy("RecipientID").agg(*flags, F.array_join(F.array_sort(unlisted), ",").alias(UNLISTED))
    return patients.join(per_patient, "RecipientID", "left").fillna(0, list(groups)).fillna("", [UNLISTED])


def dx_pregnancy(patients: DataFrame, code_counts: DataFrame, code_table: DataFrame) -> DataFrame:
    """Preg_Flag: 1 coded and eligible, 0 not coded, NULL coded but not eligible."""
    flagged = dx_flags(patients, code_counts, code_table, PREGNANCY_GROUPS)
    coded = sum((F.col(g) for g in PREGNANCY_GROUPS[1:]), F.col(PREGNANCY_GROUPS[0]))
    eligible = (F.col("Enrollment_Age") > 10) & (F.col("Gender") == "Female")
    return flagged.withColumn("Preg_Flag", F.when(coded == 0, 0).when(eligible, 1))


def diagnosis_category() -> Column:
    """One label per patient; the first that holds."""
    return first_match(
        [
            (F.col("ICD_List") == NO_CODES, "NA"),
            (F.col("SCD") == 1, "SCD"),
            (F.col("Prematurity") > 0, "Prematurity"),
            ((F.col("Epilepsy") > 0) | (F.col("Brain_Injury") > 0), "Neurological"),
            (F.col("Diabetes") > 0, "Diabetes"),
            (F.col("Asthma") > 0, "Asthma"),
        ],
        "Other",
    )


def dx_primary(patients: DataFrame, code_counts: DataFrame, code_table: DataFrame) -> DataFrame:
    """Primary flags and category. Prematurity only counts up to age 3 at enrolment."""
    flagged = dx_flags(icd_list(patients, code_counts), code_counts, code_table, PRIMARY_GROUPS)
    too_old = F.col("Enrollment_Age") > 3
    young = flagged.withColumn("Prematurity", F.when(too_old, 0).otherwise(F.col("Prematurity")))
    return young.withColumn("Diagnosis_Category", diagnosis_category())
