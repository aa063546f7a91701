"""Population counts by label."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ["Current_Risk", "Diagnosis_Category", "Age_Category"]
# Flag column of each named population.
POPULATION_FLAGS = {"Engaged": "E2", "Enrolled": "E4"}
CROSSES = [
    ("Age_Category", "Diagnosis_Category"),
    ("Current_Risk", "Diagnosis_Category"),
    ("Current_Risk", "Age_Category"),
]


def _label_pairs(*names: str):
    return F.array(*[F.struct(F.lit(n).alias("Label_Type"), F.col(n).alias("Label")) for n in names])


def label_counts(patients: DataFrame) -> DataFrame:
    """Patients per risk, diagnosis and age label, in one aggregation."""
    return (
        patients.select(F.inline(_label_pairs(*LABELS)))
        .groupBy("Label_Type", "Label")
        .agg(F.count(F.lit(1)).alias("Count"))
    )


def label_cross_counts(patients: DataFrame) -> DataFrame:
    """Patients per pair of labels: counted once per combination of all labels, then rolled up to the three pairs."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(a).alias("First_Type"), F.col(a).alias("First_Label"),
                F.lit(b).alias("Second_Type"), F.col(b).alias("Second_Label"),
            )
            for a, b in CROSSES
        ]
    )
    finest = patients.groupBy(*sorted({c for pair in CROSSES for c in pair})).agg(F.count(F.lit(1)).alias("n"))
    return (
        finest.select("n", F.inline(pairs))
        .groupBy("First_Type", "First_Label", "Second_Type", "Second_Label")
        .agg(F.sum("n").alias("Count"))
    )


def population_label_counts(patients: DataFrame) -> DataFrame:
    """Engaged and enrolled patients per label."""
    populations = F.array_compact(
        F.array(*[F.when(F.col(flag) == 1, F.lit(name)) for name, flag in POPULATION_FLAGS.items()])
    )
    return (
        patients.select(F.explode(populations).alias("Population"), *LABELS)
        .select("Population", F.inline(_label_pairs(*LABELS)))
        .groupBy("Population", "Label_Type", "Label")
        .agg(F.count(F.lit(1)).alias("Count"))
    )


def population_label_value(patients: DataFrame, population: str, label_type: str, value: str) -> DataFrame:
    """One count for a population and a label value, matched without regard to case."""
    members = patients.where(F.col(POPULATION_FLAGS[population]) == 1)
    chosen = members.where(F.upper(F.col(label_type)) == value.upper())
    return chosen.agg(F.count("RecipientID").alias("Count"))


def population_label_values(patients: DataFrame, commands: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The counts of many (population, label type, value) at once, from one grouped table; 0 where nobody fits."""
    asked = F.array(
        *[F.struct(F.lit(p).alias("Population"), F.lit(k).alias("Label_Type"), F.lit(v).alias("Value")) for p, k, v in commands]
    )
    found = F.map_from_entries(F.collect_list(F.struct(F.struct("Population", "Label_Type", "Name"), "Count")))
    counts = (
        population_label_counts(patients)
        .groupBy("Population", "Label_Type", F.upper("Label").alias("Name"))
        .agg(F.sum("Count").alias("Count"))
        .agg(found.alias("counts"))
    )
    listed = counts.select("counts", F.inline(asked))
    count = F.try_element_at("counts", F.struct("Population", "Label_Type", F.upper("Value").alias("Name")))
    return listed.select("Population", "Label_Type", "Value", F.coalesce(count, F.lit(0)).cast("bigint").alias("Count"))


def rpt_population_summary(patients: DataFrame) -> DataFrame:
    """All counts in one tidy table: everyone, engaged and enrolled, by one or two labels."""
    populations = F.array_compact(
        F.array(F.lit("All"), *[F.when(F.col(flag) == 1, F.lit(name)) for name, flag in POPULATION_FLAGS.items()])
    )
    singles = [
        F.struct(
            F.lit(n).alias("Label_Type"), F.col(n).alias("Label"),
            F.lit(None).cast("string").alias("Cross_Type"), F.lit(None).cast("string").alias("Cross_Label"),
        )
        for n in LABELS
    ]
    crosses = [
        F.struct(
            F.lit(a).alias("Label_Type"), F.col(a).alias("Label"),
            F.lit(b).alias("Cross_Type"), F.col(b).alias("Cross_Label"),
        )
        for a, b in CROSSES
    ]
    rows = patients.select(F.explode(populations).alias("Population"), *LABELS).select(
        "Population",
        F.inline(F.when(F.col("Population") == "All", F.array(*singles, *crosses)).otherwise(F.array(*singles))),
    )
    return rows.groupBy("Population", "Label_Type", "Label", "Cross_Type", "Cross_Label").agg(
        F.count(F.lit(1)).alias("Count")
    )


def latest_release(stage_counts: DataFrame) -> DataFrame:
    return stage_counts.agg(
        F.max("ReleaseNum").alias("ReleaseNum"), F.max("EndReleaseDate").alias("EndReleaseDate")
    )
