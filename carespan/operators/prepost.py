"""Costs and utilization before and after programme entry."""

from __future__ import annotations

from datetime import date
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.dates import add_calendar_months, avg_months_between
from carespan.functions.lookups import map_value
from carespan.operators.cube import roll_up

# Settlement lag, first bills, durations, measures, categories and group lists.
SETTLEMENT_MONTHS = 6
FIRST_BILL_DATE = date(2014, 5, 1)
DURATIONS = (6, 12, 18)
MEASURES = ["AdjustedPriceAmt", "Visit", "Visit_Inpatient_Days"]
CATEGORY_NAMES = {
    "INPATIENT": "Inpatient",
    "OUTPATIENT": "Outpatient",
    "ED": "ED",
    "OTHER": "Other",
    "Pharmacy": "Pharmacy",
}
COST_COLUMNS = [
    "Inpatient_Pre", "Inpatient_Post", "Outpatient_Pre", "Outpatient_Post", "ED_Pre", "ED_Post",
    "Other_Pre", "Other_Post", "Pharmacy_Pre", "Pharmacy_Post", "Total_Pre", "Total_Post",
]
GROUPINGS = [
    ["Holistic"],
    ["Diagnosis_Category"],
    ["Age_Cat"],
    ["Diagnosis_Category", "Age_Cat"],
    ["Risk"],
    ["Risk", "Diagnosis_Category"],
    ["Gender", "Diagnosis_Category"],
    ["Gender", "Pregnancy"],
]


def pt_windows(patients: DataFrame, release_date: Column, first_bill: date = FIRST_BILL_DATE) -> DataFrame:
    """Whole average months of data before and after programme entry."""
    end = add_calendar_months(release_date, -SETTLEMENT_MONTHS)
    before = F.floor(avg_months_between(F.col("Program_Date"), F.lit(first_bill)))
    after = F.floor(avg_months_between(end, F.col("Program_Date")))
    return patients.select(
        "RecipientID",
        "Program_Date",
        before.cast("int").alias("Negative_Duration"),
        after.cast("int").alias("Positive_Duration"),
        "ReleaseNum",
    )


def patient_release_inner(windows: DataFrame, patients: DataFrame) -> DataFrame:
    return windows.join(patients, ["RecipientID", "Program_Date", "ReleaseNum"], "inner")


def pre_post_bounds(df: DataFrame, months: Column) -> DataFrame:
    return df.withColumns(
        {
            "Min_Date": add_calendar_months(F.col("Program_Date"), -months),
            "Max_Date": add_calendar_months(F.col("Program_Date"), months),
        }
    )


def pre_post_label(program: Column, service: Column) -> Column:
    return F.when(program > service, "Pre").otherwise("Post")


def category_rename(category: Column) -> Column:
    return map_value(CATEGORY_NAMES, category)


def pre_post_cohort(
    windows: DataFrame, patients: DataFrame, release: int, durations: Sequence[int] = DURATIONS
) -> DataFrame:
    """One row per patient and duration for which enough months exist on both sides."""
    eligible = windows.where(F.col("ReleaseNum") == release).withColumn(
        "Duration", F.explode(F.array(*[F.lit(d) for d in durations]))
    )
    eligible = eligible.where(
        (F.col("Negative_Duration") >= F.col("Duration")) & (F.col("Positive_Duration") >= F.col("Duration"))
    )
    return pre_post_bounds(patient_release_inner(eligible, patients), F.col("Duration"))


def cohort_left_costs(cohort: DataFrame, daily: DataFrame) -> DataFrame:
    """Cohort rows with their costs inside the bounds; patients without any keep one row of NULLs."""
    in_bounds = (F.col("p.RecipientID") == F.col("c.RecipientID")) & F.col("c.ServiceFromDt").between(
        F.col("p.Min_Date"), F.col("p.Max_Date")
    )
    return (
        cohort.select("RecipientID", "Duration", "ReleaseNum", "Program_Date", "Min_Date", "Max_Date")
        .alias("p")
        .join(daily.alias("c"), in_bounds, "left")
        .select(
            "p.*",
            F.col("c.ServiceFromDt").alias("ServiceFromDt"),
            category_rename(F.col("c.Summary_Category")).alias("Category"),
            F.when(
                F.col("c.ServiceFromDt").isNotNull(),
                pre_post_label(F.col("p.Program_Date"), F.col("c.ServiceFromDt")),
            ).alias("Pre_Post"),
            *[F.col(f"c.{m}").alias(m) for m in MEASURES],
        )
    )


def _pivot_sums() -> list[Column]:
    cells = []
    for measure in MEASURES:
        amount = F.col(measure).cast("decimal(28,2)")
        for column in COST_COLUMNS:
            category, side = column.split("_")
            match = F.col("Category").isNotNull() if category == "Total" else F.col("Category") == category
            total = F.sum(F.when(match & (F.col("Pre_Post") == side), amount))
            cells.append(F.coalesce(total, F.lit(0).cast("decimal(28,2)")).alias(f"{measure}__{column}"))
    return cells


def pre_post_pivot(cohort_costs: DataFrame) -> DataFrame:
    """Twelve sums per patient, duration and measure; patients without bills get zeros."""
    wide = cohort_costs.groupBy("RecipientID", "Duration", "ReleaseNum").agg(*_pivot_sums())
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("Aggregation_Type"), *[F.col(f"{m}__{c}").alias(c) for c in COST_COLUMNS])
            for m in MEASURES
        ]
    )
    return wide.select("RecipientID", "Duration", "ReleaseNum", F.inline(rows))


def grouping_columns(patients: DataFrame) -> DataFrame:
    """Label columns the groupings use, from a patient frame with programme columns."""
    return patients.withColumns(
        {
            "Holistic": F.lit("1"),
            "Age_Cat": F.col("Program_Age_Category"),
            "Risk": F.col("Program_Risk"),
            "Pregnancy": F.coalesce(F.col("Preg_Flag").cast("string"), F.lit("nan")),
        }
    )


def dense_group_cross(labels: DataFrame, by: Sequence[str], groupings: Sequence[Sequence[str]]) -> DataFrame:
    """Every combination of label values observed within each ``by`` group, for each grouping.

    Observed values are a handful per column, so they are gathered as sets and
    combined inside the row; no patient rows are multiplied.
    """
    columns = sorted({c for g in groupings for c in g})
    observed = labels.groupBy(*by).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])

    def combine(left: Column, right: Column) -> Column:
        return F.flatten(
            F.transform(left, lambda a: F.transform(right, lambda b: F.concat(a, F.lit("::"), b)))
        )

    sets = F.array(
        *[
            F.struct(
                F.lit("::".join(g)).alias("Group_Type"),
                reduce(combine, [F.col(c) for c in g]).alias("subsets"),
            )
            for g in groupings
        ]
    )
    return observed.select(*by, F.inline(sets)).select(*by, "Group_Type", F.explode("subsets").alias("Group_Subset"))


def pre_post_groupings(individual: DataFrame, patients: DataFrame) -> DataFrame:
    """Mean of the twelve columns per group, measure and duration; unseen combinations count zero.

    Grouping columns always start with Population_Type. Patient rows enter one aggregation, by all labels; the eight
    group lists are rolled up from its rows.
    """
    groupings = [["Population_Type", *g] for g in GROUPINGS]
    label_columns = sorted({c for g in groupings for c in g})
    labels = grouping_columns(patients).select("RecipientID", *label_columns)
    labelled = individual.join(labels, "RecipientID")
    by = ["Duration", "ReleaseNum"]
    keys = [*by, "Aggregation_Type"]
    sums = [F.count(F.lit(1)).alias("N"), *[F.sum(c).alias(c) for c in COST_COLUMNS]]
    finest = labelled.groupBy(*label_columns, *keys).agg(*sums)
    rolled = roll_up(finest, groupings, keys, ["N", *COST_COLUMNS])
    means = rolled.select(
        *keys,
        "Group_Type",
        "Group_Subset",
        "N",
        *[F.round(F.col(c) / F.col("N"), 2).cast("decimal(28,2)").alias(c) for c in COST_COLUMNS],
    )
    one_measure = labelled.where(F.col("Aggregation_Type") == MEASURES[0])
    dense = dense_group_cross(one_measure, by, groupings).withColumn(
        "Aggregation_Type", F.explode(F.array(*[F.lit(m) for m in MEASURES]))
    )
    return (
        dense.join(means, [*by, "Aggregation_Type", "Group_Type", "Group_Subset"], "left")
        .fillna(0, ["N", *COST_COLUMNS])
        .select(
            "Group_Type",
            "Group_Subset",
            F.lit("mean").alias("Aggregation_Function"),
            F.col("Aggregation_Type").alias("Value"),
            "N",
            *COST_COLUMNS,
            *by,
        )
    )
