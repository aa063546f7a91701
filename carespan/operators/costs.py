"""Patient costs: categorized claims placed in months relative to programme entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.functions.dates import avg_months_between

MEASURES = ["AdjustedPriceAmt", "Encounter", "Service_Count", "Visit_Inpatient_Days"]
UNCATEGORIZED = "Uncategorized"
CATEGORY_LEVELS = ["Summary_Category", "Category1", "Category2", "Category3"]


def cost_window(costs: DataFrame, patients: DataFrame) -> DataFrame:
    """Adds Program_Date and Window, the average-month offset from it, rounded up."""
    months = F.ceil(avg_months_between(F.col("ServiceFromDt"), F.col("Program_Date"))).cast("int")
    dated = costs.join(patients.select("RecipientID", "Program_Date"), "RecipientID")
    return dated.withColumn("Window", months)


def category_levels(costs: DataFrame) -> DataFrame:
    """One row per cost and level: summary, c1, c1_c2, c1_c2_c3 as (Category_Type, Category).

    A cost without a category at a level counts under UNCATEGORIZED there.
    """
    values = {
        "Summary_Category": F.col("Summary_Category"),
        "Category1": F.col("Category1"),
        "Category2": F.concat("Category1", F.lit("_"), "Category2"),
        "Category3": F.concat("Category1", F.lit("_"), "Category2", F.lit("_"), "Category3"),
    }
    levels = F.array(
        *[
            F.struct(F.lit(k).alias("Category_Type"), F.coalesce(v, F.lit(UNCATEGORIZED)).alias("Category"))
            for k, v in values.items()
        ]
    )
    kept = [c for c in costs.columns if c not in CATEGORY_LEVELS]
    return costs.select(*kept, F.inline(levels))


def daily_costs(costs: DataFrame) -> DataFrame:
    """Sums per patient, day and summary category: bounded rows for even the busiest patient."""
    return costs.groupBy("RecipientID", "ServiceFromDt", "Summary_Category").agg(
        F.sum("AdjustedPriceAmt").alias("AdjustedPriceAmt"),
        F.sum("Visit").alias("Visit"),
        F.sum("Visit_Inpatient_Days").alias("Visit_Inpatient_Days"),
    )


def daily_category_costs(costs: DataFrame) -> DataFrame:
    """Measures per patient, day and full category: the grain to join patients at."""
    return costs.groupBy("RecipientID", "ServiceFromDt", *CATEGORY_LEVELS).agg(*[F.sum(m).alias(m) for m in MEASURES])
