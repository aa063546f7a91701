"""Pre/post comparison, rolling windows, utilization, follow-up and their reports."""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.operators import costs as cost_ops
from carespan.operators import followup, keys, prepost, rolling, utilization as util
from carespan.operators.patients import program_columns
from carespan.plans import analysis, reports
from carespan.queries.bindings import FIRST_BILL, RELEASE, RELEASE_DATE
from carespan.queries.claims import categorized
from carespan.queries.registry import Inputs, fragment, register

FIRST = date.fromisoformat(FIRST_BILL)
AS_OF = date.fromisoformat(RELEASE_DATE)
MONTH = "30.436875"


def as_of():
    return F.lit(AS_OF)


def labelled(t: Inputs) -> DataFrame:
    return program_columns(t.in_patient)


# Pre/post.

fragment(
    "ref_windows",
    f"""
SELECT RecipientID, Program_Date, ReleaseNum,
  CAST(floor(date_diff('day', DATE '{FIRST_BILL}', Program_Date) / {MONTH}) AS INT) AS Negative_Duration,
  CAST(floor(date_diff('day', Program_Date, CAST(DATE '{RELEASE_DATE}' - INTERVAL 6 MONTH AS DATE)) / {MONTH}) AS INT) AS Positive_Duration
FROM in_patient
""",
)
fragment(
    "ref_cohort",
    f"""
SELECT l.*, w.Negative_Duration, w.Positive_Duration, d.Duration, CAST(l.Program_Date - d.Duration * INTERVAL 1 MONTH AS DATE) AS Min_Date,
  CAST(l.Program_Date + d.Duration * INTERVAL 1 MONTH AS DATE) AS Max_Date
FROM ref_windows w JOIN ref_labelled l USING (RecipientID, Program_Date, ReleaseNum), (VALUES (6), (12), (18)) AS d(Duration)
WHERE w.ReleaseNum = {RELEASE} AND w.Negative_Duration >= d.Duration AND w.Positive_Duration >= d.Duration
""",
)
fragment(
    "ref_cohort_lines",
    """
SELECT p.RecipientID, p.Duration, p.ReleaseNum, c.ServiceFromDt, c.AdjustedPriceAmt, c.Visit, c.Visit_Inpatient_Days,
  CASE c.Summary_Category WHEN 'INPATIENT' THEN 'Inpatient' WHEN 'OUTPATIENT' THEN 'Outpatient' WHEN 'OTHER' THEN 'Other'
    WHEN 'ED' THEN 'ED' WHEN 'Pharmacy' THEN 'Pharmacy' END AS Category,
  CASE WHEN c.ServiceFromDt < p.Program_Date THEN 'Pre' WHEN c.ServiceFromDt >= p.Program_Date THEN 'Post' END AS Pre_Post
FROM ref_cohort p LEFT JOIN ref_categorized c ON c.RecipientID = p.RecipientID AND c.ServiceFromDt BETWEEN p.Min_Date AND p.Max_Date
""",
)


def _cells(measure: str) -> str:
    cells = []
    for column in prepost.COST_COLUMNS:
        category, side = column.split("_")
        match = "Category IS NOT NULL" if category == "Total" else f"Category = '{category}'"
        cells.append(f"coalesce(sum({measure}) FILTER ({match} AND Pre_Post = '{side}'), 0) AS {column}")
    return ", ".join(cells)


fragment(
    "ref_individual",
    " UNION ALL ".join(
        f"SELECT RecipientID, Duration, ReleaseNum, '{m}' AS Aggregation_Type, {_cells(m)} FROM ref_cohort_lines GROUP BY RecipientID, Duration, ReleaseNum"
        for m in prepost.MEASURES
    ),
)
_COST_OUT = " ".join(f"{c}:m" for c in prepost.COST_COLUMNS)


@register(
    "pt_windows",
    "RecipientID Program_Date:d Negative_Duration:i Positive_Duration:i ReleaseNum:i",
    "SELECT * FROM ref_windows",
)
def _pt_windows(t: Inputs) -> DataFrame:
    return prepost.pt_windows(t.in_patient, as_of(), FIRST)


@register(
    "min_duration_filter",
    "RecipientID Negative_Duration:i Positive_Duration:i",
    f"SELECT * FROM ref_windows WHERE Negative_Duration >= 12 AND Positive_Duration >= 12 AND ReleaseNum = {RELEASE}",
)
def _min_duration(t: Inputs) -> DataFrame:
    return keys.min_duration_filter(prepost.pt_windows(t.in_patient, as_of(), FIRST), 12, RELEASE)


@register(
    "patient_release_inner",
    "RecipientID Program_Date:d ReleaseNum:i Negative_Duration:i Positive_Duration:i Gender Program_Risk",
    "SELECT w.*, l.Gender, l.Program_Risk FROM ref_windows w JOIN ref_labelled l USING (RecipientID, Program_Date, ReleaseNum)",
)
def _patient_release_inner(t: Inputs) -> DataFrame:
    return prepost.patient_release_inner(prepost.pt_windows(t.in_patient, as_of(), FIRST), labelled(t))


@register(
    "pre_post_bounds",
    "RecipientID Program_Date:d Min_Date:d Max_Date:d",
    """
    SELECT RecipientID, Program_Date, CAST(Program_Date - INTERVAL 18 MONTH AS DATE) AS Min_Date,
      CAST(Program_Date + INTERVAL 18 MONTH AS DATE) AS Max_Date FROM in_patient
    """,
)
def _pre_post_bounds(t: Inputs) -> DataFrame:
    return prepost.pre_post_bounds(t.in_patient, F.lit(18))


@register(
    "pre_post_label",
    "Pre_Post Lines:i Patients:i",
    """
    SELECT CASE WHEN p.Program_Date > c.ServiceFromDt THEN 'Pre' ELSE 'Post' END AS Pre_Post, count(*) AS Lines, count(DISTINCT RecipientID) AS Patients
    FROM in_claims c JOIN in_patient p USING (RecipientID) GROUP BY 1
    """,
)
def _pre_post_label(t: Inputs) -> DataFrame:
    joined = t.in_claims.join(t.in_patient.select("RecipientID", "Program_Date"), "RecipientID")
    side = prepost.pre_post_label(F.col("Program_Date"), F.col("ServiceFromDt"))
    # Counted per patient first, so that distinct patients need no second pass over lines.
    per_patient = joined.groupBy(side.alias("Pre_Post"), "RecipientID").agg(F.count(F.lit(1)).alias("n"))
    return per_patient.groupBy("Pre_Post").agg(F.sum("n").alias("Lines"), F.count(F.lit(1)).alias("Patients"))


@register(
    "category_rename",
    "Summary_Category Category Lines:i",
    """
    SELECT Summary_Category, CASE WHEN Summary_Category IN ('ED', 'Pharmacy') THEN Summary_Category
      WHEN Summary_Category IN ('OTHER', 'INPATIENT', 'OUTPATIENT') THEN upper(Summary_Category[1]) || lower(Summary_Category[2:]) END AS Category,
      count(*) AS Lines FROM ref_categorized GROUP BY 1
    """,
)
def _category_rename(t: Inputs) -> DataFrame:
    counted = categorized(t).groupBy("Summary_Category").agg(F.count(F.lit(1)).alias("Lines"))
    return counted.withColumn("Category", prepost.category_rename(F.col("Summary_Category")))


def cohort(t: Inputs) -> DataFrame:
    return prepost.pre_post_cohort(prepost.pt_windows(t.in_patient, as_of(), FIRST), labelled(t), RELEASE)


@register(
    "cohort_left_costs",
    "RecipientID Duration:i Category Pre_Post Days:i AdjustedPriceAmt:m Visit:i",
    """
    SELECT RecipientID, Duration, Category, Pre_Post, count(DISTINCT ServiceFromDt) AS Days, sum(AdjustedPriceAmt) AS AdjustedPriceAmt, sum(Visit) AS Visit
    FROM ref_cohort_lines GROUP BY ALL
    """,
)
def _cohort_left_costs(t: Inputs) -> DataFrame:
    lines = prepost.cohort_left_costs(cohort(t), cost_ops.daily_costs(categorized(t)))
    return lines.groupBy("RecipientID", "Duration", "Category", "Pre_Post").agg(
        F.countDistinct("ServiceFromDt").alias("Days"), F.sum("AdjustedPriceAmt").alias("AdjustedPriceAmt"), F.sum("Visit").alias("Visit")
    )


def pre_post(t: Inputs) -> dict[str, DataFrame]:
    return analysis.pre_post_run(categorized(t), t.in_patient, as_of(), RELEASE, FIRST)


_INDIVIDUAL_OUT = f"RecipientID Duration:i ReleaseNum:i Aggregation_Type {_COST_OUT}"


@register("pre_post_pivot", _INDIVIDUAL_OUT, "SELECT * FROM ref_individual")
def _pre_post_pivot(t: Inputs) -> DataFrame:
    return pre_post(t)["individual"]


@register(
    "cohort_keep_all",
    "Duration:i Aggregation_Type Patients:i Without_Bills:i",
    """
    SELECT Duration, Aggregation_Type, count(*) AS Patients,
      count(*) FILTER (RecipientID NOT IN (SELECT RecipientID FROM ref_cohort_lines x WHERE x.Duration = i.Duration AND x.Category IS NOT NULL)) AS Without_Bills
    FROM ref_individual i GROUP BY ALL
    """,
)
def _cohort_keep_all(t: Inputs) -> DataFrame:
    """Patients kept per duration and measure, and how many of them had no bill at all."""
    bills = prepost.cohort_left_costs(cohort(t), cost_ops.daily_costs(categorized(t)))
    without = bills.groupBy("RecipientID", "Duration").agg(F.count("Category").alias("n"))
    individual = prepost.pre_post_pivot(bills)
    return (
        individual.join(without, ["RecipientID", "Duration"])
        .groupBy("Duration", "Aggregation_Type")
        .agg(F.count(F.lit(1)).alias("Patients"), F.count_if(F.col("n") == 0).alias("Without_Bills"))
    )


_LABEL_SQL = """
SELECT i.*, l.Population_Type, '1' AS Holistic, l.Diagnosis_Category, l.Program_Age_Category AS Age_Cat, l.Program_Risk AS Risk, l.Gender,
  coalesce(CAST(l.Preg_Flag AS VARCHAR), 'nan') AS Pregnancy
FROM ref_individual i JOIN ref_labelled l USING (RecipientID)
"""
fragment("ref_individual_labelled", _LABEL_SQL)


def _half_up(total: str, n: str) -> str:
    """Two-decimal mean of a non-negative decimal sum, in whole numbers."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _grouping(extra: list[str]) -> str:
    columns = ["Population_Type", *extra]
    names = ", ".join(columns)
    subset = " || '::' || ".join(f"g.{c}" for c in columns)
    means = ", ".join(f"coalesce({_half_up(f'm.{c}', 'm.N')}, 0) AS {c}" for c in prepost.COST_COLUMNS)
    sums = ", ".join(f"sum({c}) AS {c}" for c in prepost.COST_COLUMNS)
    cross = " JOIN ".join(
        [f"(SELECT DISTINCT Duration, ReleaseNum, Aggregation_Type, Population_Type FROM ref_individual_labelled WHERE Population_Type IS NOT NULL)"]
        + [f"(SELECT DISTINCT Duration, {c} FROM ref_individual_labelled WHERE {c} IS NOT NULL) USING (Duration)" for c in extra]
    )
    return f"""
    SELECT '{'::'.join(columns)}' AS Group_Type, {subset} AS Group_Subset, 'mean' AS Aggregation_Function, g.Aggregation_Type AS Value,
      coalesce(m.N, 0) AS N, {means}, g.Duration, g.ReleaseNum
    FROM (SELECT * FROM {cross}) g
    LEFT JOIN (SELECT Duration, Aggregation_Type, {names}, count(*) AS N, {sums} FROM ref_individual_labelled GROUP BY Duration, Aggregation_Type, {names}) m
      USING (Duration, Aggregation_Type, {names})
    """


_GROUPINGS_SQL = " UNION ALL ".join(_grouping(g) for g in prepost.GROUPINGS)


@register(
    "pre_post_groupings",
    f"Group_Type Group_Subset Aggregation_Function Value N:i {_COST_OUT} Duration:i ReleaseNum:i",
    _GROUPINGS_SQL,
)
def _pre_post_groupings(t: Inputs) -> DataFrame:
    return pre_post(t)["groupings"]


@register(
    "dense_group_cross",
    "Group_Type Group_Subset",
    """
    SELECT 'Population_Type::Diagnosis_Category' AS Group_Type, p || '::' || d AS Group_Subset
    FROM (SELECT DISTINCT Population_Type AS p FROM ref_labelled WHERE p IS NOT NULL), (SELECT DISTINCT Diagnosis_Category AS d FROM ref_labelled)
    UNION ALL SELECT 'Population_Type::Gender', p || '::' || g
    FROM (SELECT DISTINCT Population_Type AS p FROM ref_labelled WHERE p IS NOT NULL), (SELECT DISTINCT Gender AS g FROM ref_labelled)
    """,
)
def _dense_group_cross(t: Inputs) -> DataFrame:
    return prepost.dense_group_cross(
        labelled(t), [], [["Population_Type", "Diagnosis_Category"], ["Population_Type", "Gender"]]
    )


@register(
    "pre_post_run",
    "Duration:i Patients:i Individual:i Groups:i Total_Pre:m Total_Post:m",
    f"""
    SELECT Duration, (SELECT count(*) FROM ref_cohort c WHERE c.Duration = i.Duration) AS Patients, count(*) AS Individual,
      (SELECT count(*) FROM ({_GROUPINGS_SQL}) g WHERE g.Duration = i.Duration) AS Groups,
      sum(Total_Pre) AS Total_Pre, sum(Total_Post) AS Total_Post
    FROM ref_individual i GROUP BY Duration
    """,
)
def _pre_post_run(t: Inputs) -> DataFrame:
    """Sizes and totals of everything one run publishes."""
    run = pre_post(t)
    cohort_size = run["patients"].groupBy("Duration").agg(F.count(F.lit(1)).alias("Patients"))
    individual = run["individual"].groupBy("Duration").agg(
        F.count(F.lit(1)).alias("Individual"), F.sum("Total_Pre").alias("Total_Pre"), F.sum("Total_Post").alias("Total_Post")
    )
    groups = run["groupings"].groupBy("Duration").agg(F.count(F.lit(1)).alias("Groups"))
    return cohort_size.join(individual, "Duration").join(groups, "Duration")


# Rolling windows.

fragment(
    "ref_costs",
    f"""
SELECT c.*, l.Program_Date, CAST(ceil(date_diff('day', l.Program_Date, c.ServiceFromDt) / {MONTH}) AS INT) AS Window_
FROM ref_categorized c JOIN in_patient l USING (RecipientID)
""",
)
fragment(
    "ref_levels",
    """
SELECT *, 'Summary_Category' AS Category_Type, coalesce(Summary_Category, 'Uncategorized') AS Category FROM ref_costs
UNION ALL SELECT *, 'Category1', coalesce(Category1, 'Uncategorized') FROM ref_costs
UNION ALL SELECT *, 'Category2', coalesce(Category1 || '_' || Category2, 'Uncategorized') FROM ref_costs
UNION ALL SELECT *, 'Category3', coalesce(Category1 || '_' || Category2 || '_' || Category3, 'Uncategorized') FROM ref_costs
""",
)
_SUMS = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in cost_ops.MEASURES)
fragment(
    "ref_monthly",
    f"SELECT RecipientID, Window_, Category_Type, Category, {_SUMS} FROM ref_levels GROUP BY ALL",
)
fragment(
    "ref_active",
    """
SELECT DISTINCT m.RecipientID, w.Window_, f.first
FROM ref_monthly m JOIN (SELECT unnest(range((SELECT min(Window_) FROM ref_monthly), (SELECT max(Window_) + 1 FROM ref_monthly))) AS Window_) w
  ON w.Window_ BETWEEN m.Window_ AND m.Window_ + 11
JOIN (SELECT RecipientID, min(Window_) AS first FROM ref_monthly GROUP BY RecipientID) f ON f.RecipientID = m.RecipientID
""",
)
fragment("ref_categories", "SELECT DISTINCT Category_Type, Category FROM ref_monthly")
fragment(
    "ref_rolling",
    f"""
SELECT * EXCLUDE (first) FROM (
  SELECT a.RecipientID, a.first, k.Category_Type, k.Category, a.Window_, {', '.join(
      f"sum(coalesce(m.{x}, 0)) OVER (PARTITION BY a.RecipientID, k.Category_Type, k.Category ORDER BY a.Window_ RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS {x}"
      for x in cost_ops.MEASURES)}
  FROM ref_active a CROSS JOIN ref_categories k
  LEFT JOIN ref_monthly m ON m.RecipientID = a.RecipientID AND m.Window_ = a.Window_ AND m.Category_Type = k.Category_Type AND m.Category = k.Category)
WHERE Window_ >= first + 11
""",
)
_MEASURE_OUT = "AdjustedPriceAmt:m Encounter:i Service_Count:i Visit_Inpatient_Days:i"


def costs(t: Inputs, buckets: int) -> DataFrame:
    """Costs that lie by patient in so many partitions: days are summed first, so that no patient has many rows to send."""
    daily = cost_ops.daily_category_costs(categorized(t)).repartition(buckets, "RecipientID")
    return cost_ops.cost_window(daily, t.in_patient)


@register(
    "cost_window",
    "DCN ServiceLineNbr RecipientID ServiceFromDt:d Window:i",
    'SELECT *, Window_ AS "Window" FROM ref_costs',
)
def _cost_window(t: Inputs) -> DataFrame:
    return cost_ops.cost_window(categorized(t), t.in_patient)


@register(
    "category_levels",
    "Category_Type Category Lines:i AdjustedPriceAmt:m",
    "SELECT Category_Type, Category, count(*) AS Lines, sum(AdjustedPriceAmt) AS AdjustedPriceAmt FROM ref_levels GROUP BY ALL",
)
def _category_levels(t: Inputs) -> DataFrame:
    # Counted on the narrow category columns before the four levels multiply the rows.
    narrow = categorized(t).groupBy(*cost_ops.CATEGORY_LEVELS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("AdjustedPriceAmt").alias("a")
    )
    return cost_ops.category_levels(narrow).groupBy("Category_Type", "Category").agg(
        F.sum("n").alias("Lines"), F.sum("a").alias("AdjustedPriceAmt")
    )


def _cell(category: Column, measures: Sequence[Column]) -> Column:
    """A category's measures as text, and its amount."""
    text = F.concat_ws("|", category, *[m.cast("decimal(18,2)").cast("string") for m in measures])
    amount = measures[0].cast("decimal(38,2)")
    return F.struct(text.alias("text"), amount.alias("amount"))


def _own_cell() -> Column:
    return _cell(F.col("Category"), [F.col(m) for m in cost_ops.MEASURES])


def _empty_cell(category: Column) -> Column:
    zeros = "|0.00" * len(cost_ops.MEASURES)
    return F.struct(F.concat(category, F.lit(zeros)).alias("text"), F.lit(0).cast("decimal(38,2)").alias("amount"))


def _level(cells: Column) -> dict[str, Column]:
    """All categories of a level in one row: how many, and their values as text in category order."""
    zero = F.lit(0).cast("decimal(38,2)")
    return {
        "Categories": F.size(cells),
        "AdjustedPriceAmt": F.aggregate(cells, zero, lambda a, c: (a + c["amount"]).cast("decimal(38,2)")),
        "Cells": F.array_join(F.sort_array(cells["text"]), ";"),
    }


def _cells_sql(rows: str, keys: str) -> str:
    values = " || '|' || ".join(f"CAST(CAST({m} AS DECIMAL(18,2)) AS VARCHAR)" for m in cost_ops.MEASURES)
    return f"""
    SELECT {keys}, Window_ AS "Window", Category_Type, count(*) AS Categories, sum(AdjustedPriceAmt) AS AdjustedPriceAmt,
      array_to_string(list_sort(list(Category || '|' || {values})), ';') AS Cells
    FROM ({rows}) GROUP BY ALL
    """


_CELLS_OUT = "Category_Type Categories:i AdjustedPriceAmt:m Cells"


@register(
    "window_cost_pivot",
    f"RecipientID Window:i {_CELLS_OUT}",
    _cells_sql(
        f"""
        SELECT p.RecipientID, p.Window_, k.*, {', '.join(f'coalesce(m.{x}, 0) AS {x}' for x in cost_ops.MEASURES)}
        FROM (SELECT DISTINCT RecipientID, Window_ FROM ref_monthly) p CROSS JOIN ref_categories k
        LEFT JOIN ref_monthly m ON m.RecipientID = p.RecipientID AND m.Window_ = p.Window_ AND m.Category_Type = k.Category_Type AND m.Category = k.Category
        """,
        "RecipientID",
    ),
)
def _window_cost_pivot(t: Inputs) -> DataFrame:
    return rolling.window_cost_cells(monthly(t), _own_cell(), _empty_cell, _level)


def monthly(t: Inputs) -> DataFrame:
    """Monthly costs of all four levels, their sums staged by patient: several queries start from them without a shuffle."""
    buckets = t.buckets(categorized(t))
    sums = t.stage_dealt("monthly_sums", ["RecipientID"], lambda: rolling.monthly_sums(costs(t, buckets)), buckets)
    return rolling.monthly_levels(sums)


@register("rolling_12", f"RecipientID Window:i {_CELLS_OUT}", _cells_sql("SELECT * FROM ref_rolling", "RecipientID"))
def _rolling_12(t: Inputs) -> DataFrame:
    return rolling.rolling_cells(monthly(t), _own_cell(), _empty_cell, _level)


_DEMO = """
SELECT RecipientID, Population_Type, Diagnosis_Category, Program_Risk AS Risk, Program_Age_Category AS Age_Category, Gender FROM ref_labelled
"""


@register(
    "demo_inner",
    "Population_Type Gender Risk Window:i Category_Type Category Rows:i AdjustedPriceAmt:m",
    f"""
    SELECT Population_Type, Gender, Risk, Window_ AS "Window", Category_Type, Category, count(*) AS "Rows", sum(AdjustedPriceAmt) AS AdjustedPriceAmt
    FROM ref_rolling JOIN ({_DEMO}) USING (RecipientID) GROUP BY ALL
    """,
)
def _demo_inner(t: Inputs) -> DataFrame:
    """Counted and summed over all rows, zeros too, which the intervals they hold in stand for."""
    months = monthly(t)
    people = rolling.demo_inner(rolling.rolling_12(months, dense=False), labelled(t))
    return rolling.window_sums(people, months, ["Population_Type", "Gender", "Risk"])


def _rounded_mean(units: str, millionths: int = 1_000_000) -> str:
    """Text of the mean with six decimals, half up, in whole numbers."""
    total = f"{millionths} * CAST(sum({units}) AS HUGEINT)"
    mean = f"((2 * {total} + count(*)) // (2 * count(*)))"
    return f"CAST({mean} // 1000000 AS VARCHAR) || '.' || lpad(CAST({mean} % 1000000 AS VARCHAR), 6, '0')"


def _stats(group: list[str]) -> str:
    kind = "::".join(group) or "Holistic"
    subset = " || '::' || ".join(group) if group else "'Holistic'"
    return f"""
    SELECT '{kind}' AS Group_Type, {subset} AS Group_Subset, Category_Type, Category, Window_, count(*) AS N,
      {_rounded_mean('100 * AdjustedPriceAmt', 10000)} AS AdjustedPriceAmt_Mean, sum(AdjustedPriceAmt) AS Amount_, stddev_samp(CAST(AdjustedPriceAmt AS DOUBLE)) AS AdjustedPriceAmt_Std,
      {_rounded_mean('Encounter')} AS Encounter_Mean, {_rounded_mean('Service_Count')} AS Service_Count_Mean,
      {_rounded_mean('Visit_Inpatient_Days')} AS Visit_Inpatient_Days_Mean
    FROM ref_rolling_demo GROUP BY ALL HAVING Group_Subset IS NOT NULL
    """


fragment("ref_rolling_demo", f"SELECT * FROM ref_rolling JOIN ({_DEMO}) USING (RecipientID)")
_ALL_STATS = " UNION ALL ".join(_stats(g) for g in rolling.GROUPINGS)
_MEANS = ["AdjustedPriceAmt_Mean", "Encounter_Mean", "Service_Count_Mean", "Visit_Inpatient_Days_Mean"]


@register(
    "rolling_group_stats",
    "Group_Type Group_Subset Category_Type Window:i N:i Categories:i Cells",
    f"""
    SELECT Group_Type, Group_Subset, Category_Type, Window_ AS "Window", N, count(*) AS Categories,
      array_to_string(list_sort(list(Category || '|' || {" || '|' || ".join(_MEANS)} || '|' ||
        coalesce(CAST(CAST(round(AdjustedPriceAmt_Std * 1000 / pi()) AS BIGINT) AS VARCHAR), ''))), ';') AS Cells
    FROM ({_ALL_STATS}) GROUP BY ALL
    """,
)
def _rolling_group_stats(t: Inputs) -> DataFrame:
    """All four levels; the categories of a group and window in one row, their means and deviation as text."""
    stats = rolling.rolling_group_stats(monthly(t), labelled(t))
    means = [F.round(m, 6).cast("decimal(30,6)").cast("string") for m in _MEANS]
    # In units of pi / 1000, so that no deviation of cents lies half way between two of them.
    deviation = F.coalesce(F.round(F.col("AdjustedPriceAmt_Std") * 1000 / F.pi()).cast("bigint").cast("string"), F.lit(""))
    cell = F.concat_ws("|", "Category", *means, deviation)
    return stats.groupBy("Group_Type", "Group_Subset", "Category_Type", "Window", "N").agg(
        F.count(F.lit(1)).alias("Categories"), F.array_join(F.array_sort(F.collect_list(cell)), ";").alias("Cells")
    )


@register(
    "rolling_patients",
    f"RecipientID Population_Type Diagnosis_Category Risk Age_Category Gender Window:i {_CELLS_OUT}",
    _cells_sql(
        "SELECT * FROM ref_rolling_demo", "RecipientID, Population_Type, Diagnosis_Category, Risk, Age_Category, Gender"
    ),
)
def _rolling_patients(t: Inputs) -> DataFrame:
    """The patient table of a rolling run: all four levels with demographics."""
    lines = categorized(t)
    return analysis.rolling_run(lines, t.in_patient, _own_cell(), _empty_cell, _level, t.buckets(lines))["patients"]


@register(
    "rolling_run",
    "Group_Type Category_Type Window:i Groups:i N:i Amount:f2",
    f"""
    SELECT Group_Type, Category_Type, Window_ AS "Window", count(*) AS Groups, sum(N) AS N, CAST(sum(Amount_) AS DOUBLE) AS Amount
    FROM ({_ALL_STATS}) GROUP BY ALL
    """,
)
def _rolling_run(t: Inputs) -> DataFrame:
    """All four levels and all eleven group lists, summarized per window."""
    lines = categorized(t)
    stats = analysis.rolling_run(lines, t.in_patient, buckets=t.buckets(lines))["groups"]
    return stats.groupBy("Group_Type", "Category_Type", "Window").agg(
        F.count(F.lit(1)).alias("Groups"), F.sum("N").alias("N"), F.sum("AdjustedPriceAmt_Sum").alias("Amount")
    )


@register(
    "months_in_program",
    "RecipientID Months_In_Program:i",
    f"SELECT RecipientID, CAST(trunc(date_diff('day', Program_Date, DATE '{RELEASE_DATE}') / {MONTH}) AS INT) AS Months_In_Program FROM in_patient",
)
def _months_in_program(t: Inputs) -> DataFrame:
    return t.in_patient.withColumn("Months_In_Program", util.months_in_program(as_of(), F.col("Program_Date")))


# Utilization.

AFTER = date(2000, 12, 31)
fragment(
    "ref_window_lines",
    f"SELECT * FROM ref_categorized WHERE ServiceFromDt > DATE '{AFTER}' AND ServiceFromDt <= DATE '{RELEASE_DATE}'",
)
fragment(
    "ref_util_pivot",
    f"""
SELECT RecipientID, {', '.join(f"coalesce(sum(Visit) FILTER (Summary_Category = '{c}'), 0) AS {c}_Visit" for c in util.VISIT_COLUMNS)},
  sum(Visit) AS Release_Visit, count(*) AS Release_Encounters, sum(AdjustedPriceAmt) AS Release_AdjustedPriceAmt
FROM ref_window_lines WHERE Summary_Category IS NOT NULL GROUP BY RecipientID
""",
)
fragment(
    "ref_util_min_max",
    """
SELECT RecipientID, min(ServiceFromDt) AS Min_ServiceFromDt, max(ServiceFromDt) AS Max_ServiceFromDt,
  date_diff('day', min(ServiceFromDt), max(ServiceFromDt)) + 1 AS Total_Duration_Days FROM ref_window_lines GROUP BY RecipientID
""",
)
fragment(
    "ref_util_cumulative",
    f"""
SELECT c.RecipientID, sum(Visit) AS Cumulative_Visit, count(*) AS Cumulative_Encounters, sum(AdjustedPriceAmt) AS Cumulative_AdjustedPriceAmt
FROM ref_categorized c JOIN in_patient p ON p.RecipientID = c.RecipientID AND c.ServiceFromDt >= p.Program_Date
WHERE c.ServiceFromDt <= DATE '{RELEASE_DATE}' AND c.Summary_Category IS NOT NULL GROUP BY c.RecipientID
""",
)


def window_daily(t: Inputs) -> DataFrame:
    return util.in_window(util.util_daily(categorized(t)), F.lit(AFTER), as_of())


_VISIT_OUT = " ".join(f"{c}_Visit:i" for c in util.VISIT_COLUMNS)
_PIVOT_OUT = f"RecipientID {_VISIT_OUT} Release_Visit:i Release_Encounters:i Release_AdjustedPriceAmt:m"
_CUMULATIVE_OUT = "Cumulative_Visit:i Cumulative_Encounters:i Cumulative_AdjustedPriceAmt:m"


@register("util_pivot", _PIVOT_OUT, "SELECT * FROM ref_util_pivot")
def _util_pivot(t: Inputs) -> DataFrame:
    return util.util_pivot(window_daily(t))


@register(
    "util_min_max",
    "RecipientID Min_ServiceFromDt:d Max_ServiceFromDt:d Total_Duration_Days:i",
    "SELECT * FROM ref_util_min_max",
)
def _util_min_max(t: Inputs) -> DataFrame:
    return util.util_min_max(window_daily(t))


@register("util_cumulative", f"RecipientID {_CUMULATIVE_OUT}", "SELECT * FROM ref_util_cumulative")
def _util_cumulative(t: Inputs) -> DataFrame:
    return util.util_cumulative(util.util_daily(categorized(t)), t.in_patient, as_of())


@register(
    "claims_patient_join",
    "RecipientID ServiceFromDt:d Program_Date:d Encounters:i",
    f"""
    SELECT c.RecipientID, c.ServiceFromDt, p.Program_Date, count(*) AS Encounters FROM in_claims c JOIN in_patient p USING (RecipientID)
    WHERE c.ServiceFromDt >= p.Program_Date AND c.ServiceFromDt <= DATE '{RELEASE_DATE}' GROUP BY ALL
    """,
)
def _claims_patient_join(t: Inputs) -> DataFrame:
    days = t.in_claims.groupBy("RecipientID", "ServiceFromDt").agg(F.count(F.lit(1)).alias("Encounters"))
    return util.claims_patient_join(days, t.in_patient, as_of())


@register(
    "rpt_high_utilizers",
    f"{_PIVOT_OUT} Min_ServiceFromDt:d Max_ServiceFromDt:d Total_Duration_Days:i {_CUMULATIVE_OUT} PatientID:i MRN Asthma:i Diabetes:i SCD:i "
    "Prematurity:i Brain_Injury:i Epilepsy:i Program_Date:d Current_Risk HC:i E2:i E4:i HE2:i HE4:i Months_In_Program:i Release_Number:i",
    f"""
    SELECT * EXCLUDE (ReleaseNum), CAST(trunc(date_diff('day', p.Program_Date, DATE '{RELEASE_DATE}') / {MONTH}) AS INT) AS Months_In_Program,
      {RELEASE} AS Release_Number
    FROM ref_util_pivot JOIN ref_util_min_max USING (RecipientID) JOIN ref_util_cumulative USING (RecipientID) LEFT JOIN in_patient p USING (RecipientID)
    """,
)
def _rpt_high_utilizers(t: Inputs) -> DataFrame:
    """The window opens after the last service date of the release before, read from the raw claims.

    The three values are worked out once and stand in the plan as literals.
    """
    newest = keys.of_latest_release(t.in_release).select("ReleaseNum", F.col("HFS_Release_Date").alias("until")).first()
    number, until = (newest.ReleaseNum, newest.until) if newest else (None, None)
    previous = t.in_raw_claims.where(F.col("ReleaseNum") == (F.lit(number) - 1))
    after = previous.agg(F.max("ServiceFromDt").alias("d")).first().d
    day = lambda d: F.lit(d).cast("date")
    return reports.rpt_high_utilizers(categorized(t), t.in_patient, day(after), day(until), F.lit(number).cast("int"))


# Follow-up after discharge.

_STAY = """
SELECT m.RecipientID, i.DischargeDt, i.AdmissionDt, m.DCN, m.ServiceLineNbr, m.RejectionStatusCd, m.AdjudicatedDt, m.ProviderNPI, m.CatgofServiceCd,
  m.AdjustedPriceAmt, i.AdmissionDiagCd, i.ICDVersion, '{report}' AS Report
FROM ref_categorized m JOIN in_institutional i USING (DCN, ServiceLineNbr, RejectionStatusCd, RecipientID, AdjudicatedDt)
WHERE i.PatientStatusCd = '01' AND m.RejectionStatusCd = 'N' AND i.DischargeDt IS NOT NULL AND m.RecordIDCd = 'I' AND m.Category1 = 'INPATIENT'
  AND m.Category3 IN ({categories})
"""
fragment(
    "ref_stays",
    _STAY.format(report="IP", categories="'INPATIENT_IP', 'EMERGENCY_IP'")
    + " UNION ALL "
    + _STAY.format(report="EDIP", categories="'EMERGENCY_IP'")
    + """
UNION ALL SELECT RecipientID, ServiceThruDt, ServiceFromDt, DCN, ServiceLineNbr, RejectionStatusCd, AdjudicatedDt, ProviderNPI, CatgofServiceCd,
  AdjustedPriceAmt, NULL, NULL, 'EDOP' FROM ref_categorized
WHERE RejectionStatusCd = 'N' AND RecordIDCd = 'O' AND Category1 = 'OUTPATIENT' AND Category3 = 'EMERGENCY_OP'
""",
)
_EVENTS = ", ".join(f"'{c}'" for c in followup.OUTPATIENT_EVENTS)
fragment(
    "ref_followup",
    f"""
SELECT * EXCLUDE (rn), date_diff('day', DischargeDt, EarliestServiceFromDt) AS DaysDiff,
  CASE WHEN Engagement_Date > DischargeDt THEN 'PreEngagement' WHEN Engagement_Date < DischargeDt THEN 'PostEngagement' END AS EngagementStatus
FROM (
  SELECT s.*, p.* EXCLUDE (RecipientID), e.ServiceFromDt AS EarliestServiceFromDt, e.Category3 AS OPCategory, e.ProviderNPI AS OPProviderNPI,
    e.CatgofServiceCd AS OPCatgofServiceCd, e.AdjustedPriceAmt AS OPAdjustedPriceAmt,
    row_number() OVER (PARTITION BY s.Report, s.RecipientID ORDER BY e.ServiceFromDt, s.DischargeDt, s.AdmissionDt, s.DCN, s.ServiceLineNbr, s.RejectionStatusCd,
      s.AdjudicatedDt, e.Category3, e.ProviderNPI, e.CatgofServiceCd, e.AdjustedPriceAmt) AS rn
  FROM ref_stays s JOIN in_patient p ON p.RecipientID = s.RecipientID AND p.Engagement_Date IS NOT NULL
  JOIN ref_categorized e ON e.RecipientID = s.RecipientID AND e.ServiceFromDt > s.DischargeDt AND e.Category3 IN ({_EVENTS}))
WHERE rn = 1
""",
)
_STAY_OUT = "DCN ServiceLineNbr AdmissionDt:d DischargeDt:d ProviderNPI CatgofServiceCd AdjustedPriceAmt:m AdmissionDiagCd ICDVersion"


@register("admission_join", f"Report RecipientID {_STAY_OUT}", "SELECT * FROM ref_stays WHERE Report <> 'EDOP'")
def _admission_join(t: Inputs) -> DataFrame:
    return followup.admission_join(categorized(t), t.in_institutional)


@register(
    "first_event_after",
    "RecipientID DischargeDt:d EarliestServiceFromDt:d",
    f"""
    SELECT s.RecipientID, s.d AS DischargeDt, min(e.ServiceFromDt) AS EarliestServiceFromDt
    FROM (SELECT RecipientID, min(DischargeDt) AS d FROM in_institutional GROUP BY RecipientID) s
    JOIN ref_categorized e ON e.RecipientID = s.RecipientID AND e.ServiceFromDt > s.d AND e.Category3 IN ({_EVENTS}) GROUP BY ALL
    """,
)
def _first_event_after(t: Inputs) -> DataFrame:
    stays = t.in_institutional.groupBy("RecipientID").agg(F.min("DischargeDt").alias("DischargeDt"))
    return followup.first_event_after(stays, followup.outpatient_events(categorized(t)))


@register(
    "first_followup",
    f"Report RecipientID MRN Engagement_Date:d {_STAY_OUT} EarliestServiceFromDt:d OPCategory OPProviderNPI OPCatgofServiceCd OPAdjustedPriceAmt:m "
    "EngagementStatus DaysDiff:i",
    "SELECT * FROM ref_followup",
)
def _first_followup(t: Inputs) -> DataFrame:
    return followup.first_followup(categorized(t), t.in_institutional, t.in_patient)


@register(
    "rpt_followup",
    "Category EngagementStatus RecipientID MRN PatientID:i Engagement_Date:d AdmissionDt:d DischargeDt:d ProviderNPI CodeDescription AdjustedPriceAmt:m "
    "AdmissionDiagCd ICDVersion OPCategory OPProviderNPI OPCodeDescription OPAdjustedPriceAmt:m EarliestServiceFromDt:d DaysDiff:i Asthma:i Diabetes:i "
    "SCD:i Prematurity:i Epilepsy:i Brain_Injury:i Release_Number:i",
    f"""
    SELECT f.* EXCLUDE (Report), f.Report AS Category, a.CodeDescription, b.CodeDescription AS OPCodeDescription, {RELEASE} AS Release_Number
    FROM ref_followup f JOIN in_code_descriptions a ON a.DomainName = 'CatgofServiceCd' AND a.CodeValue = f.CatgofServiceCd
    JOIN in_code_descriptions b ON b.DomainName = 'CatgofServiceCd' AND b.CodeValue = f.OPCatgofServiceCd
    """,
)
def _rpt_followup(t: Inputs) -> DataFrame:
    return reports.rpt_followup(categorized(t), t.in_institutional, t.in_patient, t.in_code_descriptions, RELEASE)
