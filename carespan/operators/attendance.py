"""School attendance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.lookups import first_match

# First and last day of each school quarter.
QUARTERS = [
    ("2014-09-02", "2014-11-06", "Q1"),
    ("2014-11-07", "2015-01-29", "Q2"),
    ("2015-01-30", "2015-04-02", "Q3"),
    ("2015-04-03", "2015-06-16", "Q4"),
    ("2015-09-06", "2015-11-12", "Q1"),
    ("2015-11-13", "2016-02-04", "Q2"),
    ("2016-02-05", "2016-04-07", "Q3"),
    ("2016-04-08", "2016-06-21", "Q4"),
    ("2016-08-28", "2016-11-03", "Q1"),
    ("2016-11-04", "2017-02-02", "Q2"),
    ("2017-02-03", "2017-04-06", "Q3"),
    ("2017-04-07", "2017-06-20", "Q4"),
    ("2017-08-27", "2017-11-02", "Q1"),
    ("2017-11-03", "2018-02-01", "Q2"),
    ("2018-02-02", "2018-04-12", "Q3"),
    ("2018-04-13", "2018-06-18", "Q4"),
]
GRADES = ["PE", "PK", "K", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12"]
NOT_A_GRADE = ["20", "--"]
CHRONIC_BELOW = 0.9


def valid_grade(attendance: DataFrame) -> DataFrame:
    grade = F.col("Student_Annual_Grade_Code")
    return attendance.where(grade.isNotNull() & ~grade.isin(NOT_A_GRADE))


def attendance_calc(attendance: DataFrame) -> DataFrame:
    """Days, share present and chronic absence; no days give an unknown share that is not chronic."""
    days = F.col("Present") + F.col("Absent")
    return attendance.withColumns({"Day_Count": days, "Att_Percent": F.try_divide(F.col("Present"), days)}).withColumn(
        "Chronic_Absent", F.coalesce(F.col("Att_Percent") < CHRONIC_BELOW, F.lit(False))
    )


def school_quarter(day: Column) -> Column:
    """Quarter whose inclusive range holds the day, NULL outside all of them."""
    return first_match(
        [
            (day.between(F.lit(date.fromisoformat(first)), F.lit(date.fromisoformat(last))), name)
            for first, last, name in QUARTERS
        ]
    )


def grade_group(grade: Column) -> Column:
    return (
        F.when(grade.isin("PK", "PE"), "<K")
        .when(grade.isin("K", "1", "2", "3", "4", "5"), "K-5")
        .when(grade.isin("6", "7", "8"), "6-8")
        .when(grade.isin("9", "10", "11", "12"), "9-12")
        .otherwise(grade)
    )


def grade_order(grade: Column) -> Column:
    return first_match([(grade == g, i) for i, g in enumerate(GRADES)])


def attendance_report(attendance: DataFrame) -> DataFrame:
    """Valid grades with quarter, grade group and a sortable grade; other grade texts become NULL."""
    grade = F.col("Student_Annual_Grade_Code")
    return valid_grade(attendance).withColumns(
        {
            "Date": F.to_date("Date"),
            "Quarter": school_quarter(F.to_date("Date")),
            "Student_Grade_Category": grade_group(grade),
            "Grade_Order": grade_order(grade),
            "Student_Annual_Grade_Code": F.when(grade.isin(GRADES), grade),
        }
    )
