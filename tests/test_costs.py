"""Hand-worked pre/post, rolling, utilization and follow-up results, with brute-force checks."""

import math
import random
import statistics
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carespan.operators import followup, prepost, rolling, utilization as util

MEASURES = "AdjustedPriceAmt decimal(18,2), Encounter int, Service_Count long, Visit_Inpatient_Days int"
MONTHLY = f"RecipientID string, Window int, Summary_Category string, Category1 string, Category2 string, Category3 string, {MEASURES}"


def monthly(spark, rows):
    """rows: (patient, window, summary category, amount)"""
    full = [(p, w, c, "OUTPATIENT", "X", "Y", Decimal(a), 1, 2, 0) for p, w, c, a in rows]
    return rolling.monthly_costs(spark.createDataFrame(full, MONTHLY), ["Summary_Category"])


def brute_rolling(rows):
    spent, patients, categories = defaultdict(Decimal), defaultdict(set), set()
    for p, w, c, a in rows:
        patients[p].add(w)
        spent[p, c or "Uncategorized", w] += Decimal(a)
        categories.add(c or "Uncategorized")
    last = max(w for _, w, _, _ in rows)
    return {
        (p, c, w): sum((spent[p, c, v] for v in range(w - 11, w + 1)), Decimal(0))
        for p, windows in patients.items()
        for w in range(min(windows) + 11, last + 1)
        if any(v in windows for v in range(w - 11, w + 1))
        for c in categories
    }


def random_costs(seed):
    pick = random.Random(seed)
    rows = []
    for p in range(25):
        for _ in range(pick.randint(1, 25)):
            rows.append((f"p{p}", pick.randint(-20, 40), pick.choice(["ED", "OTHER", "INPATIENT", None]), pick.randint(1, 9999) / 100))
    return [(p, w, c, f"{a:.2f}") for p, w, c, a in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_equals_direct_sums(spark, seed):
    rows = random_costs(seed)
    out = {(r.RecipientID, r.Category, r.Window): r.AdjustedPriceAmt for r in rolling.rolling_12(monthly(spark, rows)).collect()}
    assert out == brute_rolling(rows)


def test_categories_add_up_at_every_level(spark):
    rows = [(p, w, c, "OUTPATIENT", d, "Y", Decimal(a), 1, 2, 0) for k, (p, w, c, a) in enumerate(random_costs(7)) for d in [None if k % 5 == 0 else "X"]]
    totals = defaultdict(Decimal)
    for r in rolling.rolling_12(rolling.monthly_costs(spark.createDataFrame(rows, MONTHLY))).collect():
        totals[r.RecipientID, r.Window, r.Category_Type] += r.AdjustedPriceAmt
    assert {k[2] for k in totals} == {"Summary_Category", "Category1", "Category2", "Category3"}
    for (p, w, _), amount in totals.items():
        assert amount == sum((r[6] for r in rows if r[0] == p and w - 11 <= r[1] <= w), Decimal(0))


def test_spread_of_large_nearly_equal_amounts(spark):
    costs = spark.range(20_000).selectExpr("cast(id as string) RecipientID", "0 Window", "'ED' Summary_Category", "'A' Category1", "'B' Category2", "'C' Category3",
        "cast(90000000.00 + 0.01 * (id % 2) as decimal(18,2)) AdjustedPriceAmt", "1 Encounter", "1L Service_Count", "0 Visit_Inpatient_Days")
    people = costs.selectExpr("RecipientID", "'Engaged' Population_Type", "'Asthma' Diagnosis_Category", "'Low' Program_Risk", "'0-1' Program_Age_Category", "if(cast(RecipientID as int) % 3 = 0, 'Male', 'Female') Gender")
    later = costs.selectExpr("RecipientID", "11 Window", "'ED' Summary_Category", "'A' Category1", "'B' Category2", "'C' Category3", "cast(0 as decimal(18,2)) AdjustedPriceAmt", "0 Encounter", "0L Service_Count", "0 Visit_Inpatient_Days")
    stats = rolling.rolling_group_stats(rolling.monthly_costs(costs.unionByName(later), ["Summary_Category"]), people)
    row = stats.where("Group_Type = 'Holistic' AND Window = 11").first()
    assert row.N == 20_000 and row.AdjustedPriceAmt_Std == pytest.approx(0.005 * math.sqrt(20_000 / 19_999), rel=1e-6)


def test_rolling_does_not_depend_on_batches(spark):
    rows = random_costs(3)
    # The last window and the categories are global, so both halves get one patient that has them all.
    anchor = [("anchor", 40, c, "1.00") for c in ("ED", "OTHER", "INPATIENT")]
    whole = rolling.rolling_12(monthly(spark, rows + anchor))
    halves = [[r for r in rows if (int(r[0][1:]) % 2 == h)] + anchor for h in (0, 1)]
    parts = rolling.rolling_12(monthly(spark, halves[0])).union(rolling.rolling_12(monthly(spark, halves[1]))).distinct()
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_group_stats_equal_statistics_over_dense_rows(spark):
    rows = random_costs(4)
    people = [(f"p{i}", "Engaged" if i % 2 else "Enrolled", "Asthma" if i % 3 else None, "Low", "0-1", "Male") for i in range(25)]
    patients = spark.createDataFrame(people, "RecipientID string, Population_Type string, Diagnosis_Category string, Program_Risk string, Program_Age_Category string, Gender string")
    dense = brute_rolling(rows)
    out = {(r.Group_Type, r.Group_Subset, r.Category, r.Window): r for r in rolling.rolling_group_stats(monthly(spark, rows), patients).collect()}
    for kind, label in (("Holistic", lambda p: "Holistic"), ("Population_Type::Gender", lambda p: p[1] + "::Male"), ("Diagnosis_Category", lambda p: p[2])):
        values = defaultdict(list)
        for (p, c, w), amount in dense.items():
            name = label(people[int(p[1:])])
            if name:
                values[kind, name, c, w].append(float(amount))
        assert values and set(values) == {k for k in out if k[0] == kind}
        for k, v in values.items():
            assert out[k].N == len(v)
            assert float(out[k].AdjustedPriceAmt_Mean) == pytest.approx(statistics.fmean(v))
            expected = statistics.stdev(v) if len(v) > 1 else None
            assert out[k].AdjustedPriceAmt_Std == (pytest.approx(expected, abs=1e-6) if expected is not None else None)


def test_rolling_rows_cross_the_network_only_before_they_are_dense(spark):
    plan = rolling.rolling_12(monthly(spark, random_costs(5)))._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Subquery") if "Subquery" in plan else None]
    dense_side = top[: top.index("Generate")]  # steps after the last explode, up to the result
    assert "Exchange" not in dense_side


def test_rows_for_each_window_are_neither_sorted_nor_grouped(spark):
    cells = rolling.rolling_cells(monthly(spark, random_costs(5)), rolling.measure_cell(), rolling.zero_cell)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("Generate")]  # steps after the windows were told apart
    assert "Aggregate" not in after and "Sort" not in after


def test_demographics_come_to_dense_rows_without_moving_them(spark):
    people = [(f"p{i}", "Engaged", "Asthma", "Low", "0-1", "Male") for i in range(25)]
    patients = spark.createDataFrame(people, "RecipientID string, Population_Type string, Diagnosis_Category string, Program_Risk string, Program_Age_Category string, Gender string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many patients
    try:
        rows = rolling.rolling_12(monthly(spark, random_costs(5)))
        joined = rolling.demo_inner(rows, patients)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        dense = plan[: plan.index("Generate")]
        assert "Exchange" not in dense and "Sort" not in dense
        assert joined.count() == rows.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_rolling_run_starts_from_written_sums(spark):
    from carespan.plans import analysis
    from carespan.queries.claims import categorized
    from carespan.queries.registry import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    for frame in analysis.rolling_run(categorized(t), t.in_patient).values():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "monthly_sums-" in plan and "categorized-" not in plan


def test_windows_use_average_months(spark):
    patients = spark.createDataFrame([("a", date(2014, 10, 31), 1), ("b", date(2016, 4, 30), 1)], "RecipientID string, Program_Date date, ReleaseNum int")
    out = {r.RecipientID: (r.Negative_Duration, r.Positive_Duration) for r in prepost.pt_windows(patients, F.lit(date(2016, 8, 31))).collect()}
    # Six calendar months before 2016-08-31 is 2016-02-29.
    assert out == {"a": (6, 15), "b": (23, -3)}


def pre_post_inputs(spark):
    columns = "RecipientID string, Program_Date date, ReleaseNum int, Population_Type string, Diagnosis_Category string, Program_Age_Category string, Program_Risk string, Gender string, Preg_Flag int"
    entry = date(2015, 6, 30)
    patients = spark.createDataFrame(
        [("a", entry, 1, "Engaged", "Asthma", "0-1", "Low", "Female", None), ("b", entry, 1, "Enrolled", "SCD", "2-5", "High", "Male", 0),
         ("c", entry, 2, "Engaged", "SCD", "2-5", "High", "Male", 0)], columns)
    windows = spark.createDataFrame([("a", entry, 12, 13, 1), ("b", entry, 6, 40, 1), ("c", entry, 40, 40, 2)],
                                    "RecipientID string, Program_Date date, Negative_Duration int, Positive_Duration int, ReleaseNum int")
    costs = spark.createDataFrame(
        [("a", date(2014, 12, 30), "ED", Decimal("1.00"), 1, 0),  # exactly six months before (clamped)
         ("a", date(2014, 12, 29), "ED", Decimal("2.00"), 1, 0),  # only in twelve months
         ("a", entry, "INPATIENT", Decimal("4.00"), 1, 3),  # entry day counts as Post
         ("a", date(2015, 12, 30), "Pharmacy", Decimal("8.00"), 0, 0),
         ("a", date(2015, 12, 31), "OTHER", Decimal("16.00"), 0, 0),
         ("a", date(2015, 7, 1), None, Decimal("32.00"), 1, 0)],  # no category: in no sum
        "RecipientID string, ServiceFromDt date, Summary_Category string, AdjustedPriceAmt decimal(18,2), Visit int, Visit_Inpatient_Days int")
    return patients, windows, costs


def test_pre_post(spark):
    patients, windows, costs = pre_post_inputs(spark)
    cohort = prepost.pre_post_cohort(windows, patients, 1)
    assert {(r.RecipientID, r.Duration) for r in cohort.collect()} == {("a", 6), ("a", 12), ("b", 6)}
    individual = prepost.pre_post_pivot(prepost.cohort_left_costs(cohort, costs))
    out = {(r.RecipientID, r.Duration, r.Aggregation_Type): r for r in individual.collect()}
    six, twelve = out["a", 6, "AdjustedPriceAmt"], out["a", 12, "AdjustedPriceAmt"]
    assert (six.ED_Pre, six.Inpatient_Post, six.Pharmacy_Post, six.Other_Post) == (1, 4, 8, 0)
    assert (twelve.ED_Pre, twelve.Other_Post, twelve.Total_Pre, twelve.Total_Post) == (3, 16, 3, 28)
    assert out["a", 6, "Visit_Inpatient_Days"].Inpatient_Post == 3
    assert set(list(out["b", 6, "Visit"])[4:]) == {0}  # no bills at all: kept with zeros
    for r in out.values():
        for side in ("Pre", "Post"):
            assert r[f"Total_{side}"] == sum(r[f"{c}_{side}"] for c in ("Inpatient", "Outpatient", "ED", "Other", "Pharmacy"))


def test_groupings_are_dense_and_sum_to_the_cohort(spark):
    patients, windows, costs = pre_post_inputs(spark)
    individual = prepost.pre_post_pivot(prepost.cohort_left_costs(prepost.pre_post_cohort(windows, patients, 1), costs))
    out = {(r.Duration, r.Value, r.Group_Type, r.Group_Subset): r for r in prepost.pre_post_groupings(individual, patients.where("ReleaseNum = 1")).collect()}
    six = {k[3]: r.N for k, r in out.items() if k[:3] == (6, "Visit", "Population_Type::Gender::Pregnancy")}
    assert six == {f"{p}::{g}::{x}": 0 for p in ("Engaged", "Enrolled") for g in ("Female", "Male") for x in ("nan", "0")} | {
        "Engaged::Female::nan": 1, "Enrolled::Male::0": 1}
    assert out[6, "AdjustedPriceAmt", "Population_Type::Holistic", "Engaged::1"].Pharmacy_Post == 8
    for kind in {k[2] for k in out}:
        assert sum(r.N for k, r in out.items() if k[:3] == (6, "AdjustedPriceAmt", kind)) == 2


def test_utilization(spark):
    lines = [("a", date(2016, 1, 1), "ED", 1, "10.00"), ("a", date(2016, 1, 1), "ED", 0, "5.00"), ("a", date(2016, 1, 9), "Pharmacy", 2, "1.00"),
             ("a", date(2016, 1, 20), None, 4, "7.00"), ("a", date(2015, 1, 1), "OTHER", 8, "3.00")]
    claims = spark.createDataFrame([(p, d, c, v, Decimal(m)) for p, d, c, v, m in lines], "RecipientID string, ServiceFromDt date, Summary_Category string, Visit int, AdjustedPriceAmt decimal(18,2)")
    daily = util.util_daily(claims)
    window = util.in_window(daily, F.lit(date(2015, 12, 31)), F.lit(date(2016, 1, 20)))
    row = util.util_pivot(window).first()
    assert (row.ED_Visit, row.INPATIENT_Visit, row.Release_Visit, row.Release_Encounters, row.Release_AdjustedPriceAmt) == (1, 0, 3, 3, Decimal("16.00"))
    span = util.util_min_max(window).first()
    assert (span.Min_ServiceFromDt, span.Max_ServiceFromDt, span.Total_Duration_Days) == (date(2016, 1, 1), date(2016, 1, 20), 20)
    patients = spark.createDataFrame([("a", date(2016, 1, 1))], "RecipientID string, Program_Date date")
    total = util.util_cumulative(daily, patients, F.lit(date(2016, 1, 20))).first()
    assert (total.Cumulative_Visit, total.Cumulative_Encounters) == (3, 3)


def test_followup_is_the_earliest_event_after_any_discharge(spark):
    pick, start = random.Random(7), date(2016, 1, 1)
    stays = [(f"p{pick.randint(0, 30)}", start + timedelta(days=pick.randint(0, 60))) for _ in range(120)]
    events = [(f"p{pick.randint(0, 30)}", start + timedelta(days=pick.randint(0, 70))) for _ in range(150)]
    expected = {}
    for p, discharged in stays:
        for q, seen in events:
            if p == q and seen > discharged:
                expected[p] = min(expected.get(p, seen), seen)
    first = spark.createDataFrame(stays, "RecipientID string, DischargeDt date").groupBy("RecipientID").agg(F.min("DischargeDt").alias("DischargeDt"))
    columns = "RecipientID string, ServiceFromDt date, Category3 string, ProviderNPI string, CatgofServiceCd string, AdjustedPriceAmt decimal(18,2), DCN string, ServiceLineNbr string, RejectionStatusCd string, AdjudicatedDt date"
    rows = [(p, d, "OFFICE_VISIT", "n", "1", None, str(i), "1", "N", d) for i, (p, d) in enumerate(events)]
    found = followup.first_event_after(first, followup.outpatient_events(spark.createDataFrame(rows, columns)))
    assert {r.RecipientID: r.EarliestServiceFromDt for r in found.collect()} == expected


def test_sums_by_window_come_from_intervals_as_from_dense_rows(spark):
    months = monthly(spark, random_costs(5))
    people = [(f"p{i}", "Engaged" if i % 2 else None, "Low" if i % 3 else "High", "Male") for i in range(25)] + [("p1", "Enrolled", "Low", "Male")]
    patients = spark.createDataFrame(people, "RecipientID string, Population_Type string, Program_Risk string, Gender string")
    patients = patients.withColumns({"Diagnosis_Category": F.lit("x"), "Program_Age_Category": F.lit("0-1")})
    by = ["Population_Type", "Gender", "Risk"]
    keys = [*by, "Category_Type", "Category", "Window"]
    dense = rolling.demo_inner(rolling.rolling_12(months), patients).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Rows"), F.sum("AdjustedPriceAmt").cast("decimal(38,2)").alias("AdjustedPriceAmt")
    )
    found = rolling.window_sums(rolling.demo_inner(rolling.rolling_12(months, dense=False), patients), months, by)
    found = found.select(*dense.columns)
    assert dense.count() > 100 and found.count() == dense.count()
    assert found.exceptAll(dense).count() == 0


def test_a_row_of_cells_is_made_before_its_windows_are_told_apart(spark):
    def row(cells):
        return {"text": F.array_join(cells["Category"], ";")}

    made = rolling.rolling_cells(monthly(spark, random_costs(5)), rolling.measure_cell(), rolling.zero_cell, row)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sequence(start") < plan.index("array_join(")
    whole = rolling.rolling_cells(monthly(spark, random_costs(5)), rolling.measure_cell(), rolling.zero_cell)
    whole = whole.select("RecipientID", "Window", "Category_Type", F.array_join(F.col("cells.Category"), ";").alias("text"))
    assert made.count() > 100 and made.exceptAll(whole).count() == 0 and whole.exceptAll(made).count() == 0


def test_monthly_costs_lie_by_patient(spark):
    from carespan.queries import costs
    from carespan.queries.registry import Inputs

    plan = costs.monthly(Inputs(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "monthly_sums" in plan and "Exchange" not in plan
