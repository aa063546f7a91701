"""Questionnaires, contacts, attendance, text cleaners and presentation tables."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from carespan.functions import text
from carespan.functions.dates import add_calendar_months, avg_months_between, slash_date, whole_years_between
from carespan.functions.instruments import QUESTIONS, T_SCORES
from carespan.operators import assessments as asm
from carespan.operators import attendance as att
from carespan.operators import contacts as con
from carespan.operators import registry as reg
from carespan.operators import tabulate
from carespan.operators.tabulate import crosstab_report, describe_report, exact_quantiles, paired_stats, two_sided_p


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


RAW = "PatientID long, AssessmentName string, QuestionText string, CTS timestamp, ResponseDate timestamp, MedicaidID string, StartDate date, EndDate timestamp, StatusCode string, QuestionID int, YesNo int, Range int, Text string, CUserID string"


def raw(day, answered, rng, note=None, yes=None, question="q"):
    return (1, "A", question, datetime(2016, 1, day), datetime(2016, 1, answered), None, date(2016, 1, day), None, "New", 1, yes, rng, note, " U ")


def test_latest_response_skips_nulls_column_by_column(spark):
    rows = [raw(1, 9, 1, "old"), raw(5, 6, 2), raw(5, 7, None, "new"), raw(5, 5, 4, "first")]
    row = asm.latest_response(spark.createDataFrame(rows, RAW)).first()
    assert (row.Range, row.Text, row.StartDate) == (2, "new", date(2016, 1, 5))


OPENED = "PatientID long, MedicaidID string, AssessmentName string, StartDate date, EndDate timestamp, StatusCode string, CTS timestamp, QuestionID int, QuestionText string"
ANSWERED = "MedRecPatientID long, QuestionID int, ResponseDate timestamp, YesNo int, Range int, Text string, CUserID string"


def test_yes_no_overrides_range_and_spells_answers(spark):
    answers = spark.createDataFrame([("q", 3, "Often")], "QuestionText string, IntegerValue int, Response string")
    opened = spark.createDataFrame([(1, None, "A", date(2016, 1, 1), datetime(2016, 1, 9), "New", datetime(2016, 1, 1), k, q) for k, q in ((1, "q"), (2, "r"))], OPENED)
    given = spark.createDataFrame([(1, 1, datetime(2016, 1, 2), None, 3, None, " U "), (1, 2, datetime(2016, 1, 2), 0, 3, None, " U ")], ANSWERED)
    out = {r.QuestionText: r for r in asm.assessment_responses(opened, given, answers).collect()}
    assert (out["q"].Range, out["q"].Response, out["q"].CUserID) == (3, "Often", "u")
    assert (out["r"].Range, out["r"].Response) == (0, "No")


def test_newest_responses_equal_those_of_all_pairs(spark):
    pick = random.Random(11)
    day = lambda: datetime(2016, 1, 1) + timedelta(days=pick.randrange(40))
    maybe = lambda v: None if pick.random() < 0.4 else v
    opened, given = [], []
    for p in range(12):
        for _ in range(25):
            start = day()
            opened.append((p, maybe(str(p)), pick.choice("AB"), maybe(start.date()), maybe(start + timedelta(days=pick.randrange(15))), "New", maybe(start), pick.randrange(3), f"q{pick.randrange(2)}"))
        given += [(p, pick.randrange(3), maybe(day()), maybe(pick.randrange(2)), maybe(pick.randrange(5)), maybe(pick.choice("xyz")), maybe("u")) for _ in range(60)]
    # One patient with thousands of overlapping assessments and responses.
    opened += [(99, None, "A", date(2016, 1, 1), datetime(2016, 3, 1), "New", datetime(2016, 1, 1) + timedelta(seconds=k % 7), 1, "q1") for k in range(2000)]
    given += [(99, 1, datetime(2016, 2, 1) + timedelta(seconds=k % 50), None, k % 9, None, "u") for k in range(2000)]
    o, r = spark.createDataFrame(opened, OPENED), spark.createDataFrame(given, ANSWERED)
    pairs = asm.latest_response(asm.assessment_join(o, r))
    ours = asm.newest_responses(o, r).select(*pairs.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, pairs.collect())) and pairs.count() > 40


def answers(spark, patient_scores):
    """(patient, assessment, instrument, scale, answers) to latest responses"""
    rows = []
    for patient, name, instrument, scale, given in patient_scores:
        for question, score in zip(QUESTIONS[instrument][scale], given):
            rows.append((patient, name, question, score, date(2016, 1, 1), "u"))
    return spark.createDataFrame(rows, "PatientID long, AssessmentName string, QuestionText string, Range int, StartDate date, CUserID string")


PROMIS = "Tier 2 PROMIS Tool"


def test_promis_is_strict_and_needs_every_scale(spark):
    full = [(1, PROMIS + " ", "PROMIS", s, [1, 1, 1, 1]) for s in T_SCORES]
    partial = [(2, PROMIS, "PROMIS", s, [5, 5, 5, None if s == "Social" else 5]) for s in T_SCORES]
    missing = [(3, PROMIS, "PROMIS", s, [1, 1, 1, 1]) for s in T_SCORES if s != "Social"]
    out = {r.PatientID: r for r in asm.score_promis(answers(spark, full + partial + missing)).collect()}
    assert set(out) == {1, 2}
    assert (out[1].Anxiety_Score, out[1].Anxiety_T_Score, out[1].Social_T_Score) == (4, 40.3, 27.5)
    assert (out[2].Anxiety_T_Score, out[2].Social_Score, out[2].Social_T_Score) == (81.6, None, None)


def test_psc_flags(spark):
    name = "Tier 2 Pediatric Symptom Checklist (PSC-17) Caregiver"
    rows = [(1, name, "PSC", "Attention Problems", [2, 2, 2, 1, 0]), (1, name, "PSC", "Internalizing Problems", [1, 1, 1, 1, None]),
            (1, name, "PSC", "Externalizing Problems", [1, 1, 1, 1, 0, 0, 0]), (2, name, "PSC", "Attention Problems", [2, 2, 2, 2, 2])]
    (row,) = asm.score_psc(answers(spark, rows)).collect()
    assert (row.Total_Score, row.Attention_At_Risk, row.Internalizing_At_Risk, row.Externalizing_At_Risk, row.Total_At_Risk) == (15, True, False, False, True)


@pytest.mark.parametrize("total, result", [(4, "No Signs of Depression"), (5, "Mild Depression"), (27, "Severe Depression"), (28, None)])
def test_phq_bands(spark, total, result):
    assert value(spark, asm.band(F.lit(total), asm.PHQ_BANDS)) == result


def test_totals(spark):
    rows = [(1, PROMIS, "CHAOS", "Total", [0] * 6), (2, PROMIS, "CHAOS", "Total", [1, 0, 0, 0, 0, 0]), (2, "Tier 3 PHQ9 Adult or Caregiver - 6 Month", "PHQ9", "Total", [3] * 9)]
    scored = asm.auto_score(answers(spark, rows))
    assert {(r.PatientID, r.Instrument, r.Sequence, r.Score) for r in scored.collect()} == {(2, "CHAOS", "baseline", 1.0), (2, "PHQ9", "6mo", 27.0)}
    (wide,) = asm.score_totals_pivot(scored).collect()
    assert (wide.CHAOS_Total_Score_Baseline_Score, wide.PHQ9_Total_Score_6mo_Score, wide.PSC_Total_Score_6mo_Score) == (1.0, 27.0, None)


def test_column_labels(spark):
    df = spark.createDataFrame([(1, 2, 3)], "PatientID int, PSC_Flag int, Total int")
    assert asm.column_labels(df, "PSC", "6mo").columns == ["PatientID", "PSC_Flag_6mo", "PSC_Total_6mo"]


@pytest.mark.parametrize(
    "reason, cleaned, category",
    [("ed/hospitalization  follow-up", "Ed/Hospitalization Follow Up", "A.S.C."),
     ("Care Coordination Consult with PCP", "Care Coordination Consultation With Pcp", "Consultations"),
     ("Change of PCP or Specialist", "Change Of Pcp Or Specialist", "Nothing"),
     ("BIRTHDAY", "Birthday", "Maintenance")],
)
def test_reasons(spark, reason, cleaned, category):
    assert value(spark, text.reason_clean(F.lit(reason))) == cleaned
    assert value(spark, con.service_category(F.lit(cleaned))) == category


def test_recent_and_counted_contacts(spark):
    columns = "PatientID long, OutcomeStatusGBLCode string, ContactTS timestamp, OutcomeDateTime timestamp"
    home, message, day = "Face to face visit successful", "Left Message", datetime(2016, 1, 1)
    rows = [(1, home, day, datetime(2016, 1, 2, 23)), (1, home, day, day), (1, message, None, datetime(2016, 3, 1)),
            (2, "unknown text", day, day), (3, home, day, day), (4, home, day, None)]
    df = spark.createDataFrame(rows, columns)
    patients = spark.createDataFrame([(1, "m1"), (2, "m2"), (3, None), (4, "m4")], "ID long, MedicaidNum string")
    (recent,) = con.recent_contact_pivot(df, patients).collect()
    assert (recent.MedicaidNum, recent.Successful_Home_Visit, recent.Successful_Phone_Contact) == ("m1", date(2016, 1, 2), None)
    counts = {r.PatientID: r for r in con.contact_counts(df, patients).collect()}
    assert set(counts) == {1, 4}
    assert (counts[1].Count_of_Successful_Home_Visit, counts[1].Count_of_Unsuccessful_Phone_Contact) == (2, 0)


def test_attendance(spark):
    df = spark.createDataFrame([(9, 1), (8, 1), (0, 0)], "Present int, Absent int")
    assert [(r.Day_Count, r.Chronic_Absent) for r in att.attendance_calc(df).collect()] == [(10, False), (9, True), (0, False)]
    quarter = lambda d: value(spark, att.school_quarter(F.lit(d)))
    assert [quarter(date(2014, 9, 2)), quarter(date(2014, 11, 7)), quarter(date(2018, 6, 18)), quarter(date(2015, 7, 1))] == ["Q1", "Q2", "Q4", None]
    grades = spark.createDataFrame([("20", date(2016, 9, 1)), ("--", None), (None, None), ("PK", date(2016, 9, 1)), ("12", date(2016, 9, 1)), ("UG", date(2016, 9, 1))], "Student_Annual_Grade_Code string, Date date")
    out = [(r.Student_Annual_Grade_Code, r.Student_Grade_Category, r.Grade_Order) for r in att.attendance_report(grades).collect()]
    assert out == [("PK", "<K", 1), ("12", "9-12", 14), (None, "UG", None)]


def test_small_converters(spark):
    v = lambda c: value(spark, c)
    assert v(text.medicaid_normalize(F.lit(" 42"))) == "000000042"
    assert v(text.medicaid_normalize(F.lit("0001234567890"))) == "1234567890"  # longer numbers are kept whole
    assert v(text.zip5(F.lit("60612-1234"))) == "60612" and v(text.zip5(F.lit("606"))) == "606"
    assert v(text.diagnosis_text_clean(F.lit("  a_b   c "))) == "a b,c"
    assert v(text.strip_leading_zeros(F.lit("000120"))) == "120"
    assert [v(reg.age_group(F.lit(a))) for a in (0, 1, 5, 6, 13, 19, 20)] == ["THB", "THB", "THT", "", "Teen", "Teen", ""]
    assert v(slash_date(F.lit("2016_03/15 x"))) == date(2016, 3, 15) and v(slash_date(F.lit("n/a"))) is None
    assert v(add_calendar_months(F.lit(date(2016, 8, 31)), F.lit(-6))) == date(2016, 2, 29)
    assert v(avg_months_between(F.lit(date(2016, 3, 1)), F.lit(date(2016, 1, 30)))) == pytest.approx(31 / 30.436875)
    assert v(whole_years_between(F.lit(date(2016, 1, 1)), F.lit(date(2000, 1, 1)))) == 16


def test_deltas(spark):
    registry = spark.createDataFrame([(r, "f", "l", date(2000, 1, 1), "M", "60612") for r in ("000000001", "000000002", "000000003")], "RIN string, fn string, ln string, dob date, gender string, zip_code string")
    sent = spark.createDataFrame([("000000001",)], "RIN string")
    enrolled = spark.createDataFrame([("000000002", date(2015, 1, 1), None), ("000000001", None, None)], "RIN string, First_Enrollment_Date date, DisEnrollment_Date date")
    rows = reg.semi_anti_delta(registry, sent, enrolled)
    member = reg.membership_delta(rows, enrolled).first()
    assert (member.PARTICIPANT_SYSTEM_ID, member.BEGIN_DATE, member.END_DATE, member.DROP_DATE) == ("2", date(2015, 1, 1), None, None)
    person = reg.participant_delta(rows, date(2016, 1, 1)).first()
    assert len(person) == 32 and (person.age, person.CITY, person.POSTAL_CODE) == (16, None, "60612")


def test_presentation_tables(spark):
    df = spark.createDataFrame([("x", "a", 1.0)] * 2 + [("x", "b", 3.0), ("y", "a", 10.0)], "g string, k string, v double")
    table = {r.k: r for r in crosstab_report(df, "g", "k", ["x", "y"], "v").collect()}
    assert (table["a"].x, table["a"].x_Text, table["b"].y_Text, table["a"].Total_Text) == (2, "2 (66.7%)", "0 (0.0%)", "3 (75.0%)")
    assert table["b"].x_Heading == "x (n=3) (%)"
    more = df.union(spark.createDataFrame([("new", "a", 1.0), ("new", "only new", 1.0), (None, "only null", 1.0)], df.schema))
    table = {r.k: r for r in crosstab_report(more, "g", "k", ["x", "y"], "v").collect()}
    assert {k: (r.x, r.y, r.Other, r.Total) for k, r in table.items()} == {"a": (2, 1, 1, 4), "b": (1, 0, 0, 1), "only new": (0, 0, 1, 1), "only null": (0, 0, 0, 0)}
    assert [(r.Count, r.Min, r.Max) for r in describe_report(df, "g", "v", "mean").where("Group = 'Total'").collect()] == [(4, 1.0, 10.0)]
    assert {r.Group: r.Final for r in describe_report(df, "g", "v", "median").collect()} == {"x": "1.00 (1.00, 2.00)", "y": "10.00 (10.00, 10.00)", "Total": "2.00 (1.00, 4.75)"}
    assert {r.Group: r.Final for r in describe_report(df, "g", "v", "mean").collect()}["x"] == "1.67 (1.15)"


def test_paired_comparison(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 3.0), (4.0, 6.0), (5.0, None)], "a double, b double")
    row = paired_stats(df, "a", "b").first()
    assert (row.n, row.First_Mean, row.Second_Mean) == (4, 2.5, 3.75)
    assert row.T_Statistic == pytest.approx(-2.6111648) and row.p_value == pytest.approx(0.0796, abs=1e-3)
    assert row.CI_95 == pytest.approx(1.98 * row.SE_diff)


def test_p_values(spark):
    # Known values, the closed forms for one and two degrees, and the normal law for very many.
    cases = [(2.228138851964939, 10, 0.05), (0.0, 4, 1.0), (1.0, 1, 0.5), (-3.0, 2, 1 - 3 / math.sqrt(11)), (1.959963984540054, 10**9, 0.05),
             (5.0, 10**10, math.erfc(5 / math.sqrt(2))), (1e4, 1, 2 / math.pi * math.atan(1e-4))]
    df = spark.createDataFrame([(t, n, p) for t, n, p in cases] + [(None, 3, None), (float("nan"), 3, None), (1.0, 0, None)], "t double, n long, p double")
    for r in df.withColumn("ours", two_sided_p(F.col("t"), F.col("n"))).collect():
        assert r.ours is None if r.p is None else r.ours == pytest.approx(r.p, rel=1e-7, abs=1e-12)


def test_exact_quantiles(spark, monkeypatch):
    pick = random.Random(5)
    rows = [(pick.choice("abb"), round(pick.choice([1, 1000, 0.01]) * pick.uniform(-5, 5), 3)) for _ in range(400)]
    rows += [("narrow", 100.001 + k * 1e-9) for k in range(900)] + [("last bits", 1.0 + k * 2.0**-52) for k in range(9)]
    rows += [("one", 7.0), ("zero", 0.0), ("zero", 0.0), ("pow", 999.9999999), ("pow", 1000.0), ("pow", 1000.1)]
    df = spark.createDataFrame(rows, "g string, v double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    wanted = F.percentile("v", F.array(*map(F.lit, probabilities))).alias("q")
    rows += [(None, 5.0), ("a", None)]
    df = df.union(spark.createDataFrame(rows[-2:], df.schema))
    expected = {r.g: r.q for r in df.where("g IS NOT NULL").groupBy("g").agg(wanted).collect()} | {"all": df.agg(wanted).first().q}
    for few, error in ((tabulate.FEW, tabulate.RANK_ERROR), (0, 0.05), (0, -0.6)):  # the last with bands that miss every rank
        monkeypatch.setattr(tabulate, "FEW", few)
        monkeypatch.setattr(tabulate, "RANK_ERROR", error)
        ours = {r.g: r for r in exact_quantiles(df, "g", "v", probabilities, "all").collect()}
        assert len(ours) == 8 and ours["all"].n == len(rows) - 1 and (ours["pow"].low, ours["pow"].high) == (999.9999999, 1000.1)
        for g, q in expected.items():
            assert ours[g].quantiles == pytest.approx(q)
    assert exact_quantiles(df.where("false"), "g", "v", probabilities, "all").count() == 0


def test_exact_quantiles_read_the_rows_twice(spark):
    df = spark.range(30_000).selectExpr("cast(id % 3 as string) g", "cast(pmod(xxhash64(id), 20011) as double) v")
    plan = exact_quantiles(df, "g", "v", [0.25, 0.5], "all")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and plan.count("Relation") <= 3
    ours = {r.g: r.quantiles for r in exact_quantiles(df, "g", "v", [0.25, 0.5], "all").collect()}
    expected = df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5))).alias("q")).collect()
    assert all(ours[r.g] == r.q for r in expected) and len(ours) == 4


def test_hot_group_description(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    assert describe_report(df, "g", "v", "median").where("Group = 'hot'").first().Final == "3.00 (1.00, 5.00)"
