"""Hand-worked diagnoses, risk tiers, scores and labels."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.operators import cdps, diagnosis as dx, population as pop, registry as reg, risk
from carespan.operators.patients import program_columns


def counts(spark, rows):
    return spark.createDataFrame(rows, "RecipientID string, DiagCd string, ICD_Count long")


def people(spark, *rows):
    return spark.createDataFrame(rows, "RecipientID string, Enrollment_Age int, Gender string")


TABLE = [("SCD", "S1", "I"), ("SCD", "S2", "E"), ("Asthma", "A1", "I"), ("Asthma", "A2", "E"), ("Prematurity", "P1", "I"), ("Epilepsy", "E1", "I")]


def test_inclusion_ratio(spark):
    table = spark.createDataFrame(TABLE, "Group_Name string, Dx_Code string, Incl_Excl string")
    rows = [
        ("a", "S1", 3), ("a", "S2", 1),  # exactly three quarters
        ("b", "S1", 2), ("b", "S2", 1),  # two thirds
        ("c", "A1", 50), ("c", "A2", 1),  # one exclusion code disqualifies
        ("d", "A1", 1),
        ("e", "A2", 4),  # exclusions only
    ]
    found = {(r.RecipientID, r.Group_Name) for r in dx.dx_inclusion_exclusion(counts(spark, rows), table).collect()}
    assert found == {("a", "SCD"), ("d", "Asthma")}


def test_primary_category(spark):
    table = spark.createDataFrame(TABLE, "Group_Name string, Dx_Code string, Incl_Excl string")
    rows = [("a", "S1", 1), ("a", "A1", 1), ("b", "P1", 1), ("b", "A1", 1), ("c", "P1", 1), ("d", "E1", 1), ("e", "ZZ", 1)]
    patients = people(spark, ("a", 9, "Male"), ("b", 4, "Male"), ("c", 3, "Male"), ("d", 5, "Male"), ("e", 5, "Male"), ("f", 5, "Male"))
    out = {r.RecipientID: r for r in dx.dx_primary(patients, counts(spark, rows), table).collect()}
    assert {k: r.Diagnosis_Category for k, r in out.items()} == {
        "a": "SCD", "b": "Asthma", "c": "Prematurity", "d": "Neurological", "e": "Other", "f": "NA",
    }
    assert out["b"].Prematurity == 0 and out["a"].ICD_List == "A1,S1" and out["f"].ICD_List == "0"


def test_pregnancy_has_three_states(spark):
    table = spark.createDataFrame([("Delivery", "D1", "I")], "Group_Name string, Dx_Code string, Incl_Excl string")
    rows = [("a", "D1", 1), ("b", "D1", 1), ("c", "D1", 1)]
    patients = people(spark, ("a", 11, "Female"), ("b", 10, "Female"), ("c", 20, "Male"), ("d", 20, "Female"))
    flags = {r.RecipientID: r.Preg_Flag for r in dx.dx_pregnancy(patients, counts(spark, rows), table).collect()}
    assert flags == {"a": 1, "b": None, "c": None, "d": 0}


@pytest.mark.parametrize(
    "ed, ip, tier",
    [(0, 0, "Low"), (1, 0, "Medium"), (3, 0, "Medium"), (4, 0, "High"), (0, 1, "Medium"), (5, 1, "Medium"), (2, 5, "Medium"), (0, 2, "High"), (4, 2, "High")],
)
def test_tier(spark, ed, ip, tier):
    assert spark.range(1).select(risk.risk_tier(F.lit(ed), F.lit(ip)).alias("t")).first().t == tier


def daily(spark, *rows):
    return spark.createDataFrame(rows, "RecipientID string, ServiceFromDt date, IP long, ED long")


PATIENTS = "RecipientID string, Program_Date date, Initial_Enrollment_Date date, Engagement_Date date"


def test_lookback_is_inclusive_at_both_ends(spark):
    patients = spark.createDataFrame(
        [(p, date(2016, 2, 29), None, None) for p in "abcd"] + [("e", date(2015, 1, 1), date(2016, 2, 29), None)], PATIENTS
    )
    events = daily(
        spark,
        ("a", date(2015, 2, 28), 0, 2), ("a", date(2016, 2, 29), 1, 2),  # both ends count; month end is clamped
        ("b", date(2015, 2, 27), 9, 9), ("b", date(2016, 3, 1), 9, 9),
        ("e", date(2016, 1, 1), 2, 0),
    )
    out = {r.RecipientID: (r.ED, r.IP, r.Enrollment_Risk) for r in risk.risk_enrollment(patients, events).collect()}
    assert out == {"a": (4, 1, "Medium"), "b": (0, 0, "Low"), "c": (0, 0, "Low"), "d": (0, 0, "Low"), "e": (0, 2, "High")}


def test_assembly_agrees_with_single_risks(spark):
    patients = spark.createDataFrame(
        [("a", date(2016, 1, 1), None, date(2016, 6, 1)), ("b", date(2016, 1, 1), date(2015, 1, 1), None)], PATIENTS
    )
    events = daily(spark, ("a", date(2015, 12, 1), 0, 1), ("a", date(2016, 3, 1), 2, 0), ("b", date(2014, 6, 1), 0, 4))
    out = {r.RecipientID: tuple(r)[1:] for r in risk.risk_assembly(patients, events, date(2016, 12, 31)).collect()}
    # (Enrollment, Engagement, Current); engagement stays empty without a date
    # At engagement a has one ED line, which makes Medium despite two admissions.
    assert out == {"a": ("Medium", "Medium", "High"), "b": ("High", None, "Low")}


def test_release_risks_join_on_the_patient(spark):
    patients = spark.createDataFrame([(p, None, None, None) for p in "cab"], PATIENTS)
    releases = spark.createDataFrame(
        [(1, date(2015, 1, 1)), (2, date(2016, 1, 1)), (3, date(2017, 1, 1))], "ReleaseNum int, HFS_Release_Date date"
    )
    events = daily(spark, ("b", date(2014, 6, 1), 0, 1), ("b", date(2016, 6, 1), 2, 0), ("a", date(2016, 1, 1), 1, 0))
    out = {(r.RecipientID, r.ReleaseNum): tuple(r)[2:] for r in risk.risk_all_releases(patients, events, releases).collect()}
    # The pattern leaves the latest release out; every release of the table has its row.
    assert [out["b", n] for n in (1, 2, 3)] == [(5, 12, "50"), (0, 12, "50"), (7, 12, "50")]
    assert [out["a", n] for n in (1, 2, 3)] == [(0, 10, "05"), (5, 10, "05"), (5, 10, "05")]
    assert [out["c", n] for n in (1, 2, 3)] == [(0, 0, "00")] * 3 and len(out) == 9


def test_groups_left_off_the_list_are_named(spark):
    patients = spark.createDataFrame([("a",), ("b",)], "RecipientID string")
    table = spark.createDataFrame([("d1", "Asthma", "I"), ("d2", "New", "I"), ("d3", "Also", "I")], "Dx_Code string, Group_Name string, Incl_Excl string")
    codes = counts(spark, [("a", "d1", 1), ("a", "d2", 1), ("a", "d3", 2)])
    out = {r.RecipientID: tuple(r)[1:] for r in dx.dx_flags(patients, codes, table, ["Asthma"]).collect()}
    assert out == {"a": (1, "Also,New"), "b": (0, "")}


def test_score_takes_the_most_severe_code_per_group(spark):
    patients = spark.createDataFrame([("a", 0, "Male"), ("b", 10, "Female"), ("c", 30, None), ("d", 4, "Male")], "RecipientID string, Age int, Gender string")
    icd = spark.createDataFrame([("x1", "CARL"), ("x2", "CARVH"), ("x3", "GIL"), ("x4", "CPULH")], "ICD string, Code string")
    rows = [("a", "x1", 5), ("a", "x2", 1), ("a", "x3", 1), ("b", "x4", 1), ("b", "zz", 1)]
    out = {r.RecipientID: r for r in cdps.cdps_demographic_adjust(cdps.cdps_score(patients, counts(spark, rows), icd)).collect()}
    assert out["a"].UCSD_Risk_Raw == pytest.approx(2.489 + 0.176)
    assert out["a"].UCSD_Risk == pytest.approx(2.665 + 0.398 + 0.226)
    assert out["b"].UCSD_Risk_Raw == 0  # weighted codes outside every group are never reached
    assert out["b"].UCSD_Risk == pytest.approx(-0.105 + 0.226)
    assert out["c"].UCSD_Risk is None
    assert out["d"].UCSD_Risk == pytest.approx(-0.068 + 0.226)


def test_program_columns(spark):
    columns = "RecipientID string, E2 int, E4 int, HC int, HE2 int, HE4 int, Enrollment_Age int, Engagement_Age int, Enrollment_Age_Category string, Engagement_Age_Category string, Enrollment_Risk string, Engagement_Risk string"
    rest = (1, 2, "e", "g", "Low", "High")
    rows = [("a", 1, 0, 0, 0, 0, *rest), ("b", 1, 1, 1, 1, 0, *rest), ("c", None, 1, 0, 0, 0, *rest), ("d", 0, 0, 0, 0, 0, *rest)]
    out = {r.RecipientID: (r.Population_Type, r.Program_Age, r.Program_Risk) for r in program_columns(spark.createDataFrame(rows, columns)).collect()}
    assert out == {"a": ("Engaged", 2, "High"), "b": ("Harmony_Engaged", 2, "High"), "c": ("Enrolled", 1, "Low"), "d": (None, 1, "Low")}


def test_population_counts_ignore_case(spark):
    df = spark.createDataFrame([("a", 1, 0, "Low", "Asthma", "0-1"), ("b", 1, 1, "low", "SCD", "0-1"), ("c", 0, 1, "High", "SCD", "2-5")],
                               "RecipientID string, E2 int, E4 int, Current_Risk string, Diagnosis_Category string, Age_Category string")
    assert pop.population_label_value(df, "Engaged", "Current_Risk", "LOW").first().Count == 2
    summary = {(r.Population, r.Label, r.Cross_Label): r.Count for r in pop.rpt_population_summary(df).collect()}
    assert summary[("Enrolled", "SCD", None)] == 2 and summary[("All", "0-1", "SCD")] == 1
    assert sum(v for (p, _, c), v in summary.items() if p == "All" and c is None) == 9


def test_registry(spark):
    columns = "RIN string, asthma int, diabetes int, scd int, prematurity int, newborn int, epilepsy int, other_diag string"
    rows = [("none", 0, 0, 0, 0, 0, 0, ""), ("asthma", 1, None, 0, 0, 0, 0, None), ("two", 1, 1, 0, 0, 0, 0, ""),
            ("born", 0, 0, 0, 0, 1, 0, ""), ("text", 0, 0, 0, 0, 0, 0, "murmur"), ("both", 0, 0, 1, 0, 0, 1, "")]
    out = {r.RIN: r for r in reg.registry_diagnosis(spark.createDataFrame(rows, columns)).collect()}
    assert {k: r.Diagnosis for k, r in out.items()} == {
        "none": "Other Diagnosis", "asthma": "Asthma", "two": "Multiple Diagnoses", "born": "Other Diagnosis", "text": None, "both": "Multiple Diagnoses",
    }
    assert out["two"].FaerDiagnosis == '"Diabetes","Asthma"'
    assert out["both"].FaerDiagnosis == '"Other Diagnosis","SCD"'
