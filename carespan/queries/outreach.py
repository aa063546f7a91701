"""Contacts, attendance, registry, deltas, monthly reports and presentation tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.functions import text
from carespan.functions.dates import slash_date
from carespan.operators import attendance as att
from carespan.operators import contacts as con
from carespan.operators import registry as reg
from carespan.operators.tabulate import crosstab_report, describe_report
from carespan.plans import reports
from carespan.queries.bindings import BINDINGS, Fixed
from carespan.queries.registry import Inputs, fragment, register

AS_OF = date(2005, 6, 30)

# Contacts.

BINDINGS["in_outcomes"] = Fixed(
    "Outcome string, Success string, Kind string", tuple((k, s, c) for k, (s, c) in con.OUTCOMES.items())
)
BINDINGS["in_service_categories"] = Fixed(
    "Reason string, Service_Category string", tuple((r, c) for c, rs in con.SERVICE_CATEGORIES.items() for r in rs)
)
fragment(
    "ref_contacts",
    """
SELECT c.*, p.MedicaidNum, o.Success || ' ' || o.Kind AS ContactTypeSuccess, o.Success AS ContactSuccess
FROM in_contacts c LEFT JOIN in_patient_ids p ON p.ID = c.PatientID LEFT JOIN in_outcomes o ON o.Outcome = c.OutcomeStatusGBLCode
""",
)
_CONTACT_OUT = "PatientID:i MedicaidNum ContactTS:t ContactTypeGBLcode ContactPartyGBLCode ContactReasonGBLCode ContactCHSName OutcomeStatusGBLCode OutcomeDateTime:t CUserID"


def report(t: Inputs) -> DataFrame:
    return con.contact_report(t.in_contacts, t.in_patient_ids)


@register(
    "patient_contact_only",
    "PatientID:i ContactTS:t ContactTypeGBLcode ContactPartyGBLCode",
    """
    SELECT * FROM in_contacts WHERE ContactPartyGBLCode IN ('Caregiver', 'Patient', 'Home')
      AND ContactTypeGBLcode IN ('Phone - Outbound', 'Visit', 'Home', 'Phone - Inbound')
    """,
)
def _patient_contact_only(t: Inputs) -> DataFrame:
    return con.patient_contact_only(t.in_contacts)


@register("contact_patient_left", _CONTACT_OUT, "SELECT * FROM ref_contacts")
def _contact_patient_left(t: Inputs) -> DataFrame:
    return con.contact_patient_left(t.in_contacts, t.in_patient_ids)


@register(
    "contact_outcome",
    "OutcomeStatusGBLCode General Precise Contacts:i",
    "SELECT OutcomeStatusGBLCode, ContactSuccess AS General, ContactTypeSuccess AS Precise, count(*) AS Contacts FROM ref_contacts GROUP BY ALL",
)
def _contact_outcome(t: Inputs) -> DataFrame:
    counted = t.in_contacts.groupBy("OutcomeStatusGBLCode").agg(F.count(F.lit(1)).alias("Contacts"))
    outcome = F.col("OutcomeStatusGBLCode")
    return counted.withColumns({"General": con.contact_outcome(outcome, False), "Precise": con.contact_outcome(outcome, True)})


@register("contact_report", f"{_CONTACT_OUT} ContactTypeSuccess ContactSuccess", "SELECT * FROM ref_contacts")
def _contact_report(t: Inputs) -> DataFrame:
    return report(t)


def _types(template: str) -> str:
    return ", ".join(template.format(kind=k, name=k.replace(" ", "_")) for k in con.OUTCOME_TYPES)


fragment(
    "ref_recent",
    f"""
SELECT MedicaidNum, PatientID, {_types("CAST(max(OutcomeDateTime) FILTER (ContactTypeSuccess = '{kind}') AS DATE) AS {name}")}
FROM ref_contacts WHERE MedicaidNum IS NOT NULL AND ContactTypeSuccess IS NOT NULL AND OutcomeDateTime IS NOT NULL GROUP BY MedicaidNum, PatientID
""",
)
_TYPE_DATES = " ".join(f"{k.replace(' ', '_')}:d" for k in con.OUTCOME_TYPES)


@register("recent_contact_pivot", f"MedicaidNum PatientID:i {_TYPE_DATES}", "SELECT * FROM ref_recent")
def _recent_contact_pivot(t: Inputs) -> DataFrame:
    return con.recent_contact_pivot(t.in_contacts, t.in_patient_ids)


@register(
    "contact_counts",
    "MedicaidNum PatientID:i " + " ".join(f"Count_of_{k.replace(' ', '_')}:i" for k in con.OUTCOME_TYPES),
    f"""
    SELECT MedicaidNum, PatientID, {_types("count(ContactTS) FILTER (ContactTypeSuccess = '{kind}') AS Count_of_{name}")}
    FROM ref_contacts WHERE MedicaidNum IS NOT NULL AND ContactTypeSuccess IS NOT NULL GROUP BY MedicaidNum, PatientID
    """,
)
def _contact_counts(t: Inputs) -> DataFrame:
    return con.contact_counts(t.in_contacts, t.in_patient_ids)


# Title case letter by letter: a letter is upper case unless a letter stands before it.
_TITLE = """
list_aggregate(list_transform(range(1, length(s) + 1),
  lambda i: CASE WHEN i > 1 AND regexp_matches(substr(s, CAST(i AS INT) - 1, 1), '[A-Za-z]') THEN lower(substr(s, CAST(i AS INT), 1)) ELSE upper(substr(s, CAST(i AS INT), 1)) END), 'string_agg', '')
"""
fragment(
    "ref_reasons",
    f"""
SELECT ContactReasonGBLCode, CASE WHEN s = '' THEN '' ELSE {_TITLE} END AS Reason, n AS Contacts FROM (
  SELECT ContactReasonGBLCode, count(*) AS n,
    trim(regexp_replace(replace(replace(ContactReasonGBLCode, '-', ' '), 'Care Coordination Consult ', 'Care Coordination Consultation '), '\\s+', ' ', 'g')) AS s
  FROM in_contacts GROUP BY ContactReasonGBLCode)
""",
)


@register("reason_clean", "ContactReasonGBLCode Reason Contacts:i", "SELECT * FROM ref_reasons")
def _reason_clean(t: Inputs) -> DataFrame:
    counted = t.in_contacts.groupBy("ContactReasonGBLCode").agg(F.count(F.lit(1)).alias("Contacts"))
    return counted.withColumn("Reason", text.reason_clean(F.col("ContactReasonGBLCode")))


@register(
    "service_category",
    "PatientID:i Reason Service_Category Contacts:i",
    """
    SELECT c.PatientID, r.Reason, coalesce(any_value(k.Service_Category), 'Nothing') AS Service_Category, count(*) AS Contacts
    FROM in_contacts c JOIN ref_reasons r USING (ContactReasonGBLCode) LEFT JOIN in_service_categories k ON k.Reason = r.Reason
    GROUP BY c.PatientID, r.Reason
    """,
)
def _service_category(t: Inputs) -> DataFrame:
    per_reason = t.in_contacts.groupBy("PatientID", "ContactReasonGBLCode").agg(F.count(F.lit(1)).alias("n"))
    cleaned = con.contact_services(per_reason)
    return cleaned.groupBy("PatientID", "Reason", "Service_Category").agg(F.sum("n").alias("Contacts"))


@register(
    "phone_patient_left",
    "Patient_ID:i MedicaidNum Record_Type Party_Name Party_Relationship Party_Type Phone_Type Phone_Number Primary_Flag:i Phone_Number_StartDate "
    "Phone_Number_EndDate Phone_Number_Created Phone_Number_Updated",
    """
    SELECT f.PatientID AS Patient_ID, p.MedicaidNum, 'Phone' AS Record_Type, 'Phone' AS Party_Name, 'Phone' AS Party_Relationship, 'Phone' AS Party_Type,
      Description AS Phone_Type, PhoneNumberAC || '-' || PhoneNumberPrefix || '-' || PhoneNumberLineNumber AS Phone_Number, PrimaryFlag AS Primary_Flag,
      strftime(StartDate, '%Y-%m-%d') AS Phone_Number_StartDate, strftime(EndDate, '%Y-%m-%d') AS Phone_Number_EndDate,
      strftime(CTS, '%Y-%m-%d') AS Phone_Number_Created, strftime(MTS, '%Y-%m-%d') AS Phone_Number_Updated
    FROM in_phones f LEFT JOIN in_patient_ids p ON p.ID = f.PatientID
    """,
)
def _phone_patient_left(t: Inputs) -> DataFrame:
    return con.phone_patient_left(t.in_phones, t.in_patient_ids)


# Attendance.

BINDINGS["in_quarters"] = Fixed("First_Day string, Last_Day string, Quarter string", tuple(att.QUARTERS))
_QUARTER = "(SELECT Quarter FROM in_quarters q WHERE a.Date_ BETWEEN CAST(q.First_Day AS DATE) AND CAST(q.Last_Day AS DATE))"
_GROUP = """
CASE WHEN Student_Annual_Grade_Code IN ('PK', 'PE') THEN '<K' WHEN Student_Annual_Grade_Code IN ('K', '1', '2', '3', '4', '5') THEN 'K-5'
  WHEN Student_Annual_Grade_Code IN ('6', '7', '8') THEN '6-8' WHEN Student_Annual_Grade_Code IN ('9', '10', '11', '12') THEN '9-12'
  ELSE Student_Annual_Grade_Code END
"""


def days(t: Inputs) -> DataFrame:
    return t.in_attendance.withColumnRenamed("Date_", "Date")


@register(
    "valid_grade",
    "Student_ID:i Date:d Student_Annual_Grade_Code Present:i Absent:i",
    "SELECT *, Date_ AS \"Date\" FROM in_attendance WHERE Student_Annual_Grade_Code NOT IN ('20', '--')",
)
def _valid_grade(t: Inputs) -> DataFrame:
    return att.valid_grade(days(t))


@register(
    "attendance_calc",
    "Student_ID:i Day_Count:i Att_Percent:f6 Chronic_Absent:b",
    """
    SELECT *, Present / nullif(Day_Count, 0) AS Att_Percent, coalesce(Present / nullif(Day_Count, 0) < 0.9, false) AS Chronic_Absent
    FROM (SELECT Student_ID, sum(Present) AS Present, sum(Present + Absent) AS Day_Count FROM in_attendance GROUP BY Student_ID)
    """,
)
def _attendance_calc(t: Inputs) -> DataFrame:
    per_student = t.in_attendance.groupBy("Student_ID").agg(F.sum("Present").alias("Present"), F.sum("Absent").alias("Absent"))
    return att.attendance_calc(per_student)


@register("school_quarter", "Student_ID:i Date:d Quarter", f'SELECT Student_ID, Date_ AS "Date", {_QUARTER} AS Quarter FROM in_attendance a')
def _school_quarter(t: Inputs) -> DataFrame:
    return days(t).withColumn("Quarter", att.school_quarter(F.col("Date")))


@register(
    "grade_group",
    "Student_ID:i Student_Annual_Grade_Code Student_Grade_Category Days:i",
    f"SELECT Student_ID, Student_Annual_Grade_Code, {_GROUP} AS Student_Grade_Category, count(*) AS Days FROM in_attendance GROUP BY ALL",
)
def _grade_group(t: Inputs) -> DataFrame:
    counted = t.in_attendance.groupBy("Student_ID", "Student_Annual_Grade_Code").agg(F.count(F.lit(1)).alias("Days"))
    return counted.withColumn("Student_Grade_Category", att.grade_group(F.col("Student_Annual_Grade_Code")))


_GRADE_LIST = "['PE','PK','K','1','2','3','4','5','6','7','8','9','10','11','12']"


@register(
    "attendance_report",
    "Student_ID:i Date:d Quarter Student_Grade_Category Grade_Order:i Student_Annual_Grade_Code Present:i Absent:i",
    f"""
    SELECT Student_ID, Date_ AS "Date", {_QUARTER} AS Quarter, {_GROUP} AS Student_Grade_Category,
      nullif(list_position({_GRADE_LIST}, Student_Annual_Grade_Code), 0) - 1 AS Grade_Order,
      CASE WHEN list_contains({_GRADE_LIST}, Student_Annual_Grade_Code) THEN Student_Annual_Grade_Code END AS Student_Annual_Grade_Code, Present, Absent
    FROM in_attendance a WHERE Student_Annual_Grade_Code NOT IN ('20', '--')
    """,
)
def _attendance_report(t: Inputs) -> DataFrame:
    return att.attendance_report(days(t))


BINDINGS["in_slash_dates"] = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE concat(cast(year(o_orderdate) AS string), '_', lpad(cast(o_custkey % 12 + 1 AS string), 2, '0'), '/',
  lpad(cast(o_orderkey % 28 + 1 AS string), 2, '0'), '_x') END AS raw
FROM {{orders}}
"""


@register(
    "cps_date_clean",
    "o_orderkey:i raw Day:d",
    """
    SELECT o_orderkey, raw, TRY_CAST(substr(raw, 1, 4) || '-' || substr(raw, strpos(raw, '/') - 2, 2) || '-' || substr(raw, strpos(raw, '/') + 1, 2) AS DATE) AS Day
    FROM in_slash_dates
    """,
)
def _cps_date_clean(t: Inputs) -> DataFrame:
    return t.in_slash_dates.withColumn("Day", slash_date(F.col("raw")))


# Converters and registry.


@register("zip5", "RIN zip_code Zip", "SELECT RIN, zip_code, left(zip_code, 5) AS Zip FROM in_registry")
def _zip5(t: Inputs) -> DataFrame:
    return t.in_registry.withColumn("Zip", text.zip5(F.col("zip_code")))


@register("non_empty_flag", "RIN Flag:i", "SELECT RIN, CASE WHEN other_diag <> '' THEN 1 ELSE 0 END AS Flag FROM in_registry")
def _non_empty_flag(t: Inputs) -> DataFrame:
    return t.in_registry.withColumn("Flag", text.non_empty_flag(F.col("other_diag")))


BINDINGS["in_diagnosis_texts"] = """
SELECT p_partkey, concat(' ', replace(p_name, ' ', '  '), '   ', p_brand, '_', p_type, ' ') AS raw FROM {part}
"""


@register(
    "diagnosis_text_clean",
    "p_partkey:i Clean",
    "SELECT p_partkey, replace(array_to_string(list_filter(string_split_regex(raw, '\\s+'), lambda w: w <> ''), ','), '_', ' ') AS Clean FROM in_diagnosis_texts",
)
def _diagnosis_text_clean(t: Inputs) -> DataFrame:
    return t.in_diagnosis_texts.withColumn("Clean", text.diagnosis_text_clean(F.col("raw")))


@register(
    "age_group",
    "RIN age:i Age_Group",
    "SELECT RIN, age, CASE WHEN age IN (0, 1) THEN 'THB' WHEN age IN (2, 3, 4, 5) THEN 'THT' WHEN age >= 13 AND age < 20 THEN 'Teen' ELSE '' END AS Age_Group FROM in_registry",
)
def _age_group(t: Inputs) -> DataFrame:
    return t.in_registry.withColumn("Age_Group", reg.age_group(F.col("age")))


BINDINGS["in_medicaid_texts"] = """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat(' ', cast(o_custkey AS string)) WHEN 1 THEN concat('000', cast(o_orderkey * 1000003 AS string))
  WHEN 2 THEN cast(o_orderkey * 7919 + 10000000000 AS string) ELSE lpad(cast(o_custkey AS string), 9, '0') END AS raw
FROM {orders}
"""


@register(
    "medicaid_normalize",
    "o_orderkey:i raw RIN",
    """
    SELECT o_orderkey, raw, CASE WHEN length(n) >= 9 THEN n ELSE repeat('0', 9 - length(n)) || n END AS RIN
    FROM (SELECT *, CAST(CAST(trim(raw) AS BIGINT) AS VARCHAR) AS n FROM in_medicaid_texts)
    """,
)
def _medicaid_normalize(t: Inputs) -> DataFrame:
    return t.in_medicaid_texts.withColumn("RIN", text.medicaid_normalize(F.col("raw")))


fragment(
    "ref_registry",
    """
WITH a AS (SELECT RIN, coalesce(asthma, 0) AS asthma, diabetes, scd, prematurity, newborn, epilepsy,
  CASE WHEN epilepsy + newborn > 0 THEN 1 WHEN length(coalesce(other_diag, '')) > 0 THEN 1 ELSE 0 END AS o FROM in_registry),
b AS (SELECT *, asthma + diabetes + scd + prematurity + o AS n FROM a),
c AS (SELECT *, CASE WHEN n = 0 OR epilepsy = 1 OR newborn = 1 THEN 1 ELSE o END AS other FROM b)
SELECT RIN, n AS SumDiagnosis, other AS other_diag,
  replace(array_to_string(list_filter([CASE WHEN other = 1 THEN '"Other_Diagnosis"' END, CASE WHEN diabetes = 1 THEN '"Diabetes"' END,
    CASE WHEN asthma = 1 THEN '"Asthma"' END, CASE WHEN scd = 1 THEN '"SCD"' END, CASE WHEN prematurity = 1 THEN '"Prematurity"' END], lambda x: x IS NOT NULL), ','), '_', ' ') AS FaerDiagnosis,
  CASE WHEN n = 0 THEN 'Other Diagnosis' WHEN n > 1 THEN 'Multiple Diagnoses' WHEN prematurity = 1 THEN 'Prematurity' WHEN scd = 1 THEN 'SCD'
    WHEN asthma = 1 THEN 'Asthma' WHEN diabetes = 1 THEN 'Diabetes' WHEN epilepsy = 1 OR newborn = 1 THEN 'Other Diagnosis' END AS Diagnosis
FROM c
""",
)


@register("registry_diagnosis", "RIN SumDiagnosis:i other_diag:i FaerDiagnosis Diagnosis", "SELECT * FROM ref_registry")
def _registry_diagnosis(t: Inputs) -> DataFrame:
    return reg.registry_diagnosis(t.in_registry)


BINDINGS["in_icd_dictionary"] = "SELECT concat('D', cast(n_nationkey AS string)) AS Code, n_name AS Text FROM {nation} WHERE n_nationkey % 3 <> 0"


@register(
    "icd_translate",
    "RecipientID DiagCd Lines:i",
    """
    SELECT RecipientID, coalesce(n.Text, d.DiagCd) AS DiagCd, count(*) AS Lines FROM in_diagnosis d LEFT JOIN in_icd_dictionary n ON n.Code = d.DiagCd GROUP BY 1, 2
    """,
)
def _icd_translate(t: Inputs) -> DataFrame:
    counted = t.in_diagnosis.groupBy("RecipientID", "DiagCd").agg(F.count(F.lit(1)).alias("n"))
    translated = reg.icd_translate(counted, "DiagCd", t.in_icd_dictionary)
    return translated.groupBy("RecipientID", "DiagCd").agg(F.sum("n").alias("Lines"))


@register(
    "rename_columns",
    "RIN Asthma:i Diabetes:i SCD:i Prematurity:i DOB:d Zip_Code",
    'SELECT RIN, asthma AS "Asthma", diabetes AS "Diabetes", scd AS "SCD", prematurity AS "Prematurity", dob AS "DOB", zip_code AS "Zip_Code" FROM in_registry',
)
def _rename_columns(t: Inputs) -> DataFrame:
    source = t.in_registry.withColumnRenamed("RIN", "Medicaid Rin")
    return reg.rename_columns(source)


_NEW_ROWS = """
SELECT * FROM in_registry WHERE RIN NOT IN (SELECT lpad(PARTICIPANT_SYSTEM_ID, 9, '0') FROM in_participants)
  AND RIN IN (SELECT RecipientID FROM in_enrollment WHERE PatientID % 6 <> 0)
"""
fragment("ref_new_rows", _NEW_ROWS)


def enrolled(t: Inputs) -> DataFrame:
    return t.in_enrollment.where(F.col("PatientID") % 6 != 0).withColumnRenamed("RecipientID", "RIN")


def new_rows(t: Inputs) -> DataFrame:
    sent = t.in_participants.select(text.medicaid_normalize(F.col("PARTICIPANT_SYSTEM_ID")).alias("RIN"))
    return reg.semi_anti_delta(t.in_registry, sent, enrolled(t))


@register("semi_anti_delta", "RIN fn ln dob:d", "SELECT * FROM ref_new_rows")
def _semi_anti_delta(t: Inputs) -> DataFrame:
    return new_rows(t)


_MEMBERSHIP_OUT = (
    "PARTICIPANT_SYSTEM_ID BEGIN_DATE:d END_DATE:d DROP_DATE:d MEMBERSHIP_ENTRY_REASONS MEMBERSHIP_EXIT_REASONS MEMBERSHIP_REFERENCE"
)
fragment(
    "ref_membership",
    """
SELECT ltrim(r.RIN, '0') AS PARTICIPANT_SYSTEM_ID, e.First_Enrollment_Date AS BEGIN_DATE, e.DisEnrollment_Date AS END_DATE, CAST(NULL AS DATE) AS DROP_DATE,
  NULL AS MEMBERSHIP_ENTRY_REASONS, NULL AS MEMBERSHIP_EXIT_REASONS, NULL AS MEMBERSHIP_REFERENCE
FROM ref_new_rows r LEFT JOIN in_enrollment e ON e.RecipientID = r.RIN
""",
)


@register("membership_delta", _MEMBERSHIP_OUT, "SELECT * FROM ref_membership")
def _membership_delta(t: Inputs) -> DataFrame:
    return reg.membership_delta(new_rows(t), enrolled(t))


_FILLED = {
    "PARTICIPANT_SYSTEM_ID": "ltrim(RIN, '0')",
    "PARTICIPANT_LOCAL_ID": "ltrim(RIN, '0')",
    "FIRST_NAME": "fn",
    "LAST_NAME": "ln",
    "BIRTH_DATE": "dob",
    "PARTICIPANT_GENDER": "gender",
    "POSTAL_CODE": "zip_code",
    "age": f"CAST(trunc(date_diff('day', dob, DATE '{AS_OF}') / 365.2425) AS INT)",
    "UPDATE_DATE": "CAST(NULL AS DATE)",
}
_PARTICIPANT_KINDS = {"BIRTH_DATE": ":d", "UPDATE_DATE": ":d", "age": ":i"}
_PARTICIPANT_OUT = " ".join(c + _PARTICIPANT_KINDS.get(c, "") for c in reg.PARTICIPANT_LAYOUT)
_PARTICIPANT_CELLS = ", ".join(f'{_FILLED.get(c, "NULL")} AS "{c}"' for c in reg.PARTICIPANT_LAYOUT)


@register("participant_delta", _PARTICIPANT_OUT, f"SELECT {_PARTICIPANT_CELLS} FROM ref_new_rows")
def _participant_delta(t: Inputs) -> DataFrame:
    return reg.participant_delta(new_rows(t), AS_OF)


@register("constant_columns", _PARTICIPANT_OUT, f"SELECT {_PARTICIPANT_CELLS} FROM in_registry")
def _constant_columns(t: Inputs) -> DataFrame:
    return reg.participant_delta(t.in_registry, AS_OF)


@register(
    "delta_append",
    "Delta Rows:i First_ID Last_ID",
    """
    SELECT 'membership' AS Delta, count(*) AS "Rows", min(PARTICIPANT_SYSTEM_ID) AS First_ID, max(PARTICIPANT_SYSTEM_ID) AS Last_ID
    FROM (SELECT PARTICIPANT_SYSTEM_ID FROM in_participants UNION ALL SELECT PARTICIPANT_SYSTEM_ID FROM ref_membership)
    UNION ALL SELECT 'participant', count(*), min(i), max(i)
    FROM (SELECT PARTICIPANT_SYSTEM_ID AS i FROM in_participants UNION ALL SELECT ltrim(RIN, '0') FROM ref_new_rows)
    """,
)
def _delta_append(t: Inputs) -> DataFrame:
    """Both deltas appended to tables that hold what was sent before."""
    from carespan.session import fresh_path
    from carespan.sources.tables import append_table, delta_table_name

    fresh = {"membership": reg.membership_delta(new_rows(t), enrolled(t)), "participant": reg.participant_delta(new_rows(t), AS_OF)}
    parts = []
    for kind, delta in fresh.items():
        path = fresh_path(t.spark, delta_table_name(kind))
        append_table(t.in_participants.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "PARTICIPANT_SYSTEM_ID" else f.name for f in delta.schema]), path)
        append_table(delta, path)
        parts.append(
            t.spark.read.parquet(path).agg(
                F.lit(kind).alias("Delta"),
                F.count(F.lit(1)).alias("Rows"),
                F.min("PARTICIPANT_SYSTEM_ID").alias("First_ID"),
                F.max("PARTICIPANT_SYSTEM_ID").alias("Last_ID"),
            )
        )
    return parts[0].unionByName(parts[1])


# Demographics and monthly reports.

fragment(
    "ref_demo",
    """
SELECT e.*, s.Current_Enrollment_Status, s.Group_, g.E2, g.E4, g.HE2, g.HE4, g.Program_Date, r.Consensus_Risk
FROM in_enrollment e LEFT JOIN in_status s USING (RecipientID) LEFT JOIN in_grouping g USING (RecipientID) JOIN in_consensus_risk r USING (PatientID)
""",
)


def demo(t: Inputs) -> DataFrame:
    status = t.in_status.withColumnRenamed("Group_", "Group")
    return reg.demo_assembly(t.in_enrollment, status, t.in_grouping, t.in_consensus_risk)


@register(
    "demo_assembly",
    "RecipientID PatientID:i Current_Enrollment_Status Group E2:i E4:i HE2:i HE4:i Program_Date:d Consensus_Risk MCO_Name",
    'SELECT *, Group_ AS "Group" FROM ref_demo',
)
def _demo_assembly(t: Inputs) -> DataFrame:
    return demo(t)


@register(
    "report_cohorts",
    "Cohort PatientID:i RecipientID",
    """
    SELECT 'active' AS Cohort, PatientID, RecipientID FROM ref_demo WHERE Current_Enrollment_Status = 'Active'
    UNION ALL SELECT 'enrolled', PatientID, RecipientID FROM ref_demo WHERE Current_Enrollment_Status = 'Active' AND Group_ = 'Enrolled'
    UNION ALL SELECT 'engaged payer', PatientID, RecipientID FROM ref_demo
      WHERE Current_Enrollment_Status = 'Active' AND Group_ = 'Engaged' AND MCO_Name = 'Blue Cross Blue Shield'
    """,
)
def _report_cohorts(t: Inputs) -> DataFrame:
    return reports.labelled_cohorts(demo(t)).select("Cohort", "PatientID", "RecipientID")


@register(
    "rpt_active_engaged_payer",
    "PatientID:i RecipientID First_Name Last_Name Gender DOB:d Current_Enrollment_Status",
    "SELECT * FROM ref_demo WHERE MCO_Name = 'Blue Cross Blue Shield' AND Current_Enrollment_Status = 'Active' AND Group_ = 'Engaged'",
)
def _rpt_active_engaged_payer(t: Inputs) -> DataFrame:
    return reports.rpt_active_engaged_payer(demo(t))


@register(
    "rpt_enrolled_not_engaged",
    "PatientID:i RecipientID AssignedTo Initial_Enrollment_Date:d",
    """
    SELECT d.PatientID, d.RecipientID, coalesce(c.AssignedTo, 'Unassigned') AS AssignedTo, d.Initial_Enrollment_Date
    FROM ref_demo d LEFT JOIN in_care_team c USING (PatientID) WHERE Current_Enrollment_Status = 'Active' AND Group_ = 'Enrolled'
    """,
)
def _rpt_enrolled_not_engaged(t: Inputs) -> DataFrame:
    return reports.rpt_enrolled_not_engaged(demo(t), t.in_care_team)


fragment(
    "ref_careplan",
    """
SELECT d.PatientID, d.RecipientID, d.Group_ AS "Group", d.Engagement_Date, d.Consensus_Risk AS Risk, r.* EXCLUDE (PatientID, MedicaidNum),
  p.StartDate, m.NetID, w.ConsensusUsername, w.FirstName
FROM ref_demo d LEFT JOIN ref_recent r USING (PatientID) LEFT JOIN in_careplan p USING (PatientID)
LEFT JOIN in_worker_mapping m USING (PatientID) LEFT JOIN in_workers w ON w.NetID = m.NetID WHERE d.Current_Enrollment_Status = 'Active'
""",
)


def careplan(t: Inputs) -> DataFrame:
    return reports.careplan_assembly(demo(t), t.in_contacts, t.in_patient_ids, t.in_careplan, t.in_worker_mapping, t.in_workers)


_CAREPLAN_OUT = f"PatientID:i RecipientID Group Engagement_Date:d Risk {_TYPE_DATES} StartDate:d NetID ConsensusUsername FirstName"


@register("careplan_assembly", _CAREPLAN_OUT, "SELECT * FROM ref_careplan")
def _careplan_assembly(t: Inputs) -> DataFrame:
    return careplan(t)


@register(
    "rpt_careplan_with",
    f"{_CAREPLAN_OUT} AssignedTo",
    """SELECT a.*, c.AssignedTo FROM ref_careplan a LEFT JOIN in_care_team c USING (PatientID) WHERE a.StartDate IS NOT NULL AND a."Group" = 'Engaged'""",
)
def _rpt_careplan_with(t: Inputs) -> DataFrame:
    return reports.rpt_careplan_with(careplan(t), t.in_care_team)


@register(
    "rpt_careplan_without",
    "PatientID:i RecipientID Group Engagement_Date:d Risk NetID ConsensusUsername FirstName AssignedTo",
    """
    SELECT a.*, coalesce(c.AssignedTo, 'Unassigned') AS AssignedTo FROM ref_careplan a LEFT JOIN in_care_team c USING (PatientID)
    WHERE a.StartDate IS NULL AND a."Group" = 'Engaged'
    """,
)
def _rpt_careplan_without(t: Inputs) -> DataFrame:
    return reports.rpt_careplan_without(careplan(t), t.in_care_team)


@register(
    "rpt_payer_worker",
    "PatientID:i Current_Enrollment_Status MCO_Name",
    "SELECT d.* FROM ref_demo d LEFT JOIN in_care_team c USING (PatientID) WHERE d.Current_Enrollment_Status = 'Active'",
)
def _rpt_payer_worker(t: Inputs) -> DataFrame:
    return reports.rpt_payer_worker(demo(t), t.in_care_team)


# Presentation tables.

_VALUES = ["Low", "High"]  # the third value present shows under Other


def _pct(n: str, total: str) -> str:
    tenths = f"((2000 * CAST({n} AS BIGINT) + CAST({total} AS BIGINT)) // (2 * CAST({total} AS BIGINT)))"
    return f"(CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) || '%')"


@register(
    "crosstab_report",
    "Diagnosis_Category "
    + " ".join(f"{v}:i {v}_Perc {v}_Text {v}_Heading" for v in [*_VALUES, "Other"])
    + " Total:i Total_Perc Total_Text",
    f"""
    WITH c AS (SELECT Diagnosis_Category, {', '.join(f"count(RecipientID) FILTER (Current_Risk = '{v}') AS {v}" for v in _VALUES)},
      count(RecipientID) FILTER (Current_Risk NOT IN ({', '.join(f"'{v}'" for v in _VALUES)})) AS Other, count(RecipientID) FILTER (Current_Risk IS NOT NULL) AS Total FROM in_patient GROUP BY Diagnosis_Category),
    g AS (SELECT {', '.join(f'sum({v}) AS g{v}' for v in [*_VALUES, 'Other', 'Total'])} FROM c)
    SELECT c.*, {', '.join(f"{_pct(v, 'g' + v)} AS {v}_Perc, {v} || ' (' || {_pct(v, 'g' + v)} || ')' AS {v}_Text" for v in [*_VALUES, 'Other', 'Total'])},
      {', '.join(f"'{v} (n=' || g{v} || ') (%)' AS {v}_Heading" for v in [*_VALUES, 'Other'])} FROM c, g
    """,
)
def _crosstab_report(t: Inputs) -> DataFrame:
    return crosstab_report(t.in_patient, "Current_Risk", "Diagnosis_Category", _VALUES, "RecipientID")


_MEAN_TEXT = "printf('%.2f', avg(v)) || ' (' || coalesce(printf('%.2f', stddev_samp(v)), 'nan') || ')'"
_MEDIAN_TEXT = "printf('%.2f', quantile_cont(v, 0.5)) || ' (' || printf('%.2f', quantile_cont(v, 0.25)) || ', ' || printf('%.2f', quantile_cont(v, 0.75)) || ')'"


@register(
    "describe_report",
    "Group Description Final Count:i Min:f4 Max:f4",
    f"""
    WITH r AS (SELECT RecordIDCd AS g, CAST(p_size AS DOUBLE) AS v FROM in_line UNION ALL SELECT 'Total', CAST(p_size AS DOUBLE) FROM in_line)
    SELECT g AS "Group", 'p_size mean' AS Description, {_MEAN_TEXT} AS Final, count(*) AS Count, min(v) AS Min, max(v) AS Max FROM r GROUP BY g
    UNION ALL SELECT g, 'p_size median', {_MEDIAN_TEXT}, count(*), min(v), max(v) FROM r GROUP BY g
    """,
)
def _describe_report(t: Inputs) -> DataFrame:
    return describe_report(t.in_line, "RecordIDCd", "p_size", "mean").unionByName(
        describe_report(t.in_line, "RecordIDCd", "p_size", "median")
    )
