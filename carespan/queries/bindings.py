"""Driver tables seen as claims, patients, contacts and questionnaires.

Each binding is one deterministic SELECT that Spark and DuckDB both evaluate.
``{name}`` refers to a table or another binding; ``{each:n}`` repeats a row for
i = 0..n. Small rule tables are ``Fixed`` rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from carespan.functions.instruments import ASSESSMENTS, QUESTIONS
from carespan.functions.lookups import fixed_table


@dataclass(frozen=True)
class Fixed:
    schema: str
    rows: tuple[tuple[Any, ...], ...]


def fixed_frame(spark: SparkSession, binding: Fixed) -> DataFrame:
    return fixed_table(spark, binding.schema, binding.rows)


_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def fixed_sql(binding: Fixed) -> str:
    fields = [field.split() for field in binding.schema.split(",")]
    casts = ", ".join(f'CAST("{name}" AS {_DUCK_TYPES[kind]}) AS "{name}"' for name, kind in fields)
    names = ", ".join(f'"{name}"' for name, _ in fields)
    rows = ",\n".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in binding.rows)
    return f"SELECT {casts} FROM (VALUES\n{rows}) AS t({names})"


_EACH = re.compile(r"\{each:([^}]*)\}")


def spark_sql_text(binding: str) -> str:
    return _EACH.sub(r"LATERAL VIEW explode(sequence(0, cast(\1 as int))) copies AS i", binding)


def sql_text(binding: str) -> str:
    text = _EACH.sub(r", unnest(range(0, cast(\1 as int) + 1)) AS copies(i)", binding)
    return re.sub(r"\{(\w+)\}", r"\1", text)


FIRST_BILL = "1995-01-01"
RELEASE_DATE = "2001-08-01"
RELEASE = 2007

KEY = "DCN, ServiceLineNbr, RejectionStatusCd, RecipientID, AdjudicatedDt"

BINDINGS: dict[str, str | Fixed] = {}

# Claim lines with everything the claim tables derive from. The line number is
# made unique within the document by part and supplier.
BINDINGS["in_line"] = """
SELECT lpad(cast(l.l_orderkey AS string), 15, '0') AS DCN,
  concat(lpad(cast(l.l_linenumber AS string), 2, '0'), '-', lpad(cast(l.l_partkey AS string), 9, '0'), '-',
         lpad(cast(l.l_suppkey AS string), 9, '0')) AS ServiceLineNbr,
  CASE WHEN l.l_linestatus = 'F' THEN 'N' ELSE 'Y' END AS RejectionStatusCd,
  lpad(cast(o.o_custkey AS string), 9, '0') AS RecipientID,
  cast(l.l_shipdate AS date) AS AdjudicatedDt,
  cast(o.o_orderdate AS date) AS ServiceFromDt,
  cast(o.o_orderdate AS date) + (l.l_linenumber - 1) AS ServiceThruDt,
  CASE l.l_returnflag WHEN 'A' THEN 'I' WHEN 'R' THEN 'O' ELSE 'N' END AS RecordIDCd,
  cast(l.l_extendedprice AS decimal(18,2)) AS price,
  cast(l.l_discount AS decimal(4,2)) AS discount,
  cast(l.l_tax AS decimal(4,2)) AS tax,
  cast(l.l_quantity AS decimal(18,2)) AS quantity,
  cast(p.p_retailprice AS decimal(18,2)) AS retail,
  l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag, p.p_size,
  cast(substring(p.p_brand, 7) AS int) AS brand
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
"""

BINDINGS["in_claims"] = f"""
SELECT {KEY}, ServiceFromDt, ServiceThruDt, lpad(cast(p_size % 25 AS string), 3, '0') AS CatgofServiceCd, RecordIDCd,
  lpad(cast(l_suppkey AS string), 10, '0') AS ProviderNPI,
  CASE WHEN tax = 0.00 THEN NULL ELSE cast(quantity * retail AS decimal(18,2)) END AS EncounterPriceAmt,
  cast(price * (cast(1 AS decimal(4,2)) - discount) AS decimal(18,2)) AS NetLiabilityAmt
FROM {{in_line}}
"""

BINDINGS["in_revenue"] = f"""
SELECT {KEY}, CASE (p_size + i) % 5 WHEN 0 THEN '0450' WHEN 1 THEN '0001' ELSE '0300' END AS RevenueCd,
  concat('H', cast((brand + 7 * i) % 25 + 1 AS string)) AS RevenueHCPCSCd, cast(i AS int) AS SeqLine
FROM {{in_line}} {{each:p_size % 3}} WHERE RecordIDCd <> 'N' AND p_size % 13 <> 0
"""

BINDINGS["in_institutional"] = f"""
SELECT {KEY},
  CASE WHEN p_size <= 15 THEN 111 WHEN p_size <= 25 THEN 211 WHEN p_size <= 35 THEN 811 ELSE 131 END AS UBTypeofBillCd,
  ServiceFromDt AS AdmissionDt,
  CASE WHEN p_size % 11 = 0 THEN NULL ELSE ServiceThruDt + p_size % 10 END AS DischargeDt,
  CASE WHEN p_size % 4 = 3 THEN '20' ELSE '01' END AS PatientStatusCd,
  concat('D', cast(brand AS string)) AS AdmissionDiagCd,
  CASE WHEN l_linenumber % 2 = 0 THEN '09' ELSE '10' END AS ICDVersion
FROM {{in_line}} WHERE RecordIDCd = 'I' AND p_size % 17 <> 0
"""

BINDINGS["in_procedure"] = f"""
SELECT {KEY}, CASE WHEN (p_size + i) % 7 = 0 THEN NULL ELSE concat('P', cast((brand + 3 * i) % 25 + 1 AS string)) END AS ProcCd
FROM {{in_line}} {{each:(p_size + l_linenumber) % 3}} WHERE RecordIDCd <> 'O' AND p_size % 6 <> 5
"""

BINDINGS["in_nips"] = f"""
SELECT {KEY}, CASE p_size % 3 WHEN 0 THEN '11' WHEN 1 THEN '22' ELSE '' END AS PlaceOfServiceCd
FROM {{in_line}} WHERE RecordIDCd = 'N' AND p_size % 10 <> 9
"""

BINDINGS["in_diagnosis"] = f"""
SELECT {KEY}, concat('D', cast(brand AS string)) AS DiagCd FROM {{in_line}} WHERE cast(RecipientID AS int) % 29 <> 3
"""

_OP_RULES = (
    [("OUTPATIENT", "EMERGENCY", "EMERGENCY_OP", 1.0, 1.0, "0450", f"H{n}", None, None) for n in range(1, 19)]
    + [("OUTPATIENT", "CLINIC", "CLINIC_OP", 4.0, 4.0, "0300", f"H{n}", None, None) for n in range(4, 12)]
    + [("OUTPATIENT", "LAB", "LAB_OP", 4.0, 4.0, "0300", f"H{n}", None, None) for n in (5, 6, 20)]
    + [("OUTPATIENT", "OUTPATIENT", "OUTPATIENT_OP", 3.0, 3.0, "0300", f"H{n}", None, None) for n in (12, 13, 14)]
    + [("OUTPATIENT", "ANCILLARY", "AMBULANCE_OP", 8.0, 8.0, "0540", f"H{n}", None, None) for n in (14, 15)]
    + [("OUTPATIENT", "ANCILLARY", "DME_OP", 9.0, 9.0, "0290", f"H{n}", None, None) for n in (15, 16)]
    + [("OUTPATIENT", "ANCILLARY", "HOME_HEALTH_OP", 10.0, 10.0, "0570", f"H{n}", None, None) for n in (16, 17)]
)
_NIPS_RULES = (
    [("NIPS", "VISIT", "OFFICE_VISIT", 2.0, 2.0, None, None, f"P{n}", "11") for n in range(1, 7)]
    + [("NIPS", "VISIT", "HOSPITAL_OUTPATIENT_VISIT", 3.0, 3.0, None, None, f"P{n}", "22") for n in range(3, 9)]
    + [("NIPS", "VISIT", "OTHER_OUTPATIENT_VISIT", 5.0, 5.0, None, None, f"P{n}", None) for n in (5, 6, 9, 10)]
    + [("NIPS", "VISIT", "PREVENTIVE_VISIT", 1.0, 4.0, None, None, f"P{n}", "") for n in (10, 11, 12)]
    + [("NIPS", "DRUG", "DRUG_PROF", 6.0, 6.0, None, None, f"P{n}", "") for n in (12, 13, 14)]
    + [("NIPS", "LAB", "LAB_PROF", 7.0, 7.0, None, None, f"P{n}", None) for n in (15, 16)]
)
_RULE_SCHEMA = (
    "Category1 string, Category2 string, Category3 string, Category2Rank double, Category3Rank double, "
    "RevenueCd string, RevenueHCPCSCd string, ProcCd string, PlaceOfServiceCd string"
)
BINDINGS["in_bill_rules"] = Fixed(_RULE_SCHEMA, tuple(_OP_RULES + _NIPS_RULES))

BINDINGS["in_summary_map"] = Fixed(
    "Category1 string, Category2 string, Category3 string, Summary_Category string",
    (
        ("INPATIENT", "INPATIENT", "INPATIENT_IP", "INPATIENT"),
        ("INPATIENT", "INPATIENT", "EMERGENCY_IP", "INPATIENT"),
        ("INPATIENT", "SNF", "SNF_IP", "INPATIENT"),
        ("INPATIENT", "SNF", "EMERGENCY_IP", "INPATIENT"),
        ("INPATIENT", "HOSPICE", "HOSPICE_IP", "OTHER"),
        ("INPATIENT", "OTHER", "OTHER_IP", "OTHER"),
        ("INPATIENT", "OTHER", "EMERGENCY_IP", "ED"),
        ("OUTPATIENT", "EMERGENCY", "EMERGENCY_OP", "ED"),
        ("OUTPATIENT", "CLINIC", "CLINIC_OP", "OUTPATIENT"),
        ("OUTPATIENT", "LAB", "LAB_OP", "OUTPATIENT"),
        ("OUTPATIENT", "OUTPATIENT", "OUTPATIENT_OP", "OUTPATIENT"),
        ("OUTPATIENT", "ANCILLARY", "AMBULANCE_OP", "OTHER"),
        ("OUTPATIENT", "ANCILLARY", "DME_OP", "OTHER"),
        ("OUTPATIENT", "ANCILLARY", "HOME_HEALTH_OP", "OTHER"),
        ("OUTPATIENT", "UNCLASSIFIED", "UNCLASSIFIED", "OTHER"),
        ("NIPS", "VISIT", "OFFICE_VISIT", "OUTPATIENT"),
        ("NIPS", "VISIT", "HOSPITAL_OUTPATIENT_VISIT", "OUTPATIENT"),
        ("NIPS", "VISIT", "OTHER_OUTPATIENT_VISIT", "OUTPATIENT"),
        ("NIPS", "VISIT", "PREVENTIVE_VISIT", "OUTPATIENT"),
        ("NIPS", "DRUG", "DRUG_PROF", "Pharmacy"),
        ("NIPS", "OTHER", "OTHER_PROF", "OTHER"),
    ),
)

_DX_SCHEMA = "Group_Name string, Dx_Code string, Incl_Excl string"


def _dx(groups: dict[str, tuple[list[int], list[int]]]) -> Fixed:
    rows = []
    for name, (included, excluded) in groups.items():
        rows += [(name, f"D{n}", "I") for n in included] + [(name, f"D{n}", "E") for n in excluded]
    return Fixed(_DX_SCHEMA, tuple(rows))


BINDINGS["in_dx_primary"] = _dx(
    {
        "SCD": ([1, 2, 3], [4]),
        "Prematurity": ([5, 6], [7, 8]),
        "Epilepsy": ([9], [10, 11]),
        "Brain_Injury": ([12], [13]),
        "Diabetes": ([14, 15], [16]),
        "Asthma": ([17, 18], [19, 20]),
    }
)
BINDINGS["in_dx_pregnancy"] = _dx(
    {"Antenatal_care": ([21], [22]), "Delivery": ([23], [24, 25]), "Abortive": ([2], [3])}
)
BINDINGS["in_dx_mental_health"] = _dx(
    {"Anxiety": ([1], []), "Depression": ([4, 5], [6]), "Bipolar": ([7], [8]), "Psychosis": ([9, 10], [11])}
)
# The diagnosis-to-condition map is not public; these rows stand in for it.
BINDINGS["in_cdps_map"] = Fixed(
    "ICD string, Code string",
    tuple(
        (f"D{n}", code)
        for n, code in enumerate(
            "CARVH CARM CARL PSYH PSYM PSYL PULH PULL CNSM CNSL DIA1H DIA2L GIM GIL SKCL RENL EYEL CERL HEML INFL CANL "
            "METM".split(),
            1,
        )
    ),
)

_ENTRY = "date '1995-01-01' + cast((c_custkey * 7) % 2400 AS int)"


def _pick(expr: str, *values: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _age_band(expr: str) -> str:
    return f"CASE WHEN {expr} < 2 THEN '0-1' WHEN {expr} < 6 THEN '2-5' WHEN {expr} < 13 THEN '6-12' ELSE '13+' END"


def _flag(segment: str, also: str = "false") -> str:
    return f"CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment = '{segment}' OR {also} THEN 1 ELSE 0 END"


BINDINGS["in_patient"] = f"""
SELECT lpad(cast(c_custkey AS string), 9, '0') AS RecipientID, {RELEASE} AS ReleaseNum, c_custkey AS PatientID,
  concat('M', cast(c_custkey AS string)) AS MRN,
  {_ENTRY} AS Program_Date,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {_ENTRY} - 30 END AS Initial_Enrollment_Date,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {_ENTRY} + 60 END AS Engagement_Date,
  {_ENTRY} - cast((c_custkey % 30) * 365 AS int) AS DOB,
  cast(c_custkey % 31 AS int) AS Age,
  cast(c_custkey % 30 AS int) AS Enrollment_Age, cast((c_custkey + 1) % 30 AS int) AS Engagement_Age,
  {_age_band('c_custkey % 30')} AS Enrollment_Age_Category, {_age_band('(c_custkey + 1) % 30')} AS Engagement_Age_Category,
  {_age_band('c_custkey % 31')} AS Age_Category,
  CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
  {_pick('c_custkey % 3', 'Low', 'Medium', 'High')} AS Enrollment_Risk,
  {_pick('(c_custkey + 1) % 3', 'Low', 'Medium', 'High')} AS Engagement_Risk,
  {_pick('(c_custkey + 2) % 3', 'Low', 'Medium', 'High')} AS Current_Risk,
  {_flag('AUTOMOBILE', "(c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0)")} AS E2,
  {_flag('BUILDING')} AS E4, {_flag('FURNITURE')} AS HC, {_flag('HOUSEHOLD')} AS HE2, {_flag('MACHINERY')} AS HE4,
  cast(c_custkey % 2 AS int) AS Asthma, CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS Diabetes,
  CASE WHEN c_custkey % 7 = 1 THEN 1 ELSE 0 END AS SCD, CASE WHEN c_custkey % 5 = 2 THEN 1 ELSE 0 END AS Prematurity,
  CASE WHEN c_custkey % 11 = 3 THEN 1 ELSE 0 END AS Epilepsy, CASE WHEN c_custkey % 13 = 4 THEN 1 ELSE 0 END AS Brain_Injury,
  {_pick('c_custkey % 7', 'NA', 'SCD', 'Prematurity', 'Neurological', 'Diabetes', 'Asthma', 'Other')} AS Diagnosis_Category,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 1 AND c_custkey % 9 < 4 THEN 1 ELSE 0 END AS Preg_Flag
FROM {{customer}}
"""

# One release per order year; the last one is dated 2001-08-01.
BINDINGS["in_release"] = """
SELECT cast(2000 + year(o_orderdate) - 1994 AS int) AS ReleaseNum,
  substring(cast(2000 + year(o_orderdate) - 1994 AS string), 3) AS Cumulative_ReleaseNum,
  max(cast(o_orderdate AS date)) AS HFS_Release_Date, max(cast(o_orderdate AS date)) + 10 AS Load_Date
FROM {orders} GROUP BY year(o_orderdate)
"""

# Raw claims as loaded, each under the release of its service year.
BINDINGS["in_raw_claims"] = """
SELECT DCN, ServiceLineNbr, RecipientID, ServiceFromDt, 'HFS' AS DataSource,
  cast(2000 + year(ServiceFromDt) - 1994 AS int) AS ReleaseNum, cast(year(ServiceFromDt) - 1994 AS int) AS CumReleaseNum
FROM {in_line}
"""
BINDINGS["in_raw_diagnosis"] = """
SELECT DCN, DiagCd, 'HFS' AS DataSource, cast(2000 + year(AdjudicatedDt) - 1994 AS int) AS ReleaseNum,
  cast(year(AdjudicatedDt) - 1994 AS int) AS CumReleaseNum
FROM {in_diagnosis}
"""

BINDINGS["in_population"] = """
SELECT RecipientID, E4, E2, HE4, HE2, HC, Program_Date, cast(2005 + PatientID % 3 AS int) AS ReleaseNum FROM {in_patient}
"""

BINDINGS["in_code_descriptions"] = """
SELECT 'CatgofServiceCd' AS DomainName, lpad(cast(n_nationkey AS string), 3, '0') AS CodeValue, n_name AS CodeDescription
FROM {nation}
UNION ALL
SELECT 'Region' AS DomainName, lpad(cast(r_regionkey AS string), 3, '0') AS CodeValue, r_name AS CodeDescription FROM {region}
"""

# Enrolment, status and demographics.
BINDINGS["in_enrollment"] = """
SELECT RecipientID, PatientID, concat('First', cast(PatientID AS string)) AS First_Name,
  concat('Last', cast(PatientID % 97 AS string)) AS Last_Name, Gender, DOB,
  CASE PatientID % 4 WHEN 0 THEN 'Blue Cross Blue Shield' WHEN 1 THEN 'Plan B' ELSE 'Plan C' END AS MCO_Name,
  Engagement_Date, Initial_Enrollment_Date, Program_Date AS First_Enrollment_Date,
  CASE WHEN PatientID % 6 = 0 THEN NULL ELSE Program_Date + 400 END AS DisEnrollment_Date
FROM {in_patient}
"""
BINDINGS["in_status"] = """
SELECT RecipientID, CASE WHEN PatientID % 4 = 3 THEN 'Inactive' ELSE 'Active' END AS Current_Enrollment_Status,
  CASE WHEN PatientID % 3 = 0 THEN 'Enrolled' ELSE 'Engaged' END AS "Group"
FROM {in_patient} WHERE PatientID % 19 <> 5
""".replace('"Group"', "Group_")
BINDINGS["in_grouping"] = """
SELECT RecipientID, E2, E4, HE2, HE4, Program_Date FROM {in_patient} WHERE PatientID % 23 <> 1
"""
BINDINGS["in_consensus_risk"] = """
SELECT PatientID, Current_Risk AS Consensus_Risk FROM {in_patient} WHERE PatientID % 29 <> 2
"""
BINDINGS["in_care_team"] = """
SELECT PatientID, concat('worker', cast(PatientID % 12 AS string)) AS AssignedTo FROM {in_patient} WHERE PatientID % 4 <> 1
"""
BINDINGS["in_careplan"] = """
SELECT PatientID, Program_Date + 90 AS StartDate FROM {in_patient} WHERE PatientID % 3 = 1
"""
BINDINGS["in_worker_mapping"] = """
SELECT PatientID, concat('net', cast(PatientID % 14 AS string)) AS NetID, 'x' AS Note FROM {in_patient} WHERE PatientID % 5 <> 0
"""
BINDINGS["in_workers"] = """
SELECT concat('net', cast(s_suppkey AS string)) AS NetID, s_name AS ConsensusUsername,
  concat('W', cast(s_suppkey AS string)) AS FirstName FROM {supplier}
"""
BINDINGS["in_patient_ids"] = """
SELECT c_custkey AS ID, lpad(cast(c_custkey AS string), 9, '0') AS MedicaidNum FROM {customer} WHERE c_custkey % 31 <> 7
"""

# Contacts: one event each; the other outcome texts follow the event type.
BINDINGS["in_contacts"] = """
SELECT user_id AS PatientID, ts AS ContactTS,
  CASE event_id % 5 WHEN 0 THEN 'Phone - Outbound' WHEN 1 THEN 'Visit' WHEN 2 THEN 'Home' WHEN 3 THEN 'Phone - Inbound' ELSE 'Email' END
    AS ContactTypeGBLcode,
  CASE event_id % 4 WHEN 0 THEN 'Caregiver' WHEN 1 THEN 'Patient' WHEN 2 THEN 'Home' ELSE 'Provider' END AS ContactPartyGBLCode,
  CASE event_id % 9 WHEN 0 THEN 'tier-1 assessment' WHEN 1 THEN 'ED/hospitalization  follow-up' WHEN 2 THEN 'Care Coordination Consult with PCP'
    WHEN 3 THEN 'dental concern' WHEN 4 THEN 'Birthday' WHEN 5 THEN 'Change of PCP or Specialist' WHEN 6 THEN 'transportation'
    WHEN 7 THEN 'medication /prescription concerns' ELSE 'something else' END AS ContactReasonGBLCode,
  concat('chs', cast(event_id % 6 AS string)) AS ContactCHSName,
  CASE WHEN event_id % 37 = 0 THEN 'Other text' WHEN event_type = 'signup' THEN 'Successful'
    WHEN event_type = 'error' THEN 'Wrong Number or Number Disconnected/Out of Service' WHEN event_type = 'click' THEN 'Left Message'
    WHEN event_type = 'purchase' THEN 'Face to face visit successful'
    WHEN event_id % 2 = 0 THEN 'Face to face visit not successful' ELSE 'Unable to reach' END AS OutcomeStatusGBLCode,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE ts END AS OutcomeDateTime,
  concat(' User', cast(event_id % 3 AS string), ' ') AS CUserID
FROM {events}
"""
BINDINGS["in_phones"] = """
SELECT user_id AS PatientID, event_type AS Description, lpad(cast(user_id % 1000 AS string), 3, '0') AS PhoneNumberAC,
  lpad(cast(event_id % 1000 AS string), 3, '0') AS PhoneNumberPrefix, lpad(cast(event_id % 10000 AS string), 4, '0') AS PhoneNumberLineNumber,
  cast(event_id % 2 AS int) AS PrimaryFlag, cast(ts AS date) AS StartDate,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(ts AS date) + 30 END AS EndDate, ts AS CTS, ts AS MTS
FROM {events}
"""

# Attendance: four school years of days spread over the events.
BINDINGS["in_attendance"] = """
SELECT user_id AS Student_ID, date '2014-09-02' + cast(event_id % 1385 AS int) AS Date_,
  CASE event_id % 19 WHEN 0 THEN 'PE' WHEN 1 THEN 'PK' WHEN 2 THEN 'K' WHEN 15 THEN '20' WHEN 16 THEN '--' WHEN 17 THEN NULL
    WHEN 18 THEN 'UG' ELSE cast(event_id % 19 - 2 AS string) END AS Student_Annual_Grade_Code,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS Present,
  CASE WHEN event_type = 'error' AND event_id % 7 <> 0 THEN 1 ELSE 0 END AS Absent
FROM {events}
"""

# Registry rows by customer; identifiers appear as plain integers.
BINDINGS["in_registry"] = """
SELECT lpad(cast(c_custkey AS string), 9, '0') AS RIN, CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE cast(c_custkey % 2 AS int) END AS asthma,
  CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS diabetes, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS scd,
  CASE WHEN c_custkey % 8 = 3 THEN 1 ELSE 0 END AS prematurity, CASE WHEN c_custkey % 12 = 6 THEN 1 ELSE 0 END AS newborn,
  CASE WHEN c_custkey % 10 = 4 THEN 1 ELSE 0 END AS epilepsy,
  CASE c_custkey % 6 WHEN 0 THEN 'heart  murmur' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE '' END AS other_diag,
  concat('fn', cast(c_custkey AS string)) AS fn, concat('ln', cast(c_custkey AS string)) AS ln,
  date '1995-01-01' + cast((c_custkey * 13) % 2000 AS int) AS dob, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 3 = 0 THEN concat('60', lpad(cast(c_custkey % 1000 AS string), 3, '0'), '-1234') ELSE concat('6', lpad(cast(c_custkey % 1000 AS string), 3, '0')) END AS zip_code,
  cast(c_custkey % 24 AS int) AS age
FROM {customer}
"""
BINDINGS["in_participants"] = """
SELECT cast(c_custkey AS string) AS PARTICIPANT_SYSTEM_ID FROM {customer} WHERE c_custkey % 4 = 1
"""

# Questionnaires.
_ASSESSMENT_NAMES = sorted({name for _, _, name in ASSESSMENTS})
_NAME_ID = {name: i for i, name in enumerate(_ASSESSMENT_NAMES)}
_TEXTS = sorted({q for scales in QUESTIONS.values() for qs in scales.values() for q in qs})
_TEXT_ID = {text: i for i, text in enumerate(_TEXTS)}
_YES_NO = {q for i in ("MHSParent", "MHSPatient") for q in QUESTIONS[i]["Total"]}
_ASKED = sorted(
    {
        (_NAME_ID[name], _TEXT_ID[q])
        for instrument, _, name in ASSESSMENTS
        for qs in QUESTIONS[instrument].values()
        for q in qs
    }
)
BINDINGS["in_client_assessment"] = Fixed("ID int, AssessmentName string", tuple((i, n) for n, i in _NAME_ID.items()))
BINDINGS["in_questionnaire"] = Fixed("ID int, QuestionnaireName string", tuple((100 + i, n) for n, i in _NAME_ID.items()))
BINDINGS["in_questionnaire_question"] = Fixed(
    "QuestionnaireID int, QuestionID int", tuple((100 + a, q) for a, q in _ASKED)
)
BINDINGS["in_question"] = Fixed(
    "ID int, QuestionText string, OptionsGlobalCodeName string, YesNoItem int",
    tuple(
        (i, t, "Other List" if i % 9 == 0 else f"Question Scale {i % 2}", 1 if t in _YES_NO else 0)
        for t, i in _TEXT_ID.items()
    ),
)
BINDINGS["in_code"] = Fixed("CodeName string", (("Question Scale 0",), ("Question Scale 1",), ("Other List",)))
BINDINGS["in_code_value"] = Fixed(
    "CodeName string, Description string, IntegerValue int",
    tuple(
        (name, f"{word} ({name[-1]})", i)
        for name in ("Question Scale 0", "Question Scale 1", "Other List")
        for i, word in enumerate(["Never", "Rarely", "Sometimes", "Often", "Always"])
    ),
)
# Sign-up and purchase events open an assessment for twenty days, the others are sittings
# answering nearly all questions of one questionnaire.
_PICK = f"cast((event_id * 7 + user_id) % {len(_ASSESSMENT_NAMES)} AS int)"
BINDINGS["in_assessment"] = f"""
SELECT user_id AS PatientID, {_PICK} AS ClientAssessmentID, cast(ts AS date) AS StartDate, ts + interval '20' day AS EndDate,
  CASE event_id % 7 WHEN 0 THEN 'Voided' WHEN 1 THEN 'New' WHEN 2 THEN 'In Process' ELSE 'Completed' END AS StatusCode, ts AS CTS
FROM {{events}} WHERE event_type IN ('signup', 'purchase')
"""
BINDINGS["in_response"] = f"""
SELECT q.QuestionID, e.user_id AS MedRecPatientID, e.ts AS ResponseDate,
  CASE WHEN t.YesNoItem = 1 THEN cast((e.event_id + q.QuestionID) % 2 AS int) END AS YesNo,
  CASE WHEN (e.event_id + q.QuestionID) % 53 = 0 THEN NULL ELSE cast((e.event_id + q.QuestionID * 3) % 5 + CASE WHEN t.YesNoItem = 1 THEN 0 ELSE 1 END AS int) END AS "Range",
  CASE WHEN q.QuestionID % 5 = 0 THEN 'note' END AS "Text", concat(' User', cast(e.event_id % 3 AS string)) AS CUserID
FROM (SELECT *, 100 + {_PICK} AS sheet FROM {{events}} WHERE event_type NOT IN ('signup', 'purchase')) e
JOIN {{in_questionnaire_question}} q ON q.QuestionnaireID = e.sheet JOIN {{in_question}} t ON t.ID = q.QuestionID
WHERE (e.event_id * 31 + q.QuestionID * 17) % 101 <> 0
""".replace('"Range"', "Range").replace('"Text"', "Text")
