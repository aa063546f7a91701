"""Diagnosis classification, risk tiers, risk score and patient labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.operators import cdps, diagnosis as dx, keys, patients as pat, population as pop, risk
from carespan.queries.bindings import BINDINGS, RELEASE_DATE, Fixed
from carespan.queries.claims import categorized
from carespan.queries.registry import Inputs, fragment, register

AS_OF = date.fromisoformat(RELEASE_DATE)

fragment(
    "ref_counts",
    "SELECT RecipientID, DiagCd, count(*) AS ICD_Count FROM in_diagnosis GROUP BY RecipientID, DiagCd",
)
fragment(
    "ref_icd",
    """
SELECT p.*, coalesce((SELECT string_agg(DISTINCT d.DiagCd, ',' ORDER BY d.DiagCd) FROM in_diagnosis d WHERE d.RecipientID = p.RecipientID), '0') AS ICD_List
FROM in_patient p
""",
)


def _qualified(table: str) -> str:
    return f"""
SELECT RecipientID, Group_Name, sum(CASE WHEN Incl_Excl = 'I' THEN ICD_Count ELSE 0 END) AS Included,
  sum(CASE WHEN Incl_Excl = 'E' THEN ICD_Count ELSE 0 END) AS Excluded
FROM ref_counts JOIN {table} ON Dx_Code = DiagCd GROUP BY RecipientID, Group_Name
HAVING Included >= 1 AND Included * 1.0 / (Included + Excluded) >= CASE WHEN Group_Name = 'SCD' THEN 0.75 ELSE 1 END
"""


for _name in ("primary", "pregnancy", "mental_health"):
    fragment(f"ref_qualified_{_name}", _qualified(f"in_dx_{_name}"))


def _flag(table: str, group: str) -> str:
    return (
        f"CASE WHEN EXISTS (SELECT 1 FROM ref_qualified_{table} q WHERE q.RecipientID = p.RecipientID "
        f"AND q.Group_Name = '{group}') THEN 1 ELSE 0 END AS {group}"
    )


def _flags(table: str, groups: list[str]) -> str:
    return ", ".join(_flag(table, g) for g in groups)


MENTAL_HEALTH_GROUPS = ["Anxiety", "Depression", "Bipolar", "Psychosis"]


def base_patients(t: Inputs) -> DataFrame:
    return t.in_patient.select("RecipientID", "Enrollment_Age", "Gender")


def counts(t: Inputs) -> DataFrame:
    return dx.dx_code_counts(t.in_diagnosis)


@register("dx_code_counts", "RecipientID DiagCd ICD_Count:i", "SELECT * FROM ref_counts")
def _dx_code_counts(t: Inputs) -> DataFrame:
    return counts(t)


@register("icd_list", "RecipientID ICD_List", "SELECT * FROM ref_icd")
def _icd_list(t: Inputs) -> DataFrame:
    return dx.icd_list(base_patients(t), counts(t))


@register(
    "patient_dx_left",
    "RecipientID Enrollment_Age:i Gender Codes:i ICD_List",
    """
    SELECT p.RecipientID, p.Enrollment_Age, p.Gender, count(DISTINCT d.DiagCd) AS Codes, any_value(p.ICD_List) AS ICD_List
    FROM ref_icd p LEFT JOIN in_diagnosis d ON d.RecipientID = p.RecipientID GROUP BY ALL
    """,
)
def _patient_dx_left(t: Inputs) -> DataFrame:
    return dx.icd_list(base_patients(t), counts(t)).withColumn("Codes", F.size("ICD_Codes"))


@register(
    "code_table_inner",
    "RecipientID DiagCd ICD_Count:i Group_Name Incl_Excl",
    "SELECT * FROM ref_counts JOIN in_dx_primary ON DiagCd = Dx_Code",
)
def _code_table_inner(t: Inputs) -> DataFrame:
    return dx.code_table_inner(counts(t), t.in_dx_primary)


@register(
    "dx_inclusion_exclusion",
    "RecipientID Group_Name Included:i Excluded:i",
    "SELECT * FROM ref_qualified_primary",
)
def _dx_inclusion_exclusion(t: Inputs) -> DataFrame:
    return dx.dx_inclusion_exclusion(counts(t), t.in_dx_primary)


_LISTED = dx.PRIMARY_GROUPS[:-1]


@register(
    "dx_flags",
    "RecipientID " + " ".join(f"{g}:i" for g in _LISTED) + " Unlisted_Groups",
    f"""
    SELECT p.RecipientID, {_flags('primary', _LISTED)}, coalesce((SELECT string_agg(Group_Name, ',' ORDER BY Group_Name)
      FROM ref_qualified_primary q WHERE q.RecipientID = p.RecipientID AND Group_Name NOT IN ({', '.join(f"'{g}'" for g in _LISTED)})), '') AS Unlisted_Groups
    FROM in_patient p
    """,
)
def _dx_flags(t: Inputs) -> DataFrame:
    """The last primary group is left off the list, so that it shows as an unlisted one."""
    return dx.dx_flags(base_patients(t), counts(t), t.in_dx_primary, _LISTED)


@register(
    "dx_mental_health",
    "RecipientID " + " ".join(f"{g}:i" for g in MENTAL_HEALTH_GROUPS),
    f"SELECT p.RecipientID, {_flags('mental_health', MENTAL_HEALTH_GROUPS)} FROM in_patient p",
)
def _dx_mental_health(t: Inputs) -> DataFrame:
    return dx.dx_flags(base_patients(t), counts(t), t.in_dx_mental_health, MENTAL_HEALTH_GROUPS)


@register(
    "dx_pregnancy",
    "RecipientID " + " ".join(f"{g}:i" for g in dx.PREGNANCY_GROUPS) + " Preg_Flag:i",
    f"""
    SELECT *, CASE WHEN Antenatal_care + Delivery + Abortive = 0 THEN 0 WHEN Enrollment_Age > 10 AND Gender = 'Female' THEN 1 END AS Preg_Flag
    FROM (SELECT p.RecipientID, p.Enrollment_Age, p.Gender, {_flags('pregnancy', dx.PREGNANCY_GROUPS)} FROM in_patient p)
    """,
)
def _dx_pregnancy(t: Inputs) -> DataFrame:
    return dx.dx_pregnancy(base_patients(t), counts(t), t.in_dx_pregnancy)


fragment(
    "ref_primary",
    f"""
SELECT * EXCLUDE (Prematurity0), CASE WHEN ICD_List = '0' THEN 'NA' WHEN SCD = 1 THEN 'SCD' WHEN Prematurity > 0 THEN 'Prematurity'
    WHEN Epilepsy > 0 THEN 'Neurological' WHEN Brain_Injury > 0 THEN 'Neurological' WHEN Diabetes > 0 THEN 'Diabetes'
    WHEN Asthma > 0 THEN 'Asthma' ELSE 'Other' END AS Diagnosis_Category
FROM (SELECT *, CASE WHEN Enrollment_Age > 3 THEN 0 ELSE Prematurity0 END AS Prematurity
      FROM (SELECT p.RecipientID, p.Enrollment_Age, p.ICD_List,
              {_flags('primary', dx.PRIMARY_GROUPS).replace('AS Prematurity', 'AS Prematurity0')} FROM ref_icd p))
""",
)


@register(
    "dx_primary",
    "RecipientID ICD_List " + " ".join(f"{g}:i" for g in dx.PRIMARY_GROUPS) + " Diagnosis_Category",
    "SELECT * FROM ref_primary",
)
def _dx_primary(t: Inputs) -> DataFrame:
    return dx.dx_primary(base_patients(t), counts(t), t.in_dx_primary)


# Risk tiers.

fragment(
    "ref_ed_ip_lines",
    """
SELECT RecipientID, ServiceFromDt, CASE WHEN Category3 = 'EMERGENCY_OP' THEN 1 ELSE 0 END AS ED,
  CASE WHEN Category3 = 'EMERGENCY_OP' THEN 0 ELSE 1 END AS IP
FROM ref_categorized WHERE RejectionStatusCd = 'N' AND Category3 IN ('INPATIENT_IP', 'EMERGENCY_IP', 'EMERGENCY_OP')
""",
)


def _tier(ed: str, ip: str, low: str = "'Low'", medium: str = "'Medium'", high: str = "'High'") -> str:
    return (
        f"CASE WHEN {ed} = 0 AND {ip} = 0 THEN {low} WHEN ({ed} >= 1 AND {ed} <= 3) OR {ip} = 1 THEN {medium} "
        f"WHEN {ed} > 3 OR {ip} > 1 THEN {high} END"
    )


def _sums(at: str) -> str:
    return f"""
SELECT p.RecipientID, coalesce(sum(e.ED), 0) AS ED, coalesce(sum(e.IP), 0) AS IP
FROM in_patient p LEFT JOIN ref_ed_ip_lines e ON e.RecipientID = p.RecipientID
  AND e.ServiceFromDt <= {at} AND e.ServiceFromDt >= CAST({at} - INTERVAL 12 MONTH AS DATE)
WHERE {at} IS NOT NULL GROUP BY p.RecipientID
"""


_ENROLLED = "coalesce(p.Initial_Enrollment_Date, p.Program_Date)"
_NOW = f"DATE '{RELEASE_DATE}'"
fragment("ref_sums_enrollment", _sums(_ENROLLED))
fragment("ref_sums_current", _sums(_NOW))
fragment("ref_sums_engagement", _sums("p.Engagement_Date"))


def daily(t: Inputs) -> DataFrame:
    return risk.ip_ed_daily(categorized(t))


@register(
    "ip_ed_daily",
    "RecipientID ServiceFromDt:d IP:i ED:i",
    "SELECT RecipientID, ServiceFromDt, sum(IP) AS IP, sum(ED) AS ED FROM ref_ed_ip_lines GROUP BY ALL",
)
def _ip_ed_daily(t: Inputs) -> DataFrame:
    return daily(t)


@register(
    "lookback_12",
    "RecipientID Program_Date:d Low_Window_Date:d",
    "SELECT *, CAST(Program_Date - INTERVAL 12 MONTH AS DATE) AS Low_Window_Date FROM in_patient",
)
def _lookback(t: Inputs) -> DataFrame:
    return risk.lookback_12(t.in_patient, "Program_Date")


@register("window_sums", "RecipientID ED:i IP:i", "SELECT * FROM ref_sums_current")
def _window_sums(t: Inputs) -> DataFrame:
    dated = t.in_patient.withColumn("Current_Date", F.lit(AS_OF))
    return risk.window_sums(dated, daily(t), "Current_Date")


@register(
    "risk_tier",
    "RecipientID ED:i IP:i Tier",
    f"""
    SELECT *, {_tier('ED', 'IP')} AS Tier FROM (
      SELECT RecipientID, count(*) FILTER (RecordIDCd = 'O') AS ED, count(*) FILTER (RecordIDCd = 'I') AS IP
      FROM in_claims WHERE RejectionStatusCd = 'N' AND ServiceFromDt >= DATE '2001-01-01' GROUP BY RecipientID)
    """,
)
def _risk_tier(t: Inputs) -> DataFrame:
    recent = keys.accepted_only(t.in_claims).where(F.col("ServiceFromDt") >= F.lit(date(2001, 1, 1)))
    sums = recent.groupBy("RecipientID").agg(
        F.count_if(F.col("RecordIDCd") == "O").alias("ED"), F.count_if(F.col("RecordIDCd") == "I").alias("IP")
    )
    return sums.withColumn("Tier", risk.risk_tier(F.col("ED"), F.col("IP")))


@register(
    "risk_enrollment",
    "RecipientID ED:i IP:i Enrollment_Risk",
    f"SELECT *, {_tier('ED', 'IP')} AS Enrollment_Risk FROM ref_sums_enrollment",
)
def _risk_enrollment(t: Inputs) -> DataFrame:
    return risk.risk_enrollment(t.in_patient, daily(t))


@register(
    "risk_current",
    "Current_Risk Patients:i",
    f"SELECT {_tier('ED', 'IP')} AS Current_Risk, count(*) AS Patients FROM ref_sums_current GROUP BY 1",
)
def _risk_current(t: Inputs) -> DataFrame:
    tiers = risk.risk_current(t.in_patient, daily(t), AS_OF)
    return tiers.groupBy("Current_Risk").agg(F.count(F.lit(1)).alias("Patients"))


@register(
    "risk_engagement",
    "RecipientID ED:i IP:i Engagement_Risk",
    f"SELECT *, {_tier('ED', 'IP')} AS Engagement_Risk FROM ref_sums_engagement",
)
def _risk_engagement(t: Inputs) -> DataFrame:
    return risk.risk_engagement(t.in_patient, daily(t))


_WEIGHTS = dict(line.replace("'", "").split("=") for line in cdps.WEIGHT_LINES)
BINDINGS["in_cdps_codes"] = Fixed(
    "Group_ int, Severity int, Code string, Weight double",
    tuple((g, s, c, float(_WEIGHTS[c])) for g, line in enumerate(cdps.GROUP_LINES) for s, c in enumerate(line.split())),
)
fragment(
    "ref_cdps",
    """
SELECT p.RecipientID, p.Gender, p.Age, CAST(coalesce(sum(w.Weight), 0) AS DOUBLE) AS UCSD_Risk_Raw
FROM in_patient p LEFT JOIN (
  SELECT RecipientID, Group_, CAST(arg_min(Weight, Severity) AS DECIMAL(9,3)) AS Weight
  FROM (SELECT DISTINCT RecipientID, DiagCd FROM in_diagnosis) d JOIN in_cdps_map m ON m.ICD = d.DiagCd JOIN in_cdps_codes c ON c.Code = m.Code
  GROUP BY RecipientID, Group_) w ON w.RecipientID = p.RecipientID
GROUP BY p.RecipientID, p.Gender, p.Age
""",
)
_AGE_SEX = """
CASE WHEN Age <= 1 THEN 0.398 WHEN Age < 5 THEN -0.068
  WHEN Age < 15 THEN CASE Gender WHEN 'Male' THEN -0.06 WHEN 'Female' THEN -0.105 END
  WHEN Age < 25 THEN CASE Gender WHEN 'Male' THEN -0.026 WHEN 'Female' THEN 0.051 END
  ELSE CASE Gender WHEN 'Male' THEN -0.068 WHEN 'Female' THEN 0.041 END END + 0.226
"""


def scored(t: Inputs) -> DataFrame:
    return cdps.cdps_score(t.in_patient.select("RecipientID", "Gender", "Age"), counts(t), t.in_cdps_map)


@register("cdps_score", "RecipientID UCSD_Risk_Raw:f3", "SELECT * FROM ref_cdps")
def _cdps_score(t: Inputs) -> DataFrame:
    return scored(t)


@register(
    "cdps_demographic_adjust",
    "RecipientID Age:i Gender UCSD_Risk_Raw:f3 UCSD_Risk:f3",
    f"SELECT *, UCSD_Risk_Raw + {_AGE_SEX} AS UCSD_Risk FROM ref_cdps",
)
def _cdps_adjust(t: Inputs) -> DataFrame:
    return cdps.cdps_demographic_adjust(scored(t))


@register(
    "risk_assembly",
    "RecipientID Enrollment_Risk Engagement_Risk Current_Risk UCSD_Risk_Raw:f3 UCSD_Risk:f3",
    f"""
    SELECT p.RecipientID, {_tier('a.ED', 'a.IP')} AS Enrollment_Risk, {_tier('g.ED', 'g.IP')} AS Engagement_Risk,
      {_tier('c.ED', 'c.IP')} AS Current_Risk, s.UCSD_Risk_Raw, s.UCSD_Risk
    FROM in_patient p LEFT JOIN ref_sums_enrollment a USING (RecipientID) LEFT JOIN ref_sums_engagement g USING (RecipientID)
    LEFT JOIN ref_sums_current c USING (RecipientID)
    LEFT JOIN (SELECT *, UCSD_Risk_Raw + {_AGE_SEX} AS UCSD_Risk FROM ref_cdps) s USING (RecipientID)
    """,
)
def _risk_assembly(t: Inputs) -> DataFrame:
    adjusted = cdps.cdps_demographic_adjust(scored(t)).drop("Age", "Gender")
    return risk.risk_assembly(t.in_patient, daily(t), AS_OF, adjusted)


_PER_RELEASE = f"""
SELECT e.RecipientID, r.ReleaseNum, {_tier('sum(ED)', 'sum(IP)', '2', '5', '7')} AS Tier
FROM ref_ed_ip_lines e JOIN in_release r ON e.ServiceFromDt <= r.HFS_Release_Date
  AND e.ServiceFromDt >= CAST(r.HFS_Release_Date - INTERVAL 12 MONTH AS DATE)
GROUP BY e.RecipientID, r.ReleaseNum
"""


@register(
    "risk_all_releases",
    "RecipientID ReleaseNum:i Tier:i Total:i Pattern",
    f"""
    WITH t AS ({_PER_RELEASE}), w AS (SELECT p.RecipientID, r.ReleaseNum, coalesce(t.Tier, 0) AS Tier
      FROM in_patient p CROSS JOIN in_release r LEFT JOIN t ON t.RecipientID = p.RecipientID AND t.ReleaseNum = r.ReleaseNum)
    SELECT RecipientID, ReleaseNum, Tier, sum(Tier) OVER (PARTITION BY RecipientID) AS Total,
      coalesce(string_agg(CAST(Tier AS VARCHAR), '') FILTER (ReleaseNum < (SELECT max(ReleaseNum) FROM in_release))
        OVER (PARTITION BY RecipientID ORDER BY ReleaseNum ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') AS Pattern FROM w
    """,
)
def _risk_all_releases(t: Inputs) -> DataFrame:
    return risk.risk_all_releases(t.in_patient, daily(t), t.in_release)


# Patient labels.

fragment(
    "ref_labelled",
    """
SELECT *, CASE WHEN HE4 = 1 THEN 'Harmony_Enrolled' WHEN HE2 = 1 THEN 'Harmony_Engaged' WHEN HC = 1 THEN 'Harmony_Control'
    WHEN E4 = 1 THEN 'Enrolled' WHEN E2 = 1 THEN 'Engaged' END AS Population_Type,
  CASE WHEN E2 IS NOT NULL AND E2 = 1 THEN Engagement_Age ELSE Enrollment_Age END AS Program_Age,
  CASE WHEN E2 IS NOT NULL AND E2 = 1 THEN Engagement_Age_Category ELSE Enrollment_Age_Category END AS Program_Age_Category,
  CASE WHEN E2 IS NOT NULL AND E2 = 1 THEN Engagement_Risk ELSE Enrollment_Risk END AS Program_Risk
FROM in_patient
""",
)


@register("population_type", "RecipientID Population_Type", "SELECT * FROM ref_labelled")
def _population_type(t: Inputs) -> DataFrame:
    return t.in_patient.withColumn("Population_Type", pat.population_type())


@register(
    "program_columns",
    "RecipientID Population_Type Program_Age:i Program_Age_Category Program_Risk",
    "SELECT * FROM ref_labelled",
)
def _program_columns(t: Inputs) -> DataFrame:
    return pat.program_columns(t.in_patient)


@register(
    "patient_group_latest",
    "RecipientID E4:i E2:i HE4:i HE2:i HC:i Program_Date:d",
    "SELECT * FROM in_population WHERE ReleaseNum = (SELECT max(ReleaseNum) FROM in_population)",
)
def _patient_group_latest(t: Inputs) -> DataFrame:
    return keys.of_latest_release(t.in_population)


@register(
    "latest_release_scalar",
    "ReleaseNum:i Cumulative_ReleaseNum HFS_Release_Date:d",
    "SELECT * FROM in_release ORDER BY ReleaseNum DESC LIMIT 1",
)
def _latest_release_scalar(t: Inputs) -> DataFrame:
    return keys.of_latest_release(t.in_release)


@register(
    "latest_release",
    "ReleaseNum:i EndReleaseDate:d",
    "SELECT max(ReleaseNum) AS ReleaseNum, max(HFS_Release_Date) AS EndReleaseDate FROM in_release",
)
def _latest_release(t: Inputs) -> DataFrame:
    return pop.latest_release(t.in_release.withColumnRenamed("HFS_Release_Date", "EndReleaseDate"))


# Population counts.

_LABELS = ["Current_Risk", "Diagnosis_Category", "Age_Category"]


def _single(population: str, where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{population}' AS Population, '{c}' AS Label_Type, {c} AS Label, count(*) AS Count FROM in_patient WHERE {where} GROUP BY {c}"
        for c in _LABELS
    )


def _crossed(names: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS {names[0]}, {a} AS {names[1]}, '{b}' AS {names[2]}, {b} AS {names[3]}, count(*) AS Count FROM in_patient GROUP BY {a}, {b}"
        for a, b in (
            ("Age_Category", "Diagnosis_Category"),
            ("Current_Risk", "Diagnosis_Category"),
            ("Current_Risk", "Age_Category"),
        )
    )


@register("label_counts", "Label_Type Label Count:i", _single("All", "true"))
def _label_counts(t: Inputs) -> DataFrame:
    return pop.label_counts(t.in_patient)


@register(
    "label_cross_counts",
    "First_Type First_Label Second_Type Second_Label Count:i",
    _crossed(("First_Type", "First_Label", "Second_Type", "Second_Label")),
)
def _label_cross_counts(t: Inputs) -> DataFrame:
    return pop.label_cross_counts(t.in_patient)


@register(
    "population_label_counts",
    "Population Label_Type Label Count:i",
    f"{_single('Engaged', 'E2 = 1')} UNION ALL {_single('Enrolled', 'E4 = 1')}",
)
def _population_label_counts(t: Inputs) -> DataFrame:
    return pop.population_label_counts(t.in_patient)


_COMMANDS = [
    (population, kind, value)
    for population in ("Engaged", "Enrolled")
    for kind, values in {
        "Diagnosis_Category": ("Asthma", "SCD", "Prematurity", "Neurological", "Diabetes", "Other", "NA"),
        "Current_Risk": ("LOW", "MEDIUM", "HIGH"),
        "Age_Category": ("0-1", "2-5", "6-12", "13+"),
    }.items()
    for value in values
]


@register(
    "population_label_value",
    "Population Label_Type Value Count:i",
    " UNION ALL ".join(
        f"SELECT '{p}' AS Population, '{k}' AS Label_Type, '{v}' AS Value, count(*) AS Count FROM in_patient "
        f"WHERE {'E2' if p == 'Engaged' else 'E4'} = 1 AND {k} ILIKE '{v}'"
        for p, k, v in _COMMANDS
    ),
)
def _population_label_value(t: Inputs) -> DataFrame:
    """Every command's answer from one counted table."""
    return pop.population_label_values(t.in_patient, _COMMANDS)


@register(
    "rpt_population_summary",
    "Population Label_Type Label Cross_Type Cross_Label Count:i",
    f"""
    SELECT Population, Label_Type, Label, NULL AS Cross_Type, NULL AS Cross_Label, Count FROM (
      {_single('All', 'true')} UNION ALL {_single('Engaged', 'E2 = 1')} UNION ALL {_single('Enrolled', 'E4 = 1')})
    UNION ALL SELECT 'All', * FROM ({_crossed(('Label_Type', 'Label', 'Cross_Type', 'Cross_Label'))})
    """,
)
def _rpt_population_summary(t: Inputs) -> DataFrame:
    return pop.rpt_population_summary(t.in_patient)
