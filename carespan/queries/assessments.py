"""Questionnaire responses, scores and totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.functions.instruments import ASSESSMENTS, LOWEST_RAW, QUESTIONS, T_SCORES, scale_sizes
from carespan.operators import assessments as asm
from carespan.operators.tabulate import paired_stats
from carespan.plans import reports
from carespan.queries.bindings import BINDINGS, Fixed
from carespan.queries.registry import Inputs, fragment, register

BINDINGS["in_assessment_names"] = Fixed("Instrument string, Sequence string, AssessmentName string", tuple(ASSESSMENTS))
BINDINGS["in_scales"] = Fixed(
    "Instrument string, Scale string, QuestionText string, Items int",
    tuple(
        (i, s, q, scale_sizes(i)[s]) for i, scales in QUESTIONS.items() for s, qs in scales.items() for q in qs
    ),
)
BINDINGS["in_t_scores"] = Fixed(
    "Scale string, Raw int, T double",
    tuple((s, LOWEST_RAW + i, t) for s, ts in T_SCORES.items() for i, t in enumerate(ts)),
)

fragment(
    "ref_joined",
    """
SELECT a.PatientID, p.MedicaidNum AS MedicaidID, c.AssessmentName, a.StartDate, a.EndDate, a.StatusCode, a.CTS, qq.QuestionID, q.QuestionText,
  r.ResponseDate, r.YesNo, r.Range, r.Text, r.CUserID
FROM in_assessment a JOIN in_client_assessment c ON a.ClientAssessmentID = c.ID JOIN in_patient_ids p ON a.PatientID = p.ID
JOIN in_questionnaire n ON c.AssessmentName = n.QuestionnaireName JOIN in_questionnaire_question qq ON n.ID = qq.QuestionnaireID
JOIN in_question q ON q.ID = qq.QuestionID JOIN in_response r ON r.QuestionID = qq.QuestionID AND r.MedRecPatientID = p.ID
WHERE a.StatusCode IN ('Completed', 'In Process', 'New') AND r.ResponseDate BETWEEN a.CTS AND a.EndDate
""",
)


def _newest(column: str, source: str | None = None) -> str:
    value = source or column
    return (
        f"(list({value} ORDER BY CTS DESC, ResponseDate DESC, {value} DESC) FILTER ({value} IS NOT NULL))[1] AS {column}"
    )


fragment(
    "ref_latest",
    f"""
SELECT PatientID, AssessmentName, QuestionText, {', '.join(_newest(c) for c in ('MedicaidID', 'StartDate', 'EndDate', 'StatusCode', 'YesNo', 'Text'))},
  {_newest('"Range"', 'coalesce(YesNo, "Range")')}, {_newest('CUserID')}
FROM ref_joined GROUP BY PatientID, AssessmentName, QuestionText
""",
)
fragment(
    "ref_answers",
    """
SELECT q.QuestionText, v.IntegerValue, v.Description AS Response FROM in_question q JOIN in_code c ON q.OptionsGlobalCodeName = c.CodeName
JOIN in_code_value v ON c.CodeName = v.CodeName WHERE c.CodeName LIKE 'Question %'
""",
)
fragment(
    "ref_responses",
    """
SELECT l.* REPLACE (trim(lower(l.CUserID)) AS CUserID), CASE WHEN l.YesNo = 0 THEN 'No' WHEN l.YesNo = 1 THEN 'Yes' ELSE a.Response END AS Response
FROM ref_latest l LEFT JOIN ref_answers a ON a.QuestionText = l.QuestionText AND a.IntegerValue = l."Range"
""",
)
fragment(
    "ref_scale_scores",
    """
SELECT r.PatientID, n.Instrument, n.Sequence, n.AssessmentName, s.Scale, count(r."Range") AS Answered,
  CASE WHEN n.Instrument <> 'PROMIS' OR count(r."Range") = any_value(s.Items) THEN sum(r."Range") END AS Score
FROM ref_responses r JOIN in_assessment_names n ON n.AssessmentName = trim(r.AssessmentName)
JOIN in_scales s ON s.Instrument = n.Instrument AND s.QuestionText = r.QuestionText
GROUP BY r.PatientID, n.Instrument, n.Sequence, n.AssessmentName, s.Scale HAVING count(r."Range") > 0
""",
)
_COUNTS = ", ".join(f"('{i}', {len(s)})" for i, s in QUESTIONS.items())
fragment(
    "ref_complete",
    f"""
SELECT s.* FROM ref_scale_scores s JOIN (
  SELECT PatientID, Instrument, Sequence FROM ref_scale_scores JOIN (VALUES {_COUNTS}) AS k(Instrument, n) USING (Instrument)
  GROUP BY PatientID, Instrument, Sequence HAVING count(*) = any_value(n)) USING (PatientID, Instrument, Sequence)
""",
)


def _score(scale: str) -> str:
    return f"max(Score) FILTER (Scale = '{scale}')"


def _wide(instrument: str) -> str:
    cells = ", ".join(f'{_score(s)} AS "{s}"' for s in QUESTIONS[instrument])
    return f"SELECT PatientID, Sequence, {cells} FROM ref_complete WHERE Instrument = '{instrument}' GROUP BY PatientID, Sequence"


def _total(instrument: str) -> str:
    return f"SELECT PatientID, Sequence, Score AS Total_Score FROM ref_complete WHERE Instrument = '{instrument}'"


def opened(t: Inputs) -> DataFrame:
    return asm.opened_questions(
        t.in_assessment, t.in_client_assessment, t.in_patient_ids, t.in_questionnaire, t.in_questionnaire_question, t.in_question
    )


def joined(t: Inputs) -> DataFrame:
    return asm.assessment_join(opened(t), t.in_response)


def responses(t: Inputs) -> DataFrame:
    answers = asm.answer_codes(t.in_question, t.in_code, t.in_code_value)
    return asm.assessment_responses(opened(t), t.in_response, answers)


@register(
    "assessment_join",
    "PatientID:i MedicaidID AssessmentName QuestionText ResponseDate:t CTS:t EndDate:t YesNo:i Range:i",
    "SELECT * FROM ref_joined",
)
def _assessment_join(t: Inputs) -> DataFrame:
    return joined(t)


_LATEST_OUT = "PatientID:i AssessmentName QuestionText MedicaidID StartDate:d EndDate:t StatusCode YesNo:i Range:i Text CUserID"


@register("latest_response", _LATEST_OUT, "SELECT * FROM ref_latest")
def _latest_response(t: Inputs) -> DataFrame:
    return asm.latest_response(joined(t).withColumn("Range", F.coalesce("YesNo", "Range")))


@register(
    "code_value_join",
    "PatientID:i AssessmentName QuestionText Range:i Response",
    """
    SELECT l.*, a.Response FROM ref_latest l LEFT JOIN ref_answers a ON a.QuestionText = l.QuestionText AND a.IntegerValue = l."Range"
    """,
)
def _code_value_join(t: Inputs) -> DataFrame:
    latest = asm.newest_responses(opened(t), t.in_response.withColumn("Range", F.coalesce("YesNo", "Range")))
    return asm.code_value_join(latest, asm.answer_codes(t.in_question, t.in_code, t.in_code_value))


@register("assessment_responses", f"{_LATEST_OUT} Response", "SELECT * FROM ref_responses")
def _assessment_responses(t: Inputs) -> DataFrame:
    return responses(t)


@register(
    "assessment_pivot",
    "PatientID:i Instrument Sequence Scale Answered:i Score:i",
    "SELECT * FROM ref_scale_scores",
)
def _assessment_pivot(t: Inputs) -> DataFrame:
    return asm.scale_scores(responses(t))


@register(
    "score_sum",
    "PatientID:i Sequence Anxiety:i Depression:i Emotional:i Informational:i Instrumental:i Social:i",
    _wide("PROMIS"),
)
def _score_sum(t: Inputs) -> DataFrame:
    return asm.score_sum(responses(t), "PROMIS")


@register("total_score", "PatientID:i Sequence Total_Score:i", _total("Edinburgh"))
def _total_score(t: Inputs) -> DataFrame:
    return asm.total_score(responses(t), "Edinburgh")


@register(
    "score_psc",
    "PatientID:i Sequence Attention_Problems:i Internalizing_Problems:i Externalizing_Problems:i Total_Score:i Attention_At_Risk:b "
    "Internalizing_At_Risk:b Externalizing_At_Risk:b Total_At_Risk:b",
    f"""
    SELECT PatientID, Sequence, a AS Attention_Problems, i AS Internalizing_Problems, e AS Externalizing_Problems, a + i + e AS Total_Score,
      a >= 7 AS Attention_At_Risk, i >= 5 AS Internalizing_At_Risk, e >= 7 AS Externalizing_At_Risk, a + i + e >= 15 AS Total_At_Risk
    FROM (SELECT PatientID, Sequence, "Attention Problems" AS a, "Internalizing Problems" AS i, "Externalizing Problems" AS e FROM ({_wide('PSC')}))
    """,
)
def _score_psc(t: Inputs) -> DataFrame:
    return asm.score_psc(responses(t))


@register(
    "score_promis",
    "PatientID:i Sequence " + " ".join(f"{s}_Score:i {s}_T_Score:f1" for s in T_SCORES),
    "SELECT PatientID, Sequence, "
    + ", ".join(
        f'"{s}" AS {s}_Score, (SELECT T FROM in_t_scores x WHERE x.Scale = \'{s}\' AND x.Raw = w."{s}") AS {s}_T_Score' for s in T_SCORES
    )
    + f" FROM ({_wide('PROMIS')}) w",
)
def _score_promis(t: Inputs) -> DataFrame:
    return asm.score_promis(responses(t))


_PHQ = (
    "CASE WHEN Total_Score <= 4 THEN 'No Signs of Depression' WHEN Total_Score <= 9 THEN 'Mild Depression' "
    "WHEN Total_Score <= 14 THEN 'Moderate Depression' WHEN Total_Score <= 19 THEN 'Moderately Severe Depression' "
    "WHEN Total_Score <= 27 THEN 'Severe Depression' END AS Result"
)
_SCORE_OUT = "PatientID:i Sequence Total_Score:i Result"


@register("score_phq9", _SCORE_OUT, f"SELECT *, {_PHQ} FROM ({_total('PHQ9')})")
def _score_phq9(t: Inputs) -> DataFrame:
    return asm.score_phq(responses(t), "PHQ9")


@register("score_phqa", _SCORE_OUT, f"SELECT *, {_PHQ} FROM ({_total('PHQA')})")
def _score_phqa(t: Inputs) -> DataFrame:
    return asm.score_phq(responses(t), "PHQA")


@register(
    "score_edinburgh",
    _SCORE_OUT,
    f"""
    SELECT *, CASE WHEN Total_Score <= 8 THEN 'Low probability of depression'
      WHEN Total_Score <= 12 THEN 'Most likely just dealing w/ a new baby or the baby blues.'
      WHEN Total_Score <= 14 THEN 'Signs leading to possibility of PPD; take preventative measures.'
      ELSE 'High probability of experiencing clinical depression.' END AS Result FROM ({_total('Edinburgh')})
    """,
)
def _score_edinburgh(t: Inputs) -> DataFrame:
    return asm.score_edinburgh(responses(t))


_ACT = """CASE WHEN Total_Score <= 19 THEN 'Pt''s asthma symptoms may not be in as much control as they should be '
  ELSE 'Pt appears to have well controlled asthma.' END"""


@register("score_act", _SCORE_OUT, f"SELECT *, {_ACT} AS Result FROM ({_total('ACT')})")
def _score_act(t: Inputs) -> DataFrame:
    return asm.score_act(responses(t))


@register("score_chaos", "PatientID:i Sequence Total_Score:i", f"SELECT * FROM ({_total('CHAOS')}) WHERE Total_Score <> 0")
def _score_chaos(t: Inputs) -> DataFrame:
    return asm.score_chaos(responses(t))


@register("score_mhs_parent", "PatientID:i Sequence Total_Score:i", _total("MHSParent"))
def _score_mhs_parent(t: Inputs) -> DataFrame:
    return asm.total_score(responses(t), "MHSParent")


@register("score_mhs_patient", "PatientID:i Sequence Total_Score:i", _total("MHSPatient"))
def _score_mhs_patient(t: Inputs) -> DataFrame:
    return asm.total_score(responses(t), "MHSPatient")


fragment(
    "ref_earliest",
    """
SELECT PatientID, AssessmentName, StartDate, CUserID FROM (
  SELECT *, row_number() OVER (PARTITION BY PatientID, AssessmentName ORDER BY StartDate, CUserID) AS rn FROM ref_responses) WHERE rn = 1
""",
)
fragment(
    "ref_auto",
    """
SELECT f.*, e.StartDate, e.CUserID FROM (
  SELECT c.PatientID, c.Instrument, c.Sequence, c.AssessmentName, c.Scale || ' T-Score' AS Score_Type, t.T AS Score
  FROM ref_complete c LEFT JOIN in_t_scores t ON t.Scale = c.Scale AND t.Raw = c.Score WHERE c.Instrument = 'PROMIS'
  UNION ALL
  SELECT PatientID, Instrument, Sequence, AssessmentName, 'Total Score', CAST(sum(Score) AS DOUBLE) FROM ref_complete
  WHERE Instrument <> 'PROMIS' GROUP BY ALL HAVING Instrument <> 'CHAOS' OR sum(Score) <> 0) f
JOIN ref_earliest e USING (PatientID, AssessmentName)
""",
)


@register("earliest_assessment", "PatientID:i AssessmentName StartDate:d CUserID", "SELECT * FROM ref_earliest")
def _earliest_assessment(t: Inputs) -> DataFrame:
    return asm.earliest_assessment(responses(t))


_AUTO_OUT = "PatientID:i Instrument Sequence AssessmentName Score_Type Score:f1 StartDate:d CUserID"


@register("auto_score", _AUTO_OUT, "SELECT * FROM ref_auto")
def _auto_score(t: Inputs) -> DataFrame:
    return asm.auto_score(responses(t))


@register(
    "totals_labels",
    "Instrument Sequence Score_Type Patients:i",
    """
    SELECT Instrument, upper(Sequence[1]) || lower(Sequence[2:]) AS Sequence, Score_Type, count(*) AS Patients FROM ref_auto GROUP BY ALL
    """,
)
def _totals_labels(t: Inputs) -> DataFrame:
    labelled = asm.totals_labels(asm.auto_score(responses(t)))
    return labelled.groupBy("Instrument", "Sequence", "Score_Type").agg(F.count(F.lit(1)).alias("Patients"))


def _total_cells() -> str:
    cells = []
    for instrument, kind, sequence, stem in asm.total_columns():
        here = f"Instrument = '{instrument}' AND Score_Type = '{kind}' AND lower(Sequence) = '{sequence.lower()}'"
        cells.append(f"max(Score) FILTER ({here}) AS {stem}_Score, max(StartDate) FILTER ({here}) AS {stem}_StartDate")
    return ", ".join(cells)


@register(
    "score_totals_pivot",
    "PatientID:i " + " ".join(f"{stem}_Score:f1 {stem}_StartDate:d" for _, _, _, stem in asm.total_columns()),
    f"SELECT PatientID, {_total_cells()} FROM ref_auto WHERE Instrument <> 'ACT' GROUP BY PatientID",
)
def _score_totals_pivot(t: Inputs) -> DataFrame:
    return asm.score_totals_pivot(asm.auto_score(responses(t)))


@register(
    "column_labels",
    "PatientID:i PHQ9_Sequence_6mo PHQ9_Total_Score_6mo:i PHQ9_Result_6mo",
    f"SELECT PatientID, Sequence AS PHQ9_Sequence_6mo, Total_Score AS PHQ9_Total_Score_6mo, Result AS PHQ9_Result_6mo FROM (SELECT *, {_PHQ} FROM ({_total('PHQ9')}))",
)
def _column_labels(t: Inputs) -> DataFrame:
    scored = asm.score_phq(responses(t), "PHQ9").withColumnRenamed("Result", "PHQ9_Result")
    return asm.column_labels(scored, "PHQ9", "6mo")


fragment(
    "ref_pairs",
    """
SELECT a.PatientID, a.Score AS First_, b.Score AS Second_ FROM ref_complete a JOIN ref_complete b USING (PatientID)
WHERE a.Instrument = 'PHQ9' AND a.Sequence = 'baseline' AND b.Instrument = 'PHQ9' AND b.Sequence = '6mo'
""",
)
_PAIRED_OUT = (
    "n:i First_Mean:f6 First_Std:f6 First_Sem:f6 Second_Mean:f6 Second_Std:f6 Second_Sem:f6 T_Statistic:f6 SE_diff:f6 CI_95:f6"
)
# The tail of Student's t by the midpoint rule, on x = sqrt(n - 1) * tan(u).
_P_VALUE = """
SELECT least(1.0, 2 * exp(lgamma((n - 1) / 2.0 + 0.5) - lgamma((n - 1) / 2.0)) / sqrt(pi()) * sum(pow(cos(start + (k + 0.5) * width), n - 2)) * width) AS p_value
FROM (SELECT n, start, (least(pi() / 2, start + 40 / sqrt(n - 1)) - start) / 200000 AS width
  FROM (SELECT n, atan(abs(T_Statistic) / sqrt(n - 1)) AS start FROM ref_paired)), range(200000) AS r(k) GROUP BY n, start, width
"""


fragment(
    "ref_paired",
    """
    SELECT count(*) AS n, avg(First_) AS First_Mean, stddev_samp(First_) AS First_Std, stddev_samp(First_) / sqrt(count(*)) AS First_Sem,
      avg(Second_) AS Second_Mean, stddev_samp(Second_) AS Second_Std, stddev_samp(Second_) / sqrt(count(*)) AS Second_Sem,
      avg(First_ - Second_) / (stddev_samp(First_ - Second_) / sqrt(count(*))) AS T_Statistic,
      sqrt(var_samp(First_) / count(*) + var_samp(Second_) / count(*)) AS SE_diff,
      1.98 * sqrt(var_samp(First_) / count(*) + var_samp(Second_) / count(*)) AS CI_95 FROM ref_pairs
    """,
)


@register("paired_stats", _PAIRED_OUT + " p_value:f9", f"SELECT * FROM ref_paired, ({_P_VALUE})")
def _paired_stats(t: Inputs) -> DataFrame:
    return paired_stats(pairs(t), "First", "Second")


def pairs(t: Inputs) -> DataFrame:
    scored = asm.total_score(responses(t), "PHQ9").where(F.col("Sequence").isin("baseline", "6mo"))
    both = scored.groupBy("PatientID").agg(
        F.max(F.when(F.col("Sequence") == "baseline", F.col("Total_Score"))).alias("First"),
        F.max(F.when(F.col("Sequence") == "6mo", F.col("Total_Score"))).alias("Second"),
    )
    return both.dropna(subset=["First", "Second"])


@register("paired_p_value", "n:i p_value:f9", f"SELECT n, p_value FROM ref_paired, ({_P_VALUE})")
def _paired_p_value(t: Inputs) -> DataFrame:
    return paired_stats(pairs(t), "First", "Second")


fragment(
    "ref_act",
    f"""
SELECT s.PatientID, e.StartDate, e.n AS Assessment_Count, s.Total_Score AS ACT_Total_Score, {_ACT} AS ACT_Result
FROM ({_total('ACT')}) s JOIN (
  SELECT PatientID, min(StartDate) AS StartDate, count(DISTINCT StartDate) AS n FROM ref_responses
  WHERE trim(AssessmentName) = 'Tier 2 Asthma Control Test (ACT)' GROUP BY PatientID) e USING (PatientID)
""",
)


@register(
    "rpt_act",
    "PatientID:i StartDate:d Assessment_Count:i ACT_Total_Score:i ACT_Result AssignedTo",
    "SELECT a.*, c.AssignedTo FROM ref_act a LEFT JOIN in_care_team c USING (PatientID) WHERE a.StartDate BETWEEN DATE '2024-01-02' AND DATE '2024-01-31'",
)
def _rpt_act(t: Inputs) -> DataFrame:
    scores = asm.act_scores(responses(t))
    return reports.rpt_act(scores, t.in_care_team, date(2024, 1, 2), date(2024, 1, 31))
