"""Questionnaire responses to scores.

Everything stays long, one row per patient, assessment and question, until the
last step; all instruments and sequences are scored in one aggregation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carespan.functions.instruments import (
    ASSESSMENTS,
    LOWEST_RAW,
    QUESTIONS,
    T_SCORES,
    scale_rows,
    scale_sizes,
)
from carespan.functions.lookups import first_match, fixed_table, map_value
from carespan.functions.text import capitalize

# Statuses that are read, code-name prefix and result texts.
OPEN_STATUSES = ["Completed", "In Process", "New"]
QUESTION_CODE_PREFIX = "Question "
PHQ_BANDS = [
    (4, "No Signs of Depression"),
    (9, "Mild Depression"),
    (14, "Moderate Depression"),
    (19, "Moderately Severe Depression"),
    (27, "Severe Depression"),
]
EDINBURGH_BANDS = [
    (8, "Low probability of depression"),
    (12, "Most likely just dealing w/ a new baby or the baby blues."),
    (14, "Signs leading to possibility of PPD; take preventative measures."),
]
EDINBURGH_ABOVE = "High probability of experiencing clinical depression."
ACT_BANDS = [(19, "Pt's asthma symptoms may not be in as much control as they should be ")]
ACT_ABOVE = "Pt appears to have well controlled asthma."
PSC_LIMITS = {"Attention Problems": 7, "Internalizing Problems": 5, "Externalizing Problems": 7}
PSC_TOTAL_LIMIT = 15

RESPONSE_KEY = ["PatientID", "AssessmentName", "QuestionText"]
RESPONSE_VALUES = [
    "MedicaidID", "StartDate", "EndDate", "StatusCode", "QuestionID", "YesNo", "Range", "Text", "CUserID",
]


def opened_questions(
    assessments: DataFrame,
    client_assessments: DataFrame,
    patients: DataFrame,
    questionnaires: DataFrame,
    questionnaire_questions: DataFrame,
    questions: DataFrame,
) -> DataFrame:
    """Open assessments with the questions they ask, a row each."""
    asked = (
        client_assessments.join(
            questionnaires, client_assessments["AssessmentName"] == questionnaires["QuestionnaireName"]
        )
        .select(client_assessments["ID"].alias("ClientAssessmentID"), "AssessmentName", questionnaires["ID"].alias("QuestionnaireID"))
        .join(questionnaire_questions, "QuestionnaireID")
        .join(questions.select(F.col("ID").alias("QuestionID"), "QuestionText"), "QuestionID")
    )
    return (
        assessments.where(F.col("StatusCode").isin(OPEN_STATUSES))
        .join(patients.select(F.col("ID").alias("PatientID"), F.col("MedicaidNum").alias("MedicaidID")), "PatientID")
        .join(asked, "ClientAssessmentID")
    )


def assessment_join(opened: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses dated between an open assessment's creation and its end.

    Its output grows with overlapping assessments; ``newest_responses`` gives what most need of it without the pairs.
    """
    opened, answered = opened.alias("a"), responses.alias("r")
    same = (
        (F.col("a.PatientID") == F.col("r.MedRecPatientID"))
        & (F.col("a.QuestionID") == F.col("r.QuestionID"))
        & F.col("r.ResponseDate").between(F.col("a.CTS"), F.col("a.EndDate"))
    )
    return opened.join(answered, same).select(
        "a.PatientID",
        "a.MedicaidID",
        "a.AssessmentName",
        "a.StartDate",
        "a.EndDate",
        "a.StatusCode",
        "a.CTS",
        "a.QuestionID",
        "a.QuestionText",
        "r.ResponseDate",
        "r.YesNo",
        "r.Range",
        "r.Text",
        "r.CUserID",
    )


def latest_response(responses: DataFrame) -> DataFrame:
    """Per question the newest value of each column, skipping NULLs column by column.

    Newest is by assessment creation, then response date, then the value itself.
    """
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct("CTS", "ResponseDate", c))).alias(c) for c in RESPONSE_VALUES
    ]
    latest = responses.groupBy(*RESPONSE_KEY).agg(*newest, F.max(F.struct("CTS", "ResponseDate")).alias("at"))
    return latest.select(
        *RESPONSE_KEY, *[F.col(f"{c}.{c}").alias(c) for c in RESPONSE_VALUES], F.col("at.CTS"), F.col("at.ResponseDate")
    )


ANSWER_VALUES = ["YesNo", "Range", "Text", "CUserID"]


def newest_responses(opened: DataFrame, responses: DataFrame) -> DataFrame:
    """``latest_response`` of the assessment join, without joining.

    Assessments (at their end) and responses of a patient and question stand in one order of time.
    A running maximum holds the newest response of each column so far; an assessment takes it
    if it isn't older than the assessment. So there is one candidate for an assessment and question,
    however many responses and other assessments overlap it.
    """
    ours = [c for c in RESPONSE_VALUES if c not in ANSWER_VALUES]
    dated = responses.select(
        F.col("MedRecPatientID").alias("PatientID"),
        "QuestionID",
        F.col("ResponseDate").alias("_at"),
        F.lit(0).alias("_order"),
        F.struct(F.col("ResponseDate").alias("at")).alias("_any"),
        *[F.when(F.col(c).isNotNull(), F.struct(F.col("ResponseDate").alias("at"), F.col(c))).alias(f"_{c}") for c in ANSWER_VALUES],
    )
    ends = opened.select(
        "PatientID",
        "QuestionID",
        F.col("EndDate").alias("_at"),
        F.lit(1).alias("_order"),
        F.struct("CTS", "AssessmentName", "QuestionText", *[F.col(c) for c in ours]).alias("a"),
    )
    so_far = W.partitionBy("PatientID", "QuestionID").orderBy("_at", "_order").rowsBetween(W.unboundedPreceding, 0)
    seen = [c for c in dated.columns if c.startswith("_") and c not in ("_at", "_order")]
    events = dated.unionByName(ends, allowMissingColumns=True).where("_at IS NOT NULL")
    held = events.withColumns({c: F.max(c).over(so_far) for c in seen}).where("_order = 1")
    held = held.withColumns({c: F.when(F.col(f"{c}.at") >= F.col("a.CTS"), F.col(c)) for c in seen}).where("_any IS NOT NULL")
    own = [F.max(F.when(F.col(f"a.{c}").isNotNull(), F.struct("a.CTS", "_any.at", F.col(f"a.{c}").alias("v")))).alias(c) for c in ours]
    answers = [F.max(F.when(F.col(f"_{c}").isNotNull(), F.struct("a.CTS", f"_{c}.at", F.col(f"_{c}.{c}").alias("v")))).alias(c) for c in ANSWER_VALUES]
    latest = held.groupBy("PatientID", "a.AssessmentName", "a.QuestionText").agg(*own, *answers, F.max(F.struct("a.CTS", "_any.at")).alias("at"))
    return latest.select(
        *RESPONSE_KEY, *[F.col(f"{c}.v").alias(c) for c in RESPONSE_VALUES], F.col("at.CTS"), F.col("at.at").alias("ResponseDate")
    )


def answer_codes(questions: DataFrame, codes: DataFrame, code_values: DataFrame) -> DataFrame:
    """(QuestionText, IntegerValue) to answer text for questions with an answer list."""
    named = codes.where(F.col("CodeName").startswith(QUESTION_CODE_PREFIX)).select("CodeName")
    return (
        questions.select("QuestionText", F.col("OptionsGlobalCodeName").alias("CodeName"))
        .join(named, "CodeName")
        .join(code_values, "CodeName")
        .select("QuestionText", "IntegerValue", F.col("Description").alias("Response"))
    )


def code_value_join(responses: DataFrame, answers: DataFrame) -> DataFrame:
    match = (responses["QuestionText"] == answers["QuestionText"]) & (responses["Range"] == answers["IntegerValue"])
    return responses.join(answers, match, "left").select(*[responses[c] for c in responses.columns], answers["Response"])


def assessment_responses(opened: DataFrame, responses: DataFrame, answers: DataFrame) -> DataFrame:
    """Latest responses with yes/no answers folded into Range and answers spelled out."""
    folded = responses.withColumn("Range", F.coalesce("YesNo", "Range"))
    coded = code_value_join(newest_responses(opened, folded), answers)
    return coded.withColumns(
        {
            "CUserID": F.trim(F.lower("CUserID")),
            "Response": F.when(F.col("YesNo") == 0, "No").when(F.col("YesNo") == 1, "Yes").otherwise(F.col("Response")),
        }
    )


def named_assessments(responses: DataFrame) -> DataFrame:
    """Responses tagged with the instruments and sequences their assessment feeds."""
    spark = responses.sparkSession
    names = fixed_table(spark, "Instrument string, Sequence string, AssessmentName string", ASSESSMENTS)
    return responses.withColumn("AssessmentName", F.trim("AssessmentName")).join(names, "AssessmentName")


def scale_scores(responses: DataFrame, instruments: Sequence[str] | None = None) -> DataFrame:
    """Sum and number of answered items per patient, instrument, sequence and scale.

    ``Score`` of a strict scale is NULL unless every item was answered. Scales
    with no answer have no row.
    """
    spark = responses.sparkSession
    items = [r for r in scale_rows() if instruments is None or r[0] in instruments]
    sizes = {(i, s): n for i in QUESTIONS for s, n in scale_sizes(i).items()}
    scales = fixed_table(
        spark,
        "Instrument string, Scale string, QuestionText string, Strict boolean, Items int",
        [(*row, sizes[row[0], row[1]]) for row in items],
    )
    answered = named_assessments(responses).join(scales, ["Instrument", "QuestionText"])
    return (
        answered.where(F.col("Range").isNotNull())
        .groupBy("PatientID", "Instrument", "Sequence", "AssessmentName", "Scale", "Strict", "Items")
        .agg(F.sum("Range").alias("Total"), F.count("Range").alias("Answered"))
        .withColumn("Score", F.when(~F.col("Strict") | (F.col("Answered") == F.col("Items")), F.col("Total")))
        .drop("Strict", "Items", "Total")
    )


def score_sum(responses: DataFrame, instrument: str) -> DataFrame:
    """One row per patient and sequence with a column per scale of the instrument.

    A patient missing a whole scale is dropped.
    """
    scales = list(QUESTIONS[instrument])
    wide = (
        scale_scores(responses, [instrument])
        .groupBy("PatientID", "Sequence", "AssessmentName")
        .agg(
            *[F.max(F.when(F.col("Scale") == s, F.col("Score"))).alias(s) for s in scales],
            F.count(F.lit(1)).alias("_scales"),
        )
    )
    return wide.where(F.col("_scales") == len(scales)).drop("_scales")


def total_score(responses: DataFrame, instrument: str) -> DataFrame:
    return score_sum(responses, instrument).withColumnRenamed("Total", "Total_Score")


def band(score: Column, limits: Sequence[tuple[int, str]], above: str | None = None) -> Column:
    return first_match([(score <= limit, text) for limit, text in limits], above)


def score_psc(responses: DataFrame) -> DataFrame:
    scored = score_sum(responses, "PSC")
    total = F.col("Attention Problems") + F.col("Internalizing Problems") + F.col("Externalizing Problems")
    flags = {f"{s.split()[0]}_At_Risk": F.col(s) >= limit for s, limit in PSC_LIMITS.items()}
    return (
        scored.withColumn("Total_Score", total)
        .withColumns({**flags, "Total_At_Risk": F.col("Total_Score") >= PSC_TOTAL_LIMIT})
        .withColumnsRenamed({s: s.replace(" ", "_") for s in PSC_LIMITS})
    )


def t_score(scale: str, raw: Column) -> Column:
    return map_value({LOWEST_RAW + i: t for i, t in enumerate(T_SCORES[scale])}, raw.cast("int"))


def score_promis(responses: DataFrame) -> DataFrame:
    scored = score_sum(responses, "PROMIS")
    return scored.withColumns({f"{s}_T_Score": t_score(s, F.col(s)) for s in T_SCORES}).withColumnsRenamed(
        {s: f"{s}_Score" for s in T_SCORES}
    )


def score_phq(responses: DataFrame, instrument: str) -> DataFrame:
    """PHQ9 or PHQA; sums beyond the last band have no result text."""
    return total_score(responses, instrument).withColumn("Result", band(F.col("Total_Score"), PHQ_BANDS))


def score_edinburgh(responses: DataFrame) -> DataFrame:
    return total_score(responses, "Edinburgh").withColumn(
        "Result", band(F.col("Total_Score"), EDINBURGH_BANDS, EDINBURGH_ABOVE)
    )


def score_act(responses: DataFrame) -> DataFrame:
    return total_score(responses, "ACT").withColumn("Result", band(F.col("Total_Score"), ACT_BANDS, ACT_ABOVE))


def score_chaos(responses: DataFrame) -> DataFrame:
    return total_score(responses, "CHAOS").where(F.col("Total_Score") != 0)


def earliest_assessment(responses: DataFrame) -> DataFrame:
    """Earliest start per patient and assessment, ties by user."""
    return (
        responses.withColumn("AssessmentName", F.trim("AssessmentName"))
        .groupBy("PatientID", "AssessmentName")
        .agg(F.min(F.struct("StartDate", "CUserID")).alias("e"))
        .select("PatientID", "AssessmentName", "e.*")
    )


def final_scores(scored: DataFrame) -> DataFrame:
    """(Score_Type, Score) rows: six T-scores for PROMIS, one total for the others.

    ``scored`` is the output of ``scale_scores`` for all instruments.
    """
    wanted = map_value({i: len(QUESTIONS[i]) for i in QUESTIONS}, F.col("Instrument"))
    per_patient = scored.groupBy("PatientID", "Instrument", "Sequence", "AssessmentName").agg(
        F.count(F.lit(1)).alias("_scales"),
        F.sum("Score").alias("_total"),
        *[F.max(F.when(F.col("Scale") == s, F.col("Score"))).alias(f"_{s}") for s in T_SCORES],
    )
    complete = per_patient.where(F.col("_scales") == wanted).where(
        (F.col("Instrument") != "CHAOS") | (F.col("_total") != 0)
    )
    promis = F.array(
        *[
            F.struct(F.lit(f"{s} T-Score").alias("Score_Type"), t_score(s, F.col(f"_{s}")).alias("Score"))
            for s in T_SCORES
        ]
    )
    single = F.array(F.struct(F.lit("Total Score").alias("Score_Type"), F.col("_total").cast("double").alias("Score")))
    return complete.select(
        "PatientID",
        "Instrument",
        F.col("Sequence"),
        "AssessmentName",
        F.inline(F.when(F.col("Instrument") == "PROMIS", promis).otherwise(single)),
    )


def auto_score(responses: DataFrame) -> DataFrame:
    """All instruments and sequences with the start date and user of the earliest assessment."""
    scores = final_scores(scale_scores(responses))
    return scores.join(earliest_assessment(responses), ["PatientID", "AssessmentName"])


def totals_labels(scores: DataFrame) -> DataFrame:
    return scores.withColumn("Sequence", capitalize(F.col("Sequence")))


def total_columns() -> list[tuple[str, str, str, str]]:
    """(instrument, score type, sequence, column stem) of the totals table; ACT is kept apart."""
    out = []
    for instrument, sequence, _ in ASSESSMENTS:
        if instrument == "ACT":
            continue
        kinds = [f"{s} T-Score" for s in T_SCORES] if instrument == "PROMIS" else ["Total Score"]
        label = sequence[:1].upper() + sequence[1:]
        for kind in kinds:
            stem = f"{instrument}_{kind}_{label}".replace(" ", "_").replace("-", "_")
            out.append((instrument, kind, label, stem))
    return out


def score_totals_pivot(scores: DataFrame) -> DataFrame:
    """One row per patient: score and start date of every instrument, type and sequence."""
    labelled = totals_labels(scores.where(F.col("Instrument") != "ACT"))
    cells = []
    for instrument, kind, sequence, stem in total_columns():
        here = (
            (F.col("Instrument") == instrument) & (F.col("Score_Type") == kind) & (F.col("Sequence") == sequence)
        )
        cells.append(F.max(F.when(here, F.col("Score"))).alias(f"{stem}_Score"))
        cells.append(F.max(F.when(here, F.col("StartDate"))).alias(f"{stem}_StartDate"))
    return labelled.groupBy("PatientID").agg(*cells)


def column_labels(df: DataFrame, name: str, suffix: str, keep: Sequence[str] = ("PatientID",)) -> DataFrame:
    """Prefix with the assessment name unless already there, then add the suffix."""
    renamed = {
        c: f"{c}_{suffix}" if c.startswith(name) else f"{name}_{c}_{suffix}" for c in df.columns if c not in keep
    }
    return df.withColumnsRenamed(renamed)


def act_scores(responses: DataFrame) -> DataFrame:
    """ACT totals with start date and the number of the patient's ACT assessments."""
    starts = responses.withColumn("AssessmentName", F.trim("AssessmentName")).where(
        F.col("AssessmentName") == "Tier 2 Asthma Control Test (ACT)"
    )
    counted = (
        starts.groupBy("PatientID", "StartDate").agg(F.lit(1).alias("one"))
        .groupBy("PatientID").agg(F.min("StartDate").alias("StartDate"), F.count(F.lit(1)).alias("Assessment_Count"))
    )
    return (
        score_act(responses)
        .join(counted, "PatientID")
        .select(
            "PatientID",
            "StartDate",
            "Assessment_Count",
            F.col("Total_Score").alias("ACT_Total_Score"),
            F.col("Result").alias("ACT_Result"),
        )
    )
