"""Diagnosis-based risk score: most severe code per group, weights summed, age and sex added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.functions.lookups import first_match, fixed_table

# Weight of each condition code.
WEIGHT_LINES = """
'CARVH'=2.489
'CARM'=0.897
'CARL'=0.283
'CAREL'=0.048
'PSYH'=0.692
'PSYM'=0.375
'PSYML'=0.205
'PSYL'=0.133
'SKCM'=0.409
'SKCL'=0.134
'SKCVL'=0.099
'CNSH'=2.146
'CNSM'=0.752
'CNSL'=0.268
'PULVH'=3.190
'PULH'=1.582
'PULM'=1.164
'PULL'=0.218
'GIH'=1.145
'GIM'=0.719
'GIL'=0.176
'DIA1H'=0.506
'DIA1M'=0.506
'DIA2M'=0.209
'DIA2L'=0.209
'SKNH'=1.826
'SKNL'=0.709
'SKNVL'=0.152
'RENEH'=5.227
'RENVH'=1.691
'RENM'=0.733
'RENL'=0.481
'SUBL'=0.494
'SUBVL'=0.206
'CANVH'=3.458
'CANH'=1.626
'CANM'=0.661
'CANL'=0.285
'DDM'=1.264
'DDL'=0.527
'GENEL'=0.004
'METH'=0.722
'METM'=0.722
'METVL'=0.314
'PRGCMP'=0.130
'PRGINC'=0.451
'EYEL'=0.214
'EYEVL'=0.019
'CERL'=0.421
'AIDSH'=0.852
'INFH'=0.852
'HIVM'=0.794
'INFM'=0.794
'INFL'=0.153
'HEMEH'=3.475
'HEMVH'=2.020
'HEMM'=1.244
'HEML'=0.622
'CCARVH'=1.735
'CCARM'=0.931
'CPULVH'=2.279
'CPULH'=0.524
'CGIH'=1.801
'CMETH'=0.232
'CHIVM'=0.593
'CINFM'=0.593
'CHEMEH'=1.444
""".strip().splitlines()

# Codes of one group per line, most severe first.
GROUP_LINES = """
AIDSH INFH HIVM INFM INFL
CANVH CANH CANM CANL
CARVH CARM CARL CAREL
CERL
CNSH CNSM CNSL
DIA1H DIA1M DIA2M DIA2L
DDM DDL
EYEL EYEVL
GENEL
GIH GIM GIL
HEMEH HEMVH HEMM HEML
METH METM METVL
PRGCMP PRGINC
PSYH PSYM PSYML PSYL
SUBL SUBVL
PULVH PULH PULM PULL
RENEH RENVH RENM RENL
SKCM SKCL SKCVL
SKNH SKNL SKNVL
""".strip().splitlines()

# Constant and age/sex terms of the score.
BASE_TERM = 0.226
INFANT_TERM = 0.398
TODDLER_TERM = -0.068
SEX_TERMS = [
    # from age, below age, Male, Female
    (5, 15, -0.06, -0.105),
    (15, 25, -0.026, 0.051),
    (25, None, -0.068, 0.041),
]


def weight_lines(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, "value string", [(line,) for line in WEIGHT_LINES])


def group_lines(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, "Group int, value string", list(enumerate(GROUP_LINES)))


def scoring_table(spark: SparkSession) -> DataFrame:
    """(Group, Severity, Code, Weight) of every code that belongs to a group."""
    # Restated as rows so that the 58-row table stays a local relation in every plan.
    weights = dict(line.replace("'", "").split("=") for line in WEIGHT_LINES)
    rows = [
        (g, s, code, float(weights[code]))
        for g, line in enumerate(GROUP_LINES)
        for s, code in enumerate(line.split())
    ]
    return fixed_table(spark, "Group int, Severity int, Code string, Weight double", rows)


def cdps_score(patients: DataFrame, code_counts: DataFrame, icd_map: DataFrame) -> DataFrame:
    """Sum over groups of the weight of the patient's most severe code; 0 without codes.

    ``icd_map`` (ICD, Code) comes from outside; it is broadcast only while small.
    """
    coded = code_counts.select("RecipientID", F.col("DiagCd").alias("ICD")).join(icd_map, "ICD")
    worst = (
        coded.join(scoring_table(patients.sparkSession), "Code")
        .groupBy("RecipientID", "Group")
        .agg(F.min_by("Weight", "Severity").alias("Weight"))
    )
    # Weights have three decimals; summing them as decimals keeps the total independent of order.
    raw = worst.groupBy("RecipientID").agg(F.sum(F.col("Weight").cast("decimal(9,3)")).cast("double").alias("UCSD_Risk_Raw"))
    return patients.join(raw, "RecipientID", "left").fillna(0.0, ["UCSD_Risk_Raw"])


def demographic_term(age: Column, gender: Column) -> Column:
    """Age and sex term including the constant; NULL where age or sex is unknown."""
    cases = [(age <= 1, INFANT_TERM), ((age > 1) & (age < 5), TODDLER_TERM)]
    for low, high, male, female in SEX_TERMS:
        span = (age >= low) & (age < high) if high else (age >= low)
        cases += [(span & (gender == "Male"), male), (span & (gender == "Female"), female)]
    return first_match(cases) + F.lit(BASE_TERM)


def cdps_demographic_adjust(scored: DataFrame) -> DataFrame:
    return scored.withColumn("UCSD_Risk", F.col("UCSD_Risk_Raw") + demographic_term(F.col("Age"), F.col("Gender")))
