"""Claim categorization: inpatient, outpatient and professional claims.

Each branch reduces its many-row detail table to one summary row per claim
key before it meets the claims, so every claim-key join is one-to-one and no
claim's detail lines are ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.lookups import first_match
from carespan.functions.skew import attach_summary, summarize
from carespan.operators.keys import (
    CLAIM_KEY,
    DOCUMENT_KEY,
    claim_key_inner,
    claim_key_left,
    record_type_split,
)

# Bill types, revenue codes and category names of the claim rules.
EMERGENCY_REVENUE_CODES = ["0450", "0451", "0452", "0456", "0459", "0981"]
NOT_A_SERVICE_REVENUE_CODE = "0001"
VISIT_CATEGORIES = [
    "OTHER_OUTPATIENT_VISIT",
    "HOSPITAL_OUTPATIENT_VISIT",
    "OFFICE_VISIT",
    "RURAL_HEALTH_CLINIC_VISIT",
    "HOME_VISIT",
    "TELEPHONE_VISIT",
    "PREVENTIVE_VISIT",
    "OUTPATIENT_CONSULT",
]
# HCPCS overrides (Category3, Category2, rank); a code in several of them takes the last.
HCPCS_OVERRIDES = [
    ("OUTPATIENT_OP", "OUTPATIENT", 3.0),
    ("AMBULANCE_OP", "ANCILLARY", 8.0),
    ("DME_OP", "ANCILLARY", 9.0),
    ("HOME_HEALTH_OP", "ANCILLARY", 10.0),
]
UNRANKED = 15.0
INPATIENT_RANK = 1.5

CATEGORY_COLUMNS = ["Category1", "Category2", "Category3", "Category2Rank", "Category3Rank"]
COUNT_COLUMNS = ["Visit", "Service_Count", "Procedure_Count", "Encounter", "Visit_Inpatient_Days"]
PUBLISHED_COLUMNS = [
    *CLAIM_KEY,
    "AdjustedPriceAmt",
    "Category1",
    "Category2",
    "Category3",
    "Summary_Category",
    "Category2Rank",
    "Category3Rank",
    *COUNT_COLUMNS,
    "Prematurity_Ineligible",
]


def bill_type_category(bill_type: Column) -> Column:
    family, last = F.floor(bill_type / 10), bill_type % 10
    real = last.between(1, 9)
    return first_match(
        [
            (real & family.isin(11, 12), "INPATIENT"),
            (real & family.between(21, 28), "SNF"),
            (real & family.isin(81, 82), "HOSPICE"),
        ],
        "OTHER",
    )


def ip_service_count(revenue: DataFrame) -> DataFrame:
    """Revenue lines other than the total line, per claim; no row where there are none."""
    counted = ~F.col("RevenueCd").eqNullSafe(F.lit(NOT_A_SERVICE_REVENUE_CODE))
    return revenue.where(counted).groupBy(*CLAIM_KEY).agg(F.count("RevenueCd").alias("Service_Count"))


def _ip_revenue_summary(revenue: DataFrame) -> DataFrame:
    counted = ~F.col("RevenueCd").eqNullSafe(F.lit(NOT_A_SERVICE_REVENUE_CODE))
    return (
        revenue.groupBy(*CLAIM_KEY)
        .agg(
            F.bool_or(F.coalesce(F.col("RevenueCd").isin(EMERGENCY_REVENUE_CODES), F.lit(False))).alias("_emergency"),
            F.count_if(counted).alias("_counted"),
            F.count(F.when(counted, F.col("RevenueCd"))).alias("_services"),
        )
        .select(*CLAIM_KEY, "_emergency", F.when(F.col("_counted") > 0, F.col("_services")).alias("Service_Count"))
    )


def ip_procedure_count(claims: DataFrame, procedures: DataFrame) -> DataFrame:
    """Coded procedures per claim, 0 when there are none."""
    per_claim = procedures.groupBy(*CLAIM_KEY).agg(F.count("ProcCd").alias("Procedure_Count"))
    return claim_key_left(claims, per_claim).fillna(0, ["Procedure_Count"])


def document_summary(lines: DataFrame) -> DataFrame:
    """Per document: last line of it and of each rejection status, and the length of stay."""
    by_status = summarize(
        lines,
        [*DOCUMENT_KEY, "RejectionStatusCd"],
        F.max("ServiceLineNbr").alias("_last"),
        F.min("ServiceFromDt").alias("_from"),
        F.max("ServiceThruDt").alias("_thru"),
    )
    entry = F.when(F.col("RejectionStatusCd").isNotNull(), F.struct("RejectionStatusCd", "_last"))
    return by_status.groupBy(*DOCUMENT_KEY).agg(
        F.max("_last").alias("_last_of_document"),
        F.map_from_entries(F.collect_list(entry)).alias("_last_of_status"),
        (F.datediff(F.max("_thru"), F.min("_from")) + 1).alias("_stay"),
        F.sum("_rows").alias("_rows"),
    )


def ip_visit_encounter_days(lines: DataFrame) -> DataFrame:
    """Visit and Encounter on the last line per status, inpatient days on the last line of all."""
    with_summary = attach_summary(lines, document_summary(lines), DOCUMENT_KEY)
    last = F.try_element_at("_last_of_status", F.col("RejectionStatusCd"))
    is_last = F.coalesce((F.col("ServiceLineNbr") == last).cast("int"), F.lit(0))
    days = F.when(F.col("ServiceLineNbr") == F.col("_last_of_document"), F.col("_stay"))
    return with_summary.select(
        *lines.columns,
        is_last.alias("Visit"),
        is_last.alias("Encounter"),
        F.coalesce(days, F.lit(0)).alias("Visit_Inpatient_Days"),
    )


def ip_lines(claims: DataFrame, institutional: DataFrame) -> DataFrame:
    bill_types = institutional.select(*CLAIM_KEY, "UBTypeofBillCd")
    return claim_key_inner(record_type_split(claims, "I"), bill_types)


def ip_categories(lines: DataFrame, revenue: DataFrame) -> DataFrame:
    """Categories and service count of inpatient lines that carry their bill type."""
    category2 = bill_type_category(F.col("UBTypeofBillCd").cast("int"))
    category3 = F.when(F.col("_emergency"), "EMERGENCY_IP").otherwise(F.concat("Category2", F.lit("_IP")))
    return (
        claim_key_left(lines, _ip_revenue_summary(revenue))
        .withColumns(
            {
                "Category1": F.lit("INPATIENT"),
                "Category2": category2,
                "Category2Rank": F.lit(INPATIENT_RANK),
                "Category3Rank": F.lit(INPATIENT_RANK),
            }
        )
        .withColumn("Category3", category3)
        .drop("_emergency", "UBTypeofBillCd")
    )


def ip_categorize(claims: DataFrame, institutional: DataFrame, revenue: DataFrame, procedures: DataFrame) -> DataFrame:
    # Document summaries need the bare lines only, so they come before the detail joins.
    flagged = ip_visit_encounter_days(ip_lines(claims, institutional))
    coded = ip_procedure_count(ip_categories(flagged, revenue), procedures)
    return coded.select(*claims.columns, *CATEGORY_COLUMNS, *COUNT_COLUMNS)


def _outcome(rank2: Column, rank3: Column, category3: Column, category2: Column) -> Column:
    return F.struct(
        rank2.cast("double").alias("Category2Rank"),
        rank3.cast("double").alias("Category3Rank"),
        category3.alias("Category3"),
        category2.alias("Category2"),
    )


def _fixed_outcome(rank: float, category3: str, category2: str) -> Column:
    return _outcome(F.lit(rank), F.lit(rank), F.lit(category3), F.lit(category2))


def _rule_outcome(category3: str, category2: str) -> Column:
    """What a rule row gives, its gaps filled with the defaults."""
    return _outcome(
        F.coalesce("Category2Rank", F.lit(UNRANKED)),
        F.coalesce("Category3Rank", F.lit(UNRANKED)),
        F.coalesce("Category3", F.lit(category3)),
        F.coalesce("Category2", F.lit(category2)),
    )


def _ordered_outcomes(rules: DataFrame, per_rule: list[Column], fixed: list[Column]) -> Column:
    """Every outcome a claim can have, best first, as a scalar array.

    Candidates are compared by their place in it, so picking the best one is a
    minimum of integers. Bounded by the rule table.
    """
    possible = rules.select(F.explode(F.array(*per_rule)).alias("o")).agg(F.collect_set("o").alias("o"))
    return possible.select(F.array_sort(F.array_union("o", F.array(*fixed))).alias("o")).scalar()


def rule_join_rev(revenue: DataFrame, rules: DataFrame) -> DataFrame:
    """Revenue lines left joined to rules on (revenue code, HCPCS)."""
    return revenue.join(rules, ["RevenueCd", "RevenueHCPCSCd"], "left")


_OP_DEFAULT = ("UNCLASSIFIED", "UNCLASSIFIED")


def op_outcomes(rules: DataFrame) -> Column:
    fixed = [_fixed_outcome(rank, c3, c2) for c3, c2, rank in HCPCS_OVERRIDES]
    return _ordered_outcomes(rules, [_rule_outcome(*_OP_DEFAULT)], [*fixed, _fixed_outcome(UNRANKED, *_OP_DEFAULT)])


def hcpcs_overrides(rules: DataFrame, outcomes: Column) -> DataFrame:
    """One override per HCPCS that some rule places in an overriding category."""
    order = [name for name, _, _ in HCPCS_OVERRIDES]
    priority = first_match([(F.col("Category3") == name, i) for i, name in enumerate(order)])
    last = rules.where(F.col("Category3").isin(order)).groupBy("RevenueHCPCSCd").agg(F.max(priority).alias("p"))
    given = first_match(
        [(F.col("p") == i, _fixed_outcome(rank, c3, c2)) for i, (c3, c2, rank) in enumerate(HCPCS_OVERRIDES)]
    )
    return last.select("RevenueHCPCSCd", F.array_position(outcomes, given).alias("_override"))


def op_candidates(revenue: DataFrame, rules: DataFrame) -> DataFrame:
    """The best outcome of each revenue line by its rules, unless its HCPCS is overridden."""
    op_rules = rules.where(F.col("Category1") == "OUTPATIENT")
    outcomes = op_outcomes(op_rules)
    ranked = (
        op_rules.select("RevenueCd", "RevenueHCPCSCd", F.array_position(outcomes, _rule_outcome(*_OP_DEFAULT)).alias("r"))
        .groupBy("RevenueCd", "RevenueHCPCSCd")
        .agg(F.min("r").alias("_rule"))
    )
    lines = revenue.select(*CLAIM_KEY, "RevenueCd", "RevenueHCPCSCd")
    default = F.array_position(outcomes, _fixed_outcome(UNRANKED, *_OP_DEFAULT))
    return (
        rule_join_rev(lines, ranked)
        .join(hcpcs_overrides(op_rules, outcomes), "RevenueHCPCSCd", "left")
        .select(*CLAIM_KEY, F.coalesce("_override", "_rule", default).alias("Outcome"))
    )


def best_rank_per_claim(candidates: DataFrame, category1: str, outcomes: Column) -> DataFrame:
    """Lowest (Category2Rank, Category3Rank) per claim; ties by Category3, then Category2.

    A minimum of integers combines map-side, so a claim with very many
    candidate lines needs no sort of them all in one task.
    """
    best = candidates.groupBy(*CLAIM_KEY).agg(F.min("Outcome").alias("Outcome"))
    named = best.withColumn("o", F.element_at(outcomes, F.col("Outcome").cast("int")))
    return named.select(
        *CLAIM_KEY, F.lit(category1).alias("Category1"), *[F.col(f"o.{c}").alias(c) for c in CATEGORY_COLUMNS[1:]]
    )


def op_best(lines: DataFrame, rules: DataFrame) -> DataFrame:
    outcomes = op_outcomes(rules.where(F.col("Category1") == "OUTPATIENT"))
    return best_rank_per_claim(op_candidates(lines, rules), "OUTPATIENT", outcomes)


def op_lines(claims: DataFrame, revenue: DataFrame) -> DataFrame:
    """Revenue lines of outpatient claims. The claim side has one row per key."""
    keys = record_type_split(claims, "O").select(*CLAIM_KEY)
    return revenue.join(keys, CLAIM_KEY, "left_semi")


def op_service_count(lines: DataFrame) -> DataFrame:
    """Counted revenue lines per document; every line of the document will repeat it."""
    counted = F.col("RevenueCd") != NOT_A_SERVICE_REVENUE_CODE
    return lines.groupBy(*DOCUMENT_KEY).agg(F.count(F.when(counted, F.col("RevenueCd"))).alias("Service_Count"))


def op_constants(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Visit": F.lit(1),
            "Encounter": F.lit(1),
            "Procedure_Count": F.lit(0).cast("long"),
            "Visit_Inpatient_Days": F.lit(0),
        }
    )


def op_categorize(claims: DataFrame, revenue: DataFrame, rules: DataFrame) -> DataFrame:
    lines = op_lines(claims, revenue)
    op = claim_key_inner(record_type_split(claims, "O"), op_best(lines, rules))
    counts = op_service_count(lines)
    # Line counts come from the claims alone; they only decide which documents are hot.
    outpatient = record_type_split(claims, "O")
    sized = summarize(outpatient, DOCUMENT_KEY).join(counts, DOCUMENT_KEY, "left")
    counted = attach_summary(op, sized, DOCUMENT_KEY).fillna(0, ["Service_Count"])
    return op_constants(counted).select(*claims.columns, *CATEGORY_COLUMNS, *COUNT_COLUMNS)


def rule_join_proc(procedures: DataFrame, rules: DataFrame) -> DataFrame:
    """Procedures left joined to rules on ProcCd; the rule's place is kept apart."""
    return procedures.join(rules.withColumnRenamed("PlaceOfServiceCd", "Rule_Place"), "ProcCd", "left")


_NIPS_DEFAULT = ("OTHER_PROF", "OTHER")


def _at_place() -> Column:
    """A rule's outcome where its place matches: first by Category2Rank."""
    rule = _rule_outcome(*_NIPS_DEFAULT)
    return rule.withField("Category2Rank", F.lit(0.0))


def nips_outcomes(rules: DataFrame) -> Column:
    return _ordered_outcomes(
        rules, [_rule_outcome(*_NIPS_DEFAULT), _at_place()], [_fixed_outcome(UNRANKED, *_NIPS_DEFAULT)]
    )


def nips_candidates(claims: DataFrame, nips: DataFrame, procedures: DataFrame, rules: DataFrame) -> DataFrame:
    """Every outcome a professional claim qualifies for.

    A rule naming a place counts only at that place, and then comes first. A
    claim whose rules all name other places has no candidate and vanishes.
    """
    rule_set = rules.where(F.col("Category1") == "NIPS")
    outcomes = nips_outcomes(rule_set)
    ranked = (
        rule_set.select(
            "ProcCd",
            "PlaceOfServiceCd",
            F.array_position(outcomes, _rule_outcome(*_NIPS_DEFAULT)).alias("r"),
            F.array_position(outcomes, _at_place()).alias("m"),
        )
        .groupBy("ProcCd", "PlaceOfServiceCd")
        .agg(F.min("r").alias("_anywhere"), F.min("m").alias("_at_place"))
    )
    default = F.array_position(outcomes, _fixed_outcome(UNRANKED, *_NIPS_DEFAULT))
    # One row per (claim, place) and (claim, rule place): few per claim however many lines it has.
    places = nips.groupBy(*CLAIM_KEY, "PlaceOfServiceCd").agg(F.lit(1).alias("_seen")).drop("_seen")
    ruled = (
        rule_join_proc(procedures.select(*CLAIM_KEY, "ProcCd"), ranked)
        .groupBy(*CLAIM_KEY, "Rule_Place")
        .agg(F.min(F.coalesce("_anywhere", default)).alias("_anywhere"), F.min("_at_place").alias("_at_place"))
    )
    joined = claim_key_left(claim_key_left(record_type_split(claims, "N").select(*CLAIM_KEY), places), ruled)
    matches = F.coalesce(F.col("PlaceOfServiceCd") == F.col("Rule_Place"), F.lit(False))
    kept = joined.where(matches | (F.coalesce(F.col("Rule_Place"), F.lit("")) == ""))
    outcome = F.when(matches, F.col("_at_place")).otherwise(F.coalesce("_anywhere", default))
    return kept.select(*CLAIM_KEY, outcome.alias("Outcome"))


def nips_best(claims: DataFrame, nips: DataFrame, procedures: DataFrame, rules: DataFrame) -> DataFrame:
    outcomes = nips_outcomes(rules.where(F.col("Category1") == "NIPS"))
    return best_rank_per_claim(nips_candidates(claims, nips, procedures, rules), "NIPS", outcomes)


def nips_visit(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Visit": F.col("Category3").isin(VISIT_CATEGORIES).cast("int"),
            "Service_Count": F.lit(1).cast("long"),
            "Encounter": F.lit(1),
            "Procedure_Count": F.lit(0).cast("long"),
            "Visit_Inpatient_Days": F.lit(0),
        }
    )


def nips_categorize(claims: DataFrame, nips: DataFrame, procedures: DataFrame, rules: DataFrame) -> DataFrame:
    best = nips_best(claims, nips, procedures, rules)
    categorized = claim_key_inner(record_type_split(claims, "N"), best)
    return nips_visit(categorized).select(*claims.columns, *CATEGORY_COLUMNS, *COUNT_COLUMNS)


def summary_map_join(df: DataFrame, summary_map: DataFrame) -> DataFrame:
    return df.join(summary_map, ["Category1", "Category2", "Category3"], "left")


def categorize_claims(
    claims: DataFrame,
    institutional: DataFrame,
    revenue: DataFrame,
    procedures: DataFrame,
    nips: DataFrame,
    rules: DataFrame,
    summary_map: DataFrame,
    dealt: bool = False,
) -> DataFrame:
    """All three branches with price and summary category; keeps the claim columns.

    ``dealt``: the tables lie by document already, in as many buckets each.
    """
    from carespan.operators.one_pass import categorize_all

    branches = categorize_all(claims, institutional, revenue, procedures, nips, rules, dealt)
    priced = branches.withColumns(
        {
            "AdjustedPriceAmt": F.greatest("NetLiabilityAmt", "EncounterPriceAmt"),
            "Prematurity_Ineligible": F.lit(0),
        }
    )
    return summary_map_join(priced, summary_map)


def claims_categorized(categorized: DataFrame) -> DataFrame:
    """Published layout. Ordering is left to whoever writes the table (``presentation_sort``)."""
    return categorized.select(*PUBLISHED_COLUMNS)


def presentation_sort(df: DataFrame, *columns: str) -> DataFrame:
    """Total order for output; only ever the last step before a sink."""
    return df.orderBy(*(columns or CLAIM_KEY))
