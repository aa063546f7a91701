"""Claim filters, claim-key joins and categorization."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.skew import attach_summary, summarize
from carespan.operators import categorize as cat
from carespan.operators import keys
from carespan.operators.one_pass import hot_documents
from carespan.operators.refresh import DEALT_BY, ClaimTables, refresh
from carespan.queries.bindings import KEY
from carespan.queries.registry import Inputs, fragment, register
from carespan.session import written, written_dealt

KEY_OUT = "DCN ServiceLineNbr RejectionStatusCd RecipientID AdjudicatedDt:d"
CATEGORY_OUT = "Category1 Category2 Category3 Category2Rank:f1 Category3Rank:f1"
COUNT_OUT = "Visit:i Service_Count:i Procedure_Count:i Encounter:i Visit_Inpatient_Days:i"
BRANCH_OUT = f"{KEY_OUT} {CATEGORY_OUT} NetLiabilityAmt:m EncounterPriceAmt:m {COUNT_OUT}"

fragment(
    "ref_ip",
    f"""
SELECT b.* EXCLUDE (UBTypeofBillCd, em, c2), 'INPATIENT' AS Category1, c2 AS Category2,
  CASE WHEN em THEN 'EMERGENCY_IP' ELSE c2 || '_IP' END AS Category3, 1.5 AS Category2Rank, 1.5 AS Category3Rank,
  CASE WHEN ServiceLineNbr = max(ServiceLineNbr) OVER (PARTITION BY RecipientID, DCN, RejectionStatusCd) THEN 1 ELSE 0 END AS Visit,
  CASE WHEN ServiceLineNbr = max(ServiceLineNbr) OVER (PARTITION BY RecipientID, DCN, RejectionStatusCd) THEN 1 ELSE 0 END AS Encounter,
  CASE WHEN ServiceLineNbr = max(ServiceLineNbr) OVER (PARTITION BY RecipientID, DCN)
    THEN max(ServiceThruDt) OVER (PARTITION BY RecipientID, DCN) - min(ServiceFromDt) OVER (PARTITION BY RecipientID, DCN) + 1 ELSE 0 END AS Visit_Inpatient_Days
FROM (
  SELECT c.*, i.UBTypeofBillCd, coalesce(r.em, false) AS em, CASE WHEN r.sc > 0 THEN r.sc END AS Service_Count, coalesce(p.pc, 0) AS Procedure_Count,
    CASE WHEN UBTypeofBillCd BETWEEN 111 AND 119 OR UBTypeofBillCd BETWEEN 121 AND 129 THEN 'INPATIENT'
         WHEN UBTypeofBillCd BETWEEN 211 AND 289 AND UBTypeofBillCd % 10 <> 0 THEN 'SNF'
         WHEN UBTypeofBillCd BETWEEN 811 AND 819 OR UBTypeofBillCd BETWEEN 821 AND 829 THEN 'HOSPICE' ELSE 'OTHER' END AS c2
  FROM in_claims c JOIN in_institutional i USING ({KEY})
  LEFT JOIN (SELECT {KEY}, bool_or(RevenueCd IN ('0450','0451','0452','0456','0459','0981')) AS em,
               count(*) FILTER (RevenueCd <> '0001') AS sc FROM in_revenue GROUP BY {KEY}) r USING ({KEY})
  LEFT JOIN (SELECT {KEY}, count(ProcCd) AS pc FROM in_procedure GROUP BY {KEY}) p USING ({KEY})
  WHERE c.RecordIDCd = 'I') b
""",
)

fragment(
    "ref_op_lines",
    f"SELECT c.*, r.RevenueCd, r.RevenueHCPCSCd FROM in_claims c JOIN in_revenue r USING ({KEY}) WHERE c.RecordIDCd = 'O'",
)


def _hcpcs(category: str) -> str:
    return f"l.RevenueHCPCSCd IN (SELECT RevenueHCPCSCd FROM in_bill_rules WHERE Category3 = '{category}')"


fragment(
    "ref_op_candidates",
    f"""
SELECT l.*, 'OUTPATIENT' AS Category1,
  CASE WHEN {_hcpcs('HOME_HEALTH_OP')} OR {_hcpcs('DME_OP')} OR {_hcpcs('AMBULANCE_OP')} THEN 'ANCILLARY'
       WHEN {_hcpcs('OUTPATIENT_OP')} THEN 'OUTPATIENT' ELSE coalesce(b.Category2, 'UNCLASSIFIED') END AS Category2,
  CASE WHEN {_hcpcs('HOME_HEALTH_OP')} THEN 'HOME_HEALTH_OP' WHEN {_hcpcs('DME_OP')} THEN 'DME_OP' WHEN {_hcpcs('AMBULANCE_OP')} THEN 'AMBULANCE_OP'
       WHEN {_hcpcs('OUTPATIENT_OP')} THEN 'OUTPATIENT_OP' ELSE coalesce(b.Category3, 'UNCLASSIFIED') END AS Category3,
  CASE WHEN {_hcpcs('HOME_HEALTH_OP')} THEN 10 WHEN {_hcpcs('DME_OP')} THEN 9 WHEN {_hcpcs('AMBULANCE_OP')} THEN 8
       WHEN {_hcpcs('OUTPATIENT_OP')} THEN 3 ELSE coalesce(b.Category2Rank, 15) END AS Category2Rank,
  CASE WHEN {_hcpcs('HOME_HEALTH_OP')} THEN 10 WHEN {_hcpcs('DME_OP')} THEN 9 WHEN {_hcpcs('AMBULANCE_OP')} THEN 8
       WHEN {_hcpcs('OUTPATIENT_OP')} THEN 3 ELSE coalesce(b.Category3Rank, 15) END AS Category3Rank
FROM ref_op_lines l LEFT JOIN in_bill_rules b
  ON b.Category1 = 'OUTPATIENT' AND b.RevenueCd = l.RevenueCd AND b.RevenueHCPCSCd = l.RevenueHCPCSCd
""",
)
fragment(
    "ref_op",
    f"""
SELECT x.* EXCLUDE (rn, RevenueCd, RevenueHCPCSCd), 1 AS Visit, 1 AS Encounter, 0 AS Procedure_Count, 0 AS Visit_Inpatient_Days,
  coalesce(s.n, 0) AS Service_Count
FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY Category2Rank, Category3Rank, Category3, Category2) AS rn
      FROM ref_op_candidates) x
LEFT JOIN (SELECT RecipientID, DCN, count(*) AS n FROM ref_op_lines WHERE RevenueCd <> '0001' GROUP BY RecipientID, DCN) s USING (RecipientID, DCN)
WHERE rn = 1
""",
)
fragment(
    "ref_nips_candidates",
    f"""
SELECT c.*, n.PlaceOfServiceCd, p.ProcCd, b.PlaceOfServiceCd AS Rule_Place, 'NIPS' AS Category1,
  coalesce(b.Category2, 'OTHER') AS Category2, coalesce(b.Category3, 'OTHER_PROF') AS Category3,
  CASE WHEN n.PlaceOfServiceCd = b.PlaceOfServiceCd THEN 0 ELSE coalesce(b.Category2Rank, 15) END AS Category2Rank,
  coalesce(b.Category3Rank, 15) AS Category3Rank
FROM in_claims c LEFT JOIN in_nips n USING ({KEY}) LEFT JOIN in_procedure p USING ({KEY})
LEFT JOIN in_bill_rules b ON b.Category1 = 'NIPS' AND b.ProcCd = p.ProcCd
WHERE c.RecordIDCd = 'N' AND (n.PlaceOfServiceCd = b.PlaceOfServiceCd OR coalesce(b.PlaceOfServiceCd, '') = '')
""",
)
fragment(
    "ref_nips",
    f"""
SELECT * EXCLUDE (rn, PlaceOfServiceCd, ProcCd, Rule_Place),
  CASE WHEN Category3 IN ('OTHER_OUTPATIENT_VISIT','HOSPITAL_OUTPATIENT_VISIT','OFFICE_VISIT','RURAL_HEALTH_CLINIC_VISIT','HOME_VISIT',
    'TELEPHONE_VISIT','PREVENTIVE_VISIT','OUTPATIENT_CONSULT') THEN 1 ELSE 0 END AS Visit,
  1 AS Encounter, 0 AS Procedure_Count, 0 AS Visit_Inpatient_Days, 1 AS Service_Count
FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY Category2Rank, Category3Rank, Category3, Category2) AS rn
      FROM ref_nips_candidates) WHERE rn = 1
""",
)
fragment(
    "ref_categorized",
    """
SELECT u.*, CASE WHEN NetLiabilityAmt IS NULL THEN EncounterPriceAmt WHEN EncounterPriceAmt IS NULL THEN NetLiabilityAmt
    WHEN NetLiabilityAmt > EncounterPriceAmt THEN NetLiabilityAmt ELSE EncounterPriceAmt END AS AdjustedPriceAmt,
  0 AS Prematurity_Ineligible, m.Summary_Category
FROM (SELECT * FROM ref_ip UNION ALL BY NAME SELECT * FROM ref_op UNION ALL BY NAME SELECT * FROM ref_nips) u
LEFT JOIN in_summary_map m USING (Category1, Category2, Category3)
""",
)


def categorized(t: Inputs) -> DataFrame:
    """Categorized claims as published: staged once, read by every analysis after it."""
    return t.stage("categorized", lambda: categorize(t))


def categorize(t: Inputs) -> DataFrame:
    """Over lines that lie by document, unless a document is hot: its lines would be dealt into one task."""
    dealt = hot_documents([t.in_line]) is None
    if dealt:
        t = t.by_document()
    return cat.categorize_claims(
        t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure, t.in_nips, t.in_bill_rules, t.in_summary_map, dealt
    )


# Filters and predicates.


@register(
    "record_type_split",
    f"{KEY_OUT} RecordIDCd Branch",
    "SELECT *, RecordIDCd AS Branch FROM in_claims WHERE RecordIDCd IN ('I', 'O', 'N')",
)
def _record_type_split(t: Inputs) -> DataFrame:
    inpatient, outpatient, professional = (
        keys.record_type_split(t.in_claims, kind).withColumn("Branch", F.lit(kind)) for kind in "ION"
    )
    return inpatient.unionByName(outpatient).unionByName(professional)


@register("accepted_only", KEY_OUT, "SELECT * FROM in_claims WHERE RejectionStatusCd = 'N'")
def _accepted_only(t: Inputs) -> DataFrame:
    return keys.accepted_only(t.in_claims)


@register(
    "inclusive_between",
    f"{KEY_OUT} ServiceFromDt:d Engagement_Date:d",
    """
    SELECT c.*, p.Engagement_Date FROM in_claims c JOIN in_patient p USING (RecipientID)
    WHERE c.ServiceFromDt >= p.Program_Date AND c.ServiceFromDt <= p.Engagement_Date
    """,
)
def _inclusive_between(t: Inputs) -> DataFrame:
    dated = t.in_claims.join(t.in_patient.select("RecipientID", "Program_Date", "Engagement_Date"), "RecipientID")
    return keys.inclusive_between(dated, "ServiceFromDt", "Program_Date", "Engagement_Date")


@register(
    "half_open_release_window",
    f"{KEY_OUT} ServiceFromDt:d",
    "SELECT * FROM in_claims WHERE ServiceFromDt > DATE '2000-06-30' AND ServiceFromDt <= DATE '2001-08-01'",
)
def _half_open(t: Inputs) -> DataFrame:
    return keys.half_open_release_window(t.in_claims, F.lit(date(2000, 6, 30)), F.lit(date(2001, 8, 1)))


@register(
    "in_list",
    f"{KEY_OUT} RevenueCd RevenueHCPCSCd",
    """
    SELECT * FROM in_revenue WHERE RevenueCd IN ('0450', '0001')
      AND RevenueHCPCSCd IN (SELECT RevenueHCPCSCd FROM in_bill_rules WHERE Category1 = 'OUTPATIENT')
      AND RevenueHCPCSCd NOT IN (SELECT RevenueHCPCSCd FROM in_bill_rules WHERE Category3 = 'OUTPATIENT_OP')
    """,
)
def _in_list(t: Inputs) -> DataFrame:
    rules = t.in_bill_rules
    listed = keys.in_list(t.in_revenue, "RevenueCd", ["0450", "0001"])
    known = rules.where(F.col("Category1") == "OUTPATIENT").select("RevenueHCPCSCd")
    excluded = rules.where(F.col("Category3") == "OUTPATIENT_OP").select("RevenueHCPCSCd")
    return keys.in_list(keys.in_list(listed, "RevenueHCPCSCd", known), "RevenueHCPCSCd", excluded, negate=True)


@register(
    "discharged_home",
    f"{KEY_OUT} AdmissionDt:d DischargeDt:d",
    "SELECT * FROM in_institutional WHERE PatientStatusCd = '01' AND DischargeDt IS NOT NULL",
)
def _discharged_home(t: Inputs) -> DataFrame:
    return keys.discharged_home(t.in_institutional)


# Joins on the claim key.


@register(
    "claim_key_inner",
    f"{KEY_OUT} ServiceFromDt:d UBTypeofBillCd:i",
    f"SELECT * FROM in_claims JOIN in_institutional USING ({KEY})",
)
def _claim_key_inner(t: Inputs) -> DataFrame:
    return keys.claim_key_inner(t.in_claims, t.in_institutional)


@register(
    "claim_key_left",
    f"{KEY_OUT} RecordIDCd PlaceOfServiceCd",
    f"SELECT * FROM in_claims LEFT JOIN in_nips USING ({KEY})",
)
def _claim_key_left(t: Inputs) -> DataFrame:
    return keys.claim_key_left(t.in_claims, t.in_nips)


@register(
    "rule_join_rev",
    f"{KEY_OUT} RevenueCd RevenueHCPCSCd {CATEGORY_OUT}",
    f"""
    SELECT r.*, b.Category1, b.Category2, b.Category3, b.Category2Rank, b.Category3Rank
    FROM in_revenue r LEFT JOIN in_bill_rules b ON b.RevenueCd = r.RevenueCd AND b.RevenueHCPCSCd = r.RevenueHCPCSCd
    """,
)
def _rule_join_rev(t: Inputs) -> DataFrame:
    return cat.rule_join_rev(t.in_revenue, t.in_bill_rules.drop("ProcCd", "PlaceOfServiceCd"))


@register(
    "rule_join_proc",
    f"{KEY_OUT} ProcCd Rule_Place {CATEGORY_OUT}",
    """
    SELECT p.*, b.PlaceOfServiceCd AS Rule_Place, b.Category1, b.Category2, b.Category3, b.Category2Rank, b.Category3Rank
    FROM in_procedure p LEFT JOIN in_bill_rules b ON b.ProcCd = p.ProcCd
    """,
)
def _rule_join_proc(t: Inputs) -> DataFrame:
    return cat.rule_join_proc(t.in_procedure, t.in_bill_rules.drop("RevenueCd", "RevenueHCPCSCd"))


@register(
    "summary_map_join",
    f"{KEY_OUT} {CATEGORY_OUT} Summary_Category",
    """
    SELECT o.*, (SELECT any_value(m.Summary_Category) FROM in_summary_map m
      WHERE m.Category1 = o.Category1 AND m.Category2 = o.Category2 AND m.Category3 = o.Category3) AS Summary_Category FROM ref_op o
    """,
)
def _summary_map_join(t: Inputs) -> DataFrame:
    return cat.summary_map_join(cat.op_categorize(t.in_claims, t.in_revenue, t.in_bill_rules), t.in_summary_map)


# Counts, days and flags.


@register(
    "ip_service_count",
    f"{KEY_OUT} Service_Count:i",
    f"""
    SELECT c.*, s.n AS Service_Count FROM in_claims c
    LEFT JOIN (SELECT {KEY}, count(RevenueCd) AS n FROM in_revenue WHERE RevenueCd <> '0001' GROUP BY {KEY}) s USING ({KEY})
    WHERE c.RecordIDCd = 'I'
    """,
)
def _ip_service_count(t: Inputs) -> DataFrame:
    return keys.claim_key_left(keys.record_type_split(t.in_claims, "I"), cat.ip_service_count(t.in_revenue))


@register(
    "ip_procedure_count",
    f"{KEY_OUT} Procedure_Count:i",
    f"""
    SELECT c.*, (SELECT count(p.ProcCd) FROM in_procedure p WHERE p.DCN = c.DCN AND p.ServiceLineNbr = c.ServiceLineNbr
      AND p.RejectionStatusCd = c.RejectionStatusCd AND p.RecipientID = c.RecipientID AND p.AdjudicatedDt = c.AdjudicatedDt) AS Procedure_Count
    FROM in_claims c WHERE c.RecordIDCd = 'I'
    """,
)
def _ip_procedure_count(t: Inputs) -> DataFrame:
    return cat.ip_procedure_count(keys.record_type_split(t.in_claims, "I"), t.in_procedure)


@register(
    "op_service_count",
    f"{KEY_OUT} Service_Count:i",
    """
    SELECT c.*, coalesce(s.n, 0) AS Service_Count FROM in_claims c
    LEFT JOIN (SELECT RecipientID, DCN, count(RevenueCd) AS n FROM ref_op_lines WHERE RevenueCd <> '0001' GROUP BY ALL) s USING (RecipientID, DCN)
    WHERE c.RecordIDCd = 'O'
    """,
)
def _op_service_count(t: Inputs) -> DataFrame:
    claims = keys.record_type_split(t.in_claims, "O")
    counts = cat.op_service_count(cat.op_lines(t.in_claims, t.in_revenue))
    sized = summarize(claims, keys.DOCUMENT_KEY).join(counts, keys.DOCUMENT_KEY, "left")
    return attach_summary(claims, sized, keys.DOCUMENT_KEY).fillna(0, ["Service_Count"])


@register(
    "inpatient_days",
    f"{KEY_OUT} Visit_Inpatient_Days:i",
    """
    SELECT c.*, CASE WHEN ServiceLineNbr = max(ServiceLineNbr) OVER w THEN
      date_diff('day', min(ServiceFromDt) OVER w, max(ServiceThruDt) OVER w) + 1 ELSE 0 END AS Visit_Inpatient_Days
    FROM in_claims c WHERE RecordIDCd = 'I' WINDOW w AS (PARTITION BY RecipientID, DCN)
    """,
)
def _inpatient_days(t: Inputs) -> DataFrame:
    return cat.ip_visit_encounter_days(keys.record_type_split(t.in_claims, "I"))


@register(
    "max_line_flag",
    f"{KEY_OUT} Is_Last:b",
    """
    SELECT c.*, ServiceLineNbr = max(ServiceLineNbr) OVER (PARTITION BY RecipientID, DCN, RejectionStatusCd) AS Is_Last FROM in_claims c
    """,
)
def _max_line_flag(t: Inputs) -> DataFrame:
    group = [*keys.DOCUMENT_KEY, "RejectionStatusCd"]
    last = summarize(t.in_claims, group, F.max("ServiceLineNbr").alias("_last"))
    return attach_summary(t.in_claims, last, group).withColumn("Is_Last", F.col("ServiceLineNbr") == F.col("_last"))


# Categorization.


@register("ip_categorize", BRANCH_OUT, "SELECT * FROM ref_ip")
def _ip_categorize(t: Inputs) -> DataFrame:
    return cat.ip_categorize(t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure)


@register(
    "ip_visit_encounter",
    f"{KEY_OUT} Visit:i Encounter:i",
    """
    SELECT c.*, CASE WHEN m.last = c.ServiceLineNbr THEN 1 ELSE 0 END AS Visit, CASE WHEN m.last = c.ServiceLineNbr THEN 1 ELSE 0 END AS Encounter
    FROM in_claims c JOIN (SELECT RecipientID, DCN, RejectionStatusCd, max(ServiceLineNbr) AS last FROM in_claims WHERE RecordIDCd = 'I' GROUP BY ALL) m
      USING (RecipientID, DCN, RejectionStatusCd) WHERE c.RecordIDCd = 'I'
    """,
)
def _ip_visit_encounter(t: Inputs) -> DataFrame:
    return cat.ip_visit_encounter_days(keys.record_type_split(t.in_claims, "I"))


@register("op_categorize", BRANCH_OUT, "SELECT * FROM ref_op")
def _op_categorize(t: Inputs) -> DataFrame:
    return cat.op_categorize(t.in_claims, t.in_revenue, t.in_bill_rules)


@register(
    "best_rank_per_claim",
    f"{KEY_OUT} {CATEGORY_OUT}",
    f"""
    SELECT DISTINCT ON ({KEY}) * FROM ref_op_candidates
    ORDER BY {KEY}, Category2Rank, Category3Rank, Category3, Category2
    """,
)
def _best_rank(t: Inputs) -> DataFrame:
    return cat.op_best(cat.op_lines(t.in_claims, t.in_revenue), t.in_bill_rules)


@register("nips_categorize", BRANCH_OUT, "SELECT * FROM ref_nips")
def _nips_categorize(t: Inputs) -> DataFrame:
    return cat.nips_categorize(t.in_claims, t.in_nips, t.in_procedure, t.in_bill_rules)


@register(
    "nips_visit",
    "Category3 Visit:i Encounter:i Service_Count:i Lines:i",
    "SELECT Category3, Visit, Encounter, Service_Count, count(*) AS Lines FROM ref_nips GROUP BY ALL",
)
def _nips_visit(t: Inputs) -> DataFrame:
    best = cat.nips_best(t.in_claims, t.in_nips, t.in_procedure, t.in_bill_rules)
    return cat.nips_visit(best).groupBy("Category3", "Visit", "Encounter", "Service_Count").agg(F.count(F.lit(1)).alias("Lines"))


@register(
    "op_constants",
    f"{KEY_OUT} Visit:i Encounter:i Procedure_Count:i Visit_Inpatient_Days:i",
    "SELECT *, 1 AS Visit, 1 AS Encounter, 0 AS Procedure_Count, 0 AS Visit_Inpatient_Days FROM in_claims WHERE RecordIDCd = 'O'",
)
def _op_constants(t: Inputs) -> DataFrame:
    return cat.op_constants(keys.record_type_split(t.in_claims, "O"))


PUBLISHED_OUT = (
    f"{KEY_OUT} AdjustedPriceAmt:m Category1 Category2 Category3 Summary_Category Category2Rank:f1 Category3Rank:f1 "
    f"{COUNT_OUT} Prematurity_Ineligible:i"
)


@register("claims_categorized", PUBLISHED_OUT, "SELECT * FROM ref_categorized")
def _claims_categorized(t: Inputs) -> DataFrame:
    return cat.claims_categorized(categorize(t))


@register("categorized_refresh", PUBLISHED_OUT, "SELECT * FROM ref_categorized")
def _categorized_refresh(t: Inputs) -> DataFrame:
    """Three releases, dealt by claim so that documents run through them, each added to the table the ones before left."""
    dealt = hot_documents([t.in_line]) is None
    buckets = t.document_buckets() if dealt else None
    t = t.by_document() if dealt else t
    tables = ClaimTables(t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure, t.in_nips)
    release = F.pmod(F.xxhash64(*keys.CLAIM_KEY), F.lit(3))

    def of(condition: Column) -> ClaimTables:
        return ClaimTables(*[table.where(condition) for table in tables])

    def kept(current: DataFrame) -> DataFrame:
        return written_dealt(current, "categorized", DEALT_BY, buckets) if dealt else written(current, "categorized")

    current = cat.categorize_claims(*of(release == 0), t.in_bill_rules, t.in_summary_map, dealt)
    for number in (1, 2):
        current = refresh(kept(current), of(release < number), of(release == number), t.in_bill_rules, t.in_summary_map, buckets)
    return cat.claims_categorized(current)


@register(
    "presentation_sort",
    "RecordIDCd RecipientID Lines:i",
    "SELECT RecordIDCd, RecipientID, count(*) AS Lines FROM in_claims GROUP BY ALL ORDER BY RecordIDCd, RecipientID",
)
def _presentation_sort(t: Inputs) -> DataFrame:
    counted = t.in_claims.groupBy("RecordIDCd", "RecipientID").agg(F.count(F.lit(1)).alias("Lines"))
    return cat.presentation_sort(counted, "RecordIDCd", "RecipientID")


# Set operations.


@register(
    "union_all",
    "RecipientID Kind Code",
    "SELECT RecipientID, 'dx' AS Kind, DiagCd AS Code FROM in_diagnosis UNION ALL SELECT RecipientID, 'proc', ProcCd FROM in_procedure",
)
def _union_all(t: Inputs) -> DataFrame:
    dx = t.in_diagnosis.select("RecipientID", F.lit("dx").alias("Kind"), F.col("DiagCd").alias("Code"))
    proc = t.in_procedure.select(F.col("ProcCd").alias("Code"), "RecipientID", F.lit("proc").alias("Kind"))
    return dx.unionByName(proc)


@register(
    "union_distinct",
    "RecipientID ServiceFromDt:d Category",
    """
    SELECT RecipientID, ServiceFromDt, 'IP' AS Category FROM in_claims WHERE RecordIDCd = 'I'
    UNION SELECT RecipientID, ServiceFromDt, 'OP' FROM in_claims WHERE RecordIDCd <> 'N'
    """,
)
def _union_distinct(t: Inputs) -> DataFrame:
    ip = t.in_claims.where(F.col("RecordIDCd") == "I").select("RecipientID", "ServiceFromDt", F.lit("IP").alias("Category"))
    op = t.in_claims.where(F.col("RecordIDCd") != "N").select("RecipientID", "ServiceFromDt", F.lit("OP").alias("Category"))
    return ip.union(op).distinct()
