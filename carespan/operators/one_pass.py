"""All three claim branches in one pass over the detail tables.

Claims and their details are dealt by document once, each row as narrow as it can be; what a claim gets from its
details and from the other lines of its document is then worked out within the partition, whatever the branch, and the branch is a
condition on the row. Rows of a document with HOT_ROWS rows or more take another way: revenue lines, procedures and places are each
reduced to one row per claim key, combining before they are sent, and joined to the claims. What a
claim collects is bounded by the rule table (distinct rule sets, places), never by its lines.
The result equals the branches' own operators, one after another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carespan.functions import skew
from carespan.functions.skew import attach_summary, summarize
from carespan.operators import categorize as branch
from carespan.operators.keys import CLAIM_KEY, DOCUMENT_KEY, claim_key_left


# No rule and no override: behind every outcome.
_UNRULED = 2**31
_BUCKETS = 1 << 16


def revenue_lines(revenue: DataFrame, rules: DataFrame, outcomes: Column) -> DataFrame:
    """Per revenue line: its outpatient outcome, whether it is an emergency, a service, and a service with a code."""
    op_rules = rules.where(F.col("Category1") == "OUTPATIENT").withColumn("outcomes", outcomes)
    ranked = (
        op_rules.select(
            "RevenueCd", "RevenueHCPCSCd", F.array_position("outcomes", branch._rule_outcome(*branch._OP_DEFAULT)).alias("r")
        )
        .groupBy("RevenueCd", "RevenueHCPCSCd")
        .agg(F.min("r").alias("_rule"))
    )
    overrides = branch.hcpcs_overrides(rules.where(F.col("Category1") == "OUTPATIENT"), outcomes)
    lines = revenue.select(*CLAIM_KEY, "RevenueCd", "RevenueHCPCSCd")
    # Rules are few, lines are not: these joins must not shuffle them.
    placed = branch.rule_join_rev(lines, F.broadcast(ranked)).join(F.broadcast(overrides), "RevenueHCPCSCd", "left")
    service = ~F.col("RevenueCd").eqNullSafe(F.lit(branch.NOT_A_SERVICE_REVENUE_CODE))
    emergency = F.coalesce(F.col("RevenueCd").isin(branch.EMERGENCY_REVENUE_CODES), F.lit(False))
    return placed.select(
        *CLAIM_KEY,
        F.coalesce("_override", "_rule", F.lit(_UNRULED)).alias("op"),
        emergency.alias("emergency"),
        service.alias("service"),
        (service & F.col("RevenueCd").isNotNull()).alias("coded"),
    )


def _of_revenue(line: Column) -> dict[str, Column]:
    """What a claim takes from its revenue lines: best outcome, emergency flag, counts of both branches."""
    return {
        "_op": F.min(line["op"]),
        "_emergency": F.bool_or(line["emergency"]),
        "_counted": F.count_if(line["service"]),
        "_services": F.count_if(line["coded"]),
    }


def revenue_summary(revenue: DataFrame, rules: DataFrame, outcomes: Column) -> DataFrame:
    """Per claim: best outpatient outcome, emergency flag and the counts of both branches."""
    lines = revenue_lines(revenue, rules, outcomes)
    line = F.struct("op", "emergency", "service", "coded")
    return lines.groupBy(*CLAIM_KEY).agg(*[c.alias(n) for n, c in _of_revenue(line).items()])


def _rule_entries() -> Column:
    """A single rule entry that names nothing."""
    return F.array(F.struct(F.lit(None).cast("string").alias("place"), F.lit(None).cast("long").alias("anywhere"), F.lit(None).cast("long").alias("there")))


def procedure_rules(rules: DataFrame, outcomes: Column) -> DataFrame:
    """Professional rules of each procedure code as an array of (place, anywhere, there)."""
    nips_rules = rules.where(F.col("Category1") == "NIPS").withColumn("outcomes", outcomes)
    return (
        nips_rules.select(
            "ProcCd",
            F.col("PlaceOfServiceCd").alias("place"),
            F.array_position("outcomes", branch._rule_outcome(*branch._NIPS_DEFAULT)).alias("r"),
            F.array_position("outcomes", branch._at_place()).alias("m"),
        )
        .groupBy("ProcCd", "place")
        .agg(F.min("r").alias("anywhere"), F.min("m").alias("there"))
        .groupBy("ProcCd")
        .agg(F.collect_list(F.struct("place", "anywhere", "there")).alias("rules"))
    )


def procedure_summary(procedures: DataFrame, rules: DataFrame, outcomes: Column) -> DataFrame:
    """Per claim: coded procedures, and the professional rules of their codes as (place, anywhere, there)."""
    lines = procedures.select(*CLAIM_KEY, "ProcCd").join(procedure_rules(rules, outcomes), "ProcCd", "left")
    return lines.groupBy(*CLAIM_KEY).agg(
        F.count("ProcCd").alias("_procedures"),
        F.array_distinct(F.flatten(F.collect_set(F.coalesce("rules", _rule_entries())))).alias("_rules"),
    )


def place_summary(nips: DataFrame) -> DataFrame:
    """Per claim: its distinct places; a missing one counts as a place without a name."""
    place = F.struct(F.col("PlaceOfServiceCd").alias("p"))
    return nips.groupBy(*CLAIM_KEY).agg(F.transform(F.collect_set(place), lambda x: x["p"]).alias("_places"))


def _nips_outcome() -> Column:
    """Best outcome over the claim's places and rules; NULL where every rule names another place."""
    rules = F.coalesce(F.col("_rules"), _rule_entries())
    places = F.coalesce(F.col("_places"), F.array(F.lit(None).cast("string")))

    def at(place: Column) -> Column:
        matches = lambda r: F.coalesce(place == r["place"], F.lit(False))
        fitting = F.filter(rules, lambda r: matches(r) | (F.coalesce(r["place"], F.lit("")) == ""))
        return F.transform(
            fitting, lambda r: F.when(matches(r), r["there"]).otherwise(F.coalesce(r["anywhere"], F.col("_nips_default")))
        )

    return F.array_min(F.flatten(F.transform(places, at)))


def hot_documents(tables: list[DataFrame]) -> DataFrame | None:
    """Documents with HOT_ROWS rows or more in all the tables; None when there are none, as nearly always.

    Rows are counted by a hash of their document first, which sends next to nothing; only documents of a bucket with that many rows are
    counted themselves. There are at most total / HOT_ROWS.
    """
    documents = reduce(DataFrame.unionAll, [t.select(*DOCUMENT_KEY) for t in tables])
    bucket = F.pmod(F.xxhash64(*DOCUMENT_KEY), F.lit(_BUCKETS))
    full = documents.groupBy(bucket.alias("bucket")).count().where(F.col("count") >= skew.HOT_ROWS)
    buckets = [r.bucket for r in full.collect()]
    if not buckets:
        return None
    counted = documents.where(bucket.isin(buckets)).groupBy(*DOCUMENT_KEY).count()
    rows = counted.where(F.col("count") >= skew.HOT_ROWS).select(*DOCUMENT_KEY).collect()
    return documents.sparkSession.createDataFrame(rows, documents.schema) if rows else None


def _of_documents(table: DataFrame, documents: DataFrame, how: str) -> DataFrame:
    """Semi or anti join; a NULL is equal to a NULL."""
    named = documents.select(*[F.col(c).alias(f"_{c}") for c in DOCUMENT_KEY])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DOCUMENT_KEY])
    return table.join(F.broadcast(named), same, how)


def categorize_all(
    claims: DataFrame,
    institutional: DataFrame,
    revenue: DataFrame,
    procedures: DataFrame,
    nips: DataFrame,
    rules: DataFrame,
    dealt: bool = False,
) -> DataFrame:
    """Claim columns with categories and counts of all branches. ``dealt``: the tables lie by document already."""
    tables = [claims.where(F.col("RecordIDCd").isin("I", "O", "N")), institutional, revenue, procedures, nips]
    hot = hot_documents(tables)
    if hot is None:
        return _within_documents(*tables, rules, dealt)
    even = _within_documents(*[_of_documents(t, hot, "left_anti") for t in tables], rules, dealt)
    return even.unionByName(_by_claim_key(*[_of_documents(t, hot, "left_semi") for t in tables], rules))


def _within_documents(
    claims: DataFrame,
    institutional: DataFrame,
    revenue: DataFrame,
    procedures: DataFrame,
    nips: DataFrame,
    rules: DataFrame,
    dealt: bool = False,
) -> DataFrame:
    """One shuffle of claims and details by document, none if they lie so; windows over claim keys and documents stay in the partition.

    Said of tables that don't, ``dealt`` only makes the windows shuffle by themselves.
    """
    op_outcomes = branch.op_outcomes(rules.where(F.col("Category1") == "OUTPATIENT"))
    nips_outcomes = branch.nips_outcomes(rules.where(F.col("Category1") == "NIPS"))
    own = [c for c in claims.columns if c not in CLAIM_KEY]
    parts = {
        "_claim": claims.select(*CLAIM_KEY, F.struct(*own).alias("_claim")),
        "_bill": institutional.select(*CLAIM_KEY, F.struct("UBTypeofBillCd").alias("_bill")),
        "_line": revenue_lines(revenue, rules, op_outcomes).select(*CLAIM_KEY, F.struct("op", "emergency", "service", "coded").alias("_line")),
        "_procedure": procedures.select(*CLAIM_KEY, F.struct("ProcCd").alias("_procedure")),
        "_place": nips.select(*CLAIM_KEY, F.struct(F.col("PlaceOfServiceCd").alias("p")).alias("_place")),
    }
    types = {name: part.schema[name].dataType for name, part in parts.items()}

    def wide(name: str, part: DataFrame) -> DataFrame:
        # A detail with a NULL in its key belongs to no claim.
        matched = part if name == "_claim" else part.dropna(subset=CLAIM_KEY)
        return matched.select(*CLAIM_KEY, *[F.col(n) if n == name else F.lit(None).cast(types[n]).alias(n) for n in types])

    together = reduce(DataFrame.unionAll, [wide(n, p) for n, p in parts.items()])
    by_document = together if dealt else together.repartition(*DOCUMENT_KEY)
    ranked = procedure_rules(rules, nips_outcomes).withColumnRenamed("ProcCd", "_ProcCd")
    ruled = by_document.join(F.broadcast(ranked), F.col("_procedure.ProcCd") == F.col("_ProcCd"), "left")
    rules_of = F.when(F.col("_procedure").isNotNull(), F.coalesce("rules", _rule_entries()))
    of_claim = W.partitionBy(*DOCUMENT_KEY, *[c for c in CLAIM_KEY if c not in DOCUMENT_KEY])
    taken = {
        "_bills": F.collect_list("_bill"),
        **_of_revenue(F.col("_line")),
        "_procedures": F.count("_procedure.ProcCd"),
        "_rules": F.collect_set(rules_of),
        "_places": F.collect_set("_place"),
    }
    joined = ruled.select(*CLAIM_KEY, "_claim", *[c.over(of_claim).alias(n) for n, c in taken.items()]).where(F.col("_claim").isNotNull())
    bill = F.explode_outer("_bills").alias("_bill")
    named = joined.select(*CLAIM_KEY, "_claim.*", *[n for n in taken if n != "_bills"], bill).withColumns(
        {
            "UBTypeofBillCd": F.col("_bill.UBTypeofBillCd"),
            "_billed": F.col("_bill").isNotNull(),
            "_rules": F.when(F.size("_rules") > 0, F.array_distinct(F.flatten("_rules"))),
            "_places": F.when(F.size("_places") > 0, F.col("_places.p")),
        }
    )
    # Counts of a document's lines go by branch, as a document may hold more than one. They are taken before claims
    # without an outcome leave.
    counted = named.where((F.col("RecordIDCd") != "I") | F.col("_billed"))
    document = W.partitionBy(*DOCUMENT_KEY, "RecordIDCd")
    status = W.partitionBy(*DOCUMENT_KEY, "RecordIDCd", "RejectionStatusCd")
    known = F.col("RecipientID").isNotNull() & F.col("DCN").isNotNull()
    stay = F.datediff(F.max("ServiceThruDt").over(document), F.min("ServiceFromDt").over(document)) + 1
    with_summary = counted.withColumns(
        {
            "_last": F.when(known & F.col("RejectionStatusCd").isNotNull(), F.max("ServiceLineNbr").over(status)),
            "_last_of_document": F.when(known, F.max("ServiceLineNbr").over(document)),
            "_stay": F.when(known, stay),
            "_op_services": F.when(known, F.sum("_services").over(document)),
        }
    )
    rows = _with_outcomes(with_summary, op_outcomes, nips_outcomes)
    return _named(rows, claims.columns)


def _with_outcomes(rows: DataFrame, op_outcomes: Column, nips_outcomes: Column) -> DataFrame:
    """The outcome each branch gives; claims without one, and unbilled inpatient claims, leave."""
    nips_default = branch._fixed_outcome(branch.UNRANKED, *branch._NIPS_DEFAULT)
    rows = rows.withColumns({"_op_outcomes": op_outcomes, "_nips_outcomes": nips_outcomes})
    rows = rows.withColumn("_nips_default", F.array_position("_nips_outcomes", nips_default))
    rows = rows.withColumn("_nips", _nips_outcome())
    kinds = F.col("RecordIDCd")
    return rows.where(
        F.when(kinds == "I", F.col("_billed")).when(kinds == "O", F.col("_op").isNotNull()).otherwise(F.col("_nips").isNotNull())
    )


def _by_claim_key(
    claims: DataFrame, institutional: DataFrame, revenue: DataFrame, procedures: DataFrame, nips: DataFrame, rules: DataFrame
) -> DataFrame:
    """Details reduced to a row per claim key and joined: no task holds all rows of a document."""
    op_outcomes = branch.op_outcomes(rules.where(F.col("Category1") == "OUTPATIENT"))
    nips_outcomes = branch.nips_outcomes(rules.where(F.col("Category1") == "NIPS"))
    billed = claim_key_left(claims, institutional.select(*CLAIM_KEY, "UBTypeofBillCd", F.lit(True).alias("_billed")))
    with_revenue = claim_key_left(billed, revenue_summary(revenue, rules, op_outcomes))
    joined = claim_key_left(with_revenue, procedure_summary(procedures, rules, nips_outcomes))
    rows = _with_outcomes(claim_key_left(joined, place_summary(nips)), op_outcomes, nips_outcomes)
    # Counts of a document's lines go by branch, as a document may hold more than one.
    document = [*DOCUMENT_KEY, "RecordIDCd"]
    summary = _document_summary(with_revenue.where((F.col("RecordIDCd") != "I") | F.col("_billed")), document)
    with_summary = attach_summary(rows, summary, document)
    last = F.try_element_at("_last_of_status", F.col("RejectionStatusCd"))
    return _named(with_summary.withColumn("_last", last), claims.columns)


def _named(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Categories and counts out of a claim's outcomes and the summary of its document."""
    kinds = F.col("RecordIDCd")
    default = branch._fixed_outcome(branch.UNRANKED, *branch._OP_DEFAULT)
    op_place = F.when(F.col("_op") < _UNRULED, F.col("_op")).otherwise(F.array_position("_op_outcomes", default))
    chosen = F.when(kinds == "O", F.try_element_at("_op_outcomes", op_place.cast("int"))).otherwise(
        F.try_element_at("_nips_outcomes", F.col("_nips").cast("int"))
    )
    bill = branch.bill_type_category(F.col("UBTypeofBillCd").cast("int"))
    inpatient = kinds == "I"
    is_last = F.coalesce((F.col("ServiceLineNbr") == F.col("_last")).cast("int"), F.lit(0))
    stay = F.when(F.col("ServiceLineNbr") == F.col("_last_of_document"), F.col("_stay"))
    visited = F.col("_chosen.Category3").isin(branch.VISIT_CATEGORIES).cast("int")
    services = F.when(F.col("_counted") > 0, F.col("_services"))
    out = rows.withColumn("_chosen", chosen).withColumns(
        {
            "Category1": F.when(inpatient, "INPATIENT").when(kinds == "O", "OUTPATIENT").otherwise("NIPS"),
            "Category2": F.when(inpatient, bill).otherwise(F.col("_chosen.Category2")),
            "Category3": F.when(inpatient, F.when(F.col("_emergency"), "EMERGENCY_IP").otherwise(F.concat(bill, F.lit("_IP")))).otherwise(
                F.col("_chosen.Category3")
            ),
            "Category2Rank": F.when(inpatient, branch.INPATIENT_RANK).otherwise(F.col("_chosen.Category2Rank")),
            "Category3Rank": F.when(inpatient, branch.INPATIENT_RANK).otherwise(F.col("_chosen.Category3Rank")),
            "Visit": F.when(inpatient, is_last).when(kinds == "O", 1).otherwise(visited),
            "Service_Count": F.when(inpatient, services).when(kinds == "O", F.coalesce("_op_services", F.lit(0))).otherwise(1).cast("long"),
            "Procedure_Count": F.when(inpatient, F.coalesce("_procedures", F.lit(0))).otherwise(0).cast("long"),
            "Encounter": F.when(inpatient, is_last).otherwise(1),
            "Visit_Inpatient_Days": F.when(inpatient, F.coalesce(stay, F.lit(0))).otherwise(0),
        }
    )
    return out.select(*columns, *branch.CATEGORY_COLUMNS, *branch.COUNT_COLUMNS)


def _document_summary(rows: DataFrame, document: list[str]) -> DataFrame:
    """Per document and branch: last lines, length of stay, counted revenue lines of outpatient claims."""
    by_status = summarize(
        rows,
        [*document, "RejectionStatusCd"],
        F.max("ServiceLineNbr").alias("_last"),
        F.min("ServiceFromDt").alias("_from"),
        F.max("ServiceThruDt").alias("_thru"),
        F.sum("_services").alias("_op_services"),
    )
    entry = F.when(F.col("RejectionStatusCd").isNotNull(), F.struct("RejectionStatusCd", "_last"))
    return by_status.groupBy(*document).agg(
        F.max("_last").alias("_last_of_document"),
        F.map_from_entries(F.collect_list(entry)).alias("_last_of_status"),
        (F.datediff(F.max("_thru"), F.min("_from")) + 1).alias("_stay"),
        F.sum("_op_services").alias("_op_services"),
        F.sum("_rows").alias("_rows"),
    )
