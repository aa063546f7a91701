"""Hand-worked claims: categories, counts, visits, days, ties and lost lines."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carespan.functions import skew
from carespan.operators import categorize as cat
from carespan.operators.keys import CLAIM_KEY, in_list

KEY_TYPES = "DCN string, ServiceLineNbr string, RejectionStatusCd string, RecipientID string, AdjudicatedDt date"
DAY = date(2016, 3, 1)
RULES = (
    "Category1 string, Category2 string, Category3 string, Category2Rank double, Category3Rank double, "
    "RevenueCd string, RevenueHCPCSCd string, ProcCd string, PlaceOfServiceCd string"
)


def key(document, line, status="N", patient="000000001"):
    return (document, line, status, patient, DAY)


def claims(spark, rows):
    """rows: (key, record type, from, thru, encounter, net)"""
    schema = f"{KEY_TYPES}, RecordIDCd string, ServiceFromDt date, ServiceThruDt date, EncounterPriceAmt decimal(18,2), NetLiabilityAmt decimal(18,2)"
    money = lambda v: None if v is None else Decimal(v)
    return spark.createDataFrame([(*k, kind, a, b, money(e), money(n)) for k, kind, a, b, e, n in rows], schema)


def detail(spark, columns, rows):
    return spark.createDataFrame([(*k, *values) for k, *values in rows], f"{KEY_TYPES}, {columns}")


def one(df, document, line="01"):
    (row,) = df.where((F.col("DCN") == document) & (F.col("ServiceLineNbr") == line)).collect()
    return row


@pytest.mark.parametrize(
    "bill_type, category",
    [(111, "INPATIENT"), (129, "INPATIENT"), (110, "OTHER"), (120, "OTHER"), (131, "OTHER"), (211, "SNF"), (289, "SNF"),
     (280, "OTHER"), (291, "OTHER"), (811, "HOSPICE"), (829, "HOSPICE"), (831, "OTHER")],
)
def test_bill_type(spark, bill_type, category):
    (row,) = spark.range(1).select(cat.bill_type_category(F.lit(bill_type)).alias("c")).collect()
    assert row.c == category


def test_inpatient(spark):
    a1, a2, b1, c1 = key("A", "01"), key("A", "02", "Y"), key("B", "01"), key("C", "01")
    df = cat.ip_categorize(
        claims(
            spark,
            [
                (a1, "I", date(2016, 1, 1), date(2016, 1, 3), "5", "7"),
                (a2, "I", date(2016, 1, 2), date(2016, 1, 6), "5", "7"),
                (b1, "I", date(2016, 2, 1), date(2016, 2, 1), "5", "7"),
                (c1, "I", date(2016, 2, 1), date(2016, 2, 1), "5", "7"),  # no institutional row
                (key("D", "01"), "O", DAY, DAY, "1", "1"),
            ],
        ),
        detail(spark, "UBTypeofBillCd int", [(a1, 111), (a2, 811), (b1, 211)]),
        detail(spark, "RevenueCd string, RevenueHCPCSCd string", [(a1, "0450", ""), (a1, "0001", ""), (a1, "0300", ""), (b1, "0001", "")]),
        detail(spark, "ProcCd string", [(a1, "P1"), (a1, None), (a1, "P2")]),
    )
    assert {(r.DCN, r.ServiceLineNbr) for r in df.collect()} == {("A", "01"), ("A", "02"), ("B", "01")}
    first, second, other = one(df, "A", "01"), one(df, "A", "02"), one(df, "B")
    assert (first.Category2, first.Category3) == ("INPATIENT", "EMERGENCY_IP")
    assert (second.Category2, second.Category3) == ("HOSPICE", "HOSPICE_IP")
    assert (other.Category2, other.Category3) == ("SNF", "SNF_IP")
    assert (first.Service_Count, second.Service_Count, other.Service_Count) == (2, None, None)
    assert (first.Procedure_Count, second.Procedure_Count) == (2, 0)
    # Each rejection status has its own last line; days sit on the document's last line only.
    assert (first.Visit, second.Visit) == (1, 1)
    assert (first.Visit_Inpatient_Days, second.Visit_Inpatient_Days) == (0, 6)
    assert other.Visit_Inpatient_Days == 1


def test_all_lines_tied_for_last_are_visits(spark):
    rows = [(("A", "02", "N", "p", date(2016, 1, d)), "I", DAY, DAY, None, "1") for d in (1, 2)]
    flagged = cat.ip_visit_encounter_days(claims(spark, rows))
    assert [r.Visit for r in flagged.collect()] == [1, 1]


OP_RULES = [
    ("OUTPATIENT", "EMERGENCY", "EMERGENCY_OP", 1.0, 1.0, "0450", "H1", None, None),
    ("OUTPATIENT", "CLINIC", "CLINIC_OP", 4.0, 4.0, "0300", "H1", None, None),
    ("OUTPATIENT", "LAB", "ALAB_OP", 4.0, 4.0, "0300", "H1", None, None),
    ("OUTPATIENT", "OUTPATIENT", "OUTPATIENT_OP", 3.0, 3.0, "0999", "H2", None, None),
    ("OUTPATIENT", "ANCILLARY", "AMBULANCE_OP", 8.0, 8.0, "0999", "H2", None, None),
    ("OUTPATIENT", "ANCILLARY", "HOME_HEALTH_OP", 10.0, 10.0, "0999", "H3", None, None),
]


def test_outpatient(spark):
    a1, a2, b1, c1, d1 = key("A", "01"), key("A", "02"), key("B", "01"), key("C", "01"), key("D", "01")
    df = cat.op_categorize(
        claims(spark, [(k, "O", DAY, DAY, "5", "7") for k in (a1, a2, b1, c1, d1)]),
        detail(
            spark,
            "RevenueCd string, RevenueHCPCSCd string",
            [(a1, "0300", "H1"), (a1, "0001", "H9"), (a2, "0450", "H1"), (a2, "0300", "H3"), (b1, "0450", "H2"), (c1, "0777", "H8")],
        ),
        spark.createDataFrame(OP_RULES, RULES),
    )
    assert df.count() == 4  # D has no revenue line
    assert one(df, "A", "01").Category3 == "ALAB_OP"  # ranks tie, the name decides
    assert one(df, "A", "02").Category3 == "EMERGENCY_OP"  # rank 1 beats the override's 10
    assert (one(df, "B").Category3, one(df, "B").Category2Rank) == ("AMBULANCE_OP", 8.0)  # last override, any revenue code
    assert (one(df, "C").Category2, one(df, "C").Category2Rank) == ("UNCLASSIFIED", 15.0)
    # Per document, repeated on each of its lines.
    assert (one(df, "A", "01").Service_Count, one(df, "A", "02").Service_Count) == (3, 3)


def test_professional(spark):
    rules = [
        ("NIPS", "VISIT", "OFFICE_VISIT", 2.0, 2.0, None, None, "P1", "11"),
        ("NIPS", "VISIT", "HOME_VISIT", 3.0, 3.0, None, None, "P1", "12"),
        ("NIPS", "DRUG", "DRUG_PROF", 6.0, 6.0, None, None, "P2", ""),
        ("NIPS", "LAB", "LAB_PROF", 1.0, 1.0, None, None, "P2", None),
        ("NIPS", "VISIT", "HOME_VISIT", 9.0, 9.0, None, None, "P2", "11"),
    ]
    a, b, c, d, e = (key(x, "01") for x in "ABCDE")
    df = cat.nips_categorize(
        claims(spark, [(k, "N", DAY, DAY, "5", "7") for k in (a, b, c, d, e)]),
        detail(spark, "PlaceOfServiceCd string", [(a, "11"), (b, "99"), (c, "11"), (d, "22")]),
        detail(spark, "ProcCd string", [(a, "P1"), (b, "P1"), (c, "P2"), (d, "P2")]),
        spark.createDataFrame(rules, RULES),
    )
    assert one(df, "A").Category3 == "OFFICE_VISIT" and one(df, "A").Category2Rank == 0.0
    assert df.where("DCN = 'B'").count() == 0  # every rule of its procedure names another place
    assert one(df, "C").Category3 == "HOME_VISIT"  # the matching place comes first despite rank 9
    assert one(df, "D").Category3 == "LAB_PROF"
    assert (one(df, "E").Category3, one(df, "E").Visit) == ("OTHER_PROF", 0)
    assert (one(df, "A").Visit, one(df, "D").Visit) == (1, 0)


def test_price_takes_the_larger_known_amount(spark):
    rows = [
        (key("A", "01"), "N", DAY, DAY, "5.10", "7.20"),
        (key("B", "01"), "N", DAY, DAY, "5.10", None),
        (key("C", "01"), "N", DAY, DAY, None, None),
    ]
    empty = lambda columns: spark.createDataFrame([], f"{KEY_TYPES}, {columns}")
    df = cat.categorize_claims(
        claims(spark, rows),
        empty("UBTypeofBillCd int"),
        empty("RevenueCd string, RevenueHCPCSCd string"),
        empty("ProcCd string"),
        empty("PlaceOfServiceCd string"),
        spark.createDataFrame([], RULES),
        spark.createDataFrame([("NIPS", "OTHER", "OTHER_PROF", "OTHER")], "Category1 string, Category2 string, Category3 string, Summary_Category string"),
    )
    assert {r.DCN: r.AdjustedPriceAmt for r in df.collect()} == {"A": Decimal("7.20"), "B": Decimal("5.10"), "C": None}
    assert {r.Summary_Category for r in df.collect()} == {"OTHER"}


def test_results_do_not_depend_on_row_order_or_partitions(spark):
    lines = [(key(f"D{i % 7}", f"{i:02d}", "NY"[i % 2], f"p{i % 3}"), "I", date(2016, 1, 1 + i % 28), date(2016, 2, 1), "1", "2") for i in range(60)]
    df = claims(spark, lines)
    shuffled = df.orderBy(F.xxhash64("DCN", "ServiceLineNbr")).repartition(7)
    collect = lambda d: sorted(map(tuple, cat.ip_visit_encounter_days(d).collect()), key=str)
    assert collect(df) == collect(shuffled)


def test_attach_summary_with_a_hot_key(spark, monkeypatch):
    """A key with a third of all rows, many cold keys and a NULL key: same as a plain left join."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 1900)).alias("k"),
        "id",
    )
    for hot_rows, most_hot in ((1_000_000, 100_000), (3, 100_000), (50, 4)):
        monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(skew, "MOST_HOT", most_hot)
        summary = skew.summarize(rows, ["k"], F.max("id").alias("top"))
        ours = skew.attach_summary(rows, summary, ["k"])
        plain = rows.join(summary.drop("_rows"), "k", "left")
        assert ours.count() == 6000
        assert ours.exceptAll(plain.select(*ours.columns)).count() == 0


def test_hot_rows_are_dealt_over_partitions(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    attached = skew.attach_summary(rows, skew.summarize(rows, ["k"], F.max("id").alias("top")), ["k"])
    plan = attached._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "Window" not in plan and "CartesianProduct" not in plan


def test_in_list_negation_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    values = spark.createDataFrame([("a",)], "v string")
    for listed in (["a"], values):
        assert {r.x for r in in_list(df, "x", listed, negate=True).collect()} == {"b", None}
        assert {r.x for r in in_list(df, "x", listed).collect()} == {"a"}


def test_one_row_per_claim_key(spark):
    from carespan.queries.claims import categorize
    from carespan.queries.registry import Inputs

    df = categorize(Inputs(spark, "/root/testdata/sf0.001"))
    assert df.groupBy(*CLAIM_KEY).count().where("count > 1").count() == 0


def test_one_pass_equals_the_branches(spark):
    from carespan.operators.one_pass import categorize_all
    from carespan.queries.registry import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    detail = (t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure, t.in_nips, t.in_bill_rules)
    together = categorize_all(*detail)
    branches = (
        cat.op_categorize(t.in_claims, t.in_revenue, t.in_bill_rules)
        .unionByName(cat.nips_categorize(t.in_claims, t.in_nips, t.in_procedure, t.in_bill_rules))
        .unionByName(cat.ip_categorize(t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure))
    )
    assert together.dtypes == branches.dtypes and together.count() == branches.count()
    assert together.exceptAll(branches).count() == 0


def random_lines(spark):
    """Documents with repeated and null keys, and details of all kinds that belong to a claim, to none, or to a null key."""
    pick = random.Random(11)
    keys = []
    for k in range(300):
        # Most lines of one document, so that it counts as hot.
        document = "hot" if k % 3 == 0 else pick.choice(["d1", "d2", "d3", None])
        keys.append((document, f"{pick.randint(0, 60):02d}", pick.choice(["N", "Y", None]), pick.choice(["1", "2", None]) if document != "hot" else "1", DAY))
    lines = [(k, pick.choice("IONX"), date(2016, 3, pick.randint(1, 9)), date(2016, 3, pick.randint(10, 28)), "1.50", None) for k in keys]
    some = lambda: pick.choices(keys, k=250) + [("none", "01", "N", "1", DAY)]
    return (
        claims(spark, lines),
        detail(spark, "UBTypeofBillCd int", [(k, pick.choice([111, 211, None])) for k in some()]),
        detail(spark, "RevenueCd string, RevenueHCPCSCd string", [(k, pick.choice(["0450", "0001", None]), pick.choice(["H1", "H2", None])) for k in some()]),
        detail(spark, "ProcCd string", [(k, pick.choice(["P1", "P2", None])) for k in some()]),
        detail(spark, "PlaceOfServiceCd string", [(k, pick.choice(["11", "22", None])) for k in some()]),
        spark.createDataFrame(
            [("OUTPATIENT", "EMERGENCY", "EMERGENCY_OP", 1.0, 1.0, "0450", "H1", None, None),
             ("OUTPATIENT", "ANCILLARY", "DME_OP", 9.0, 9.0, "0290", "H2", None, None),
             ("NIPS", "VISIT", "OFFICE_VISIT", 2.0, 2.0, None, None, "P1", "11"),
             ("NIPS", "DRUG", "DRUG_PROF", 6.0, 6.0, None, None, "P2", "")], RULES),
    )


def test_ways_of_hot_and_other_documents_agree(spark, monkeypatch):
    from carespan.operators import one_pass

    tables = random_lines(spark)
    assert one_pass.hot_documents(list(tables[:5])) is None
    together = one_pass.categorize_all(*tables)
    by_key = one_pass._by_claim_key(tables[0].where("RecordIDCd <> 'X'"), *tables[1:])
    assert together.count() > 100 and together.dtypes == by_key.dtypes
    assert together.exceptAll(by_key).count() == 0 and by_key.exceptAll(together).count() == 0
    monkeypatch.setattr(skew, "HOT_ROWS", 150)
    assert [r.DCN for r in one_pass.hot_documents(list(tables[:5])).collect()] == ["hot"]
    split = one_pass.categorize_all(*tables)
    assert together.exceptAll(split).count() == 0 and split.exceptAll(together).count() == 0


def test_claims_and_details_are_shuffled_once_by_document(spark):
    from carespan.operators.one_pass import categorize_all

    plan = categorize_all(*random_lines(spark))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_COL" in line for line in exchanges) == 1
    assert not any("ServiceLineNbr" in line for line in exchanges) and "SortMergeJoin" not in plan


def test_tables_said_to_lie_by_document_need_not(spark):
    from carespan.operators.one_pass import categorize_all

    tables = random_lines(spark)
    dealt, said = categorize_all(*tables), categorize_all(*tables, dealt=True)
    assert dealt.count() > 100 and dealt.exceptAll(said).count() == 0 and said.exceptAll(dealt).count() == 0


def line_folder(spark, folder):
    """Raw tables with few lines: repeated ones, orders and lines with null keys, a line without an order."""
    spark.range(40).selectExpr("id AS p_partkey", "concat('Brand#', id % 5 + 1, '1') AS p_brand", "cast(id AS int) AS p_size", "900.5D AS p_retailprice").write.parquet(f"{folder}/part.parquet")
    spark.range(30).selectExpr("id AS o_orderkey", "nullif(id % 4, 3) AS o_custkey", "timestamp'2000-01-05' AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    lines = spark.range(120).selectExpr(
        "nullif(id % 32, 7) AS l_orderkey", "id % 40 AS l_partkey", "id % 3 AS l_suppkey", "cast(id % 4 + 1 AS int) AS l_linenumber",
        "element_at(array('A', 'R', 'N'), cast(id % 3 + 1 AS int)) AS l_returnflag", "if(id % 2 = 0, 'F', 'O') AS l_linestatus", "timestamp'2000-02-05' AS l_shipdate",
        "id * 1.5D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "2D AS l_quantity",
    )
    lines.union(lines.where("l_orderkey < 5")).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_claims_are_categorized_without_a_shuffle_of_lines(spark, tmp_path, monkeypatch):
    from carespan.queries import claims as queries
    from carespan.queries.registry import Inputs

    t = Inputs(spark, line_folder(spark, tmp_path))
    laid = t.by_document().in_line
    assert laid.dtypes == t.in_line.dtypes and laid.count() == t.in_line.count() > 100
    assert laid.exceptAll(t.in_line).count() == 0 and t.in_line.exceptAll(laid).count() == 0
    found = queries.categorize(t)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and ("DCN" in line or "RecipientID" in line) for line in plan.splitlines())
    plain = cat.categorize_claims(t.in_claims, t.in_institutional, t.in_revenue, t.in_procedure, t.in_nips, t.in_bill_rules, t.in_summary_map)
    assert found.count() > 50 and found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    # A hot document is not dealt into one bucket.
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(Inputs, "by_document", lambda self: pytest.fail("dealt"))
    assert queries.categorize(t).exceptAll(plain).count() == 0


def test_a_dealt_table_has_buckets_by_its_rows(spark, tmp_path, monkeypatch):
    from carespan.queries import registry

    monkeypatch.setattr(registry, "BUCKET_ROWS", 10)
    inputs = registry.Inputs(spark, str(tmp_path))
    build = lambda: spark.range(95).selectExpr("id % 30 AS k", "id")
    assert inputs.stage_dealt("dealt_probe", ["k"], build).count() == 95
    path = registry._STAGED[spark.sparkContext.applicationId, str(tmp_path), "dealt_probe"]
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {path.rsplit('/', 1)[1]}").collect()}
    assert described["Num Buckets"] == "10"
    assert len(inputs.stage_dealt("dealt_probe", ["k"], lambda: pytest.fail("written again")).columns) == 2
    registry._STAGED[spark.sparkContext.applicationId, str(tmp_path), "dealt_probe"] = "/nonexistent/probe"
    assert inputs.stage_dealt("dealt_probe", ["k"], build).count() == 95


def test_lines_are_joined_and_dealt_by_document_in_one_shuffle(spark, tmp_path, monkeypatch):
    from carespan.queries import registry

    t = registry.Inputs(spark, line_folder(spark, tmp_path))
    kept = {}
    monkeypatch.setattr(registry.Inputs, "stage_dealt", lambda self, name, by, build, buckets=None: kept.setdefault(name, build()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many orders and parts
    try:
        lines = t._lines_by_document()
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 4  # lines and parts by part, both sides by order
        assert lines.count() == t._bound(registry.joined_and_rows(registry.BINDINGS["in_line"])[0]).count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Lines of a hot order are not dealt.
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(registry.Inputs, "_lines_by_document", lambda self: pytest.fail("dealt"))
    assert registry.Inputs(spark, str(tmp_path)).in_line.count() == lines.count()
