"""Scans, loads, release bookkeeping and sinks."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.operators.keys import CLAIM_KEY
from carespan.queries.bindings import BINDINGS, KEY
from carespan.queries.registry import Inputs, register
from carespan.session import fresh_path, small_methods
from carespan.sources import releases, tables
from carespan.sources.config_files import assessment_config_scan, code_values, severity_groups
from carespan.sources.fixed_width import fixed_width_lines, fixed_width_scan, read_extract, reject_counts, scan_with_rejects
from carespan.sources.layouts import LAYOUTS, Layout

LOAD_DATE = date(2001, 9, 1)
_KNOWN = {
    "DCN": "DCN",
    "ServiceLineNbr": "lpad(cast(l_linenumber AS string), 2, '0')",
    "RejectionStatusCd": "RejectionStatusCd",
    "RecipientID": "RecipientID",
    "AdjudicatedDt": "AdjudicatedDt",
    "ServiceFromDt": "ServiceFromDt",
    "ServiceThruDt": "ServiceThruDt",
    "RecordIDCd": "RecordIDCd",
}


def _cell(layout: Layout, position: int) -> str:
    """Expression for one extract column: known claim columns, else codes, amounts and dates
    varied by position, with blanks among them."""
    field = layout.fields[position]
    if field.name in _KNOWN:
        return _KNOWN[field.name]
    j = position + 1
    if field.kind == "d":
        return f"CASE WHEN (l_partkey + {j}) % 9 = 0 THEN NULL ELSE ServiceFromDt + cast((l_suppkey + {j}) % 50 AS int) END"
    if field.kind == "n":
        size = 10 ** min(field.width - 3, 6) if field.width >= 7 else 10 ** min(field.width, 2)
        whole = f"cast((l_partkey * {j + 3} + l_suppkey) % {size} AS decimal(18,2))"
        cents = f" + cast(l_linenumber AS decimal(18,2)) * cast(0.25 AS decimal(4,2))" if field.width >= 7 else ""
        return f"CASE WHEN (l_partkey + {j}) % 11 = 0 THEN NULL ELSE cast({whole}{cents} AS decimal(18,2)) END"
    if field.width >= 15:
        return f"concat('Name ', cast((l_partkey + {j}) % 1000 AS string))"
    width = max(1, field.width - j % 2)
    return f"CASE WHEN (l_partkey + {j}) % 13 = 0 THEN '' ELSE lpad(cast(l_partkey * {j + 7} + l_suppkey AS string), {width}, '0') END"


def _extract_binding(layout: Layout) -> str:
    cells = ", ".join(f"{_cell(layout, i)} AS {f.name}" for i, f in enumerate(layout.fields))
    return f"SELECT {cells} FROM {{in_line}}"


def _out(layout: Layout) -> str:
    kinds = {"s": "", "d": ":d", "n": ":m"}
    return " ".join(f.name + kinds[f.kind] for f in layout.fields)


def _register_load(layout: Layout) -> None:
    name = f"in_{layout.key}"
    BINDINGS[name] = _extract_binding(layout)

    def load(t: Inputs) -> DataFrame:
        path = fresh_path(small_methods(t.spark), layout.key)
        # Blanks and padding make up most of an extract, so its files are compressed; the quickest way takes a fifth more room.
        lines = fixed_width_lines(getattr(t, name), layout).write.option("compression", "gzip")
        lines.option("zlib.compress.level", "BEST_SPEED").text(path)
        return read_extract(t.spark, path, layout)

    register(layout.key, _out(layout), f"SELECT * FROM {name}")(load)


for _layout in LAYOUTS.values():
    _register_load(_layout)


@register(
    "fixed_width_scan",
    _out(LAYOUTS["load_main_claims"]),
    "SELECT * FROM in_load_main_claims",
)
def _fixed_width_scan(t: Inputs) -> DataFrame:
    layout = LAYOUTS["load_main_claims"]
    # Trailing blanks are stripped, so lines that end in blank fields are short.
    lines = fixed_width_lines(t.in_load_main_claims, layout).select(F.rtrim("value").alias("value"))
    return fixed_width_scan(lines, layout)


@register(
    "stamp_release",
    "DCN RecipientID DataSource ReleaseNum:i CumReleaseNum:i ServiceFromDt:d",
    "SELECT *, 'HFS' AS DataSource, 2007 AS ReleaseNum, CAST(substr('2007', 3) AS INT) AS CumReleaseNum FROM in_claims",
)
def _stamp_release(t: Inputs) -> DataFrame:
    return releases.stamp_release(t.in_claims, "HFS", 2007)


_RAW = {"trc_hfs_main_claims": "in_raw_claims", "trc_hfs_diagnosis": "in_raw_diagnosis"}


@register(
    "load_audit",
    "Table_Name ReleaseNum:i Cumulative_ReleaseNum:i Load_Date:d Count:i",
    " UNION ALL ".join(
        f"SELECT '{name}' AS Table_Name, ReleaseNum, CumReleaseNum AS Cumulative_ReleaseNum, DATE '2001-09-01' AS Load_Date, "
        f"count(*) AS Count FROM {source} GROUP BY ReleaseNum, CumReleaseNum"
        for name, source in _RAW.items()
    ),
)
def _load_audit(t: Inputs) -> DataFrame:
    return releases.load_audit({name: getattr(t, source) for name, source in _RAW.items()}, LOAD_DATE)


@register(
    "reconcile_counts",
    "Table_Name Lines:i Rows:i Matched:b Action Publish_Audit:b",
    """
    WITH c AS (
      SELECT 'trc_hfs_main_claims' AS Table_Name, (SELECT count(*) FROM lineitem) AS "Lines", (SELECT count(*) FROM in_raw_claims) AS "Rows"
      UNION ALL
      SELECT 'trc_hfs_diagnosis', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM in_raw_diagnosis))
    SELECT *, "Lines" = "Rows" AS Matched, CASE WHEN "Lines" = "Rows" THEN 'keep' ELSE 'delete' END AS Action,
      (SELECT bool_and("Lines" = "Rows") FROM c) AS Publish_Audit FROM c
    """,
)
def _reconcile_counts(t: Inputs) -> DataFrame:
    lines = releases.row_counts({name: t.lineitem for name in _RAW}, "Lines")
    return releases.reconcile_counts(lines, releases.row_counts({n: getattr(t, s) for n, s in _RAW.items()}, "Rows"))


@register(
    "delete_release",
    "DCN ServiceLineNbr DataSource ReleaseNum:i",
    "SELECT * FROM in_raw_claims WHERE NOT (DataSource = 'HFS' AND ReleaseNum = 2004)",
)
def _delete_release(t: Inputs) -> DataFrame:
    return releases.delete_release(t.in_raw_claims, "HFS", 2004)


@register(
    "release_gate",
    "Requested_Release:i Last_Release:i Expected_Release:i Status",
    """
    SELECT r AS Requested_Release, m AS Last_Release, m + 1 AS Expected_Release,
      CASE WHEN r = m + 1 THEN 'accepted' WHEN r <= m THEN 'already present' ELSE 'expected ' || CAST(m + 1 AS VARCHAR) END AS Status
    FROM (VALUES (2007), (2008), (2010)) AS t(r), (SELECT max(ReleaseNum) AS m FROM in_release)
    """,
)
def _release_gate(t: Inputs) -> DataFrame:
    first, *more = [releases.release_gate(t.in_release, n) for n in (2007, 2008, 2010)]
    for frame in more:
        first = first.unionByName(frame)
    return first


@register(
    "release_info_append",
    "ReleaseNum:i Cumulative_ReleaseNum HFS_Release_Date:d Load_Date:d",
    """
    SELECT * FROM in_release UNION ALL
    SELECT 2008, '08', DATE '2002-02-01', DATE '2002-02-11'
    """,
)
def _release_info_append(t: Inputs) -> DataFrame:
    return releases.release_info_append(t.in_release, 2008, date(2002, 2, 1), date(2002, 2, 11))


@register(
    "table_query",
    "RecipientID n:i First_Date:d",
    "SELECT RecipientID, count(*) AS n, min(ServiceFromDt) AS First_Date FROM in_claims GROUP BY RecipientID",
)
def _table_query(t: Inputs) -> DataFrame:
    sql = "SELECT RecipientID, count(*) AS n, cast(min(ServiceFromDt) AS string) AS First_Date FROM {claims} GROUP BY RecipientID"
    return tables.table_query(t.spark, sql, ["First_Date"], claims=t.in_claims)


_AUDIT_SQL = "SELECT ReleaseNum, count(*) AS n, count(DISTINCT DCN) AS documents FROM ({}) AS r GROUP BY ReleaseNum"


def _audit(df: DataFrame) -> DataFrame:
    return df.groupBy("ReleaseNum").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("DCN").alias("documents"))


@register(
    "append_table",
    "ReleaseNum:i n:i documents:i",
    _AUDIT_SQL.format("SELECT DCN, ReleaseNum FROM in_raw_claims UNION ALL SELECT DCN, ReleaseNum FROM in_raw_diagnosis"),
)
def _append_table(t: Inputs) -> DataFrame:
    path = fresh_path(t.spark, "append_table")
    for frame in (t.in_raw_claims, t.in_raw_diagnosis):
        tables.append_table(frame.select("DCN", "ReleaseNum"), path, ["ReleaseNum"])
    return _audit(t.spark.read.parquet(path))


@register("replace_table", "ReleaseNum:i n:i documents:i", _AUDIT_SQL.format("SELECT * FROM in_raw_diagnosis"))
def _replace_table(t: Inputs) -> DataFrame:
    path = fresh_path(t.spark, "replace_table")
    for frame in (t.in_raw_claims, t.in_raw_diagnosis):
        tables.replace_table(frame.select("DCN", "ReleaseNum"), path, ["ReleaseNum"])
    return _audit(t.spark.read.parquet(path))


_CLAIM_CSV = "DCN string, RecipientID string, ServiceFromDt date, NetLiabilityAmt decimal(18,2), EncounterPriceAmt decimal(18,2)"
_CLAIM_OUT = "DCN RecipientID ServiceFromDt:d NetLiabilityAmt:m EncounterPriceAmt:m"


def _claim_csv(t: Inputs, name: str) -> str:
    path = fresh_path(t.spark, name)
    tables.write_csv(t.in_claims.select("DCN", "RecipientID", "ServiceFromDt", "NetLiabilityAmt", "EncounterPriceAmt"), path)
    return path


@register("bulk_csv_reload", _CLAIM_OUT, "SELECT * FROM in_claims")
def _bulk_csv_reload(t: Inputs) -> DataFrame:
    table = fresh_path(t.spark, "bulk_csv_reload_table")
    tables.replace_table(t.in_claims.select("DCN", "RecipientID"), table)
    tables.bulk_csv_reload(t.spark, _claim_csv(t, "bulk_csv_reload"), _CLAIM_CSV, table)
    return t.spark.read.parquet(table)


@register("csv_to_parquet", _CLAIM_OUT, "SELECT * FROM in_claims")
def _csv_to_parquet(t: Inputs) -> DataFrame:
    return tables.csv_to_parquet(t.spark, _claim_csv(t, "csv_to_parquet"), _CLAIM_CSV, fresh_path(t.spark, "csv_as_parquet"))


@register(
    "patient_level_load",
    "RecordIDCd n:i Amount:m",
    "SELECT RecordIDCd, count(*) AS n, sum(NetLiabilityAmt) AS Amount FROM in_claims GROUP BY RecordIDCd",
)
def _patient_level_load(t: Inputs) -> DataFrame:
    table, parts = fresh_path(t.spark, "patient_level_table"), []
    for kind in ("I", "O", "N"):
        path = fresh_path(t.spark, "pt_level")
        tables.write_csv(t.in_claims.where(F.col("RecordIDCd") == kind).select("RecordIDCd", "NetLiabilityAmt"), path)
        parts.append(path)
    tables.patient_level_load(t.spark, parts, "RecordIDCd string, NetLiabilityAmt decimal(18,2)", table)
    loaded = t.spark.read.parquet(table)
    return loaded.groupBy("RecordIDCd").agg(F.count(F.lit(1)).alias("n"), F.sum("NetLiabilityAmt").alias("Amount"))


def _lines(t: Inputs, rows: DataFrame, name: str) -> DataFrame:
    """The text column ``value`` of the rows, written as a file and read again."""
    path = fresh_path(t.spark, name)
    rows.select("value").write.text(path)
    return t.spark.read.text(path)


# Code lines quoted and closed in every way that occurs, and some that are none.
_CODE_LINE = """CASE p_partkey % 7 WHEN 0 THEN concat('K', p_partkey, ' ', p_size) WHEN 1 THEN concat('K', p_partkey, '=', p_size, '.5')
  WHEN 2 THEN concat("'K", p_partkey, "' = ", p_size, '.5;') ELSE concat("'K", p_partkey, "'='", p_size, ".5';  ") END"""


@register(
    "code_lookup_scan",
    "Group:i Severity:i Code Value",
    """
    SELECT s_suppkey AS "Group", i AS Severity, Code, Value
    FROM (SELECT s_suppkey, i, 'K' || ((s_suppkey * 7 + i * 13) % 200 + 1) AS Code FROM supplier, range(6) AS r(i))
    JOIN (SELECT 'K' || p_partkey AS Code, p_size || '.5' AS Value FROM part WHERE p_partkey % 7 <> 0) USING (Code)
    """,
)
def _code_lookup_scan(t: Inputs) -> DataFrame:
    """Code values and severity lists, both parsed from text files made of the tables."""
    values = code_values(_lines(t, t.part.select(F.expr(_CODE_LINE).alias("value")), "code_values"))
    words = "array_join(transform(sequence(0, 5), i -> concat('K', (s_suppkey * 7 + i * 13) % 200 + 1)), '  ')"
    numbered = _lines(t, t.supplier.select(F.expr(f"concat(s_suppkey, '\t ', {words}, ' ')").alias("value")), "code_groups")
    parts = F.split("value", "\t")
    listed = numbered.select(parts[0].alias("Group"), parts[1].alias("value"))
    return severity_groups(listed).join(values, "Code")


@register(
    "assessment_config_scan",
    "Instrument Scale Item:i QuestionText",
    """
    SELECT 'I' || c_custkey AS Instrument, 'Total' AS Scale, i AS Item, 'Item "' || i || '" of ' || c_name AS QuestionText
    FROM customer, range(1, 5) AS r(i) WHERE c_custkey % 2 = 1 AND i <= 2 + c_custkey % 3
    UNION ALL SELECT 'I' || c_custkey, s.Scale, i, 'Item {' || i || '}, ' || s.Scale || ' é of ' || c_name
    FROM customer, (VALUES ('First', 3), ('Second', 2)) AS s(Scale, n), range(1, 4) AS r(i) WHERE c_custkey % 2 = 0 AND i <= s.n
    """,
)
def _assessment_config_scan(t: Inputs) -> DataFrame:
    """Questionnaire files, one JSON text for each customer: odd ones hold questions, even ones two scales of them."""
    direct = """to_json(named_struct('Clean', transform(sequence(1, cast(2 + c_custkey % 3 as int)), i -> concat('Item "', i, '" of ', c_name))))"""
    scale = "'{0}', named_struct('ScoreCol', '{0} Score', 'Clean', transform(sequence(1, {1}), i -> concat('Item {{', i, '}}, {0} é of ', c_name)))"
    scales = f"to_json(map({scale.format('First', 3)}, {scale.format('Second', 2)}))"
    value = f"""concat('{{"I', c_custkey, '": ', CASE WHEN c_custkey % 2 = 1 THEN {direct} ELSE {scales} END, '}}')"""
    return assessment_config_scan(_lines(t, t.customer.select(F.expr(value).alias("value")), "questionnaires"))


@register(
    "report_sink",
    "RecipientID Lines:i Amount:m",
    "SELECT RecipientID, count(*) AS Lines, sum(NetLiabilityAmt) AS Amount FROM in_claims GROUP BY RecipientID",
)
def _report_sink(t: Inputs) -> DataFrame:
    report = t.in_claims.groupBy("RecipientID").agg(
        F.count(F.lit(1)).alias("Lines"), F.sum("NetLiabilityAmt").alias("Amount")
    )
    path = tables.report_sink(report, fresh_path(t.spark, "reports"), "claims", LOAD_DATE)
    return tables.read_csv(t.spark, path, "RecipientID string, Lines bigint, Amount decimal(28,2)")


@register(
    "catalog_scan",
    "RecipientID ServiceLineNbr DCN AdjudicatedDt:d RejectionStatusCd UBTypeofBillCd:i",
    f"SELECT {KEY}, UBTypeofBillCd FROM in_institutional WHERE PatientStatusCd IS NOT NULL",
)
def _catalog_scan(t: Inputs) -> DataFrame:
    name = f"institutional_{uuid.uuid4().hex}"
    tables.save_named_table(t.in_institutional, name, fresh_path(t.spark, "institutional"))
    return tables.catalog_scan(
        t.spark, name, [*CLAIM_KEY, "UBTypeofBillCd"], "PatientStatusCd IS NOT NULL", {"UBTypeofBillCd": "int"}, [name]
    )


_ODD = {"ServiceThruDt": "03", "NetLiabilityAmt": "05"}  # fields made unreadable, on lines of that number
_CHECKED = [f for f in LAYOUTS["load_main_claims"].fields if f.kind in "dn"]


@register(
    "rejected_fields",
    "Table_Name Field Rejected:i",
    " UNION ALL ".join(
        f"SELECT 'trc_hfs_main_claims' AS Table_Name, '{f.name}' AS Field, "
        f"(SELECT count(*) FROM in_load_main_claims WHERE ServiceLineNbr = '{_ODD.get(f.name, '')}') AS Rejected"
        for f in _CHECKED
    ),
)
def _rejected_fields(t: Inputs) -> DataFrame:
    """Unreadable dates and numbers of an extract, counted for each field."""
    layout = LAYOUTS["load_main_claims"]
    value = F.col("value")
    for f in _CHECKED:
        if f.name in _ODD:
            number = next(x for x in layout.fields if x.name == "ServiceLineNbr")
            chosen = F.trim(F.substring("value", number.start, number.width)) == _ODD[f.name]
            value = F.when(chosen, F.overlay(value, F.lit("?"), f.start, 1)).otherwise(value)
    lines = fixed_width_lines(t.in_load_main_claims, layout).select(value.alias("value"))
    scanned = scan_with_rejects(lines, layout)
    return reject_counts({layout.table: scanned}, {layout.table: [f.name for f in _CHECKED]})
