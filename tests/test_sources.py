"""Fixed-width reading, release bookkeeping, sinks and configuration files."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carespan.functions.instruments import QUESTIONS, config_json
from carespan.operators.cdps import GROUP_LINES, WEIGHT_LINES
from carespan.plans import monthly_load
from carespan.plans.monthly_load import drop_release, load_release, raw_table
from carespan.sources import published as published_tables
from carespan.sources import releases, tables
from carespan.sources.config_files import assessment_config_scan, code_values, severity_groups
from carespan.sources.fixed_width import fixed_width_lines, fixed_width_scan, read_extract
from carespan.sources.layouts import LAYOUTS
from carespan.sources.published import publish, published_audit, read_published, unnamed_folders, write_version
from carespan.streaming.landing import land_new_extracts

WIDTHS = {
    "load_adjustments": (7, 59), "load_main_claims": (22, 170), "load_immunization": (4, 63), "load_lead": (8, 62),
    "load_pharmacy": (35, 274), "load_recipient_flags": (2, 11), "load_diagnosis": (11, 51), "load_institutional": (23, 106),
    "load_nips": (13, 86), "load_compound_drugs": (8, 60), "load_procedure": (15, 69), "load_revenue_codes": (23, 157),
}


def schema(layout):
    kinds = {"s": "string", "d": "date", "n": "decimal(18,2)"}
    return ", ".join(f"{f.name} {kinds[f.kind]}" for f in layout.fields)


def test_layout_sizes():
    assert {k: (len(v.fields), v.width) for k, v in LAYOUTS.items()} == WIDTHS


@pytest.mark.parametrize("key", sorted(LAYOUTS))
def test_round_trip(spark, key):
    """Full, blank, full-width and leading-zero values survive writing and reading."""
    layout = LAYOUTS[key]
    full = {"s": lambda w: "0" * (w - 1) + "7", "d": lambda w: date(2016, 2, 29), "n": lambda w: Decimal(10 ** min(w, 8) - 1)}
    blank = {"s": "", "d": None, "n": None}
    rows = [
        tuple(full[f.kind](f.width) for f in layout.fields),
        tuple(blank[f.kind] for f in layout.fields),
        tuple(full[f.kind](f.width) if i % 2 else blank[f.kind] for i, f in enumerate(layout.fields)),
    ]
    df = spark.createDataFrame(rows, schema(layout))
    lines = fixed_width_lines(df, layout)
    assert {len(r.value) for r in lines.collect()} == {layout.width}
    assert sorted(fixed_width_scan(lines, layout).collect(), key=str) == sorted(df.collect(), key=str)


def test_short_lines_zero_dates_and_nonsense(spark):
    layout = LAYOUTS["load_adjustments"]
    head = "D1".ljust(15) + "01" + "000000042"
    lines = spark.createDataFrame(
        [(head + "2016-01-05",), (head + "0000-00-00" + "       1.50" + "   x".ljust(11) + "V",), ("",)], "value string"
    )
    a, b, c = fixed_width_scan(lines, layout).collect()
    assert (a.DCN, a.RecipientID, a.AdjudicatedDt, a.DeltaNetLiabilityAmt, a.VoidInd) == ("D1", "000000042", date(2016, 1, 5), None, "")
    assert (b.AdjudicatedDt, b.CorrectedNetLiabilityAmt, b.DeltaNetLiabilityAmt, b.VoidInd) == (None, Decimal("1.50"), None, "V")
    assert (c.DCN, c.AdjudicatedDt) == ("", None)


def test_release_gate(spark):
    known = spark.createDataFrame([(2006,), (2007,)], "ReleaseNum int")
    status = lambda n: releases.release_gate(known, n).first().Status
    assert [status(n) for n in (2005, 2007, 2008, 2009)] == ["already present", "already present", "accepted", "expected 2008"]


def test_stamp_and_append(spark):
    row = releases.stamp_release(spark.range(1), "HFS", 2031).first()
    assert (row.DataSource, row.ReleaseNum, row.CumReleaseNum) == ("HFS", 2031, 31)
    known = releases.release_row(spark, 2031, date(2016, 1, 1), date(2016, 1, 9))
    both = releases.release_info_append(known, 2032, date(2016, 2, 1), date(2016, 2, 9))
    assert [(r.ReleaseNum, r.Cumulative_ReleaseNum) for r in both.orderBy("ReleaseNum").collect()] == [(2031, "31"), (2032, "32")]


def test_reconcile(spark):
    lines = spark.createDataFrame([("a", 3), ("b", 2)], "Table_Name string, Lines long")
    rows = spark.createDataFrame([("a", 3), ("b", 1)], "Table_Name string, Rows long")
    out = {r.Table_Name: r for r in releases.reconcile_counts(lines, rows).collect()}
    assert (out["a"].Action, out["b"].Action) == ("keep", "delete")
    assert not out["a"].Publish_Audit
    good = releases.reconcile_counts(lines.where("Table_Name = 'a'"), rows).first()
    assert good.Publish_Audit


def write_extracts(spark, folder, keys, n=5):
    paths = {}
    for key in keys:
        layout = LAYOUTS[key]
        rows = []
        for i in range(n):
            values = {"s": str(i), "d": date(2016, 1, 1 + i), "n": Decimal(i)}
            rows.append(tuple(values[f.kind] for f in layout.fields))
        paths[key] = f"{folder}/{key}"
        fixed_width_lines(spark.createDataFrame(rows, schema(layout)), layout).write.text(paths[key])
    return paths


MAIN = "trc_hfs_main_claims"


def published(spark, target, *names):
    return {n: sorted(map(str, read_published(spark, target, n).collect())) for n in names}


def test_load_release_is_repeatable_and_audited(spark, tmp_path):
    extracts = write_extracts(spark, str(tmp_path / "in"), sorted(LAYOUTS))
    target = str(tmp_path / "raw")
    for _ in range(2):
        outcome = load_release(spark, extracts, target, "HFS", 2031, date(2016, 3, 1))
        assert {(r.Lines, r.Rows, r.Action, r.Rejected) for r in outcome.collect()} == {(5, 5, "keep", 0)}
    claims = raw_table(spark, target, "load_main_claims")
    assert claims.count() == 5 and set(claims.columns) >= {"DataSource", "ReleaseNum", "CumReleaseNum"}
    assert published_audit(spark, target).count() == 13
    load_release(spark, extracts, target, "HFS", 2032, date(2016, 4, 1))
    assert read_published(spark, target, MAIN).count() == 10
    assert read_published(spark, target, MAIN, ("HFS", 2032)).select("ReleaseNum").distinct().collect() == [(2032,)]
    drop_release(spark, target, "HFS", 2031)
    assert read_published(spark, target, MAIN).count() == 5 and read_published(spark, target, MAIN, ("HFS", 2031)).count() == 0


def test_mismatch_leaves_the_published_tables_untouched(spark, tmp_path, monkeypatch):
    extracts = write_extracts(spark, str(tmp_path / "in"), ["load_lead", "load_nips"])
    target = str(tmp_path / "raw")
    load_release(spark, extracts, target, "HFS", 2030, date(2016, 2, 1))
    before = published(spark, target, "trc_hfs_lead", "trc_hfs_nips"), published_audit(spark, target).collect()
    whole = monthly_load.read_extract

    def lossy(session, path, layout):
        rows = whole(session, path, layout)
        return rows.where("RecipientID <> '3'") if layout.key == "load_lead" else rows

    monkeypatch.setattr(monthly_load, "read_extract", lossy)
    outcome = {r.Table_Name: r.Action for r in load_release(spark, extracts, target, "HFS", 2031, date(2016, 3, 1)).collect()}
    assert outcome == {"trc_hfs_lead": "delete", "trc_hfs_nips": "keep"}
    assert (published(spark, target, "trc_hfs_lead", "trc_hfs_nips"), published_audit(spark, target).collect()) == before


def test_an_empty_file_empties_the_release(spark, tmp_path):
    extracts = write_extracts(spark, str(tmp_path / "in"), ["load_lead", "load_nips"], n=3)
    target = str(tmp_path / "raw")
    load_release(spark, extracts, target, "HFS", 2030, date(2016, 2, 1))
    spark.createDataFrame([], "value string").write.text(f"{tmp_path}/none")
    outcome = load_release(spark, extracts | {"load_lead": f"{tmp_path}/none"}, target, "HFS", 2030, date(2016, 2, 2)).collect()
    assert {(r.Table_Name, r.Lines, r.Rows, r.Action) for r in outcome} == {("trc_hfs_lead", 0, 0, "keep"), ("trc_hfs_nips", 3, 3, "keep")}
    assert read_published(spark, target, "trc_hfs_lead").count() == 0 and read_published(spark, target, "trc_hfs_nips").count() == 3
    assert {r.Table_Name: r.Count for r in published_audit(spark, target).collect()}["trc_hfs_lead"] == 0


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_load_that_dies_leaves_the_old_release_whole(spark, tmp_path, monkeypatch, dies_at):
    first = write_extracts(spark, str(tmp_path / "in"), ["load_lead", "load_nips"], n=3)
    later = write_extracts(spark, str(tmp_path / "later"), ["load_lead", "load_nips"], n=5)
    target = str(tmp_path / "raw")
    load_release(spark, first, target, "HFS", 2030, date(2016, 2, 1))
    before = published(spark, target, "trc_hfs_lead", "trc_hfs_nips"), published_audit(spark, target).collect()
    real, calls = monthly_load.write_version, []

    def dying(*given):
        calls.append(given)
        if len(calls) == dies_at:
            raise KeyboardInterrupt
        return real(*given)

    with monkeypatch.context() as patch:
        patch.setattr(monthly_load, "write_version", dying)
        with pytest.raises(KeyboardInterrupt):
            load_release(spark, later, target, "HFS", 2030, date(2016, 2, 2))
    assert (published(spark, target, "trc_hfs_lead", "trc_hfs_nips"), published_audit(spark, target).collect()) == before
    load_release(spark, later, target, "HFS", 2030, date(2016, 2, 2))
    assert {len(x) for x in published(spark, target, "trc_hfs_lead", "trc_hfs_nips").values()} == {5}
    assert len(unnamed_folders(spark, target)) == 3


def test_a_broken_manifest_is_passed_over(spark, tmp_path):
    target = str(tmp_path)
    entry = write_version(spark.range(3), target, "t", "HFS", 1, date(2016, 1, 1))
    assert publish(spark, target, [entry]) == 1
    torn = [(2, 2, *entry._replace(Folder="elsewhere"))]
    spark.createDataFrame(torn, published_tables._SCHEMA).write.mode("append").parquet(f"{target}/{published_tables.MANIFEST}")
    assert read_published(spark, target, "t").count() == 3
    assert publish(spark, target, removed=[("HFS", 1)]) == 3 and published_audit(spark, target).count() == 0
    with pytest.raises(LookupError):
        read_published(spark, target, "t")


def test_rejected_fields_are_kept_and_counted(spark, tmp_path):
    layout = LAYOUTS["load_lead"]
    good = ("7", "lab", date(2016, 1, 2), None, "3", "V", "low", date(2016, 1, 3))
    lines = [r.value for r in fixed_width_lines(spark.createDataFrame([good] * 3, schema(layout)), layout).collect()]
    at = {f.name: f.start - 1 for f in layout.fields}
    lines[1] = lines[1][: at["CollectedDate"]] + "2016-13-40" + lines[1][at["CollectedDate"] + 10 :]
    lines[2] = lines[2][: at["BirthDate"]] + "unknown   " + lines[2][at["BirthDate"] + 10 :]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/lead")
    target = str(tmp_path / "raw")
    outcome = load_release(spark, {"load_lead": f"{tmp_path}/lead"}, target, "HFS", 2030, date(2016, 2, 1)).first()
    assert (outcome.Lines, outcome.Rows, outcome.Rejected) == (3, 3, 2)
    texts = read_published(spark, target, monthly_load.REJECT_TABLE)
    assert {(r.Table_Name, r.Field, r.Raw_Text) for r in texts.collect()} == {
        ("trc_hfs_lead", "CollectedDate", "2016-13-40"), ("trc_hfs_lead", "BirthDate", "unknown")}
    rows = raw_table(spark, target, "load_lead")
    assert "_Rejected" not in rows.columns and rows.where("CollectedDate IS NULL").count() == 1


def test_delete_release(spark):
    df = spark.createDataFrame([("HFS", 1), ("HFS", 2), (None, 1), ("X", 1)], "DataSource string, ReleaseNum int")
    left = {tuple(r) for r in releases.delete_release(df, "HFS", 1).collect()}
    assert left == {("HFS", 2), (None, 1), ("X", 1)}


def test_landing_takes_each_file_once(spark, tmp_path):
    folder, target, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    layout = LAYOUTS["load_recipient_flags"]
    for batch, expected in ((["00000000101"], 1), (["00000000202", "00000000303"], 3)):
        spark.createDataFrame([(line,) for line in batch], "value string").write.mode("append").text(folder)
        query = land_new_extracts(spark, folder, layout, target, mark, "HFS", 2031)
        query.awaitTermination(120)
        assert spark.read.parquet(target).count() == expected


def test_report_sink(spark, tmp_path):
    path = tables.report_sink(spark.range(3), str(tmp_path), "ids", date(2016, 5, 6))
    assert path.endswith("/2016-05-06/ids_2016-05-06")
    assert tables.read_csv(spark, path, "id long").count() == 3


def test_delta_names():
    assert tables.delta_table_name("membership") == "cps_membership_delta"
    with pytest.raises(ValueError):
        tables.delta_table_name("anything")


def test_configuration_files(spark):
    weights = code_values(spark.createDataFrame([(x,) for x in WEIGHT_LINES], "value string"))
    assert weights.count() == 67
    assert weights.where("Code = 'RENEH'").first().Value == "5.227"
    quoted = code_values(spark.createDataFrame([("'2500'='DIA2L';",)], "value string")).first()
    assert (quoted.Code, quoted.Value) == ("2500", "DIA2L")
    groups = severity_groups(spark.createDataFrame(list(enumerate(GROUP_LINES)), "Group int, value string"))
    assert groups.count() == 58 and groups.join(weights, "Code", "left_anti").count() == 0
    assert groups.where("Code = 'CANM'").select("Group", "Severity").first() == (1, 2)
    items = assessment_config_scan(spark.createDataFrame([(config_json(),)], "value string"))
    assert items.count() == sum(len(q) for s in QUESTIONS.values() for q in s.values())
    assert items.where("Instrument = 'PSC'").select("Scale").distinct().count() == 3
    assert items.where((F.col("Instrument") == "ACT") & (F.col("Item") == 5)).first().Scale == "Total"


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from carespan.session import shared_folder

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))

    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(session("local[4]")) == shared_folder(session("local"))
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_tables_by_name(spark, tmp_path):
    rows = spark.range(10).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    tables.save_named_table(rows, "named_rows", f"{tmp_path}/named")
    found = tables.catalog_scan(spark, "named_rows", ["id"], "name = 'n3'", {"id": "int"}, ["named_rows"])
    assert found.collect() == [(3,)] and found.dtypes == [("id", "int")]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED named_rows").collect()}
    assert "10 rows" in described["Statistics"]
    tables.save_named_table(rows.limit(2), "named_rows", f"{tmp_path}/named2")
    assert tables.catalog_scan(spark, "named_rows").count() == 2
    for name in ("other", "named_rows; DROP TABLE x"):
        with pytest.raises(ValueError):
            tables.catalog_scan(spark, name, allowed=["named_rows"])
    with pytest.raises(ValueError):
        tables.catalog_scan(spark, "a b")
    spark.sql("DROP TABLE named_rows")


def test_a_loaded_extract_is_compressed(spark, monkeypatch, tmp_path):
    from carespan.queries import registry, sources

    monkeypatch.setattr(sources, "fresh_path", lambda session, name: str(tmp_path / name))
    rows = registry.QUERIES["load_recipient_flags"](spark, "/root/testdata/sf0.001")
    assert rows.count() == registry.Inputs(spark, "/root/testdata/sf0.001").in_line.count()
    parts = [p for p in (tmp_path / "load_recipient_flags").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.suffix == ".gz" for p in parts)


def test_fields_are_cut_by_bytes_where_characters_are_bytes(spark):
    layout = LAYOUTS["load_adjustments"]
    line = "D" * 15 + "01" + "R" * 9 + "2001-02-03" + "       1.50" + "           " + "V"
    rows = [(line,), (line.replace("D", "é"),), (line.replace("2001-02-03", " 2001-2-3 "),), (line[:20],), ("",), (None,)]
    found = fixed_width_scan(spark.createDataFrame(rows, "value string"), layout)
    assert "octet_length" in found._jdf.queryExecution().optimizedPlan().toString()
    plain, wide, odd, short, empty, none = found.collect()
    assert plain[1:] == wide[1:] == odd[1:] == ("01", "R" * 9, date(2001, 2, 3), Decimal("1.50"), None, "V")
    assert (plain.DCN, wide.DCN) == ("D" * 15, "é" * 15)
    assert short[:4] == ("D" * 15, "01", "RRR", None) and empty[:4] == ("", "", "", None) and none[:4] == (None,) * 4


def test_dates_are_read_as_by_their_pattern(spark):
    from carespan.functions.dates import parse_iso_date

    texts = ["2001-02-03", "2001-2-3", "0000-00-00", "0000-01-01", "2001-02-30", "2000-02-29", "", "2001-02-0T", "2001-02-1T", "12001-02-03", "2001/02/03", "٢٠٠١-٠٢-٠٣", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    compared = rows.select(parse_iso_date(F.col("t")).cast("string").alias("a"), F.try_to_date("t", "y-M-d").cast("string").alias("b")).collect()
    assert [r.a for r in compared] == [r.b for r in compared]


def test_a_load_leaves_wide_rows_to_the_compiler(spark, monkeypatch, tmp_path):
    from carespan.queries import registry
    from carespan.queries.sources import BINDINGS

    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    monkeypatch.setitem(BINDINGS, "in_load_recipient_flags", "SELECT '000000001' AS RecipientID, 'AB' AS RecipientFlagCd")
    assert registry.QUERIES["load_recipient_flags"](spark, str(tmp_path)).collect() == [("000000001", "AB")]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
