"""Fixed-width text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.functions.dates import parse_iso_date
from carespan.sources.layouts import Field, Layout

AMOUNT = "decimal(18,2)"


_LINE, _SINGLE = "_line", "_single"


def _laid(lines: DataFrame, column: str) -> DataFrame:
    """The line, and whether each of its characters is one byte."""
    return lines.select(F.col(column).alias(_LINE), (F.octet_length(column) == F.char_length(column)).alias(_SINGLE))


def _text(field: Field) -> Column:
    """A field's text. Characters are counted from the start of the line, for every field anew; bytes, where they are the same, are not."""
    cut = F.substring(F.col(_LINE).cast("binary"), field.start, field.width).cast("string")
    return F.trim(F.when(F.col(_SINGLE), cut).otherwise(F.substring(F.col(_LINE), field.start, field.width)))


def _typed(field: Field) -> Column:
    text = _text(field)
    if field.kind == "d":
        return parse_iso_date(text)
    if field.kind == "n":
        return F.nullif(text, F.lit("")).try_cast(AMOUNT)
    return text


def fixed_width_scan(lines: DataFrame, layout: Layout, column: str = "value") -> DataFrame:
    """Split one text column into the layout's columns. Works on batch and streaming frames."""
    return _laid(lines, column).select(*[_typed(f).alias(f.name) for f in layout.fields])


REJECTED = "_Rejected"


def scan_with_rejects(lines: DataFrame, layout: Layout, column: str = "value") -> DataFrame:
    """The scan with REJECTED, an array of (Field, Raw_Text): dates and numbers that are neither blank nor readable, NULL in their column."""
    odd = [
        F.when((_text(f) != "") & _typed(f).isNull(), F.struct(F.lit(f.name).alias("Field"), _text(f).alias("Raw_Text")))
        for f in layout.fields
        if f.kind in "dn"
    ]
    none = F.array().cast("array<struct<Field:string,Raw_Text:string>>")
    found = F.array_compact(F.array(*odd)) if odd else none
    return _laid(lines, column).select(*[_typed(f).alias(f.name) for f in layout.fields], found.alias(REJECTED))


def rejected_fields(scanned: DataFrame, table: str) -> DataFrame:
    """(Table_Name, Field, Raw_Text) of every field of ``scan_with_rejects`` that couldn't be read."""
    return scanned.select(F.lit(table).alias("Table_Name"), F.inline(REJECTED))


def reject_counts(scanned: dict[str, DataFrame], fields: dict[str, list[str]]) -> DataFrame:
    """Rejects per table and field, 0 for fields without any, in one pass over each table."""
    out = None
    for table, rows in scanned.items():
        counts = F.array(*[F.struct(F.lit(f).alias("Field"), F.col(f"_{k}").alias("Rejected")) for k, f in enumerate(fields[table])])
        sums = [F.coalesce(F.sum(F.array_contains(F.col(f"{REJECTED}.Field"), f).cast("long")), F.lit(0)).alias(f"_{k}") for k, f in enumerate(fields[table])]
        own = rows.agg(*sums).select(F.lit(table).alias("Table_Name"), F.inline(counts))
        out = own if out is None else out.unionByName(own)
    return out


def read_extract(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    return fixed_width_scan(spark.read.text(path), layout)


def fixed_width_lines(rows: DataFrame, layout: Layout) -> DataFrame:
    """Inverse of the scan: one ``value`` column of exactly ``layout.width`` characters.

    Text and dates are left-aligned, numbers right-aligned without empty decimals, NULLs blank.
    """
    cells = []
    for f in layout.fields:
        text = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        if f.kind == "n":
            cells.append(F.lpad(F.regexp_replace(text, r"\.0+$", ""), f.width, " "))
        else:
            cells.append(F.rpad(text, f.width, " "))
    return rows.select(F.concat(*cells).alias("value"))
