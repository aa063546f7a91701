"""Text cleaners used by contacts, registry and school extracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Capitalize after every non-letter, so 'ed/hospitalization' gives 'Ed/Hospitalization'."""
    runs = F.regexp_extract_all(F.lower(text), F.lit("([a-z]+|[^a-z]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def reason_clean(text: Column) -> Column:
    spaced = F.replace(text, F.lit("-"), F.lit(" "))
    expanded = F.replace(
        spaced,
        F.lit("Care Coordination Consult "),
        F.lit("Care Coordination Consultation "),
    )
    return title_case(F.trim(F.regexp_replace(expanded, r"\s+", " ")))


def medicaid_normalize(text: Column) -> Column:
    """Integer text padded to nine characters; longer identifiers are kept whole."""
    number = F.trim(text).try_cast("decimal(38,0)").cast("string")
    return F.when(F.length(number) < 9, F.lpad(number, 9, "0")).otherwise(number)


def zip5(text: Column) -> Column:
    return F.substring(text.cast("string"), 1, 5)


def non_empty_flag(text: Column) -> Column:
    return F.when(F.length(F.coalesce(text, F.lit(""))) > 0, 1).otherwise(0)


def diagnosis_text_clean(text: Column) -> Column:
    """Whitespace-separated words joined by commas, underscores shown as spaces."""
    words = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), " ", ",")
    return F.replace(words, F.lit("_"), F.lit(" "))


def strip_leading_zeros(text: Column) -> Column:
    return F.ltrim(text, F.lit("0"))


def label(*parts: Column) -> Column:
    return F.concat_ws("::", *parts)


def capitalize(text: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def percent_text(part: Column, whole: Column) -> Column:
    """Share as text with one decimal, rounded half up in whole numbers; NULL when ``whole`` is 0."""
    tenths = F.floor(F.try_divide(part * 2000 + whole, whole * 2))
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))
