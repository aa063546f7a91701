"""Parsers for the two small text configurations: risk-code files and questionnaires."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """``'KEY'=VALUE`` lines, quotes and semicolons optional, to (Code, Value)."""
    pattern = r"^'?([^'=]+)'?\s*=\s*'?([^';\s]*)'?;?\s*$"
    raw = F.col(column)
    return lines.where(raw.rlike(pattern)).select(
        F.regexp_extract(raw, pattern, 1).alias("Code"),
        F.regexp_extract(raw, pattern, 2).alias("Value"),
    )


def severity_groups(lines: DataFrame, group: str = "Group", column: str = "value") -> DataFrame:
    """Numbered lines of codes, most severe first, to (Group, Severity, Code)."""
    words = F.split(F.trim(F.col(column)), r"\s+")
    return lines.select(F.col(group).alias("Group"), F.posexplode(words).alias("Severity", "Code"))


_SCALE = "struct<ScoreCol:string,Clean:array<string>>"


def assessment_config_scan(documents: DataFrame, column: str = "value") -> DataFrame:
    """Questionnaire JSON to (Instrument, Scale, Item, QuestionText).

    An instrument holds either named scales or its questions directly; the
    latter are reported under the scale 'Total'.
    """
    instruments = documents.select(
        F.explode(F.from_json(F.col(column), "map<string,string>")).alias("Instrument", "body")
    )
    direct = F.from_json("body", "struct<Clean:array<string>>")["Clean"]
    whole = F.create_map(F.lit("Total"), F.struct(F.lit("Total Score").alias("ScoreCol"), direct.alias("Clean")))
    scales = F.when(direct.isNotNull(), whole).otherwise(F.from_json("body", f"map<string,{_SCALE}>"))
    return (
        instruments.select("Instrument", F.explode(scales).alias("Scale", "def"))
        .select("Instrument", "Scale", F.posexplode("def.Clean").alias("Item", "QuestionText"))
        .withColumn("Item", F.col("Item") + 1)
    )
