"""Small fixed tables and maps.

``fixed_table`` is for tables whose size is set by this source tree, so a
broadcast of them cannot grow with the data. Lookups that come from data get
no hint: Spark broadcasts them only while their measured size stays under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles them beyond it.
"""

from __future__ import annotations

from itertools import chain
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def fixed_table(spark: SparkSession, schema: str | StructType, rows: Sequence[Sequence[Any]]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([tuple(r) for r in rows], schema))


def map_value(mapping: Mapping[Any, Any], key: Column) -> Column:
    """Value for ``key`` in a small fixed mapping, NULL when it is absent."""
    pairs: Iterable[Any] = chain.from_iterable(mapping.items())
    return F.try_element_at(F.create_map(*[F.lit(v) for v in pairs]), key)


def first_match(pairs: Sequence[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """CASE expression from (condition, value) pairs; the first true condition wins."""
    out = None
    for condition, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))

