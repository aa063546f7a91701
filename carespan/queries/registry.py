"""Registered queries, their output columns and their SQL counterparts.

``register(key, out, sql)`` names a function from ``Inputs`` to a DataFrame.
``out`` fixes column order and portable types of both the Spark result and the
SQL result, so the two can be compared value by value:

  plain name  string        ``:i`` 64-bit integer     ``:m`` amount, 2 decimals as double
  ``:fN``     double rounded to N decimals            ``:d`` date as yyyy-MM-dd text
  ``:t``      timestamp as text to the second         ``:b`` boolean as 0/1

SQL may mention bound inputs (``in_*``) and shared fragments (``ref_*``); the
common table expressions they need are added in front.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.functions import skew
from carespan.operators.keys import DOCUMENT_KEY
from carespan.queries.bindings import BINDINGS, Fixed, fixed_frame, fixed_sql, spark_sql_text, sql_text
from carespan.session import COMPRESSION, fresh_path, shared_folder

Query = Callable[["Inputs"], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}
RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


# Tables written once per application and data folder, as the monthly load writes its
# staged layers: later queries read them instead of deriving them again.
STAGED_BINDINGS = ("in_line",)
_STAGED: dict[tuple[str, str, str], str] = {}
# Rows of a bucket of a staged table that is dealt by key: sorts over what derives from it stay in memory, whatever the table's size.
BUCKET_ROWS = 250_000
HASHES = 1 << 16
_HOT: dict[tuple[str, str, int], bool] = {}


class Inputs:
    """Bound inputs by name, as lazily built DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Read the staged table, writing it to the shared folder when it is not there yet.

        It is written as it lies, without another shuffle: what is staged comes out of joins and sums whose partitions
        adaptive execution has already evened out.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in _STAGED:
            try:
                return self.spark.read.parquet(_STAGED[key])
            except AnalysisException:
                pass  # the folder was cleared in between, so it is written again
        path = fresh_path(self.spark, name)
        build().write.option("compression", COMPRESSION).parquet(path)
        _STAGED[key] = path
        return self.spark.read.parquet(path)

    def stage_dealt(self, name: str, by: Sequence[str], build: Callable[[], DataFrame], buckets: int | None = None) -> DataFrame:
        """As ``stage``, dealt into buckets by columns: windows over these and further columns need no shuffle.

        With ``buckets`` the frame lies in so many partitions by these columns already and is written as it lies.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in _STAGED:
            try:
                self.spark.read.parquet(_STAGED[key])
                return self.spark.table(_STAGED[key].rsplit("/", 1)[1])
            except AnalysisException:
                pass  # the folder was cleared in between, so it is written again
        frame = build()
        if buckets is None:
            buckets = self.buckets(frame)
            frame = frame.repartition(buckets, *by)
        table = f"{name}_{uuid.uuid4().hex}"
        path = f"{shared_folder(self.spark).rstrip('/')}/{table}"
        dealt = frame.write.bucketBy(buckets, *by).option("compression", COMPRESSION)
        dealt.option("path", path).saveAsTable(table, format="parquet")
        _STAGED[key] = path
        return self.spark.table(table)

    def buckets(self, rows: DataFrame) -> int:
        """Buckets for a table that is dealt by key and has about as many rows."""
        return max(self.spark.sparkContext.defaultParallelism, -(-rows.count() // BUCKET_ROWS))

    def document_buckets(self) -> int:
        """Buckets of the claim lines that lie by document."""
        return self.buckets(self.lineitem)

    def by_document(self) -> Inputs:
        """The same inputs over staged claim lines that lie by document.

        A document's lines are in one bucket, so none should have HOT_ROWS lines.
        """
        rows = joined_and_rows(BINDINGS["in_line"])[1]
        laid = {c: f"_{c}" for c in DOCUMENT_KEY}
        # The keys as they were dealt by: worked out again, they would not be known to lie together.
        staged = self._lines_by_document()
        with_keys = rows.replace("\nFROM", f", {', '.join(laid.values())}\nFROM")
        lines = self.spark.sql(spark_sql_text(with_keys), staged=staged)
        other = Inputs(self.spark, self.folder)
        other._frames["in_line"] = lines.select(*[F.col(laid[c]).alias(c) if c in laid else c for c in self.in_line.columns])
        return other

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        binding = BINDINGS[name]
        if isinstance(binding, Fixed):
            return fixed_frame(self.spark, binding)
        if name in STAGED_BINDINGS:
            return self.spark.sql(spark_sql_text(joined_and_rows(binding)[1]), staged=self._staged_join(name))
        return self._bound(binding)

    def _staged_join(self, name: str) -> DataFrame:
        if not self._has_hot_order():
            return self._lines_by_document()
        binding = BINDINGS[name]
        return self.stage(f"{name}_as_it_lies", lambda: self._bound(joined_and_rows(binding)[0], cast_columns(binding)))

    def _has_hot_order(self) -> bool:
        """Whether an order may have HOT_ROWS lines; told by counts of hashes, so nothing is shuffled for it."""
        key = (self.spark.sparkContext.applicationId, self.folder, skew.HOT_ROWS)
        if key not in _HOT:
            order = F.pmod(F.xxhash64("l_orderkey"), F.lit(HASHES))
            lines = self.lineitem.where("l_orderkey IS NOT NULL").groupBy(order.alias("h")).count()
            _HOT[key] = (lines.agg(F.max("count").alias("n")).first().n or 0) >= skew.HOT_ROWS
        return _HOT[key]

    def _lines_by_document(self) -> DataFrame:
        """The join behind claim lines, dealt by document by the same shuffle that its orders are joined in.

        Orders are joined by the text that documents go by, so lines lie by document when they come out of the join. The
        numbers are compared too, as long ones are cut short in the text.
        """
        binding = BINDINGS["in_line"]
        document, patient = (re.search(rf"(lpad\([^\n]*?'0'\)) AS {c}\b", binding).group(1) for c in ("DCN", "RecipientID"))
        join = joined_and_rows(binding)[0]
        columns = re.findall(r"\b[a-z]\.(\w+)", join.split("\nFROM ")[0])
        casts = cast_columns(binding)

        def text(key: str, of: str = "l_orderkey") -> Column:
            return F.expr(re.sub(r"\b[a-z]\.", "", key).replace("l_orderkey", of))

        def table(name: str, *keys: str) -> DataFrame:
            rows = getattr(self, name)
            rows = rows.select(*[c for c in rows.columns if c in columns or c in keys])
            return rows.withColumns({c: F.col(c).cast(casts[c]) for c in rows.columns if c in casts})

        def build() -> DataFrame:
            line_key, order_key = text(document), text(document, "o_orderkey")
            lines = table("lineitem").join(table("part", "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
            lines = lines.select(*[c for c in lines.columns if c in columns]).repartition(buckets, line_key)
            orders = table("orders", "o_orderkey").repartition(buckets, order_key)
            same = F.col("l_orderkey").between(F.col("o_orderkey"), F.col("o_orderkey"))
            joined = lines.join(orders, (line_key == order_key) & same)
            return joined.select(line_key.alias("_DCN"), text(patient).alias("_RecipientID"), *columns)

        buckets = self.document_buckets()
        return self.stage_dealt("in_line", ["_DCN"], build, buckets)

    def _bound(self, binding: str, casts: dict[str, str] | None = None) -> DataFrame:
        used = {n: getattr(self, n) for n in re.findall(r"\{(\w+)\}", binding)}
        if casts:
            used = {n: t.withColumns({c: F.col(c).cast(casts[c]) for c in t.columns if c in casts}) for n, t in used.items()}
        return self.spark.sql(spark_sql_text(binding), **used)


def cast_columns(binding: str) -> dict[str, str]:
    """Columns that a binding only ever reads as one date or decimal type: cast before its joins, they are sent in fewer bytes."""
    cast = set(re.findall(r"\bcast\([a-z]\.(\w+) AS (date|decimal\([\d, ]+\))\)", binding))
    types = dict(cast)
    other = re.sub(r"\bcast\([a-z]\.\w+ AS (?:date|decimal\([\d, ]+\))\)", "", binding)
    read = set(re.findall(r"\b[a-z]\.(\w+)", other))
    return {c: t for c, t in types.items() if c not in read and len([x for x, _ in cast if x == c]) == 1}


def joined_and_rows(binding: str) -> tuple[str, str]:
    """A binding over a join as two steps: the join's own columns, and the binding's columns out of ``{staged}``.

    Keys padded to text take several times the room of the numbers they are made of, so the numbers are staged. The join's
    columns must be qualified (``l.l_orderkey``) and differ in name.
    """
    columns, tables = binding.split("\nFROM ", 1)
    qualified = re.compile(r"\b[a-z]\.(\w+)")
    used = sorted(set(m.group(0) for m in qualified.finditer(columns)))
    return f"SELECT {', '.join(used)}\nFROM {tables}", qualified.sub(r"\1", columns) + "\nFROM {staged}"


def _columns(out: str) -> list[tuple[str, str]]:
    return [tuple((c if ":" in c else f"{c}:s").split(":")) for c in out.split()]


def _portable(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    if kind == "i":
        c = c.cast("bigint")
    elif kind == "b":
        c = c.cast("int")
    elif kind == "m":
        c = F.round(c.cast("decimal(38,6)"), 2).cast("double")
    elif kind.startswith("f"):
        c = F.round(c.cast("double"), int(kind[1:]))
    elif kind == "d":
        c = F.date_format(c, "yyyy-MM-dd")
    elif kind == "t":
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    else:
        c = c.cast("string")
    return c.alias(name)


def _portable_sql(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "i":
        c = f"CAST({c} AS BIGINT)"
    elif kind == "b":
        c = f"CAST({c} AS INTEGER)"
    elif kind == "m":
        c = f"CAST(round(CAST({c} AS DECIMAL(38,6)), 2) AS DOUBLE)"
    elif kind.startswith("f"):
        c = f"round(CAST({c} AS DOUBLE), {kind[1:]})"
    elif kind == "d":
        c = f"strftime({c}, '%Y-%m-%d')"
    elif kind == "t":
        c = f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    else:
        c = f"CAST({c} AS VARCHAR)"
    return f'{c} AS "{name}"'


def fragment(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql


def _expand(name: str) -> str:
    if name in FRAGMENTS:
        return FRAGMENTS[name]
    binding = BINDINGS[name]
    return fixed_sql(binding) if isinstance(binding, Fixed) else sql_text(binding)


def _with_tables(sql: str) -> str:
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:in|ref)_\w+\b", text):
            if (name in FRAGMENTS or name in BINDINGS) and name not in ordered:
                need(_expand(name))
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    return ",\n".join(f"{name} AS (\n{_expand(name)}\n)" for name in ordered)


def compose_sql(sql: str, out: str) -> str:
    tables = _with_tables(sql)
    prefix = f"WITH {tables}\n" if tables else ""
    columns = ", ".join(_portable_sql(n, k) for n, k in _columns(out))
    return f"{prefix}SELECT {columns} FROM (\n{sql}\n) AS result"


def register(key: str, out: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        assert key not in QUERIES, key

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(spark, folder)).select(*[_portable(n, k) for n, k in _columns(out)])

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = (sql, out)
        return fn

    return add


def oracle_sql() -> dict[str, str]:
    return {key: compose_sql(sql, out) for key, (sql, out) in ORACLES.items()}
