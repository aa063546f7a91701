"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

A document's size is its number of words (runs without ASCII white space). The sources, in
code-point order with null last, weigh 5, 2, 1, 5, 2, 1, ... and share 150% of all words;
a source gets at most twice its own, and what it can't take is shared again by weight.

Every document of a source is expected target / source size times. The prefix sum of these
expected copies, plus one random offset below 1 for the source, crosses whole numbers;
a document is emitted once for each crossed inside its own step. As no step is over 2, no
document comes more than twice. Within a source documents stand by size class (sixteen classes
for each doubling), so every size is taken in proportion and the words come near their target,
then in the order of a seeded hash.

The prefix sum is taken in two levels: a source's size classes are cut into ``SALTS`` cells by
the hash; cells are counted with a combining aggregate and summed up over the
at most 64 * 16 * SALTS cells of a source, and a document only needs its place in its cell.
So a source that holds a third of all rows is dealt over many tasks.

Nulls, ties and odd rows: a null text has size 0; a null source is a source; rows equal in
hash and size are interchangeable; a source without any words keeps each row once;
other columns are kept as they are; no rows give no rows. The same rows and seed
give the same mix whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm.storage import documents

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # times a source's or a document's size
SALTS = 512
SEED = "mix"

_OWN = "__mix_"  # before the names of columns made here


def _hash(text: Column) -> Column:
    """A number below 2**60 from the md5 of the seed and the text."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), text)), 1, 15), 16, 10).cast("long")


def _placed(docs: DataFrame) -> DataFrame:
    """docs with size, source key, size class, hash and cell."""
    own = {
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "no_source": F.col("source").isNull(),
        "source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "hash": _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
    }
    out = docs.withColumns({_OWN + k: v for k, v in own.items()})
    bits = F.length(F.bin(_OWN + "size"))
    top = F.expr(f"shiftright(shiftleft({_OWN}size, 4), length(bin({_OWN}size)) - 1) & 15")
    return out.withColumns({_OWN + "class": (bits * 16 + top).cast("int"), _OWN + "salt": F.pmod(_OWN + "hash", F.lit(SALTS)).cast("int")})


def _targets(cells: DataFrame) -> DataFrame:
    """Target words, rate and offset of each source; one row a source."""
    key = [_OWN + "no_source", _OWN + "source"]
    sources = cells.groupBy(*key).agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(*key)) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST)
    filling = Window.orderBy(F.col("most") / F.col("weight"), *key)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    level = left / F.sum("weight").over(after)  # words a unit of weight, if all sources before are full
    sources = sources.withColumn("level", level)
    sources = sources.withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    rest = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), *key, F.col("level")))).over(everything)
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * rest["level"])
    offset = _hash(F.concat(F.lit("offset "), F.col(key[1]), F.col(key[0]).cast("string"))) / F.lit(float(1 << 60))
    return sources.withColumn("target", target).select(
        *key,
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0).alias("rate"),
        offset.alias("offset"),
    )


def with_copies(docs: DataFrame) -> DataFrame:
    """Every row of docs with size, source_size, target and copies (0, 1 or 2) under prefixed names."""
    placed = _placed(docs)
    source = [_OWN + "no_source", _OWN + "source"]
    cell = [*source, _OWN + "class", _OWN + "salt"]
    cells = placed.groupBy(*cell).agg(F.count("*").alias("rows"), F.sum(_OWN + "size").alias("words"))
    before = Window.partitionBy(*source).orderBy(*cell[2:]).rowsBetween(Window.unboundedPreceding, -1)
    base = cells.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    base = base.join(_targets(cells), source).select(*cell, "base", "source_size", "target", "rate", "offset")
    for c in ("base", "source_size", "target", "rate", "offset"):
        base = base.withColumnRenamed(c, _OWN + c)
    in_cell = Window.partitionBy(*cell).orderBy(_OWN + "hash", _OWN + "size")
    ranked = placed.withColumn(_OWN + "place", F.row_number().over(in_cell)).join(base, cell)
    until = F.col(_OWN + "base") + F.col(_OWN + "place")
    crossed = F.floor(F.col(_OWN + "offset") + F.col(_OWN + "rate") * until) - F.floor(
        F.col(_OWN + "offset") + F.col(_OWN + "rate") * (until - 1)
    )
    return ranked.withColumn(_OWN + "copies", crossed)


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each row of docs as often as it is taken, columns as they were."""
    times = with_copies(docs).withColumn(_OWN + "copy", F.explode(F.sequence(F.lit(1), F.lit(MOST))))
    return times.where(F.col(_OWN + "copy") <= F.col(_OWN + "copies")).select(*[F.col(f"`{c}`") for c in docs.columns])


def taken_words(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    found = with_copies(docs.select("doc_id", "text", "source"))
    return found.select(
        "doc_id",
        F.col(_OWN + "size").alias("size"),
        F.col(_OWN + "source_size").alias("source_size"),
        F.col(_OWN + "target").alias("target"),
        (F.col(_OWN + "copies") * F.col(_OWN + "size")).alias("taken"),
    )


def op10_source_mixture(spark, folder: str) -> DataFrame:
    return taken_words(documents(spark, folder))


def _sql_hash(text: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:' || {text}), 1, 15) AS BIGINT)"


ORACLE = f"""
WITH placed AS (
  SELECT doc_id, size, source IS NULL AS no_source, coalesce(source, '') AS source, hash,
    length(bin(size)) * 16 + (((size << 4) >> (length(bin(size)) - 1)) & 15) AS class, hash % {SALTS} AS salt
  FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    {_sql_hash("coalesce(doc_id::VARCHAR, '')")} AS hash FROM documents)
), sources AS (
  SELECT no_source, source, sum(size)::BIGINT AS source_size,
    [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY no_source, source) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM placed GROUP BY no_source, source
), levels AS (
  SELECT *, {MOST} * source_size AS most,
    ({SHARE}::DOUBLE * (sum(source_size) OVER ()) - coalesce(sum({MOST} * source_size) OVER (filling
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(weight) OVER (filling
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM sources WINDOW filling AS (ORDER BY {MOST} * source_size / weight, no_source, source)
), rest AS (
  SELECT level FROM levels WHERE most > weight * level ORDER BY most / weight, no_source, source LIMIT 1
), targets AS (
  SELECT no_source, source, source_size,
    CASE WHEN most <= weight * level THEN most::DOUBLE ELSE weight * (SELECT level FROM rest) END AS target,
    {_sql_hash("'offset ' || source || no_source::VARCHAR")} / {float(1 << 60)!r}::DOUBLE AS shift
  FROM levels
), ordered AS (
  SELECT doc_id, size, source_size, target, shift, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate,
    row_number() OVER (PARTITION BY no_source, source ORDER BY class, salt, hash, size) AS place
  FROM placed JOIN targets USING (no_source, source)
)
SELECT doc_id, size, source_size, target,
  ((floor(shift + rate * place) - floor(shift + rate * (place - 1))) * size)::BIGINT AS taken
FROM ordered
"""
