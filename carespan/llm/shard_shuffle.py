"""Sharding by a two-pass external shuffle, with DataFrame functions only.

First pass: rows are scattered uniformly into buckets of about ``BUCKET_BYTES`` by a seeded
hash of doc_id, text and row number, so a bucket fits in a task's memory however large the table is. Second
pass: each bucket's rows, in a fixed order, are shuffled by Fisher-Yates (Spark's ``shuffle`` of an
array, with a seed) and written. The buckets one after another are a random order of all rows;
the shards are its equal parts.

Law: ``rows``. The row counts of two shards differ by one at most. Buckets are counted with a
combining aggregate and their counts summed up in bucket order, a row for each bucket; a row's place in
the whole is its bucket's base plus its place in the bucket.

Nulls, ties and odd rows: a null text counts no bytes and is scattered like any other; a null
doc_id is a row like any other; rows repeated as a whole are told apart by a column that the
caller names (the query takes each row's file and number in it, which stay the same however files are split), so they are scattered, too;
without one they share a bucket, each with its own place. Other columns are written as they are; no rows give no rows. The
order depends on the rows, that column, the seed and the number of buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespan.llm.storage import documents
from carespan.session import fresh_path

SHARDS = 40
BUCKET_BYTES = 8 << 20
ROW_BYTES = 16
SEED = 17
LAW = "rows"
NUMBER = "__shard_number"


def _size():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES


def numbered(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and text of the documents, and each row's file and number in it as ``NUMBER``."""
    number = F.xxhash64("_metadata.file_name", "_metadata.row_index").alias(NUMBER)
    return documents(spark, folder).select("doc_id", "text", number)


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, number: str | None = None) -> DataFrame:
    """docs with its columns in ``row``, and the ``shard`` and ``slot`` of each.

    ``number`` names a column that tells rows equal in doc_id and text apart; it is left out of ``row``.
    """
    total = docs.agg(F.sum(_size()).alias("bytes"), F.count("*").alias("rows")).first()
    rows, buckets = total.rows, max(1, -(-(total.bytes or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text", *([number] if number else [])), F.lit(buckets))
    scattered = docs.select(bucket.alias("bucket"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != number]).alias("row"))
    ordered = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        docs.select(bucket.alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("base"))
    )
    # The seed of an array's shuffle goes with its partition: a fixed number of them, in order within.
    gathered = (
        scattered.repartition(buckets, "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .sortWithinPartitions("bucket")
    )
    dealt = gathered.select("bucket", F.shuffle("rows", SEED).alias("rows")).join(F.broadcast(bases) if buckets <= 10_000 else bases, "bucket")
    placed = dealt.select("base", F.posexplode("rows").alias("place", "row")).select(
        (F.col("base") + F.col("place")).alias("at"), "row"
    )
    shard = F.expr(f"at * {shards} div {max(rows, 1)}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "row", "shard", F.expr(f"at - (shard * {max(rows, 1)} + {shards - 1}) div {shards}").alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, number: str | None = None) -> DataFrame:
    """Write the shards under ``folder`` (a folder for each) and read them again."""
    placed = shuffled_shards(docs, shards, bucket_bytes, number)
    placed.write.partitionBy("shard").parquet(folder)
    schema = placed.schema
    return docs.sparkSession.read.schema(schema).parquet(folder).select("row", "shard", "slot")


def shard_digests(docs: DataFrame, folder: str, bucket_bytes: int = BUCKET_BYTES, number: str | None = None) -> DataFrame:
    """Contract columns of every row, from the files written."""
    columns = ["doc_id", "text", *([number] if number else [])]
    written = write_shards(docs.select(*columns), folder, bucket_bytes=bucket_bytes, number=number)
    text = F.col("row.text")
    return written.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_two_pass_shards(spark, folder: str) -> DataFrame:
    return shard_digests(numbered(spark, folder), fresh_path(spark, "llm-shards"), number=NUMBER)
