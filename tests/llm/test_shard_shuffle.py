"""The sharding law, the files and the randomness of the order."""

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from carespan.llm import shard_shuffle
from carespan.session import fresh_path


def rows_of(n):
    rng = random.Random(n)
    rows = [(k, "".join(rng.choices("abcdé ", k=rng.randint(0, 300)))) for k in range(n)]
    return rows + [(None, "x"), (None, None), (1, None)] + [(2, "same")] * 30 + [(k, "copy") for k in range(n, n + 200)]


def check(got, rows, shards=40):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1 and set(counts) <= set(range(shards))
    assert sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s, n in counts.items() for k in range(n))
    assert {(r.law, r.grown_shard) for r in got} <= {("rows", None)}


def test_law_and_files(spark):
    rows = rows_of(1000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit(1)).withColumn("row", F.lit("r"))
    folder = fresh_path(spark, "shards")
    got = shard_shuffle.shard_digests(docs, folder, bucket_bytes=4000).collect()
    check(got, rows)
    assert spark.read.parquet(f"{folder}/shard=7").count() in (30, 31)
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    rising = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.4 < rising / len(order) < 0.6
    again = shard_shuffle.shard_digests(docs, fresh_path(spark, "shards"), bucket_bytes=4000).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(k, f"t{k}", k % 3) for k in range(50)], "doc_id long, text string, shard int")
    out = shard_shuffle.shuffled_shards(docs, shards=7).collect()
    assert sorted((r.row.doc_id, r.row.shard) for r in out) == [(k, k % 3) for k in range(50)]


def test_few_and_no_rows(spark):
    for rows in ([(1, "a")], [], [(None, None)] * 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        check(shard_shuffle.shard_digests(docs, fresh_path(spark, "shards")).collect(), rows) if rows else None
        if not rows:
            assert shard_shuffle.shard_digests(docs, fresh_path(spark, "shards")).count() == 0


def test_equal_rows_of_files_are_scattered(spark):
    folder = fresh_path(spark, "equal")
    rows = [(k, f"text {k}") for k in range(1000)] + [(5, "same")] * 500 + [(None, None)] * 300
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs = shard_shuffle.numbered(spark, folder)
    got = shard_shuffle.shard_digests(docs, fresh_path(spark, "shards"), bucket_bytes=1000, number=shard_shuffle.NUMBER).collect()
    check(got, rows)
    for same in (lambda r: r.doc_id is None, lambda r: r.doc_id == 5 and r.size == 20):
        held = Counter(r.shard for r in got if same(r))
        assert len(held) > 35 and max(held.values()) < 35  # of 45 rows in a shard
    # However the files are split, the rows fall into the same shards.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    again = shard_shuffle.shard_digests(shard_shuffle.numbered(spark, folder), fresh_path(spark, "shards"), bucket_bytes=1000, number=shard_shuffle.NUMBER)
    same_again = sorted(map(str, again.collect())) == sorted(map(str, got))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert same_again
